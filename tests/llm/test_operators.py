"""Each corpus operator against a brute-force version, or its edge cases: nulls, empty and long texts, ties, repeated
rows, empty tables and clashing extra columns."""

import collections
import datetime
import hashlib
import re
import zlib

import numpy as np
import pytest

from folioscope.llm import curriculum, license_scan, multiset_hash, packing, pii_feistel, preference, prob_minhash, quality_crf, suffix_dedup, textcore, toxicity_kn

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, node string, bands int, _size int"


def text(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{int(i)}é" if i % 7 else f"The{int(i)}." for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def rows():
    base = text(1, 300)
    words = base.split(" ")
    near = " ".join(w if i % 100 else "changed" for i, w in enumerate(words))
    long = text(5, 6000, 50_000)
    out = [(1, base), (2, base), (3, near), (4, text(2, 200)), (5, None), (6, ""), (7, "   \n "), (8, "one"), (9, "a b c d e"), (10, base[200:900] + "\n" + text(3, 100)), (11, text(3, 100)), (12, long), (13, long[5000:9000] + " end"), (None, base), (8, "one")]
    return [(i, t, "s" if i else None, "x", 1, 2) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def shingles(t):
    w = WORD.findall(t or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else {}


def jp(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in both) for d in x if d in y)


def test_near_duplicates(docs, rows):
    got = {(r.doc_id): r.class_id for r in prob_minhash.near_duplicates(docs, block=2).collect()}
    sets = {i: shingles(t) for i, t, *_ in rows if i}
    for a in sets:
        for b in sets:
            same = jp(sets[a], sets[b]) >= 0.8 if sets[a] and sets[b] else not sets[a] and not sets[b]
            if same:
                assert got[a] == got[b], (a, b)
    assert got[1] == got[2] == got[3] == 1 and got[4] == 4 and got[5] == got[6] == got[7] == 5 and got[8] == 8
    kept = prob_minhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 8, 9, 10, 11, 12, 13]
    assert prob_minhash.near_duplicates(docs.limit(0)).count() == 0 and prob_minhash.keep_one(docs.limit(0)).count() == 0


def test_unique_texts_stay_whatever_their_id(spark):
    x, y, z = text(1, 200), text(2, 200), text(3, 200)
    near = x + " and a little more"
    data = [(1, x, "p"), (None, y, "q"), (5, near, "r"), (5, z, "s"), (None, y, "q"), (1, x, "t"), (None, near, "u")]
    got = prob_minhash.keep_one(spark.createDataFrame(data, "doc_id long, text string, row string"))
    assert got.columns == ["doc_id", "text", "row"]
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(1, x), (0, y), (5, z)])
    kept = prob_minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string, k1 string"))
    assert sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in kept.collect()) == [(0, 0, True), (0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (5, 1, False), (5, 5, True)]


def test_planted_pairs_are_found(spark):
    """Links and classes of 400 pairs of J_P between 0.8 and 0.9, and none of 100 pairs below 0.75."""
    data, want = [], {}
    for i in range(500):
        cut = 4 + i % 7 if i < 400 else 30
        w = [f"p{i}w{j}" for j in range(95)]
        data += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[: 95 - cut] + [f"x{i}w{j}" for j in range(cut)]))]
        want[i] = jp(shingles(data[-2][1]), shingles(data[-1][1]))
    assert all(0.8 <= want[i] <= 0.93 for i in range(400)) and all(want[i] < 0.75 for i in range(400, 500))
    got = {r.doc_id: r.class_id for r in prob_minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), block=64).collect()}
    assert np.mean([got[2 * i] == got[2 * i + 1] for i in range(400)]) >= 0.99 and all(got[2 * i] != got[2 * i + 1] for i in range(400, 500))


def test_a_bucket_beyond_its_blocks(spark):
    """A family of near copies, most within reach of its first, in blocks far smaller than it: as brute force."""
    base = [f"b{j}" for j in range(120)]
    rng = np.random.default_rng(8)
    data = []
    for i in range(60):
        w = list(base)
        for j in rng.choice(120, int(rng.integers(0, 4)), False):
            w[j] = f"n{i}_{j}"
        data.append((i, " ".join(w)))
    sets = [shingles(t) for _, t in data]
    up = list(range(60))

    def root(x):
        return x if up[x] == x else root(up[x])

    for i in range(60):
        for j in range(i):
            if jp(sets[i], sets[j]) >= 0.8:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    got = {r.doc_id: r.class_id for r in prob_minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), block=5).collect()}
    assert got == {i: root(i) for i in range(60)}


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b").union(spark.range(1000, 1003).selectExpr("id as a", "1010 as b"))
    got = {r.node: r.component for r in prob_minhash.components(links.repartition(7)).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[i] == 1000 for i in (1001, 1002, 1010))


def test_similarity_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = ({int(k): int(v) for k, v in zip(rng.choice(30, 12, False), rng.integers(1, 4, 12), strict=True)} for _ in range(2))
        a, b = (np.array(sorted(d), np.uint64) for d in (x, y))
        assert abs(prob_minhash.similarity(a, np.array([x[int(k)] for k in a]), b, np.array([y[int(k)] for k in b])) - jp(x, y)) < 1e-9


def test_registers_estimate_similarity():
    a, b = (textcore.mix(np.arange(s, s + 200, dtype=np.uint64)) for s in (0, 50))
    sig = prob_minhash.signatures(np.r_[a, b], np.repeat([0, 1], 200), np.ones(400), 2, 1024)
    assert abs((sig[0] == sig[1]).mean() - 150 / 250) < 0.07


def brute_dedup(rows, length):
    seen, out = {}, {}
    for d, t in sorted({(d, t) for d, t in rows if d is not None}):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                cover[i : i + length] = b"\1" * length
            else:
                seen[b[i : i + length]] = d
        spans = sum(1 for i in range(len(b)) if cover[i] and (not i or not cover[i - 1]))
        out[d] = (len(b), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(b, cover, strict=True) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("how", [{}, {"most": 1}, {"share": 0.0001}])
def test_suffix_dedup(docs, rows, how):
    want = brute_dedup([(i, t) for i, t, *_ in rows], 100)
    got = suffix_dedup.deduplicated(docs, **how).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
        else:
            assert r.n_removed == 0


def test_texts_that_share_a_doc_id(spark):
    x, y = text(7, 80), text(8, 80)
    got = suffix_dedup.deduplicated(spark.createDataFrame([(1, x), (2, x), (2, y), (2, x), (3, "a " + y)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == sorted([(1, len(x.encode()), 0), *[(2, len(x.encode()), len(x.encode()))] * 2, (2, len(y.encode()), 0), (3, len(y.encode()) + 2, len(y.encode()))])
    assert suffix_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_merged_transforms(shards):
    """Order and common prefixes of merged shards as by sorting all suffixes; one string is a case of its own."""
    rng = np.random.default_rng(shards)
    strings = [rng.integers(1, 3, int(n)).astype(np.uint16) for n in rng.integers(1, 30, 8 if shards > 1 else 1)]
    sizes, parts, at = np.array([len(x) for x in strings]), [], 0
    for chosen in np.array_split(np.arange(len(strings)), shards):
        bwt, suffix = suffix_dedup.shard_bwt(np.concatenate([strings[i] for i in chosen]), sizes[chosen])
        parts.append((bwt, suffix + at))
        at += int(sizes[chosen].sum()) + len(chosen)
    order, common = suffix_dedup.merge_all(parts, 40)
    full = []
    for i, x in enumerate(strings):
        full += [(*(int(v) + 100 for v in x[k:]), i) for k in range(len(x) + 1)]
    want = sorted(range(len(full)), key=lambda k: full[k])
    assert order.tolist() == want
    share = lambda a, b: next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), 0)
    assert common[1:].tolist() == [share(full[a], full[b]) for a, b in zip(want, want[1:], strict=False)]
    one = suffix_dedup.covered_windows([b"ab" * 200], np.array([1]), np.array([0]), np.array([0]), np.array([301]))
    assert len(one[0]) == 299


def test_repetitive_bytes(spark):
    data = [(1, "a" * 500), (2, "a" * 99), (3, "ab" * 300), (4, "xab" + "ab" * 120)]
    got = suffix_dedup.deduplicated(spark.createDataFrame(data, "doc_id long, text string"))
    want = brute_dedup(data, 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == want


def test_packing(docs, rows, spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.tokenizer_path())
    docs = docs.unionByName(spark.createDataFrame([(20, "it's 'some <|endoftext|> don't A1b2,c—d é  x", "s", "x", 1, 2)], DOCS))
    pieces = collections.defaultdict(list)
    for r in packing.pack_documents(docs).collect():
        pieces[r.doc_id].append(r)
    for i, t, *_ in [*rows, (20, "it's 'some <|endoftext|> don't A1b2,c—d é  x")]:
        ids = [*encoder.encode(t or "", add_special_tokens=False).ids, 2]
        if i != 8:
            assert sum(p.length for p in pieces[i]) == len(ids)
            for p in pieces[i]:
                assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    used = collections.defaultdict(list)
    for p in (p for ps in pieces.values() for p in ps):
        used[p.sequence_id].append((p.offset, p.length))
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_pack_any_sizes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 17, 300):
        sizes = rng.integers(1, 9000, n).tolist()
        got = packing.pack(sizes)
        assert sum(p[2] for s in got for p in s) == sum(sizes)
        assert all((t := sum(p[2] for p in s)) == 4096 or t & (t - 1) == 0 for s in got)


def test_quality_base_counts(docs, rows, spark):
    more = [(30, "a <b> | c\n\na <b> | c\n \t\n#x\na <b> | c", "s", "x", 1, 2), (31, "é #* $%&\r\né #* $%&", "s", "x", 1, 2)]
    docs, rows = docs.unionByName(spark.createDataFrame(more, DOCS)), [*rows, *more]
    labels = spark.createDataFrame([(1, 1), (4, 1), (9, 0), (8, 0)], "doc_id long, quality int")
    for r in quality_crf.judge(docs, labels).collect():
        t = next(t for i, t, *_ in rows if i == r.doc_id) or ""
        w = WORD.findall(t)
        c = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(cover))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert quality_crf.judge(docs, labels.limit(0)).where("kept").count() > 0


def test_field_gradients():
    rng = np.random.default_rng(2)
    x = np.array([[3, 700, 9, -1], [1, -1, -1, -1], [5, 6, 4000, 2]])
    y, scale = rng.integers(0, 2, x.shape), np.array([0.5, 0.2, 0.3])
    w, t = rng.normal(size=(len(quality_crf.FEATURES) + 1, 2)), rng.normal(size=(2, 2))
    value, *grads = quality_crf.log_likelihood(w, t, x, y, scale)
    assert value < 0
    for at, grad in ((w, grads[0]), (t, grads[1])):
        for i in np.ndindex(*at.shape):
            at[i] += 1e-5
            up = quality_crf.log_likelihood(w, t, x, y, scale)[0]
            at[i] -= 2e-5
            down = quality_crf.log_likelihood(w, t, x, y, scale)[0]
            at[i] += 1e-5
            assert abs((up - down) / 2e-5 - grad[i]) < 1e-6


def test_lines_of_both_kinds_are_told_apart(spark):
    rng = np.random.default_rng(6)
    good = lambda i: f"The word{i} of this line goes on for a while and ends with words {i}."
    junk = lambda i: f"| buy{i} ### | $$$ now{i} | && | %% {i}"
    data, labels = [], []
    for i in range(200):
        q = i % 2
        data.append((i, "\n".join((good if (rng.random() < 0.85) == bool(q) else junk)(100 * i + k) for k in range(10))))
        labels.append((i, q))
    data.append((999, "\n".join([*map(good, range(6)), *map(junk, range(3))])))
    df = spark.createDataFrame(data, "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_crf.judge(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert sum(0 < r.content_share < 1 for r in rows.values()) > 50 and 0.5 < rows[999].content_share < 1
    assert np.mean([(rows[i].content_share >= 0.5) == bool(q) for i, q in labels]) > 0.95
    assert quality_crf.judge(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    emission, transition = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    row, code = np.array([0, 0, 0, 2, 2, 2, 2, 3]), rng.integers(0, 8, 8)
    got = quality_crf.viterbi(row, code, 4, emission, transition)
    for r in (0, 2, 3):
        c = code[row == r]
        score = lambda p: sum(emission[k, y] for k, y in zip(c, p, strict=True)) + sum(transition[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
        best = max((tuple(int(b) for b in np.binary_repr(v, len(c))) for v in range(2 ** len(c))), key=score)
        assert tuple(got[row == r]) == best


def test_pseudonyms(spark):
    t = "card 4539 1488 0343 6467, 4539148803436467 ip 10.1.2.3 on 1999-02-28 or 28/02/1999 tel +1 (743) 555-3824 ssn 123-45-6789 mail ann.b2@x.org bad 4539148803436468 2023-02-30"
    df = spark.createDataFrame([(1, t), (2, t), (3, None), (4, "")], "doc_id long, text string")
    a, b, c, d = (r.text for r in pii_feistel.pseudonymised(df, "key").orderBy("doc_id").collect())
    assert a == b != t and c is None and d == "" and "4539148803436468 2023-02-30" in a
    spaced, plain = re.search(r"card ([\d ]+), (\d+)", a).groups()
    assert spaced.replace(" ", "") == plain and plain[0] == "4"
    digits = [int(x) for x in plain[::-1]]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])) % 10 == 0
    iso, day = re.search(r"on (\S+) or (\S+)", a).groups()
    assert datetime.date.fromisoformat(iso).strftime("%d/%m/%Y") == day
    other = pii_feistel.pseudonymised(df, key="k").orderBy("doc_id").first().text
    assert other != a and re.search(r"mail [a-z]{3}\.[a-z]\d@x\.org", a)


def test_no_value_is_left_in_clear(spark):
    card = "4539 1488 0343 6467"
    phones = ["+1-743-555-3824", "+1.743.555.3824", "+1743-555-3824", "743 555 3824", "+1 743 555 3824", "7435553824", "+17435553824", "(743) 555-3824", "1-743-555-3824", "743-555-3824", "743.555.3824"]
    cards = [f"{card} 12/27", f"12/27 {card} 124", f"{card} 124", f"1234 5678 {card} 12-27", f"{card} {card}", f"{card} 743-555-3824", f"{card} 1999-02-28", "3056 930902 5904"]
    same = ["4539 1488 0343 6468", "id a7435553824", "0.7435553824", "74355538241"]
    df = spark.createDataFrame([(i, f"see {x} now") for i, x in enumerate(phones + cards + same)], "doc_id long, text string")
    got = [r.text[4:-4] for r in pii_feistel.pseudonymised(df, "key").orderBy("doc_id").collect()]
    form = lambda x: re.sub("[0-9]", "0", x)
    assert [form(x) for x in got] == [form(x) for x in phones + cards + same] and got[len(phones + cards) :] == same
    numbers = {re.sub("[^0-9]", "", x)[-10:] for x in got[: len(phones)]}
    assert len(numbers) == 1 and "7435553824" not in numbers
    shown = got[len(phones) :]
    new = shown[2][: len(card)]
    assert new != card and [x.count(new) for x in shown[:7]] == [1, 1, 1, 1, 2, 1, 1]
    assert shown[3].startswith("1234 5678 ") and shown[5].replace("-", "").endswith(numbers.pop()) and not shown[6].endswith("1999-02-28") and shown[7][5:] != "930902 5904"


def test_numbers_of_other_countries_and_accounts(spark):
    values = ["+44 20 7946 0958", "+442079460958", "+49 (30) 901820-55", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606"]
    same = ["DE88 3704 0044 0532 0130 00", "+44 20", "AB12CD", "C+12345678"]
    df = spark.createDataFrame([(i, f"see {x}, now") for i, x in enumerate(values + same)], "doc_id long, text string")
    got = [r.text[4:-5] for r in pii_feistel.pseudonymised(df, "k").orderBy("doc_id").collect()]
    form = lambda x: re.sub("[0-9]", "0", x)
    assert [form(x) for x in got] == [form(x) for x in values + same] and got[len(values) : -1] == same[:-1]
    bare = [x.replace(" ", "") for x in got]
    assert bare[0] == bare[1] != values[1] and got[2].startswith("+49 (3") and bare[3] == bare[4] and all(a != b for a, b in zip(got, values, strict=False))
    for x in bare[3:7]:
        assert int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_telephones_stay_diallable_and_apart(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "concat('(', 200 + id % 800, ') ', lpad(cast(2000000 + id * 397 as string), 7, '0')) as text", "1 as matches", "2 as row", "3 as new")
    rows = pii_feistel.pseudonymised(df, "k")
    got = [re.sub("[^0-9]", "", r.text) for r in rows.collect()]
    assert rows.columns == df.columns and len(set(got)) == df.select("text").distinct().count() and all(x[0] >= "2" and x[3] >= "2" for x in got)
    assert pii_feistel.pseudonymised(df.limit(0), "k").count() == 0 and rows.select("matches", "row", "new").distinct().collect() == [(1, 2, 3)]


def test_feistel_permutes(spark):
    df = spark.range(189 * 773).selectExpr("date_format(date_add(date'1800-01-01', cast(id as int)), 'yyyy-MM-dd') as text")
    assert pii_feistel.pseudonymised(df, "key").distinct().count() == 189 * 773


def test_curriculum_meets_targets(spark):
    rng = np.random.default_rng(2)
    data = [(i, " ".join(["x"] * int(rng.integers(0, 40))), "s" + str(i % 5 if i % 3 else 0)) for i in range(400)] + [(400, None, None), (401, "a b", None), (401, "a b", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = curriculum.curriculum(curriculum.measured(df), buckets=8).collect()
    assert len(got) == len(data) and all(0 <= r._taken <= 3 * r._size for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for rs in by.values():
        assert sum(r._taken for r in rs) == int(rs[0]._target)
    assert abs(sum(rs[0]._target for rs in by.values()) - sum(r._size for r in got)) < 1e-6
    mixed = curriculum.mix(df.selectExpr("*", "1 as _size", "2 as _hash", "3 as row", "4 as _text"))
    assert mixed.columns == [*df.columns, "_size", "_hash", "row", "_text"] and mixed.select("_size", "row").distinct().collect() == [(1, 3)]
    assert curriculum.mix(df.limit(0)).count() == 0
    mixed = curriculum.mix(df)
    assert mixed.columns == df.columns and mixed.agg({"doc_id": "count"}).first()[0] > 0
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert {k: v for k, v in words.items()} == {k: int(rs[0]._target) for k, rs in by.items() if int(rs[0]._target)}


def test_every_stretch_has_its_share(spark):
    """By numeric integration: the words of a source that lie before a place in the stream are those its ramp demands."""
    data = [(i, " ".join(["x"] * 5), "abc"[i % 3]) for i in range(3000)]
    rows = curriculum.curriculum(curriculum.measured(spark.createDataFrame(data, "doc_id long, text string, source string")), buckets=8).where("_taken > 0").collect()
    target = {r.source: (r._target, r._ramp) for r in rows}
    t = np.linspace(0, 1, 20_001)
    demand = {s: np.cumsum(np.r_[0, w * (1 + a * (t[1:] + t[:-1] - 1)) * np.diff(t)]) for s, (w, a) in target.items()}
    everything = sum(demand.values())
    assert abs(everything[-1] - 15_000) < 1 and len({a for _, a in target.values()}) == 3
    for place in (1000, 4000, 9000):
        at = np.searchsorted(everything, place)
        for s in "abc":
            size = {r.source: r._source_size for r in rows}[s]
            first = sum(min(5, r._taken) for r in rows if r.source == s and r._position < place)
            assert abs(first - min(demand[s][at], size)) < 12, (place, s)


def brute_kneser_ney(sample, docs, wanted):
    """Mean differences of log-likelihood, straight from the formulas."""
    words = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    everything = collections.Counter(w for t in docs for w in words(t))
    n = [collections.Counter(), collections.Counter()]
    for t, c in sample:
        w = ["", *words(t)]
        n[c].update(zip(w, w[1:], strict=False))
    both = n[0] + n[1]

    def discount(counts):
        c = collections.Counter(counts)
        return c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5

    def level(n, lower):
        d, total, kinds = discount(n.values()), collections.Counter(), collections.Counter()
        for (u, _), k in n.items():
            total[u] += k
            kinds[u] += 1
        return lambda u, w: (max(n[u, w] - d, 0) + d * kinds[u] * lower(u, w)) / total[u] if total[u] else lower(u, w)

    def model(n):
        kinds = collections.Counter(w for _, w in n)
        d, total = discount(kinds.values()), len(n)
        word = lambda u, w: (max(kinds[w] - d, 0) + d * len(kinds) * everything[w] / sum(everything.values())) / total
        return level(n, level(both, word))

    p = [model(x) for x in n]
    out = {}
    for i, t in wanted:
        w = ["", *words(t)]
        gain = [np.log(p[1](u, x)) - np.log(p[0](u, x)) for u, x in zip(w, w[1:], strict=False)]
        out[i] = np.mean(gain) if gain else 0.0
    return out


def test_kneser_ney_is_that_of_the_formulas(spark):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    texts = [" ".join(f"W{int(k)}{'é' if k % 3 else ''}," for k in rng.zipf(1.4, 30) % 60) for _ in range(40)] + ["", None, "a a a b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sample = [(texts[i], i % 2) for i in range(24)]
    model = toxicity_kn.model_of(df, spark.createDataFrame(sample, "text string, toxic int"))
    data, offs = textcore.text_buffers(pa.array(texts))
    got = model.signals(data, offs)[:, 0]
    want = brute_kneser_ney(sample, texts, list(enumerate(texts)))
    assert np.allclose(got, [want[i] for i in range(len(texts))], atol=1e-4)


def test_toxicity_separates(spark):
    rng = np.random.default_rng(4)
    data, labels = [], []
    for i in range(600):
        w = [f"w{int(k)}" for k in rng.zipf(1.3, 80) % 500]
        bad = i % 3 == 0
        if bad:
            for k in rng.integers(0, 80, 4):
                w[k] = ["vile", "awful", "nasty"][int(k) % 3]
        data.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    data += [(1000, None), (1001, ""), (1002, " .\n"), (None, data[0][1]), (3, data[3][1])]
    df, lab = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_kn.score(df, lab).collect()}
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert np.mean([p == y for p, y in held]) > 0.95 and got[1000].predicted == got[1001].predicted == got[1002].predicted == 0
    kept = toxicity_kn.keep_ordinary(df.selectExpr("*", "1 as row", "2 as toxic"), lab)
    assert kept.count() < 480 and kept.columns == ["doc_id", "text", "row", "toxic"]
    assert toxicity_kn.score(df.limit(0), lab).count() == 0
    assert {r.score for r in toxicity_kn.score(df, lab.where("toxic = 0")).collect()} == {0.0}


def test_preference(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a b"), (1, 2, "user", "x"), (2, 0, "user", "hi"), (2, 1, "assistant", "a b"), (2, 2, "assistant", "z"), (3, 0, None, None), (None, 0, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.chosen_id: r for r in preference.preferences(df).collect()}
    r = got[2]
    assert r.rejected_id == 1 and r.shared_turns == 2 and r.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\na b<|end|>\n"
    assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == ["z"] and r.rejected_mask == [] and got[3].rejected is None
    same = preference.preferences(df, spark.createDataFrame([(1, 1), (9, 1)], "chosen_id long, rejected_id long")).collect()
    assert len(same) == 1 and same[0].chosen == same[0].rejected == ""


def test_every_conversation_gets_a_pair(spark):
    turns = [(i, k, "assistant" if k % 2 else "user", f"u{i if i < 40 else 'hot'}" if not k else f"t{i} {k}") for i in range(540) for k in range(4)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = preference.preferences(df).collect()
    own = [r for r in rows if r.chosen_id < 40]
    assert len(own) == 40 and len(rows) == 40 + 250 and all(r.rejected is not None and r.rejected_id != r.chosen_id for r in rows)
    for r in own:
        assert r.shared_turns == 3 and r.prompt.endswith(f"t{r.chosen_id} 2<|end|>\n")
        assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == [f"t{r.chosen_id} 3"] and [r.rejected[m.start : m.end] for m in r.rejected_mask] == [f"t{r.rejected_id} 3"]
    ids = [x for r in rows if r.chosen_id >= 40 for x in (r.chosen_id, r.rejected_id)]
    assert sorted(ids) == list(range(40, 540))


def test_preference_query_as_by_hand(spark, tmp_path):
    """All columns of the query against a version in plain Python, for the pairs it makes."""
    rng = np.random.default_rng(5)
    turns = []
    for i in range(300):
        script = ["hot" if i % 3 else f"own {i}", *(f"x{int(rng.integers(0, 3))}" for _ in range(int(rng.integers(0, 5))))]
        turns += [(i, k, ("user", "assistant")[k % 2], x if rng.random() < 0.97 else None) for k, x in enumerate(script)]
    turns += [(7, 0, "user", "again"), (None, 1, "user", "q"), (301, None, None, None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    convs = collections.defaultdict(list)
    for i, k, role, x in turns:
        convs[i].append((k if k is not None else -1, role or "", x or ""))
    convs = {i: [(r, x) for _, r, x in sorted(c)] for i, c in convs.items() if i is not None}
    show = lambda c: "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in c)

    def mask(c):
        at, out = 0, []
        for r, x in c:
            at += len(r) + 5
            if r == "assistant" and x:
                out.append(f"{at}-{at + len(x)}")
            at += len(x) + 8
        return ",".join(out)

    seen = []
    for r in preference.op6_preference(spark, str(tmp_path)).collect():
        a, b = convs[r.chosen_id], convs.get(r.rejected_id)
        seen.append(r.chosen_id)
        if b is None:
            assert (r.shared_turns, r.prompt, r.chosen, r.rejected) == (1, show(a[:1]), show(a[1:]), None)
            continue
        if a[0] != b[0]:  # an alternative of the last assistant turn
            last = max(k for k, (role, _) in enumerate(a) if role == "assistant")
            b = [*a[:last], ("assistant", next(x for role, x in reversed(b) if role == "assistant"))]
        else:
            seen.append(r.rejected_id)
        n = next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
        assert (r.shared_turns, r.prompt, r.chosen, r.rejected) == (n, show(a[:n]), show(a[n:]), show(b[n:]))
        assert (r.chosen_mask, r.rejected_mask) == (mask(a[n:]), mask(b[n:]))
    assert sorted(seen) == sorted(convs)
    assert preference.preferences(spark.createDataFrame([], "conv_id long, turn long, role string, text string, t int, a int")).count() == 0


def test_multiset_hash(spark):
    t = ["One. Two.\nThree.", "Three.\nTwo. One.", "One. Two.", "", "x" * 5000]
    fp = lambda x: f"{multiset_hash.fingerprint(multiset_hash.pieces(x))}"
    df = spark.createDataFrame([(x,) for x in t], "text string").selectExpr("text", f"{fp('text')} as a", f"{multiset_hash.insert(fp('text'), fp(chr(39) + 'New.' + chr(39)))} as b", f"{fp('concat(text, chr(10), ' + chr(39) + 'New.' + chr(39) + ')')} as c")
    r = {x.text: x for x in df.collect()}
    assert r[t[0]].a == r[t[1]].a != r[t[2]].a and all(x.b == x.c for x in r.values()) and set(r[""].a) == {0}


def test_fingerprints_as_by_hand(docs, rows, spark):
    """The next document, the edited text and both fingerprints of every row, against plain Python."""
    places = sorted({(i is not None, i or 0, t or "") for i, t, *_ in rows})
    hashes = {t: h for t, h in spark.createDataFrame([(t,) for *_, t in places], "t string").selectExpr("t", "xxhash64(t)").collect()}
    places.sort(key=lambda p: (p[0], p[1], hashes[p[2]]))
    edited = {}
    for at, (named, i, t) in enumerate(places):
        n, after = len(t), places[(at + 1) % len(places)][2]
        edited[i if named else None, t] = (t[: n - n // 4] + after[: n // 4], after)
    got = multiset_hash.fingerprinted(docs).collect()
    assert len(got) == len(rows)
    text_of = {(i, len(t or "")): t or "" for i, t, *_ in rows}
    every = {t for pair in edited.items() for t in (pair[0][1], *pair[1])}
    fp = {r.t: r.fp for r in spark.createDataFrame([(t,) for t in every], "t string").selectExpr("t", f"{multiset_hash.fingerprint(multiset_hash.pieces('t'))} as fp").collect()}
    for r in got:
        t = text_of[r.doc_id, r.n_chars]
        new, after = edited[r.doc_id, t]
        assert (r.edited, r.fp, r.fp_edited, r.fp_next) == (new, fp[t], fp[new], fp[after])
    assert multiset_hash.fingerprinted(docs.limit(0)).count() == 0
    (one,) = multiset_hash.fingerprinted(docs.where("doc_id = 4")).collect()
    assert one.fp_next == one.fp


def test_likeness_follows_the_shared_part(spark):
    part = lambda tag, n: ". ".join(f"{tag} {i} sentence" for i in range(n))
    data = [(part("a", 60), part("a", 60), 1.0), (part("a", 60), part("b", 60), 0.0), (part("a", 60), part("a", 30) + ". " + part("b", 30), 0.5), ("", "", 1.0)]
    fp = lambda x: multiset_hash.fingerprint(multiset_hash.pieces(x))
    rows = spark.createDataFrame(data, "x string, y string, want double").selectExpr("want", f"{fp('x')} as x", f"{fp('y')} as y").selectExpr("want", f"{multiset_hash.likeness('x', 'y')} as got").collect()
    assert all(0 <= r.got <= 1 and abs(r.got - r.want) < 0.2 for r in rows)


def test_licences(spark):
    cases = [(s, k) for k, v in license_scan.TEMPLATES.items() for s in v] + [(s, None) for s in license_scan.UNKNOWN] + [("", None), (None, None)]
    df = spark.createDataFrame([(i, "intro\n" + s + "\nrest" if s else s) for i, (s, _) in enumerate(cases)], "doc_id long, text string")
    got = license_scan.scan(df).orderBy("doc_id").collect()
    assert [[x.family for x in r.licences] for r in got] == [[k] if k else [] for _, k in cases]


#: Not among the sentences that the classifier is trained on.
WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice.""",
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "LGPL": """This library is free software; you can redistribute it and/or modify it
under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation; either version 2.1 of the License, or later.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "MPL": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file""",
}
SHORT = {"The code is MIT licensed.": "MIT", "License: GPL-2.0-only": "GPL", "MIT License": "MIT", "The MIT License (MIT)": "MIT", "This project is licensed under the MIT License - see the file for details.": "MIT", "Apache License\nVersion 2.0, January 2004": "Apache-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL", "BSD 3-Clause License": "BSD", "# Readme\nlicensed under the Apache License 2.0": "Apache-2.0"}
TALK = ["The licensing of music is a wide field.", "She kept her licence in a drawer, and her copyright notices in another.", "Public domain works were shown.", "Permission to leave was not given.", "He works at MIT and licenses his inventions.", "Free software and general public use were the topics."]


def test_licences_that_are_wrapped_or_short(spark):
    cases = [(v, k) for k, v in WRAPPED.items()] + list(SHORT.items()) + [(x, None) for x in TALK]
    long = " ".join(f"w{i}" for i in range(500))
    cases += [(f"{long} {WRAPPED['MIT']} {long}", "MIT"), (f"{long} This work is licensed under CC BY-SA 4.0 {long}", "CC-BY-SA")]
    df = spark.createDataFrame([(i, f"Some title\n\n{x}\n \nAnd the rest.") for i, (x, _) in enumerate(cases)] + [(1000, WRAPPED["MIT"] + "\n\n" + WRAPPED["BSD"])], "doc_id long, text string")
    got = {r.doc_id: [(x.family, x.paragraph) for x in r.licences] for r in license_scan.scan(df).collect()}
    wrong = [(x, k, got[i]) for i, (x, k) in enumerate(cases) if got[i] != ([(k, 1)] if k else [])]
    assert not wrong and got[1000] == [("MIT", 0), ("BSD", 1)]
    assert license_scan.scan(df.limit(0)).count() == 0


#: Frames and names that the classifier is not trained on: held out, whole.
OTHER_GRANTS = ["Sources are published under the {}.", "It ships with the {} and may be used accordingly.", "The contents of this repository are licensed under the terms of the {}.", "Released by its authors under {}.", "See LICENSE: this package is distributed under the {}.", "This file is part of a library that is licensed under the {}.", "We license our work to you under the {}.", "Code licensed {}.", "Everything here is provided under the terms of {}."]
OTHER_TALK = ["A lecture on the {} and its licensing was held.", "It is not distributed under the {}.", "The licence debate about the {} went on.", "This code was not licensed under the {}.", "Many prefer other licenses to the {}.", "Our software is never released under the {}."]
OTHER_NAMES = {"MIT": "MIT licence", "Apache-2.0": "Apache License v2.0", "BSD": "3-clause BSD license", "GPL": "GNU GPL v3", "LGPL": "GNU LGPL v2.1", "AGPL": "GNU AGPL v3", "MPL": "MPL 2.0", "EPL": "Eclipse Public License v2.0", "ISC": "ISC licence", "CC-BY-SA": "CC BY-SA 3.0", "EUPL": "EUPL v1.2", "zlib": "zlib licence", "Boost": "Boost Software License v1.0"}
SEVERAL = {"dual-licensed under MIT and Apache-2.0": ["Apache-2.0", "MIT"], "This is licensed under either of Apache License, Version 2.0 or MIT license at your option.": ["Apache-2.0", "MIT"], "Distributed under the MIT software license, see the accompanying file LICENSE or http://www.opensource.org/licenses/mit-license.php.": ["MIT"], "distributed under the terms of the GNU GPL version 2 or later": ["GPL"], "The project uses the Apache license.": ["Apache-2.0"], "Not licensed under the MIT License.": [], "It is not available under the GPL.": []}


def test_licences_held_out(spark):
    cases = [(f.format(n), k) for f in OTHER_GRANTS for k, n in OTHER_NAMES.items()] + [(f.format(n), None) for f in OTHER_TALK for n in OTHER_NAMES.values()]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [x.family for x in r.licences] for r in license_scan.scan(df).collect()}
    hits = sum(k in got[i] for i, (_, k) in enumerate(cases) if k)
    claims = sum(len(v) for v in got.values())
    recall, precision = hits / sum(k is not None for _, k in cases), hits / max(1, claims)
    print(f"held out: {len(cases)} sentences, recall {recall:.3f}, precision {precision:.3f}")
    assert len(cases) >= 190 and recall >= 0.85 and precision >= 0.9  # 0.872 and 0.911
    probes = spark.createDataFrame(list(SEVERAL.items()), "text string, want array<string>")
    for r in license_scan.scan(probes).collect():
        assert [x.family for x in r.licences] == r.want, r.text


def softmax(z):
    e = [np.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_licence_model_in_sql_is_the_model(spark):
    """The SQL of one piece against the weights in plain Python."""
    weights, bias, names = license_scan.train()
    pieces = ["Licensed under the MIT License.", "He reads licences.", "", "GNU GPL or Apache-2.0, at your option", "1." * 5000, "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in pieces], "t string").selectExpr(f"{license_scan.judged('t', 0.7)} as x").collect()]
    for t, found in zip(pieces, got):
        w = license_scan.words(t)
        rows = [weights[g] for g in license_scan.grams(w) if g in weights]
        p = softmax([b + sum(r[k] for r in rows) / max(1, len(rows)) ** 0.5 for k, b in enumerate(bias)])
        pairs, want = {" ".join(w[i : i + 2]) for i in range(len(w) - 1)} or set(w), []
        for k, f in enumerate(names[:-1]):
            same = [sorted({" ".join(x[i : i + 2]) for i in range(len(x) - 1)} or set(x)) for x in map(license_scan.words, license_scan.TEMPLATES.get(f, []))]
            share = max((len(pairs & set(x)) / len(x) for x in same), default=0.0)
            named = bool(set(license_scan.TERMS.get(f, [])) & set(license_scan.grams(w)))
            if p[-1] < 0.5 and p[k] >= license_scan.SHARE * (1 - p[-1]) and (named or share >= 0.7 and p[k] >= 0.5 * (1 - p[-1])):
                want.append((f, p[k], share))
        assert [x.family for x in found] == [f for f, *_ in want], t
        assert all(abs(x.probability - q) < 1e-6 and abs(x.similarity - s) < 1e-9 for x, (_, q, s) in zip(found, want))


@pytest.mark.parametrize("text", ["license " + "1." * 1_000_000, "license" + "\n" * 2_000_000 + "x", "license" + " \n" * 1_000_000 + "x", "license" + "." * 2_000_000, "license " + "a" * 2_000_000, "license " + "word " * 400_000, "license" + "([{," * 500_000, "license " + "9" * 2_000_000], ids=lambda t: repr(t[7:11]))
def test_licences_in_long_texts(spark, text):
    assert license_scan.scan(spark.createDataFrame([(text,)], "text string")).select("licences").collect()[0].licences == []


PRIVATE = {
    "12/31/1985": "date", "1985/12/31": "date", "3.4.1985": "date", "31/12/1985": "date", "(020) 7946 0958": "national", "020 7946 0958": "national", "0049 30 1234567": "intl", "4539.1488.0343.6467": "card", "de89370400440532013000": "iban",
    "de89 3704 0044 0532 0130 00": "iban", "123 45 6789": "ssn", "7435553824": "phone",
}


def test_private_forms(spark):
    rows = [(v, f"see {v}, please") for v in PRIVATE] + [(v, v) for v in ("1700000000", "0123456789", "30/2/1985", "32/12/1985", "12/32/1985", "1.2.3.4.5", "00312470", "123 45-6789", "2111234567", "2915551234")]
    got = {r.v: r.text for r in pii_feistel.pseudonymised(spark.createDataFrame(rows, "v string, text string"), "k").collect()}
    for v in PRIVATE:
        new = got[v].removeprefix("see ").removesuffix(", please")
        # in form alike, but for dates, whose numbers keep no leading zero
        assert new != v and (re.sub(r"[0-9]+" if PRIVATE[v] == "date" else "[0-9]", "9", new) == re.sub(r"[0-9]+" if PRIVATE[v] == "date" else "[0-9]", "9", v)), (v, new)
    assert all(got[v] == v for v, t in rows if t == v)
    linked = {"4539 1488 0343 6467": "4539.1488.0343.6467", "+49 30 1234567": "0049 30 1234567", "DE89370400440532013000": "de89370400440532013000", "123-45-6789": "123 45 6789", "(743) 555-3824": "7435553824", "1985-12-31": "12/31/1985"}
    new = {r.v: re.sub("[^0-9]", "", r.text) for r in pii_feistel.pseudonymised(spark.createDataFrame([(v, v) for v in linked], "v string, text string"), "k").collect()}
    for a, b in linked.items():
        other = re.sub("[^0-9]", "", got[b])
        assert sorted(new[a]) == sorted(other) if "/" in b else new[a] == other.removeprefix("00" if b.startswith("00") else ""), (a, b)


@pytest.mark.parametrize("text", ["x@" + "b." * 1_000_000 + "com", "a" * 2_000_000, "1234567890" * 200_000, "." * 2_000_000, "\n" * 2_000_000, "," * 2_000_000, "([{" * 600_000, "a@" * 1_000_000, "(0" * 1_000_000, "de12 " * 400_000, "+1" * 1_000_000, "12/" * 600_000], ids=lambda t: repr(t[:5]))
def test_private_forms_in_long_texts(spark, text):
    new = pii_feistel.pseudonymised(spark.createDataFrame([(text,)], "text string"), "k").first().text
    assert len(new) == len(text)
