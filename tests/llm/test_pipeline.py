"""The corpus pipeline: every stage against plain Python, with nulls, repeats, extra columns of any name, empty tables."""

import collections

import numpy as np
import pytest

import corpus_pipeline
from folioscope.llm import packing
from tests.llm.test_operators import jp, shingles

TOXIC = ("vile", "awful", "nasty")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(400):
        w = [f"w{int(k)}" for k in rng.integers(0, 3000, 60)]
        if i % 4 == 0:
            for k in rng.choice(60, 6, False):
                w[k] = TOXIC[int(k) % 3]
        rows.append([i, " ".join(w), "ab"[i % 2]])
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [[1001, rows[1][1], "b"], [1002, rows[2][1] + " tail", "a"], [None, "a text of its own kind without an id at all", None], [3, "another text that repeats the id of three and no more", "a"]]
    rows += [[1003, None, "a"], [1004, "", "b"], [1005, "please call 743-555-3824 or write to ann@x.org about the matter of today", "c"], rows[5][:]]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1, "m", 2, 3, 4) for r in rows], "doc_id long, text string, source string, n_chars long, _size int, _matches string, node int, row int, k1 int")
    path = tmp_path_factory.mktemp("corpus")
    docs.write.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{path}/none/documents.parquet")
    for where in (path, path / "none"):
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    docs, kept = given, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == given.columns, name
        assert docs.select("_size", "_matches", "node", "row", "k1").distinct().collect() == [(1, "m", 2, 3, 4)] if docs.count() else True
        kept[name] = docs.collect()
    all_rows = given.collect()
    bad = lambda t: any(w in TOXIC for w in (t or "").split())
    assert [r for r in kept["toxicity"] if bad(r.text)] == [] and len(kept["toxicity"]) == sum(not bad(r.text) for r in all_rows)

    classes = []
    for r in sorted(kept["toxicity"], key=lambda r: (r.doc_id is None, r.doc_id)):
        mine = shingles(r.text)
        for c in classes:
            if any((jp(mine, s) >= 0.8 if mine and s else not mine and not s) for s in c[1]):
                c[1].append(mine)
                break
        else:
            classes.append((r, [mine]))
    key = lambda r: (r.doc_id or -1, r.text)
    assert sorted(map(key, kept["near_duplicates"]), key=str) == sorted((key(c[0]) for c in classes), key=str)

    before = {key(r): r for r in kept["near_duplicates"]}
    changed = [r for r in kept["pii"] if key(r) not in before]
    assert len(kept["pii"]) == len(before) and [r.doc_id for r in changed] == [1005] and "743-555-3824" not in changed[0].text and "ann@" not in changed[0].text
    assert all(r.n_chars == len(r.text or "") for r in kept["pii"] + kept["mixing"])

    words, taken = collections.Counter(), collections.Counter()
    for r in kept["pii"]:
        words[r.source] += len((r.text or "").split())
    for r in kept["mixing"]:
        taken[r.source] += len(r.text.split())
    total, weights = sum(words.values()), {s: k % 3 + 1 for k, s in enumerate(sorted(words, key=lambda s: (s is None, s)))}
    target, open_ = {}, dict(weights)
    while True:
        rest = total - sum(target.values())
        over = [s for s in open_ if rest * open_[s] / sum(open_.values()) > 3 * words[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * words[s]
            del open_[s]
    target |= {s: rest * w / sum(open_.values()) for s, w in open_.items()}
    assert {s: taken[s] for s in words} == {s: int(target[s] + 1e-6) for s in words}

    encoder = __import__("tokenizers").Tokenizer.from_file(packing.tokenizer_path())
    want = collections.Counter()
    for r in kept["mixing"]:
        want[r.doc_id, len(encoder.encode(r.text, add_special_tokens=False).ids) + 1] += 1
    pieces = corpus_pipeline.pack(spark, docs, folder).collect()
    got = collections.Counter()
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
    assert got == {k: k[1] * n for k, n in want.items()}


def test_whole_run(spark, folder):
    before = len(corpus_pipeline.WRITTEN)
    pieces = corpus_pipeline.run(spark, folder)
    assert len(corpus_pipeline.WRITTEN) - before == len(corpus_pipeline.STAGES)
    rows = pieces.collect()
    used = collections.defaultdict(list)
    for p in rows:
        used[p.sequence_id].append((p.offset, p.length))
    for spans in used.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(spans), sorted(spans)[1:], strict=False))
    assert sorted(map(str, rows)) == sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
