"""URL filter, ranked search and centroid clustering against plain Python, with their edge cases."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from folioscope.llm import centroids, ranked_search, url_filter

DATA = Path("/root/testdata/sf0.001")


# --- URL filter


def host_path(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    return host, re.match(r"[^?#]*", rest[len(raw) :])[0], host + rest[len(raw) :]


def fitting(host, path, rules=url_filter.RULES):
    fits = [(v, r) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=lambda x: len(x[1]), default=(None, None))


class Markov:
    """The two models, by dictionaries of every order."""

    def __init__(self, ruled):
        self.n = [Counter(), Counter()]
        for judged, verdict in ruled:
            for g in self.windows(judged):
                for k in range(1, url_filter.ORDER + 1):
                    self.n[verdict == "block"][g[-k:]] += 1
        self.total, self.kinds = [Counter(), Counter()], [Counter(), Counter()]
        for c in (0, 1):
            for g, n in self.n[c].items():
                self.total[c][g[:-1], len(g)] += n
                self.kinds[c][g[:-1], len(g)] += 1

    @staticmethod
    def windows(judged):
        t = "\x02" * (url_filter.ORDER - 1) + judged + "\x03"
        return [t[i : i + url_filter.ORDER] for i in range(len(judged) + 1)]

    def p(self, c, g):
        if not g:
            return 1 / url_filter.ALPHABET
        n, t, rest = self.total[c][g[:-1], len(g)], self.kinds[c][g[:-1], len(g)], self.p(c, g[1:])
        return rest if not n else (self.n[c][g] + t * rest) / (n + t)

    def value(self, judged):
        w = self.windows(judged)
        return sum(round(math.log(self.p(0, g) / self.p(1, g)) * 1e9) for g in w) / len(w) / 1e9


def twin(spark, urls, rules=url_filter.RULES):
    folds = {r.judged: r.fold for r in url_filter.urls_of(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()}
    at = [(*host_path(u), *fitting(*host_path(u)[:2], rules)) for u in urls]
    model = Markov([(j, v) for _, _, j, v, _ in at if v and folds[j]])
    value = {j: model.value(j) for j in folds}
    bins = Counter((max(-2000, min(2000, int(math.copysign(math.floor(abs(value[j]) * 100 + 0.5), value[j])))), v) for _, _, j, v, _ in at if v and not folds[j])
    slope, offset = url_filter.curve(sorted((b, v, n) for (b, v), n in bins.items()))
    score = {j: 1 / (1 + math.exp(-(slope * value[j] + offset))) for j in folds}
    return [(h, p, r, v or ("allow" if score[j] >= 0.5 else "block"), score[j]) for h, p, j, v, r in at]


def same_verdicts(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and abs(g[4] - w[4]) < 1e-6 and (g[3] == w[3] or abs(w[4] - 0.5) < 1e-6), (g, w)


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_url_query_by_brute_force(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {r.page_id: tuple(r)[1:] for r in url_filter.op11_url_filter(spark, str(DATA)).collect()}
    ids = sorted(pages)
    same_verdicts([got[i] for i in ids], twin(spark, [pages[i] for i in ids]))


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "http://org/", "http://org", "http://xorg/", "http://a.example.org/ES/1", "x://b.example.org/en/12", "http://b.com/fr/?a://c", "http://b.com?x/fr/", "ftp://é😀.net/𝒳/ü",
            "http://b.com/fr/1", "http://b.com/fr/1", "http://b.com/de/2", "http://shop.com/de/7", "http://a.b/c\nd/e", "https://" + "a." * 40_000 + "net/" + "z/" * 40_000]
    rows = [(i, u, 1, "r") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, k1 int, row string")
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict, r.score) for r in url_filter.judge(pages).collect()}
    same_verdicts([got[i] for i in range(len(urls))], twin(spark, urls))
    assert got[4][:4] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[6][2] is None and got[8][2] == "org/" and got[9][3] == "block" and got[11][1] == ""
    kept = url_filter.keep_allowed(pages)
    assert kept.columns == pages.columns and {r.page_id for r in kept.collect()} == {i for i in got if got[i][3] == "allow"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_models_know_classes(spark):
    """Hosts that the rules do not name follow the ruled hosts that they resemble."""
    good, bad = [f"http://library{i}.com/fr/article-{i}" for i in range(150)], [f"http://cheap-pills{i}.com/de/win-{i}" for i in range(150)]
    new = [(f"http://library{i}.net/article-{i}", "allow") for i in range(150, 170)] + [(f"http://cheap-pills{i}.net/win-{i}", "block") for i in range(150, 170)]
    pages = spark.createDataFrame([(u,) for u in good + bad + [u for u, _ in new]], "url string")
    got = {r.row.url: r.verdict for r in url_filter.judge(pages).collect()}
    assert sum(got[u] == v for u, v in new) == len(new)


def test_url_one_class_only(spark):
    pages = spark.createDataFrame([("http://a.org/x",), ("http://b.net/x",)], "url string")
    assert {r.verdict for r in url_filter.judge(pages).collect()} <= {"allow", "block"}


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(t or "")]


def ranking(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    total = [sum(b.values()) for _, b in bags]
    n_docs, length = sum(n > 0 for n in total), sum(total)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, t in dict.fromkeys(items):
        query, found = Counter(terms(t)), []
        for (i, b), n in zip(bags, total):
            m = 75 + (25 * n * n_docs) // max(length, 1)
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 12 * m)) for w, c in query.items() if w in b)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    topics = [[f"w{t}x{i}" for i in range(60)] + ["The", "of", "AND"] for t in range(6)]
    docs = [(i, " ".join(rng.choice(topics[i % 6], 40))) for i in range(500)]
    docs += [(500 + i, docs[3][1]) for i in range(200)] + [(None, docs[3][1]), (None, "the w1x1"), (701, None), (702, ""), (703, "?!"), (3, docs[3][1]), (704, "É é ß w1x1 " * 3000 + "W1X1_w1x2")]
    items = [(1, docs[3][1]), (2, "the OF and"), (3, None), (4, "..."), (5, "w1x1 w1x1 w1x1 É"), (5, "w2x2"), (6, "unknown"), (None, "w3x3-w4x4"), (1, docs[3][1]), (7, " ".join(topics[0]) * 50)]
    return docs, items


def test_search_by_brute_force(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(ranked_search, "WAVES", (1, 3))
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, terms string, block int")
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, q int")
    index = ranked_search.build(d)
    got = [tuple(r) for r in ranked_search.search(index, q).collect()]
    assert order(got) == order(ranking(docs, items))
    assert max(r.n for r in index.blocks("leaf", "ids").selectExpr("size(ids) as n").collect()) <= 64  # copies have blocks of their own
    batch = next(ranked_search.batches_of(q.where("item_id = 5")))
    _, seen = ranked_search.search_batch(index, batch, 1)
    assert 0 < seen["visited"] < seen["offered"]
    monkeypatch.setattr(ranked_search, "BATCH_TERMS", 20)
    assert order(tuple(r) for r in ranked_search.search(index, q).collect()) == order(got)
    assert ranked_search.search(index, q.limit(0)).count() == 0
    assert ranked_search.search(ranked_search.build(d.limit(0)), q).count() == 0


def test_bisection_gathers_topics():
    rng = np.random.default_rng(1)
    topic = np.arange(512) % 8
    tree = ranked_search.Tree([np.unique(rng.integers(0, 200, 40) + 1000 * t).astype(np.uint64) for t in topic], 3)
    rows = [np.unique(rng.integers(0, 200, 40) + 1000 * t).astype(np.uint64) for t in topic]
    leaf = tree.leaves(len(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows))
    pure = sum(Counter(leaf[topic == t]).most_common(1)[0][1] for t in range(8))
    assert pure > 0.9 * len(rows) and np.bincount(leaf, minlength=8).max() < 130
    assert ranked_search.Tree([]).leaves(2, np.zeros(0, int), np.zeros(0, np.uint64)).tolist() == [0, 0]


# --- centroid clustering


def lloyd(rows, k=8, rounds=10):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            v = [math.floor(1024 * float(np.float32(x))) for x in e]
            if max(map(abs, v)) < 1 << 27:
                kept.append((i, v))
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    c = [v for _, v in sorted(kept, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(c)), key=lambda j: (dist(v, c[j]), j))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        c = [[sum(x) // len(m) for x in zip(*m)] if (m := [v for (_, v), a in zip(kept, at) if a == j]) else c[j] for j in range(len(c))]
    out = [(i, near(v), dist(v, c[near(v)])) for i, v in kept]
    return [(i, a, d, sum(x for _, b, x in out if b == a), sum(x for *_, x in out), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for i, a, d in out]


def test_centroids_by_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 64) / 1024]) for i in range(120)]  # small integers: many ties
    rows += [(200 + i, rows[5][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[7][1]), (301, None), (302, []), (303, [0.5] * 63), (304, [None] + [0.1] * 63), (305, [float("nan")] + [0.1] * 63), (306, [float("inf")] * 64), (307, [2e5] * 64), (308, [131071.0, -131071.0] * 32), (309, [-0.0001] * 64)]
    df = spark.createDataFrame([(i, e, 1, "v") for i, e in rows], "vec_id long, embedding array<float>, cluster int, v string")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got = sorted((tuple(r) for r in centroids.summary(*centroids.cluster(df)).collect()), key=key)
    assert got == sorted(lloyd(rows), key=key)
    few = df.where("vec_id < 3")
    assert sorted(map(tuple, centroids.summary(*centroids.cluster(few)).collect())) == sorted(lloyd([r for r in rows if r[0] is not None and r[0] < 3]))
    assert centroids.summary(*centroids.cluster(df.limit(0))).count() == 0


def test_intervals_hold_and_screen():
    """Ties and near ties are computed exactly; vectors far from a border are not."""
    rng = np.random.default_rng(3)
    c = rng.integers(-(1 << 26), 1 << 26, (8, 64))
    x = np.r_[rng.integers(-(1 << 26), 1 << 26, (500, 64)), (c[:4] + c[4:]) // 2, c, c + 1]
    at, again = centroids.nearest(x.astype(np.int32), c)
    want = [min(range(8), key=lambda j: (sum((int(a) - int(b)) ** 2 for a, b in zip(v, c[j])), j)) for v in x]
    assert at.tolist() == want and 0 < again < 100
    same = np.repeat(c[:1], 8, 0)
    assert centroids.nearest(x.astype(np.int32), same)[0].tolist() == [0] * len(x)
