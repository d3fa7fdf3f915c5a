"""Metrics with weights and what is left of damaged words, against plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.operators import bundle, compare, recover


@pytest.mark.parametrize("weight", [None, "w"])
def test_bundle(spark, weight):
    rng = random.Random(4)
    kinds = ["Clear", "Noisy", "Trash", "Non-text", "Empty"]
    rows = [(rng.choice(["a", "b", None]), rng.choice([*kinds[:3], None]), rng.choice(kinds), rng.choice(["1.5", "2", "0.25"])) for _ in range(300)]
    df = bundle.checked_weights(spark.createDataFrame(rows, "g string, gold string, pred string, w string"), "w")
    got = {r.g: r for r in bundle.metric_bundle(df, "g", weight=weight).collect()}
    groups = defaultdict(list)
    for g, a, b, w in rows:
        if a:
            groups[g].append((a, b, float(w) if weight else 1.0))
    assert set(got) == set(groups)
    for g, m in groups.items():
        r, mass = got[g], sum(w for *_, w in m)
        near = lambda x, y: abs(x - y) < 1e-9
        assert r.line_count == len(m) and r.flip_count == sum(a != b for a, b, _ in m) and near(r.flip_rate, sum(w for a, b, w in m if a != b) / mass)
        assert near(r.clear_rate, sum(w for _, b, w in m if b == "Clear") / mass) and near(r["non-text_rate"], sum(w for _, b, w in m if b == "Non-text") / mass)
        assert near(r.costed_score, sum(w * compare.COSTS.get((a, b), 1.0) for a, b, w in m if a != b) / mass)
        p, q, hit = Counter(), Counter(), Counter()
        for a, b, w in m:
            p[a] += w
            q[b] += w
            hit[a] += w * (a == b)
        labels = set(p) | set(q)
        f = {x: 2 * hit[x] / (p[x] + q[x]) for x in labels}
        assert near(r.macro_f1, sum(f.values()) / len(f)) and near(r.weighted_f1, sum(f[x] * p[x] for x in labels) / mass)
        assert near(r.kl_divergence, sum((p[x] / mass + 1e-12) * math.log((p[x] / mass + 1e-12) / (q[x] / mass + 1e-12)) for x in labels))
        assert r.gold_clear_loss == sum(a == "Clear" and b in ("Trash", "Non-text") for a, b, _ in m)
    assert bundle.metric_bundle(df.limit(0), "g").count() == 0


@pytest.mark.parametrize("bad", ["x", None, "-1", "0", "NaN"])
def test_weights_are_checked(spark, bad):
    df = spark.createDataFrame([("Clear", bad), (None, "y")], "gold string, w string")
    with pytest.raises(ValueError):
        bundle.checked_weights(df, "w")


def fold(t):
    return t.translate(str.maketrans("áéíóúýčďěňřšťůž", "aeiouycdenrstuz"))


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_recoverability(spark):
    table = {"okraje": 50, "objekt": 378, "základní": 40, "fragment": 30, "město": 12, "krátké": 9, "oobjekt": 3, "misto": 11}
    words = ["okraje", "okraie", "okrajé", "zakladni", "fraament", "fragrnent", "oobjekt", "mesto", "krátké", "oueussd", "abc", "ob", "objekty", "základní"]
    lex = spark.createDataFrame(list(table.items()), "token string, df long")
    strong = {t: n for t, n in table.items() if n >= 10}
    want, near = {}, defaultdict(dict)
    for t in {w for w in words if len(w) >= 4}:
        if t in strong:
            want[t] = "attested"
            continue
        for c in strong:
            swaps = {t[:i] + b + t[i + len(a) :] for a, b in recover.CONFUSIONS for i in range(len(t)) if t.startswith(a, i)}
            kind = "diacritics" if fold(c) == t and c != t else "confusion" if c in swaps or t[0] == t[1] and t[1:] == c else "edit1" if one_edit(t, c) else None
            if kind:
                near[t][c] = kind
        want[t] = "recoverable" if near[t] else "unattested"
    tokens = spark.createDataFrame([(w,) for w in words + [None]], "token string")
    status, found = recover.judged(tokens, lex)
    assert {r.token: r.status for r in status.collect()} == want
    got = defaultdict(dict)
    for r in found.collect():
        got[r.token][r.candidate] = r.mechanism
    assert dict(got) == {t: c for t, c in near.items() if c}
    lines = spark.createDataFrame([(1, w) for w in ("okraje", "okraie", "oueussd", "oueussd", "abc")] + [(2, "abc"), (3, "oueussd")], "line int, token string")
    assert {r.line: (r.tokens, r.attested, r.recoverable, r.score) for r in recover.recoverability(lines, lex, ["line"]).collect()} == {1: (4, 1, 1, 0.5), 3: (1, 0, 0, 0.0)}
    first = {r.token: r.candidate for r in recover.nearest_attested(found, 1).collect()}
    assert first["mesto"] == "město" and first["oobjekt"] == "objekt"
    report = {r.status: (r.tokens, r.kinds) for r in recover.status_report(lines.withColumn("c", F.lit("Noisy")), lex, "c").collect()}
    assert report["unattested"] == (3, 1)
