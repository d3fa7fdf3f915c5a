"""Packs and their labels, and pairs within groups, against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.operators import concordance as co, packs

CHANGE = "id string, collection string, doc string, text string, `from` string, `to` string"


def changes(seed, n=600):
    rng = random.Random(seed)
    texts = ["Obr. 1", "obr 1", "OBR-1", "...", "!!", None, "Nález č. 5", "nález č 5"] + [f"text {i}" for i in range(150)]
    return [(f"i{i}", rng.choice("AB"), f"d{rng.randrange(30)}", rng.choice(texts[:8] if rng.random() < 0.4 else texts), *rng.sample(["Clear", "Noisy", "Trash"], 2)) for i in range(n)]


def key(t):
    return re.sub(r"[\W]", "", (t or "").lower())


def test_top_groups(spark):
    rows = changes(1)
    excluded = {key("text 3"), key("text 4")}
    groups = defaultdict(list)
    for r in rows:
        if key(r[3]) not in excluded:
            groups[key(r[3])].append(r)
    want, done, total = [], 0, sum(map(len, groups.values()))
    for rank, k in enumerate(sorted(groups, key=lambda k: (-len(groups[k]), k))[:12], 1):
        g = groups[k]
        done += len(g)
        spelt = sorted(Counter(r[3] for r in g).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
        moves = sorted(Counter(f"{r[4]}->{r[5]}" for r in g).items(), key=lambda x: (-x[1], x[0]))
        want.append((rank, k, len(g), round(done / total, 3), spelt[0][0], len(spelt), " | ".join(t for t, _ in spelt[1:4] if t is not None), len({r[1:3] for r in g}), min(r[0] for r in g), "; ".join(f"{m} {n}" for m, n in moves)))
    df = spark.createDataFrame(rows, CHANGE)
    got = packs.top_groups(df, 12, spark.createDataFrame([(k,) for k in excluded], "key string")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == want
    assert packs.top_groups(df.limit(0), 5).count() == 0


def test_tail_sample(spark):
    df = spark.createDataFrame(changes(2), CHANGE)
    top = packs.top_groups(df, 5)
    tail = packs.tail_sample(df, top, 50, seed=3)
    again = packs.tail_sample(df.orderBy(F.rand(1)), top, 50, seed=3)
    got = [tuple(r) for r in tail.orderBy("position").collect()]
    assert got == [tuple(r) for r in again.orderBy("position").collect()] and [r[0] for r in got] == list(range(1, 51))
    population = df.where(~packs.family_key(F.coalesce("text", F.lit(""))).isin([r.key for r in top.collect()]))
    assert abs(got[0][6] - 50 / population.count()) < 1e-12
    assert packs.tail_sample(df, top, 10_000).count() == population.count() and packs.tail_sample(df.limit(0), top, 5).count() == 0


def test_labels_and_estimates(spark):
    rows = changes(3)
    arm, reference = rows[:500], rows[200:]
    top = [(key("Obr. 1"), "Clear"), ("", " "), (key("text 1"), "Trash"), (key("text 1"), None), (key("text 2"), None)]
    tail = [(r[0], random.Random(i).choice(["Clear", "Noisy", "Trash", ""])) for i, r in enumerate(rows[250:400])]
    df = lambda x, s: spark.createDataFrame(x, s)
    found = packs.labelled(df(arm, CHANGE), df(reference, CHANGE), df(top, "key string, label string"), df(tail, "id string, label string"))
    sheet = {}
    for k, v in top:
        sheet[k] = sheet.get(k) or (v or "").strip() or None
    ids, lines = {r[0] for r in reference if key(r[3]) not in sheet}, {i: t or None for i, t in tail}
    want = {}
    for r in arm:
        k = key(r[3])
        want[r[0]] = ("top", sheet[k]) if sheet.get(k) else ("excluded", None) if k in sheet else ("tail", lines.get(r[0])) if r[0] in ids else ("new", None)
    assert {r.id: (r.bucket, r.label) for r in found.collect()} == want
    by = {r.measure: r for r in packs.estimates(found).collect()}
    moves = {r[0]: r[4:] for r in arm}
    hit = lambda b: sum(want[i][0] == b and want[i][1] == m[1] != m[0] for i, m in moves.items())
    sampled = sum(b == "tail" and x is not None for b, x in want.values())
    population = sum(b == "tail" for b, _ in want.values())
    e = by["fixed"]
    assert (e.top, e.tail, e.sampled, e.population) == (hit("top"), hit("tail"), sampled, population) and abs(e.total - (hit("top") + hit("tail") / sampled * population)) < 1e-3
    loss = sum(x == "Clear" and moves[i][1] == "Trash" for i, (b, x) in want.items() if b == "top")
    assert by["clear_loss"].top == loss and set(by) == set(packs.MEASURES)
    bare = packs.estimates(found.limit(0)).collect()
    assert len(bare) == 7 and all(r.estimate is None and r.total == 0 for r in bare)


def test_estimates_are_unbiased(spark):
    """Over many seeds the estimate from groups and sample is that of labelling every line."""
    rows = changes(5, 400)
    truth = {r[0]: random.Random(r[0]).choice(["Clear", "Noisy", "Trash"]) for r in rows}
    df = spark.createDataFrame(rows, CHANGE).cache()
    top = packs.top_groups(df, 4)
    keys = {r.key for r in top.collect()}
    # a group's label holds for all its lines, so the truth of labelled groups is one value each
    truth = {r[0]: "Clear" if key(r[3]) in keys else truth[r[0]] for r in rows}
    whole = sum(truth[r[0]] == r[5] for r in rows)
    labels = spark.createDataFrame([(k, "Clear") for k in keys], "key string, label string")
    in_groups = sum(truth[r[0]] == r[5] for r in rows if key(r[3]) in keys)
    estimates = []
    for seed in range(20):
        sample = [r.id for r in packs.tail_sample(df, top, 60, seed).select("id").collect()]
        population = sum(key(r[3]) not in keys for r in rows)
        estimates.append(in_groups + sum(truth[i] == next(r[5] for r in rows if r[0] == i) for i in sample) / len(sample) * population)
    mean = sum(estimates) / len(estimates)
    spread = (sum((x - mean) ** 2 for x in estimates) / (len(estimates) - 1) / len(estimates)) ** 0.5
    assert abs(mean - whole) < 3.5 * spread + 1e-9
    tail = spark.createDataFrame([(i, truth[i]) for i in sample], "id string, label string")
    last = {r.measure: r.total for r in packs.estimates(packs.labelled(df, df, labels, tail)).collect()}
    assert abs(last["fixed"] - estimates[-1]) < 1e-3


def pairs(rows, levels):
    groups = defaultdict(list)
    for g, s, x in rows:
        if s in levels and x is not None and x == x:
            groups[g].append((levels.index(s), x))
    return {g: (sum(a < b for a, _ in m for b, _ in m), sum(a < b and x >= y - 1e-9 for a, x in m for b, y in m)) for g, m in groups.items()}


@pytest.mark.parametrize("seed", range(3))
def test_concordance_is_pairwise(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["none", "light", "heavy", "other", None]), rng.choice([None, float("nan"), *(rng.randrange(6) / 7 for _ in range(6)), rng.random(), 0.5 + 5e-10, 0.5])) for _ in range(300)]
    levels = ["none", "light", "heavy"]
    df = spark.createDataFrame(rows, "g string, sev string, x double")
    got = {r.g: (r.pairs, r.concordant) for r in co.concordance(df, ["g"], "sev", "x", levels).collect()}
    assert got == pairs(rows, levels)
    total = co.monotonicity(co.concordance(df, ["g"], "sev", "x", levels)).first()
    assert total.pairs == sum(p for p, _ in got.values()) and total.accuracy == round(total.concordant / total.pairs, 4)


def test_one_large_group(spark):
    """A million rows of one group, with many ties, in several tasks."""
    df = spark.range(1_000_000).selectExpr("'g' as g", "cast(id % 3 as int) as sev", "(id % 5000) / 5000D - (id % 3) / 10D as x")
    r = co.concordance(df, ["g"], "sev", "x", [0, 1, 2]).first()
    n = Counter()
    for i in range(15_000):  # the rows repeat after that many
        n[i % 3, (i % 5000) / 5000 - (i % 3) / 10] += 1
    import numpy as np

    want, share = 0, 1_000_000 / 15_000
    for a in range(3):
        for b in range(a + 1, 3):
            x, y = (np.sort(np.array([v for (s, v), c in n.items() if s == k for _ in range(c)])) for k in (a, b))
            want += int((len(x) - np.searchsorted(x, y - 1e-9, "left")).sum())
    assert abs(r.concordant / (want * share * share) - 1) < 1e-3 and r.pairs > 3.3e11
    assert co.monotonicity(co.concordance(df.limit(0), ["g"], "sev", "x", [0, 1])).first().accuracy == 1.0
