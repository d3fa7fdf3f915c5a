"""Effects read off the masks against scoring again with rules disabled, and elimination against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscope.operators import rule_effects as e, scoring
from folioscope.params import DEFAULT

LINES = [
    "Praha byla založena v 9. století a rozkvétala.", "", "12345", "xkcd qwrt zzzpl vvbn", "č.j. 123/45", "A B C D E F", "HRADCANY", "PRG XYZ TRK", "inv. č. 12", "oueussd nupoy uaaeei", "ab ab ab ab ab", "nuop uo pod ou", "#$%&@ §¤~ ^^ <<>> a",
    "Dobrý den, toto je věta s dvaceti slovy.", "kk kk k k k k k", "aaab bbbc cccd", "wqx xqw wqxx", "rozměry 12 x 30 cm", "Tb. 12 neg. 34", "u", "ve", "Nov4k z4 v0d0u", "mAlÁ VelKá slOvA", "..........", "a1b2 c3d4 e5f6", "Obsah", "kat. č. 5 .....",
]


def lines(spark):
    rng = random.Random(5)
    rows = []
    for k in range(12):
        for i, t in enumerate(LINES):
            words = t.split(" ")
            rng.shuffle(words)
            rows.append((f"d{k}", 1, i + 1, " ".join(words) if k else t, rng.choice(["ces_Latn", "slk_Latn", "xyz_Cyrl", None]), rng.choice([0.1, 0.3, 0.5, 0.8, 0.99]), rng.choice([5.0, 20.0, 40.0, 150.0, 500.0, 1500.0, 4000.0, 50000.0]), rng.choice(["Clear", "Noisy", "Trash", None])))
    return spark.createDataFrame(rows, "file string, page_num int, line_num int, text string, lang string, lang_score double, perplex double, gold string")


@pytest.mark.parametrize("p", [DEFAULT, DEFAULT.but(witness_floor=True)])
def test_masks_equal_scoring_again(spark, p):
    signals = scoring.with_score(scoring.with_signals(scoring.prefilter(lines(spark), p), p), p).checkpoint()
    entries = e.cascade(p)
    rules = e.names(entries)
    mask = " | ".join(f"if(coalesce({x.when}, false), {1 << i}L, 0L)" for i, x in enumerate(entries))
    rows = signals.select("file", "line_num", "gold", F.expr(mask).alias("mask")).checkpoint()
    arms = {"": ()} | {r: (r,) for r in rules} | {"two": ("rule_short_line", "rule_garbage_density")}
    wide = rows.select("file", "line_num", *(e.decided(F.col("mask").bitwiseAND(~0 ^ e.bits(entries, *off)), entries).alias(f"a{i}") for i, off in enumerate(arms.values()))).collect()
    by_rule = {}
    for i, off in enumerate(arms.values()):
        want = {(r.file, r.line_num): r.categ for r in scoring.categorised(signals, p.but(disabled=p.disabled | set(off))).select("file", "line_num", "categ").collect()}
        got = {(r.file, r.line_num): r[f"a{i}"] for r in wide}
        assert got == want, list(arms)[i]
        by_rule[list(arms)[i]] = want
    table = e.masks(signals, entries, "gold")
    assert table.agg(F.sum("n")).first()[0] == signals.count()
    gold = {(r.file, r.line_num): r.gold for r in rows.collect()}
    found = {r.rule: r for r in e.effects(table, entries, gated=("rule_extreme_ppl", "rule_fragment_tokens")).collect()}
    assert list(found) and set(found) == set(rules)
    for r in rules:
        base, arm = by_rule[""], by_rule[r]
        assert found[r].decisive == sum(base[k] != arm[k] for k in base)
        assert found[r].clear_loss == sum(base[k] == "Clear" and arm[k] in ("Trash", "Non-text") for k in base)
        assert found[r].gold_n == sum(g is not None for g in gold.values())
        assert found[r].gold_clear_loss == sum(gold[k] == "Clear" and arm[k] in ("Trash", "Non-text") for k in base)
        assert abs(found[r].gold_macro_f1_delta - (f1(gold, arm) - f1(gold, base))) < 1e-8
    kinds = {r["class"] for r in found.values()}
    assert "LOAD-BEARING" in kinds and kinds <= {"LOAD-BEARING", "REDUNDANT-HERE", "DEAD", "INERT"}


def f1(gold, pred):
    keys = [k for k in gold if gold[k] is not None]
    labels = {gold[k] for k in keys} | {pred[k] for k in keys} - {None}
    out = []
    for x in labels:
        hits, n = sum(gold[k] == pred[k] == x for k in keys), sum(gold[k] == x for k in keys) + sum(pred[k] == x for k in keys)
        out.append(2 * hits / n)
    return sum(out) / len(out)


ENTRIES = [e.Entry(("rule_a",), "a", "Trash"), e.Entry(("rule_b", "rule_x"), "b", "Clear"), e.Entry(("rule_b",), "c", "Noisy"), e.Entry(("rule_c",), "d", "Trash"), e.Entry(("rule_d",), "a and d", "Clear"), e.Entry(("rule_e",), "b and c", "Noisy"), e.Entry(("default",), "true", "Clear")]


@pytest.mark.parametrize("seed", range(3))
def test_elimination_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [tuple(rng.random() < 0.4 for _ in range(4)) + (rng.choice(["Clear", "Clear", "Noisy", "Trash", None]),) for _ in range(200)]
    table = e.masks(spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean, gold string"), ENTRIES, "gold")
    tests = (lambda a, b, c, d: a, lambda a, b, c, d: b, lambda a, b, c, d: c, lambda a, b, c, d: d, lambda a, b, c, d: a and d, lambda a, b, c, d: b and c, lambda *_: True)

    def measure(off):
        pred = [next(x.categ for x, t in zip(ENTRIES, tests) if not set(x.owners) & off and t(*r[:4])) for r in rows]
        gold = [r[4] for r in rows]
        known = [i for i, g in enumerate(gold) if g]
        return sum(pred[i] != gold[i] for i in known), sum(gold[i] == "Clear" and pred[i] == "Trash" for i in known), f1(dict(enumerate(gold)), dict(enumerate(pred)))

    for tolerance in (0.0, 0.05):
        left, off, want, step = e.names(ENTRIES), set(), [], 0
        while left:
            _, lost, score = measure(off)
            tried = sorted((max(0, m[1] - lost), round(score - m[2], 9), m[0], r) for r in left for m in [measure(off | {r})])
            if tried[0][0] > 0 or tried[0][1] > tolerance + 1e-9:
                want += [(None, r, f, c, d) for c, d, f, r in tried]
                break
            step += 1
            c, d, f, r = tried[0]
            want.append((step, r, f, c, d))
            left.remove(r)
            off.add(r)
        got = [(r.step, r.rule, r.flips, r.clear_loss, round(r.macro_drop, 9)) for r in e.eliminate(table, ENTRIES, tolerance=tolerance).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(got, key=key) == sorted(want, key=key)


def test_edges(spark):
    empty = spark.createDataFrame([], "a boolean, b boolean, c boolean, d boolean, gold string")
    table = e.masks(empty, ENTRIES, "gold")
    assert e.effects(table, ENTRIES).count() == 0
    assert {(r.step, r.flips) for r in e.eliminate(table, ENTRIES).collect()} == {(None, 0)}
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, empty.schema)
    assert [tuple(r) for r in e.masks(nulls, ENTRIES, "gold").collect()] == [(64, None, 3)]
    with pytest.raises(ValueError):
        e.masks(empty, ENTRIES * 10, "gold")
