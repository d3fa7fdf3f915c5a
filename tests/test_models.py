"""Training data without leaks, a baseline that learns, and constants ranked by what they move."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscope.operators import importance as im, quality_model as qm, scoring
from folioscope.params import DEFAULT
from tests.test_rule_effects import lines as marked_lines


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    words = "Praha byla založena v devátém století na levém břehu řeky a rozkvétala dlouhá léta nález sonda vrstva objekt".split()
    rows = [(f"d{i % 40}", i // 200, i, " ".join(rng.choices(words, k=rng.randint(2, 14))), rng.choice(["Clear", "Clear", "Noisy", "Empty"]), 4, "ces_Latn", rng.choice([0.3, 0.9]), rng.choice([30.0, 200.0])) for i in range(900)]
    df = spark.createDataFrame(rows, "file string, page_num int, line_num int, text string, categ string, word_count int, lang string, lang_score double, perplex double")
    gold = spark.createDataFrame([("d3",), ("d4",), ("d3",)], "file string")
    return df, gold, qm.dataset(df, seed=1, each=2, gold=gold, bins=10, most=60)


def test_dataset_is_sound(training):
    df, gold, rows = training
    got = rows.collect()
    assert qm.shared_documents(rows).count() == 0
    assert {r.split for r in got if r.file in ("d3", "d4")} == {"test"} and {r.split for r in got} == {"train", "val", "test"}
    texts = Counter(" ".join(r.text.split()) for r in got)
    assert max(texts.values()) == 1
    bins = Counter(min(9, max(0, int(r.raw_score * 10))) for r in got if r.split == "train")
    assert max(bins.values()) <= 60 and not [r for r in got if r.source_categ == "Empty"]
    assert {r.provenance for r in got} == {"original", "corrupt"}
    frozen = {(r.file, r.page_num, r.line_num): r.perplex for r in df.collect()}
    assert all(r.perplex == frozen[r.file, r.page_num, r.line_num] for r in got)
    again = qm.dataset(df.repartition(5), seed=1, each=2, gold=gold, bins=10, most=60)
    key = lambda r: (r.file, r.page_num, r.line_num, r.provenance, r.number, r.split, r.text)
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))


def test_baseline_learns(training):
    *_, rows = training
    model, names = qm.train(rows, iterations=8)
    assert "perplex" not in names
    out = qm.predicted(model, names, rows)
    assert out.where("prediction < 0 or prediction > 1 or prediction is null").count() == 0 and "features" not in out.columns
    by = {r.split: r for r in qm.metrics(out).collect()}
    assert by["train"].r2 > 0.6 and by["test"].r2 > 0.3 and 0 <= by["val"].band_agreement <= 1


def test_settings(spark):
    signals = scoring.with_score(scoring.with_signals(scoring.prefilter(marked_lines(spark)))).checkpoint()
    settings = im.sampled(3, seed=4)
    assert settings == im.sampled(3, seed=4) and settings != im.sampled(3, seed=5) and all(im.SPACE[c][0] <= v <= im.SPACE[c][1] for s in settings for c, v in s.items())
    found = {r.trial: r for r in im.evaluated(signals, settings).collect()}
    for i, s in enumerate(settings):
        rows = scoring.categorised(signals, DEFAULT.but(**s)).select("gold", "categ").collect()
        known = [r for r in rows if r.gold]
        assert abs(found[i].accuracy - sum(r.gold == r.categ for r in known) / len(known)) < 1e-9
        assert abs(found[i].clear_rate - sum(r.categ == "Clear" for r in rows) / len(rows)) < 1e-9
        assert abs(found[i].trash_rate - sum(r.categ == "Trash" for r in rows) / len(rows)) < 1e-9


def test_forest_finds_what_matters(spark):
    names = ("a", "b", "c")
    points = im.sampled(60, names, seed=1, space={n: (0.0, 1.0) for n in names})
    trials = spark.createDataFrame([(i, p["a"], p["b"], p["c"], 3 * p["b"] + 0.2 * p["c"]) for i, p in enumerate(points)], "trial int, a double, b double, c double, macro_f1 double")
    got = {r.constant: r for r in im.forest_importance(trials, names, trees=20).collect()}
    assert got["b"].importance > 0.6 and got["b"].permutation > got["c"].permutation >= 0 and got["b"].r2 > 0.5
    assert got == {r.constant: r for r in im.forest_importance(trials.repartition(4), names, trees=20).collect()}
    flat = im.forest_importance(trials.withColumn("macro_f1", F.lit(1.0)), names, trees=5).collect()
    assert all(r.permutation == 0 for r in flat)


def test_consensus(spark):
    rows = [("r1", "a", 0.6), ("r1", "b", 0.3), ("r1", "c", 0.1), ("r2", "b", 0.5), ("r2", "a", 0.5), ("r3", "b", 1.0), ("r3", "a", 0.0)]
    got = {r.constant: tuple(r)[1:] for r in im.consensus(spark.createDataFrame(rows, "run string, constant string, importance double"), 1).collect()}
    assert got == {"a": (2, True, 1.33), "b": (1, False, 1.67), "c": (0, False, 999.0)}
