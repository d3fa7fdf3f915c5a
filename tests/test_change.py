"""Arms, labelled lines and pages, the page check, and the checks of records."""

from dataclasses import fields

import pytest

from folioscope.operators import change, record, scoring
from folioscope.params import DEFAULT

LINE = "file string, page_num int, line_num int, text string, lang string, lang_score double, perplex double"


def test_late_constants_leave_signals_alone(spark):
    lines = spark.createDataFrame([], LINE)
    plan = lambda p: scoring.with_signals(scoring.prefilter(lines, p), p)
    whole = plan(DEFAULT)
    for f in fields(DEFAULT):
        if f.name in change.LATE and f.name != "disabled":
            step = {"noisy_max": 0.9, "trash_max": 0.5, "vowel_low": 0.1}.get(f.name, getattr(DEFAULT, f.name) * 2)
            assert whole.sameSemantics(plan(DEFAULT.but(**{f.name: step}))), f.name
    assert not whole.sameSemantics(plan(DEFAULT.but(fused_vowels=5)))


def test_reach_is_each_arm_on_its_own(spark):
    texts = ["Pohled na zámek od jihu", "oueussd", "xx ## yy", "", "Tb. IV č. 12", "vyt1ačená zpráva o 2ámku", "IDIDID DUOID"]
    lines = spark.createDataFrame([(f"d{i % 2}", 1, i, t, "ces_Latn", 0.6 + i / 20, 100.0 * i) for i, t in enumerate(texts)], LINE)
    arms = {"base": DEFAULT, "strict": DEFAULT.but(trash_max=0.7), "floor": DEFAULT.but(witness_floor=True)}
    columns = ["file", "line_num", "categ", "rule", "quality_score"]
    got = change.reach(lines, arms).select("arm", *columns).collect()
    want = [(n, *r) for n, p in arms.items() for r in scoring.process(lines, p).select(*columns).collect()]
    assert sorted(map(tuple, got)) == sorted(want) and len({r[3] for r in want}) > 2
    assert {"base", "-rule_allcaps"} <= set(change.ablation()) and "rule_allcaps" in change.ablation()["-rule_allcaps"].disabled


def test_reach_reads_lines_once_for_the_witness(spark, monkeypatch):
    made = []
    signals = scoring.with_signals
    monkeypatch.setattr(change.scoring, "with_signals", lambda rows, p: made.append(p) or signals(rows, p))
    lines = spark.createDataFrame([("d", 1, 1, "oueussd", "ces_Latn", 0.9, 50.0)], LINE)
    arms = {"base": DEFAULT, "floor": DEFAULT.but(witness_floor=True), "both": DEFAULT.but(witness=True, trash_max=0.7), "other": DEFAULT.but(fused_vowels=4)}
    rows = change.reach(lines, arms).select("arm", "shape_clauses").collect()
    assert len(made) == 2 and {r.arm: r.shape_clauses is not None for r in rows} == {"base": False, "floor": True, "both": True, "other": False}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [("d", p, i, g, r, a, s) for p, i, g, r, a, s in [
        (1, 1, "Clear", "Noisy", "Clear", "x"), (1, 2, "Clear", "Clear", "Clear", "x"), (1, 3, "Trash", "Trash", "Noisy", "y"), (1, 4, None, "Clear", "Trash", "y"),
        (2, 1, "Clear", "Clear", "Noisy", "x"), (2, 2, None, "Clear", "Clear", "x")]]
    return spark.createDataFrame(rows, "file string, page_num int, line_num int, gold string, ref string, arm string, source string")


def test_labelled_lines_and_pages(labelled):
    got = {r.source: tuple(r)[1:] for r in change.line_results(labelled, "source").collect()}
    assert got == {"x": (3, 1, 1, 0), "y": (1, 0, 1, 0)}
    e = change.page_errors(labelled, pred="arm").first()
    assert (e.pages, e.band_pages, e.band_agree, e.clear_abs, round(e.trash_abs, 6), e.trash_share_mae) == (1, 1, 1, 0.0, 0.333333, 0.3333)
    assert change.page_errors(labelled, pred="arm", coverage=0.8).first().pages == 0
    assert change.page_errors(labelled, pred="arm", least=1).first().pages == 2 and change.page_errors(labelled.limit(0)
        .withColumnRenamed("arm", "categ")).first().clear_share_mae is None


def test_page_check(spark):
    results = lambda *rows: spark.createDataFrame(rows, "arm string, source string, fixed long, broken long, clear_loss long")
    errors = spark.createDataFrame([("r", 9, 9, 8, 1.0, 1.0), ("good", 9, 9, 8, 0.9, 1.0), ("bad", 9, 9, 7, 1.2, 1.0), ("old", 9, 9, 8, 1.0, 1.0)], "arm string, pages long, band_pages long, band_agree long, clear_abs double, trash_abs double")
    moves = spark.createDataFrame([("good", 1000, 5, 0), ("bad", 1000, 1, 9), ("old", 1000, 50, 50)], "arm string, pages long, band_flips long, moved long")
    rows = [("good", "s", 5, 2, 0), ("bad", "s", 2, 2, 1), ("bad", "t", 0, 1, -1), ("old", "s", 0, 3, 1)]
    got = {r.arm: r for r in change.page_check(results(*rows), errors, moves, "r", "old").collect()}
    assert (got["good"].holds, got["good"].reasons, got["good"].verdict) == (True, [], "HOLD")
    assert got["bad"].reasons == ["net broken on t", "Clear lost on s", "labelled lines not improved", "pages worse in band agreement", "pages worse in Clear share", "immaterial"]
    assert (got["old"].role, got["old"].holds) == ("revert", False)
    assert {r.verdict for r in change.page_check(results(*rows), errors, moves, "r", "old", ("good",)).collect()} == {"GO"}
    assert {r.verdict for r in change.page_check(results(*rows[:3], ("old", "s", 4, 3, -1)), errors, moves, "r", "old").collect()} == {"REVERT"}


def test_record_checks(spark):
    docs = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], "file string, page_count int")
    lines = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, None), ("a", 2, 1, "y"), ("c", 2, 1, "z")], "file string, page_num int, line_num int, text string")
    assert sorted(map(tuple, record.page_rows(docs, lines).collect())) == [("a", 1, "text", 2), ("a", 2, "text", 1), ("a", 3, "empty", 0), ("c", 1, "empty", 0)]
    assert [r.file for r in record.foreign_pages(lines, docs).collect()] == ["c"]
    assert {(r.file, r.page_num): r.content for r in record.page_texts(lines).collect()} == {("a", 1): "x\n", ("a", 2): "y", ("c", 2): "z"}
    refs = spark.createDataFrame([("a", 1, 1, 0), ("a", 1, 3, 1), ("a", None, 1, 2), ("a", 9, None, 3), ("z", 1, 1, 4)], "file string, page_num int, line_num int, k int")
    assert sorted(r.k for r in record.key_problems(refs, lines).collect()) == [1, 2]
    size = "file string, page_num int, width double, height double, unit string"
    one = spark.createDataFrame([("a", 1, 600.0, 800.0, "pt"), ("a", 2, 600.0, 800.0, "pt"), ("a", 3, 600.0, 800.0, "pt"), ("a", 4, 0.0, 1.0, "pt")], size)
    two = spark.createDataFrame([("a", 1, 605.0, 808.0, "pt"), ("a", 2, 607.0, 800.0, "pt"), ("a", 3, 600.0, 800.0, "px"), ("a", 4, 1.0, 1.0, "pt"), ("b", 1, 1.0, 1.0, "pt")], size)
    assert sorted((r.page_num, r.differs) for r in record.geometry_problems(one, two).collect()) == [(2, "width"), (3, "unit")]
    names = spark.createDataFrame([(" OCR:x", ["Kraken 4"]), ("docx", ["My OCR-D", "ABBYY FineReader"]), ("what", [None, "superkraken"]), (None, None)], "o string, n array<string>")
    from pyspark.sql import functions as F

    got = [tuple(r) for r in names.select(record.record_origin(F.col("o")), record.producer_origin(F.col("n")), record.line_source(record.record_origin(F.col("o")))).collect()]
    assert got == [("atr", "ocr:kraken", "atr"), ("digital", "ABBYY-ALTO", "text-layer"), (None, None, None), (None, None, None)]
