"""No text ends an executor or keeps it for ever: lines of a million characters of every kind go through the line queries."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import signals as s
from folioscope.operators import scoring

N = 1_000_000
KINDS = {
    "one word": "abcdefghij" * (N // 10),
    "capitals": "ABCDEFGHIJ" * (N // 10),
    "digits": "1234567890" * (N // 10),
    "dots": "." * N,
    "abbreviations": "a." * (N // 2),
    "capital abbreviations": "Ab." * (N // 3),
    "labels": "x@" + "b." * (N // 2) + "com",
    "blanks": "a" + " " * N + "b",
    "letters and blanks": "A " * (N // 2),
    "wide blanks": "a" + "  " * (N // 2) + "b",
    "commas": "," * N,
    "brackets": "([{" * (N // 3),
    "grid": "A/" * (N // 2),
    "versions": "1." * (N // 2),
    "times": "12:30 " * (N // 6),
}


@pytest.fixture(scope="module")
def long_lines(spark):
    rows = [(k, 1, 1, t, "ces_Latn", 0.9, 50.0) for k, t in KINDS.items()]
    return spark.createDataFrame(rows, "file string, page_num int, line_num int, text string, lang string, lang_score double, perplex double").repartition(8)


def test_cascade(long_lines):
    got = {r.file: r.categ for r in scoring.process(long_lines).select("file", "categ").collect()}
    assert set(got) == set(KINDS) and set(got.values()) <= {"Clear", "Noisy", "Trash", "Non-text", "Empty"}


def test_shapes(long_lines):
    pieces = long_lines.select("file", F.expr(f"size({s.shape_pieces('text')})").alias("n"))
    assert {r.file for r in pieces.collect()} == set(KINDS)
    assert scoring.shape_witness(long_lines).count() >= 0


def test_line_kinds(long_lines):
    rows = long_lines.select("file", F.expr(f"array_join({s.words('text')}, ' ')").alias("t"))
    kinds = {"measurement": s.measurement, "dated": s.dated, "contents": s.contents_entry, "heading": s.heading, "notation": s.notation, "structured": s.structured_shape}
    got = {r.file: r for r in rows.select("file", *(F.expr(f("t")).alias(k) for k, f in kinds.items())).collect()}
    assert got["labels"].notation and not got["one word"].notation and not got["blanks"].structured


def test_same_answers_as_before(spark):
    """The patterns that were unbounded, on short texts."""
    q = lambda x: "'" + x.replace("'", "\\'") + "'"
    ask = lambda f, *texts: [spark.sql(f"select {f(q(t))} as x").first().x for t in texts]
    assert ask(lambda t: s.rlike(t, s.URL), "see a.b@c.de", "see a@b", "http://x", "http:// x", "www.a.cz", "www.a.c", "e-mail: x") == [True, False, True, False, True, False, True]
    pieces = lambda t: f"transform({s.shape_pieces(t)}, x -> x.c)"
    assert ask(pieces, "ab - cd,, ef", "  x") == [["ab", "cd", "ef"], ["x"]]
