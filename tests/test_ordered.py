"""Running sums over ranges, bounded samples and family counts against plain Python."""

import random

from pyspark.sql import functions as F

from folioscope.operators import compare, lexicon, sampling
from folioscope.operators.ordered import running


def test_running_sums(spark):
    r = random.Random(3)
    rows = [(r.randrange(40), i, r.choice([None, 1, 5]), f"x{i}") for i in range(500)] + [(None, 1, 7, "x")]
    df = spark.createDataFrame(rows, "a int, b int, range long, sum string")  # names that the operator uses itself
    got = {(g.a, g.b): (g.n, g.n_all, g.v, g["sum"]) for g in running(df, [F.col("a"), -F.col("b")], n=F.lit(1), v=F.col("range")).collect()}
    n = v = 0
    for a, b, x, s in sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, -t[1])):
        n, v = n + 1, v + (x or 0)
        assert got[a, b] == (n, len(rows), v, s)
    assert running(df.limit(0), [F.col("a")], n=F.lit(1)).count() == 0


def test_average_ranks(spark):
    df = spark.createDataFrame([(x,) for x in (3.0, 1.0, 3.0, 3.0, 9.0, None)], "x double")
    assert {r.value: r.rank for r in compare.average_ranks(df, "x").collect()} == {1.0: 1.0, 3.0: 3.0, 9.0: 5.0}


def test_stratified_keeps_columns_and_totals(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else None, i * 2, "t") for i in range(90)], "id int, s string, n int, take string")
    got = sampling.stratified(df, "s", "id", 10)
    assert got.columns == df.columns and got.count() == 10 and got.where("s is null").count() == 3
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, sampling.stratified(df, "s", "id", 10).collect()), key=str)


def test_families(spark):
    rows = spark.createDataFrame([("Ab c", "Clear"), ("abc", "Clear"), ("abc", "Trash"), ("A.B.C", "Noisy"), ("abc", "Clear"), ("..", "Trash"), (None, "Empty")], "text string, categ string")
    assert [tuple(r) for r in lexicon.families(rows).collect()] == [("abc", 5, 3, "Clear:3|Noisy:1|Trash:1")]
