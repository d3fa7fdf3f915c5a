"""Approximate distinct counts and quantiles as small columns that merge: of pages, to documents, to collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch of distinct values has 2 ** LG_K slots: a relative standard error of about 1.04 / sqrt(2 ** LG_K).
LG_K = 12
#: Items that a quantile sketch keeps at its lowest level: a rank error of about 1.3 % at 200.
KLL_K = 200


def sketched(rows: DataFrame, by: list[str], distinct: str, value: str, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """(by..., n, distinct_sketch, value_sketch): rows, and sketches of the different values of ``distinct`` and of the numbers of ``value``.
    Nulls are in neither; a group without a value has a null sketch of values."""
    number = F.col(value).cast("double")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.hll_sketch_agg(F.col(distinct), lg_k).alias("distinct_sketch"), F.call_function("kll_sketch_agg_double", number, F.lit(k)).alias("value_sketch"))


def merged(sketches: DataFrame, by: list[str], k: int = KLL_K) -> DataFrame:
    """The sketches of larger groups from those of smaller ones; the rows themselves are not read again."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.call_function("kll_merge_agg_double", F.col("value_sketch"), F.lit(k)).alias("value_sketch"))


def estimated(sketches: DataFrame, points: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Sketches read: n, distinct (about), and quantiles (about) as q05, q25 and so on; null without a value."""
    keep = [c for c in sketches.columns if c not in ("distinct_sketch", "value_sketch")]
    some = F.call_function("kll_sketch_get_n_double", F.col("value_sketch")) > 0
    at = lambda p: F.when(some, F.call_function("kll_sketch_get_quantile_double", F.col("value_sketch"), F.lit(p)))
    return sketches.select(*keep, F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *(at(p).alias(f"q{round(p * 100):02d}") for p in points))
