"""Does a score keep an order within groups: pairs of rows counted by ranks, not made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.ordered import running

SLACK = 1e-9


def concordance(rows: DataFrame, group: list[str], severity: str, score: str, levels: list, slack: float = SLACK) -> DataFrame:
    """(group..., pairs, concordant): of the pairs of a group's rows whose severities differ, those in which the lighter row scores at least as high as
    the heavier one, less ``slack``.

    ``levels`` are the severities, from light to heavy; rows of another one, or without a score, do not count. Equal rows count each;
    null is a group like any other; a group with rows of one severity has no pairs. Equal (group, severity, score) are counted first; each such
    number stands in one order of all groups twice, as a lighter row at its score and as a heavier one at its score less the slack, and
    running sums by level over ranges of that order give what scores as high. So one group of very many rows is many tasks.
    """
    level = F.coalesce(*(F.when(F.col(severity) == v, F.lit(i)) for i, v in enumerate(levels)), F.lit(None).cast("int"))
    n = rows.select(F.struct(*(F.col(c) for c in group)).alias("g"), level.alias("s"), F.col(score).cast("double").alias("x"))
    n = n.where("s is not null and x is not null and not isnan(x)").groupBy("g", "s", "x").agg(F.count("*").alias("n"))
    events = n.select("g", "s", "n", F.explode(F.array(F.struct(F.col("x").alias("at"), F.lit(0).alias("heavy")), F.struct((F.col("x") - slack).alias("at"), F.lit(1).alias("heavy")))).alias("e")).select("g", "s", "n", "e.*")
    at = range(len(levels))
    light = {f"c{i}": F.when((F.col("heavy") == 0) & (F.col("s") == i), F.col("n")).otherwise(0) for i in at}
    sums = running(events, [F.col("g"), -F.col("at"), F.col("heavy"), F.col("s")], **light)
    below = sum((F.when(F.col("s") > i, F.col(f"c{i}") * F.col("n")).otherwise(0) for i in at), F.lit(0))
    heavy = F.col("heavy") == 1
    per = sums.groupBy("g").agg(
        F.sum(F.when(heavy, below).otherwise(0)).alias("all"),
        *(F.sum(F.when(heavy & (F.col("s") > i), F.col("n")).otherwise(0)).alias(f"n{i}") for i in at),  # rows heavier than i
        *(F.min(F.col(f"c{i}") - light[f"c{i}"]).alias(f"b{i}") for i in at),  # rows of level i in the groups before
        *(F.sum(light[f"c{i}"]).alias(f"m{i}") for i in at),
    )
    pairs = sum((F.col(f"m{i}") * F.col(f"n{i}") for i in at), F.lit(0))
    ahead = sum((F.col(f"b{i}") * F.col(f"n{i}") for i in at), F.lit(0))
    return per.select(*(F.col("g").getField(c).alias(c) for c in group), pairs.cast("long").alias("pairs"), (F.col("all") - ahead).cast("long").alias("concordant"))


def monotonicity(per_group: DataFrame) -> DataFrame:
    """One row: pairs, concordant, and accuracy to four places, 1 where there is no pair."""
    sums = per_group.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("concordant"), F.lit(0)).alias("concordant"))
    return sums.withColumn("accuracy", F.coalesce(F.round(F.try_divide(F.col("concordant").cast("double"), F.col("pairs")), 4), F.lit(1.0)))
