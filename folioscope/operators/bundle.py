"""All metrics of one labelling against another, by any groups, with sampling weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.compare import COSTS
from folioscope.params import CATEGORIES

LOST = ("Trash", "Non-text")


def checked_weights(rows: DataFrame, weight: str, gold: str = "gold") -> DataFrame:
    """``rows`` with ``weight`` as a number. A weight of a labelled row that is no number or negative, and weights that sum to 0, are errors: one
    that is silently dropped changes what is measured."""
    number = F.expr(f"try_cast(`{weight}` as double)")
    w = rows.where(F.col(gold).isNotNull()).agg(F.count_if(number.isNull() | F.isnan(number)).alias("bad"), F.count_if(number < 0).alias("negative"), F.sum(number).alias("sum")).first()
    if w.bad:
        raise ValueError(f"{weight} has {w.bad} values that are no numbers on labelled rows")
    if w.negative:
        raise ValueError(f"{weight} has {w.negative} negative values")
    if not (w["sum"] or 0) > 0:
        raise ValueError(f"{weight} sums to zero over the labelled rows")
    return rows.withColumn(weight, number)


def metric_bundle(rows: DataFrame, *by: str, gold: str = "gold", pred: str = "pred", weight: str | None = None) -> DataFrame:
    """One row a group, over its labelled rows: line_count and flip_count (rows), and, weighted where ``weight`` is given, flip_rate, the rates of the
    predicted categories, macro_f1 and weighted_f1 (by support), kl_divergence of the predicted from the labels' distribution, costed_score (mean cost
    of flips), and gold_clear_loss (rows labelled Clear that became Trash or Non-text).

    F1 averages over the labels of either side; one never hit counts 0. A null prediction is a category of its own that no label is. Groups without a
    labelled row have none. Group columns may be null.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cells = rows.where(F.col(gold).isNotNull()).select(F.struct(*by, F.lit(0).alias("_")).alias("g"), F.col(gold).alias("a"), F.col(pred).alias("b"), w.alias("w"))
    cells = cells.groupBy("g", "a", "b").agg(F.count("*").alias("n"), F.sum("w").alias("w"))  # at most 36 rows a group from here
    same = F.col("a").eqNullSafe(F.col("b"))
    cost = F.lit(1.0)
    for (x, y), c in COSTS.items():
        cost = F.when((F.col("a") == x) & (F.col("b") == y), c).otherwise(cost)
    mass = F.nullif(F.sum("w"), F.lit(0.0))
    rate = lambda t: F.coalesce(F.sum(F.when(t, F.col("w")).otherwise(0.0)) / mass, F.lit(0.0))
    plain = cells.groupBy("g").agg(
        F.sum("n").alias("line_count"), F.sum(F.when(~same, F.col("n")).otherwise(0)).alias("flip_count"), rate(~same).alias("flip_rate"), *(rate(F.col("b") == k).alias(f"{k.lower()}_rate") for k in CATEGORIES),
        F.coalesce(F.sum(F.when(~same, cost * F.col("w")).otherwise(0.0)) / mass, F.lit(0.0)).alias("costed_score"), F.sum(F.when((F.col("a") == "Clear") & F.col("b").isin(*LOST), F.col("n")).otherwise(0)).alias("gold_clear_loss"),
    )
    sides = F.explode(F.array(F.struct(F.col("a").alias("label"), F.col("w").alias("p"), F.lit(0.0).alias("q"), F.when(same, F.col("w")).otherwise(0.0).alias("hit")), F.struct(F.col("b").alias("label"), F.lit(0.0).alias("p"), F.col("w").alias("q"), F.lit(0.0).alias("hit"))))
    labels = cells.select("g", sides.alias("s")).groupBy("g", "s.label").agg(F.sum("s.p").alias("p"), F.sum("s.q").alias("q"), F.sum("s.hit").alias("hit"))
    f1 = F.coalesce(2 * F.col("hit") / F.nullif(F.col("p") + F.col("q"), F.lit(0.0)), F.lit(0.0))
    total = labels.groupBy("g").agg(F.nullif(F.sum("p"), F.lit(0.0)).alias("t"))
    share = lambda c: F.col(c) / F.col("t") + 1e-12
    scores = labels.join(total, "g").groupBy("g").agg(F.avg(f1).alias("macro_f1"), F.coalesce(F.sum(f1 * F.col("p")) / F.first("t"), F.lit(0.0)).alias("weighted_f1"), F.coalesce(F.sum(share("p") * F.ln(share("p") / share("q"))), F.lit(0.0)).alias("kl_divergence"))
    out = plain.join(scores, "g")
    return out.select(*(F.col("g").getField(c).alias(c) for c in by), *(c for c in out.columns if c != "g"))
