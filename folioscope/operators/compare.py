"""Comparing two sets of categories: pairing, transitions, labels, and metrics of agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators.ordered import running

KEY = ("file", "page_num", "line_num")
#: What it costs to move a label, from to; any other move costs 1.
COSTS = {
    ("Clear", "Trash"): 3.0, ("Clear", "Non-text"): 3.0, ("Clear", "Noisy"): 1.0, ("Noisy", "Trash"): 2.0, ("Noisy", "Non-text"): 2.0,
    ("Noisy", "Clear"): 0.5, ("Trash", "Clear"): 2.0, ("Trash", "Noisy"): 1.0, ("Non-text", "Clear"): 2.0, ("Empty", "Clear"): 2.0,
}
ORDINAL = {"Trash": 0, "Noisy": 1, "Clear": 2}


def with_occurrence(lines: DataFrame, *order: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Numbers repeats of a key, within the columns of ``by``, so that repeated rows pair one to one."""
    return lines.withColumn("occurrence", F.row_number().over(Window.partitionBy(*KEY, *by).orderBy(*order)))


def paired(base: DataFrame, arm: DataFrame, *order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Full outer pairing of two line tables by key and occurrence: base, arm (categories), text and the columns of ``keep`` of either. A key
    with a null meets none.

    Both tables are dealt by key once, as rows of one; repeats are numbered and pairs meet where the rows are then.
    """
    columns = dict.fromkeys(("text", *keep))
    side = lambda df, is_arm: df.select(*KEY, "categ", *dict.fromkeys((*columns, *order)), F.lit(is_arm).alias("_arm"))
    rows = with_occurrence(side(base, False).unionByName(side(arm, True)).repartition(*KEY), *order, by=("_arm",))
    alone = F.when(F.expr(" or ".join(f"{k} is null" for k in KEY)), F.col("_arm"))
    of = lambda is_arm, c: F.max(F.when(F.col("_arm") == is_arm, F.col(c)))  # of one row
    both = rows.groupBy(*KEY, "occurrence", alone.alias("_alone"))
    return both.agg(of(False, "categ").alias("base"), of(True, "categ").alias("arm"), *(F.coalesce(of(True, c), of(False, c)).alias(c) for c in columns)).drop("_alone")


def unpaired(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count_if(F.col("arm").isNull()).alias("only_base"), F.count_if(F.col("base").isNull()).alias("only_arm"), F.count_if(F.col("base") != F.col("arm")).alias("changed"), F.count("*").alias("rows"))


def transitions(pairs: DataFrame, *by: str) -> DataFrame:
    """Changed lines by from, to and the columns of ``by``, with their share of all changes."""
    n = pairs.where("base <> arm").groupBy(*by, "base", "arm").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def with_gold(lines: DataFrame, gold: DataFrame) -> DataFrame:
    """Left join of the first label of each key; a blank label is none."""
    first = gold.withColumn("_k", F.row_number().over(Window.partitionBy(*KEY).orderBy("gold_categ"))).where("_k = 1").drop("_k")
    return lines.join(first.where("trim(coalesce(gold_categ, '')) <> ''"), list(KEY), "left")


def confusion(rows: DataFrame, gold: str = "gold", pred: str = "pred", weight: str | None = None) -> DataFrame:
    return rows.groupBy(F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg((F.sum(weight) if weight else F.count("*")).alias("n"))


def per_class(table: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each label of a confusion table; 0 where undefined."""
    gold = table.groupBy(F.col("gold").alias("label")).agg(F.sum("n").alias("support"))
    pred = table.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    hit = table.where("gold = pred").select(F.col("gold").alias("label"), F.col("n").alias("hits"))
    rows = gold.join(pred, "label", "full_outer").join(hit, "label", "left").na.fill(0)
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    rows = rows.withColumns({"precision": share("hits", "predicted"), "recall": share("hits", "support")})
    return rows.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def averages(classes: DataFrame) -> DataFrame:
    return classes.agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"), (F.sum("hits") / F.sum("support")).alias("accuracy"))


def kl_divergence(table: DataFrame, eps: float = 1e-12) -> DataFrame:
    """Divergence of the predicted from the gold distribution of labels."""
    share = lambda c, name: table.groupBy(F.col(c).alias("label")).agg(F.sum("n").alias("_n")).select("label", (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias(name))
    both = share("gold", "p").join(share("pred", "q"), "label", "full_outer").na.fill(0.0)
    return both.agg(F.sum((F.col("p") + eps) * F.ln((F.col("p") + eps) / (F.col("q") + eps))).alias("kl"))


def costed_flips(table: DataFrame, costs=COSTS) -> DataFrame:
    cost = F.lit(1.0)
    for (a, b), c in costs.items():
        cost = F.when((F.col("gold") == a) & (F.col("pred") == b), c).otherwise(cost)
    cost = F.when(F.col("gold") == F.col("pred"), 0.0).otherwise(cost)
    return table.agg((F.sum(cost * F.col("n")) / F.sum("n")).alias("mean_cost"))


def kappa(table: DataFrame) -> DataFrame:
    """Cohen's kappa."""
    total = table.agg(F.sum("n").alias("t"), F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n"))).alias("same"))
    a = table.groupBy(F.col("gold").alias("l")).agg(F.sum("n").alias("a"))
    b = table.groupBy(F.col("pred").alias("l")).agg(F.sum("n").alias("b"))
    chance = a.join(b, "l").agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("c"))
    po, pe = F.col("same") / F.col("t"), F.col("c") / (F.col("t") * F.col("t"))
    return total.crossJoin(chance).select(((po - pe) / (1 - pe)).alias("kappa"))


def verdict(label, frm, to):
    """fixed, broken or neither: what a change does to a labelled line."""
    return F.when((label == to) & (label != frm), "fixed").when((label == frm) & (label != to), "broken").otherwise("neither")


def average_ranks(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, rank): rank with ties averaged, for each distinct value of each column that is not null. All columns are ordered in one
    pass, one after another."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns))))
    n = df.select(each.alias("x")).select("x.*").where("value is not null").groupBy("column", "value").agg(F.count("*").alias("_n"))
    sums = running(n, [F.col("column"), F.col("value")], _to=F.col("_n"), **{f"_c{i}": F.when(F.col("column") == i, F.col("_n")) for i in range(len(columns))})
    before = sum((F.when(F.col("column") > i, F.col(f"_c{i}_all")).otherwise(0) for i in range(len(columns))), F.lit(0))
    return sums.select("column", "value", (F.col("_to") - before - (F.col("_n") - 1) / 2.0).alias("rank"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation; ranks come from value counts, so only distinct values are ordered."""
    ranks = average_ranks(df, x, y)
    of = lambda i, c, name: ranks.where(F.col("column") == i).select(F.col("value").alias(c), F.col("rank").alias(name))
    pairs = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    return pairs.join(of(0, "_x", "_rx"), "_x").join(of(1, "_y", "_ry"), "_y").agg(F.corr("_rx", "_ry").alias("spearman"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve of a 0/1 label by rank sums over distinct scores."""
    n = df.groupBy(score).agg(F.sum(label).alias("p"), F.count("*").alias("n"))
    n = running(n, [F.col(score)], upto=F.col("n") - F.col("p")).withColumn("w", F.col("p") * (F.col("upto") - (F.col("n") - F.col("p")) / 2.0))
    return n.agg((F.sum("w") / F.nullif(F.sum("p") * F.sum(F.col("n") - F.col("p")), F.lit(0))).alias("auc"))


def calibration_bins(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    b = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins + 1e-9)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("share"))


def expected_calibration_error(bins: DataFrame) -> DataFrame:
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("mean_score") - F.col("share"))) / F.sum("n")).alias("ece"))


def coverage_curve(df: DataFrame, confidence: str, correct: str) -> DataFrame:
    """For every distinct confidence, from the highest: share of rows at least as sure, and their error rate."""
    n = df.groupBy(F.col(confidence).alias("confidence")).agg(F.count("*").alias("n"), F.sum(1 - F.col(correct)).alias("e"))
    sums = running(n, [-F.col("confidence")], rows=F.col("n"), wrong=F.col("e"))
    return sums.select("confidence", (F.col("rows") / F.col("rows_all")).alias("coverage"), (F.col("wrong") / F.col("rows")).alias("error"))


def wilson(k, n, z: float = 1.959963984540054):
    """Struct (low, high) of the Wilson interval of a proportion."""
    p = k / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.struct(((mid - half) / (1 + z * z / n)).alias("low"), ((mid + half) / (1 + z * z / n)).alias("high"))


def ranked_groups(df: DataFrame, key: str) -> DataFrame:
    """Groups from the largest, ties by key, with the cumulative share of rows."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    sums = running(n, [-F.col("n"), F.col(key)], rank=F.lit(1), rows=F.col("n"))
    return sums.select(key, "n", F.col("rank").cast("int").alias("rank"), (F.col("rows") / F.col("rows_all")).alias("cum_share"))


def context(lines: DataFrame, before: int = 2, after: int = 2) -> DataFrame:
    """The lines around each, within its page, joined by line feeds."""
    w = Window.partitionBy("file", "page_num").orderBy("line_num").rowsBetween(-before, after)
    return lines.withColumn("context", F.array_join(F.collect_list("text").over(w), "\n"))


def fill(rows: DataFrame, column: str, by: list[str], order: list[str]) -> DataFrame:
    """Missing values from the row before, else from the next that has one."""
    w = Window.partitionBy(*by).orderBy(*order)
    back = F.last(column, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(column, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return rows.withColumn("filled", F.coalesce(back, ahead))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], owned: list[str]) -> DataFrame:
    """Rows of both by key; for the owned columns a value of ``new`` replaces that of ``old``, others keep theirs."""
    rest = [c for c in old.columns if c not in (*keys, *owned)]
    b = new.select(*keys, *(F.col(c).alias(f"_{c}") for c in owned))
    both = old.join(b, keys, "full_outer")
    return both.select(*keys, *rest, *(F.coalesce(f"_{c}", c).alias(c) for c in owned))
