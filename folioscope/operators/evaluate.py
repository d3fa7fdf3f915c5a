"""Evaluation of categories and changes: small column rules, votes, page changes, calibration and error measures.

Column rules take columns and give columns. Everything else is an aggregate over rows; what is ordered as a whole is a
table of bins or of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators import aggregate
from folioscope.operators.compare import ORDINAL
from folioscope.params import DEFAULT, Params

#: Category names as they are written, by their lower-case forms with hyphens.
NAMES = {"empty": "Empty", "non-text": "Non-text", "nontext": "Non-text", "trash": "Trash", "noisy": "Noisy", "clear": "Clear"}


def fast_track(categ: Column, word_count: Column) -> Column:
    """Rows of the pre-filter, which carry no scores."""
    return categ.isin("Empty", "Non-text") & (F.coalesce(word_count, F.lit(0)) == 0)


def normalised_category(value: Column) -> Column:
    """A category's own spelling whatever the case and hyphens; other values trimmed, null as ''."""
    names = F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))
    bare = F.trim(F.coalesce(value, F.lit("")))
    return F.coalesce(names[F.replace(F.lower(bare), F.lit("_"), F.lit("-"))], bare)


def locator(value: Column) -> Column:
    """Whole numbers without their fraction (149.0 is 149), other values trimmed."""
    bare = F.trim(value.cast("string"))
    number = bare.try_cast("double")
    return F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(bare)


def page_list(spec: Column) -> Column:
    """The distinct labels of a comma-separated list, sorted; null where there is none."""
    found = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(spec, ","), lambda x: F.trim(x)), lambda x: x != "")))
    return F.when(F.size(found) > 0, found)


def line_id(file: str = "file", page: str = "page_num", line: str = "line_num") -> Column:
    return F.concat_ws(":", *(F.col(c).cast("string") for c in (file, page, line)))


def band_category(score: Column, p: Params = DEFAULT) -> Column:
    return F.when(score < p.trash_max, "Trash").when(score < p.noisy_max, "Noisy").when(score.isNotNull(), "Clear")


def lane(probability: Column, accept_at: float, review_below: float) -> Column:
    """accept from ``accept_at``, review below ``review_below``, escalate between."""
    if review_below > accept_at:
        raise ValueError("review_below must not exceed accept_at")
    return F.when(probability >= accept_at, "accept").when(probability < review_below, "review").otherwise("escalate")


def word_bucket(words: Column) -> Column:
    return F.when(words >= 5, "5+").otherwise(F.greatest(words, F.lit(1)).cast("string"))


def recoverability_band(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(number >= 0.99, "full").when(number > 0, "partial").when(number.isNotNull(), "none").otherwise("unknown")


def nearer(label: Column, before: Column, after: Column) -> Column:
    """closer, farther or same: how a change moves an ordered category towards its label; n/a for other categories."""
    rank = F.create_map(*(F.lit(x) for pair in ORDINAL.items() for x in pair))
    was, now = F.abs(rank[before] - rank[label]), F.abs(rank[after] - rank[label])
    return F.when(now < was, "closer").when(now > was, "farther").when(now == was, "same").otherwise("n/a")


def dominant(mix: Column) -> Column:
    """The first of the commonest categories of a mix such as Clear:539|Trash:4, or ?."""
    parts = F.transform(F.split(mix, r"\|"), lambda x, i: F.struct(F.try_element_at(F.split(x, ":"), F.lit(2)).try_cast("long").alias("n"), (-i).alias("i"), F.split(x, ":")[0].alias("name")))
    return F.coalesce(F.array_max(F.filter(parts, lambda x: x.n.isNotNull())).getField("name"), F.lit("?"))


def contested(mix: Column) -> Column:
    return F.coalesce(F.contains(mix, F.lit("|")), F.lit(False))


def votes(lines: DataFrame) -> DataFrame:
    """Per (file, text): lines, shape of the vote on its category, and the winner (ties to the category of least name)."""
    n = lines.groupBy("file", "text", "categ").agg(F.count("*").alias("n"))
    one = n.groupBy("file", "text").agg(F.sum("n").alias("lines"), F.max("n").alias("most"), F.count("*").alias("kinds"), F.collect_list(F.struct("n", "categ")).alias("all"))
    top = F.array_sort(F.transform(F.filter("all", lambda x: x.n == F.col("most")), lambda x: x.categ))
    shape = F.when(F.col("kinds") == 1, "unanimous").when(F.size(top) > 1, "tie").when(2 * F.col("most") > F.col("lines"), "strict majority").otherwise("bare plurality")
    return one.select("file", "text", "lines", shape.alias("shape"), top[0].alias("winner"))


def brier(options: DataFrame, item: list[str], probability: str, is_gold: str) -> DataFrame:
    """Multi-class Brier score of rows (item, option): the mean over items of the summed squared errors."""
    error = F.pow(F.col(probability) - F.col(is_gold).cast("double"), 2)
    return options.groupBy(*item).agg(F.sum(error).alias("e")).agg(F.avg("e").alias("brier"), F.count("*").alias("items"))


def calibration_error(rows: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal bins of (0, 1]; 0 falls into the first."""
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.ceil(F.col(confidence) * bins) - 1))
    by = rows.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(confidence).alias("c"), F.avg(F.col(correct).cast("double")).alias("h"))
    return by.agg((F.sum(F.abs(F.col("h") - F.col("c")) * F.col("n")) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def pick_threshold(curve: DataFrame, target_error: float) -> DataFrame:
    """Of a coverage curve, the row of the least confidence whose error is within the target; none if there is none."""
    best = curve.where(F.col("error") <= target_error).agg(F.min(F.struct("confidence", "coverage", "error")).alias("b"))
    return best.where("b is not null").select("b.*")


def mcnemar(rows: DataFrame, gold: str, one: str, two: str) -> DataFrame:
    """Lines that only one of two arms has right, and the exact two-sided p-value of their split."""
    right = lambda c: F.coalesce(F.col(c) == F.col(gold), F.lit(False))
    n = rows.where(F.col(gold).isNotNull()).agg(F.count_if(right(one) & ~right(two)).alias("only_one"), F.count_if(~right(one) & right(two)).alias("only_two"))
    n = n.withColumns({"all": F.col("only_one") + F.col("only_two"), "least": F.least("only_one", "only_two")})
    # log of the binomial terms, each from the one before
    start = F.struct((-F.col("all") * F.log(F.lit(2.0))).alias("term"), F.exp(-F.col("all") * F.log(F.lit(2.0))).alias("sum"))

    def step(s, i):
        term = s.term + F.log((F.col("all") - i + 1) / i)
        return F.struct(term.alias("term"), (s.sum + F.exp(term)).alias("sum"))

    tail = F.aggregate(F.when(F.col("least") > 0, F.sequence(F.lit(1).cast("long"), F.col("least"))).otherwise(F.array().cast("array<bigint>")), start, step, lambda s: s.sum)
    return n.select("only_one", "only_two", F.round(F.when(F.col("all") == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail)), 6).alias("p_value"))


def regression_metrics(rows: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """n, mae, rmse, r2 and pearson (each 0 where undefined) of predictions ``y`` for ``x``; see ``compare.spearman`` for ranks. Rows with a
    null in either count in n only."""
    gap = F.col(x) - F.col(y)
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    known = F.when(gap.isNotNull(), F.col(x))
    r2 = 1 - F.try_divide(F.sum(gap * gap), F.nullif(F.var_pop(known), F.lit(0.0)) * F.count(gap))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), zero(F.avg(F.abs(gap))).alias("mae"), zero(F.sqrt(F.avg(gap * gap))).alias("rmse"), zero(r2).alias("r2"), zero(F.corr(x, y)).alias("pearson"))


def scaled_estimate(count: Column, n: Column, population: Column) -> Column:
    """Struct (estimate, low, high) of a count in a sample, scaled to the population with a normal interval."""
    p = F.try_divide(count.cast("double"), n)
    half = 1.96 * F.sqrt(p * (1 - p) / n)
    return F.struct(*(F.round(v * population, 3).alias(k) for k, v in (("estimate", p), ("low", p - half), ("high", p + half))))


def page_profile(lines: DataFrame) -> DataFrame:
    """Per page: counts by category, the mean score of text lines, and the band."""
    p = aggregate.page_stats(lines, digits=None)
    return p.select("file", "page_num", "clear", "noisy", "trash", F.col("avg_quality_score").alias("score"), aggregate.quality_band(F.col("clear"), F.col("noisy"), F.col("trash")).alias("band"))


def page_changes(reference: DataFrame, arm: DataFrame) -> DataFrame:
    """Pages whose profile differs: both bands and scores, changes of counts, and ``moved``, the score's move in hundredths
    (100 where one side has none; null where it does not move)."""
    side = lambda df, name: df.select("file", "page_num", *(F.col(c).alias(f"{c}_{name}") for c in ("clear", "noisy", "trash", "score", "band")))
    both = side(reference, "ref").join(side(arm, "arm"), ["file", "page_num"])
    same = F.lit(True)
    for c in ("clear", "noisy", "trash", "score", "band"):
        same &= F.col(f"{c}_ref").eqNullSafe(F.col(f"{c}_arm"))
    move = F.abs(F.col("score_arm") - F.col("score_ref"))
    moved = F.when(F.col("score_ref").isNull() & F.col("score_arm").isNull(), None).when(move.isNull(), 100).when(move > 1e-12, F.least(F.lit(100), F.floor(move * 100 + 1e-9)))
    deltas = [(F.col(f"{c}_arm") - F.col(f"{c}_ref")).alias(f"d_{c}") for c in ("clear", "noisy", "trash")]
    return both.where(~same).select("file", "page_num", "band_ref", "band_arm", "score_ref", "score_arm", *deltas, moved.cast("int").alias("moved"))


def page_change_summary(changes: DataFrame) -> DataFrame:
    return changes.agg(
        F.count("*").alias("pages_changed"), F.count_if(~F.col("band_ref").eqNullSafe(F.col("band_arm"))).alias("band_flips"), F.count_if(F.col("moved") >= 1).alias("moved_ge_1"), F.count_if(F.col("moved") >= 5).alias("moved_ge_5")
    )


def binned_quantiles(rows: DataFrame, value: str, points=(0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """(point, value): quantiles at the centres of bins of a hundredth; only the bins are ordered."""
    bins = rows.where(F.col(value).isNotNull()).groupBy(F.floor(F.col(value) * 100 + 1e-9).alias("bin")).agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.select("bin", up_to.alias("c"), F.sum("n").over(Window.partitionBy()).alias("all"))
    asked = bins.withColumn("point", F.explode(F.array(*map(F.lit, points)))).where(F.col("c") >= F.col("point") * F.col("all"))
    return asked.groupBy("point").agg(F.round((F.min("bin") + 0.5) / 100, 3).alias("value"))


def preflight(lines: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """How labels meet lines: labels, distinct keys, keys with a line, labels without one."""
    there = lines.select(*keys).distinct().withColumn("there", F.lit(1))
    found = gold.groupBy(*keys).agg(F.count("*").alias("n")).join(there, keys, "left")
    return found.agg(F.sum("n").alias("labels"), F.count("*").alias("keys"), F.count("there").alias("matched"), F.coalesce(F.sum(F.when(F.col("there").isNull(), F.col("n"))), F.lit(0)).alias("unmatched"))


def stratum_agreement(rows: DataFrame, stratum: str, gold: str, pred: str) -> DataFrame:
    """Per stratum: labelled rows, those that agree, and their share."""
    n = rows.where(F.col(gold).isNotNull()).groupBy(stratum).agg(F.count("*").alias("n"), F.count_if(F.col(gold) == F.col(pred)).alias("agree"))
    return n.withColumn("share", F.col("agree") / F.col("n"))
