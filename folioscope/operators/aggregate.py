"""Page statistics and document summaries of the line table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.params import CATEGORIES

def _text():
    return F.col("categ").isin("Clear", "Noisy")


def _name(c: str) -> str:
    return c.lower()


def _rounded(x, digits):
    return x if digits is None else F.round(x, digits)


def page_stats(lines: DataFrame, digits: int | None = 4) -> DataFrame:
    """One aggregate per page: lines by category and their ratios, sums and means over Clear and Noisy lines, main
    language (ties the least name). Ratios of an empty denominator, and means without text lines, are null."""
    have = set(lines.columns)
    counts = [F.count_if(F.col("categ") == c).alias(_name(c)) for c in CATEGORIES]
    sums = [F.coalesce(F.sum(F.when(_text(), F.col(c))), F.lit(0)).cast("long").alias(f"total_{c}") for c in ("word_count", "char_count") if c in have]
    means = [_rounded(F.avg(F.when(_text(), F.col(c))), digits).alias(f"avg_{c}") for c in ("quality_score", "word_weird", "lang_score", "perplex", "vowel_ratio", "rot_ratio") if c in have]
    lang = [F.mode(F.when(_text(), F.col("lang")), True).alias("main_lang")] if "lang" in have else []
    pages = lines.groupBy("file", "page_num").agg(*counts, *sums, *means, *lang)
    pages = pages.withColumn("num_lines", sum((F.col(f"`{_name(c)}`") for c in CATEGORIES), F.lit(0)))
    full = F.nullif(F.col("num_lines") - F.col("empty"), F.lit(0))
    ratios = {f"{_name(c)}_ratio": _rounded(F.col(f"`{_name(c)}`") / (F.nullif(F.col("num_lines"), F.lit(0)) if c == "Empty" else full), digits) for c in CATEGORIES}
    return pages.withColumns(ratios)


def quality_band(clear, noisy, trash):
    """Plurality of three counts, ties to the better one; null without lines."""
    return F.when(clear + noisy + trash == 0, F.lit(None)).when((clear >= noisy) & (clear >= trash), "Clear").when(noisy >= trash, "Noisy").otherwise("Trash")


def quality_summary(lines: DataFrame, digits: int | None = 4) -> DataFrame:
    """Per document: mean, median, least and greatest page score, and the lines by category as a map."""
    pages = lines.groupBy("file", "page_num").agg(F.avg(F.when(_text(), F.col("quality_score"))).alias("score"))
    score = pages.groupBy("file").agg(_rounded(F.avg("score"), digits).alias("mean"), _rounded(F.median("score"), digits).alias("median"), _rounded(F.min("score"), digits).alias("min"), _rounded(F.max("score"), digits).alias("max"), F.count("*").alias("pages"))
    counts = lines.groupBy("file", "categ").agg(F.count("*").alias("n")).groupBy("file").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("categ", "n")))).alias("by_categ"))
    return score.join(counts, "file")


def category_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("categ").agg(F.count("*").alias("n"))
