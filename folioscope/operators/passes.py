"""Corrections of isolated mistakes from the rest of the document: four passes over windows, and perplexity blending.

All windows of a document share one hash partitioning on file; a page's windows are contained in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.params import DEFAULT, Params


def _doc():
    return Window.partitionBy("file")


def _page():
    return Window.partitionBy("file", "page_num")


def scoreable():
    return ~F.col("categ").isin("Empty", "Non-text")


def dedup_modal(lines: DataFrame, categ: str = "categ") -> DataFrame:
    """Equal lines of a document take their most common category, ties the least name; pp_dedup marks those moved."""
    modal = F.mode(categ, True).over(Window.partitionBy("file", "text"))
    return lines.withColumn("_m", modal).withColumn("pp_dedup", F.col("_m") != F.col(categ)).withColumn(categ, F.col("_m")).drop("_m")


def surrounded(lines: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A weak Noisy line with two Trash lines on either side becomes Trash, in documents of five lines or more."""
    around = [f("categ", k).over(_doc().orderBy("page_num", "line_num")) == "Trash" for f in (F.lag, F.lead) for k in (1, 2)]
    test = (F.col("categ") == "Noisy") & (F.col("quality_score") < p.trash_max + p.surrounded_margin) & (F.count("*").over(_doc()) >= 5)
    for a in around:
        test = test & F.coalesce(a, F.lit(False))
    return lines.withColumn("pp_surrounded_trash", test).withColumn("categ", F.when(F.col("pp_surrounded_trash"), "Trash").otherwise(F.col("categ")))


def page_context(lines: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """On a garbage page weak Noisy lines become Trash; on a clean page trusted Trash lines become Noisy."""
    on = lambda x: F.when(scoreable(), x)
    trusted = F.col("lang_score") >= p.lang_remap
    rows = lines.withColumns({
        "_clear": F.avg(on((F.col("categ") == "Clear").cast("double"))).over(_page()),
        "_trust": F.avg(on(trusted.cast("double"))).over(_page()),
        "_median": F.expr("percentile(case when categ not in ('Empty', 'Non-text') then quality_score end, 0.5)").over(_page()),
    })
    garbage = (F.col("_clear") <= p.garbage_clear_max) & (F.col("_trust") < p.garbage_lang_max) & (F.col("_median") < p.garbage_median_max)
    clean = (F.col("_clear") > p.clean_clear_min) & (F.col("_median") > p.clean_median_min)
    down = garbage & (F.col("categ") == "Noisy") & (F.col("quality_score") < p.garbage_noisy_max)
    up = clean & (F.col("categ") == "Trash") & trusted & (F.col("quality_score") >= p.clean_recover_min)
    rows = rows.withColumn("_to", F.when(down, "Trash").when(up, "Noisy"))
    return rows.withColumn("pp_page_context", F.col("_to").isNotNull()).withColumn("categ", F.coalesce("_to", "categ")).drop("_clear", "_trust", "_median", "_to")


def suspicious(p: Params = DEFAULT):
    """Looks like a scan read upside down: turned letters, or odd words with high perplexity, without trusted language."""
    sure = F.coalesce(F.col("lang_score") >= p.rot_high_conf, F.lit(False))
    odd = F.col("word_weird") >= p.weird_inverted
    return scoreable() & ~F.col("diacritics") & ~sure & ((F.col("rot_ratio") >= p.rot_inverted) & odd | (F.col("perplex") >= p.ppl_inverted) & odd)


def suspicious_runs(lines: DataFrame, p: Params = DEFAULT, flag: str | None = None) -> DataFrame:
    """Runs of suspicious lines become Trash: all of them on a document where most are, else runs of ``run_min``.

    Empty and Non-text lines neither belong to a run nor break one.
    """
    rows = lines.withColumn("_s", F.coalesce(F.col(flag) if flag else suspicious(p), F.lit(False))).withColumn("_on", scoreable())
    scored = Window.partitionBy("file", "_on").orderBy("page_num", "line_num")
    rows = rows.withColumn("_island", F.sum((~F.col("_s")).cast("int")).over(scored.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumns({"_run": F.sum(F.col("_s").cast("int")).over(Window.partitionBy("file", "_on", "_island")), "_share": F.avg(F.col("_s").cast("double")).over(Window.partitionBy("file", "_on"))})
    hit = F.col("_on") & F.col("_s") & ((F.col("_share") >= p.page_majority) | (F.col("_run") >= p.run_min))
    return rows.withColumn("pp_inverted_run", hit & (F.col("categ") != "Trash")).withColumn("categ", F.when(hit, "Trash").otherwise(F.col("categ"))).drop("_s", "_on", "_island", "_run", "_share")


def document_passes(lines: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The four passes in order, over one exchange by document. Scores stay as they are, also of moved lines."""
    return suspicious_runs(page_context(surrounded(dedup_modal(lines.repartition("file")), p), p), p)


def blended_perplexity(lines: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """perplex_blend: the geometric mean of a line's perplexity and the median of its page's long lines, or where a page
    has few, of its document's."""
    long = F.col("word_count") >= p.blend_long_words
    median = lambda w: F.expr(f"percentile(case when word_count >= {p.blend_long_words} then perplex end, 0.5)").over(w)
    rows = lines.withColumns({"_n": F.count_if(long).over(_page()), "_page": median(_page()), "_doc": median(_doc())})
    base = F.coalesce(F.when(F.col("_n") >= p.blend_min_lines, F.col("_page")), F.col("_doc"))
    blend = F.exp(p.blend_weight * F.ln("perplex") + (1 - p.blend_weight) * F.ln(base))
    return rows.withColumn("perplex_blend", F.round(blend, 2)).drop("_n", "_page", "_doc")
