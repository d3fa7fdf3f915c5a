"""Packs of changed lines for labelling, and labels back onto changes.

A pack has the largest groups of changed lines whole, a group being the lines that read alike but for case and marks, and a sample of all other
changed lines: those of least hash, so that each has the same known chance to be in it. A label of a group holds for all its lines;
the sampled lines' labels are scaled up to the lines they stand for.

Changes are rows of (id, collection, doc, text, from, to); ``from`` and ``to`` are categories, ids are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators import evaluate
from folioscope.operators.compare import verdict
from folioscope.operators.lexicon import family_key
from folioscope.operators.sampling import unit_hash

LOST = ("Trash", "Non-text")
MEASURES = ("fixed", "broken", "neither", "closer", "farther", "clear_loss", "clear_demoted")


def top_groups(changes: DataFrame, top: int, excluded: DataFrame | None = None) -> DataFrame:
    """The ``top`` largest groups: rank, key, occurrences, cumulative_share (of the lines considered), text (the commonest spelling, ties
    by text), variants, other_variants (the next three), documents, example (the least id), transitions.

    Groups with a key of ``excluded`` (key) are not considered. Equal sizes go by key. Lines of no letters or digits share the empty key; a null text
    has it too.
    """
    rows = _considered(changes, excluded)
    total = rows.agg(F.count("*").alias("total"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("occurrences"), F.count_distinct("collection", "doc").alias("documents"), F.min("id").alias("example"))
    picked = sizes.orderBy(F.desc("occurrences"), "key").limit(top)
    by_size = Window.orderBy(F.desc("occurrences"), "key")  # ``top`` rows
    picked = picked.withColumns({"rank": F.row_number().over(by_size), "_sum": F.sum("occurrences").over(by_size.rowsBetween(Window.unboundedPreceding, 0))})
    chosen = F.broadcast(picked.select("key"))  # at most ``top`` rows
    own = rows.join(chosen, "key", "left_semi")
    spellings = own.groupBy("key", "text").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "text"))
    first = spellings.withColumn("k", place).where("k <= 4").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("v"))
    spelt = first.join(spellings.groupBy("key").agg(F.count("*").alias("variants")), "key")
    spelt = spelt.select("key", F.col("v")[0].text.alias("text"), "variants", F.array_join(F.transform(F.slice("v", 2, 3), lambda x: x.text), " | ").alias("other_variants"))
    moves = own.groupBy("key", F.concat("from", F.lit("->"), "to").alias("move")).agg(F.count("*").alias("n"))  # a few dozen a group
    moves = moves.groupBy("key").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "move"))).alias("v")).select("key", F.array_join(F.transform("v", lambda x: F.concat(x.move, F.lit(" "), -x.n)), "; ").alias("transitions"))
    out = picked.join(spelt, "key").join(moves, "key").join(F.broadcast(total), F.lit(True))
    return out.select("rank", "key", "occurrences", F.round(F.col("_sum") / F.col("total"), 3).alias("cumulative_share"), "text", "variants", "other_variants", "documents", "example", "transitions")


def _considered(changes: DataFrame, excluded: DataFrame | None) -> DataFrame:
    rows = changes.withColumn("key", family_key(F.coalesce("text", F.lit(""))))
    return rows if excluded is None else rows.join(excluded.select("key").distinct(), "key", "left_anti")


def tail_sample(changes: DataFrame, top: DataFrame, n: int, seed: int = 0, excluded: DataFrame | None = None) -> DataFrame:
    """``n`` of the considered lines outside the groups of ``top`` (key), all of them if fewer: (position, id, text, from, to, group_occurrences,
    inclusion). They are those of least hash of seed and id, in that order; ``inclusion`` is the chance each line had."""
    rows = _considered(changes, excluded).join(top.select("key").distinct(), "key", "left_anti")
    sizes = rows.groupBy("key").agg(F.count("*").alias("group_occurrences"))
    total = sizes.agg(F.coalesce(F.sum("group_occurrences"), F.lit(0)).alias("_n"))
    picked = rows.withColumn("_h", unit_hash(F.col("id"), seed)).orderBy("_h", "id").limit(n)
    out = picked.join(sizes, "key").join(F.broadcast(total), F.lit(True))
    place = F.row_number().over(Window.orderBy("_h", "id"))  # ``n`` rows
    return out.select(place.alias("position"), "id", "text", "from", "to", "group_occurrences", F.least(F.lit(1.0), F.lit(n) / F.col("_n")).alias("inclusion"))


def labelled(arm: DataFrame, reference: DataFrame, top_labels: DataFrame, tail_labels: DataFrame) -> DataFrame:
    """The changes of ``arm`` with ``key``, ``bucket`` and ``label``.

    ``top_labels`` (key, label) is the sheet of groups, ``tail_labels`` (id, label) that of lines; a null or blank label is listed and not
    given. A change is *top* where its group has a label, *excluded* where the group is listed without one; *tail* where ``reference``, the
    changes that the pack was drawn from, has its id outside listed groups, with the label of the line if it is given; else *new*. Of several labels of
    a group or line the least counts.
    """
    given = lambda df, k: df.groupBy(k).agg(F.min(F.nullif(F.trim("label"), F.lit(""))).alias("label"))
    sheet = given(top_labels, "key").select("key", F.lit(True).alias("_listed"), F.col("label").alias("_top"))
    key = lambda df: df.withColumn("key", family_key(F.coalesce("text", F.lit(""))))
    tail = key(reference).join(sheet.select("key"), "key", "left_anti").select("id", F.lit(True).alias("_tail")).distinct()
    lines = given(tail_labels, "id").select("id", F.col("label").alias("_line"))
    rows = key(arm).join(sheet, "key", "left").join(tail, "id", "left").join(lines, "id", "left")
    bucket = F.when(F.col("_top").isNotNull(), "top").when(F.col("_listed"), "excluded").when(F.col("_tail"), "tail").otherwise("new")
    label = F.when(F.col("_top").isNotNull(), F.col("_top")).when(bucket == "tail", F.col("_line"))
    return rows.select(*arm.columns, "key", bucket.alias("bucket"), label.alias("label"))


def estimates(rows: DataFrame) -> DataFrame:
    """One row a measure, from ``labelled`` changes: its count in labelled groups (``top``), in the sample (``tail``), the sample's size and the
    lines it stands for, the estimate for those with its 95 % interval, the total of both and its share of the lines covered.

    Without a labelled sample the estimates are null and the total is that of the groups.
    """
    gold, a, b = F.col("label"), F.col("from"), F.col("to")
    tests = {m: verdict(gold, a, b) == m for m in MEASURES[:3]} | {m: evaluate.nearer(gold, a, b) == m for m in MEASURES[3:5]}
    tests |= {"clear_loss": (gold == "Clear") & b.isin(*LOST) & ~a.isin(*LOST), "clear_demoted": (gold == "Clear") & (a == "Clear") & (b != "Clear")}
    known = F.col("label").isNotNull()
    count = lambda t: F.count_if(F.coalesce(t, F.lit(False)))
    sums = rows.agg(
        count(F.col("bucket") == "top").alias("top_lines"), count(F.col("bucket") == "tail").alias("population"), count((F.col("bucket") == "tail") & known).alias("sampled"),
        F.array(*(F.struct(F.lit(m).alias("measure"), count((F.col("bucket") == "top") & t).alias("top"), count((F.col("bucket") == "tail") & known & t).alias("tail")) for m, t in tests.items())).alias("m"),
    )
    out = sums.select("top_lines", "population", "sampled", F.explode("m").alias("m")).select("m.*", "top_lines", "population", "sampled")
    out = out.withColumn("e", F.when(F.col("sampled") > 0, evaluate.scaled_estimate(F.col("tail"), F.col("sampled"), F.col("population"))))
    total = F.col("top") + F.coalesce(F.try_divide(F.col("tail").cast("double"), F.col("sampled")) * F.col("population"), F.lit(0.0))
    share = F.try_divide(total, (F.col("top_lines") + F.col("population")).cast("double"))
    return out.select("measure", "top", "tail", "sampled", "population", "e.estimate", "e.low", "e.high", F.round(total, 3).alias("total"), F.round(share, 4).alias("share"))
