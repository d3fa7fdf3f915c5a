"""One record from two layouts of a document: exact lines of a text layer in the blocks of a page recognition.

``layer`` are the lines of the text layer (file, page_num, line_num, block, text, bbox), ``blocks`` and ``own`` the blocks
(file, page_num, block, ord, bbox) and lines of the recognition, ``pages`` (file, page_num, needs_atr) the pages of the layer. A box is an array of
left, top, right, bottom, or null. Lines and blocks meet by bands of a page, so that a page of very many lines is dealt over
many tasks, and a line meets only blocks at its height.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators.ordered import checkpointed

PAGE = ["file", "page_num"]
#: Bands that a page is cut into at most, and lines of a page that share a copy of its blocks where no block covers them.
BANDS, SALT_LINES = 64, 4096


def _area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1])


def coverage(line: Column, block: Column) -> Column:
    """The share of a line's box inside a block's; a box without area is in it or not by its centre."""
    width, height = F.least(line[2], block[2]) - F.greatest(line[0], block[0]), F.least(line[3], block[3]) - F.greatest(line[1], block[1])
    x, y = (line[0] + line[2]) / 2, (line[1] + line[3]) / 2
    inside = x.between(block[0], block[2]) & y.between(block[1], block[3])
    share = F.greatest(F.lit(0.0), width) * F.greatest(F.lit(0.0), height) / _area(line)
    return F.when(_area(line) > 0, share).otherwise(inside.cast("double"))


def distance(a: Column, b: Column) -> Column:
    dx, dy = F.greatest(F.lit(0.0), b[0] - a[2], a[0] - b[2]), F.greatest(F.lit(0.0), b[1] - a[3], a[1] - b[3])
    return F.sqrt(dx * dx + dy * dy)


def by_height(lines: DataFrame, boxed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines (box l) and blocks (box b) of a page, a row for each band they reach into: bands are as many as the page's blocks, ``BANDS`` at most."""
    span = boxed.groupBy(*PAGE).agg(F.min(F.col("b")[1]).alias("low"), F.max(F.col("b")[3]).alias("high"), F.least(F.lit(BANDS), F.count("*")).alias("bands"))
    step = F.greatest((F.col("high") - F.col("low")) / F.col("bands"), F.lit(1e-9))
    band = lambda y: F.least(F.col("bands"), F.greatest(F.lit(-1), F.floor((y - F.col("low")) / step))).cast("int")
    cut = lambda df, c: df.join(span, PAGE).withColumn("band", F.explode(F.sequence(band(F.least(F.col(c)[1], F.col(c)[3])), band(F.greatest(F.col(c)[1], F.col(c)[3]))))).drop("low", "high", "bands")
    return cut(lines, "l"), cut(boxed, "b")


def linked(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, page_num, line_num, to): the block of each line with a box on a page with a boxed block.

    It is the block with the largest share of the line, shares to six places; ties go to the smaller block, then to the earlier, then
    by name. A line that no block covers goes to the nearest block, ties alike.
    """
    boxed = blocks.where("bbox is not null").select(*PAGE, "block", "ord", F.col("bbox").alias("b"))
    lines = lines.where("bbox is not null").select(*PAGE, "line_num", F.col("bbox").alias("l"))
    high_lines, high_blocks = by_height(lines, boxed)
    share = F.round(coverage(F.col("l"), F.col("b")), 6)
    near = high_lines.join(high_blocks, [*PAGE, "band"]).where(coverage(F.col("l"), F.col("b")) > 0)
    key = F.struct((-share).alias("s"), _area(F.col("b")).alias("a"), "ord", "block")
    covered = near.groupBy(*PAGE, "line_num").agg(F.min_by("block", key).alias("to"))
    bare = lines.join(covered, [*PAGE, "line_num"], "left_anti")
    salts = bare.groupBy(*PAGE).agg(F.ceil(F.count("*") / SALT_LINES).cast("int").alias("salts"))
    copies = boxed.join(salts, PAGE).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    spread = bare.join(salts, PAGE).withColumn("salt", (F.col("line_num") % F.col("salts")).cast("int")).drop("salts")
    key = F.struct(distance(F.col("l"), F.col("b")).alias("d"), _area(F.col("b")).alias("a"), "ord", "block")
    nearest = spread.join(copies, [*PAGE, "salt"]).groupBy(*PAGE, "line_num").agg(F.min_by("block", key).alias("to"))
    return covered.unionByName(nearest)


def _in_order(batches):
    """Lines sorted by page and number: a line of a layer block none of whose lines has a link takes that of the block's first line, the
    first one that of the line before it, at a page's start ``start``."""
    page, last, first_of = None, None, {}
    for b in batches:
        out = []
        for file, number, block, to, start in zip(*(b.column(c).to_pylist() for c in ("file", "page_num", "block", "to", "start"))):
            if (file, number) != page:
                page, last, first_of = (file, number), start, {}
            last = first_of.setdefault(block, last) if to is None else to
            out.append(last)
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("page_num"), b.column("line_num"), pa.array(out, pa.string())], [*PAGE, "line_num", "to"])


def placed(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``linked`` for every line: one without a box goes with most lines of its layer block, ties to the earlier block, then by name.
    Of a layer block without any box, the first line goes where the line before it does, at the start of a page where the first line with a
    link does, or to the page's first block if there is none; its other lines follow the first."""
    link = checkpointed(lines.select(*PAGE, "line_num", "block").join(linked(lines, blocks), [*PAGE, "line_num"], "left"))
    order = blocks.select(*PAGE, F.col("block").alias("to"), "ord")
    votes = link.where("to is not null").groupBy(*PAGE, "block", "to").agg(F.count("*").alias("n")).join(order, [*PAGE, "to"])
    most = votes.groupBy(*PAGE, "block").agg(F.min_by("to", F.struct((-F.col("n")).alias("n"), "ord", "to")).alias("most"))
    a, b = link.alias("a"), most.alias("b")
    same = [F.col("a.file") == F.col("b.file"), F.col("a.page_num") == F.col("b.page_num"), F.col("a.block").eqNullSafe(F.col("b.block"))]
    known = a.join(b, same, "left").select("a.file", "a.page_num", "a.line_num", "a.block", F.coalesce("a.to", "b.most").alias("to"))
    head = blocks.where("bbox is not null").groupBy(*PAGE).agg(F.min_by("block", F.struct("ord", "block")).alias("head"))
    linked_first = link.where("to is not null").groupBy(*PAGE).agg(F.min_by("to", "line_num").alias("seen"))
    start = head.join(linked_first, PAGE, "left").select(*PAGE, F.coalesce("seen", "head").alias("start"))
    rows = known.join(start, PAGE).repartition(*PAGE).sortWithinPartitions(*PAGE, "line_num")
    return rows.select(*PAGE, "line_num", "block", "to", "start").mapInArrow(_in_order, rows.select(*PAGE, "line_num", "to").schema)


def merged(pages: DataFrame, layer: DataFrame, blocks: DataFrame, own: DataFrame) -> DataFrame:
    """(file, page_num, line_num, block, text, bbox, text_source): the lines of the record, numbered from 1 on each page.

    A page that needs recognition, that the layer lacks or has no line on, has the recognition's lines. Any other keeps the layer's, each in the block
    it is placed in, in the layer's order; a block that no line went to adds its own lines. Blocks are in reading order, ties by name; a
    null order is the last. Repeated line numbers are told apart by nothing: keep them unique on a page. Pages that ``problems`` names have
    layer lines and no boxed block: those lines are left out.
    """
    blocks = blocks.withColumn("ord", F.coalesce("ord", F.lit(1 << 30)))
    kept_pages = layer.select(*PAGE).distinct().join(pages.where("not coalesce(needs_atr, false)").select(*PAGE).distinct(), PAGE)
    lines = layer.join(kept_pages, PAGE, "left_semi")
    went = checkpointed(placed(lines, blocks))
    exact = lines.drop("block").join(went, [*PAGE, "line_num"]).select(*PAGE, F.col("to").alias("block"), F.col("line_num").alias("_n"), "text", "bbox", F.lit("text-layer").alias("text_source"))
    filled = went.select(*PAGE, F.col("to").alias("block")).distinct()
    mine = own.select(*PAGE, "block", F.col("line_num").alias("_n"), "text", "bbox", F.lit("atr").alias("text_source"))
    whole = mine.join(kept_pages, PAGE, "left_anti").withColumn("_whole", F.lit(True))
    added = mine.join(kept_pages, PAGE, "left_semi").join(filled, [*PAGE, "block"], "left_anti")
    rows = exact.unionByName(added).withColumn("_whole", F.lit(False)).unionByName(whole)
    rows = rows.join(blocks.select(*PAGE, "block", "ord"), [*PAGE, "block"], "left")
    rows = rows.where("_whole or ord is not null")
    order = Window.partitionBy(*PAGE).orderBy(F.when(~F.col("_whole"), F.col("ord")).asc_nulls_first(), F.when(~F.col("_whole"), F.col("block")).asc_nulls_first(), "_n")
    return rows.select(*PAGE, F.row_number().over(order).alias("line_num"), "block", "text", "bbox", "text_source")


def problems(documents: DataFrame, pages: DataFrame, layer: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, page_num, problem) of documents (file, atr_pages, layer_pages, forced) that cannot be merged, page_num null for whole documents:

    not_mixed: no page of the layer needs recognition; page_mismatch: the two count other pages; forced_mismatch: the
    recognition was forced on pages (array) other than those that need it; atr_page_missing: a page with lines of the layer has no boxed
    block. For measures of pages see ``record.geometry_problems``.
    """
    need = pages.groupBy("file").agg(F.array_sort(F.collect_set(F.when(F.col("needs_atr"), F.col("page_num")))).alias("need"))
    d = documents.join(need, "file", "left").withColumn("need", F.coalesce("need", F.array().cast("array<int>")))
    forced = F.array_sort(F.array_distinct(F.coalesce(F.col("forced").cast("array<int>"), F.array().cast("array<int>"))))
    tests = {"not_mixed": F.size("need") == 0, "page_mismatch": ~F.col("atr_pages").eqNullSafe(F.col("layer_pages")), "forced_mismatch": (F.size(forced) > 0) & (forced != F.col("need"))}
    whole = d.select("file", F.explode(F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))).alias("problem"))
    bare = layer.select(*PAGE).distinct().join(pages.where("not coalesce(needs_atr, false)").select(*PAGE).distinct(), PAGE)
    bare = bare.join(blocks.where("bbox is not null").select(*PAGE).distinct(), PAGE, "left_anti").withColumn("problem", F.lit("atr_page_missing"))
    return whole.withColumn("page_num", F.lit(None).cast("int")).unionByName(bare).select("file", "page_num", "problem")
