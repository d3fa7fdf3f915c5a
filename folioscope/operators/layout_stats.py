"""Paragraphs from the boxes of lines, and counts of the elements of pages, as SQL functions over columns of markup and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators.ordered import checkpointed

PAGE = ["file", "page_num"]
#: Heights up to this do not count as a line's, a gap of so many median heights ends a paragraph, and a page without boxes has this height.
LEAST_HEIGHT, GAP, NO_HEIGHT = 5, 1.5, 10.0
#: What an element's content may hide: comments, marked sections, scripts and styles are text, not elements.
HIDDEN = r"(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
#: The elements of a layout file that make its page statistics, by their column.
ALTO_ELEMENTS = {"textlines": "TextLine", "illustrations": "Illustration", "graphics": "GraphicalElement", "strings": "String"}


def scaled_box(box: Column, width: Column, height: Column) -> Column:
    """A box (left, top, right, bottom) in thousandths of its page, halves to the even number, cut to the page; null without a box or a size."""
    one = lambda v, side: F.greatest(F.lit(0), F.least(F.lit(1000), F.bround(v * (1000.0 / F.nullif(side, F.lit(0))), 0).cast("int")))
    return F.when(box.isNotNull() & (width > 0) & (height > 0), F.array(one(box[0], width), one(box[1], height), one(box[2], width), one(box[3], height)))


def paragraph_breaks(lines: DataFrame) -> DataFrame:
    """``lines`` (file, page_num, line_num, bbox), in reading order by line_num, with ``gap``, the distance from the bottom of the line before to the
    top of the line (null on a page's first), and ``paragraph``, its number from 1.

    A paragraph begins where the order jumps up by more than the page's median height, or the gap is more than 1.5 of it. The
    median is exact, of heights over 5, of all where none is; lines without a box do not count for it and have no gaps around them.
    """
    height = F.col("bbox")[3] - F.col("bbox")[1]
    page = lines.where("bbox is not null").groupBy(*PAGE).agg(F.coalesce(F.median(F.when(height > LEAST_HEIGHT, height)), F.median(height), F.lit(NO_HEIGHT)).alias("_m"))
    order = Window.partitionBy(*PAGE).orderBy("line_num")
    rows = lines.join(page, PAGE, "left").withColumn("gap", F.col("bbox")[1] - F.lag("bbox").over(order)[3])
    new = F.coalesce((F.col("gap") < -F.col("_m")) | (F.col("gap") > GAP * F.col("_m")), F.lit(False)).cast("int")
    return rows.withColumn("paragraph", F.sum(new).over(order) + 1).drop("_m")


def paragraph_texts(lines: DataFrame) -> DataFrame:
    """(file, page_num, paragraph, text): lines of each paragraph joined by line feeds; null lines are empty ones."""
    parts = F.array_sort(F.collect_list(F.struct("line_num", F.coalesce("text", F.lit("")).alias("t"))))
    return paragraph_breaks(lines).groupBy(*PAGE, "paragraph").agg(F.array_join(F.transform(parts, lambda x: x.t), "\n").alias("text"))


def element_counts(pages: DataFrame, key: list[str], column: str) -> DataFrame:
    """(key..., element, n): start tags by their local name in lower case, in a column of HTML or XML; of what is hidden none. A null
    text has none."""
    bare = F.regexp_replace(F.col(column), HIDDEN, "")
    tags = F.regexp_extract_all(bare, F.lit(r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)"), F.lit(1))
    return pages.select(*key, F.explode(tags).alias("element")).groupBy(*key, F.lower("element").alias("element")).agg(F.count("*").alias("n"))


def alto_counts(pages: DataFrame, key: list[str], column: str) -> DataFrame:
    """One row a page: textlines, illustrations, graphics and strings of a layout file; 0 where there are none, or no text."""
    bare = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), HIDDEN, "")
    count = lambda name: F.regexp_count(bare, F.lit(rf"<(?:[A-Za-z_][\w.-]*:)?{name}(?=[\s/>])"))
    return pages.select(*key, *(count(v).alias(k) for k, v in ALTO_ELEMENTS.items()))


def json_leaves(rows: DataFrame, key: list[str], column: str, most: int = 64) -> DataFrame:
    """(key..., path, kind, value): the leaves of JSON texts, objects and arrays opened level by level; kind is string, number, boolean or
    null. A path has names and numbers from 0, joined by dots; what is no JSON has no leaves, and neither do empty objects and arrays. Values more than
    ``most`` levels down are errors."""
    level = rows.select(F.struct(*key).alias("k"), F.lit("").alias("path"), F.try_parse_json(column).alias("v")).where("v is not null")
    out = None
    for _ in range(most):
        # a value opens where it has a part; its parts are of the next level
        kind = F.schema_of_variant("v")
        nested = kind.startswith("OBJECT<") | kind.startswith("ARRAY<")
        level = checkpointed(level.withColumn("kind", F.when(nested, "nested").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")))
        leaves = level.where("kind <> 'nested'").select("k.*", "path", "kind", F.col("v").cast("string").alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        inner = level.where("kind = 'nested'")
        if inner.isEmpty():
            return out
        parts = inner.lateralJoin(inner.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "part"))
        level = parts.select("k", F.concat_ws(".", F.nullif("path", F.lit("")), F.coalesce("name", F.col("pos").cast("string"))).alias("path"), F.col("part").alias("v"))
    raise ValueError(f"JSON of more than {most} levels")
