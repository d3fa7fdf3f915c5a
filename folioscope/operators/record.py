"""Nested document records: layout input, line tables to records, and records merged field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators.aggregate import quality_summary

LAYOUT = (
    "version string, documentLanguage string, pages array<struct<pageNumber: int, width: double, height: double, blocks: array<struct<id: string, type: string, bbox: array<double>, readingOrder: int, content: string, lines: array<struct<text: string, bbox: array<double>>>>>>>"
)


def layout_lines(docs: DataFrame, id_column: str = "file", column: str = "json") -> DataFrame:
    """Lines of layout JSON in reading order: a block's own lines, else its content split at line feeds.

    A document that is not of the schema gives one row with ``error`` and no text.
    """
    d = docs.select(F.col(id_column).alias("file"), F.from_json(column, LAYOUT).alias("d"))
    bad = d.where("d is null or d.pages is null").select("file", F.lit("not a layout document").alias("error"))
    page = d.where("d.pages is not null").select("file", F.explode("d.pages").alias("p"))
    block = page.select("file", F.col("p.pageNumber").alias("page_num"), F.posexplode(F.array_sort("p.blocks", lambda a, b: F.coalesce(a.readingOrder, F.lit(1 << 30)) - F.coalesce(b.readingOrder, F.lit(1 << 30)))).alias("_b", "b"))
    own = F.when(F.size("b.lines") > 0, F.transform("b.lines", lambda x: F.struct(x.text.alias("text"), x.bbox.alias("bbox")))).otherwise(F.transform(F.split(F.coalesce("b.content", F.lit("")), "\n"), lambda t: F.struct(t.alias("text"), F.col("b.bbox").alias("bbox"))))
    rows = block.select("file", "page_num", "_b", F.col("b.id").alias("block"), F.posexplode(own).alias("_l", "l"))
    number = F.row_number().over(Window.partitionBy("file", "page_num").orderBy("_b", "_l"))
    rows = rows.select("file", "page_num", number.alias("line_num"), "block", "l.text", "l.bbox", F.lit(None).cast("string").alias("error"))
    return rows.unionByName(bad, allowMissingColumns=True)


def nearest_block(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """The block of each line of a page: that which covers most of it, ties the smaller, then the earlier; where none
    does, the nearest. Boxes are arrays of left, top, right, bottom."""
    side = lambda f, i: f(F.col("l.bbox")[i], F.col("b.bbox")[i])
    both = lines.alias("l").join(blocks.alias("b"), [F.col("l.file") == F.col("b.file"), F.col("l.page_num") == F.col("b.page_num")])
    width = F.greatest(F.lit(0.0), side(F.least, 2) - side(F.greatest, 0))
    height = F.greatest(F.lit(0.0), side(F.least, 3) - side(F.greatest, 1))
    area = lambda a: (F.col(f"{a}.bbox")[2] - F.col(f"{a}.bbox")[0]) * (F.col(f"{a}.bbox")[3] - F.col(f"{a}.bbox")[1])
    gap = lambda lo, hi: F.greatest(F.lit(0.0), F.col("b.bbox")[lo] - F.col("l.bbox")[hi], F.col("l.bbox")[lo] - F.col("b.bbox")[hi])
    cover = F.coalesce(F.try_divide(width * height, area("l")), F.lit(0.0))
    key = F.struct(cover.alias("cover"), (-(gap(0, 2) + gap(1, 3))).alias("near"), (-area("b")).alias("size"), (-F.col("b.ord")).alias("ord"))
    return both.groupBy(F.col("l.file").alias("file"), F.col("l.page_num").alias("page_num"), F.col("l.line_num").alias("line_num")).agg(F.max_by("b.block", key).alias("block"))


def records(lines: DataFrame) -> DataFrame:
    """(file, record): JSON of each document with its lines in order, pages, and quality summary; nulls are left out."""
    line = F.struct("page_num", "line_num", *(c for c in ("text", "categ", "quality_score", "lang") if c in lines.columns))
    body = lines.groupBy("file").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    rows = body.join(quality_summary(lines), "file")
    return rows.select("file", F.to_json(F.struct(F.lit("2.0").alias("schema_version"), F.col("file").alias("doc_id"), "lines", F.struct("mean", "median", "min", "max", "pages", "by_categ").alias("quality_summary"))).alias("record"))


def merged(parts: DataFrame, keys: list[str], order: str, first: list[str] = ()) -> DataFrame:
    """Parts of a record folded in order: of each field the last value that is not null, for ``first`` the first."""
    fields = [c for c in parts.columns if c not in (*keys, order)]
    pick = lambda c: (F.min_by if c in first else F.max_by)(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return parts.groupBy(*keys).agg(*(pick(c).alias(c) for c in fields))


#: How an input's origin begins, and what a record calls it; what a record says of a line's source; engines.
ORIGINS = {"digital": "digital", "docx": "digital", "pdf": "digital", "abbyy": "legacy", "alto": "legacy", "ocr:": "atr", "vlm:": "atr", "atr": "atr", "legacy": "legacy"}
TEXT_SOURCES = {"digital": "text-layer", "atr": "atr", "legacy": "legacy"}
ENGINES = {
    r"(abbyy|fine\s*reader)": "ABBYY-ALTO", r"tesseract\b": "ocr:tesseract", r"pero\b": "ocr:pero", r"kraken\b": "ocr:kraken", r"transkribus\b": "ocr:transkribus",
    r"escriptorium\b": "ocr:escriptorium", r"ocr-?d\b": "ocr:ocrd", r"calamari\b": "ocr:calamari",
}
#: How far two measures of a page's side may differ, in points and as a share.
SIDE_POINTS, SIDE_SHARE = 2.0, 0.01


def record_origin(origin):
    """digital, atr or legacy, by how an origin begins whatever its case; null where nothing fits."""
    folded = F.lower(F.trim(origin))
    return F.coalesce(*(F.when(folded.startswith(k), F.lit(v)) for k, v in ORIGINS.items()))


def producer_origin(names):
    """The origin of the first engine known among the names (array) that a file gives of its software, else null."""
    seen = lambda k: F.exists(names, lambda n: F.coalesce(F.lower(n).rlike(rf"\b{k}"), F.lit(False)))
    return F.coalesce(*(F.when(seen(k), F.lit(v)) for k, v in ENGINES.items()))


def line_source(origin):
    return F.coalesce(*(F.when(origin == k, F.lit(v)) for k, v in TEXT_SOURCES.items()))


def page_rows(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """A row for each of a document's (file, page_count) pages: text where the page has a line, else empty. Line numbers of
    pages beyond the count give no row; see ``foreign_pages``."""
    pages = documents.where("page_count > 0").select("file", F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page_num"))
    n = lines.groupBy("file", "page_num").agg(F.count("*").alias("n_lines"))
    rows = pages.join(n, ["file", "page_num"], "left")
    return rows.select("file", "page_num", F.when(F.col("n_lines") > 0, "text").otherwise("empty").alias("content_status"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def foreign_pages(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows (file, page_num) of pages that their document does not have; null page numbers are not checked."""
    return rows.join(documents.select("file", "page_count"), "file").where("page_num is not null and not page_num between 1 and page_count").drop("page_count")


def page_texts(lines: DataFrame) -> DataFrame:
    """The text of each page, its lines in order, joined by line feeds; null lines are empty ones."""
    parts = F.array_sort(F.collect_list(F.struct("line_num", F.coalesce("text", F.lit("")).alias("t"))))
    return lines.groupBy("file", "page_num").agg(F.array_join(F.transform(parts, lambda x: x.t), "\n").alias("content"))


def key_problems(references: DataFrame, lines: DataFrame) -> DataFrame:
    """References (file, page_num, line_num, and more) to lines that their record does not have. Those without a line, and
    those of records without any line, are not checked."""
    keys = lines.select("file", "page_num", "line_num").distinct()
    named = references.where("line_num is not null").join(keys.select("file").distinct(), "file", "left_semi")
    return named.alias("r").join(keys.alias("k"), [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("file", "page_num", "line_num")], "left_anti")


def geometry_problems(pages: DataFrame, layer: DataFrame) -> DataFrame:
    """Pages (file, page_num, width, height, unit) that two sources measure differently, and in what: unit, width or height.
    A page that one of them lacks, or does not measure, is not checked."""
    a, b = pages.alias("a"), layer.alias("b")
    both = a.join(b, [F.col("a.file") == F.col("b.file"), F.col("a.page_num") == F.col("b.page_num")]).where("a.width > 0 and a.height > 0 and b.width > 0 and b.height > 0")
    far = lambda side: F.abs(F.col(f"a.{side}") - F.col(f"b.{side}")) > F.greatest(F.lit(SIDE_POINTS), F.greatest(f"a.{side}", f"b.{side}") * SIDE_SHARE)
    what = F.when(~F.col("a.unit").eqNullSafe(F.col("b.unit")), "unit").when(far("width"), "width").when(far("height"), "height")
    return both.select(F.col("a.file").alias("file"), F.col("a.page_num").alias("page_num"), what.alias("differs")).where("differs is not null")
