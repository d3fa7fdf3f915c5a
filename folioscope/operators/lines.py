"""The line table: documents to pages to lines, joined across line ends.

Row identity is (file, page_num, line_num), line_num from 1 on each page. Order is carried by these columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAGE_LINES = 40


def explode_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", page_lines: int = PAGE_LINES) -> DataFrame:
    """Lines of each text, with the other columns of ``docs``; a form feed or ``page_lines`` lines end a page.

    A null text gives no lines, an empty text one empty line.
    """
    rest = [c for c in docs.columns if c not in (id_column, text)]
    # one plain character is found without a pattern
    cut = lambda s: F.when(F.contains(s, F.lit("\r")), F.split(s, "\r\n|\r|\n", -1)).otherwise(F.split(s, "\n", -1))
    sheets = F.transform(F.split(F.col(text), "\f", -1), cut)
    # each sheet with the number of pages before it
    numbered = F.aggregate(
        sheets,
        F.struct(F.lit(0).alias("pages"), F.array().cast("array<struct<before:int,lines:array<string>>>").alias("sheets")),
        lambda s, x: F.struct((s.pages + F.ceil(F.size(x) / page_lines).cast("int")).alias("pages"), F.concat(s.sheets, F.array(F.struct(s.pages.alias("before"), x.alias("lines")))).alias("sheets")),
        lambda s: s.sheets,
    )
    numbered = F.when(F.contains(F.col(text), F.lit("\f")), numbered).otherwise(F.array(F.struct(F.lit(0).alias("before"), cut(F.col(text)).alias("lines"))))
    pages = docs.select(F.col(id_column).cast("string").alias("file"), *rest, F.explode(numbered).alias("_sheet"))
    lines = pages.select("file", *rest, F.col("_sheet.before").alias("_before"), F.posexplode("_sheet.lines").alias("_i", "text"))
    return lines.select("file", (F.col("_before") + F.floor(F.col("_i") / page_lines) + 1).cast("int").alias("page_num"), (F.col("_i") % page_lines + 1).cast("int").alias("line_num"), "text", *rest)


def _page():
    return Window.partitionBy("file", "page_num").orderBy("line_num")


def split_braces(lines: DataFrame) -> DataFrame:
    """``prefix- {whole}`` at a line's end becomes the whole word (split_ws: its prefix); the rest of the word, where the
    next line of the page starts with it, goes there (split_we)."""
    mark = r"(\S+)(?:-|\x{ad})\s*\{([^}]+)\}"
    last = lambda k: F.coalesce(F.try_element_at(F.regexp_extract_all("text", F.lit(mark), F.lit(k)), F.lit(-1)), F.lit(""))
    rows = lines.withColumns({"_whole": last(2), "split_ws": last(1)})
    rows = rows.withColumn("_tail", F.when(F.expr("_whole <> '' and startswith(_whole, split_ws)"), F.expr("substr(_whole, length(split_ws) + 1)")).otherwise(""))
    rows = rows.withColumn("text", F.regexp_replace(F.trim("text"), mark, "$2"))
    rows = rows.withColumn("_before", F.coalesce(F.lag("_tail").over(_page()), F.lit("")))
    cut = F.expr("_before <> '' and startswith(text, _before)")
    return rows.withColumn("split_we", F.when(cut, F.col("_before")).otherwise("")).withColumn("text", F.when(cut, F.trim(F.expr("substr(text, length(_before) + 1)"))).otherwise(F.col("text"))).drop("_whole", "_tail", "_before")


def join_hyphens(lines: DataFrame) -> DataFrame:
    """Lines that end in a hyphen are joined to the next, along chains of any length; the first line's number stays."""
    open_ = F.col("text").rlike(r"\p{L}-$")
    rows = lines.withColumn("_open", open_).withColumn("_group", F.coalesce(F.sum((~F.col("_open")).cast("int")).over(_page().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("line_num", F.when(F.col("_open"), F.expr("substr(text, 1, length(text) - 1)")).otherwise(F.col("text")).alias("t"))))
    return rows.groupBy("file", "page_num", "_group").agg(F.min("line_num").alias("line_num"), F.array_join(F.transform(parts, lambda x: x.t), "").alias("text"), F.count("*").alias("n_joined")).drop("_group")


def shape(lines: DataFrame, width: int = 1000) -> DataFrame:
    """Blank lines dropped, white space collapsed, long lines wrapped at spaces; ``piece`` counts from 1."""
    rows = lines.withColumn("text", F.trim(F.regexp_replace("text", r"[\p{Z}\s]+", " "))).where("text <> ''")
    wrapped = F.regexp_extract_all("text", F.lit(rf"(\S{{{width}}}|.{{1,{width}}}(?= |$))"), F.lit(1))
    rows = rows.select("*", F.posexplode(wrapped).alias("_p", "_t"))
    return rows.withColumns({"text": F.trim("_t"), "piece": F.col("_p") + 1}).drop("_p", "_t")


def decade(file: str = "file"):
    """Decade from an id such as CTX197501234, null without a year."""
    return F.floor(F.nullif(F.regexp_extract(F.col(file), r"^[A-Za-z]{2,4}(\d{4})", 1), F.lit("")).cast("int") / 10) * 10


def natural_key(label: str):
    """Sort key: numeric labels by value, then the others as text."""
    number = F.expr(f"try_cast({label} as bigint)")
    return F.struct(number.isNull().alias("other"), number.alias("number"), F.col(label).alias("label"))
