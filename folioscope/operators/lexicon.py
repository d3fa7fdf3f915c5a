"""Token document frequencies and likely corrections of rare tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How optical recognition misreads letters, written form to meant form.
CONFUSIONS = (("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("li", "h"), ("1", "l"), ("l", "1"), ("0", "o"), ("o", "0"), ("c", "e"), ("e", "c"), ("u", "n"), ("n", "u"), ("vv", "w"), ("ii", "u"))


def tokens(lines: DataFrame, text: str = "text", min_letters: int = 2) -> DataFrame:
    """Lower-case letter runs of at least ``min_letters``, one row each, with the other columns."""
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(\p{{L}}{{{min_letters},}})"), F.lit(1))
    return lines.select(*(c for c in lines.columns if c != text), F.explode(found).alias("token"))


def document_frequency(tokens_: DataFrame, doc: str = "file", by: str | None = None) -> DataFrame:
    """Documents with each token; with ``by``, also per group, the total having a null group."""
    once = tokens_.select(doc, "token", *([by] if by else [])).distinct()
    if by is None:
        return once.groupBy("token").agg(F.count("*").alias("df"))
    return _with_totals(once.groupBy("token", by).agg(F.count("*").alias("df")), by)


def text_frequency(docs: DataFrame, doc: str = "doc_id", text: str = "text", by: str | None = None, min_letters: int = 2) -> DataFrame:
    """``document_frequency`` of the ``tokens`` of whole texts. Tokens are told apart within each row; only where an id repeats, which is looked up
    first, are they dealt by document to be told apart there."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(\p{{L}}{{{min_letters},}})"), F.lit(1)))
    rows = docs.select(F.col(doc).alias("file"), *([by] if by else []), F.explode(found).alias("token"))
    if not docs.groupBy(doc).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return document_frequency(rows, by=by)
    once = rows.groupBy("token", *([by] if by else [])).agg(F.count("*").alias("df"))
    return once if by is None else _with_totals(once, by)


def _with_totals(once: DataFrame, by: str) -> DataFrame:
    every = once.groupBy("token").agg(F.sum("df").alias("df"))
    return once.where("token is not null").unionByName(every.where("token is not null").withColumn(by, F.lit(None).cast(once.schema[by].dataType)))


def deletes(word: str) -> str:
    """SQL array of the word and all forms with one character taken out."""
    return f"array_distinct(concat(array({word}), transform(sequence(1, length({word})), i -> concat(substr({word}, 1, i - 1), substr({word}, i + 1)))))"


def neighbours(rare: DataFrame, lexicon: DataFrame, verify: bool = True) -> DataFrame:
    """Pairs (token, candidate) one edit apart, by an equi-join on one-character deletes, so no pair is tried twice. The deletes meet by their
    hashes where pairs are verified."""
    form = f"transform({deletes('token')}, x -> xxhash64(x))" if verify else deletes("token")
    a = rare.select("token", F.explode(F.expr(form)).alias("_k"))
    b = lexicon.select(F.col("token").alias("candidate"), "df", F.explode(F.expr(form)).alias("_k"))
    pairs = a.join(b, "_k").where("token <> candidate").select("token", "candidate", "df").distinct()
    return pairs.where(F.levenshtein("token", "candidate", 1) == 1) if verify else pairs


def confused(rare: DataFrame, lexicon: DataFrame, pairs=CONFUSIONS) -> DataFrame:
    """Candidates by one directed misreading. The misreadings are those of the lexicon, which is smaller than what is looked up in it."""
    table = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs))
    rows = lexicon.select(F.col("token").alias("candidate"), "df", F.explode(table).alias("c")).where("contains(candidate, c.b)")
    at = "filter(sequence(1, length(candidate) + 1), i -> i <= length(candidate) - length(c.b) + length(c.a) and substr(candidate, i, length(c.b)) = c.b)"
    rows = rows.select("candidate", "df", F.expr(f"explode(transform({at}, i -> concat(substr(candidate, 1, i - 1), c.a, substr(candidate, i + length(c.b)))))").alias("token"))
    return rows.where("token <> candidate").join(rare.select("token"), "token").select("token", "candidate", "df").distinct()


def nearest(candidates: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent candidates of each token, ties by spelling."""
    w = Window.partitionBy("token").orderBy(F.desc("df"), "candidate")
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def status(lexicon: DataFrame, candidates: DataFrame, min_df: int = 3, ratio: float = 10.0) -> DataFrame:
    """attested, recoverable (a candidate at least ``ratio`` times as frequent) or unattested, for each token."""
    best = candidates.groupBy("token").agg(F.max("df").alias("best"))
    rows = lexicon.join(best, "token", "left")
    return rows.withColumn("status", F.when(F.col("df") >= min_df, "attested").when(F.col("best") >= ratio * F.col("df"), "recoverable").otherwise("unattested"))


def family_key(text: str | Column) -> Column:
    """Letters, digits and underscores of a text, in lower case: what spellings of one line share."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]", "")


def families(lines: DataFrame, categ: str = "categ") -> DataFrame:
    """Spelling families: lines whose letters and digits agree without case, their variants and category mix A:n|B:m."""
    n = lines.withColumn("family", family_key("text")).where("family <> ''").groupBy("family", "text", categ).agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("family", "text").orderBy(categ)) == 1  # counts a text once; at most one row a category
    n = n.withColumn("v", first.cast("long")).groupBy("family", categ).agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    mix = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(categ).alias("c"), F.col("n").alias("n")))), lambda x: F.concat_ws(":", x.c, x.n.cast("string"))), "|")
    return n.groupBy("family").agg(F.sum("n").alias("lines"), F.sum("v").cast("int").alias("variants"), mix.alias("mix"))
