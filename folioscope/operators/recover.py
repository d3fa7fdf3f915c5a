"""How much of a line is words, or one known misreading away from words: evidence on tokens, and a score of lines.

Tokens are looked up once each, however often they occur: their candidates come from joins with the strong part of the lexicon, and lines join the
tokens' status. Tables that several joins read are kept in the shared folder: lines are cut into tokens once for each use of their occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import signals as s
from folioscope.operators import lexicon
from folioscope.operators.ordered import checkpointed

#: Documents that make a token attested, letters below which a token is not looked up; letters and shapes that are taken for each other.
STRONG_DF, LEAST_LETTERS = 10, 4
GLYPHS = (("i", "j"), ("i", "l"), ("i", "1"), ("l", "1"), ("o", "0"), ("s", "5"), ("b", "6"), ("g", "9"), ("b", "8"), ("z", "2"), ("u", "v"), ("c", "e"), ("f", "t"), ("h", "b"), ("m", "n"))
SHAPES = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("li", "h"), ("nn", "m"), ("ri", "n"), ("lt", "h"), ("ss", "ß"))
CONFUSIONS = tuple((x, y) for a, b in GLYPHS + SHAPES for x, y in ((a, b), (b, a)))


def candidates(tokens: DataFrame, strong: DataFrame) -> DataFrame:
    """(token, candidate, df, mechanism) for distinct tokens (token) and the strong lexicon (token, df): *diacritics* where the token is the candidate
    without its marks, *confusion* where one misread letter or shape, or a doubled first letter, is put right, else *edit1*."""
    folds = strong.select(F.expr(s.folded("token")).alias("token"), F.col("token").alias("candidate"), "df").where("token <> candidate")
    found = tokens.join(folds, "token").withColumn("m", F.lit(0))
    found = found.unionByName(lexicon.confused(tokens, strong, CONFUSIONS).withColumn("m", F.lit(1)))
    doubled = tokens.where("length(token) > 1 and substr(token, 1, 1) = substr(token, 2, 1)").select("token", F.expr("substr(token, 2)").alias("candidate"))
    found = found.unionByName(doubled.join(strong.select(F.col("token").alias("candidate"), "df"), "candidate").select("token", "candidate", "df", F.lit(1).alias("m")))
    found = found.unionByName(lexicon.neighbours(tokens, strong).withColumn("m", F.lit(2)))
    best = found.groupBy("token", "candidate", "df").agg(F.min("m").alias("m"))
    return best.select("token", "candidate", "df", F.element_at(F.array(F.lit("diacritics"), F.lit("confusion"), F.lit("edit1")), F.col("m") + 1).alias("mechanism"))


def judged(tokens: DataFrame, table: DataFrame, strong_df: int = STRONG_DF, least: int = LEAST_LETTERS) -> tuple[DataFrame, DataFrame]:
    """The distinct tokens of ``tokens`` (token) with ``status``, attested, recoverable or unattested, by a lexicon ``table`` (token, df); and the candidates
    of those that are not attested. Tokens of fewer letters than ``least`` are left out; null ones are."""
    strong = table.where(F.col("df") >= strong_df)
    distinct = tokens.where(F.length(F.regexp_replace("token", r"\P{L}", "")) >= least).select("token").distinct()
    known = checkpointed(distinct.join(strong.select("token").distinct().withColumn("_s", F.lit(True)), "token", "left"))
    found = candidates(known.where("_s is null").select("token"), strong)
    some = found.select("token").distinct().withColumn("_c", F.lit(True))
    status = F.when(F.col("_s"), "attested").when(F.col("_c"), "recoverable").otherwise("unattested")
    return known.join(some, "token", "left").select("token", status.alias("status")), found


def nearest_attested(found: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent candidates of each token, ties by spelling, with their rank."""
    place = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("df"), "candidate"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def recoverability(tokens: DataFrame, table: DataFrame, keys: list[str], kinds: DataFrame | None = None, **how) -> DataFrame:
    """(keys..., tokens, attested, recoverable, score) of lines with a token (keys..., token, repeats and all) that can be looked up: the score is the share of
    tokens that are attested or recoverable. Lines without one have no row; a score of 0 is no verdict. ``kinds`` (token) holds all tokens of the
    lines, and may hold more, where the caller has them: a lexicon of the same lines, say."""
    status, _ = judged(tokens.select("token") if kinds is None else kinds, table, **how)
    rows = tokens.join(status.hint("shuffle_hash"), "token").groupBy(*keys)  # a row a token, where the lines would have to be sorted
    count = lambda k: F.count_if(F.col("status") == k).alias(k)
    return rows.agg(F.count("*").alias("tokens"), count("attested"), count("recoverable")).withColumn("score", (F.col("attested") + F.col("recoverable")) / F.col("tokens"))


def status_report(tokens: DataFrame, table: DataFrame, by: str, **how) -> DataFrame:
    """(by, status, tokens, kinds, share): occurrences and different tokens of each status by a column, such as the category of their line."""
    counts = checkpointed(tokens.groupBy(by, "token").agg(F.count("*").alias("n")))
    status, _ = judged(counts.select("token"), table, **how)
    rows = counts.join(status, "token").groupBy(by, "status").agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds"))
    return rows.withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy(by)))  # three rows a value
