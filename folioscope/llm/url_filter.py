"""URL filter by a ratio of character language models (operator 11), in SQL functions only.

Rules of host and path decide some URLs; the accepted and the rejected ones are the text of two variable-order Markov models
of characters, which judge the others. For each class, a character c after a context of k - 1 characters has

    P_k(c) = (n(context c) + t(context) * P_{k-1}(c)) / (n(context) + t(context))

where t is the number of distinct characters seen after the context; a context that the class has not seen leaves P_{k-1}, so
the order varies with what is known. P_0 is uniform over ``ALPHABET``. A URL's value is the mean over its characters of
ln P(accepted) - ln P(rejected); a logistic curve turns it into the probability of being accepted. The curve is fitted, classes
weighted alike, on a fold of the ruled URLs that the counts do not use.

Only the longest windows are counted, once for every distinct URL with its number of rows; shorter ones are sums of
those. All windows of all URLs stand in one table with their counts (0 where the classes have none), so that
their probabilities come from joins of that table's own levels, and URLs join it once. The table grows with the URLs. The driver
sees a histogram of values of at most 2 * (2 * BINS + 1) rows. Sums are of integers, billionths of a nat, so reruns agree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WRITTEN, forget, packed, stored, table, unpacked

#: (verdict, host and start of path), as the contract has them.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Characters of a window, the last of which is predicted.
ORDER = 5
ALPHABET = 256
#: Values are told apart by hundredths of a nat for the curve, up to this number of them on each side.
BINS = 2000
FOLDS = 5
_START, _END = "\x02", "\x03"
_NANO = 1e9


def parts(url: str = "url") -> dict[str, Column]:
    """host, path and judged (host and all that follows it) of a column of URLs; empty where it is null or has no ``://``."""
    rest = F.expr(f"case when instr({url}, '://') > 0 then substring({url}, instr({url}, '://') + 3) else '' end")
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "judged": F.concat(host, F.substr(rest, F.length(raw) + 1))}


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as text; null where none does."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, start = rule.partition("/")[::2]
        out = F.when(((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{start}")), rule).otherwise(out)
    return out


def verdict_of(rule: Column, rules=RULES) -> Column:
    return F.coalesce(*(F.when(rule == r, v) for v, r in rules), F.lit(None).cast("string"))


def _key(judged: Column) -> list[Column]:
    return [F.xxhash64(judged).alias("k1"), F.xxhash64(F.lit(11), judged).alias("k2")]


def urls_of(pages: DataFrame, rules=RULES) -> DataFrame:
    """Distinct (judged, verdict or null) of ``pages`` (url) with rows n, a 128-bit key and the fold."""
    p = parts()
    rows = pages.select(p["judged"].alias("judged"), verdict_of(rule_of(p["host"], p["path"], rules), rules).alias("label"))
    rows = rows.groupBy("judged", "label").agg(F.count("*").alias("n"))
    return rows.select("judged", "label", "n", *_key(F.col("judged")), F.pmod(F.xxhash64(F.lit(5), "judged"), F.lit(FOLDS)).alias("fold"))


def windows(urls: DataFrame, *keep: str) -> DataFrame:
    """One row for each character of ``urls`` and its end, as the window g of ORDER characters that ends there."""
    padded = F.concat(F.lit(_START * (ORDER - 1)), "judged", F.lit(_END))
    rows = urls.select(*keep, F.split(padded, "").alias("c"))
    at = ", ".join(f"c[i - {k}]" for k in range(ORDER - 1, -1, -1))
    return rows.select(*keep, F.explode(F.expr(f"transform(sequence({ORDER - 1}, size(c) - 1), i -> concat({at}))")).alias("g"))


def counted(urls: DataFrame) -> DataFrame:
    """Every window with its occurrences in accepted (a) and rejected (b) URLs outside of fold 0."""
    of = lambda label: F.sum(F.when((F.col("label") == label) & (F.col("fold") > 0), F.col("n")).otherwise(0))
    return windows(urls, "label", "fold", "n").groupBy("g").agg(of("allow").alias("a"), of("block").alias("b"))


def gains(counts: DataFrame) -> DataFrame:
    """(g, gain): for each window, ln P(accepted) - ln P(rejected) of its last character, in billionths."""
    levels = [counts]
    for _ in range(ORDER - 1):
        levels.append(levels[-1].groupBy(F.substring("g", 2, ORDER).alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    below = None
    for level in reversed(levels):
        context = Window.partitionBy(F.expr("left(g, length(g) - 1)"))
        rows = level.select("g", F.expr("substring(g, 2)").alias("s"), *(x for c in "ab" for x in (F.col(c), F.sum(c).over(context).alias(f"n{c}"), F.count_if(F.col(c) > 0).over(context).alias(f"t{c}"))))
        if below is None:
            rows = rows.withColumns({"pa": F.lit(1.0 / ALPHABET), "pb": F.lit(1.0 / ALPHABET)})
        else:
            rows = rows.join(below.select(F.col("g").alias("s"), "pa", "pb"), "s")
        p = {f"p{c}": F.when(F.col(f"n{c}") == 0, F.col(f"p{c}")).otherwise((F.col(c) + F.col(f"t{c}") * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}"))) for c in "ab"}
        below = rows.select("g", *(v.alias(k) for k, v in p.items()))
    return below.select("g", F.round((F.ln("pa") - F.ln("pb")) * _NANO).cast("long").alias("gain"))


def valued(urls: DataFrame, gain: DataFrame) -> DataFrame:
    """(k1, k2, value): the mean gain of each URL's windows."""
    sums = windows(urls, "k1", "k2").join(gain, "g").groupBy("k1", "k2").agg(F.sum("gain").alias("s"), F.count("*").alias("m"))
    return sums.select("k1", "k2", (F.col("s") / F.col("m") / _NANO).alias("value"))


def curve(histogram: list[tuple[int, str, int]], steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve over values, from (bin, label, n). Without both classes, or where the
    values do not tell them apart in the right direction, the plain curve (1, 0)."""
    x = np.array([b for b, _, _ in histogram], float) / 100
    y = np.array([label == "allow" for _, label, _ in histogram], float)
    n = np.array([n for _, _, n in histogram], float)
    if not (n * y).sum() or not (n * (1 - y)).sum():
        return 1.0, 0.0
    w = n * np.where(y == 1, 0.5 / (n * y).sum(), 0.5 / (n * (1 - y)).sum())
    f, theta = np.stack([x, np.ones(len(x))], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(f @ theta, -30, 30)))
        h = (f * (w * p * (1 - p))[:, None]).T @ f + 1e-4 * np.eye(2)
        theta += np.clip(np.linalg.solve(h, f.T @ (w * (y - p)) - 1e-4 * theta), -2, 2)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (1.0, 0.0)


def _judged(pages: DataFrame, rules) -> tuple[DataFrame, list[str]]:
    """(k1, k2, score) of each distinct URL, and the folders that it reads."""
    before = len(WRITTEN)
    urls = stored(urls_of(pages, rules), "urls")
    gain = stored(gains(stored(counted(urls), "windows")), "gains")
    values = stored(valued(urls, gain), "values")
    held = urls.where("fold = 0 and label is not null").join(values, ["k1", "k2"])
    bins = held.groupBy(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.round(F.col("value") * 100))).cast("int").alias("bin"), "label").agg(F.sum("n").alias("n")).collect()
    slope, offset = curve(sorted((r.bin, r.label, r.n) for r in bins))
    path = WRITTEN[-1]
    forget(pages.sparkSession, [p for p in WRITTEN[before:] if p != path])
    return values.select("k1", "k2", (1 / (1 + F.exp(-(F.lit(slope) * F.col("value") + offset)))).alias("score")), [path]


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: its columns as ``row``, with host, path, rule, verdict and score.

    A URL that is null or has no ``://`` has an empty host and path, fits no rule, and is judged as the empty string. Rules
    fit a host and all its subdomains, case of A to Z aside, where the path starts with theirs (a path's case counts); of
    several the longest decides. Other URLs are allowed from a score of 0.5. Without a ruled URL of either class the score is 0.5, or
    that of the class there is. Repeated rows are judged, and counted, each; long URLs are read whole; other columns may have any name; an empty
    table gives no rows.
    """
    scores, _ = _judged(pages.select(F.col("url").cast("string").alias("url")), rules)
    rows = packed(pages, url=F.col("url").cast("string"))
    p = parts()
    rows = rows.select("row", p["host"].alias("host"), p["path"].alias("path"), *_key(p["judged"]))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).join(scores, ["k1", "k2"])
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return rows.select("row", "host", "path", "rule", verdict.alias("verdict"), "score")


def keep_allowed(pages: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns."""
    return unpacked(judge(pages, rules).where("verdict = 'allow'"), pages.columns)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
