"""Order-independent document fingerprints by a homomorphic multiset hash (operator 7).

A text is the multiset of its paragraph pieces (lines, cut after sentence ends). Every piece is hashed to a wide
vector, and the fingerprint is the sum of the vectors modulo a power of two: it does not depend on the order of the
pieces, and pieces are inserted or deleted by adding or subtracting their vectors. The vector has

    1 word    that counts pieces,
    4 words   of 62 hash bits, modulo 2**62, for equality,
    62 words  of two packed 31-bit counters, each adding one hash bit; bits read as signs make the sums a sketch of the
              multiset (124 random projections) whose distances estimate those of the multisets.

Likeness of fingerprints is 1 - |x - y|**2 / (|x|**2 + |y|**2) of the sketches, cut to 0..1: the shared part of the
pieces for like sizes, about 0 (plus or minus 0.09) for unrelated texts.

All steps are SQL functions. Every fingerprint is computed once, and stored without its text. The next document is
found on ids alone, within ranges of them; the first of each range is looked up from the range before it. Of the next
document only the characters that are wanted travel, to the row that wants them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, stored, table

MOD = (1 << 62) - 1
EQUAL_WORDS = 4
SKETCH_HASHES = 2
LANE_BITS = 31
_LANES = 1 | 1 << LANE_BITS
WIDTH = 1 + EQUAL_WORDS + SKETCH_HASHES * LANE_BITS

#: Boundaries of paragraph pieces.
CUT = r"\\n|(?<=[.!?])[ \\t]+"


def pieces(text: str) -> str:
    return f"split(coalesce({text}, ''), '{CUT}', -1)"


def _vector(p: str) -> str:
    """SQL array of the words of a piece's vector."""
    words = ", ".join(f"xxhash64({p}, {k}) & {MOD}L" for k in range(EQUAL_WORDS))
    sketch = ", ".join(f"transform(sequence(0, {LANE_BITS - 1}), j -> shiftrightunsigned(h{k}, j) & {_LANES}L)" for k in range(SKETCH_HASHES))
    body = f"concat(array(1L, {words}), {sketch})"
    for k in range(SKETCH_HASHES):
        body = f"element_at(transform(array(xxhash64({p}, {100 + k})), h{k} -> {body}), 1)"
    return body


def fingerprint(array: str) -> str:
    """SQL array of longs: the sum over an array of pieces; empty pieces count for nothing."""
    return f"aggregate(filter({array}, p -> p <> ''), array_repeat(0L, {WIDTH}), (s, p) -> zip_with(s, {_vector('p')}, (a, b) -> (a + b) & {MOD}L))"


def insert(fp: str, more: str) -> str:
    return f"zip_with({fp}, {more}, (a, b) -> (a + b) & {MOD}L)"


def delete(fp: str, less: str) -> str:
    return f"zip_with({fp}, {less}, (a, b) -> (a - b) & {MOD}L)"


def text_of(fp: str) -> str:
    return f"array_join(transform({fp}, v -> lpad(hex(v), 16, '0')), '')"


def _signs(fp: str) -> str:
    mask = (1 << LANE_BITS) - 1
    lanes = f"array(v & {mask}L, shiftright(v, {LANE_BITS}) & {mask}L)"
    return f"transform(flatten(transform(slice({fp}, {2 + EQUAL_WORDS}, {WIDTH}), v -> {lanes})), v -> cast(2 * v - {fp}[0] as double))"


def likeness(x: str, y: str) -> str:
    """SQL double 0..1 from two fingerprint arrays; two empty multisets are alike."""
    square = lambda a: f"aggregate({a}, 0D, (t, v) -> t + v * v)"
    far = f"{square('zip_with(q.x, q.y, (a, b) -> a - b)')} / nullif({square('q.x')} + {square('q.y')}, 0D)"
    return f"element_at(transform(array(named_struct('x', {_signs(x)}, 'y', {_signs(y)})), q -> greatest(0D, least(1D, 1D - coalesce({far}, 0D)))), 1)"


#: The order of documents: by doc_id, null first, and of one doc_id by text hash.
ORDER = ("named", "doc_id", "tie")


def followers(places: DataFrame) -> DataFrame:
    """``places`` (named, doc_id, tie, n_chars), distinct, with the struct ``next`` (named, doc_id, tie) of the place after
    each, the first after the last."""
    ranged = places.repartitionByRange(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), *ORDER)
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    inner = Window.partitionBy("range").orderBy(*ORDER)
    place = F.struct(*ORDER)
    rows = ranged.withColumn("next", F.lead(place).over(inner))
    ends = ranged.groupBy("range").agg(F.min(place).alias("first"))
    # one row for each range: their number is that of partitions
    over, whole = Window.orderBy("range"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("range", F.coalesce(F.lead("first").over(over), F.first("first").over(whole)).alias("after"))
    return rows.join(F.broadcast(ends), "range").select(*ORDER, "n_chars", F.coalesce("next", "after").alias("next"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited (the text with its last quarter replaced by the start of
    the next document), and the arrays fp, fp_edited and fp_next.

    A null text is empty. The next document is that of the next larger doc_id; a null doc_id comes first; texts that share a
    doc_id follow each other in the order of a hash, and rows that repeat both are one document, so each gets the same
    result. The one document of a table follows itself. Long texts are read whole; extra columns are ignored; an empty table
    gives no rows.
    """
    docs = columns(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    prints = stored(docs.select(*ORDER, F.length("text").alias("n_chars"), F.expr(fingerprint(pieces("text"))).alias("fp")), "fingerprints")
    places = prints.select(*ORDER, "n_chars").dropDuplicates(list(ORDER))
    links = stored(followers(places), "followers")
    of = links.select(F.col("next.named").alias("named"), F.col("next.doc_id").alias("doc_id"), F.col("next.tie").alias("tie"), F.struct(*ORDER).alias("of"), "n_chars")
    once = prints.dropDuplicates(list(ORDER)).drop("n_chars")
    heads = docs.join(of, list(ORDER)).join(once, list(ORDER))
    heads = heads.select("of.named", "of.doc_id", "of.tie", F.expr("substr(text, 1, cast(n_chars div 4 as int))").alias("head"), F.col("fp").alias("fp_next"))
    heads = heads.dropDuplicates(list(ORDER))
    rows = docs.join(heads, list(ORDER)).join(once, list(ORDER))
    rows = rows.withColumn("n_chars", F.length("text")).withColumn("stay", F.expr("substr(text, 1, n_chars - n_chars div 4)"))
    rows = rows.withColumn("edited", F.concat("stay", "head"))
    # the pieces before the last cut of what stays are the same in both texts
    rows = rows.withColumn("same", F.expr(f"size({pieces('stay')}) - 1"))
    tail = lambda text: f"slice({pieces(text)}, same + 1, n_chars + 1)"
    rows = rows.withColumn("fp_edited", F.expr(insert(delete("fp", fingerprint(tail("text"))), fingerprint(tail("edited")))))
    return rows.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited", "fp", "fp_edited", "fp_next")


def op7_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row of documents: the fingerprint, that of the edited text, and their likenesses.

    The edited text's fingerprint is the text's with the pieces of its end deleted and those of the new end inserted.
    """
    return fingerprinted(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.expr(text_of("fp")).alias("fingerprint"),
        F.expr(text_of("fp_edited")).alias("edited_fingerprint"),
        F.expr(likeness("fp", "fp_edited")).alias("near_edited"),
        F.expr(likeness("fp", "fp_next")).alias("near_next"),
    )
