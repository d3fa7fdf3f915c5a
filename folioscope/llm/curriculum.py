"""Mixing sources to target weights along a time-varying curriculum (operator 4).

Every source has a weight that ramps linearly over training time t in [0, 1]; its integral is the source's weight.
Targets share all words by these weights, none above ``CAP`` times its source (water-filling, in closed form).
The documents of a source form a stream in hash order, repeated as often as the target needs; a copy whose
words begin at a share x of the target is due at the time when the integral of the ramp reaches x. All sources' ramps
times their targets, integrated up to that time, are the words demanded before it: the copy's training position, a place
in the stream of all words. The documents are range-sorted by it.

Cumulative sums are taken in two levels, over hash buckets of a source and within a bucket, so that no task holds a
source. Only the table of sources is ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, packed, partitions_for, stored, table, unpacked

CAP = 3
WEIGHTS = (1, 2, 3)
#: Relative slopes of the ramps, by rank of the source: weight(t) = w * (1 + a * (2t - 1)).
RAMPS = (-0.5, 0.0, 0.5)
BUCKET_BYTES = 8 << 20
_HASH_BITS = 60


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row``, with doc_id, source, _size (words; null text: 0), _hash and _tie, by which a source's documents are
    ordered."""
    return packed(
        docs,
        doc_id=F.col("doc_id").cast("long"),
        source=F.col("source").cast("string"),
        _size=F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"),
        _hash=F.conv(F.substring(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.md5("text"))), 1, 15), 16, 10).cast("long"),
        _tie=F.xxhash64("text"),
    )


def targets(sizes: DataFrame, cap: int = CAP, weights=WEIGHTS, ramps=RAMPS) -> DataFrame:
    """Per source of (_none, _name, _source_size): _target, _ramp, and the sums _demand and _slope of all sources, of the
    targets and of targets times ramps. Sources by code point, null last."""
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))
    rank = F.row_number().over(Window.orderBy("_none", "_name")) - 1
    s = sizes.withColumn("_rank", rank)
    s = s.withColumns({"_w": pick(weights, F.col("_rank")), "_ramp": pick([float(r) for r in ramps], F.col("_rank"))})
    s = s.withColumn("_limit", F.lit(cap) * F.col("_source_size") / F.col("_w"))
    order = Window.orderBy("_limit", "_rank")
    capped = F.coalesce(F.sum("_source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap
    s = s.withColumn("_level", (F.sum("_source_size").over(Window.partitionBy()) - capped) / F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    level = F.coalesce(F.max(F.when(F.col("_limit") >= F.col("_level"), F.col("_level"))).over(Window.partitionBy()), F.lit(0.0))
    target = F.least(F.lit(float(cap)) * F.col("_source_size"), F.col("_w") * level)
    every = Window.partitionBy()
    s = s.withColumn("_target", target).withColumns({"_demand": F.sum("_target").over(every), "_slope": F.sum(F.col("_target") * F.col("_ramp")).over(every)})
    return s.select("_none", "_name", "_source_size", "_target", "_ramp", "_demand", "_slope")


def due(x, ramp):
    """The time at which the integral of 1 + a(2t - 1) from 0 reaches x."""
    return 2 * x / ((1 - ramp) + F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * x))


def position(share):
    """The words all sources have demanded by the time at which a row's source has a share of its target."""
    t = due(share, F.col("_ramp"))
    return F.col("_demand") * t + F.col("_slope") * (t * t - t)


def curriculum(docs: DataFrame, cap: int = CAP, weights=WEIGHTS, ramps=RAMPS, buckets: int | None = None) -> DataFrame:
    """``docs``, a result of ``measured``, with _source_size, _target, _taken and _position.

    _taken is the number of words the mix takes of the row, repeats counted: whole copies, but for one document of
    a source in which its target falls. _position is the place of the row's first copy in the stream of words,
    null where nothing is taken. The taken words of a source sum to its target, rounded down. Repeated rows are documents of their own.
    """
    bits = (buckets or partitions_for(docs, BUCKET_BYTES, 16) - 1).bit_length()
    keyed = docs.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce(F.col("source").cast("string"), F.lit("")), "_bucket": F.shiftright("_hash", _HASH_BITS - bits)})
    parts = stored(keyed.groupBy("_none", "_name", "_bucket").agg(F.sum("_size").alias("_words")), "sources")
    before = Window.partitionBy("_none", "_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts_at = parts.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    sources = targets(parts.groupBy("_none", "_name").agg(F.sum("_words").alias("_source_size")), cap, weights, ramps)
    placed = keyed.join(parts_at.drop("_words").join(sources, ["_none", "_name"]), ["_none", "_name", "_bucket"])
    inner = Window.partitionBy("_none", "_name", "_bucket").orderBy("_hash", "doc_id", "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_size").over(inner), F.lit(0))
    whole = F.floor("_target")
    placed = placed.withColumns({"_start": start, "_full": F.when(F.col("_source_size") > 0, F.floor(whole / F.col("_source_size"))).otherwise(0)})
    rest = F.greatest(F.least(whole - F.col("_full") * F.col("_source_size") - F.col("_start"), F.col("_size")), F.lit(0))
    placed = placed.withColumn("_taken", F.col("_full") * F.col("_size") + rest)
    return placed.withColumn("_position", F.when(F.col("_taken") > 0, position(F.col("_start") / F.col("_target"))))


def by_position(df: DataFrame, position: str = "_position") -> DataFrame:
    """Range-sorted by position; rows without one follow, spread by hash."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(position), 1 + F.col("_demand") + F.col("_hash") / F.lit(float(1 << _HASH_BITS)))
    return df.withColumn("_key", key).repartitionByRange(n, "_key").sortWithinPartitions("_key", "doc_id").drop("_key")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: every taken copy of every row of ``docs``, with the columns of ``docs``, in training order.

    The one document of a source in which its target falls gives the words up to there in its last copy. Rows of
    no words, null texts among them, are not taken. A null source is a source. Equal rows are ordered by chance, and are
    taken alike but for that document. Long texts are cut at words only; an empty table gives no rows.
    """
    rows = curriculum(measured(docs), **how)
    copies = F.sequence(F.lit(0), (F.ceil(F.col("_taken") / F.col("_size")) - 1).cast("int"))
    rows = rows.where("_taken > 0").withColumn("_copy", F.explode(copies))
    rows = rows.withColumn("_position", position((F.col("_start") + F.col("_copy") * F.col("_source_size")) / F.col("_target")))
    left = F.col("_taken") - F.col("_copy") * F.col("_size")
    text = F.col("row").getField("text")
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), 1, left.cast("int")), " ")
    rows = rows.withColumn("_text", F.when(left < F.col("_size"), words).otherwise(text))
    return unpacked(by_position(rows), docs.columns, text=F.col("_text"))


def op4_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of documents: doc_id, size, source_size, target, taken, position (null: not taken)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = curriculum(stored(measured(docs).drop("row"), "sizes"), buckets=partitions_for(docs, BUCKET_BYTES, 16))
    return by_position(rows).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), F.round("_position", 3).alias("position"))


ORACLE = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(concat_ws('|', doc_id::varchar, md5(text))), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (
  select *, rank % 3 + 1 as w, (rank % 3 - 1) * 0.5::double as ramp, 3 * source_size / (rank % 3 + 1) as lim from s),
l as (
  select *, ((sum(source_size) over ()) - 3 * coalesce(sum(source_size) over (order by lim, rank rows between unbounded preceding and 1 preceding), 0))::double
            / sum(w) over (order by lim, rank rows between current row and unbounded following) as level from w),
t as (
  select source, source_size, ramp, least(3.0::double * source_size, w * coalesce(max(case when lim >= level then level end) over (), 0)) as target from l),
e as (
  select *, sum(target) over () as demand, sum(target * ramp) over () as slope from t),
c as (
  select doc_id, size, source_size, target, ramp, demand, slope,
         coalesce(sum(size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
  from d join e t on d.source is not distinct from t.source),
f as (
  select *, case when source_size > 0 then floor(floor(target) / source_size) else 0 end as reps from c),
g as (
  select *, (reps * size + greatest(least(floor(target) - reps * source_size - start, size), 0))::bigint as taken, start / target as x from f),
h as (
  select *, 2 * x / ((1 - ramp) + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * x)) as due from g)
select doc_id, size, source_size, target, taken, case when taken > 0 then round(demand * due + slope * (due * due - due), 3) end as position
from h
"""
