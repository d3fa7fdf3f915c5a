"""Running sums over a whole table in a given order, with no task that holds all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only where no cluster is (a local master, as in tests) is one made; elsewhere a folder of this
    machine would be lost on others, so its lack is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if path is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="folioscope-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back. Spark removes the files with the frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """``df`` with two columns for each of ``sums``: its sum over the row and all before it in ``order``, and as NAME_all over
    all rows. ``order`` has to tell rows apart; nulls come first.

    Ranges of the order go to tasks and are written once, so that a lost task cannot move their bounds; then sums within
    each range are raised by those of the ranges before it, one row a range. Null sums count as 0.
    """
    names = df.columns
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))).alias("key"), F.struct(*(F.coalesce(v, F.lit(0)).alias(f"s{i}") for i, v in enumerate(sums.values()))).alias("sum"))
    ranged = checkpointed(rows.repartitionByRange("key").withColumn("range", F.spark_partition_id()))
    at = range(len(sums))
    before, every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranges = ranged.groupBy("range").agg(*(F.sum(f"sum.s{i}").alias(f"t{i}") for i in at))
    ranges = ranges.select("range", *(F.coalesce(F.sum(f"t{i}").over(before), F.lit(0)).alias(f"b{i}") for i in at), *(F.sum(f"t{i}").over(every).alias(f"a{i}") for i in at))
    within = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.select("row", "range", *(F.sum(f"sum.s{i}").over(within).alias(f"w{i}") for i in at)).join(F.broadcast(ranges), "range")
    return out.select(*(F.col("row").getField(c).alias(c) for c in names), *(c for i, n in enumerate(sums) for c in ((F.col(f"w{i}") + F.col(f"b{i}")).alias(n), F.col(f"a{i}").alias(f"{n}_all"))))
