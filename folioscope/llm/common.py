"""Session helpers of the corpus operators: tables, shared checkpoints, partition counts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word rule: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only where the session has none (tests, one machine) is one made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="folioscope-"))
    return sc.getCheckpointDir()


#: Folders that ``stored`` has written in this process, in order.
WRITTEN: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``stored`` has written, once nothing reads them any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        WRITTEN.remove(path)


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate of the size of ``df``: the files' bytes for a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame, each: int, least: int = 8, most: int = 1_000_000) -> int:
    """As many partitions as give each about ``each`` bytes of the stored input."""
    size = input_bytes(df)
    if size >= 1 << 60:  # no estimate
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return int(min(most, max(least, -(-size // each))))


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns, cast to the types; other columns, of whatever name, stay out."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in wanted.items()))


def packed(df: DataFrame, **more) -> DataFrame:
    """``df`` as one struct column ``row`` beside the columns ``more``, so that no name of a user's column clashes."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(v.alias(k) for k, v in more.items()))


def unpacked(rows: DataFrame, names: list[str], **new) -> DataFrame:
    """The columns ``names`` of ``row``, those in ``new`` replaced."""
    return rows.select(*(new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in names))
