"""Incremental ingest: new files under a folder become scored lines, each file once.

The file source remembers what it has read in its checkpoint; ``availableNow`` takes what is there and stops. A batch
replaces the partition of its own number, so a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.lines import explode_lines
from folioscope.operators.scoring import process
from folioscope.params import DEFAULT, Params

SCHEMA = "doc_id string, text string"


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, p: Params = DEFAULT, trigger: dict | None = None):
    """Streams JSON documents (doc_id, text) from ``source`` into the scored line table at ``target``; returns the query."""
    docs = spark.readStream.schema(SCHEMA).json(source)

    def write(batch: DataFrame, epoch: int) -> None:
        rows = process(explode_lines(batch), p).select("file", "page_num", "line_num", "text", "categ", "reason", "quality_score")
        rows.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(target)

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
