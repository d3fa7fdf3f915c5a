"""Tables in versions: what is written is staged, and readers see it when its version file appears, last and at once.

``target/data/<write>/<table>/bucket=<k>`` holds the files of a write, ``target/versions/<number>.json`` names the folders of all buckets
of all tables. Rows go to buckets by a hash of their key. A bucket whose rows are those of the version before keeps its old
folder, untouched, and its new one is dropped; so a rerun that changes nothing leaves every file and time as it is, and later
stages can tell by file times what is new. A write that fails or is killed leaves folders that no version names; ``vacuum`` removes
them. Two writers cannot make the same version: the second one's file is refused.

The driver reads and writes one small entry for each bucket; rows stay on executors. Paths may be of any file system that Spark knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer has made the version that this one was to be."""


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole, and only if there is none: written beside, then renamed."""
    fs, at = _path(spark, path)
    _, beside = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at) or not fs.rename(beside, at):
        fs.delete(beside, False)
        raise Conflict(path)


def _read(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file


@dataclass
class Version:
    """Number, and by table its schema, key, number of buckets and entries: bucket to (folder, rows, digest)."""

    target: str
    number: int = 0
    tables: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        t = self.tables[name]
        schema = StructType.fromJson(t["schema"])
        folders = sorted(f"{self.target}/{e[0]}" for e in t["entries"].values())
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def buckets(self, spark: SparkSession, name: str, which: set[int]) -> DataFrame:
        """The rows of some buckets only."""
        t = self.tables[name]
        part = {"entries": {k: e for k, e in t["entries"].items() if int(k) in which}, "schema": t["schema"]}
        return Version(self.target, tables={name: part}).table(spark, name)


def current(spark: SparkSession, target: str) -> Version:
    """The last version of ``target``; number 0, without tables, where there is none."""
    fs, at = _path(spark, f"{target}/versions")
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    numbers = sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())
    if not numbers:
        return Version(target)
    d = json.loads(_read(spark, f"{target}/versions/{numbers[-1]:08d}.json"))
    return Version(target, numbers[-1], d["tables"], d["notes"])


def bucket_of(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


@dataclass
class Write:
    """A table to be staged: its rows, their key, and, for a change of some buckets only, which; the others stay as they are. Rows may be a
    function of the tables staged before it in the same write, by name: what is costly is then computed once."""

    rows: DataFrame | Callable[[dict[str, DataFrame]], DataFrame]
    key: list[str]
    only: set[int] | None = None


def staged(spark: SparkSession, base: Version, name: str, write: Write, folder: str, buckets: int = BUCKETS) -> dict:
    """Writes the rows and gives the table's description in the next version. An order-free digest of each bucket's rows, the sums
    of two hashes of every row, tells whether it has changed."""
    old = base.tables.get(name)
    n = old["buckets"] if old else buckets
    names, schema = write.rows.columns, write.rows.schema
    if "bucket" in names:
        raise ValueError("a column may not be called bucket")
    path = f"{folder}/{name}"
    write.rows.withColumn("bucket", bucket_of(write.key, n)).repartition(n, "bucket").write.partitionBy("bucket").parquet(f"{base.target}/{path}")
    again = spark.read.schema(StructType([*schema.fields, StructField("bucket", IntegerType())])).parquet(f"{base.target}/{path}")
    digest = [F.sum(F.xxhash64(F.lit(seed), *names).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    found = {}
    for r in again.groupBy("bucket").agg(F.count("*").alias("n"), digest[0].alias("a"), digest[1].alias("b")).collect():  # one row a bucket
        found[str(r.bucket)] = [f"{path}/bucket={r.bucket}", r.n, f"{r.n}:{r.a}:{r.b}"]
    same_shape = old is not None and StructType.fromJson(old["schema"]).simpleString() == schema.simpleString()
    entries = {}
    for k, e in found.items():
        if same_shape and k in old["entries"] and old["entries"][k][2] == e[2]:
            fs, at = _path(spark, f"{base.target}/{e[0]}")
            fs.delete(at, True)
            e = old["entries"][k]
        entries[k] = e
    if write.only is not None and old is not None:
        if not same_shape:
            raise ValueError(f"{name}: a change of some buckets has to keep the columns")
        entries |= {k: e for k, e in old["entries"].items() if int(k) not in write.only}
    return {"schema": json.loads(schema.json()), "key": write.key, "buckets": n, "entries": entries}


def publish(spark: SparkSession, target: str, writes: dict[str, Write], base: Version | None = None, notes: dict | None = None, buckets: int = BUCKETS) -> Version:
    """The next version of ``target``: the tables of ``writes`` as they are now, others as they were in ``base`` (the last one).

    Where nothing differs, the version there is stays. Repeated rows are rows of their own, null keys have a bucket, an empty table is one without
    folders.
    """
    base = base or current(spark, target)
    folder = f"data/{base.number + 1:08d}-{uuid.uuid4().hex}"
    tables, ready = dict(base.tables), {}
    for name, w in writes.items():
        rows = w.rows(ready) if callable(w.rows) else w.rows
        tables[name] = staged(spark, base, name, Write(rows, w.key, w.only), folder, buckets)
        ready[name] = Version(target, tables=tables).table(spark, name)
    if base.number and tables == base.tables and (notes is None or notes == base.notes):
        fs, at = _path(spark, f"{target}/{folder}")
        fs.delete(at, True)
        return base
    version = Version(target, base.number + 1, tables, base.notes if notes is None else notes)
    fs, at = _path(spark, f"{target}/versions")
    fs.mkdirs(at)
    _write_once(spark, f"{target}/versions/{version.number:08d}.json", json.dumps({"tables": tables, "notes": version.notes}))
    return version


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Removes versions before the last ``keep``, and folders that none of those left names; gives what it removed. Not to be run beside a
    writer."""
    fs, at = _path(spark, f"{target}/versions")
    files = sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []
    versions = [f for f in files if f.endswith(".json")]
    gone = [f"versions/{f}" for f in files if f not in versions[-keep:]]
    named = {e[0] for f in versions[-keep:] for t in json.loads(_read(spark, f"{target}/versions/{f}"))["tables"].values() for e in t["entries"].values()}
    _, data = _path(spark, f"{target}/data")
    for write in fs.listStatus(data) if fs.exists(data) else []:
        at_write = f"data/{write.getPath().getName()}"
        if not any(n.startswith(f"{at_write}/") for n in named):
            gone.append(at_write)
            continue
        for table in fs.listStatus(write.getPath()):
            for bucket in fs.listStatus(table.getPath()) if table.isDirectory() else []:
                path = f"{at_write}/{table.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and path not in named:
                    gone.append(path)
    for path in gone:
        fs_, p = _path(spark, f"{target}/{path}")
        fs_.delete(p, True)
    return gone
