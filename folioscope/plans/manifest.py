"""Incremental work by the state of the inputs: what is new, changed or gone, and a job that redoes only that.

A manifest is a table of inputs (path, modified, size, digest) of the last finished run. It is a table of the same version as the outputs, so that
both change at once: a run that is killed leaves the old manifest with the old outputs, and the next run finds the same work.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.lines import explode_lines
from folioscope.operators.ordered import checkpointed
from folioscope.operators.scoring import process
from folioscope.params import DEFAULT, Params
from folioscope.plans.versions import Version, Write, bucket_of, current, publish


def listing(spark: SparkSession, source: str, glob: str = "*") -> DataFrame:
    """(path, modified, size, file) of the files below ``source``, without reading them; path is below it, file is where to read it. Files
    without a byte are not listed: they hold no line, and what held one before is gone."""
    root = re.sub(r"^[a-z0-9]+:/*", "/", source.rstrip("/")) + "/"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(source)
    below = F.regexp_replace("path", r"^[a-z0-9]+:/*", "/")
    return files.select(F.substr(below, F.lit(len(root) + 1)).alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"), F.col("path").alias("file"))


def differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` and what has gone, by path, with ``state``: new, same (time and size are), unsure (only the time differs), changed (the
    size does), gone. A path that repeats counts once, at its latest time; a null path is left out."""
    last = lambda df: df.where("path is not null").groupBy("path").agg(F.max(F.struct(*(c for c in ("modified", "size", "digest", "file") if c in df.columns))).alias("r"))
    both = last(old).select("path", F.col("r").alias("o")).join(last(new).select("path", F.col("r").alias("n")), "path", "full_outer")
    same_time = F.col("o.modified").eqNullSafe(F.col("n.modified"))
    same_size = F.col("o.size").eqNullSafe(F.col("n.size"))
    state = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "gone").when(same_time & same_size, "same").when(same_size, "unsure").otherwise("changed")
    found = [F.col("n.file").alias("file")] if "file" in new.columns else []
    return both.select("path", F.coalesce("n.modified", "o.modified").alias("modified"), F.coalesce("n.size", "o.size").alias("size"), F.col("o.digest").alias("old_digest"), *found, state.alias("state"))


def contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, content) of files (path, file). Their names go through the driver, as in any list of files that Spark is to read."""
    names = [r.file for r in files.select("file").toLocalIterator()]
    if not names:
        return spark.createDataFrame([], "path string, content binary")
    return files.join(spark.read.format("binaryFile").load(names).select(F.col("path").alias("file"), "content"), "file").select("path", "content")


def work(spark: SparkSession, old: DataFrame | None, source: str, glob: str = "*") -> DataFrame:
    """The differences between the manifest ``old`` and ``source``, with the digests (SHA-256) of all that is there. Only files that are
    new, changed or unsure are read; an unsure one with the bytes it had is the same. Without a manifest the whole folder is read."""
    found = listing(spark, source, glob)
    digest = F.sha2("content", 256).alias("digest")
    if old is None:
        read = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(source)
        return found.join(read.select(F.col("path").alias("file"), digest), "file").withColumns({"old_digest": F.lit(None).cast("string"), "state": F.lit("new")})
    d = checkpointed(differences(old, found))
    read = contents(spark, d.where("state in ('new', 'changed', 'unsure')")).select("path", digest)
    d = d.join(read, "path", "left").withColumn("digest", F.coalesce("digest", "old_digest"))
    return d.withColumn("state", F.when(F.col("state") == "unsure", F.when(F.col("digest") == F.col("old_digest"), "same").otherwise("changed")).otherwise(F.col("state")))


def text_scorer(spark: SparkSession, p: Params = DEFAULT) -> Callable[[DataFrame], DataFrame]:
    """Scores plain text files: their lines with categories; ``file`` and ``path`` are the path."""

    def score(files: DataFrame) -> DataFrame:
        docs = contents(spark, files).select(F.col("path").alias("doc_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
        rows = process(explode_lines(docs), p)
        return rows.select(F.col("file").alias("path"), "page_num", "line_num", "text", "categ", "reason", "quality_score")

    return score


def refresh(spark: SparkSession, source: str, target: str, score: Callable[[DataFrame], DataFrame], glob: str = "*", buckets: int = 64, settings: str = "") -> Version:
    """Brings the table ``lines`` of ``target`` up to date with the files of ``source``: those that are new or changed are scored, lines of
    changed and vanished ones go, all others stay, their files untouched.

    ``score`` takes (path, file) of the files to be read and gives rows with the column ``path``. Other ``settings`` than those
    of the last version make everything be done again.
    """
    base = current(spark, target)
    fresh = not base.number or base.notes.get("settings") != settings
    old = None if fresh else base.table(spark, "inputs")
    todo = checkpointed(work(spark, old, source, glob))
    rows = score(todo.where("state in ('new', 'changed')").select("path", "file"))
    inputs = todo.where("state <> 'gone'").select("path", "modified", "size", "digest")
    if fresh:
        writes = {"lines": Write(rows, ["path"]), "inputs": Write(inputs, ["path"])}
    else:
        n = base.tables["lines"]["buckets"]
        hit = {r.b for r in todo.where("state <> 'same'").select(bucket_of(["path"], n).alias("b")).distinct().collect()}  # buckets
        if not hit:  # new times of unchanged files are noted; nothing else is
            return publish(spark, target, {"inputs": Write(inputs, ["path"])}, base)
        kept = base.buckets(spark, "lines", hit).join(todo.where("state <> 'same'").select("path"), "path", "left_anti")
        writes = {"lines": Write(kept.unionByName(rows.select(*kept.columns)), ["path"], hit), "inputs": Write(inputs, ["path"])}
    return publish(spark, target, writes, base, {"settings": settings}, buckets)


def undecided(lines: DataFrame, decided: DataFrame, *also: str) -> DataFrame:
    """Lines whose key (file, page_num, line_num), and columns of ``also``, no decided line has; null is a value like any other."""
    keys = ["file", "page_num", "line_num", *also]
    a, b = lines.alias("a"), decided.select(*keys).distinct().alias("b")
    return a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys], "left_anti")


def decide(spark: SparkSession, lines: DataFrame, target: str, answer: Callable[[DataFrame], DataFrame], steps: int = 4, buckets: int = 64) -> Version:
    """Answers the lines that the table ``decisions`` of ``target`` lacks, and commits after each of ``steps`` parts of them: what a killed run
    has committed is not asked again."""
    base, key = current(spark, target), ["file", "page_num", "line_num"]
    n = base.tables["decisions"]["buckets"] if "decisions" in base.tables else buckets
    for k in range(steps):
        mine = {b for b in range(n) if b % steps == k}
        part = lines.where(bucket_of(key, n) % steps == k)
        done = base.buckets(spark, "decisions", mine) if "decisions" in base.tables else None
        new = answer(part if done is None else undecided(part, done))
        rows = new if done is None else done.unionByName(new.select(*done.columns))
        base = publish(spark, target, {"decisions": Write(rows, key, mine)}, base, buckets=n)
    return base
