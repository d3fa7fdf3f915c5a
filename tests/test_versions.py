"""Versions that appear at once, files that stay when their rows do, and runs that are killed."""

import os
import time

import pytest
from pyspark.sql import functions as F

from folioscope.operators.scoring import process
from folioscope.operators.lines import explode_lines
from folioscope.plans import manifest, versions
from folioscope.plans.versions import Write, current, publish, vacuum


def times(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


SCHEMA = "k string, v int, x array<int>"


def test_rerun_leaves_files_alone(spark, tmp_path):
    target = f"{tmp_path}/t"
    df = spark.createDataFrame([(f"k{i % 40}", i, [i]) for i in range(200)] + [(None, 1, None), (None, 1, None)], SCHEMA)
    one = publish(spark, target, {"a": Write(df, ["k"])}, buckets=8)
    assert one.number == 1 and rows(one.table(spark, "a").na.fill("")) == rows(df.na.fill(""))
    was = times(target)
    again = publish(spark, target, {"a": Write(df.orderBy(F.rand(1)), ["k"])})
    assert again.number == 1 and times(target) == was
    two = publish(spark, target, {"a": Write(df.withColumn("v", F.expr("if(k = 'k3', v + 1, v)")), ["k"])})
    now = times(target)
    kept = {f for f in was if f in now and now[f] == was[f]}
    assert two.number == 2 and kept == set(was) and 1 <= len(set(now) - set(was)) <= 8
    same = [k for k, e in two.tables["a"]["entries"].items() if e == one.tables["a"]["entries"].get(k)]
    assert len(same) == len(one.tables["a"]["entries"]) - 1
    assert rows(one.table(spark, "a").where("k = 'k3'")) != rows(two.table(spark, "a").where("k = 'k3'"))


def test_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/t"
    old = spark.createDataFrame([("a", 1, None)], SCHEMA)
    publish(spark, target, {"a": Write(old, ["k"]), "b": Write(old, ["k"])}, buckets=4)
    bad = old.select("k", F.expr("cast(raise_error('no') as int)").alias("v"), "x")
    with pytest.raises(Exception):
        publish(spark, target, {"a": Write(bad, ["k"])})

    def killed(*_):
        raise KeyboardInterrupt

    new = spark.createDataFrame([("b", 2, [1])], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(versions, "_write_once", killed)
        with pytest.raises(KeyboardInterrupt):
            publish(spark, target, {"a": Write(new, ["k"])})
    now = current(spark, target)
    assert now.number == 1 and rows(now.table(spark, "a")) == [("a", 1, None)]
    publish(spark, target, {"a": Write(new, ["k"])})
    assert rows(current(spark, target).table(spark, "a")) == [("b", 2, [1])] and rows(current(spark, target).table(spark, "b")) == [("a", 1, None)]
    gone = vacuum(spark, target, keep=1)
    assert any(g.startswith("data/") for g in gone) and "versions/00000001.json" in gone
    assert rows(current(spark, target).table(spark, "a")) == [("b", 2, [1])] and rows(current(spark, target).table(spark, "b")) == [("a", 1, None)]


def test_conflict_empty_and_shape(spark, tmp_path):
    target = f"{tmp_path}/t"
    df = spark.createDataFrame([("a", 1, None)], SCHEMA)
    base = current(spark, target)
    assert base.number == 0
    publish(spark, target, {"a": Write(df, ["k"])}, buckets=2)
    with pytest.raises(versions.Conflict):
        publish(spark, target, {"a": Write(df.withColumn("v", F.lit(5)), ["k"])}, base)
    none = publish(spark, target, {"a": Write(df.limit(0), ["k"])})
    assert none.table(spark, "a").count() == 0 and none.table(spark, "a").columns == ["k", "v", "x"]
    wider = publish(spark, target, {"a": Write(df.withColumn("y", F.lit("z")), ["k"])})
    assert rows(wider.table(spark, "a")) == [("a", 1, None, "z")]
    with pytest.raises(ValueError):
        publish(spark, target, {"a": Write(df.withColumnRenamed("v", "bucket"), ["k"])})


def put(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")


def test_refresh_does_only_what_changed(spark, tmp_path):
    source, target = tmp_path / "in", f"{tmp_path}/out"
    put(source, {f"d{i}.txt": f"Line {i} of the text.\nAnother one, číslo {i}." for i in range(8)} | {"sub/d0.txt": "Below.\n", "empty.txt": ""})
    asked = []

    def score(files):
        asked.append(sorted(r.path for r in files.collect()))
        return manifest.text_scorer(spark)(files)

    one = manifest.refresh(spark, str(source), target, score, buckets=8)
    assert len(asked[-1]) == 9 and one.number == 1 and one.table(spark, "inputs").count() == 9
    was = times(target)
    two = manifest.refresh(spark, str(source), target, score)
    assert two.number == 1 and asked[-1] == [] and times(target) == was
    time.sleep(0.01)
    put(source, {"d1.txt": "Changed now.", "new.txt": "A new file."})
    put(source, {"d2.txt": (source / "d2.txt").read_text()})  # same bytes, new time
    os.utime(source / "d2.txt", (1, 1))
    (source / "d3.txt").unlink()
    three = manifest.refresh(spark, str(source), target, score)
    assert asked[-1] == ["d1.txt", "new.txt"] and three.number == 2
    whole = spark.read.option("recursiveFileLookup", "true").text(str(source), wholetext=True).select(F.col("value").alias("text"), F.regexp_replace(F.col("_metadata.file_path"), "^.*/in/", "").alias("doc_id"))
    want = process(explode_lines(whole)).select("file", "page_num", "line_num", "text", "categ")
    assert rows(three.table(spark, "lines").select("path", "page_num", "line_num", "text", "categ").where("text <> ''")) == rows(want.where("text <> ''"))
    paths = {r.path for r in three.table(spark, "lines").select("path").distinct().collect()}
    assert "d3.txt" not in paths and "new.txt" in paths and "sub/d0.txt" in paths
    kept = [f for f in was if f in times(target) and times(target)[f] == was[f]]
    assert len(kept) == len(was)
    assert manifest.refresh(spark, str(source), target, score, settings="other").number == 3 and len(asked[-1]) == 9


def test_refresh_survives_a_kill(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", f"{tmp_path}/out"
    put(source, {"a.txt": "One line.", "b.txt": "Two lines.\nOf text."})
    score = manifest.text_scorer(spark)
    manifest.refresh(spark, str(source), target, score, buckets=4)
    put(source, {"a.txt": "Another line now."})

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "_write_once", killed)
        with pytest.raises(KeyboardInterrupt):
            manifest.refresh(spark, str(source), target, score)
    assert {r.text for r in current(spark, target).table(spark, "lines").collect()} == {"One line.", "Two lines.", "Of text."}
    manifest.refresh(spark, str(source), target, score)
    assert {r.text for r in current(spark, target).table(spark, "lines").collect()} == {"Another line now.", "Two lines.", "Of text."}


def test_decisions_resume(spark, tmp_path):
    lines = spark.createDataFrame([("d", i // 5, i % 5, f"t{i}") for i in range(40)] + [(None, None, 1, "n")], "file string, page_num int, line_num int, text string")
    asked = []

    def answer(part, fail=False):
        asked.append(part.count())
        if fail and len(asked) == 3:
            raise RuntimeError("away")
        return part.withColumn("answer", F.upper("text"))

    with pytest.raises(RuntimeError):
        manifest.decide(spark, lines, f"{tmp_path}/t", lambda p: answer(p, True), buckets=4)
    done = current(spark, f"{tmp_path}/t").table(spark, "decisions").count()
    assert 0 < done < 41
    asked.clear()
    v = manifest.decide(spark, lines, f"{tmp_path}/t", answer)
    assert sum(asked) == 41 - done and v.table(spark, "decisions").count() == 41
    assert manifest.undecided(lines, v.table(spark, "decisions")).count() == 0


def test_differences(spark):
    s = "path string, modified timestamp, size long, digest string"
    t = lambda n: __import__("datetime").datetime(2024, 1, 1, 0, 0, n)
    old = spark.createDataFrame([("a", t(1), 1, "x"), ("b", t(1), 1, "x"), ("c", t(1), 1, "x"), ("d", t(1), 1, "x"), (None, t(1), 1, "x")], s)
    new = spark.createDataFrame([("a", t(1), 1, "f"), ("b", t(2), 1, "f"), ("c", t(2), 2, "f"), ("e", t(2), 2, "f"), ("e", t(3), 2, "f"), (None, t(1), 1, "f")], s.replace("digest", "file"))
    assert {r.path: r.state for r in manifest.differences(old, new).collect()} == {"a": "same", "b": "unsure", "c": "changed", "d": "gone", "e": "new"}
