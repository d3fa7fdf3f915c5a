"""Paragraphs by gaps, counts of elements and leaves, and sketches, against plain Python."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from folioscope.operators import layout_stats as ls, sketches as sk


def test_paragraphs(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for d in range(30):
        y, boxes = 0, []
        for i in range(rng.randint(1, 25)):
            h = rng.choice([3, 4, 6, 8, 10, 11]) if d % 5 else rng.choice([1, 2, 5])
            y += rng.choice([0, 2, 5, 14, 18, 40]) if rng.random() < 0.9 else -60
            boxes.append(None if rng.random() < 0.1 else [0.0, float(y), 5.0, float(y + h)])
            y += h
        heights = [b[3] - b[1] for b in boxes if b]
        valid = [h for h in heights if h > 5] or heights
        m, p, before = statistics.median(valid) if valid else 10, 1, None
        for i, b in enumerate(boxes):
            gap = b[1] - before[3] if b and before and i else None
            p += gap is not None and (gap < -m or gap > 1.5 * m)
            want[f"d{d}", i] = (gap, p)
            rows.append((f"d{d}", 1, i, f"t{i}", b))
            before = b
    df = spark.createDataFrame(rows, "file string, page_num int, line_num int, text string, bbox array<double>")
    assert {(r.file, r.line_num): (r.gap, r.paragraph) for r in ls.paragraph_breaks(df).collect()} == want
    texts = {(r.file, r.paragraph): r.text for r in ls.paragraph_texts(df).collect()}
    assert texts["d0", 1].split("\n") == [f"t{i}" for i in range(sum(k[0] == "d0" and v[1] == 1 for k, v in want.items()))]
    assert ls.paragraph_breaks(df.limit(0)).count() == 0


def test_scaled_boxes(spark):
    df = spark.createDataFrame([([0.25, -5.0, 300.0, 1e6], 500.0, 400.0), ([1.0] * 4, 0.0, 5.0), (None, 5.0, 5.0)], "b array<double>, w double, h double")
    assert [r[0] for r in df.select(ls.scaled_box(F.col("b"), F.col("w"), F.col("h"))).collect()] == [[0, 0, 600, 1000], None, None]  # 0.5 goes to 0


def test_elements(spark):
    xml = "<a:alto><Page><!-- <TextLine> --><TextLine/><TextLine x='1'><a:String/><String CONTENT='<b'/></TextLine><TextLines/><![CDATA[<String/>]]><Illustration></Page>"
    df = spark.createDataFrame([(1, xml), (2, None), (3, ""), (4, "<p>a<P class=x><script>'<p>'</script><style><p></style>")], "id int, t string")
    got = {(r.id, r.element): r.n for r in ls.element_counts(df, ["id"], "t").collect()}
    assert got[4, "p"] == 2 and (4, "script") not in got and got[1, "textline"] == 2 and not [k for k in got if k[0] in (2, 3)]
    assert [tuple(r) for r in ls.alto_counts(df, ["id"], "t").orderBy("id").collect()][:2] == [(1, 2, 1, 0, 2), (2, 0, 0, 0, 0)]


def leaves(v, path=""):
    if isinstance(v, dict) or isinstance(v, list):
        for k, x in v.items() if isinstance(v, dict) else enumerate(v):
            yield from leaves(x, f"{path}.{k}" if path else str(k))
    else:
        yield path, "null" if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"


def test_json_leaves(spark):
    values = [{"a": [1, "x", None, {"b": True, "c": []}], "d": {"e": {"f": "y"}}}, [], {}, "bare", 5, None, [[["z"]]], {"k": "1"}]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(90, "{broken"), (91, None), (92, "")]
    got = sorted((r.id, r.path, r.kind) for r in ls.json_leaves(spark.createDataFrame(rows, "id int, j string"), ["id"], "j").collect())
    assert got == sorted((i, p, k) for i, v in enumerate(values) for p, k in leaves(v))
    with pytest.raises(ValueError):
        ls.json_leaves(spark.createDataFrame([(1, "[" * 9 + "]" * 9)], "id int, j string"), ["id"], "j", most=4)


def test_sketches(spark):
    rows = spark.range(200_000).selectExpr("cast(id % 3 as string) as c", "cast(id % 50 as string) as p", "concat('v', id % 20011) as d", "if(id % 97 = 0, null, pow(id % 1009, 2)) as x").cache()
    pages = sk.sketched(rows, ["c", "p"], "d", "x")
    merged = {r.c: r for r in sk.estimated(sk.merged(pages, ["c"])).collect()}
    once = {r.c: r for r in sk.estimated(sk.sketched(rows, ["c"], "d", "x")).collect()}
    for c, want in {r.c: r for r in rows.groupBy("c").agg(F.count("*").alias("n"), F.countDistinct("d").alias("k")).collect()}.items():
        for got in (merged[c], once[c]):
            assert got.n == want.n and abs(got.distinct / want.k - 1) < 0.06
            for q in (5, 25, 50, 75, 95):  # the rank of the estimate is near the point
                below = rows.where(F.col("c") == c).where(F.col("x") <= got[f"q{q:02d}"]).count() / rows.where(F.col("c") == c).where("x is not null").count()
                assert abs(below - q / 100) < 0.03
    # the distinct sketch of merged pages is that of one pass
    assert {c: r.distinct for c, r in merged.items()} == pytest.approx({c: r.distinct for c, r in once.items()}, rel=0.02)
    none = sk.estimated(sk.sketched(rows.where("x is null").withColumn("d", F.lit(None).cast("string")), ["c"], "d", "x")).first()
    assert none.distinct == 0 and none.q50 is None
