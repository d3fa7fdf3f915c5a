import json

from folioscope.operators import record
from folioscope.streaming.ingest import ingest


def test_layout_and_blocks(spark):
    doc = {"version": "1", "pages": [{"pageNumber": 1, "blocks": [{"id": "b", "readingOrder": 2, "content": "x\ny", "bbox": [0, 10, 10, 20]}, {"id": "a", "readingOrder": 1, "bbox": [0, 0, 10, 10], "lines": [{"text": "t", "bbox": [0, 1, 5, 2]}]}]}]}
    rows = record.layout_lines(spark.createDataFrame([("d", json.dumps(doc)), ("e", "{bad")], "file string, json string"))
    got = sorted(((r.file, r.line_num or 0, r.block, r.text, r.error is None) for r in rows.collect()), key=str)
    assert got == [("d", 1, "a", "t", True), ("d", 2, "b", "x", True), ("d", 3, "b", "y", True), ("e", 0, None, None, False)]
    lines = spark.createDataFrame([("d", 1, 1, [0.0, 11.0, 5.0, 12.0]), ("d", 1, 2, [0.0, 40.0, 5.0, 41.0])], "file string, page_num int, line_num int, bbox array<double>")
    blocks = spark.createDataFrame([("d", 1, "a", 1, [0.0, 0.0, 10.0, 10.0]), ("d", 1, "b", 2, [0.0, 10.0, 10.0, 20.0])], "file string, page_num int, block string, ord int, bbox array<double>")
    assert [r.block for r in record.nearest_block(lines, blocks).orderBy("line_num").collect()] == ["b", "b"]


def test_records_and_merge(spark):
    rows = spark.createDataFrame([("d", 1, 2, "b", "Clear", 0.9), ("d", 1, 1, "a", "Trash", 0.1)], "file string, page_num int, line_num int, text string, categ string, quality_score double")
    got = json.loads(record.records(rows).first().record)
    assert [x["text"] for x in got["lines"]] == ["a", "b"] and got["quality_summary"]["by_categ"] == {"Clear": 1, "Trash": 1}
    parts = spark.createDataFrame([("d", 1, "x", "s1"), ("d", 2, None, "s2")], "file string, o int, v string, source string")
    assert tuple(record.merged(parts, ["file"], "o", ["source"]).first()) == ("d", "x", "s1")


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text('{"doc_id": "1", "text": "Pohled na zámek\\nod jihu a severu"}\n')
    for expected in (2, 2, 3):
        if expected == 3:
            (source / "b.json").write_text('{"doc_id": "2", "text": "Druhý dokument je tady"}\n')
        ingest(spark, str(source), target, str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(target).count() == expected
