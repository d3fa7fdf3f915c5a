"""Scores at a decimal tie are rounded as the SQL of the queries on order rounds them."""

import duckdb

from folioscope import queries as q, queries_changes as qc


def test_tie(spark, tmp_path):
    near = "a" * 75 + "####" + "#"  # 0.625 less 0.05: the binary product with 100 lies below 57.5
    text = "\n".join(["b" * 40, "c" * 41, near, "d" * 42, near, "", near])
    spark.createDataFrame([(1, text, "en", "web"), (2, near + "\n" + text, "en", "web")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    own = sorted((r.file, r.page_num, r.severity, r.score) for r in qc._severe(spark, str(tmp_path)).collect())
    assert own == sorted(db.sql(qc._SEVERE + "select * from x").fetchall())
    assert any(r[3] == 0.57 for r in own)
    for name in ("concordance", "monotonicity"):
        rel = db.sql(q.oracle_sql()[name])
        assert sorted(tuple(r[c] for c in rel.columns) for r in q.queries()[name](spark, str(tmp_path)).collect()) == sorted(rel.fetchall())
