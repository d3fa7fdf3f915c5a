"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from folioscope import queries as q

DATA = Path("/root/testdata/sf0.001")


def values(rows, columns):
    show = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{float(v):.6f}" if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)
    return sorted(tuple(show(r[columns.index(c)]) for c in sorted(columns)) for r in rows)


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query(spark, name):
    db = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations", "events", "benchmark", "embeddings"):
        p = DATA / f"{t}.parquet"
        db.sql(f"create view {t} as select * from '{p}/*.parquet'" if p.is_dir() else f"create view {t} as select * from '{p}'")
    df = q.queries()[name](spark, str(DATA))
    rel = db.sql(q.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert values([tuple(r) for r in df.collect()], df.columns) == values(rel.fetchall(), rel.columns)
