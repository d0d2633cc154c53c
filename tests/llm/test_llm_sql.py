"""The SQL of those queries that have one, run by DuckDB on the same tables."""

import pytest

from almanac.llm.queries import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equals_sql(spark, key):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = db.execute(ORACLE[key])
    columns = [c[0] for c in want.description]
    got = QUERIES[key](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_vector_sql_links(spark, tmp_path):
    """The given vectors have no links at this size: the same SQL on a table that has."""
    import numpy as np
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(60, 16)), 5, axis=0) + rng.normal(size=(300, 16)) * rng.choice([0.02, 0.12], 300)[:, None]
    rows = [(i, [float(c) for c in v], None if i % 31 == 0 else i % 10 // 5) for i, v in enumerate(x)] + [(400, None, 1), (401, [0.0] * 16, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = db.execute(ORACLE["op13_embedding_near_dedup"]).fetchall()
    got = [tuple(r) for r in QUERIES["op13_embedding_near_dedup"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and sum(r[1] for r in want) > 300
