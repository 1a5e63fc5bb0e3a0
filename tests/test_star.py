"""Every query over the star-schema tables against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__
from claimforge.plans import scenes, star  # noqa: F401  scenes adds its queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", star.QUERIES)
def test_query_matches_sql(spark, db, name):
    df = star.QUERIES[name](spark, SF)
    rel = db.sql(star.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    want = Counter(tuple(r[rel.columns.index(c)] for c in columns) for r in rel.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
