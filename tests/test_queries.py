"""Every query of the library runs on the small tables and gives the rows of its SQL."""

import math
from pathlib import Path

import duckdb
import pytest

from lodestone.plans import queries as plans

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.7g}"
    return str(v)


@pytest.fixture(scope="module")
def db(small):
    c = duckdb.connect()
    for t in NAMES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_same_rows_as_sql(spark, small, db, name):
    df = plans.QUERIES[name](spark, small)
    sql = db.sql(plans.ORACLE[name])
    assert sorted(df.columns) == sorted(sql.columns)
    order = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    at = [sql.columns.index(c) for c in order]
    theirs = sorted(tuple(plain(r[k]) for k in at) for r in sql.fetchall())
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__ as entry

    if Path("/root/testdata/sf0.001").exists():
        assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
