"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as entry  # noqa: E402
from scripts.oracle_check import TABLES, table_hash  # noqa: E402

from aerosift.plans import catalog, oracle  # noqa: E402

NAMES = sorted(catalog.REGISTRY)     # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_position_query_has_an_oracle():
    assert set(oracle.QUERIES) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    os_ = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    od = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    assert table_hash([tuple(r[i] for i in os_) for r in s_rows]) == \
        table_hash([tuple(r[i] for i in od) for r in d_rows])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 15
    assert "icao24" in df.columns


@pytest.mark.parametrize("name", ["fact_positions", "traffic_in_air_sliding", "source_freshness", "kpis"])
def test_results_do_not_depend_on_session_zone(spark, name):
    q = entry.queries()[name]
    utc = q(spark, SF_SMALL).collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")   # UTC+05:45
    try:
        other = q(spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(map(tuple, utc), key=repr) == sorted(map(tuple, other), key=repr)
