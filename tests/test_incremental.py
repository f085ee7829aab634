"""Exact incremental update == full rebuild, for several ways of splitting the input."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_SMALL

SPLITS = {
    "by_ingest_time": lambda: F.col("ingested_at") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"),
    "random_30pct_late": lambda: F.pmod(F.xxhash64("id"), F.lit(10)) >= 3,
    "two_pct_late": lambda: F.pmod(F.xxhash64("id"), F.lit(50)) != 0,
    "everything_new": lambda: F.lit(False),
}


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    from aerosift.plans.tables import build_tables
    from aerosift.sources.events_adapter import raw_positions

    root = str(tmp_path_factory.mktemp("full"))
    build_tables(spark, raw_positions(spark, SF_SMALL), root, AS_OF)
    return root


@pytest.mark.parametrize("split", sorted(SPLITS))
def test_incremental_equals_full(spark, full, tmp_path, split):
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_SMALL)
    cond = SPLITS[split]()
    root = str(tmp_path / "inc")
    build_tables(spark, raw.filter(cond), root, AS_OF)
    incremental_update(spark, root, raw, raw.filter(~cond), AS_OF)
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, root)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, read.__name__


def test_incremental_twice_is_idempotent(spark, full, tmp_path):
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_int
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_SMALL)
    late = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    root = str(tmp_path / "inc2")
    build_tables(spark, raw.filter(~late), root, AS_OF)
    incremental_update(spark, root, raw, raw.filter(late), AS_OF)
    incremental_update(spark, root, raw, raw.filter(late), AS_OF)
    a, b = read_int(spark, full), read_int(spark, root)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_with_untimed_rows(spark, tmp_path):
    """Rows without a time form one NULL bucket per aircraft (dedup keeps one of them); a late
    untimed row of one aircraft must not disturb another aircraft's untimed row."""
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from tests.conftest import raw_df

    t0 = 1704067200
    rows = [dict(icao24="f00001", time_position=t0 + 10 * i, last_contact=t0 + 10 * i,
                 baro_altitude=1000.0 + 50 * i) for i in range(12)]
    rows += [dict(icao24="f00002", time_position=t0 + 10 * i, last_contact=t0 + 10 * i) for i in range(6)]
    rows += [dict(icao24="f00001", time_position=None, baro_altitude=500.0, source_position=2),
             dict(icao24="f00002", time_position=None, baro_altitude=700.0),
             dict(icao24="f00001", time_position=None, baro_altitude=900.0, source_position=1),   # late, better
             dict(icao24="f00001", time_position=t0 + 45, baro_altitude=3000.0)]                  # late, timed
    raw = raw_df(spark, rows)
    late = F.col("id").isin("id00020", "id00021")
    full, inc = str(tmp_path / "full"), str(tmp_path / "inc")
    build_tables(spark, raw, full, AS_OF)
    build_tables(spark, raw.filter(~late), inc, AS_OF)
    incremental_update(spark, inc, raw, raw.filter(late), AS_OF)
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, inc)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, read.__name__
    untimed = read_int(spark, inc).filter(F.col("window_30s").isNull())
    assert untimed.count() == 2
    assert {r["icao24"]: r["altitude_baro_m"] for r in untimed.collect()} == {"f00001": 900.0, "f00002": 700.0}


@pytest.mark.parametrize("step_days", [1, 31])
def test_incremental_over_several_days(spark, tmp_path, step_days):
    """Positions spread over three days / three months (partials in several partitions)."""
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_SMALL).withColumn(
        "time_position", F.col("time_position") + F.pmod(F.xxhash64("icao24"), F.lit(3)) * 86400 * step_days)
    late = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    full, inc = str(tmp_path / "full"), str(tmp_path / "inc")
    build_tables(spark, raw, full, AS_OF)
    build_tables(spark, raw.filter(~late), inc, AS_OF)
    incremental_update(spark, inc, raw, raw.filter(late), AS_OF)
    assert read_fact(spark, full).select("date_utc").distinct().count() == 3
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, inc)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, read.__name__


def test_empty_slice_changes_nothing(spark, full, tmp_path):
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_SMALL)
    root = str(tmp_path / "same")
    build_tables(spark, raw, root, AS_OF)
    assert incremental_update(spark, root, raw, raw.limit(0), AS_OF) == {"recomputed_positions": 0}
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, root)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_schemas_equal_the_operators_output(spark):
    from datetime import datetime

    from aerosift.operators.dedup import dedup
    from aerosift.operators.marts import flight_dim, position_fact
    from aerosift.operators.staging import stage
    from aerosift.plans.tables import daily_groups, hourly_groups, monthly_groups, with_int_partition
    from aerosift.schemas import RAW_POSITIONS, TABLE_SCHEMAS

    inter = dedup(stage(spark.createDataFrame([], RAW_POSITIONS)))
    dim = flight_dim(inter, datetime(2000, 1, 1))
    hourly = hourly_groups(with_int_partition(inter))
    got = {"int": with_int_partition(inter), "dim": dim, "fact": position_fact(inter, dim, datetime(2000, 1, 1)),
           "dim_hourly": hourly, "dim_daily": daily_groups(hourly), "dim_monthly": monthly_groups(daily_groups(hourly))}
    kinds = lambda schema: [(f.name, f.dataType) for f in schema]
    assert {k: kinds(v.schema) for k, v in got.items()} == {k: kinds(v) for k, v in TABLE_SCHEMAS.items()}


def test_an_update_that_dies_before_the_dimension_is_repeated_exactly(spark, full, tmp_path, monkeypatch):
    from aerosift.plans import incremental
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_SMALL)
    late = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    root = str(tmp_path / "dies")
    build_tables(spark, raw.filter(~late), root, AS_OF)

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "write_version", die)
        with pytest.raises(RuntimeError):
            incremental.incremental_update(spark, root, raw, raw.filter(late), AS_OF)
    incremental.incremental_update(spark, root, raw, raw.filter(late), AS_OF)
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, root)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, read.__name__


def test_touched_windows_are_masks_that_many_of_are_shuffled(spark):
    """A row for each aircraft and quarter of an hour, not one for each window; shifted masks hold the windows around
    each touched one across the borders of blocks; many masks are not broadcast, however small their file is."""
    from aerosift.plans.incremental import BLOCK, _expand, affected_raw, touched_windows
    from tests.conftest import raw_df

    t0 = 1704067200
    times = [t0 + 30 * i for i in (0, 1, 28, 29, 30, 61)]
    raw = raw_df(spark, [dict(time_position=t) for t in times] + [dict(icao24="def456", time_position=None)])
    touched = touched_windows(raw)
    assert touched.count() == 4

    def windows(masks):
        return {(r.icao24, None if r.block is None else r.block * BLOCK + i)
                for r in masks.collect() for i in range(BLOCK) if r.mask >> i & 1}

    own = {("abc123", t // 30) for t in times}
    assert windows(touched) == own | {("def456", None)}
    around = {(a, w + k) for a, w in own for k in range(-4, 5)}
    assert windows(_expand(touched, -4, 4, 30)) == around | {("def456", None)}
    far = {(a, w + k) for a, w in own for k in range(0, 71)}                 # reaches over two blocks
    assert windows(_expand(touched, 0, 70, 30)) == far | {("def456", None)}

    stored = raw_df(spark, [dict(time_position=t0 + 30 * i) for i in range(-10, 80)] + [dict(icao24="def456", time_position=None),
                                                                                        dict(time_position=None)])
    got = affected_raw(stored, _expand(touched, -4, 4, 30), many=True)
    assert {(r.icao24, r.time_position and r.time_position // 30) for r in got.collect()} == {
        (a, w) for a, w in around if t0 // 30 - 10 <= w < t0 // 30 + 80} | {("def456", None)}
    plan = affected_raw(stored, _expand(touched, -4, 4, 30), many=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
