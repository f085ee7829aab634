"""Landed payloads, insert-only merge and ingest statistics."""

import hashlib
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_SMALL, raw_df

STATE = ["3c6444", "DLH9LF  ", "Germany", 1704067200, 1704067201, 2.35, 48.85, 10972.8, False, 240.5, 95.3,
         0.0, None, 11049.0, "1000", False, 0]


def _write_payloads(d):
    payloads = {
        "normal.json": {"time": 1704067260, "states": [STATE, ["abc123", None, "France", 1704067230, 1704067230,
                                                              1.5, 47.0, None, None, None, None, None]]},
        "short.json": {"time": 1704067260, "states": [["def456", "AFR1", "France", 1704067220, 1704067220, 2.0, 46.0]]},
        "nullcoords.json": {"time": 1704067260, "states": [["aaa111", "X", "France", 1704067200, 1704067200,
                                                            None, 46.0, 100.0]]},
        "badalt.json": {"time": 1704067260, "states": [["bbb222", "Y", "France", 1704067200, 1704067200, 3.0, 45.0,
                                                        "high", False]]},
        "badlat.json": {"time": 1704067260, "states": [["ccc333", "Z", "France", 1704067200, 1704067200, 3.0, "n/a"]]},
        "nostates.json": {"time": 1704067260, "states": None},
        "empty.json": {"time": 1704067260, "states": []},
    }
    for name, p in payloads.items():
        with open(os.path.join(d, name), "w") as f:
            json.dump(p, f)


def test_parse_states(spark, tmp_dir):
    from aerosift.functions.keys import BATCH_CLOCK_FORMAT
    from aerosift.sources.states import parse_states, read_states

    _write_payloads(tmp_dir)
    pos, rej = parse_states(read_states(spark, tmp_dir), AS_OF)
    got = {r["icao24"]: r for r in pos.collect()}
    assert set(got) == {"3c6444", "abc123", "def456"}
    a = got["3c6444"]
    assert a["callsign"] == "DLH9LF" and a["baro_altitude"] == 10972.8 and a["au_sol"] is False
    assert a["source_position"] == 0 and a["time_position"] == 1704067200
    assert a["id"] == hashlib.sha256(b"3c6444_1704067200_48.8500_2.3500").hexdigest()
    assert a["batch_id"] == hashlib.md5(AS_OF.strftime(BATCH_CLOCK_FORMAT).encode()).hexdigest()
    assert a["ingested_at"] == AS_OF
    assert got["abc123"]["au_sol"] is None            # explicit null stays NULL
    assert got["def456"]["au_sol"] is False           # absent field defaults to FALSE
    assert sorted(r["icao24"] for r in rej.collect()) == ["bbb222", "ccc333"]      # any value that does not type


def test_malformed_values_and_files_become_rejects(spark, tmp_dir):
    from aerosift.sources.states import parse_states, read_states

    bad_time = ["ddd444", "Z", "France", "notatime", 1704067200, 3.0, 46.0]
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        json.dump({"time": 1704067260, "states": [STATE, bad_time]}, f)
    with open(os.path.join(tmp_dir, "b.json"), "w") as f:
        f.write(json.dumps({"time": 1704067860, "states": [STATE]})[:40])
    with open(os.path.join(tmp_dir, "c.json"), "w") as f:
        json.dump({"time": 1704067860, "states": [STATE]}, f)
    pos, rej = parse_states(read_states(spark, tmp_dir))
    rows = rej.collect()
    assert sorted((r["icao24"], r["corrupt"] is None) for r in rows if r["corrupt"] is None) == [("ddd444", True)]
    assert sum(r["corrupt"] is not None for r in rows) == 1
    # stamp and batch id follow each row's own payload
    assert sorted((r["ingested_at"], r["batch_id"]) for r in pos.collect()) == sorted(
        (t, hashlib.md5(t.strftime("%Y%m%d_%H%M%S").encode()).hexdigest())
        for t in (datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 11)))


def test_landed_batch_roundtrip(spark, tmp_dir):
    from aerosift.sources.states import read_batch, write_batch

    df = raw_df(spark, [dict(), dict(icao24="def456")])
    n = write_batch(df, os.path.join(tmp_dir, "b1"))
    assert n == 2
    back = read_batch(spark, os.path.join(tmp_dir, "b1"))
    assert back.exceptAll(df).count() == 0
    assert read_batch(spark, os.path.join(tmp_dir, "missing")).count() == 0


def test_merge_raw_idempotent_and_twins(spark, tmp_dir):
    from aerosift.operators.sinks import dedup_rate, merge_raw

    table = os.path.join(tmp_dir, "raw")
    b1 = raw_df(spark, [dict(), dict(icao24="def456"), dict(icao24="def456")])   # ids id00000..2
    b1 = b1.withColumn("id", F.when(F.col("id") == "id00002", F.lit("id00001")).otherwise(F.col("id")))  # twin
    s1 = merge_raw(spark, b1, table)
    assert s1 == {"inserted": 2, "skipped": 1, "total": 3}
    s2 = merge_raw(spark, b1, table)
    assert s2 == {"inserted": 0, "skipped": 3, "total": 3}
    assert spark.read.parquet(table).count() == 2
    assert dedup_rate(s2) == 100.0
    assert merge_raw(spark, b1.limit(0), table) == {"inserted": 0, "skipped": 0, "total": 0}
    assert dedup_rate({"inserted": 0, "skipped": 0, "total": 0}) == 0.0


def test_merge_of_untimed_rows_inserts_them_once(spark, tmp_dir):
    from aerosift.operators.sinks import merge_raw

    table = os.path.join(tmp_dir, "raw")
    batch = raw_df(spark, [dict(), dict(time_position=None, last_contact=None)])
    assert [merge_raw(spark, batch, table)["inserted"] for _ in range(3)] == [2, 0, 0]
    assert spark.read.parquet(table).count() == 2


def test_differing_twins_keep_one_row_whatever_the_input_order(spark):
    from aerosift.operators.sinks import one_per_id

    rows = [dict(callsign=c, squawk=q) for c, q in (("BBB", "1"), ("AAA", "2"), ("AAA", "1"), (None, "0"))]
    df = raw_df(spark, rows).withColumn("id", F.lit("same"))
    kept = {tuple(one_per_id(df.orderBy(F.rand(seed))).first()[["callsign", "squawk"][i]] for i in (0, 1)) for seed in range(4)}
    assert kept == {("AAA", "1")}


def test_an_unreadable_table_is_an_error_not_an_empty_one(spark, tmp_dir):
    from aerosift.operators.sinks import merge_raw
    from aerosift.sources.states import read_batch

    table = os.path.join(tmp_dir, "raw")
    batch = raw_df(spark, [dict()])
    merge_raw(spark, batch, table)
    for d, _, files in os.walk(table):
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(d, f), "wb") as out:
                    out.write(b"not a parquet file")
                crc = os.path.join(d, f".{f}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        merge_raw(spark, batch, table)
    with pytest.raises(Exception):  # noqa: B017, PT011
        read_batch(spark, table).collect()


def test_merge_stats_equal_sequential_merges(spark, tmp_dir):
    """Set-based per-batch stats equal merging the batches one after the other."""
    from aerosift.operators.sinks import merge_raw, merge_stats
    from aerosift.sources.events_adapter import raw_positions, replayed_batches

    batches = replayed_batches(raw_positions(spark, SF_SMALL, keep_event_id=True)).drop("event_id")
    stats = {r["ingested_at"]: (r["inserted"], r["skipped"], r["total"]) for r in merge_stats(batches).collect()}
    table = os.path.join(tmp_dir, "raw")
    keys = sorted(stats)
    for k in keys[:6]:
        s = merge_raw(spark, batches.filter(F.col("ingested_at") == F.lit(k)), table)
        assert (s["inserted"], s["skipped"], s["total"]) == stats[k]
    assert stats[keys[-1]][0] == 0   # the last batch holds replays only


def test_ingestion_stats(spark):
    from aerosift.operators.sinks import ingestion_stats
    from aerosift.sources.events_adapter import raw_positions

    r = ingestion_stats(raw_positions(spark, SF_SMALL), AS_OF).first()
    assert r["dernier_batch"] == datetime(2024, 1, 1, 3, 0)
    assert r["nombre_batches"] == 7 and r["avions_uniques"] > 0


def test_should_run_throttle():
    from aerosift.operators.quality import should_run

    assert should_run("any", 1)
    hits = sum(should_run(f"run-{i}", 6) for i in range(600))
    assert 50 < hits < 150


def test_airline_filter_and_row_counts(spark):
    from aerosift.operators import serving
    from aerosift.plans.transform import build_marts
    from aerosift.sources.events_adapter import raw_positions

    m = build_marts(raw_positions(spark, SF_SMALL), AS_OF, materialize=True)
    live = serving.live_positions(m.fact, m.dim, AS_OF)
    names = [r[0] for r in serving.airlines(live).collect()]
    assert names == sorted(names) and "Air France" in names
    assert serving.filter_airline(live, "Toutes").count() == live.count()
    assert serving.filter_airline(live, None).count() == live.count()
    assert serving.filter_airline(live, "Air France").count() == 2
    counts = serving.row_counts({"fact_positions": m.fact, "dim_vols": m.dim})
    serving.assert_non_empty(counts)
    with pytest.raises(RuntimeError):
        serving.assert_non_empty(serving.row_counts({"empty": m.dim.limit(0)}))


def test_json_landing_roundtrip_and_bbox(spark, tmp_dir):
    from aerosift.sources.states import FRANCE, parse_states, read_batch, read_states, write_batch

    df = raw_df(spark, [dict(), dict(icao24="def456", ingested_at=datetime(2024, 1, 1, 1, 0))])
    path = os.path.join(tmp_dir, "landed-json")
    assert write_batch(df, path, fmt="json") == 2
    back = read_batch(spark, path, fmt="json")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0

    landing = os.path.join(tmp_dir, "payloads")
    _write_payloads(landing) if os.path.isdir(landing) else (os.makedirs(landing), _write_payloads(landing))
    inside, _ = parse_states(read_states(spark, landing), AS_OF, bbox=FRANCE)
    everything, _ = parse_states(read_states(spark, landing), AS_OF)
    assert inside.count() == everything.count()        # all fixture states are inside the box
    tiny = dict(lat_min=48.0, lat_max=49.0, lon_min=2.0, lon_max=3.0)
    assert [r["icao24"] for r in parse_states(read_states(spark, landing), AS_OF, bbox=tiny)[0].collect()] \
        == ["3c6444"]


def test_merge_projects_to_raw_schema(spark, tmp_dir):
    from aerosift.operators.sinks import merge_raw
    from aerosift.schemas import RAW_COLUMNS

    table = os.path.join(tmp_dir, "raw")
    df = raw_df(spark, [dict()]).withColumn("extra", F.lit(1))
    merge_raw(spark, df.drop("squawk"), table)
    stored = spark.read.parquet(table)
    assert [c for c in stored.columns if c not in ("event_date", "event_hour")] == RAW_COLUMNS
    assert stored.first()["squawk"] is None
