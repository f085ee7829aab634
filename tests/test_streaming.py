"""Structured Streaming paths compared with their batch equivalents."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_SMALL, raw_df


def to_state_payloads(raw, batch_col="ingested_at"):
    """Test helper, the inverse of ``parse_states``: one payload per landed
    batch (``time`` = batch stamp, ``states`` = 17-value text arrays)."""
    from aerosift.schemas import STATE_FIELDS

    vals = [F.lit(None).cast("string") if n in ("sensors", "spi") else F.col(n).cast("string")
            for n in STATE_FIELDS]
    return raw.groupBy(batch_col).agg(F.collect_list(F.array(*vals)).alias("states")).select(
        F.unix_seconds(F.col(batch_col).cast("timestamp")).alias("time"), "states")


def test_ingest_stream_equals_batch_build(spark, tmp_dir):
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int
    from aerosift.sources.events_adapter import raw_positions
    from aerosift.streaming.pipeline import run_ingest_stream

    raw = raw_positions(spark, SF_SMALL)
    stamps = sorted(r[0] for r in raw.select("ingested_at").distinct().collect())[:4]
    landing = os.path.join(tmp_dir, "landing")
    for s in stamps:   # one landed file per 10-minute batch
        to_state_payloads(raw.filter(F.col("ingested_at") == F.lit(s))).coalesce(1) \
            .write.mode("append").json(landing)
    root = os.path.join(tmp_dir, "marts")
    q = run_ingest_stream(spark, landing, root, os.path.join(tmp_dir, "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    stored_raw = spark.read.parquet(os.path.join(root, "raw"))
    n_expected = raw.filter(F.col("ingested_at").isin(stamps)).filter(
        F.col("latitude").between(41.0, 51.5) & F.col("longitude").between(-5.5, 10.0)).count()      # the region's box
    assert stored_raw.count() == n_expected
    assert stored_raw.select("batch_id").distinct().count() == 4
    assert spark.read.parquet(os.path.join(root, "checks")).select("batch_id").distinct().count() == 4    # stored per payload
    ref = os.path.join(tmp_dir, "ref")
    build_tables(spark, stored_raw.drop("event_date", "event_hour"), ref, AS_OF)
    a, b = read_int(spark, ref), read_int(spark, root)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # marts: the audit stamp is the as_of of the micro-batch that last touched the row
    for read in (read_dim, read_fact):
        a, b = read(spark, ref).drop("dbt_updated_at"), read(spark, root).drop("dbt_updated_at")
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, read.__name__


def test_window_winners_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    from aerosift.operators.dedup import window_winners
    from aerosift.operators.staging import stage
    from aerosift.schemas import RAW_POSITIONS
    from aerosift.sources.events_adapter import raw_positions
    from aerosift.streaming.pipeline import window_winners_stream

    raw = raw_positions(spark, SF_SMALL)
    raw.write.parquet(os.path.join(tmp_dir, "landing"))
    src = spark.readStream.schema(RAW_POSITIONS).parquet(os.path.join(tmp_dir, "landing"))
    q = (window_winners_stream(stage(src), "30 minutes").writeStream.format("parquet")
         .option("path", os.path.join(tmp_dir, "out")).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    from aerosift.streaming.pipeline import dropped_by_watermark
    assert dropped_by_watermark(q) == 0          # one micro-batch: nothing arrives behind the watermark
    got = spark.read.parquet(os.path.join(tmp_dir, "out")).drop("position_id")
    batch = window_winners(stage(raw))
    wm = batch.agg(F.max("timestamp_position_utc")).first()[0]
    closed = batch.filter(F.col("window_30s") <= F.lit(wm).cast("timestamp_ntz") - F.expr("INTERVAL 1830 SECONDS"))
    assert got.count() == closed.count() > 0
    assert closed.select(*got.columns).exceptAll(got).count() == 0


def test_dedup_ids_and_latest_and_segments_stream(spark, tmp_dir):
    from aerosift.operators.staging import stage
    from aerosift.schemas import RAW_POSITIONS
    from aerosift.streaming.pipeline import dedup_ids_stream, latest_positions_stream, track_segments_stream

    t0 = 1704067200
    rows = [dict(id="same", time_position=t0), dict(id="same", time_position=t0),
            dict(id="b", time_position=t0 + 60), dict(id="c", time_position=t0 + 400)]
    df = raw_df(spark, rows)
    df = df.withColumn("id", F.when(F.col("id").isin("id00000", "id00001"), F.lit("same")).otherwise(F.col("id")))
    path = os.path.join(tmp_dir, "landing")
    df.write.parquet(path)
    src = spark.readStream.schema(RAW_POSITIONS).parquet(path)

    q1 = dedup_ids_stream(src).writeStream.format("memory").queryName("ids_out").trigger(availableNow=True).start()
    q1.awaitTermination()
    assert spark.table("ids_out").count() == 3

    latest = latest_positions_stream(src.select("icao24", "time_position", "baro_altitude"), key="icao24",
                                     ts="time_position")
    q2 = latest.writeStream.format("memory").queryName("latest_out").outputMode("update") \
        .trigger(availableNow=True).start()
    q2.awaitTermination()
    assert [r["time_position"] for r in spark.table("latest_out").collect()] == [t0 + 400]

    seg = track_segments_stream(stage(src), gap_s=120, watermark="1 second")
    q3 = seg.writeStream.format("memory").queryName("seg_out").outputMode("append") \
        .trigger(availableNow=True).start()
    q3.awaitTermination()
    got = sorted((r["debut"], r["nb_positions"]) for r in spark.table("seg_out").collect())
    assert got[0] == (datetime(2024, 1, 1, 0, 0), 3)


def test_segment_gap_boundary(spark, tmp_dir):
    """Δt = 120 s continues a segment (continuity rule), 121 s starts a new one."""
    from aerosift.operators.staging import stage
    from aerosift.schemas import RAW_POSITIONS
    from aerosift.streaming.pipeline import track_segments_stream

    t0 = 1704067200
    secs = [0, 120, 241, 300]          # 120 -> same segment, 121 -> new segment, 59 -> same
    path = os.path.join(tmp_dir, "landing")
    rows = [dict(icao24="h00001", time_position=t0 + s, last_contact=t0 + s) for s in secs]
    rows.append(dict(icao24="h00002", time_position=t0 + 1000, last_contact=t0 + 1000))   # moves the watermark on
    raw_df(spark, rows).write.parquet(path)
    src = spark.readStream.schema(RAW_POSITIONS).parquet(path)
    q = (track_segments_stream(stage(src), 120, "1 second").writeStream.format("memory").queryName("gap_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["debut"], r["fin"], r["nb_positions"])
                 for r in spark.table("gap_out").filter(F.col("icao24") == "h00001").collect())
    base = datetime(2024, 1, 1)
    assert got == [(base, base + timedelta(seconds=240), 2), (base + timedelta(seconds=241), base + timedelta(seconds=420), 2)]


def test_a_replayed_micro_batch_stores_rejects_and_checks_once(spark, tmp_dir):
    from aerosift.sources.states import read_states
    from aerosift.streaming.pipeline import process_landed_batch

    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "marts")
    rows = raw_df(spark, [{"icao24": f"c{i}", "time_position": 1704067200 + 60 * i} for i in range(5)])
    to_state_payloads(rows).coalesce(1).write.json(landing)
    with open(os.path.join(landing, "bad.json"), "w") as f:
        f.write('{"time": 1704067800, "states": [["d1", "X", "France", 1, 1, 2.0, "oops"]]}')
    for _ in range(2):
        stats = process_landed_batch(spark, read_states(spark, landing), root, epoch=7)
        assert stats["rejects"] == 1
        assert spark.read.parquet(os.path.join(root, "rejects")).count() == 1
        checks = spark.read.parquet(os.path.join(root, "checks"))
        assert checks.count() == checks.dropDuplicates(["batch_id", "suite", "check_order"]).count() > 0
    process_landed_batch(spark, read_states(spark, landing), root, epoch=8)
    assert spark.read.parquet(os.path.join(root, "rejects")).count() == 2


def test_windows_of_a_slice_close_with_the_next_batch_that_has_data(spark, tmp_dir):
    from contextlib import nullcontext

    from pyspark.sql import functions as F

    from aerosift.operators.staging import stage
    from aerosift.plans.catalog import closing_row
    from aerosift.schemas import RAW_POSITIONS
    from aerosift.streaming.pipeline import data_batches_only, window_winners_stream

    def drain(day, inside):
        closing_row(spark).withColumn("time_position", F.lit(86_400 * day).cast("long")).write.mode("append").parquet(f"{tmp_dir}/in")
        stg = stage(spark.readStream.schema(RAW_POSITIONS).parquet(f"{tmp_dir}/in"))
        with inside:
            q = (window_winners_stream(stg, "2 hours").writeStream.format("parquet").option("path", f"{tmp_dir}/out")
                 .option("checkpointLocation", f"{tmp_dir}/ck").outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
        return spark.read.schema("icao24 string").parquet(f"{tmp_dir}/out").count()

    conf = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(conf)
    assert [drain(day, data_batches_only(spark)) for day in (1, 2, 3)] == [0, 0, 1]
    assert spark.conf.get(conf) == before
    assert drain(4, nullcontext()) == 3              # a batch without data closes the windows up to the last row's
