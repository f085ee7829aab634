"""Streaming ingest and windowed dedup.

* ``run_ingest_stream`` (STR1, STR2, STR4, STR5): landed payload files as a
  file stream; each micro-batch (``foreachBatch``) is parsed, checked with
  the raw suite per landed payload (warn), merged insert-only into the raw table, and applied
  to the stored marts with the exact incremental update. Ingest stamp and batch id come
  from each row's own payload time, so they do not depend on how files fall into
  micro-batches, and a replayed micro-batch re-applies the same rows: merge and
  incremental update are both idempotent. Rejects are counted and stored.
* ``window_winners_stream`` (STR3): 30 s dedup as a watermarked streaming
  aggregation (``min_by`` over an ordering struct; ``row_number`` is not
  available on streams).
* ``dedup_ids_stream`` (STR2 alt.): ``dropDuplicatesWithinWatermark`` on id.
* ``latest_positions_stream`` (STR6): newest position per aircraft, update mode.
* ``track_segments_stream`` (STR7): session windows with the 120 s gap.

Watermarks need ``timestamp`` (not ``timestamp_ntz``): event times are made from
epoch seconds on the way in and back on the way out, so windows of any length
begin where they do in UTC, whatever the session zone.
"""

from __future__ import annotations

import contextlib
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.dedup import NO_SOURCE_SCORE, STG_PAYLOAD, clean_rows, dedup_order
from ..functions.timecols import epoch_to_ntz, ntz_to_epoch
from ..operators.quality import RAW_SUITE, enforce, run_suite, store_results
from ..operators.sinks import EVENT_PARTITIONS, RAW_TABLE, _versions, merge_rows, read_if_exists
from ..plans.incremental import incremental_update
from ..plans.tables import build_tables, paths
from ..schemas import TABLE_SCHEMAS
from ..sources.states import FRANCE, parse_states, read_states

EVENT_TS = "_event_ts"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _event_time(df: DataFrame, col: str = "timestamp_position_utc") -> DataFrame:
    return df.withColumn(EVENT_TS, F.timestamp_seconds(ntz_to_epoch(col)))


def naive(col: str) -> Column:
    """A window's edge as naive UTC time."""
    return epoch_to_ntz(F.unix_seconds(col))


@contextlib.contextmanager
def data_batches_only(spark: SparkSession):
    """Queries started inside run no further micro-batch that only closes windows; the session's setting is as before afterwards.

    Such a batch reads and writes the whole state again. The next one with data closes the same windows, as the watermark
    it starts from is the same."""
    before = spark.conf.get(_NO_DATA)
    spark.conf.set(_NO_DATA, "false")
    try:
        yield
    finally:
        spark.conf.set(_NO_DATA, before)


def window_winners_stream(stg: DataFrame, watermark: str = "2 hours", window_s: int = 30, event_time: bool = False) -> DataFrame:
    """Best row per (icao24, 30 s window) on a stream of staged rows; a window
    is emitted (append mode) once the watermark passes its end. ``event_time`` adds the window's time
    under that name, with the watermark, for a further stateful operator."""
    s = _event_time(clean_rows(stg)).withColumn(
        "quality_score", F.coalesce(F.col("source_capteur"), F.lit(NO_SOURCE_SCORE)))
    s = s.withWatermark(EVENT_TS, watermark)
    payload = F.struct(*[F.col(c) for c in STG_PAYLOAD if c != "icao24"], F.col("quality_score"))
    g = s.groupBy("icao24", F.window(EVENT_TS, f"{window_s} seconds").alias("_win")).agg(
        F.min_by(payload, F.struct(*dedup_order())).alias("_w"))
    time = [F.window_time("_win").alias("event_time")] * event_time
    out = g.select("icao24", naive("_win.start").alias("window_30s"), "_w.*", *time)
    return out.select(surrogate_key("icao24", "window_30s").alias("position_id"), *out.columns)


def dedup_ids_stream(positions: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Drop re-landed ids seen within the watermark horizon."""
    return (_event_time(positions, "ingested_at").withWatermark(EVENT_TS, watermark)
            .dropDuplicatesWithinWatermark(["id"]).drop(EVENT_TS))


def latest_positions_stream(fact_rows: DataFrame, key: str = "vol_sk", ts: str = "timestamp_utc") -> DataFrame:
    """Newest row per key (update mode): ``max_by`` keeps one row of state per key."""
    cols = [c for c in fact_rows.columns if c != key]
    return fact_rows.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r")).select(key, "_r.*")


def track_segments_stream(stg: DataFrame, gap_s: int = 120, watermark: str = "2 hours") -> DataFrame:
    """Track segments per aircraft: consecutive positions at most ``gap_s``
    seconds apart belong to one session window (the 120 s continuity rule of
    the climb rate: Δt <= 120 s is continuous); segment end = last position + gap."""
    s = _event_time(clean_rows(stg)).withWatermark(EVENT_TS, watermark)
    g = s.groupBy("icao24", F.session_window(EVENT_TS, f"{gap_s} seconds").alias("_s")).agg(
        F.count(F.lit(1)).alias("nb_positions"))
    return g.select("icao24", naive("_s.start").alias("debut"),
                    naive("_s.end").alias("fin"), "nb_positions")


def process_landed_batch(spark: SparkSession, states: DataFrame, root: str, on_failure: str = "warn",
                         bbox: dict | None = FRANCE, epoch: int | None = None) -> dict:
    """One micro-batch of landed state vectors -> raw table -> marts; rejects -> ``rejects``, checks -> ``checks``.

    The run id is the newest payload time, with the micro-batch's number where there is one. A replayed micro-batch
    replaces the rejects of its run id and stores its checks once."""
    positions, rejects = parse_states(states, None, bbox)
    positions = positions.persist()
    try:
        p = paths(root)
        stamp = positions.agg(F.max(ntz_to_epoch("ingested_at"))).first()[0]
        run_id = str(stamp) if epoch is None else f"{stamp}-{epoch}"
        n_rejects = rejects.count()
        if n_rejects and stamp is not None:
            rejects.write.mode("overwrite").parquet(f"{root}/rejects/run_id={run_id}")
        elif n_rejects:                 # nothing to name the run by
            rejects.write.mode("append").parquet(f"{root}/rejects/run_id=none")
        if stamp is None:
            return {"inserted": 0, "skipped": 0, "total": 0, "rejects": n_rejects}
        as_of = datetime.fromtimestamp(int(stamp), timezone.utc).replace(tzinfo=None)
        results = run_suite(positions, RAW_SUITE, by=["batch_id"])
        store_results(results, f"{root}/checks", run_id, as_of)
        enforce(results, on_failure)
        stats, _ = merge_rows(spark, positions, p["raw"])
        raw = spark.read.schema(RAW_TABLE).parquet(p["raw"])
        if _versions(spark, p["dim"]) and read_if_exists(spark, p["fact"], TABLE_SCHEMAS["fact"]) is not None:
            # the micro-batch itself is the slice: rows it re-sends only widen the recomputed
            # windows, and the update is exact for any slice holding the new rows (no raw scan)
            incremental_update(spark, root, raw, positions, as_of)
        else:
            build_tables(spark, raw.drop(*EVENT_PARTITIONS), root, as_of)
        return {**stats, "rejects": n_rejects}
    finally:
        positions.unpersist()


def run_ingest_stream(spark: SparkSession, landing: str, root: str, checkpoint_location: str,
                      available_now: bool = True, interval: str = "10 minutes", max_files_per_trigger: int | None = None,
                      bbox: dict | None = FRANCE):
    """Start the landed-file stream (``availableNow`` drains what is there and
    stops; otherwise one micro-batch per ``interval``)."""
    stream = read_states(spark, landing, streaming=True, max_files_per_trigger=max_files_per_trigger)
    w = stream.writeStream.foreachBatch(lambda df, epoch: process_landed_batch(spark, df, root, bbox=bbox, epoch=epoch)) \
        .option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def dropped_by_watermark(query) -> int:
    """Rows (after partial aggregation) that a query's micro-batches dropped as later than the watermark (STR4)."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p.get("stateOperators", []))
