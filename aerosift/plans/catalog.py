"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's ``events`` table through the fixture adapter
and runs the layers it needs over the whole table. ``as_of`` is the end of
the fixture's 3-hour day (FIXTURES.md §4).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import serving
from ..session import materialize, scratch_path
from ..operators.marts import orphan_count
from ..sources.events_adapter import raw_positions
from .transform import Marts, build_marts

AS_OF = datetime(2024, 1, 1, 3, 0, 0)
TOP_CORRIDORS = 20

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Layers over the whole events table; ``inter`` is written once to the
    checkpoint folder for the queries that read it more than once (dim and fact)."""
    return build_marts(raw_positions(spark, sf_dir), AS_OF, materialize=True)


def live(spark, sf_dir) -> DataFrame:
    m = marts(spark, sf_dir)
    return serving.live_positions(m.fact, m.dim, AS_OF)


def anomalies_24h(spark, sf_dir) -> DataFrame:
    m = marts(spark, sf_dir)
    return serving.anomalies(m.fact, m.dim, AS_OF)


# ---- layers -----------------------------------------------------------------

@register("raw_positions")
def q_raw(spark, sf_dir):
    return raw_positions(spark, sf_dir)


@register("stg_positions")
def q_stg(spark, sf_dir):
    return build_marts(raw_positions(spark, sf_dir), AS_OF).stg


@register("int_positions_deduped")
def q_int(spark, sf_dir):
    return build_marts(raw_positions(spark, sf_dir), AS_OF).inter


@register("dim_vols")
def q_dim(spark, sf_dir):
    return marts(spark, sf_dir).dim


@register("fact_positions")
def q_fact(spark, sf_dir):
    return marts(spark, sf_dir).fact


@register("fact_orphans")
def q_orphans(spark, sf_dir):
    m = marts(spark, sf_dir)
    return orphan_count(m.inter, m.dim)


@register("tranche_counts")
def q_tranche(spark, sf_dir):
    return marts(spark, sf_dir).fact.groupBy("tranche_vol").agg(F.count(F.lit(1)).alias("nb_positions"))


@register("phase_counts")
def q_phase(spark, sf_dir):
    return marts(spark, sf_dir).fact.groupBy("phase_vol").agg(F.count(F.lit(1)).alias("nb_positions"))


# ---- serving ----------------------------------------------------------------

@register("live_positions")
def q_live(spark, sf_dir):
    return live(spark, sf_dir)


@register("anomalies_24h")
def q_anomalies(spark, sf_dir):
    return anomalies_24h(spark, sf_dir)


@register("airlines")
def q_airlines(spark, sf_dir):
    return serving.airlines(live(spark, sf_dir))


@register("live_positions_air_france")
def q_live_af(spark, sf_dir):
    return serving.filter_airline(live(spark, sf_dir), "Air France")


@register("kpis")
def q_kpis(spark, sf_dir):
    m = marts(spark, sf_dir)
    lv = serving.live_positions(m.fact, m.dim, AS_OF)
    return serving.kpis(lv, serving.anomalies(m.fact, m.dim, AS_OF))


@register("kpis_air_france")
def q_kpis_af(spark, sf_dir):
    m = marts(spark, sf_dir)
    lv = serving.live_positions(m.fact, m.dim, AS_OF)
    return serving.kpis(lv, serving.anomalies(m.fact, m.dim, AS_OF), airline="Air France")


@register("map_points")
def q_map(spark, sf_dir):
    return serving.map_points(live(spark, sf_dir))


@register("active_anomalies")
def q_active(spark, sf_dir):
    return serving.active_anomalies(live(spark, sf_dir))


@register("anomaly_table")
def q_anomaly_table(spark, sf_dir):
    return serving.anomaly_table(anomalies_24h(spark, sf_dir))


@register("mart_row_counts")
def q_row_counts(spark, sf_dir):
    m = marts(spark, sf_dir)
    return serving.row_counts({"fact_positions": m.fact, "dim_vols": m.dim})


# ---- insights -----------------------------------------------------------------

@register("traffic_in_air")
def q_in_air(spark, sf_dir):
    from ..operators.insights import aircraft_in_air
    return aircraft_in_air(marts(spark, sf_dir).fact)


@register("busiest_corridors")
def q_corridors(spark, sf_dir):
    from ..operators.insights import busiest_corridors
    return busiest_corridors(marts(spark, sf_dir).fact, TOP_CORRIDORS)


@register("traffic_by_country")
def q_country(spark, sf_dir):
    from ..operators.insights import traffic_by_country
    m = marts(spark, sf_dir)
    return traffic_by_country(m.fact, m.dim)


@register("traffic_by_hour")
def q_hour(spark, sf_dir):
    from ..operators.insights import traffic_by_hour
    return traffic_by_hour(marts(spark, sf_dir).fact)


# ---- ingest -------------------------------------------------------------------

@register("ingestion_stats_last_hour")
def q_ingest_stats(spark, sf_dir):
    from ..operators.sinks import ingestion_stats
    return ingestion_stats(raw_positions(spark, sf_dir), AS_OF)


@register("raw_merge_stats")
def q_merge_stats(spark, sf_dir):
    from ..operators.sinks import merge_stats
    from ..sources.events_adapter import replayed_batches
    return merge_stats(replayed_batches(raw_positions(spark, sf_dir, keep_event_id=True)))


@register("raw_merged")
def q_merged(spark, sf_dir):
    """The raw table after merging every replayed batch: one row per id, first landing kept."""
    from ..operators.sinks import one_per_id
    from ..schemas import RAW_COLUMNS
    from ..sources.events_adapter import replayed_batches
    return one_per_id(replayed_batches(raw_positions(spark, sf_dir, keep_event_id=True))).select(*RAW_COLUMNS)


def _merge_batches(spark, sf_dir):
    """Merge the replayed batches one after the other with ``merge_raw``, then the last one again.

    The batches hold rows without a time and differing twins of one id. Returns the table's
    path and the log [(ingested_at text, total, inserted, skipped)]."""
    from ..operators.sinks import merge_raw
    from ..sources.events_adapter import awkward_batches

    landed = F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")
    batches = awkward_batches(raw_positions(spark, sf_dir, keep_event_id=True)).withColumn("_landed", landed)
    batches = materialize(batches, "batches", ["_landed"])
    table = scratch_path(spark, "raw")
    stamps = [r[0] for r in batches.select("_landed").distinct().collect()]
    log = []
    for step, stamp in enumerate([*sorted(stamps), max(stamps)]):      # the last batch lands twice
        got = merge_raw(spark, batches.where(F.col("_landed") == stamp).drop("_landed"), table)
        log.append((step, stamp, got["total"], got["inserted"], got["skipped"]))
    return table, log


@register("raw_table_merged")
def q_table_merged(spark, sf_dir):
    """The raw table after real merges, batch after batch: one row per id, the first landing in a total order."""
    from ..operators.sinks import RAW_TABLE
    from ..schemas import RAW_COLUMNS

    table, _ = _merge_batches(spark, sf_dir)
    return spark.read.schema(RAW_TABLE).parquet(table).select(*RAW_COLUMNS)


@register("raw_merge_log")
def q_merge_log(spark, sf_dir):
    """What each real merge inserted and skipped; merging the last batch again inserts nothing."""
    _, log = _merge_batches(spark, sf_dir)
    return spark.createDataFrame(log, "step int, landed string, total long, inserted long, skipped long").withColumn(
        "landed", F.col("landed").cast("timestamp_ntz"))


def _land_payloads(spark, sf_dir) -> str:
    """The whole raw table landed as JSON payloads with the feed's faults, and one file that is no payload."""
    from ..sources.events_adapter import payloads

    landing = scratch_path(spark, "payloads")
    folder = ["slot", "part"]      # one payload a file
    payloads(raw_positions(spark, sf_dir, keep_event_id=True)).write.partitionBy(*folder).json(landing)
    broken = spark.range(1).select(F.lit('{"time": 1704067200, "states": [["abc').alias("value"), F.lit(0).alias("slot"), F.lit(0).alias("part"))
    broken.write.mode("append").partitionBy(*folder).text(landing)
    return landing


@register("payload_positions")
def q_payload_positions(spark, sf_dir):
    """Landed JSON payloads -> typed positions inside the region."""
    from ..sources.states import FRANCE, parse_states, read_states

    return parse_states(read_states(spark, _land_payloads(spark, sf_dir)), None, FRANCE)[0]


@register("payload_rejects")
def q_payload_rejects(spark, sf_dir):
    """State vectors that do not type, by the first field that does not, and files that do not parse."""
    from ..sources.states import parse_states, read_states

    rejects = parse_states(read_states(spark, _land_payloads(spark, sf_dir)))[1]
    return rejects.groupBy(F.col("corrupt").isNotNull().alias("corrupt_file"), F.coalesce("icao24", F.lit("?")).alias("icao24")).agg(
        F.count("*").alias("n"))


# ---- quality ------------------------------------------------------------------

@register("dq_stg_tests")
def q_dq_stg(spark, sf_dir):
    from ..operators.quality import STG_TESTS, run_suite
    return run_suite(marts(spark, sf_dir).stg, STG_TESTS)


@register("dq_mart_tests")
def q_dq_marts(spark, sf_dir):
    from ..operators.quality import DIM_TESTS, FACT_TESTS, run_suite
    m = marts(spark, sf_dir)
    return run_suite(m.dim, DIM_TESTS).unionByName(run_suite(m.fact, FACT_TESTS, refs={"dim_vols": m.dim}))


@register("dq_raw_suite_by_batch")
def q_dq_raw(spark, sf_dir):
    from ..operators.quality import RAW_SUITE, run_suite
    return run_suite(raw_positions(spark, sf_dir), RAW_SUITE, by=["batch_id"])


@register("dq_fact_suite")
def q_dq_fact(spark, sf_dir):
    from ..operators.quality import FACT_SUITE, run_suite
    return run_suite(marts(spark, sf_dir).fact, FACT_SUITE)


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    """The blocking decision per suite: failed checks of severity error block, the others warn."""
    from ..operators.quality import DIM_TESTS, FACT_SUITE, FACT_TESTS, run_suite
    m = marts(spark, sf_dir)
    results = run_suite(m.dim, DIM_TESTS).unionByName(run_suite(m.fact, FACT_TESTS, refs={"dim_vols": m.dim})).unionByName(
        run_suite(m.fact, FACT_SUITE))
    failed = F.count_if(F.col("status") == "fail")
    return results.groupBy("suite").agg(F.count("*").alias("checks"), failed.alias("failed"),
                                        F.count_if(F.col("status") == "warn").alias("warned"), (failed > 0).alias("blocked"))


@register("altitude_coherence")
def q_coherence(spark, sf_dir):
    from ..operators.quality import altitude_coherence
    return altitude_coherence(marts(spark, sf_dir).fact)


@register("source_freshness")
def q_freshness(spark, sf_dir):
    from ..operators.quality import freshness
    return freshness(raw_positions(spark, sf_dir), AS_OF)


# ---- exact incremental (stored tables) -------------------------------------------

INCREMENTAL_CUT = datetime(2024, 1, 1, 2, 0, 0)   # rows ingested from 02:00 on arrive late


def _incremental_root(spark, sf_dir) -> str:
    """Build the marts from rows ingested before the cut, then apply the rest
    with the exact incremental update; returns the table root."""
    from ..functions.timecols import ntz_literal
    from .incremental import incremental_update
    from .tables import build_tables

    raw = raw_positions(spark, sf_dir)
    root = scratch_path(spark, "marts")
    early = F.col("ingested_at") < ntz_literal(INCREMENTAL_CUT)
    build_tables(spark, raw.filter(early), root, AS_OF)
    incremental_update(spark, root, raw, raw.filter(~early), AS_OF)
    return root


@register("int_incremental")
def q_int_incremental(spark, sf_dir):
    from .tables import read_int
    return read_int(spark, _incremental_root(spark, sf_dir))


@register("fact_incremental")
def q_fact_incremental(spark, sf_dir):
    from .tables import read_fact
    return read_fact(spark, _incremental_root(spark, sf_dir))


@register("dim_incremental")
def q_dim_incremental(spark, sf_dir):
    from .tables import read_dim
    return read_dim(spark, _incremental_root(spark, sf_dir))


# ---- streaming ---------------------------------------------------------------------

STREAM_WATERMARK = "2 hours"


CLOSING = "closing"     # aircraft of the row that ends a stream


def closing_row(spark) -> DataFrame:
    """A position a day after all others, which moves a stream's watermark past every window."""
    from ..functions.timecols import ntz_literal
    from ..schemas import RAW_POSITIONS

    return spark.createDataFrame(
        [(CLOSING, CLOSING, CLOSING, "-", int(AS_OF.replace(tzinfo=timezone.utc).timestamp()) + 86_400, None, 2.0, 46.0, 0.0, 0.0, False,
          1.0, 0.0, 0.0, None, 0)], T.StructType(RAW_POSITIONS.fields[:16])).withColumns(
        {"ingested_at": ntz_literal(AS_OF), "batch_id": F.lit(CLOSING)})


def _drain(spark, sf_dir, name: str, transform, late: bool = False, close_each: bool = True) -> tuple[DataFrame, int]:
    """Land the raw table in three hourly slices and a closing row a day later, draining the
    stream after each: several micro-batches with a restart between, and every window closed.

    With ``late`` the first slice lands once more after that, from what landed. Without ``close_each`` the windows that
    a slice closes leave with the next one's batch. Returns the result and the number of groups that the watermark dropped."""
    from contextlib import nullcontext

    from ..operators.staging import stage
    from ..schemas import RAW_POSITIONS
    from ..streaming.pipeline import data_batches_only, dropped_by_watermark

    base = scratch_path(spark, name)
    raw = raw_positions(spark, sf_dir)
    hour = F.hour("ingested_at")
    slices = [raw.where(hour == 0), raw.where(hour == 1), raw.where(hour >= 2), closing_row(spark)]
    dropped, closing, first = 0, len(slices) - 1, None
    for step in range(len(slices) + late):
        landed = first if step > closing else slices[step]
        landed.write.mode("append").parquet(f"{base}/landing")
        if step == 0:
            first = spark.read.schema(RAW_POSITIONS).parquet(f"{base}/landing")      # lists the files of this slice, no later ones
        src = spark.readStream.schema(RAW_POSITIONS).parquet(f"{base}/landing")
        with nullcontext() if close_each or step >= closing else data_batches_only(spark):
            q = (transform(stage(src)).writeStream.format("parquet").option("path", f"{base}/out")
                 .option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
        dropped += dropped_by_watermark(q)
    out = spark.read.parquet(f"{base}/out")
    return out.where(F.col("icao24") != CLOSING) if "icao24" in out.columns else out, dropped


@register("stream_window_winners")
def q_stream_winners(spark, sf_dir):
    """30 s dedup as a watermarked streaming aggregation over the landed raw table; every window closes."""
    from ..streaming.pipeline import window_winners_stream

    return _drain(spark, sf_dir, "stream", lambda stg: window_winners_stream(stg, STREAM_WATERMARK), close_each=False)[0]


@register("stream_late_rows")
def q_stream_late(spark, sf_dir):
    """The first hour lands again behind the watermark: none of its windows is emitted twice, and the drops are counted."""
    from ..streaming.pipeline import window_winners_stream

    out, dropped = _drain(spark, sf_dir, "late", lambda stg: window_winners_stream(stg, STREAM_WATERMARK), late=True, close_each=False)
    return out.agg(F.count("*").alias("windows"), F.countDistinct("position_id").alias("distinct_windows"),
                   F.lit(dropped).cast("long").alias("late_windows"))


@register("stream_ids")
def q_stream_ids(spark, sf_dir):
    """Ids of the replayed batches, each once, though most batches re-land rows of the one before."""
    from ..schemas import RAW_POSITIONS
    from ..sources.events_adapter import replayed_batches
    from ..streaming.pipeline import dedup_ids_stream

    base = scratch_path(spark, "ids")
    batches = replayed_batches(raw_positions(spark, sf_dir, keep_event_id=True)).drop("event_id")
    for hour in (F.hour("ingested_at") == 0, F.hour("ingested_at") == 1, F.hour("ingested_at") >= 2):
        batches.where(hour).write.mode("append").parquet(f"{base}/landing")
        src = spark.readStream.schema(RAW_POSITIONS).parquet(f"{base}/landing")
        q = (dedup_ids_stream(src, STREAM_WATERMARK).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("id")


@register("stream_ingest_fact")
def q_stream_ingest(spark, sf_dir):
    """The position fact after the whole ingest stream: landed JSON payloads with faults, several
    micro-batches, rates computed across them by the exact incremental update."""
    from ..streaming.pipeline import run_ingest_stream
    from .tables import read_fact

    root = scratch_path(spark, "ingested")
    q = run_ingest_stream(spark, _land_payloads(spark, sf_dir), root, f"{root}/ck", max_files_per_trigger=25)
    q.awaitTermination()
    return read_fact(spark, root).drop("dbt_updated_at")     # its stamp is that of the last micro-batch that touched the row


@register("traffic_in_air_sliding")
def q_in_air_sliding(spark, sf_dir):
    from ..operators.insights import aircraft_in_air_sliding
    return aircraft_in_air_sliding(marts(spark, sf_dir).fact)


@register("stream_latest_positions")
def q_stream_latest(spark, sf_dir):
    """Latest position per flight maintained by a streaming aggregation in update
    mode: the fact lands as several files (one micro-batch each), ``max_by``
    keeps one row of state per flight, and every micro-batch's updated keys are
    upserted into a table through ``foreachBatch``."""
    from ..operators.sinks import read_version, replace_keys
    from ..streaming.pipeline import latest_positions_stream

    base = scratch_path(spark, "latest")
    fact = marts(spark, sf_dir).fact
    fact.write.partitionBy("heure_journee").parquet(f"{base}/landing")
    src = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", "4").parquet(f"{base}/landing").select(*fact.columns)
    table = f"{base}/latest"
    q = (latest_positions_stream(src).writeStream.outputMode("update")
         .foreachBatch(lambda df, _epoch: replace_keys(spark, df, table, "vol_sk"))
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return read_version(spark, table, fact.schema)


@register("stream_track_segments")
def q_stream_segments(spark, sf_dir):
    """Track segments per aircraft as streaming session windows (gap 120 s) over
    the landed raw positions; every session closes."""
    from ..streaming.pipeline import track_segments_stream

    return _drain(spark, sf_dir, "segments", lambda stg: track_segments_stream(stg, 120, STREAM_WATERMARK))[0]


from . import catalog_history, catalog_streams  # noqa: E402

REGISTRY |= catalog_history.REGISTRY | catalog_streams.REGISTRY
