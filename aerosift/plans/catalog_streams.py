"""Registered queries of batch segments, sliding windows on a stream, the live stream, corrected late rows and ingest runs.

Each works on the whole events table, landed in slices by ingest hour."""

from __future__ import annotations

from contextlib import nullcontext
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from ..sources.events_adapter import raw_positions

AS_OF = datetime(2024, 1, 1, 3, 0, 0)
REGISTRY = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- track segments in batch (STR7) --------------------------------------------------

@register("track_segments")
def q_segments(spark, sf_dir):
    """Track segments per aircraft from partial segments of each hour, joined across hours, days and months."""
    from ..operators.segments import track_segments
    from ..operators.staging import stage

    return track_segments(stage(raw_positions(spark, sf_dir)))


@register("track_segments_merged")
def q_segments_merged(spark, sf_dir):
    """The same from two deliveries that interleave in time: the stored partials of the first merged with those of the second."""
    from ..operators.segments import hour_segments, join_segments, merge_hours
    from ..operators.staging import stage

    raw = raw_positions(spark, sf_dir, keep_event_id=True)
    second = F.col("event_id") % 3 == 0
    stored = materialize(hour_segments(stage(raw.where(~second))), "segments")
    return join_segments(merge_hours(stored, hour_segments(stage(raw.where(second)))))


@register("corridor_legs")
def q_corridor_legs(spark, sf_dir):
    """Busiest corridors by every cell that a leg between successive positions passes."""
    from ..operators.insights import corridor_legs
    from .catalog import marts

    return corridor_legs(marts(spark, sf_dir).fact)


@register("leg_cell_traffic")
def q_leg_cells(spark, sf_dir):
    """All cells that legs pass, with their legs and flights (no top)."""
    from ..operators.insights import leg_cells, legs
    from .catalog import marts

    return leg_cells(legs(marts(spark, sf_dir).fact)).groupBy("i", "j").agg(
        F.count("*").alias("nb_trajets"), F.countDistinct("vol_sk").alias("avions"))


# ---- sliding windows on a stream (STR7, INS1) -------------------------------------------

@register("stream_traffic_sliding")
def q_stream_sliding(spark, sf_dir):
    """Aircraft in the air per sliding hour from chained stateful operators, over several micro-batches with restarts between."""
    from ..streaming.traffic import in_air_sliding_stream
    from .catalog import STREAM_WATERMARK, _drain

    return _drain(spark, sf_dir, "sliding", lambda stg: in_air_sliding_stream(stg, STREAM_WATERMARK))[0]


# ---- live positions on a stream (STR6, SRV1) ----------------------------------------------

@register("stream_live_positions")
def q_stream_live(spark, sf_dir):
    """Live positions from the slot table that a stream of fact rows keeps, one hour landing after the other; each
    micro-batch meets the dimension and replaces the slots that it touches."""
    from ..streaming.traffic import live_from_slots, run_live_stream
    from .catalog import marts
    from .tables import FACT_PARTITIONS

    base = scratch_path(spark, "live")
    m = marts(spark, sf_dir)
    fact, dim = materialize(m.fact, "live-fact", FACT_PARTITIONS), materialize(m.dim, "live-dim")
    hours = [r[0] for r in fact.where("heure_journee IS NOT NULL").select("date_utc", "heure_journee").distinct()
             .select(F.struct("date_utc", "heure_journee")).collect()]
    for day, hour in sorted(hours):
        # files in the order of time: a micro-batch of some files touches their few slots, not all of the hour
        fact.where((F.col("date_utc") == F.lit(day)) & (F.col("heure_journee") == hour)).repartitionByRange("timestamp_utc").write.mode(
            "append").parquet(f"{base}/landing")
        src = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", "4").parquet(f"{base}/landing")
        run_live_stream(src, lambda: dim, f"{base}/slots", f"{base}/ck").awaitTermination()
    return live_from_slots(spark, f"{base}/slots", AS_OF)


# ---- late rows corrected (STR4) --------------------------------------------------------------

LATE_S = 3 * 3600


def with_late_rows(raw_e: DataFrame) -> DataFrame:
    """Every eleventh row reaches the feed three hours after its batch."""
    from ..functions.timecols import shift_seconds

    late = F.col("event_id") % 11 == 0
    return raw_e.withColumn("ingested_at", F.when(late, shift_seconds("ingested_at", LATE_S)).otherwise(F.col("ingested_at"))).drop("event_id")


@register("stream_late_corrected")
def q_late_corrected(spark, sf_dir):
    """The intermediate layer after a stream with late rows: on-time winners as their windows close, late rows kept in a side table
    and then merged into the stored winners, a second time as well."""
    from ..operators.staging import stage
    from ..schemas import RAW_POSITIONS
    from ..streaming.late import WINNER, merge_winners, rated_winners, run_corrected_streams, winners_of
    from ..streaming.pipeline import data_batches_only
    from .catalog import CLOSING, closing_row

    root = scratch_path(spark, "corrected")
    raw = with_late_rows(raw_positions(spark, sf_dir, keep_event_id=True))
    hour = F.hour("ingested_at")

    def stg_of():
        return stage(spark.readStream.schema(RAW_POSITIONS).parquet(f"{root}/landing"))

    slices = [raw.where(hour == 0), raw.where(hour == 1), raw.where(hour == 2), raw.where(hour >= 3), closing_row(spark)]
    for landed in slices:
        landed.write.mode("append").parquet(f"{root}/landing")
        # the windows that a slice closes leave with the next one's batch, those of the last one at once
        with data_batches_only(spark) if landed is not slices[-1] else nullcontext():
            run_corrected_streams(spark, stg_of, root)
    late = spark.read.parquet(f"{root}/late")
    for _ in range(2):
        merge_winners(spark, winners_of(late), f"{root}/winners")
    return rated_winners(spark.read.parquet(f"{root}/winners").select(*WINNER).where(F.col("icao24") != CLOSING))


# ---- landed batches and ingest runs (SRC3, SRC4, SRC7, SNK5, SNK7, DQ17, DQ18) ------------------

@register("landed_batches")
def q_landed(spark, sf_dir):
    """Each ingest hour's batch landed, the first one twice, and read back with the row count that the writer observed;
    a batch that never landed reads as an empty one."""
    from ..sources.states import read_batch, write_batch
    from .catalog_history import _by_hour

    root, out = scratch_path(spark, "landed"), None
    batches = list(_by_hour(spark, raw_positions(spark, sf_dir)))
    written = {key: write_batch(batch, f"{root}/{key}") for key, batch in [*batches, batches[0]]}
    for key in [*written, "never"]:
        back = read_batch(spark, f"{root}/{key}").withColumns({"batch_key": F.lit(key), "written": F.lit(written.get(key, 0)).cast("long")})
        out = back if out is None else out.unionByName(back)
    return out


@register("raw_lookback")
def q_lookback(spark, sf_dir):
    """The upstream incremental selection: rows that arrived in the last two hours."""
    from .incremental import lookback_slice

    return lookback_slice(raw_positions(spark, sf_dir), AS_OF, 2)


CHECK_EVERY = 2


@register("ingest_run_log")
def q_ingest_runs(spark, sf_dir):
    """Ingest runs over the landed payloads, an hour each, then the last one again and one without positions: what each
    loaded, what it rejected, and the check results that the store holds for its run id. Every second run id, by hash, validates."""
    from ..sources.states import read_states
    from .catalog import _land_payloads
    from .ingest import ingest_run

    root = scratch_path(spark, "runs")
    states = read_states(spark, _land_payloads(spark, sf_dir)).withColumn("_hour", F.floor(F.col("payload_time") / 3600))
    states = materialize(states, "run-states", ["_hour"])
    hours = sorted(r[0] for r in states.where("_hour IS NOT NULL").select("_hour").distinct().collect())
    first = int(AS_OF.replace(tzinfo=timezone.utc).timestamp()) // 3600 - 3
    log = []
    for step, at in enumerate([*hours, hours[-1], None]):
        run_id = "empty" if at is None else f"run-{at - first}"
        stats = ingest_run(spark, states.limit(0) if at is None else states.where(F.col("_hour") == at), f"{root}/raw", AS_OF, run_id,
                           results_path=f"{root}/checks", check_every=CHECK_EVERY)
        log.append((step, run_id, stats["inserted"], stats["skipped"], stats["total"], stats["rejects"]))
    runs = spark.createDataFrame(log, "step int, run_id string, inserted long, skipped long, total long, rejects long")
    stored = spark.read.parquet(f"{root}/checks").groupBy("run_id").agg(F.count("*").alias("stored_checks"))
    return runs.join(stored, "run_id", "left").withColumn("stored_checks", F.coalesce("stored_checks", F.lit(0).cast("long")))


@register("dq_enforced")
def q_enforced(spark, sf_dir):
    """What ``enforce`` does with each mart suite, warning and raising."""
    from ..operators.quality import DIM_TESTS, FACT_SUITE, FACT_TESTS, STG_TESTS, enforce, run_suite
    from .catalog import marts

    m, rows = marts(spark, sf_dir), []
    for name, frame, suite in (("stg", m.stg, STG_TESTS), ("dim", m.dim, DIM_TESTS), ("fact", m.fact, FACT_TESTS), ("fact", m.fact, FACT_SUITE)):
        results = materialize(run_suite(frame, suite, refs={"dim_vols": m.dim}), f"enforce-{name}")
        for action in ("warn", "raise"):
            try:
                enforce(results, action)
                outcome = "passed"
            except RuntimeError:
                outcome = "blocked"
            rows.append((suite.name, action, outcome))
    return spark.createDataFrame(rows, "suite string, on_failure string, outcome string")
