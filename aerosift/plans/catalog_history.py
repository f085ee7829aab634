"""Registered queries over tables that change: schema drift, the change feed, incremental checks, rollups.

Each works on the whole events table, landed in slices by ingest hour."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sinks import EVENT_PARTITIONS, with_event_date
from ..session import materialize, scratch_path
from ..sources.events_adapter import awkward_batches, raw_positions, replayed_batches

AS_OF = datetime(2024, 1, 1, 3, 0, 0)
REGISTRY = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- schema drift (SNK8) -------------------------------------------------------

def drifting_batches(raw_e: DataFrame) -> list[DataFrame]:
    """Three deliveries under three schemas: columns arrive, go and widen; the third lands rows of the second again."""
    raw_e = with_event_date(raw_e)
    hour = F.hour("ingested_at")
    always = ["id", "icao24", "event_id", "time_position", "baro_altitude", "ingested_at", *EVENT_PARTITIONS]
    first = raw_e.where(hour == 0).select(*always, "squawk", F.col("last_contact").cast("int").alias("last_contact"), "source_position")
    second = raw_e.where(hour == 1).select(*always, "last_contact", "source_position", "squawk", "au_sol", "callsign")
    third = raw_e.where((hour >= 2) | ((hour == 1) & (F.col("event_id") % 10 == 0))).select(
        "callsign", *always, "last_contact", F.concat(F.lit("s"), "source_position").alias("source_position"), "au_sol", "geo_altitude")
    return [first, second, third]


@register("schema_drift_sync")
def q_drift(spark, sf_dir):
    """The raw table after insert-only merges of three deliveries under three schemas (sync_all_columns)."""
    from ..operators.drift import merge_drifting, read_drifting

    table = scratch_path(spark, "drift")
    for batch in drifting_batches(raw_positions(spark, sf_dir, keep_event_id=True)):
        merge_drifting(spark, batch, table, "id", EVENT_PARTITIONS, "icao24", ["ingested_at", "event_id"])
    return read_drifting(spark, table, EVENT_PARTITIONS)


@register("schema_drift_upsert")
def q_drift_upsert(spark, sf_dir):
    """The fact under a model that changes twice: the second version adds columns and rewrites the hours it
    touches, the third widens one and removes one; hours that no later version touched keep their files."""
    from ..operators.drift import read_drifting, upsert_drifting
    from .catalog import marts
    from .tables import FACT_PARTITIONS

    fact = materialize(marts(spark, sf_dir).fact, "drift-fact")
    table, hour = scratch_path(spark, "drift-upsert"), F.col("heure_journee")
    base = ["position_sk", "vol_sk", "timestamp_utc", *FACT_PARTITIONS, "altitude_baro_ft"]
    versions = [fact.where(hour < 2).select(*base, "vitesse_kmh", F.col("jour_semaine").cast("short").alias("jour_semaine")),
                fact.where(hour == 1).select(*base, "vitesse_kmh", "jour_semaine", "phase_vol", "tranche_vol"),
                fact.where(hour >= 2).select(*base, F.col("jour_semaine").cast("long").alias("jour_semaine"), "tranche_vol", "phase_vol")]
    for rows in versions:
        upsert_drifting(spark, rows, table, "position_sk", FACT_PARTITIONS, "vol_sk")
    return read_drifting(spark, table, FACT_PARTITIONS)


# ---- change feed (SNK1, SRC7) ---------------------------------------------------

def _by_hour(spark, batches: DataFrame):
    """(batch key, batch) for each ingest hour, in order."""
    batches = materialize(batches, "feed-batches")
    day_hour = F.date_format("ingested_at", "yyyy-MM-dd-HH")
    for (key,) in sorted(batches.select(day_hour).distinct().collect()):
        yield key, batches.where(day_hour == key)


@register("raw_change_feed")
def q_feed(spark, sf_dir):
    """What each merged batch inserted, as its feed entry keeps it; the last batch lands twice and inserts nothing then."""
    from ..operators.feed import entries, merge_to_feed, read_feed

    table, feed = scratch_path(spark, "feed-raw"), scratch_path(spark, "feed")
    for key, batch in _by_hour(spark, awkward_batches(raw_positions(spark, sf_dir, keep_event_id=True))):
        merge_to_feed(spark, batch, table, feed, key)
    merge_to_feed(spark, batch, table, feed, key)
    return read_feed(spark, feed, entries(spark, feed)).drop(*EVENT_PARTITIONS)


@register("fact_change_feed")
def q_feed_fact(spark, sf_dir):
    """The fact kept up to date from the change feed: built from the first entry, then updated with two entries at a time,
    whatever their age (no look-back)."""
    from ..operators.feed import apply_feed, merge_to_feed
    from ..operators.sinks import RAW_TABLE
    from .incremental import incremental_update
    from .tables import build_tables, read_fact

    root = scratch_path(spark, "feed-marts")
    table, feed = f"{root}/raw", f"{root}/feed"

    def update(rows):
        raw = spark.read.schema(RAW_TABLE).parquet(table)
        incremental_update(spark, root, raw, rows, AS_OF)

    def build(rows):
        build_tables(spark, rows, root, AS_OF)

    for i, (key, batch) in enumerate(_by_hour(spark, replayed_batches(raw_positions(spark, sf_dir, keep_event_id=True)))):
        merge_to_feed(spark, batch, table, feed, key)
        if i % 2 == 0:
            apply_feed(spark, table, feed, "marts", update if i else build)
    apply_feed(spark, table, feed, "marts", update)
    return read_fact(spark, root)


# ---- state on streams (STR5) -------------------------------------------------------

@register("stream_state_rates")
def q_state_rates(spark, sf_dir):
    """Climb rates from per-aircraft state, over several micro-batches with restarts between; every window closes."""
    from ..streaming.rates import rocksdb_state, state_rates_stream
    from .catalog import STREAM_WATERMARK, _drain

    with rocksdb_state(spark):
        return _drain(spark, sf_dir, "rates", lambda stg: state_rates_stream(stg, STREAM_WATERMARK))[0]


# ---- incremental suites (DQ19) -------------------------------------------------------

def _in_slices(spark, sf_dir, follow) -> str:
    """The marts built from the rows of the first two hours, then updated with the rest. ``follow(root, touched)`` is called
    after both, with the hours that were written. Returns the tables' root."""
    from ..functions.timecols import ntz_literal
    from .catalog import INCREMENTAL_CUT
    from .incremental import incremental_update
    from .tables import FACT_PARTITIONS, build_tables, read_fact

    raw = raw_positions(spark, sf_dir)
    root, early = scratch_path(spark, "sliced-marts"), F.col("ingested_at") < ntz_literal(INCREMENTAL_CUT)
    build_tables(spark, raw.where(early), root, AS_OF)
    follow(root, read_fact(spark, root).select(*FACT_PARTITIONS).distinct())
    incremental_update(spark, root, raw, raw.where(~early), AS_OF,
                       on_delta=lambda delta: follow(root, delta.select(*FACT_PARTITIONS).distinct()))
    return root


def _checked_in_slices(spark, sf_dir, suite, pinned=()):
    """``_in_slices`` with the suite's states kept up to date; returns the root of the tables and that of the states."""
    from ..operators.quality_state import update_states
    from .tables import FACT_PARTITIONS, read_fact

    root = _in_slices(spark, sf_dir, lambda root, touched: update_states(
        spark, read_fact(spark, root), touched, f"{root}/dq", suite, FACT_PARTITIONS, pinned))
    return root, f"{root}/dq"


@register("dq_fact_incremental")
def q_dq_incremental(spark, sf_dir):
    """The fact suite from states of each hour; the update checked the hours that it rewrote, no others."""
    from ..operators.quality import FACT_SUITE
    from ..operators.quality_state import suite_results
    from .tables import FACT_PARTITIONS, read_fact

    pinned = ("position_sk",)        # hashes the row's own 30 s window, which lies in one hour
    root, states = _checked_in_slices(spark, sf_dir, FACT_SUITE, pinned)
    return suite_results(spark, read_fact(spark, root), states, FACT_SUITE, FACT_PARTITIONS, pinned)


@register("dq_mart_incremental")
def q_dq_mart_incremental(spark, sf_dir):
    """The fact's model tests, the foreign key among them, from states of each hour."""
    from ..operators.quality import FACT_TESTS
    from ..operators.quality_state import suite_results
    from .tables import FACT_PARTITIONS, read_dim, read_fact

    root, states = _checked_in_slices(spark, sf_dir, FACT_TESTS)
    return suite_results(spark, read_fact(spark, root), states, FACT_TESTS, FACT_PARTITIONS, (), {"dim_vols": read_dim(spark, root)})


# ---- bitmap rollups (INS1, INS3, INS4) -------------------------------------------------

def _rolled_up(spark, sf_dir) -> str:
    from ..operators.rollups import update_rollups
    from .tables import read_fact

    return _in_slices(spark, sf_dir, lambda root, touched: update_rollups(spark, read_fact(spark, root), touched, f"{root}/rollup"))


RANGE = (datetime(2024, 1, 1, 0, 50), datetime(2024, 1, 1, 2, 20))


@register("rollup_traffic")
def q_rollup_traffic(spark, sf_dir):
    """Distinct aircraft from the hour bitmaps, after an update that replaced the touched hours only: for each slot and each sliding
    hour in the air, each weekday and hour, and one range that begins and ends inside an hour."""
    from ..functions.timecols import ntz_literal
    from ..operators import rollups as r

    rollup = r.read_rollup(spark, f"{_rolled_up(spark, sf_dir)}/rollup")
    none = {"debut": F.lit(None).cast("timestamp_ntz"), "jour_semaine": F.lit(None).cast("int"), "heure_journee": F.lit(None).cast("int")}
    answers = {"slot": r.in_air(rollup).withColumnRenamed("tranche_10min", "debut"), "sliding": r.in_air_sliding(rollup),
               "hour": r.by_hour(rollup), "range": r.distinct_aircraft(r.in_range(rollup, *map(ntz_literal, RANGE)))}
    out = None
    for name, frame in answers.items():
        frame = frame.select(F.lit(name).alias("question"), *[F.col(c) if c in frame.columns else v.alias(c) for c, v in none.items()],
                             "avions", "nb_positions")
        out = frame if out is None else out.unionByName(frame)
    return out


@register("rollup_by_country")
def q_rollup_country(spark, sf_dir):
    """Aircraft seen in a range, by country, from bitmaps alone."""
    from ..functions.timecols import ntz_literal
    from ..operators import rollups as r
    from .tables import read_dim

    root = _rolled_up(spark, sf_dir)
    rollup = r.in_range(r.read_rollup(spark, f"{root}/rollup"), *map(ntz_literal, RANGE))
    return r.by_country(rollup, r.numbers(spark, f"{root}/rollup"), read_dim(spark, root))
