"""Deterministic adapter: the driver's ``events`` table -> raw aircraft positions.

The test data has no aircraft feed, so each event becomes one state vector
(formulas fixed in FIXTURES.md §3). Everything is integer arithmetic until
a final double division, so any SQL engine produces the same bits. The
adapter is a pure projection (narrow, no shuffle): it scales with the
events table and keeps its partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import position_id
from ..schemas import RAW_COLUMNS
from ..session import compiled_steps

# ---- Fixed values of the adapter (FIXTURES.md §3) --------------------------
EPOCH0 = 1704067200          # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 240       # 30 days -> 3 hours
ICAO_BASE = 11259375         # 0xabcdef
CALLSIGN_PREFIXES = ["AFR", "EZY", "RYR", "BAW", "DLH", "IBE", "HOP", "TVF", "VLG", "AEE", "klm"]
COUNTRIES = ["France", "Germany", "Ireland", " Spain "]
# ---------------------------------------------------------------------------


def _arr(values) -> str:
    return "array(" + ", ".join("'" + v + "'" for v in values) + ")"


def raw_positions_from_events(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Project events to the 18 raw columns (plus ``event_id`` when asked)."""
    e = "event_id"
    u = "user_id"
    base = events.select(
        F.col(e).alias("e"),
        F.col(u).alias("u"),
        F.expr(f"{EPOCH0} + (timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) - {EPOCH0})"
               f" div {TIME_COMPRESSION}").alias("t"),
    )
    base = base.withColumn("m", F.expr("(t + u * 37) % 7200"))
    base = base.withColumn("tri", F.expr("CASE WHEN m < 3600 THEN m ELSE 7200 - m END"))
    base = base.withColumn("dm", F.expr("least(90000, (tri * 100) div 3)"))
    base = base.withColumn("h", F.expr(f"lpad(lower(hex(u + {ICAO_BASE})), 6, '0')"))
    cols = {
        "icao24": "CASE WHEN e % 197 = 0 THEN NULL WHEN e % 7 = 0 THEN upper(concat(h, ' ')) ELSE h END",
        "callsign": (
            "CASE WHEN u % 13 = 12 THEN NULL WHEN u % 13 = 11 THEN 'AB' "
            f"ELSE concat(element_at({_arr(CALLSIGN_PREFIXES)}, CAST(u % 13 + 1 AS INT)), "
            "CAST(100 + u % 900 AS STRING), CASE WHEN e % 5 = 0 THEN 'B ' ELSE ' ' END) END"
        ),
        "origine_pays": f"element_at({_arr(COUNTRIES)}, CAST(u % 4 + 1 AS INT))",
        "time_position": "CAST(t AS BIGINT)",
        "last_contact": "CAST(t + e % 5 AS BIGINT)",
        "longitude": (
            "CASE WHEN e % 101 = 0 THEN NULL WHEN e % 307 = 0 THEN CAST(200 AS DOUBLE) "
            "ELSE CAST((e * 7919) % 15501 - 5500 AS DOUBLE) / CAST(1000 AS DOUBLE) END"
        ),
        "latitude": "CAST(41000 + (e * 104729) % 10501 AS DOUBLE) / CAST(1000 AS DOUBLE)",
        "geo_altitude": "CAST(dm + 500 AS DOUBLE) / CAST(10 AS DOUBLE)",
        "baro_altitude": (
            "CASE WHEN e % 71 = 0 THEN NULL WHEN e % 89 = 0 THEN CAST(-120.5 AS DOUBLE) "
            "WHEN e % 367 = 0 THEN CAST(46000 AS DOUBLE) "
            "WHEN e % 53 = 0 THEN CAST(dm + 200000 AS DOUBLE) / CAST(10 AS DOUBLE) "
            "ELSE CAST(dm AS DOUBLE) / CAST(10 AS DOUBLE) END"
        ),
        "au_sol": "CASE WHEN e % 499 = 0 THEN NULL ELSE tri < 30 END",
        "vitesse": (
            "CASE WHEN e % 139 = 0 THEN NULL WHEN e % 113 = 0 THEN CAST(-1 AS DOUBLE) "
            "WHEN e % 127 = 0 THEN CAST(345 AS DOUBLE) "
            "ELSE CAST((e * 31) % 3300 AS DOUBLE) / CAST(10 AS DOUBLE) END"
        ),
        "cap": "CAST((e * 17) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE)",
        "taux_montee": "CAST((e * 13) % 301 - 150 AS DOUBLE) / CAST(10 AS DOUBLE)",
        "squawk": "lpad(CAST(e % 7778 AS STRING), 4, '0')",
        "source_position": "CAST(CASE WHEN e % 5 = 4 THEN NULL ELSE e % 5 END AS INT)",
        "ingested_at": "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, ((t div 600) + 1) * 600)",
        "batch_id": "md5(CAST(t div 600 AS STRING))",
    }
    out = base.select(F.col("e").alias("event_id"), *[F.expr(v).alias(k) for k, v in cols.items()])
    out = out.withColumn("id", position_id("icao24", "time_position", "latitude", "longitude"))
    return out.select(*RAW_COLUMNS, *(["event_id"] if keep_event_id else []))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_positions(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """Raw position table derived from ``{sf_dir}/events.parquet``."""
    compiled_steps(spark)
    events = read_events(spark, sf_dir).select("event_id", "user_id", "ts")
    return raw_positions_from_events(events, keep_event_id)


def replayed_batches(raw_e: DataFrame) -> DataFrame:
    """Landed batches with the fixture's duplicates (FIXTURES.md §3): every row
    in its own 10-minute batch, rows with ``event_id % 10 = 0`` landed again in
    the following batch, rows with ``event_id % 50 = 0`` twice in their own."""
    from ..functions.timecols import ntz_to_epoch, shift_seconds

    nxt = ntz_to_epoch("ingested_at")
    replay = raw_e.filter(F.col("event_id") % 10 == 0).withColumn(
        "batch_id", F.md5((nxt.cast("long") / 600).cast("long").cast("string"))
    ).withColumn("ingested_at", shift_seconds("ingested_at", 600))
    twins = raw_e.filter(F.col("event_id") % 50 == 0)
    return raw_e.unionByName(replay).unionByName(twins)


def awkward_batches(raw_e: DataFrame) -> DataFrame:
    """``replayed_batches`` with the two cases that a merge gets wrong most easily: rows with
    ``event_id % 83 = 0`` have no time (their id follows), and the twins of a batch differ in their squawk."""
    untimed = F.col("event_id") % 83 == 0
    raw_e = raw_e.withColumn("time_position", F.when(~untimed, F.col("time_position")))
    raw_e = raw_e.withColumn("id", position_id("icao24", "time_position", "latitude", "longitude"))
    twins = raw_e.filter(F.col("event_id") % 50 == 0).withColumn("squawk", F.lit("0000"))
    return replayed_batches(raw_e).unionByName(twins).drop("event_id")


def payloads(raw_e: DataFrame) -> DataFrame:
    """The raw table as landed payloads, four per 10-minute batch: (time, states) and the folder (slot, part) of its file.

    Faults (FIXTURES.md §3 has the others): ``event_id % 41 = 0`` a time that is no number, ``% 43 = 0`` an altitude
    that is none, ``% 47 = 0`` an array that ends before ``au_sol``, callsigns padded with blanks."""
    from ..functions.timecols import ntz_to_epoch
    from ..schemas import STATE_FIELDS

    e = F.col("event_id")
    text = {c: F.col(c).cast("string") for c in STATE_FIELDS if c not in ("sensors", "spi")}
    text["callsign"] = F.concat(F.lit(" "), F.col("callsign"), F.lit("  "))
    text["time_position"] = F.when(e % 41 == 0, "notatime").otherwise(text["time_position"])
    text["baro_altitude"] = F.when(e % 43 == 0, "n/a").otherwise(text["baro_altitude"])
    full = F.array(*[text.get(c, F.lit(None).cast("string")) for c in STATE_FIELDS])
    state = F.when(e % 47 == 0, F.slice(full, 1, STATE_FIELDS.index("au_sol"))).otherwise(full)
    return raw_e.select(ntz_to_epoch("ingested_at").alias("time"), (e % 4).alias("part"), state.alias("state")).groupBy("time", "part").agg(
        F.collect_list("state").alias("states")).withColumn("slot", F.col("time"))
