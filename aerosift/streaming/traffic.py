"""Traffic on a stream: sliding windows (STR7, INS1) and the live picture (STR6, SRV1).

* ``in_air_sliding_stream`` chains three stateful operators on one watermark: the 30 s dedup, the positions of each
  aircraft in each sliding window, and the aircraft of each window (a distinct count is no streaming aggregate). A
  window leaves once the watermark has passed its end; the last step combines before its shuffle, so a busy window is not one task's.
* ``latest_by_slot_stream`` keeps the newest airborne position of each flight and time slot; state of a slot goes when the
  watermark has passed it. ``store_slots`` joins a micro-batch with the dimension as it is then and replaces rows in the
  touched slots only. ``live_from_slots`` answers ``serving.live_positions`` from the slots of its time range.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.timecols import bucket_start, ntz_literal, ntz_to_epoch
from ..operators.serving import LIVE_COLUMNS
from ..operators.sinks import read_if_exists, upsert
from ..session import delete_path, scratch_path
from .pipeline import EVENT_TS, _event_time, naive, window_winners_stream

SLOT_S = 600
DIM_COLUMNS = ["icao24", "callsign_principal", "compagnie_nom", "origine_pays"]


def in_air_sliding_stream(stg: DataFrame, watermark: str = "2 hours", size_s: int = 3600, slide_s: int = 600) -> DataFrame:
    """``insights.aircraft_in_air_sliding`` on a stream of staged rows (append mode)."""
    if size_s % slide_s:
        raise ValueError("size_s must be a multiple of slide_s")
    airborne = window_winners_stream(stg, watermark, event_time=True).where("NOT au_sol")
    per_aircraft = airborne.groupBy("icao24", F.window("event_time", f"{size_s} seconds", f"{slide_s} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"))
    return per_aircraft.groupBy("w").agg(F.count(F.lit(1)).alias("avions_en_vol"), F.sum("n").alias("nb_positions")).select(
        naive("w.start").alias("debut"), naive("w.end").alias("fin"),
        "avions_en_vol", "nb_positions")


def latest_by_slot_stream(fact_rows: DataFrame, watermark: str = "2 hours", slot_s: int = SLOT_S) -> DataFrame:
    """Newest airborne position of each (flight, slot) of a stream of fact rows (update mode)."""
    kept = [c for c in LIVE_COLUMNS if c not in DIM_COLUMNS]
    rows = _event_time(fact_rows.where("NOT au_sol AND latitude IS NOT NULL AND longitude IS NOT NULL"), "timestamp_utc")
    slots = rows.withWatermark(EVENT_TS, watermark).groupBy("vol_sk", F.window(EVENT_TS, f"{slot_s} seconds").alias("_slot")).agg(
        F.max_by(F.struct(*kept), "timestamp_utc").alias("_r"))
    return slots.select("vol_sk", "_r.*")


def store_slots(spark: SparkSession, rows: DataFrame, dim: DataFrame, table: str, slot_s: int = SLOT_S) -> None:
    """Replace the rows of a micro-batch in the touched slots. A flight that the dimension does not know yet is stored without its columns."""
    path = scratch_path(spark, "slots")
    named = rows.join(dim.select("vol_sk", *DIM_COLUMNS), "vol_sk", "left")
    slot = bucket_start("timestamp_utc", slot_s)
    named.select(surrogate_key("vol_sk", slot).alias("slot_sk"), "vol_sk", *LIVE_COLUMNS,
                 ntz_to_epoch(slot).alias("slot_s")).write.parquet(path)
    new = spark.read.parquet(path)
    if not new.isEmpty():
        upsert(spark, new, table, "slot_sk", "slot_s", "vol_sk")
    delete_path(spark, path)


def run_live_stream(fact_rows: DataFrame, dim_of, table: str, checkpoint_location: str, watermark: str = "2 hours"):
    """Start the live stream over what is there; ``dim_of()`` reads the dimension, once a micro-batch."""
    spark = fact_rows.sparkSession
    return (latest_by_slot_stream(fact_rows, watermark).writeStream.outputMode("update")
            .foreachBatch(lambda rows, _epoch: store_slots(spark, rows, dim_of(), table))
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())


SLOT_SCHEMA = ("slot_sk string, vol_sk string, icao24 string, callsign_principal string, compagnie_nom string, origine_pays string, "
               "latitude double, longitude double, altitude_baro_ft double, vitesse_kmh double, cap_degres double, phase_vol string, "
               "taux_montee_calcule_ms double, taux_montee_declare_ms double, flag_changement_altitude_suspect boolean, "
               "timestamp_utc timestamp_ntz, slot_s bigint")


def live_from_slots(spark: SparkSession, table: str, as_of: datetime, hours: float = 1, slot_s: int = SLOT_S) -> DataFrame:
    """``serving.live_positions`` from the slot table; only slots of the time range are read. The newest position of a slot
    decides whether any of its positions lies in the range, so slots that begin before the range are right too."""
    since = as_of - timedelta(hours=hours)
    first = int(since.replace(tzinfo=timezone.utc).timestamp()) // slot_s * slot_s
    stored = read_if_exists(spark, table, SLOT_SCHEMA)
    if stored is None:
        stored = spark.createDataFrame([], SLOT_SCHEMA)
    newest = Window.partitionBy("vol_sk").orderBy(F.col("timestamp_utc").desc_nulls_last())
    rows = stored.where((F.col("slot_s") >= first) & (F.col("timestamp_utc") >= ntz_literal(since)))
    return (rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1 AND icao24 IS NOT NULL")
            .select(*LIVE_COLUMNS).orderBy(F.col("altitude_baro_ft").desc_nulls_last()))
