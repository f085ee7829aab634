"""30-second dedup per aircraft, computed climb rate and altitude-jump flag.

Clean rows are dealt once by (aircraft, hour chunk), see ``continuity``: inside a
chunk ``row_number`` picks the winner of each 30 s window (sensor quality, highest
altitude, earliest ingest, raw id), and ``lag`` over the winners gives the
previous position. Both windows are satisfied by the one exchange, and the
second by the first one's sort. Rows of the last 120 s of a chunk are also in the
next chunk, so the lag is right across its start; these copies are dropped last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.kinematics import altitude_jump, climb_rate
from ..functions.timecols import bucket_start, ntz_to_epoch
from ..schemas import INT_COLUMNS
from .continuity import previous_in_chunk, with_chunks

NO_SOURCE_SCORE = 99  # fixed value: quality score when the sensor source is unknown

STG_PAYLOAD = [
    "position_id_raw", "icao24", "callsign", "origine_pays", "timestamp_position_utc", "ingested_at",
    "batch_id", "latitude", "longitude", "altitude_baro_m", "altitude_geo_m", "altitude_baro_ft",
    "vitesse_ms", "vitesse_kmh", "cap_degres", "taux_montee_ms", "au_sol", "squawk", "source_capteur",
]


def clean_rows(stg: DataFrame) -> DataFrame:
    """Rows with none of the three staging flags (flags are never NULL)."""
    return stg.filter(~F.col("flag_altitude_suspecte") & ~F.col("flag_vitesse_suspecte")
                      & ~F.col("flag_coords_invalides"))


def windowed(stg: DataFrame, window_s: int = 30) -> DataFrame:
    return clean_rows(stg).withColumn(
        "window_30s", bucket_start("timestamp_position_utc", window_s)
    ).withColumn("quality_score", F.coalesce(F.col("source_capteur"), F.lit(NO_SOURCE_SCORE)))


def dedup_order():
    """Ascending struct = quality ASC, altitude DESC NULLS LAST, ingest ASC NULLS LAST, id ASC NULLS LAST."""
    alt, ing, rid = F.col("altitude_baro_m"), F.col("ingested_at"), F.col("position_id_raw")
    return [F.col("quality_score"), alt.isNull(), -alt, ing.isNull(), ing, rid.isNull(), rid]


def window_winners(stg: DataFrame, window_s: int = 30) -> DataFrame:
    """Best row per (icao24, window) with ``row_number() = 1`` (the plain form;
    Catalyst adds a partial WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy("icao24", "window_30s").orderBy(
        F.col("quality_score").asc(), F.col("altitude_baro_m").desc_nulls_last(),
        F.col("ingested_at").asc_nulls_last(), F.col("position_id_raw").asc_nulls_last())
    return (windowed(stg, window_s).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def winners_with_previous(stg: DataFrame, window_s: int = 30, max_gap_s: int = 120) -> DataFrame:
    """Window winners plus ``prev_timestamp`` / ``prev_altitude_m``, with one shuffle."""
    rows = windowed(stg, window_s).select("icao24", "window_30s", "quality_score", *[c for c in STG_PAYLOAD if c != "icao24"])
    dealt = with_chunks(rows, "window_30s", window_s, max_gap_s).repartition("icao24", "_chunk")
    best = Window.partitionBy("icao24", "_chunk", "window_30s").orderBy(*dedup_order())
    winners = dealt.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")
    return previous_in_chunk(winners, "icao24", "window_30s", "timestamp_position_utc", ["altitude_baro_m"], "_prev_").withColumnsRenamed(
        {"_prev_timestamp_position_utc": "prev_timestamp", "_prev_altitude_baro_m": "prev_altitude_m"})


def dedup(stg: DataFrame, window_s: int = 30, max_gap_s: int = 120, max_rate: int = 100) -> DataFrame:
    """Intermediate layer: one row per (icao24, 30 s window), 23 columns."""
    p = winners_with_previous(stg, window_s, max_gap_s)
    dt = ntz_to_epoch("timestamp_position_utc") - ntz_to_epoch("prev_timestamp")
    return p.withColumn("_dt", dt).select(
        surrogate_key("icao24", "window_30s").alias("position_id"),
        "icao24", "callsign", "origine_pays", "timestamp_position_utc", "window_30s",
        "ingested_at", "batch_id", "latitude", "longitude", "altitude_baro_m", "altitude_geo_m",
        "altitude_baro_ft", "vitesse_ms", "vitesse_kmh", "cap_degres",
        F.col("taux_montee_ms").alias("taux_montee_declare_ms"),
        climb_rate("altitude_baro_m", "prev_altitude_m", "_dt", max_gap_s).alias("taux_montee_calcule_ms"),
        "au_sol", "squawk", "source_capteur", "quality_score",
        altitude_jump("altitude_baro_m", "prev_altitude_m", "_dt", max_gap_s, max_rate)
        .alias("flag_changement_altitude_suspect"),
    ).select(*INT_COLUMNS)
