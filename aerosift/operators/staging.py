"""Staging: identifiers cleaned, epochs typed, units converted, quality flags.

Pure projection + filter: narrow, codegen'd, and the mandatory-field filter
is pushed into the Parquet scan when the raw table is read from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_to_ntz

# Unit factors and plausibility limits.
M_TO_FT = 3.28084
MS_TO_KMH = 3.6
MAX_BARO_ALTITUDE = 45000   # metres, as coded (the comment upstream says ~13,700 m)
MAX_SPEED_MS = 340


def _flag(cond):
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def stage(raw: DataFrame) -> DataFrame:
    r = raw
    lat, lon = F.col("latitude"), F.col("longitude")
    baro, v = F.col("baro_altitude"), F.col("vitesse")
    return (
        r.filter(lat.isNotNull() & lon.isNotNull() & F.col("icao24").isNotNull())
        .select(
            F.col("id").alias("position_id_raw"),
            F.lower(F.trim("icao24")).alias("icao24"),
            F.upper(F.trim("callsign")).alias("callsign"),
            F.trim("origine_pays").alias("origine_pays"),
            epoch_to_ntz("time_position").alias("timestamp_position_utc"),
            epoch_to_ntz("last_contact").alias("dernier_contact_utc"),
            "ingested_at",
            "batch_id",
            F.round(lat.cast("double"), 6).alias("latitude"),
            F.round(lon.cast("double"), 6).alias("longitude"),
            F.round(baro.cast("double"), 1).alias("altitude_baro_m"),
            F.round(F.col("geo_altitude").cast("double"), 1).alias("altitude_geo_m"),
            F.round(baro.cast("double") * M_TO_FT, 0).alias("altitude_baro_ft"),
            F.round(F.col("geo_altitude").cast("double") * M_TO_FT, 0).alias("altitude_geo_ft"),
            F.round(v.cast("double"), 1).alias("vitesse_ms"),
            F.round(v.cast("double") * MS_TO_KMH, 1).alias("vitesse_kmh"),
            F.round(F.col("cap").cast("double"), 1).alias("cap_degres"),
            F.round(F.col("taux_montee").cast("double"), 1).alias("taux_montee_ms"),
            F.col("au_sol").cast("boolean").alias("au_sol"),
            "squawk",
            F.col("source_position").cast("int").alias("source_capteur"),
            _flag((baro < 0) | (baro > MAX_BARO_ALTITUDE)).alias("flag_altitude_suspecte"),
            _flag((v < 0) | (v > MAX_SPEED_MS)).alias("flag_vitesse_suspecte"),
            _flag(lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180))
            .alias("flag_coords_invalides"),
        )
    )
