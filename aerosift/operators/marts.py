"""Star schema: flight dimension (one row per aircraft) and position fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import airline_code, airline_name, flight_band, flight_phase
from ..functions.keys import surrogate_key
from ..functions.timecols import bucket_start, ntz_literal
from ..schemas import DIM_COLUMNS, FACT_COLUMNS


def callsign_groups(inter: DataFrame) -> DataFrame:
    """First/last seen and position count per (icao24, callsign, country).

    Hash aggregate with a partial (map-side) step: the shuffle carries one
    row per group per map task, whatever the skew of the input.
    """
    return inter.groupBy("icao24", "callsign", "origine_pays").agg(
        F.min("timestamp_position_utc").alias("premiere_vue_utc"),
        F.max("timestamp_position_utc").alias("derniere_vue_utc"),
        F.count(F.lit(1)).alias("nb_positions_total"),
    )


def merge_groups(partials: DataFrame) -> DataFrame:
    """Combine partial group stats (e.g. one row per group and hour) into
    whole-history stats: min of minima, max of maxima, sum of counts."""
    return partials.groupBy("icao24", "callsign", "origine_pays").agg(
        F.min("premiere_vue_utc").alias("premiere_vue_utc"),
        F.max("derniere_vue_utc").alias("derniere_vue_utc"),
        F.sum("nb_positions_total").alias("nb_positions_total"),
    )


def flight_dim(inter: DataFrame, as_of: datetime) -> DataFrame:
    """Main callsign per aircraft (most positions; ties: latest seen, then
    callsign, then country) with airline code/name and that group's stats."""
    return dim_from_groups(callsign_groups(inter), as_of)


def dim_from_groups(g: DataFrame, as_of: datetime) -> DataFrame:
    """Dimension rows from per-(icao24, callsign, country) stats; the window
    runs over aggregated rows (a handful per aircraft)."""
    w = Window.partitionBy("icao24").orderBy(
        F.col("nb_positions_total").desc(),
        F.col("derniere_vue_utc").desc_nulls_last(),
        F.col("callsign").asc_nulls_last(),
        F.col("origine_pays").asc_nulls_last(),
    )
    top = g.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return top.select(
        surrogate_key("icao24").alias("vol_sk"),
        "icao24",
        F.col("callsign").alias("callsign_principal"),
        "origine_pays",
        airline_code("callsign").alias("code_compagnie"),
        airline_name("callsign").alias("compagnie_nom"),
        "premiere_vue_utc",
        "derniere_vue_utc",
        "nb_positions_total",
        ntz_literal(as_of).alias("dbt_updated_at"),
    ).select(*DIM_COLUMNS)


def position_fact(inter: DataFrame, dim: DataFrame, as_of: datetime) -> DataFrame:
    """Position fact: time parts, flight-level band and phase, dimension key.

    The dimension key is ``surrogate_key(icao24)`` by construction, so it is
    computed on each row; the upstream LEFT JOIN + ``vol_sk IS NOT NULL``
    keeps exactly the rows whose aircraft has a dimension row, which is a
    semi-join against the dimension's icao24 key set -- the narrowest side
    there is. The planner broadcasts it while its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time) and
    sort-merges beyond that; the intermediate rows are never widened by the
    join.
    """
    p = inter.join(dim.select("icao24"), "icao24", "left_semi").withColumn("vol_sk", surrogate_key("icao24"))
    ts = F.col("timestamp_position_utc")
    return p.select(
        surrogate_key("position_id").alias("position_sk"),
        "vol_sk",
        ts.alias("timestamp_utc"),
        bucket_start(ts, 3600).alias("heure_utc"),
        F.to_date(ts).alias("date_utc"),
        F.hour(ts).alias("heure_journee"),
        (F.dayofweek(ts) - 1).alias("jour_semaine"),
        "latitude", "longitude", "altitude_baro_m", "altitude_baro_ft",
        flight_band("au_sol", "altitude_baro_ft").alias("tranche_vol"),
        "vitesse_ms", "vitesse_kmh", "cap_degres", "taux_montee_declare_ms", "taux_montee_calcule_ms",
        flight_phase("au_sol", "altitude_baro_ft", "taux_montee_calcule_ms").alias("phase_vol"),
        "au_sol", "squawk", "source_capteur", "flag_changement_altitude_suspect",
        "ingested_at", "batch_id",
        ntz_literal(as_of).alias("dbt_updated_at"),
    ).select(*FACT_COLUMNS)


def orphan_positions(inter: DataFrame, dim: DataFrame) -> DataFrame:
    """Intermediate rows the fact join drops (no dimension row): FCT2."""
    return inter.join(dim.select("icao24"), "icao24", "left_anti")


def orphan_count(inter: DataFrame, dim: DataFrame) -> DataFrame:
    """Number of orphan positions, with the positions first reduced to one
    (icao24, count) row per aircraft (partial aggregation), so only
    aircraft-level rows meet the dimension keys."""
    per_aircraft = inter.groupBy("icao24").agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_aircraft.join(dim.select("icao24"), "icao24", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("nb_orphelins"))
