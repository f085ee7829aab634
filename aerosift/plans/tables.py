"""Stored marts: full build and readers.

Layout under one root folder (a shared filesystem or object store):

* ``int``  intermediate positions, partitioned by (``window_date``, ``window_hour``), clustered by icao24
* ``dim_hourly`` / ``dim_daily`` / ``dim_monthly`` per (icao24, callsign, country)
  first/last seen and count per hour / day / month -- the dimension's mergeable
  partial aggregates: an update re-aggregates touched hours from int, re-rolls
  touched days from their 24 hourly partials and touched months from their
  daily partials, and derives touched aircraft from monthly partials (per-update
  work does not grow with the length of the history)
* ``dim``  flight dimension (one row per aircraft; small), in versioned folders
* ``fact`` position fact, partitioned by (``date_utc``, ``heure_journee``), clustered by ``vol_sk``

(day, hour) partitions keep an incremental upsert to the hours a batch
touches, and give serving queries hour-level partition pruning.

Each layer is written once and re-read by the next (lineage cut, and the
two marts share one stored intermediate table).
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..operators.marts import dim_from_groups, merge_groups, position_fact
from ..operators.sinks import read_version, write_clustered, write_version
from ..operators.staging import stage
from ..schemas import DIM_COLUMNS, FACT_COLUMNS, INT_COLUMNS, TABLE_SCHEMAS

INT_PARTITIONS = ["window_date", "window_hour"]
FACT_PARTITIONS = ["date_utc", "heure_journee"]


def paths(root: str) -> dict[str, str]:
    return {name: os.path.join(root, name)
            for name in ("raw", "int", "dim_hourly", "dim_daily", "dim_monthly", "dim", "fact")}


def with_int_partition(inter: DataFrame) -> DataFrame:
    return (inter.withColumn("window_date", F.to_date("window_30s"))
            .withColumn("window_hour", F.hour("window_30s")))


def _read(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(TABLE_SCHEMAS[name]).parquet(paths(root)[name])
    return df.select(*columns) if columns else df


def read_int(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "int", INT_COLUMNS)


def read_int_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """int with its partition columns (for partition-pruned reads)."""
    return _read(spark, root, "int", INT_COLUMNS + INT_PARTITIONS)


def hourly_groups(inter_partitioned: DataFrame) -> DataFrame:
    """Dimension partial aggregates per (icao24, callsign, country, window hour)."""
    return inter_partitioned.groupBy("icao24", "callsign", "origine_pays", *INT_PARTITIONS).agg(
        F.min("timestamp_position_utc").alias("premiere_vue_utc"),
        F.max("timestamp_position_utc").alias("derniere_vue_utc"),
        F.count(F.lit(1)).alias("nb_positions_total"),
    )


DAY_PARTITION = ["window_date"]


def daily_groups(hourly: DataFrame) -> DataFrame:
    """Roll hourly partials up to one row per (group, day)."""
    return hourly.groupBy("icao24", "callsign", "origine_pays", *DAY_PARTITION).agg(
        F.min("premiere_vue_utc").alias("premiere_vue_utc"),
        F.max("derniere_vue_utc").alias("derniere_vue_utc"),
        F.sum("nb_positions_total").alias("nb_positions_total"),
    )


def read_dim_hourly(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "dim_hourly")


def read_dim_daily(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "dim_daily")


MONTH_PARTITION = ["window_month"]


def monthly_groups(daily: DataFrame) -> DataFrame:
    """Roll daily partials up to one row per (group, month)."""
    return (daily.withColumn(MONTH_PARTITION[0], F.trunc(DAY_PARTITION[0], "month"))
            .groupBy("icao24", "callsign", "origine_pays", *MONTH_PARTITION).agg(
                F.min("premiere_vue_utc").alias("premiere_vue_utc"),
                F.max("derniere_vue_utc").alias("derniere_vue_utc"),
                F.sum("nb_positions_total").alias("nb_positions_total")))


def read_dim_monthly(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "dim_monthly")


def read_dim(spark: SparkSession, root: str) -> DataFrame:
    return read_version(spark, paths(root)["dim"], TABLE_SCHEMAS["dim"]).select(*DIM_COLUMNS)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "fact", FACT_COLUMNS)


def build_tables(spark: SparkSession, raw: DataFrame, root: str, as_of: datetime,
                 window_s: int = 30, max_gap_s: int = 120, max_rate: int = 100) -> None:
    """Full rebuild of int, dim and fact from the whole raw table."""
    p = paths(root)
    inter = dedup(stage(raw), window_s, max_gap_s, max_rate)
    write_clustered(with_int_partition(inter), p["int"], INT_PARTITIONS, "icao24")
    write_clustered(hourly_groups(read_int_partitioned(spark, root)), p["dim_hourly"], INT_PARTITIONS, "icao24")
    write_clustered(daily_groups(read_dim_hourly(spark, root)), p["dim_daily"], DAY_PARTITION, "icao24")
    write_clustered(monthly_groups(read_dim_daily(spark, root)), p["dim_monthly"], MONTH_PARTITION, "icao24")
    write_version(spark, dim_from_groups(merge_groups(read_dim_monthly(spark, root)), as_of), p["dim"])
    stored = read_int(spark, root)
    fact = position_fact(stored, read_dim(spark, root), as_of)
    write_clustered(fact, p["fact"], FACT_PARTITIONS, "vol_sk")


def register_views(spark: SparkSession, root: str, raw: DataFrame | None = None) -> None:
    """Expose the layers to Spark SQL (SNK4): staging stays a view over raw,
    the stored layers are views over their Parquet tables."""
    if raw is not None:
        stage(raw).createOrReplaceTempView("stg_positions")
    read_int(spark, root).createOrReplaceTempView("int_positions_deduped")
    read_dim(spark, root).createOrReplaceTempView("dim_vols")
    read_fact(spark, root).createOrReplaceTempView("fact_positions")
