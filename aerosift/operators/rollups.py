"""Exact distinct-aircraft rollups (INS1, INS3, INS4): bitmaps over dense aircraft numbers, stored for each hour.

A distinct count does not add up over hours, a set of aircraft does. Every aircraft gets a number, once and for
all (``numbers``, append-only), and each hour of the fact keeps one row for each 10-minute slot, ground or air, and block of
32,768 aircraft: the positions and a 4 kB bitmap of the aircraft seen. Any range of slots is then the union of its
bitmaps, whose bits are counted: ``bitmap_or_agg`` over a few rows an hour instead of ``countDistinct`` over the
positions. An update replaces the touched hours only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import bucket_start, epoch_to_ntz, ntz_to_epoch
from ..session import materialize
from .sinks import in_partitions, read_if_exists, replace_partitions

SLOT_S = 600
PARTITIONS = ["date_utc", "heure_journee"]
NUMBERS = T.StructType([T.StructField("vol_sk", T.StringType()), T.StructField("number", T.LongType())])
ROLLUP = T.StructType([
    T.StructField("slot", T.TimestampNTZType()), T.StructField("jour_semaine", T.IntegerType()), T.StructField("airborne", T.BooleanType()),
    T.StructField("block", T.LongType()), T.StructField("aircraft", T.BinaryType()), T.StructField("positions", T.LongType()),
    T.StructField("date_utc", T.DateType()), T.StructField("heure_journee", T.IntegerType())])


def numbers(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_exists(spark, f"{root}/numbers", NUMBERS)
    return spark.createDataFrame([], NUMBERS) if found is None else found


def number_aircraft(spark: SparkSession, keys: DataFrame, root: str) -> None:
    """Give new aircraft the next numbers. An append that died half-way leaves valid numbers; the rest get later ones."""
    known = numbers(spark, root)
    fresh = keys.select("vol_sk").where(F.col("vol_sk").isNotNull()).distinct().join(known, "vol_sk", "left_anti")
    fresh = materialize(fresh.withColumn("_part", F.spark_partition_id()), "new-aircraft")
    sizes = {r["_part"]: r["count"] for r in fresh.groupBy("_part").count().collect()}     # one row for each task
    if not sizes:
        return
    at = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    starts = []
    for part in sorted(sizes):
        starts.append((part, at))
        at += sizes[part]
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("vol_sk"))
    fresh.join(F.broadcast(offsets), "_part").select("vol_sk", (F.col("_start") + place).alias("number")).write.mode("append").parquet(
        f"{root}/numbers")


def hour_bitmaps(fact: DataFrame, known: DataFrame) -> DataFrame:
    """Rollup rows of fact rows. The fact meets the numbers after it is reduced to aircraft and slots."""
    slot = bucket_start("timestamp_utc", SLOT_S).alias("slot")
    air = F.coalesce(F.col("au_sol") == F.lit(False), F.lit(False)).alias("airborne")
    seen = fact.groupBy(*PARTITIONS, slot, "jour_semaine", air, "vol_sk").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.join(known, "vol_sk")
    return seen.groupBy("slot", "jour_semaine", "airborne", F.bitmap_bucket_number("number").alias("block"), *PARTITIONS).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("aircraft"), F.sum("n").alias("positions")).select(
        *[F.col(f.name) for f in ROLLUP])


def update_rollups(spark: SparkSession, fact: DataFrame, touched: DataFrame, root: str) -> None:
    """Recompute the rollup of the hours listed in ``touched``, reading those hours of the fact only."""
    rows = in_partitions(fact, touched, PARTITIONS)
    number_aircraft(spark, rows, root)
    fresh = materialize(hour_bitmaps(rows, numbers(spark, root)), "hour-bitmaps")
    replace_partitions(spark, fresh, f"{root}/hours", PARTITIONS, "slot")


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_exists(spark, f"{root}/hours", ROLLUP)
    return spark.createDataFrame([], ROLLUP) if found is None else found


def distinct_aircraft(rollup: DataFrame, *by: str | Column) -> DataFrame:
    """(by ..., avions, nb_positions): exact counts for any grouping of rollup rows."""
    blocks = rollup.groupBy(*by, "block").agg(F.bitmap_or_agg("aircraft").alias("aircraft"), F.sum("positions").alias("positions"))
    names = [c for c in blocks.columns if c not in ("block", "aircraft", "positions")]
    return blocks.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count("aircraft")), F.lit(0)).alias("avions"),
                                      F.coalesce(F.sum("positions"), F.lit(0)).alias("nb_positions"))


def in_range(rollup: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Rollup rows of the slots in [start, stop); the hours outside are pruned by their day."""
    return rollup.where((F.col("date_utc") >= F.to_date(start)) & (F.col("date_utc") <= F.to_date(stop))
                        & (F.col("slot") >= start) & (F.col("slot") < stop))


def in_air(rollup: DataFrame) -> DataFrame:
    """INS1 from the rollup: aircraft in the air for each slot."""
    return distinct_aircraft(rollup.where("airborne"), F.col("slot").alias("tranche_10min"))


def in_air_sliding(rollup: DataFrame, size_s: int = 3600) -> DataFrame:
    """INS1 over windows of ``size_s`` that start with every slot: each slot's bitmaps join the windows that hold it."""
    if size_s % SLOT_S:
        raise ValueError("a window is a whole number of slots")
    start = F.explode(F.sequence(F.lit(0), F.lit(size_s // SLOT_S - 1)))
    rows = rollup.where("airborne").where(F.col("slot").isNotNull()).select("*", start.alias("_k"))
    rows = rows.withColumn("debut", epoch_to_ntz(ntz_to_epoch("slot") - F.col("_k") * SLOT_S))
    return distinct_aircraft(rows, "debut")


def by_hour(rollup: DataFrame) -> DataFrame:
    """INS4 from the rollup."""
    return distinct_aircraft(rollup, "jour_semaine", "heure_journee")


def by_country(rollup: DataFrame, known: DataFrame, dim: DataFrame) -> DataFrame:
    """INS3's aircraft from the rollup: each country's aircraft, as a bitmap, met with those seen in the rollup's rows."""
    seen = rollup.groupBy("block").agg(F.bitmap_or_agg("aircraft").alias("seen"))
    own = dim.select("vol_sk", "origine_pays").join(known, "vol_sk").groupBy(
        "origine_pays", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("own"))
    both = own.join(seen, "block").select("origine_pays", "block", F.explode(F.array("own", "seen")).alias("bits"))
    met = both.groupBy("origine_pays", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    return met.groupBy("origine_pays").agg(F.sum("n").alias("avions")).where("avions > 0")
