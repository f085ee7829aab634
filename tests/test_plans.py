"""Physical-plan properties the scale design relies on (read from explain output)."""

import contextlib
import io
import re
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedup_shuffles_once_without_per_aircraft_sort(spark):
    from aerosift.operators.continuity import with_chunks
    from aerosift.operators.dedup import dedup, windowed
    from aerosift.operators.staging import stage
    from aerosift.sources.events_adapter import raw_positions

    stg = stage(raw_positions(spark, SF_SMALL))
    p = plan(dedup(stg))
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1          # both windows use one deal of the rows
    assert len(re.findall(r"^\(\d+\) Sort\b", p, re.M)) == 1              # and the first one's order
    assert "SortAggregate" not in p
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1      # raw read once
    assert "hashpartitioning(icao24" in p and "_chunk" in p
    rows = windowed(stg)
    assert with_chunks(rows, "window_30s", 30, 120).count() < 1.1 * rows.count()


def test_serving_prunes_partitions_and_pushes_filters(spark, tmp_path):
    from aerosift.operators import serving
    from aerosift.plans.tables import build_tables, read_dim, read_fact
    from aerosift.sources.events_adapter import raw_positions

    root = str(tmp_path)
    build_tables(spark, raw_positions(spark, SF_SMALL), root, AS_OF)
    p = plan(serving.live_positions(read_fact(spark, root), read_dim(spark, root), AS_OF))
    pf = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters:")][0]
    assert "date_utc" in pf and "heure_journee" in pf     # day + hour pruning
    assert "GreaterThanOrEqual(timestamp_utc" in p
    assert "WindowGroupLimit" in p and "Partial" in p   # top-1 per flight combined map-side
    fact_scan = p[p.index("(1) Scan parquet"):]
    assert "taux_montee_calcule_ms" in fact_scan.split("ReadSchema:")[1].split("\n")[0]
    assert "squawk" not in fact_scan.split("ReadSchema:")[1].split("\n")[0]   # column pruning


def test_bbox_pushed_into_parquet_scan(spark, tmp_path):
    from aerosift.sources.events_adapter import raw_positions
    from aerosift.sources.states import in_bbox

    path = str(tmp_path / "raw")
    raw_positions(spark, SF_SMALL).write.parquet(path)
    p = plan(in_bbox(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(latitude,41.0)" in p and "LessThanOrEqual(longitude,10.0)" in p


def test_incremental_slice_uses_dynamic_partition_pruning(spark, tmp_path):
    from aerosift.operators.sinks import EVENT_PARTITIONS, with_event_date
    from aerosift.plans.incremental import _expand, affected_raw, touched_windows
    from aerosift.sources.events_adapter import raw_positions

    path = str(tmp_path / "raw")
    with_event_date(raw_positions(spark, SF_SMALL)).write.partitionBy(*EVENT_PARTITIONS).parquet(path)
    stored = spark.read.parquet(path)
    new = stored.filter(F.col("event_hour") == 2)
    p = plan(affected_raw(stored, _expand(touched_windows(new), -4, 4, 30)))
    assert "dynamicpruningexpression" in p


def test_traffic_by_country_aggregates_before_join(spark):
    from aerosift.operators.insights import traffic_by_country
    from aerosift.plans.transform import build_marts
    from aerosift.sources.events_adapter import raw_positions

    m = build_marts(raw_positions(spark, SF_SMALL), AS_OF, materialize=True)
    p = plan(traffic_by_country(m.fact, m.dim))
    assert "Expand" in p                                   # rollup
    assert "count(distinct" not in p.lower()               # one row per flight: no distinct aggregation


def test_hot_aircraft_spreads_over_all_tasks(spark):
    """One aircraft with a third of the rows, over a day: its dedup/rate work is spread over every
    shuffle partition (keyed by aircraft and hour), not funnelled into one task."""
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage
    from tests.conftest import raw_df

    t0 = 1704067200
    hot = [dict(icao24="hot001", time_position=t0 + 70 * i, last_contact=t0 + 70 * i, baro_altitude=1000.0 + i % 50)
           for i in range(1200)]
    cold = [dict(icao24=f"c{i % 40:05d}", time_position=t0 + 13 * i, last_contact=t0 + 13 * i) for i in range(2400)]
    # AQE would coalesce these tiny shuffle partitions into one; look at the hash distribution itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = dedup(stage(raw_df(spark, hot + cold))).withColumn("_p", F.spark_partition_id())
        per_part = {r["_p"]: r["n"] for r in out.filter(F.col("icao24") == "hot001").groupBy("_p")
                    .agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per_part) == n_parts
    assert max(per_part.values()) < 0.5 * sum(per_part.values())


def test_stored_layout_has_few_files_of_narrow_key_ranges(spark, tmp_path):
    """40 shuffle partitions and 3 hours: no tasks x hours files, and a file covers few keys."""
    import os

    import pyarrow.parquet as pq

    from aerosift.operators.sinks import write_clustered

    df = spark.range(40_000).select((F.col("id") % 3).alias("h"), F.sha2(F.col("id").cast("string"), 256).alias("k"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(df.repartition(40, "k"), str(tmp_path / "t"), "h", "k")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 43
    spans = []
    for f in files:
        keys = pq.read_table(f, columns=["k"]).column("k").to_pylist()
        assert keys == sorted(keys)
        spans.append(int(keys[-1][:4], 16) - int(keys[0][:4], 16))
    assert sorted(spans)[len(spans) // 2] < 0.15 * 0x10000
