"""Benchmark on $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS];
prints one JSON line.

Timed as a deployment runs it:

* ``transform_full``        raw (from events) -> stg -> int -> dim -> fact, all written
                             as partitioned Parquet tables
* ``ingest_merge``          landed rows merged insert-only into the raw table
* ``transform_incremental`` tables built from all but the last 10-minute landed batch,
                             then that batch applied with the exact incremental update
                             (the upstream cadence: one batch per run)
* serving / quality / insight queries over the stored tables, each run into the
  ``noop`` sink (every row produced, nothing collected)
* ``query_*``               a few registered end-to-end queries (events -> answer)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from aerosift.functions.timecols import ntz_literal  # noqa: E402
from aerosift.operators import insights, quality, serving  # noqa: E402
from aerosift.operators.sinks import merge_raw, merge_stats  # noqa: E402
from aerosift.schemas import RAW_COLUMNS  # noqa: E402
from aerosift.plans import catalog  # noqa: E402
from aerosift.plans.incremental import incremental_update  # noqa: E402
from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int  # noqa: E402
from aerosift.session import get_session, materialize  # noqa: E402
from aerosift.sources.events_adapter import raw_positions, replayed_batches  # noqa: E402

AS_OF = datetime(2024, 1, 1, 3, 0, 0)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="aerosift-bench-")
    extra = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    }
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for profiling, kept in the scratch folder
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.path.join(scratch, "events")})
        print("event log:", os.path.join(scratch, "events"), file=sys.stderr)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), extra=extra)
    def run_all(sf_dir: str, work: str) -> dict[str, float]:
        times: dict[str, float] = {}

        def timed(name, fn):
            t0 = time.perf_counter()
            fn()
            times[name] = round(time.perf_counter() - t0, 3)

        def sink(df):
            df.write.format("noop").mode("overwrite").save()

        # ingest: landed rows merged insert-only into the raw table (partitioned by event date/hour)
        raw_path = os.path.join(work, "raw")
        timed("ingest_merge", lambda: merge_raw(spark, raw_positions(spark, sf_dir), raw_path))
        raw = spark.read.parquet(raw_path).select(*RAW_COLUMNS)
        full, inc = os.path.join(work, "full"), os.path.join(work, "inc")
        timed("transform_full", lambda: build_tables(spark, raw, full, AS_OF))
        last_batch = raw.agg(F.max("ingested_at")).first()[0]
        early = F.col("ingested_at") < ntz_literal(last_batch)
        build_tables(spark, raw.filter(early), inc, AS_OF)
        stored = spark.read.parquet(raw_path)   # with its event_date/event_hour partition columns (pruning)
        # the slice as ``merge_rows`` hands it on: the batch's new rows, stored
        new = materialize(stored.filter(~early), "bench-new")
        timed("transform_incremental", lambda: incremental_update(spark, inc, stored, new, AS_OF))

        fact, dim, inter = read_fact(spark, full), read_dim(spark, full), read_int(spark, full)
        live = serving.live_positions(fact, dim, AS_OF)
        anom = serving.anomalies(fact, dim, AS_OF)
        timed("live_positions", lambda: sink(live))
        timed("anomalies_24h", lambda: sink(anom))
        timed("kpis", lambda: sink(serving.kpis(live, anom)))
        timed("map_points", lambda: sink(serving.map_points(live)))
        timed("dq_fact_suite", lambda: sink(quality.run_suite(fact, quality.FACT_SUITE)))
        timed("dq_mart_tests", lambda: sink(quality.run_suite(dim, quality.DIM_TESTS).unionByName(
            quality.run_suite(fact, quality.FACT_TESTS, refs={"dim_vols": dim}))))
        timed("dq_raw_suite_by_batch", lambda: sink(quality.run_suite(raw, quality.RAW_SUITE, by=["batch_id"])))
        timed("altitude_coherence", lambda: sink(quality.altitude_coherence(fact)))
        timed("raw_merge_stats", lambda: sink(merge_stats(replayed_batches(raw_positions(spark, sf_dir, True)))))
        timed("busiest_corridors", lambda: sink(insights.busiest_corridors(fact)))
        timed("traffic_by_country", lambda: sink(insights.traffic_by_country(fact, dim)))
        timed("traffic_in_air", lambda: sink(insights.aircraft_in_air(fact)))
        timed("int_rows", lambda: inter.count())
        for name in ("live_positions", "kpis", "dq_fact_suite"):
            timed("query_" + name, lambda n=name: sink(catalog.REGISTRY[n](spark, sf_dir)))
        return times

    # warm-up: the whole sequence once on the smallest scale (JIT + compiled-code cache,
    # as on a long-running cluster), then the measured run
    run_all("/root/testdata/sf0.001", os.path.join(scratch, "warm"))
    times = run_all(sf_dir, os.path.join(scratch, "run"))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
