"""Job entry points for spark-submit (the scheduled runs of the upstream pipeline).

    spark-submit -m aerosift.cli build  --raw RAW --root MARTS --as-of "2024-01-01 03:00:00"
    spark-submit -m aerosift.cli land   --landing DIR --raw RAW --feed FEED --key 2024-01-01T03-00 --as-of ...
    spark-submit -m aerosift.cli update --raw RAW --root MARTS --as-of ... [--feed FEED | --lookback-hours 2]
    spark-submit -m aerosift.cli ingest --landing DIR --root MARTS --checkpoint DIR [--every "10 minutes"]
    spark-submit -m aerosift.cli check  --root MARTS --on-failure raise
    spark-submit -m aerosift.cli serve  --root MARTS --as-of ... --out DIR

Paths are shared-storage folders; ``spark.checkpoint.dir`` must be set on a
cluster (scratch data for staged writes goes there).
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .schemas import RAW_COLUMNS


def _ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _raw(spark: SparkSession, path: str):
    return spark.read.parquet(path)


def cmd_build(spark, a) -> dict:
    from .plans.tables import build_tables

    build_tables(spark, _raw(spark, a.raw).select(*RAW_COLUMNS), a.root, _ts(a.as_of))
    return {"built": a.root}


def cmd_land(spark, a) -> dict:
    """One landed batch -> raw table and change feed, as its own run."""
    from .operators.feed import merge_to_feed
    from .sources.states import FRANCE, parse_states, read_states

    positions, _ = parse_states(read_states(spark, a.landing), _ts(a.as_of), FRANCE)
    return merge_to_feed(spark, positions, a.raw, a.feed, a.key)


def cmd_update(spark, a) -> dict:
    """Apply what the feed holds and this reader has not applied, or without a feed the upstream look-back slice."""
    from .operators.feed import apply_feed
    from .plans.incremental import incremental_update, lookback_slice

    if a.feed:
        return {"applied": apply_feed(spark, a.raw, a.feed, "marts", lambda rows: incremental_update(
            spark, a.root, _raw(spark, a.raw), rows, _ts(a.as_of)))}
    raw = _raw(spark, a.raw)
    return incremental_update(spark, a.root, raw, lookback_slice(raw, _ts(a.as_of), a.lookback_hours),
                              _ts(a.as_of))


def cmd_ingest(spark, a) -> dict:
    from .streaming.pipeline import run_ingest_stream

    q = run_ingest_stream(spark, a.landing, a.root, a.checkpoint, available_now=a.every is None,
                          interval=a.every or "10 minutes")
    q.awaitTermination()
    return {"query": q.name or q.id}


def cmd_check(spark, a) -> dict:
    from .operators import quality as dq
    from .plans.tables import read_dim, read_fact

    fact, dim = read_fact(spark, a.root), read_dim(spark, a.root)
    results = (dq.run_suite(dim, dq.DIM_TESTS)
               .unionByName(dq.run_suite(fact, dq.FACT_TESTS, refs={"dim_vols": dim}))
               .unionByName(dq.run_suite(fact, dq.FACT_SUITE)))
    if a.store:
        dq.store_results(results, a.store, a.run_id, datetime.now(timezone.utc).replace(tzinfo=None))
    return dq.enforce(results, a.on_failure)


def cmd_serve(spark, a) -> dict:
    from .operators import serving
    from .plans.tables import read_dim, read_fact

    as_of = _ts(a.as_of)
    fact, dim = read_fact(spark, a.root), read_dim(spark, a.root)
    live = serving.live_positions(fact, dim, as_of).persist()
    anomalies = serving.anomalies(fact, dim, as_of)
    outputs = {
        "live_positions": live,
        "kpis": serving.kpis(live, anomalies),
        "map_points": serving.map_points(live),
        "active_anomalies": serving.active_anomalies(live),
        "anomaly_table": serving.anomaly_table(anomalies),
    }
    try:
        for name, df in outputs.items():
            df.write.mode("overwrite").parquet(os.path.join(a.out, name))
    finally:
        live.unpersist()
    return {"written": sorted(outputs)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerosift")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--root", required=True)
    b.add_argument("--as-of", required=True)
    u = sub.add_parser("update")
    u.add_argument("--raw", required=True)
    u.add_argument("--root", required=True)
    u.add_argument("--as-of", required=True)
    u.add_argument("--lookback-hours", type=float, default=2)
    u.add_argument("--feed", default=None, help="change feed to apply instead of a look-back slice")
    n = sub.add_parser("land")
    for name in ("--landing", "--raw", "--feed", "--key", "--as-of"):
        n.add_argument(name, required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--every", default=None, help="processing-time trigger; default: drain and stop")
    c = sub.add_parser("check")
    c.add_argument("--root", required=True)
    c.add_argument("--on-failure", choices=["warn", "raise"], default="raise")
    c.add_argument("--store", default=None)
    c.add_argument("--run-id", default="manual")
    s = sub.add_parser("serve")
    s.add_argument("--root", required=True)
    s.add_argument("--as-of", required=True)
    s.add_argument("--out", required=True)
    return p


COMMANDS = {"build": cmd_build, "land": cmd_land, "update": cmd_update, "ingest": cmd_ingest, "check": cmd_check, "serve": cmd_serve}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from .session import get_session

    a = parser().parse_args(argv)
    spark = spark or get_session(app=f"aerosift-{a.cmd}")
    result = COMMANDS[a.cmd](spark, a)
    print(result)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
