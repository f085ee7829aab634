"""One ingest run: landed payloads -> parse -> raw suite -> insert-only merge -> stats."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import RAW_SUITE, enforce, run_suite, should_run, store_results
from ..operators.sinks import dedup_rate, merge_raw
from ..sources.states import FRANCE, parse_states


def ingest_run(spark: SparkSession, states: DataFrame, raw_table: str, as_of: datetime, run_id: str = "",
               on_failure: str = "warn", bbox: dict | None = FRANCE, results_path: str | None = None, check_every: int = 1) -> dict:
    """Parse a landed batch, keep the region's positions, validate the whole batch, merge it into the
    raw table and return the run's statistics. Validation results go to ``results_path`` if given, once a run id.
    With ``check_every`` n > 1 one run id in n validates (``should_run``); the others load without. An empty batch
    skips validation and load."""
    positions, rejects = parse_states(states, as_of, bbox)
    positions = positions.persist()
    try:
        if positions.isEmpty():
            stats = {"inserted": 0, "skipped": 0, "total": 0}
        else:
            quality = None
            if should_run(run_id, check_every):
                results = run_suite(positions, RAW_SUITE)
                if results_path:
                    store_results(results, results_path, run_id, as_of)
                quality = enforce(results, on_failure)
            stats = merge_raw(spark, positions, raw_table)
            if quality:
                stats["quality"] = quality
        stats["rejects"] = rejects.count()
        stats["dedup_rate_pct"] = dedup_rate(stats)
        return stats
    finally:
        positions.unpersist()
