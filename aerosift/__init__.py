"""aerosift — Spark-native analytics over aircraft state-vector feeds.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``   landed payloads, raw table, fixture adapter
* ``operators`` staging, 30 s dedup, marts, serving, insights, quality, sinks
* ``functions`` Column-level helpers (keys, kinematics, classification, time)
* ``plans``     end-to-end builds (full, exact incremental, ingest run)
* ``streaming`` Structured Streaming variants of ingest and dedup
"""

__version__ = "0.1.0"

# Public API (imported lazily so that ``import aerosift`` stays cheap).
_API = {
    "get_session": "session", "materialize": "session",
    "read_states": "sources.states", "parse_states": "sources.states", "in_bbox": "sources.states",
    "write_batch": "sources.states", "read_batch": "sources.states",
    "stage": "operators.staging", "dedup": "operators.dedup",
    "flight_dim": "operators.marts", "position_fact": "operators.marts",
    "live_positions": "operators.serving", "anomalies": "operators.serving", "kpis": "operators.serving",
    "map_points": "operators.serving", "active_anomalies": "operators.serving",
    "anomaly_table": "operators.serving", "airlines": "operators.serving", "filter_airline": "operators.serving",
    "run_suite": "operators.quality", "enforce": "operators.quality", "altitude_coherence": "operators.quality",
    "merge_raw": "operators.sinks", "upsert": "operators.sinks", "merge_rows": "operators.sinks",
    "build_tables": "plans.tables", "incremental_update": "plans.incremental",
    "run_ingest_stream": "streaming.pipeline",
}


def __getattr__(name):
    if name in _API:
        import importlib

        return getattr(importlib.import_module(f"{__name__}.{_API[name]}"), name)
    raise AttributeError(name)


__all__ = sorted(_API)
