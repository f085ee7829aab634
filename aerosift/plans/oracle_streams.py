"""DuckDB SQL for the queries of ``catalog_streams``."""

from __future__ import annotations

from ..operators import quality as q
from ..schemas import FACT_COLUMNS
from . import oracle as o
from .oracle_quality import suite_sql

#: Every eleventh row reaches the feed three hours after its batch.
_LATE = """
delayed AS (SELECT * REPLACE (if(event_id % 11 = 0, ingested_at + INTERVAL 3 HOUR, ingested_at) AS ingested_at) FROM raw_e)"""

QUERIES = {
    "track_segments": o.QUERIES["stream_track_segments"],
    "track_segments_merged": o.QUERIES["stream_track_segments"],
    "stream_traffic_sliding": o.QUERIES["traffic_in_air_sliding"],
    "stream_live_positions": o.QUERIES["live_positions"],
    "stream_late_corrected": "WITH " + ",".join([o.ADAPTER, _LATE, o.STG.replace("FROM raw ", "FROM delayed "), o.INT]).strip()
    + "\nSELECT * FROM inter",
}

QUERIES["landed_batches"] = o.with_layers("raw", """
SELECT *, strftime(ingested_at, '%Y-%m-%d-%H') AS batch_key,
       count(*) OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, ingested_at)) AS written FROM raw""")
QUERIES["raw_lookback"] = o.with_layers("raw", f"SELECT * FROM raw WHERE ingested_at >= {o.AS_OF} - INTERVAL 2 HOUR")
QUERIES["ingest_run_log"] = o.with_layers("raw", f"""
SELECT step, run_id, inserted, skipped, total, rejects, if(checked AND total > 0, {len(q.RAW_SUITE.checks)}, 0) AS stored_checks
FROM (
  SELECT *, instr('02468ace', right(md5(run_id), 1)) > 0 AS checked FROM (
    SELECT CAST(h AS INTEGER) AS step, 'run-' || h AS run_id, total AS inserted, 0 AS skipped, total, rejects FROM hours
    UNION ALL SELECT CAST(h + 1 AS INTEGER), 'run-' || h, 0, total, total, rejects FROM hours WHERE h = (SELECT max(h) FROM hours)
    UNION ALL SELECT CAST(max(h) + 2 AS INTEGER), 'empty', 0, 0, 0, 0 FROM hours))""", """
hours AS (
  SELECT hour(ingested_at) AS h, count(*) FILTER (NOT bad AND inside) AS total, count(*) FILTER (bad AND latitude + longitude IS NOT NULL) AS rejects
  FROM (SELECT *, event_id % 41 = 0 OR event_id % 43 = 0 AS bad,
               ifnull(latitude BETWEEN 41.0 AND 51.5 AND longitude BETWEEN -5.5 AND 10.0, FALSE) AS inside FROM raw_e)
  GROUP BY 1
)""")

_SUITES = " UNION ALL ".join((suite_sql("stg", q.STG_TESTS, []), suite_sql("dim", q.DIM_TESTS, []),
                              suite_sql("fact", q.FACT_TESTS, FACT_COLUMNS, refs={"dim_vols": "dim"}),
                              suite_sql("fact", q.FACT_SUITE, FACT_COLUMNS)))
QUERIES["dq_enforced"] = o.with_layers("fact", f"""
SELECT suite, on_failure, if(failed AND on_failure = 'raise', 'blocked', 'passed') AS outcome
FROM (SELECT suite, count(*) FILTER (status = 'fail') > 0 AS failed FROM ({_SUITES}) GROUP BY suite), (VALUES ('warn'), ('raise')) AS a(on_failure)""")

#: A leg walks from cell to cell, over whichever edge it meets first, until the cell of its end.
_WALK = """
points AS (
  SELECT vol_sk, timestamp_utc AS ts, cap_degres, CAST(round(longitude * 1000000) AS BIGINT) AS x, CAST(round(latitude * 1000000) AS BIGINT) AS y
  FROM fact WHERE NOT au_sol AND timestamp_utc IS NOT NULL
),
flown AS (
  SELECT row_number() OVER () AS leg, vol_sk, cap_degres, px AS x0, py AS y0, x AS x1, y AS y1,
         CAST(floor(px / 500000) AS BIGINT) AS i0, CAST(floor(py / 500000) AS BIGINT) AS j0,
         CAST(floor(x / 500000) AS BIGINT) AS i1, CAST(floor(y / 500000) AS BIGINT) AS j1
  FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(ts) OVER w AS since FROM points WINDOW w AS (PARTITION BY vol_sk ORDER BY ts))
  WHERE date_diff('second', since, ts) BETWEEN 1 AND 120
),
walk AS (
  SELECT leg, i0 AS i, j0 AS j FROM flown
  UNION ALL
  SELECT leg, if(east_west, i + sign(i1 - i), i), if(east_west, j, j + sign(j1 - j))
  FROM (
    SELECT *, i <> i1 AND (j = j1 OR reach_x * abs(y1 - y0) < reach_y * abs(x1 - x0)
                           OR (reach_x * abs(y1 - y0) = reach_y * abs(x1 - x0) AND x1 > x0)) AS east_west
    FROM (SELECT *, abs((i + if(x1 > x0, 1, 0)) * 500000 - x0) AS reach_x, abs((j + if(y1 > y0, 1, 0)) * 500000 - y0) AS reach_y
          FROM walk JOIN flown USING (leg) WHERE i <> i1 OR j <> j1)
  )
)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


QUERIES["leg_cell_traffic"] = _recursive(o.with_layers("fact", """
SELECT i, j, count(*) AS nb_trajets, count(DISTINCT vol_sk) AS avions FROM walk JOIN flown USING (leg) GROUP BY i, j""", _WALK))
QUERIES["corridor_legs"] = _recursive(o.with_layers("fact", """
SELECT j * 0.5::DOUBLE AS cellule_lat, i * 0.5::DOUBLE AS cellule_lon, CAST((CAST(floor(cap_degres / 45) AS INTEGER) % 8) * 45 AS INTEGER) AS secteur_cap,
       count(DISTINCT vol_sk) AS avions, count(*) AS nb_trajets
FROM walk JOIN flown USING (leg) WHERE cap_degres IS NOT NULL
GROUP BY ALL ORDER BY avions DESC, nb_trajets DESC, cellule_lat, cellule_lon, secteur_cap LIMIT 20""", _WALK))
