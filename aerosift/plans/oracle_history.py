"""DuckDB SQL for the queries of ``catalog_history``."""

from __future__ import annotations

from ..operators import quality as q
from ..schemas import FACT_COLUMNS
from .oracle import AWKWARD, with_layers
from .oracle_quality import suite_sql

_RANGE = "timestamp_utc >= TIMESTAMP '2024-01-01 00:50:00' AND timestamp_utc < TIMESTAMP '2024-01-01 02:20:00'"

QUERIES = {
    "schema_drift_sync": with_layers("raw", """
SELECT id, icao24, event_id, time_position, baro_altitude, ingested_at,
  CAST(make_timestamp(time_position * 1000000) AS DATE) AS event_date,
  CAST(hour(make_timestamp(time_position * 1000000)) AS INTEGER) AS event_hour,
  last_contact,
  if(hour(ingested_at) < 2, CAST(source_position AS VARCHAR), 's' || source_position) AS source_position,
  if(hour(ingested_at) > 0, au_sol, NULL) AS au_sol, if(hour(ingested_at) > 0, callsign, NULL) AS callsign,
  if(hour(ingested_at) > 1, geo_altitude, NULL) AS geo_altitude
FROM raw_e QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at, event_id) = 1"""),
    "schema_drift_upsert": with_layers("fact", """
SELECT position_sk, vol_sk, timestamp_utc, date_utc, heure_journee, altitude_baro_ft, CAST(jour_semaine AS BIGINT) AS jour_semaine,
  if(heure_journee > 0, phase_vol, NULL) AS phase_vol, if(heure_journee > 0, tranche_vol, NULL) AS tranche_vol FROM fact"""),
    "raw_change_feed": with_layers("raw", "SELECT *, strftime(ingested_at, '%Y-%m-%d-%H') AS batch_key FROM stored", AWKWARD),
    "fact_change_feed": with_layers("fact", "SELECT * FROM fact"),
    "stream_state_rates": with_layers("inter", """
SELECT position_id, icao24, timestamp_position_utc, altitude_baro_m, taux_montee_calcule_ms, flag_changement_altitude_suspect
FROM inter WHERE timestamp_position_utc IS NOT NULL"""),
    "dq_fact_incremental": with_layers("fact", suite_sql("fact", q.FACT_SUITE, FACT_COLUMNS)),
    "dq_mart_incremental": with_layers("fact", suite_sql("fact", q.FACT_TESTS, FACT_COLUMNS, refs={"dim_vols": "dim"})),
    "rollup_traffic": with_layers("fact", f"""
SELECT 'slot' AS question, time_bucket(INTERVAL 10 MINUTE, timestamp_utc) AS debut, NULL::INTEGER AS jour_semaine, NULL::INTEGER AS heure_journee,
       count(DISTINCT vol_sk) AS avions, count(*) AS nb_positions
FROM fact WHERE NOT au_sol GROUP BY ALL
UNION ALL
SELECT 'sliding', time_bucket(INTERVAL 10 MINUTE, timestamp_utc) - to_minutes(10 * k), NULL, NULL, count(DISTINCT vol_sk), count(*)
FROM fact, range(0, 6) AS w(k) WHERE NOT au_sol AND timestamp_utc IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'hour', NULL, jour_semaine, heure_journee, count(DISTINCT vol_sk), count(*) FROM fact GROUP BY jour_semaine, heure_journee
UNION ALL
SELECT 'range', NULL, NULL, NULL, count(DISTINCT vol_sk), count(*) FROM fact WHERE {_RANGE}"""),
    "rollup_by_country": with_layers("fact", f"""
SELECT origine_pays, count(DISTINCT vol_sk) AS avions FROM fact JOIN (SELECT vol_sk, origine_pays FROM dim) USING (vol_sk)
WHERE {_RANGE} GROUP BY origine_pays"""),
}
