"""Declarative data-quality checks, evaluated in one aggregation pass per suite.

A suite is a list of ``Check`` specs. ``run_suite`` turns every row-level
check (null, range, set, regex, row count) into conditional aggregates of a
single ``groupBy(by).agg(...)``; only uniqueness/proportion (one
``groupBy(column)`` per column, partial aggregation first) and foreign keys
(an anti-join) need a shuffle of their own. Results come back as a small
DataFrame -- one row per check (per group when ``by`` is given) with
``suite, check, column_name, severity, observed, total, unexpected, success,
status`` -- built with unions, never joins.

Semantics: strict kinds (model tests) fail on any offending row (NULLs pass
range/value tests); ``expect_*`` kinds (batch expectations) use ``mostly``
over non-NULL values (over all rows for not-null).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import BAND_VALUES, PHASE_VALUES

STRICT_KINDS = {"not_null", "unique", "accepted_range", "accepted_values", "relationships"}
RATIO_KINDS = {"row_count_between", "column_exists", "expect_not_null", "expect_between", "expect_in_set",
            "expect_match_regex", "expect_unique", "expect_unique_proportion"}


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    min: float | None = None
    max: float | None = None
    mostly: float = 1.0
    values: tuple = ()
    regex: str | None = None
    severity: str = "error"
    inclusive: bool = True
    ref: tuple | None = None   # (reference name, reference column) for relationships

    def __post_init__(self):
        if self.kind not in STRICT_KINDS | RATIO_KINDS:
            raise ValueError(f"unknown check kind {self.kind}")


@dataclass
class Suite:
    name: str
    checks: list[Check] = field(default_factory=list)


RESULT_COLUMNS = ["suite", "check_order", "check_name", "column_name", "severity",
                  "observed", "total", "unexpected", "success", "status"]


def _in_range(c: Column, chk: Check) -> Column:
    lo = c >= chk.min if chk.inclusive else c > chk.min
    hi = c <= chk.max if chk.inclusive else c < chk.max
    if chk.min is None:
        return hi
    if chk.max is None:
        return lo
    return lo & hi


def _row_level(chk: Check, n: Column):
    """(unexpected, total) aggregate expressions for row-level checks."""
    c = F.col(chk.column)
    if chk.kind == "not_null" or chk.kind == "expect_not_null":
        return F.count(F.when(c.isNull(), 1)), n
    if chk.kind == "accepted_range":
        return F.count(F.when(~_in_range(c, chk), 1)), n
    if chk.kind == "accepted_values":
        return F.count(F.when(~c.isin(list(chk.values)), 1)), n
    if chk.kind == "expect_between":
        return F.count(F.when(c.isNotNull() & ~_in_range(c, chk), 1)), F.count(c)
    if chk.kind == "expect_in_set":
        return F.count(F.when(c.isNotNull() & ~c.isin(list(chk.values)), 1)), F.count(c)
    if chk.kind == "expect_match_regex":
        return F.count(F.when(c.isNotNull() & ~c.rlike(chk.regex), 1)), F.count(c)
    raise ValueError(chk.kind)


def _mostly_ok(u: Column, t: Column, mostly: float) -> Column:
    ratio = (t - u).cast("double") / t
    return F.when(t == 0, F.lit(True)).otherwise(ratio >= F.lit(float(mostly)))


def _status(success: Column, severity: str) -> Column:
    bad = F.lit("warn") if severity == "warn" else F.lit("fail")
    return F.when(success, F.lit("pass")).otherwise(bad)


def _row(suite, i, chk, observed, total, unexpected, success):
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(i).alias("check_order"),
        F.lit(chk.kind).alias("check_name"),
        F.lit(chk.column).cast("string").alias("column_name"),
        F.lit(chk.severity).alias("severity"),
        observed.cast("double").alias("observed"),
        total.cast("long").alias("total"),
        unexpected.cast("long").alias("unexpected"),
        success.alias("success"),
        _status(success, chk.severity).alias("status"),
    )


ROW_KINDS = {"not_null", "expect_not_null", "accepted_range", "accepted_values", "expect_between", "expect_in_set",
             "expect_match_regex"}
VALUE_KINDS = {"unique", "expect_unique", "expect_unique_proportion"}


def row_counts(suite: Suite) -> list[Column]:
    """The suite's row-level checks as counts (``_n`` rows, ``_u<i>`` unexpected, ``_t<i>`` total): they add up over parts."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, chk in enumerate(suite.checks):
        if chk.kind in ROW_KINDS:
            u, t = _row_level(chk, F.count(F.lit(1)))
            aggs += [u.alias(f"_u{i}"), t.alias(f"_t{i}")]
    return aggs


def row_results(counts: DataFrame, suite: Suite, columns: set[str], by: list[str]) -> DataFrame | None:
    """Results of the row-level, row-count and column checks from ``row_counts``."""
    rows, n = [], F.col("_n")
    for i, chk in enumerate(suite.checks):
        if chk.kind in ROW_KINDS:
            uu, tt = F.col(f"_u{i}"), F.col(f"_t{i}")
            if chk.kind in STRICT_KINDS:
                ok = uu == 0
                obs = uu
            else:
                ok = _mostly_ok(uu, tt, chk.mostly)
                obs = F.when(tt > 0, (tt - uu).cast("double") / tt)
            rows.append(_row(suite.name, i, chk, obs, tt, uu, ok))
        elif chk.kind == "row_count_between":
            ok = F.lit(True)
            if chk.min is not None:
                ok = ok & (n >= chk.min)
            if chk.max is not None:
                ok = ok & (n <= chk.max)
            rows.append(_row(suite.name, i, chk, n, n, F.when(ok, 0).otherwise(1), ok))
        elif chk.kind == "column_exists":
            exists = chk.column in columns
            rows.append(_row(suite.name, i, chk, F.lit(1.0 if exists else 0.0), n,
                             F.lit(0 if exists else 1), F.lit(exists)))
    return counts.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*") if rows else None


def value_columns(suite: Suite) -> list[str]:
    """Columns that the suite's uniqueness and proportion checks look at."""
    return sorted({c.column for c in suite.checks if c.kind in VALUE_KINDS})


def value_counts(per_value: DataFrame, column: str, by: list[str]) -> DataFrame:
    """(value, _cnt) -> ``_dup`` rows of repeated values, ``_distinct`` values, ``_nonnull`` rows."""
    known = F.col(column).isNotNull()
    aggs = [F.coalesce(F.sum(F.when(known & (F.col("_cnt") > 1), F.col("_cnt"))), F.lit(0)).alias("_dup"),
            F.count(F.when(known, 1)).alias("_distinct"),
            F.coalesce(F.sum(F.when(known, F.col("_cnt"))), F.lit(0)).alias("_nonnull")]
    # without ``by`` this is a global aggregate: one row even for an empty table
    return per_value.groupBy(*by).agg(*aggs) if by else per_value.agg(*aggs)


def value_results(stats: DataFrame, suite: Suite, column: str, by: list[str]) -> DataFrame:
    """Results of the uniqueness and proportion checks of a column from ``value_counts``."""
    rows = []
    dup, dist, nn = F.col("_dup"), F.col("_distinct"), F.col("_nonnull")
    for i, chk in enumerate(suite.checks):
        if chk.column != column:
            continue
        if chk.kind == "unique":
            rows.append(_row(suite.name, i, chk, dup, nn, dup, dup == 0))
        elif chk.kind == "expect_unique":
            rows.append(_row(suite.name, i, chk, F.when(nn > 0, (nn - dup).cast("double") / nn),
                             nn, dup, _mostly_ok(dup, nn, chk.mostly)))
        elif chk.kind == "expect_unique_proportion":
            p = F.when(nn > 0, dist.cast("double") / nn)
            ok = F.coalesce((p >= chk.min) & (p <= chk.max), F.lit(False))
            rows.append(_row(suite.name, i, chk, p, nn, F.when(ok, 0).otherwise(1), ok))
    return stats.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def run_suite(df: DataFrame, suite: Suite, by: list[str] | None = None,
              refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate every check of ``suite`` on the whole of ``df`` (optionally per ``by`` group)."""
    by = list(by or [])
    parts: list[DataFrame] = []

    # 1) one aggregation for all row-level checks + row counts
    aggs = row_counts(suite)
    found = row_results(df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs), suite, set(df.columns), by)
    if found is not None:
        parts.append(found)

    # 2) uniqueness / distinct proportion: one grouped count per column, by value *including* NULL,
    #    so every ``by`` group (even an all-NULL one) yields a row
    for col in value_columns(suite):
        per_value = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_cnt"))
        parts.append(value_results(value_counts(per_value, col, by), suite, col, by))

    # 3) foreign keys: child values reduced to (value, rows) per group first (partial
    #    aggregation); only distinct values meet the parent's key set, in a left join whose
    #    missing side flags orphans (every group keeps a result row, even with no orphan)
    for i, chk in enumerate(suite.checks):
        if chk.kind != "relationships":
            continue
        ref_name, ref_col = chk.ref
        parent = refs[ref_name].select(F.col(ref_col).alias("_k")).distinct().withColumn("_found", F.lit(True))
        child = df.groupBy(*by, chk.column).agg(F.count(F.lit(1)).alias("_rows"))
        flagged = child.join(parent, child[chk.column] == parent["_k"], "left")
        orphan = F.col(chk.column).isNotNull() & F.col("_found").isNull()
        counts = [F.coalesce(F.sum(F.when(cond, F.col("_rows"))), F.lit(0)).alias(name)
                  for name, cond in (("_u", orphan), ("_t", F.col(chk.column).isNotNull()))]
        cnt = flagged.groupBy(*by).agg(*counts) if by else flagged.agg(*counts)
        u, t = F.col("_u"), F.col("_t")
        parts.append(cnt.select(*by, _row(suite.name, i, chk, u, t, u, u == 0).alias("r")).select(*by, "r.*"))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*by, *RESULT_COLUMNS)


def enforce(results: DataFrame, on_failure: str = "warn") -> dict:
    """Act on a (small) result frame: 'warn' reports, 'raise' blocks on any
    error-severity failure. Returns counts for logging."""
    summary = results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count(F.when(F.col("status") == "fail", 1)).alias("failed"),
        F.count(F.when(F.col("status") == "warn", 1)).alias("warned"),
    ).first().asDict()
    if on_failure == "raise" and summary["failed"]:
        raise RuntimeError(f"data quality failed: {summary}")
    return summary


def should_run(run_id: str, every_n: int = 1) -> bool:
    """Deterministic 1-in-n throttle for expensive validations (stable hash)."""
    if every_n <= 1:
        return True
    return int(hashlib.md5(run_id.encode()).hexdigest(), 16) % every_n == 0


# ---- Fixed suites (values as configured upstream) ---------------------------

RAW_SUITE = Suite("raw_positions_suite", [
    Check("row_count_between", min=50, max=1500),
    Check("column_exists", "icao24"),
    Check("column_exists", "latitude"),
    Check("column_exists", "longitude"),
    Check("column_exists", "baro_altitude"),
    Check("expect_not_null", "icao24"),
    Check("expect_not_null", "latitude", mostly=0.95),
    Check("expect_between", "latitude", min=41.0, max=51.5, mostly=0.99),
    Check("expect_between", "longitude", min=-5.5, max=10.0, mostly=0.99),
    Check("expect_between", "baro_altitude", min=0, max=15000, mostly=0.95),
    Check("expect_between", "vitesse", min=0, max=340, mostly=0.99),
    Check("expect_match_regex", "icao24", regex="^[0-9a-f]{6}$", mostly=0.95),
    Check("expect_unique_proportion", "icao24", min=0.3, max=1.0),
])

FACT_SUITE = Suite("fact_positions_suite", [
    Check("row_count_between", min=1, max=10000000),
    Check("expect_not_null", "position_sk"),
    Check("expect_not_null", "vol_sk"),
    Check("expect_not_null", "timestamp_utc"),
    Check("expect_unique", "position_sk"),
    Check("expect_between", "altitude_baro_ft", min=-500, max=60000, mostly=0.99),
    Check("expect_between", "vitesse_kmh", min=0, max=1200, mostly=0.99),
    Check("expect_in_set", "tranche_vol", values=tuple(BAND_VALUES)),
    Check("expect_in_set", "phase_vol", values=tuple(PHASE_VALUES)),
    Check("expect_between", "latitude", min=41.0, max=51.5),
    Check("expect_between", "longitude", min=-5.5, max=10.0),
    Check("expect_unique_proportion", "vol_sk", min=0.001, max=0.5),
    Check("expect_not_null", "flag_changement_altitude_suspect", mostly=1.0),
])

STG_TESTS = Suite("stg_positions", [
    Check("not_null", "position_id_raw"),
    Check("unique", "position_id_raw"),
    Check("not_null", "icao24"),
    Check("not_null", "latitude"),
    Check("accepted_range", "latitude", min=41.0, max=51.5),
    Check("not_null", "longitude"),
    Check("accepted_range", "longitude", min=-5.5, max=10.0),
    Check("accepted_range", "altitude_baro_ft", min=-200, max=60000, severity="warn"),
    Check("accepted_range", "vitesse_ms", min=0, max=340),
    Check("not_null", "timestamp_position_utc"),
])

DIM_TESTS = Suite("dim_vols", [
    Check("not_null", "vol_sk"),
    Check("unique", "vol_sk"),
    Check("not_null", "icao24"),
    Check("unique", "icao24"),
    Check("not_null", "origine_pays"),
])

FACT_TESTS = Suite("fact_positions", [
    Check("not_null", "position_sk"),
    Check("unique", "position_sk"),
    Check("not_null", "vol_sk"),
    Check("relationships", "vol_sk", ref=("dim_vols", "vol_sk")),
    Check("not_null", "timestamp_utc"),
    Check("not_null", "latitude"),
    Check("accepted_range", "latitude", min=41.0, max=51.5),
    Check("not_null", "longitude"),
    Check("accepted_range", "longitude", min=-5.5, max=10.0),
    Check("accepted_range", "altitude_baro_ft", min=-200, max=60000, severity="warn"),
    Check("accepted_range", "vitesse_kmh", min=0, max=1200),
    Check("accepted_values", "tranche_vol", values=tuple(BAND_VALUES)),
    Check("accepted_values", "phase_vol", values=tuple(PHASE_VALUES)),
])


# ---- Singular test and freshness --------------------------------------------

def altitude_coherence(fact: DataFrame, max_gap_s: int = 120, max_rate: float = 100,
                       bucket_s: int = 30) -> DataFrame:
    """Airborne positions whose altitude changed faster than ``max_rate`` m/s
    since the previous airborne position of the same flight, 1..max_gap_s
    seconds earlier (warn-level singular test: rows returned = failures).

    The previous airborne position comes from ``continuity.attach_previous``
    (the fact holds one row per flight and 30 s bucket): a lag inside hour
    chunks, not a sort of a flight's whole history.
    """
    from ..functions.timecols import bucket_start, ntz_to_epoch
    from .continuity import attach_previous

    air = fact.filter(F.col("au_sol") == F.lit(False)).select(
        "position_sk", "vol_sk", "timestamp_utc", "altitude_baro_m", "latitude", "longitude",
        bucket_start("timestamp_utc", bucket_s).alias("_bucket"))
    p = attach_previous(air, "vol_sk", "_bucket", "timestamp_utc", ["altitude_baro_m"],
                        bucket_s=bucket_s, max_gap_s=max_gap_s)
    dt = ntz_to_epoch("timestamp_utc") - ntz_to_epoch("prev_timestamp_utc")
    out = p.select(
        "position_sk", "vol_sk", "timestamp_utc", "altitude_baro_m",
        F.col("prev_altitude_baro_m").alias("altitude_precedente_m"),
        F.col("prev_timestamp_utc").alias("timestamp_precedent"),
        F.abs(F.col("altitude_baro_m") - F.col("prev_altitude_baro_m")).alias("delta_altitude_m"),
        dt.alias("delta_secondes"),
    ).filter(F.col("altitude_precedente_m").isNotNull() & F.col("timestamp_precedent").isNotNull()
             & F.col("delta_secondes").between(1, max_gap_s))
    out = out.withColumn("taux_changement_ms", F.col("delta_altitude_m") / F.col("delta_secondes"))
    return out.filter(F.col("taux_changement_ms") > F.lit(float(max_rate)))


def freshness(raw: DataFrame, as_of, warn_after_s: int = 3600, error_after_s: int = 7200) -> DataFrame:
    """Source freshness: age of the newest ingested row against two limits."""
    from ..functions.timecols import ntz_literal, ntz_to_epoch

    agg = raw.agg(F.max("ingested_at").alias("dernier_ingest"))
    age = ntz_to_epoch(ntz_literal(as_of)) - ntz_to_epoch("dernier_ingest")
    return agg.select(
        "dernier_ingest",
        age.alias("age_secondes"),
        F.when(age.isNull() | (age > error_after_s), F.lit("error"))
        .when(age > warn_after_s, F.lit("warn")).otherwise(F.lit("pass")).alias("status"),
    )


def store_results(results: DataFrame, path: str, run_id: str, as_of) -> None:
    """A suite's results into the validation-result store (SNK5), stamped with the run id and time.

    A run stores each suite once: a replay of the run finds its rows (one append is one commit, so all or none of
    them are there) and adds nothing. Partitioned by suite and day, so that look-up and history read one day's files."""
    from ..functions.timecols import ntz_literal
    from .sinks import read_if_exists

    new = results.withColumns({"run_id": F.lit(run_id), "run_at": ntz_literal(as_of), "run_day": F.lit(as_of.date())})
    stored = read_if_exists(results.sparkSession, path, new.schema)
    if stored is not None:
        known = stored.where((F.col("run_day") == F.lit(as_of.date())) & (F.col("run_id") == run_id)).select("suite").distinct()
        new = new.join(known, "suite", "left_anti").select(*new.columns)
    new.write.mode("append").partitionBy("suite", "run_day").parquet(path)
