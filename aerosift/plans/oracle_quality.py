"""DuckDB SQL for data-quality suites and the other ingest/quality queries.

Each check is written as its own SELECT (the plain SQL reading of the
check's meaning) and the results are combined with UNION ALL.
"""

from __future__ import annotations

from ..operators.quality import STRICT_KINDS, Check, Suite


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def _range(col: str, chk: Check) -> str:
    lo = f"{col} >= {_lit(chk.min)}" if chk.inclusive else f"{col} > {_lit(chk.min)}"
    hi = f"{col} <= {_lit(chk.max)}" if chk.inclusive else f"{col} < {_lit(chk.max)}"
    if chk.min is None:
        return hi
    if chk.max is None:
        return lo
    return f"({lo} AND {hi})"


def _result(suite: str, i: int, chk: Check, obs: str, total: str, unexpected: str, ok: str, by: list[str],
            src: str) -> str:
    bad = "warn" if chk.severity == "warn" else "fail"
    col = _lit(chk.column) if chk.column else "CAST(NULL AS VARCHAR)"
    b = "".join(f"{c}, " for c in by)
    return (f"SELECT {b}'{suite}' AS suite, {i} AS check_order, '{chk.kind}' AS check_name, {col} AS column_name, "
            f"'{chk.severity}' AS severity, CAST({obs} AS DOUBLE) AS observed, CAST({total} AS BIGINT) AS total, "
            f"CAST({unexpected} AS BIGINT) AS unexpected, ({ok}) AS success, "
            f"CASE WHEN ({ok}) THEN 'pass' ELSE '{bad}' END AS status FROM ({src}) x")


def _mostly(u: str, t: str, mostly: float) -> str:
    return f"CASE WHEN {t} = 0 THEN TRUE ELSE CAST({t} - {u} AS DOUBLE) / {t} >= {_lit(mostly)} END"


def suite_sql(table: str, suite: Suite, columns: list[str], by: list[str] | None = None,
              refs: dict[str, str] | None = None) -> str:
    by = list(by or [])
    b = "".join(f"{c}, " for c in by)
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    parts = []
    for i, chk in enumerate(suite.checks):
        c = chk.column
        k = chk.kind
        if k in ("not_null", "expect_not_null"):
            src = f"SELECT {b}count(*) FILTER (WHERE {c} IS NULL) AS u, count(*) AS t FROM {table}{grp}"
        elif k == "accepted_range":
            src = f"SELECT {b}count(*) FILTER (WHERE NOT {_range(c, chk)}) AS u, count(*) AS t FROM {table}{grp}"
        elif k == "accepted_values":
            vals = ", ".join(_lit(v) for v in chk.values)
            src = f"SELECT {b}count(*) FILTER (WHERE {c} NOT IN ({vals})) AS u, count(*) AS t FROM {table}{grp}"
        elif k == "expect_between":
            src = (f"SELECT {b}count(*) FILTER (WHERE {c} IS NOT NULL AND NOT {_range(c, chk)}) AS u, "
                   f"count({c}) AS t FROM {table}{grp}")
        elif k == "expect_in_set":
            vals = ", ".join(_lit(v) for v in chk.values)
            src = (f"SELECT {b}count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) AS u, "
                   f"count({c}) AS t FROM {table}{grp}")
        elif k == "expect_match_regex":
            src = (f"SELECT {b}count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_matches({c}, {_lit(chk.regex)})) "
                   f"AS u, count({c}) AS t FROM {table}{grp}")
        elif k == "row_count_between":
            conds = ["TRUE"]
            if chk.min is not None:
                conds.append(f"n >= {chk.min}")
            if chk.max is not None:
                conds.append(f"n <= {chk.max}")
            ok = " AND ".join(conds)
            src = f"SELECT {b}count(*) AS n FROM {table}{grp}"
            parts.append(_result(suite.name, i, chk, "n", "n", f"CASE WHEN {ok} THEN 0 ELSE 1 END", ok, by, src))
            continue
        elif k == "column_exists":
            ex = c in columns
            src = f"SELECT {b}count(*) AS n FROM {table}{grp}"
            parts.append(_result(suite.name, i, chk, "1.0" if ex else "0.0", "n", "0" if ex else "1",
                                 "TRUE" if ex else "FALSE", by, src))
            continue
        elif k in ("unique", "expect_unique", "expect_unique_proportion"):
            inner = f"SELECT {b}{c}, count(*) AS cnt FROM {table} GROUP BY {b}{c}"
            src = (f"SELECT {b}coalesce(sum(CASE WHEN {c} IS NOT NULL AND cnt > 1 THEN cnt END), 0) AS dup, "
                   f"count({c}) AS dist, coalesce(sum(CASE WHEN {c} IS NOT NULL THEN cnt END), 0) AS nn "
                   f"FROM ({inner}) y{grp}")
            if k == "unique":
                parts.append(_result(suite.name, i, chk, "dup", "nn", "dup", "dup = 0", by, src))
            elif k == "expect_unique":
                parts.append(_result(suite.name, i, chk, "CASE WHEN nn > 0 THEN CAST(nn - dup AS DOUBLE) / nn END",
                                     "nn", "dup", _mostly("dup", "nn", chk.mostly), by, src))
            else:
                p = "CASE WHEN nn > 0 THEN CAST(dist AS DOUBLE) / nn END"
                ok = f"coalesce({p} >= {_lit(chk.min)} AND {p} <= {_lit(chk.max)}, FALSE)"
                parts.append(_result(suite.name, i, chk, p, "nn", f"CASE WHEN {ok} THEN 0 ELSE 1 END", ok, by, src))
            continue
        elif k == "relationships":
            ref_name, ref_col = chk.ref
            parent = refs[ref_name]
            src = (f"SELECT {b}count(*) FILTER (WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {parent} pa WHERE pa.{ref_col} = ch.{c})) AS u, count(ch.{c}) AS t FROM {table} ch{grp}")
            parts.append(_result(suite.name, i, chk, "u", "t", "u", "u = 0", by, src))
            continue
        else:
            raise ValueError(k)
        if k in STRICT_KINDS:
            parts.append(_result(suite.name, i, chk, "u", "t", "u", "u = 0", by, src))
        else:
            parts.append(_result(suite.name, i, chk, "CASE WHEN t > 0 THEN CAST(t - u AS DOUBLE) / t END", "t", "u",
                                 _mostly("u", "t", chk.mostly), by, src))
    return "\nUNION ALL\n".join(parts)
