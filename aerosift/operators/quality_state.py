"""Incremental suites (DQ19): check states for each partition, merged into the suite's results.

A suite over a stored table keeps, for each partition of the table,

* ``counts``: the counts of its row-level checks, which add up,
* ``values/<column>``: for each uniqueness or proportion column the values of the partition with their counts, which add up by
  value; for a *pinned* column (one whose value fixes the partition, such as a key derived from the row's
  own hour) only the partition's three totals, which add up as they are.

``update_states`` recomputes the states of the partitions that a batch touched, reading those partitions
of the table only, and replaces them; ``suite_results`` merges the states of all partitions and never reads the table. The
results equal ``run_suite`` over the whole table. Foreign keys are decided on the merged values of their column
against the parent's keys, so their column keeps its values too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .quality import RESULT_COLUMNS, Suite, _row, row_counts, row_results, value_columns, value_counts, value_results
from .sinks import _as_list, in_partitions, read_if_exists, replace_partitions

_TOTALS = ["_dup", "_distinct", "_nonnull"]


def _columns(suite: Suite) -> list[str]:
    keys = {c.column for c in suite.checks if c.kind == "relationships"}
    return sorted({*value_columns(suite), *keys})


def _states(table: DataFrame, suite: Suite, parts: list[str], pinned: tuple[str, ...]) -> dict[str, DataFrame]:
    """State name -> rows of it for every partition in ``table``."""
    out = {"counts": table.groupBy(*parts).agg(*row_counts(suite))}
    for col in _columns(suite):
        per_value = table.groupBy(*parts, col).agg(F.count(F.lit(1)).alias("_cnt"))
        out[f"values/{col}"] = value_counts(per_value, col, parts) if col in pinned else per_value
    return out


def update_states(spark: SparkSession, table: DataFrame, touched: DataFrame, root: str, suite: Suite, partition_cols,
                  pinned: tuple[str, ...] = ()) -> None:
    """Replace the states of the partitions listed in ``touched`` (all columns of ``partition_cols``).

    A run that dies in between leaves states of some kinds old; running it again for the same partitions mends that."""
    parts = _as_list(partition_cols)
    needed = {c.column for c in suite.checks if c.column in table.columns}
    rows = in_partitions(table.select(*parts, *sorted(needed - set(parts))), touched, parts)
    for name, state in _states(rows, suite, parts, pinned).items():
        replace_partitions(spark, materialize(state, "dq-state"), f"{root}/{suite.name}/{name}", parts, parts[-1])


def suite_results(spark: SparkSession, table: DataFrame, root: str, suite: Suite, partition_cols, pinned: tuple[str, ...] = (),
                  refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """The suite's results from its states; of ``table`` only the schema is used."""
    parts = _as_list(partition_cols)
    shapes = _states(spark.createDataFrame([], table.schema), suite, parts, pinned)

    def state(name: str) -> DataFrame:
        kept = [f for f in shapes[name].schema if f.name not in parts]
        schema = T.StructType([*kept, *[table.schema[p] for p in parts]])
        found = read_if_exists(spark, f"{root}/{suite.name}/{name}", schema)
        return spark.createDataFrame([], schema) if found is None else found

    counts = state("counts")
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c not in parts])
    found = [row_results(total, suite, set(table.columns), [])]
    for col in _columns(suite):
        rows = state(f"values/{col}")
        if col in pinned:
            stats = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS])
        else:
            rows = rows.groupBy(col).agg(F.sum("_cnt").alias("_cnt"))
            stats = value_counts(rows, col, [])
        if col in value_columns(suite):
            found.append(value_results(stats, suite, col, []))
        for i, chk in enumerate(suite.checks):
            if chk.kind == "relationships" and chk.column == col:
                name, key = chk.ref
                parent = refs[name].select(F.col(key).alias(col)).distinct()
                absent = rows.where(F.col(col).isNotNull()).join(parent, col, "left_anti").agg(
                    F.coalesce(F.sum("_cnt"), F.lit(0)).alias("_u"))
                known = rows.agg(F.coalesce(F.sum(F.when(F.col(col).isNotNull(), F.col("_cnt"))), F.lit(0)).alias("_t"))
                both = absent.withColumn("_t", F.lit(None).cast("long")).unionByName(known.withColumn("_u", F.lit(None).cast("long")))
                u, t = F.col("_u"), F.col("_t")
                found.append(both.agg(F.max("_u").alias("_u"), F.max("_t").alias("_t")).select(
                    _row(suite.name, i, chk, u, t, u, u == 0).alias("r")).select("r.*"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select(*RESULT_COLUMNS)
