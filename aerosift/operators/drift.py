"""Stored tables whose schema follows their input (SNK8, ``on_schema_change``).

A drifting table is a partitioned Parquet folder with a small schema log beside the
data (``_schemas``, one JSON file for each change; Spark's readers skip the folder). A logical
column is stored in one or more *stored columns*:

* a new column gets a stored column of its own; older files lack it and give typed NULLs,
* a column whose type widens gets a further stored column of the wider type; a read
  takes the newest that is set and casts the older ones, so no file is rewritten,
* a removed column is no longer read; a later column of the same name starts empty,
  because it has another stored column.

So a change of schema costs one small file, whatever the size of the table, and the log is written
before the data: a write that dies in between leaves a table that reads correctly.

Policies, as the upstream models name them: ``sync_all_columns`` (the table takes the input's columns), ``append_new_columns``
(nothing is removed; missing values are NULL), ``ignore`` (the table keeps its columns; further ones are
dropped), ``fail`` (a change raises ``SchemaDriftError``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, materialize, scratch_path
from .sinks import _as_list, _folder, in_partitions, write_clustered

POLICIES = ("sync_all_columns", "append_new_columns", "ignore", "fail")
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaDriftError(ValueError):
    """A schema change that the policy or the types do not allow."""


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """(digits before, digits after the point) that hold every value of an exact number type."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return ([3, 5, 10, 19][_WHOLE.index(t)], 0) if t in _WHOLE else None


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both without loss; text where no other does.

    Long values beyond 2**53 do not fit a double, so long and double meet as text too."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if _digits(a) and _digits(b):
        before, after = (max(x, y) for x, y in zip(_digits(a), _digits(b)))
        return T.DecimalType(before + after, after) if before + after <= 38 else T.StringType()
    kinds = {type(a), type(b)}
    if T.DoubleType in kinds and kinds & {T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if T.FloatType in kinds and kinds & {T.ByteType, T.ShortType}:
        return T.FloatType()
    if T.FloatType in kinds and T.IntegerType in kinds:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        own, other = ({f.name: f.dataType for f in s} for s in (a, b))
        return T.StructType([T.StructField(n, widest(own.get(n, T.NullType()), other.get(n, T.NullType())))
                             for n in [*own, *(n for n in other if n not in own)]])
    if any(isinstance(x, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)) for x in (a, b)):
        raise SchemaDriftError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def cast_to(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast that follows ``widest`` through arrays and structs by field name; absent fields become typed NULLs."""
    if have == want:
        return c
    if isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: cast_to(x, have.elementType, want.elementType))
    if isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have}
        made = F.struct(*[(cast_to(c[f.name], own[f.name], f.dataType) if f.name in own
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in want])
        return F.when(c.isNotNull(), made)
    return c.cast(want)


@dataclass
class Change:
    """A table's schema after a write, and what the write changed."""
    schema: T.StructType
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)

    @property
    def any(self) -> bool:
        return bool(self.added or self.removed or self.widened)


def reconcile(stored: T.StructType, incoming: T.StructType, policy: str = "sync_all_columns") -> Change:
    """The schema that the table has after a write of ``incoming`` rows. Stored columns keep their order; new ones follow."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    old, new = ({f.name: f.dataType for f in s} for s in (stored, incoming))
    if len(new) < len(incoming):
        raise SchemaDriftError("the input repeats a column name")
    wide = {n: widest(t, new[n]) for n, t in old.items() if n in new}
    change = Change(T.StructType([]), added=[n for n in new if n not in old], removed=[n for n in old if n not in new],
                    widened=[n for n, t in wide.items() if t != old[n]])
    if policy == "fail" and change.any:
        raise SchemaDriftError(f"added {change.added}, removed {change.removed}, widened {change.widened}")
    if policy != "sync_all_columns":
        change.removed = []
    if policy == "ignore":
        change.added, change.widened = [], []
        change.schema = stored
        return change
    keep = [T.StructField(n, wide.get(n, t)) for n, t in old.items() if n not in change.removed]
    change.schema = T.StructType([*keep, *[T.StructField(n, new[n]) for n in change.added]])
    return change


# ---- the schema log -----------------------------------------------------------

@dataclass
class Layout:
    """One entry of the log: each logical column with its stored columns, oldest first."""
    version: int
    columns: dict[str, list[tuple[str, T.DataType]]]
    change: Change

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, parts[-1][1]) for n, parts in self.columns.items()])

    def to_json(self) -> str:
        c = self.change
        return json.dumps({"version": self.version, "added": c.added, "removed": c.removed, "widened": c.widened, "columns": [
            {"name": n, "stored": [[s, t.jsonValue()] for s, t in parts]} for n, parts in self.columns.items()]})

    @staticmethod
    def from_json(text: str) -> Layout:
        d = json.loads(text)
        kind = lambda t: T.StructType.fromJson({"type": "struct", "fields": [
            {"name": "c", "type": t, "nullable": True, "metadata": {}}]})[0].dataType
        columns = {c["name"]: [(s, kind(t)) for s, t in c["stored"]] for c in d["columns"]}
        return Layout(d["version"], columns, Change(T.StructType([]), d["added"], d["removed"], d["widened"]))

    def after(self, change: Change) -> Layout:
        """The next entry: new and widened columns get stored columns that no earlier entry has used."""
        version = self.version + 1
        columns = {f.name: [*self.columns.get(f.name, [])] for f in change.schema}
        used = {s for parts in self.columns.values() for s, _ in parts} | {f.name for f in change.schema}
        for f in change.schema:
            if f.name in [*change.added, *change.widened]:
                name = f"{f.name}__{version}"
                while name in used:
                    name += "_"
                columns[f.name].append((name, f.dataType))
        return Layout(version, columns, change)


def _log(path: str) -> str:
    return f"{path}/_schemas"


def layouts(spark: SparkSession, path: str) -> list[Layout]:
    """The table's schema log, oldest first; [] where there is no table."""
    fs, folder = _folder(spark, _log(path))
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    files = [f"{_log(path)}/{n}" for n in names if n.endswith(".json")]
    return [Layout.from_json(r[0]) for r in sorted(spark.read.text(files, wholetext=True).collect(),
                                                   key=lambda r: json.loads(r[0])["version"])] if files else []


def _write_layout(spark: SparkSession, path: str, layout: Layout) -> None:
    """Add an entry: written beside the log, then renamed into it, so that no reader sees half of it."""
    fs, folder = _folder(spark, _log(path))
    fs.mkdirs(folder)
    at = spark._jvm.org.apache.hadoop.fs.Path
    part, name = at(f"{_log(path)}/.{layout.version:06d}"), at(f"{_log(path)}/{layout.version:06d}.json")
    out = fs.create(part, True)
    out.write(bytearray(layout.to_json().encode()))
    out.close()
    if not fs.rename(part, name):
        raise SchemaDriftError(f"schema version {layout.version} of {path} was written by another job")


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """version, added, removed, widened: one row for each schema change of the table."""
    rows = [(x.version, x.change.added, x.change.removed, x.change.widened) for x in layouts(spark, path)]
    return spark.createDataFrame(rows, "version int, added array<string>, removed array<string>, widened array<string>")


# ---- reads and writes -----------------------------------------------------------

def _stored_schema(layout: Layout, parts: list[str]) -> T.StructType:
    fields = [T.StructField(s, t) for n, stored in layout.columns.items() for s, t in stored if n not in parts]
    return T.StructType([*fields, *[T.StructField(p, layout.schema[p].dataType) for p in parts]])


def _logical(files: DataFrame, layout: Layout, parts: list[str]) -> DataFrame:
    def of(name, stored):
        if name in parts:
            return F.col(name)
        want = stored[-1][1]
        return F.coalesce(*[cast_to(F.col(f"`{s}`"), t, want) for s, t in reversed(stored)]).alias(name)

    return files.select(*[of(n, stored) for n, stored in layout.columns.items()])


def read_drifting(spark: SparkSession, path: str, partition_cols) -> DataFrame | None:
    """The table under its newest schema, or None where there is no table."""
    log = layouts(spark, path)
    if not log:
        return None
    parts = _as_list(partition_cols)
    schema = _stored_schema(log[-1], parts)
    fs, folder = _folder(spark, path)
    if all(s.getPath().getName().startswith("_") for s in fs.listStatus(folder)):      # the log is there, no data yet
        return _logical(spark.createDataFrame([], schema), log[-1], parts)
    return _logical(spark.read.schema(schema).parquet(path), log[-1], parts)


def sync_schema(spark: SparkSession, path: str, incoming: T.StructType, partition_cols, policy: str = "sync_all_columns") -> Layout:
    """Bring the table's schema in line with the input, adding to the log if it changes."""
    parts = _as_list(partition_cols)
    log = layouts(spark, path)
    if not log:
        columns = {f.name: [(f.name, f.dataType)] for f in incoming}
        layout = Layout(1, columns, Change(incoming, added=list(columns)))
    else:
        change = reconcile(log[-1].schema, incoming, policy)
        if not change.any:
            return log[-1]
        if set(parts) & {*change.added, *change.removed, *change.widened}:
            raise SchemaDriftError(f"partition columns {parts} cannot change")
        layout = log[-1].after(change)      # stored names carry the version, so a removed column's are not used again
    _write_layout(spark, path, layout)
    return layout


def _to_stored(rows: DataFrame, layout: Layout, parts: list[str]) -> DataFrame:
    """Logical rows -> stored columns of the newest types. Columns that the rows lack are left out (NULL)."""
    have = {f.name: f.dataType for f in rows.schema}
    out = []
    for name, stored in layout.columns.items():
        if name in have:
            to, kind = stored[-1]
            out.append(cast_to(F.col(name), have[name], kind).alias(name if name in parts else to))
    return rows.select(*out)


def append_drifting(spark: SparkSession, rows: DataFrame, path: str, partition_cols, cluster_col: str,
                    policy: str = "sync_all_columns") -> Layout:
    """Append rows under their own schema."""
    parts = _as_list(partition_cols)
    layout = sync_schema(spark, path, rows.schema, parts, policy)
    stored = _to_stored(rows, layout, parts)
    write_clustered(stored, path, parts, layout.columns[cluster_col][-1][0], mode="append")
    return layout


def merge_drifting(spark: SparkSession, batch: DataFrame, path: str, key: str, partition_cols, cluster_col: str,
                   order: list[str], policy: str = "sync_all_columns") -> dict:
    """Insert-only merge under drift: rows whose key is not stored yet, one for each key (first by ``order``).

    Equal keys must share their partition. Returns the counts and the schema version."""
    from pyspark.sql import Window

    parts = _as_list(partition_cols)
    first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    rows = materialize(batch.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"), "drift-batch")
    stored = read_drifting(spark, path, parts)
    if stored is not None:
        rows = materialize(rows.join(in_partitions(stored, rows, parts).select(key), key, "left_anti"), "drift-fresh")
    layout = append_drifting(spark, rows.select(*batch.columns), path, parts, cluster_col, policy)
    total, inserted = batch.count(), rows.count()
    return {"inserted": inserted, "skipped": total - inserted, "total": total, "schema_version": layout.version}


def upsert_drifting(spark: SparkSession, rows: DataFrame, path: str, key: str, partition_cols, cluster_col: str | None = None,
                    policy: str = "sync_all_columns") -> Layout:
    """Replace rows by key under drift. Touched partitions are written anew under the newest schema; the others keep their files."""
    parts = _as_list(partition_cols)
    rows = materialize(rows, "drift-rows")
    layout = sync_schema(spark, path, rows.schema, parts, policy)
    stored = read_drifting(spark, path, parts)
    have, new = {f.name for f in rows.schema}, rows
    full = rows.select(*[cast_to(F.col(f.name), new.schema[f.name].dataType, f.dataType).alias(f.name) if f.name in have
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in layout.schema])
    kept = in_partitions(stored, rows, parts).join(rows.select(key), key, "left_anti")
    staged = scratch_path(spark, "drift-staged")
    kept.unionByName(full).write.parquet(staged)
    merged = _to_stored(spark.read.schema(layout.schema).parquet(staged), layout, parts)
    write_clustered(merged, path, parts, layout.columns[cluster_col or key][-1][0], dynamic=True)
    delete_path(spark, staged)
    return layout
