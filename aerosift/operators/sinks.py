"""Writes: insert-only merge of landed batches, keyed upsert, clustered layout.

Parquet has no MERGE; each operation is a set-based plan:

* insert-only merge (SNK1): one row per id inside the batch (a total order),
  anti-join against the stored ids of the touched event hours and of the
  untimed partition (partition pruning), append.
* keyed upsert (SNK2): rows of the touched partitions minus the replaced
  keys, plus the new rows, written to a staged folder first and then swapped
  in with a dynamic partition overwrite (never overwrite a path being read); the
  next upsert finishes a swap that died. Where the better of the stored and the new
  row stays, both meet in one range shuffle and the staged folders are moved.
* clustered write (SNK3): range-partitioned on (partition columns, cluster
  column) and sorted, so a table has about as many files as its size asks for
  and each file covers a narrow key range.
* versioned tables (one row per key, e.g. the dimension): each write is a new
  folder; readers take the newest complete one, so a crash loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from ..functions.timecols import epoch_to_ntz
from ..schemas import RAW_COLUMNS, RAW_POSITIONS
from ..session import delete_path, scratch_path

EVENT_DATE = "event_date"
EVENT_HOUR = "event_hour"
EVENT_PARTITIONS = [EVENT_DATE, EVENT_HOUR]


def with_event_date(raw: DataFrame) -> DataFrame:
    """Partition columns of the raw table: the position's UTC date and hour.
    The id hashes time_position, so equal ids always share both; a merge
    reads the stored ids of the touched hours only."""
    t = epoch_to_ntz("time_position")
    return raw.withColumn(EVENT_DATE, F.to_date(t)).withColumn(EVENT_HOUR, F.hour(t))


RAW_TABLE = T.StructType([*RAW_POSITIONS.fields, T.StructField(EVENT_DATE, T.DateType()),
                          T.StructField(EVENT_HOUR, T.IntegerType())])


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, for its own scheme."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if there is no such path. Errors of an existing one are raised."""
    fs, folder = _folder(spark, path)
    return spark.read.schema(schema).format(fmt).load(path) if fs.exists(folder) else None


def one_per_id(batch: DataFrame) -> DataFrame:
    """First row per id in a total order: earliest ingest, batch id, then every other raw column."""
    order = ["ingested_at", "batch_id", *[c for c in RAW_COLUMNS if c not in ("id", "ingested_at", "batch_id")]]
    w = Window.partitionBy("id").orderBy(*[F.col(c).asc_nulls_last() for c in order if c in batch.columns])
    return batch.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def new_rows(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` whose id is not stored yet (one per id)."""
    b = with_event_date(one_per_id(batch.drop(*EVENT_PARTITIONS)))
    if existing is None:
        return b
    # equal ids share their partition, so only the batch's partitions (the untimed one too) are read
    stored = in_partitions(existing, b, EVENT_PARTITIONS).select("id")
    return b.join(stored, "id", "left_anti")


def merge_rows(spark: SparkSession, batch: DataFrame, table_path: str) -> tuple[dict, DataFrame | None]:
    """Insert-only merge of a landed batch into the raw Parquet table.

    Returns ``{"inserted", "skipped", "total"}`` and the inserted rows, stored
    beside the table: a later incremental update reads them instead of scanning raw."""
    # the stored schema is fixed: project (and type) every batch to the raw columns
    batch = batch.select(*[F.col(f.name).cast(f.dataType) if f.name in batch.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_POSITIONS.fields])
    if batch.isEmpty():
        return {"inserted": 0, "skipped": 0, "total": 0}, None
    existing = read_if_exists(spark, table_path, RAW_TABLE)
    total, inserted = Observation("batch_total"), Observation("batch_inserted")
    fresh = new_rows(batch.observe(total, F.count(F.lit(1)).alias("n")), existing)
    staged = scratch_path(spark, "inserted")
    fresh.observe(inserted, F.count(F.lit(1)).alias("n")).write.parquet(staged)
    rows = spark.read.schema(RAW_TABLE).parquet(staged)
    write_clustered(rows, table_path, EVENT_PARTITIONS, "icao24", mode="append")
    n, m = total.get["n"], inserted.get["n"]
    return {"inserted": m, "skipped": n - m, "total": n}, rows


def merge_raw(spark: SparkSession, batch: DataFrame, table_path: str) -> dict:
    """``merge_rows`` for callers that only want the counts."""
    return merge_rows(spark, batch, table_path)[0]


def dedup_rate(stats: dict) -> float:
    """Skipped share of a batch in percent (total 0 counts as 1)."""
    skipped = stats.get("skipped", 0) or 0
    total = stats.get("total", 1) or 1
    return skipped / total * 100


def merge_stats(batches: DataFrame, batch_key: str = "ingested_at") -> DataFrame:
    """Per-batch inserted / skipped / total of a sequence of insert-only merges,
    computed set-wise: an id is inserted by the earliest batch holding it.

    Equal to merging batch after batch in ``batch_key`` order (twins inside a
    batch count once), with two aggregations and no per-batch loop.
    """
    firsts = batches.groupBy("id").agg(F.min(batch_key).alias(batch_key))
    inserted = firsts.groupBy(batch_key).agg(F.count(F.lit(1)).alias("inserted"))
    totals = batches.groupBy(batch_key).agg(F.min("batch_id").alias("batch_id"),
                                            F.count(F.lit(1)).alias("total"))
    j = totals.join(inserted, batch_key, "left")
    ins = F.coalesce(F.col("inserted"), F.lit(0)).cast("long")
    return j.select(
        batch_key, "batch_id", "total", ins.alias("inserted"), (F.col("total") - ins).alias("skipped"),
        ((F.col("total") - ins) / F.col("total") * 100).alias("dedup_rate_pct"),
    )


def ingestion_stats(raw: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Rows, distinct aircraft, distinct batches and newest ingest of the last hour (ING12)."""
    from datetime import timedelta

    from ..functions.timecols import ntz_literal

    since = as_of - timedelta(hours=hours)
    r = raw.filter(F.col("ingested_at") >= ntz_literal(since))
    return r.agg(
        F.count(F.lit(1)).alias("total_positions"),
        F.countDistinct("icao24").alias("avions_uniques"),
        F.countDistinct("batch_id").alias("nombre_batches"),
        F.max("ingested_at").alias("dernier_batch"),
    )


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# per-write option (no session-wide setting): overwrite only the partitions present in the data
DYNAMIC = ("partitionOverwriteMode", "dynamic")


def write_clustered(df: DataFrame, path: str, partition_cols="date_utc", cluster_col: str = "vol_sk",
                    mode: str = "overwrite", dynamic: bool = False) -> None:
    """Partition by ``partition_cols``; every file sorted by, and a narrow range of, (partition cols, cluster_col).

    The range shuffle deals whole key ranges to tasks (adaptive execution merges small ones), so the
    number of files follows the data's size and the number of partitions, not their product with the tasks."""
    parts = _as_list(partition_cols)
    w = df.repartitionByRange(*parts, cluster_col).sortWithinPartitions(*parts, cluster_col).write.mode(mode)
    if dynamic:
        w = w.option(*DYNAMIC)
    w.partitionBy(*parts).parquet(path)


def in_partitions(table: DataFrame, keys: DataFrame, partition_cols) -> DataFrame:
    """Rows of ``table`` that lie in the partitions listed in ``keys``.

    Timed partitions: equality semi-join, so dynamic partition pruning reads only
    those. The partition without a time (NULL) is read only if ``keys`` has one."""
    parts = _as_list(partition_cols)
    keys = keys.select(*parts).distinct()
    found = table.join(keys.dropna(subset=parts[:1]), parts, "left_semi")
    null_part = F.col(parts[0]).isNull()
    return found if keys.filter(null_part).isEmpty() else found.unionByName(table.filter(null_part))


def best_clustered(rows: DataFrame, key: str, order, partition_cols, cluster_col: str) -> DataFrame:
    """The first row of each ``key`` by ``order``, dealt and sorted as ``write_clustered`` does; a key has one (partition, cluster column).

    All rows of a key meet in the shuffle that clusters them, so choosing between them takes no other."""
    parts = _as_list(partition_cols)
    w = Window.partitionBy(*parts, cluster_col, key).orderBy(*order)
    return rows.repartitionByRange(*parts, cluster_col).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn") \
        .sortWithinPartitions(*parts, cluster_col)


def upsert(spark: SparkSession, df: DataFrame, table_path: str, key: str, partition_cols,
           cluster_col: str | None = None, order=None) -> None:
    """Replace rows by ``key`` in the touched partitions of a Parquet table.

    Keys never move across partitions (the partition values derive from the
    key's own timestamp), so only the touched partitions are rewritten: with
    (day, hour) partitions a 10-minute batch rewrites the hours it touches.

    Their whole new content is staged inside the table's folder (``_upsert``, which readers skip) before the
    swap, which deletes a partition before it renames the new one. A run that dies in the swap leaves the staged rows,
    and the next upsert finishes it first.

    With ``order`` a new row does not always replace the stored one: the first of all rows of a key in that order stays. Stored and new
    rows are then shuffled once, and staged as the partitions' folders, so that the swap moves folders and writes no row again.
    """
    parts = _as_list(partition_cols)
    finish_upsert(spark, table_path, df.schema, parts, cluster_col or key)
    existing = read_if_exists(spark, table_path, df.schema)
    if order is not None:
        rows = df if existing is None else in_partitions(existing, df, parts).unionByName(df)
        best_clustered(rows, key, order, parts, cluster_col or key).write.mode("overwrite").partitionBy(*parts).parquet(_staged(table_path))
        finish_upsert(spark, table_path, df.schema, parts, cluster_col or key)
        return
    if existing is None:
        write_clustered(df, table_path, parts, cluster_col or key)
        return
    kept = in_partitions(existing, df, parts).join(df.select(key), key, "left_anti")
    kept.unionByName(df).write.mode("overwrite").parquet(_staged(table_path))
    finish_upsert(spark, table_path, df.schema, parts, cluster_col or key)


def _staged(table_path: str) -> str:
    return f"{table_path}/_upsert"


def finish_upsert(spark: SparkSession, table_path: str, schema: T.StructType, partition_cols, cluster_col: str) -> bool:
    """Swap in the staged partitions of an upsert, also of one that died; staged rows that are incomplete go. True if swapped."""
    staged = _staged(table_path)
    fs, done = _folder(spark, f"{staged}/_SUCCESS")
    complete = fs.exists(done)
    folders = _partition_folders(spark, staged, _as_list(partition_cols)) if complete else []
    if folders:
        for folder in folders:
            _move_folder(spark, f"{staged}/{folder}", f"{table_path}/{folder}")
    elif complete:
        write_clustered(spark.read.schema(schema).parquet(staged), table_path, _as_list(partition_cols), cluster_col, dynamic=True)
    delete_path(spark, staged)
    return complete


def _partition_folders(spark: SparkSession, path: str, parts: list[str]) -> list[str]:
    """Paths, below ``path``, of the partitions that are stored there."""
    found = [""]
    for part in parts:
        found = [f"{above}{s.getPath().getName()}/" for above in found for s in _folder(spark, path)[0].listStatus(_folder(spark, f"{path}/{above}")[1])
                 if s.isDirectory() and s.getPath().getName().startswith(f"{part}=")]
    return sorted(f.rstrip("/") for f in found if f)


def _move_folder(spark: SparkSession, source: str, target: str) -> None:
    """``source`` takes the place of ``target``."""
    (fs, new), (_, old) = _folder(spark, source), _folder(spark, target)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


def replace_partitions(spark: SparkSession, df: DataFrame, table_path: str, partition_cols,
                       cluster_col: str) -> None:
    """Overwrite exactly the partitions present in ``df`` (complete new content
    for each of them), leaving all other partitions untouched. ``df`` must not
    read ``table_path`` itself (use ``upsert`` for that)."""
    write_clustered(df, table_path, _as_list(partition_cols), cluster_col, dynamic=True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a versioned table, oldest first."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    done = [n for n in names if n.startswith("v=") and fs.exists(
        spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n[2:]) for n in done)


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest complete version of a versioned table (no version: an empty frame)."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={versions[-1]}")


def write_version(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write ``df`` as a new version; the one before stays for readers, older ones go.

    A write that dies leaves no ``_SUCCESS`` and is never read."""
    versions = _versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/v={(versions[-1] if versions else 0) + 1}")
    for v in versions[:-1]:
        delete_path(spark, f"{path}/v={v}")


def replace_keys(spark: SparkSession, df: DataFrame, table_path: str, key: str) -> None:
    """Upsert ``df`` by ``key`` into a versioned table (one row per key): stored rows of other keys plus ``df``."""
    stored = read_version(spark, table_path, df.schema)
    write_version(spark, stored.join(df.select(key), key, "left_anti").unionByName(df), table_path)
