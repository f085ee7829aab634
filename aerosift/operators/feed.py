"""Change feed of a raw table (SNK1, SRC7): every inserted slice is kept until all its readers have applied it.

The feed is a folder beside the raw table with one entry for each landed batch:

    <feed>/<batch key>/rows       the rows that the batch inserts (Parquet, complete with its _SUCCESS)
    <feed>/<batch key>/_merged    empty marker: the rows are in the raw table
    <feed>/<batch key>/_applied-<reader>    empty marker: a reader has applied them

``merge_to_feed`` writes the rows, appends them to the raw table and sets the marker, in this order. ``apply_feed`` hands the
rows of all entries that its reader has not applied to an idempotent function, and sets the markers afterwards.
A run that dies anywhere leaves an entry that the next run finishes: rows without a marker are appended as far as the raw table
lacks them, an update without a marker is applied again. Nothing depends on clocks or on how far back a run looks.

The driver lists entries, not rows; ``forget`` deletes those that all readers have applied.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_POSITIONS
from ..session import delete_path
from .sinks import EVENT_PARTITIONS, RAW_TABLE, _folder, in_partitions, new_rows, read_if_exists, write_clustered

_KEY = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, file = _folder(spark, path)
    return fs.exists(file)


def _mark(spark: SparkSession, path: str) -> None:
    fs, file = _folder(spark, path)
    fs.create(file, True).close()


def entries(spark: SparkSession, feed: str) -> list[str]:
    """Keys of the feed's entries, in order."""
    fs, folder = _folder(spark, feed)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()) if fs.exists(folder) else []


def _rows(spark: SparkSession, feed: str, key: str) -> DataFrame:
    return spark.read.schema(RAW_TABLE).parquet(f"{feed}/{key}/rows")


def merge_to_feed(spark: SparkSession, batch: DataFrame, table: str, feed: str, key: str) -> dict:
    """Insert-only merge of one landed batch under a key that orders batches (such as its landing time).

    The same key again is the same batch again: it finishes what is unfinished and inserts nothing twice."""
    if not _KEY.fullmatch(key):
        raise ValueError(f"a batch key is letters, digits, dots and hyphens: {key!r}")
    finish(spark, table, feed)                       # entries of runs that died come first
    batch = batch.select(*[F.col(f.name).cast(f.dataType) if f.name in batch.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_POSITIONS.fields])
    total = batch.count()
    if _exists(spark, f"{feed}/{key}/_merged"):
        stored = read_if_exists(spark, table, RAW_TABLE)
        if new_rows(batch, stored).isEmpty():
            return {"inserted": 0, "skipped": total, "total": total}
        raise ValueError(f"batch {key} was merged before with other rows")
    fresh = new_rows(batch, read_if_exists(spark, table, RAW_TABLE))
    fresh.write.mode("overwrite").parquet(f"{feed}/{key}/rows")
    _append(spark, table, feed, key, died=False)
    inserted = _rows(spark, feed, key).count()
    return {"inserted": inserted, "skipped": total - inserted, "total": total}


def _append(spark: SparkSession, table: str, feed: str, key: str, died: bool) -> None:
    """Entry -> raw table. After a death some of its files may be there already, so only absent ids are appended."""
    rows = _rows(spark, feed, key)
    stored = read_if_exists(spark, table, RAW_TABLE) if died else None
    if stored is not None:
        rows = rows.join(in_partitions(stored, rows, EVENT_PARTITIONS).select("id"), "id", "left_anti").select(*rows.columns)
    if not rows.isEmpty():
        write_clustered(rows, table, EVENT_PARTITIONS, "icao24", mode="append")
    _mark(spark, f"{feed}/{key}/_merged")


def finish(spark: SparkSession, table: str, feed: str) -> list[str]:
    """Finish the merges of runs that died. An entry whose rows are incomplete was not begun in the raw table: it goes."""
    done = []
    for key in entries(spark, feed):
        if _exists(spark, f"{feed}/{key}/_merged"):
            continue
        if _exists(spark, f"{feed}/{key}/rows/_SUCCESS"):
            _append(spark, table, feed, key, died=True)
            done.append(key)
        else:
            delete_path(spark, f"{feed}/{key}")
    return done


def pending(spark: SparkSession, feed: str, reader: str) -> list[str]:
    """Keys of merged entries that a reader has not applied."""
    return [k for k in entries(spark, feed) if _exists(spark, f"{feed}/{k}/_merged")
            and not _exists(spark, f"{feed}/{k}/_applied-{reader}")]


def read_feed(spark: SparkSession, feed: str, keys: Iterable[str]) -> DataFrame:
    """Inserted rows of some entries, with the entry's key as ``batch_key``."""
    paths = [f"{feed}/{k}/rows" for k in keys]
    if not paths:
        return spark.createDataFrame([], RAW_TABLE).withColumn("batch_key", F.lit(""))
    key = F.regexp_extract("_metadata.file_path", r"/([^/]+)/rows/[^/]+$", 1)
    return spark.read.schema(RAW_TABLE).parquet(*paths).withColumn("batch_key", key)


def apply_feed(spark: SparkSession, table: str, feed: str, reader: str, apply: Callable[[DataFrame], object]) -> list[str]:
    """Hand what a reader has not applied yet to ``apply`` (which must be idempotent), as one slice. Returns the keys."""
    finish(spark, table, feed)
    keys = pending(spark, feed, reader)
    lost = [k for k in keys if not _exists(spark, f"{feed}/{k}/rows/_SUCCESS")]
    if lost:
        raise ValueError(f"{reader} has not applied {lost}, whose rows are forgotten: rebuild it from the raw table")
    if keys:
        apply(read_feed(spark, feed, keys).drop("batch_key", *EVENT_PARTITIONS))
        for key in keys:
            _mark(spark, f"{feed}/{key}/_applied-{reader}")
    return keys


def forget(spark: SparkSession, feed: str, readers: Iterable[str]) -> list[str]:
    """Delete the rows of entries that every reader has applied; their markers stay, so a batch that lands again is known."""
    gone = []
    for key in entries(spark, feed):
        if _exists(spark, f"{feed}/{key}/rows") and all(_exists(spark, f"{feed}/{key}/_applied-{r}") for r in readers):
            delete_path(spark, f"{feed}/{key}/rows")
            gone.append(key)
    return gone
