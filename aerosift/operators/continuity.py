"""Previous row of the same key within a time reach, with the key's history cut into chunks.

A LAG over ``PARTITION BY aircraft ORDER BY ts`` puts an aircraft's whole
history into one task. Every consumer here uses the previous row only when it
is at most ``max_gap_s`` old, so the history can be cut into chunks of
``CHUNK_BUCKETS`` time buckets: rows of the last buckets within reach of a chunk's
end are copied into the next chunk (about 3 % more rows), one shuffle deals the
rows by (key, chunk), a real ``lag`` runs inside each chunk, and the copies are
dropped. The longest sort is one key's rows of one chunk.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import ntz_to_epoch

CHUNK_BUCKETS = 120     # of 30 s: one hour


def with_chunks(df: DataFrame, bucket: str, bucket_s: int, max_gap_s: int) -> DataFrame:
    """Add ``_chunk`` and ``_copy``; rows within reach of their chunk's end come twice.

    Rows without a bucket share the NULL chunk and are never copied."""
    k = max(1, math.ceil(max_gap_s / bucket_s))
    number = F.floor(ntz_to_epoch(bucket) / bucket_s).cast("long")
    chunk = F.floor(number / CHUNK_BUCKETS).cast("long")
    late = number % CHUNK_BUCKETS >= CHUNK_BUCKETS - k
    both = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(both).alias("_next")).withColumns(
        {"_chunk": chunk + F.col("_next"), "_copy": F.col("_next") == 1}).drop("_next")


def previous_in_chunk(df: DataFrame, key: str, bucket: str, ts: str, cols: list[str], prefix: str) -> DataFrame:
    """``lag`` of ``ts`` and ``cols`` inside (key, chunk); the copies go."""
    w = Window.partitionBy(key, "_chunk").orderBy(bucket)
    return df.withColumns({prefix + c: F.lag(c).over(w) for c in [ts, *cols]}).where("NOT _copy").drop("_chunk", "_copy")


def attach_previous(df: DataFrame, key: str, bucket: str, ts: str, cols: list[str],
                    bucket_s: int = 30, max_gap_s: int = 120, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix+ts`` and ``prefix+c`` for c in cols: the true predecessor whenever it is within ``max_gap_s``.

    Precondition: at most one row per (key, bucket), as after the 30 s dedup."""
    dealt = with_chunks(df, bucket, bucket_s, max_gap_s).repartition(key, "_chunk")
    return previous_in_chunk(dealt, key, bucket, ts, cols, prefix).select(
        *df.columns, prefix + ts, *[prefix + c for c in cols])
