"""Packing: optimal length buckets and token-budget batches.

1. One aggregation gives the global histogram of token counts. Its cells are
   a grid of at most 1/``GRID`` relative width (one length each below
   2 * GRID), so the histogram has a bounded number of rows for any corpus; a
   cell's length is the longest that occurs in it.
2. Dynamic programming over the whole histogram chooses ``buckets`` boundaries
   that minimise the padded tokens (every document is padded to its bucket's
   length) among cuts between cells. Documents are never cut: the last boundary is
   the longest length, and every boundary is a length that occurs.
3. Inside a bucket, documents get consecutive places. A place is the sum of the
   documents in earlier shards plus the place inside the shard; shards are
   hash-dealt and their number follows the row count, so a bucket with most of
   the corpus is spread over many tasks. ``budget // length`` neighbours form a batch.

Tokens are the white-space separated words plus one end token, or any column
the caller names. Defined results: a null or empty text has one token; equal
texts and repeated rows get a place each; a null doc_id is placed like any
other. A document longer than the budget is a batch of its own. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_RUN, SPACES, one_row_per_doc

BUCKETS, BUDGET, GRID = 12, 16_384, 64
#: Documents per shard, about.
SHARD_ROWS = 4_000


def token_count(text: Column) -> Column:
    body = F.btrim(text, F.lit(SPACES))
    return (F.when(body == "", 0).otherwise(F.size(F.split(body, SPACE_RUN))) + 1).cast("long")


def grid_length(n: Column, grid: int = GRID) -> Column:
    """Round up to a multiple of 2^k, where n has about log2(grid) + 1 leading bits left."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(n.cast("double") / grid)), F.lit(0))).cast("long")
    return (F.ceil(n / step) * step).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``lengths`` ascend; ``tokens`` are the true tokens per length. With the
    prefix sums C and T, a bucket (i, j] costs lengths[j] * (C[j] - C[i]) - (T[j] - T[i]).
    """
    m = len(lengths)
    if m == 0:
        return []
    c = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    t = np.concatenate([[0], np.cumsum(tokens)]).astype(np.float64)
    best, cut = np.full(m + 1, np.inf), []
    best[0] = 0.0
    for _ in range(min(buckets, m)):
        now, frm = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        now[0] = 0.0
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (t[j] - t[:j])
            frm[j] = int(np.argmin(cost))
            now[j] = cost[frm[j]]
        best = now
        cut.append(frm)
    bounds, j = [], m
    for frm in reversed(cut):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(frm[j])
    return bounds[::-1]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokens: str | None = None,
         buckets: int = BUCKETS, budget: int = BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, bucket_id, bucket_tokens, batch_id, batch_slot, n_padding."""
    if tokens is None:
        sized = one_row_per_doc(docs, doc_id, text).select("doc_id", token_count(F.col("text")).alias("n_tokens"))
    else:
        sized = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                            F.greatest(F.coalesce(docs[tokens].cast("long"), F.lit(1)), F.lit(1)).alias("n_tokens"))
    # the row number is stored, so that a retried task deals and orders rows as before
    sized = materialize(sized.withColumns({"length": grid_length(F.col("n_tokens")),
                                           "row": F.monotonically_increasing_id()}), "pack-lengths")
    hist = sized.groupBy("length").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"),
                                       F.max("n_tokens").alias("longest")).orderBy("length").collect()
    bounds = optimal_boundaries(np.array([r["longest"] for r in hist]), np.array([r["n"] for r in hist]),
                                np.array([r["t"] for r in hist]), buckets)
    n_shards = max(1, -(-sum(r["n"] for r in hist) // shard_rows))
    bucket = F.lit(None).cast("int")
    size = F.lit(None).cast("long")
    for k in range(len(bounds) - 1, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[k], k).otherwise(bucket)
        size = F.when(F.col("n_tokens") <= bounds[k], F.lit(bounds[k])).otherwise(size)
    placed = sized.select("doc_id", "n_tokens", "row", bucket.cast("int").alias("bucket_id"), size.cast("long").alias("bucket_tokens"),
                          F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard"))
    counts = placed.groupBy("bucket_id", "shard").agg(F.count("*").alias("rows"))
    # shards * buckets rows, dealt by bucket: one for every few thousand documents
    before = Window.partitionBy("bucket_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket_id", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket_id", "shard").orderBy("doc_id", "n_tokens", "row")
    place = F.col("offset") + F.col("rank") - 1
    capacity = F.greatest(F.floor(F.lit(budget) / F.col("bucket_tokens")), F.lit(1)).cast("long")
    ranked = placed.withColumn("rank", F.row_number().over(inside).cast("long"))
    return ranked.join(offsets, ["bucket_id", "shard"]).select(
        "doc_id", "n_tokens", "bucket_id", "bucket_tokens", F.floor(place / capacity).cast("long").alias("batch_id"),
        F.pmod(place, capacity).cast("int").alias("batch_slot"), (F.col("bucket_tokens") - F.col("n_tokens")).alias("n_padding"))
