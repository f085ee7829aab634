"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, residual bounds.

1. Components become integers, ``floor(256 * x)``. Vectors are range-partitioned
   and sorted by descending length and packed into blocks of ``BLOCK`` rows
   that know their largest length. Queries are packed into blocks too.
2. The d x d second moments of all vectors, summed from task partials, give a
   rotation (eigenvectors, which are the SVD's right singular vectors) that
   moves most of every inner product into the first coordinates.
3. Each query gets a first threshold, its k-th best score in the block of the
   longest vectors. By Cauchy-Schwarz a block whose largest length times the
   query's length is below that threshold cannot hold a result; such pairs of
   blocks are never formed.
4. Remaining pairs meet in an equi-join on a shard number: vectors are shuffled
   once, query blocks go to each shard. For a pair, partial sums over the first
   rotated coordinates plus the product of the residual lengths bound the score;
   only entries whose bound reaches the query's running threshold are computed
   exactly, in integers. Each shard returns its best k of each query, and a window picks the final k.

The result is exact: bounds carry a rounding margin, ties stay in play, and
final scores are integer sums.

Defined results: vectors that are null, or hold null or non-finite components,
take no part, nor do rows with a null id. Vectors of different sizes are
compared as if the shorter were padded with zeros. A query never meets rows
with its own id; rows repeated under another id are candidates of their own, and
rows repeated under one id count once (the best score). No other rows: no result rows. Further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import sum_rows

BLOCK, QUERY_BLOCK, SHARD_BLOCKS = 2048, 1024, 16
#: Share of the second moment that the first coordinates of the partial sum hold.
HEAD_ENERGY = 0.8
SCALE = 256


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v array<long>, norm) of the vectors that take part."""
    x = F.col("x")
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"),
                          vectors[embedding].cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(
            "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    v = F.transform("x", lambda c: F.floor(c * SCALE).cast("long"))
    return rows.select("vec_id", v.alias("v")).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))


def _matrix(column, dim: int) -> np.ndarray:
    """List column -> float64 rows, zero-padded to ``dim``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.astype(np.float64).reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = 0
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at:at + n]
        at += n
    return out


_BLOCK = "block long, top double, n int, ids binary, vecs binary"


def _pack(dim: int, rows: int):
    def block(seq, ids, vecs, norms):
        key = (TaskContext.get().partitionId() << 32) + seq
        return pa.RecordBatch.from_pydict({
            "block": pa.array([key], pa.int64()), "top": pa.array([float(norms.max())]), "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()), "vecs": pa.array([vecs.tobytes()], pa.binary())})

    def run(batches):
        held, seq, count = [], 0, 0
        for batch in batches:
            part = (batch.column(0).to_numpy(), _matrix(batch.column(1), dim), batch.column(2).to_numpy())
            for at in range(0, len(part[0]), rows):
                held.append(tuple(p[at:at + rows] for p in part))
                count += len(held[-1][0])
                while count >= rows:
                    ids, vecs, norms = (np.concatenate(p) for p in zip(*held))
                    yield block(seq, ids[:rows], vecs[:rows], norms[:rows])
                    held, count, seq = [(ids[rows:], vecs[rows:], norms[rows:])], count - rows, seq + 1
        if count:
            yield block(seq, *(np.concatenate(p) for p in zip(*held)))

    return run


def second_moments(rows: DataFrame, dim: int) -> np.ndarray:
    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column(0), dim)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
                                         ["i", "v"])

    sums = {r["i"]: r["v"] for r in sum_rows(rows.select("v").mapInArrow(moments, "i int, v array<double>")).collect()}  # dim rows
    return np.array([sums[i] for i in range(dim)]) if sums else np.eye(dim)


class Best:
    """Running best k of a block of queries: scores, ids, and the thresholds they give."""

    def __init__(self, query_ids: np.ndarray, k: int, floor: np.ndarray):
        self.query_ids, self.k, self.floor = query_ids, k, floor
        self.q = np.zeros(0, np.int64)
        self.v = np.zeros(0, np.int64)
        self.s = np.zeros(0, np.int64)

    def add(self, q, v, s) -> None:
        q, v, s = (np.concatenate(x) for x in ((self.q, q), (self.v, v), (self.s, s)))
        order = np.lexsort((-s, v, q))
        q, v, s = q[order], v[order], s[order]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])     # a repeated id counts once
        q, v, s = q[once], v[once], s[once]
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.q, self.v, self.s = q[keep], v[keep], s[keep]
        full = rank == self.k - 1
        np.maximum.at(self.floor, q[full], s[full])


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of integer vectors (as doubles) in 64-bit integers."""
    return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))


def _score_pair(best: Best, queries, rotated_q, vectors, ids, rotation, head: int) -> None:
    """Bound all entries of a pair of blocks, compute those that may count."""
    rq, rv = rotated_q, vectors @ rotation
    bound = rq[:, :head] @ rv[:, :head].T
    rest_q, rest_v = np.sqrt((rq[:, head:] ** 2).sum(1)), np.sqrt((rv[:, head:] ** 2).sum(1))
    bound += rest_q[:, None] * rest_v[None, :]
    margin = 1e-9 * np.sqrt((rq ** 2).sum(1)) * np.sqrt((rv ** 2).sum(1).max(initial=0)) + 1e-6
    may = bound >= (best.floor - margin)[:, None]
    may &= best.query_ids[:, None] != ids[None, :]
    q, v = np.nonzero(may)
    for at in range(0, len(q), 1 << 17):
        qs, vs = q[at:at + (1 << 17)], v[at:at + (1 << 17)]
        s = _exact(queries[qs], vectors[vs])
        may_count = s >= best.floor[qs]
        best.add(qs[may_count], ids[vs[may_count]], s[may_count])


def _first_thresholds(k: int, dim: int, seed_ids: bytes, seed: bytes, rotation, head: int):
    """Query blocks -> the same with thresholds (k-th best in the seed block) and the least length that matters."""
    ids, vectors = np.frombuffer(seed_ids, np.int64), np.frombuffer(seed, np.float64).reshape(-1, dim)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                queries = np.frombuffer(row["vecs"], np.float64).reshape(-1, dim)
                best = Best(np.frombuffer(row["ids"], np.int64), k, np.full(row["n"], -np.inf))
                _score_pair(best, queries, queries @ rotation, vectors, ids, rotation, head)
                norms = np.sqrt((queries ** 2).sum(1))
                reach = np.where(best.floor > 0, best.floor / np.maximum(norms, 1e-300), -np.inf)
                yield pa.RecordBatch.from_pydict({
                    "qblock": pa.array([row["block"]], pa.int64()), "qids": pa.array([row["ids"]], pa.binary()),
                    "qvecs": pa.array([row["vecs"]], pa.binary()), "floors": pa.array([best.floor.tobytes()], pa.binary()),
                    "least": pa.array([float(reach.min()) * (1 - 1e-9)])})

    return run


def _search(k: int, dim: int, rotation, head: int):
    """Pairs of blocks -> the best k of each query in this run of pairs."""
    def out(best):
        return pa.RecordBatch.from_arrays([pa.array(best.query_ids[best.q]), pa.array(best.v), pa.array(best.s)],
                                          ["query_id", "vec_id", "score"])

    def run(batches):
        now, best, queries, rotated = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column(0)[i].as_py()
                if key != now:
                    if best is not None:
                        yield out(best)
                    queries = np.frombuffer(batch.column(2)[i].as_buffer(), np.float64).reshape(-1, dim)
                    rotated = queries @ rotation
                    best = Best(np.frombuffer(batch.column(1)[i].as_py(), np.int64), k,
                                np.frombuffer(batch.column(3)[i].as_py(), np.float64).copy())
                    now = key
                vectors = np.frombuffer(batch.column(5)[i].as_py(), np.float64).reshape(-1, dim)
                _score_pair(best, queries, rotated, vectors, np.frombuffer(batch.column(4)[i].as_py(), np.int64), rotation, head)
        if best is not None:
            yield out(best)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of each query: query_id, rank, vec_id, score.

    ``is_query`` is a condition on a column ``vec_id``."""
    spark = vectors.sparkSession
    rows = materialize(integer_vectors(vectors, vec_id, embedding), "topk-vectors")
    size = rows.agg(F.max(F.size("v")).alias("dim"), F.count_if(is_query).alias("queries")).first()
    dim, n_queries = max(size["dim"] or 1, 1), size["queries"]
    values, basis = np.linalg.eigh(second_moments(rows, dim))
    rotation = np.ascontiguousarray(basis[:, ::-1])
    energy = np.cumsum(np.maximum(values[::-1], 0))
    head = min(dim, int(np.searchsorted(energy, HEAD_ENERGY * energy[-1])) + 1)

    by_length = rows.repartitionByRange(F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    blocks = materialize(by_length.mapInArrow(_pack(dim, BLOCK), _BLOCK), "topk-blocks")
    n_blocks = blocks.count()
    seed = blocks.orderBy(F.desc("top"), "block").first()            # one block of at most BLOCK vectors
    query_rows = rows.where(is_query).repartition(max(1, -(-n_queries // QUERY_BLOCK)), "vec_id").sortWithinPartitions("vec_id")
    packed = query_rows.mapInArrow(_pack(dim, QUERY_BLOCK), _BLOCK)
    seed_ids, seed_vecs = (bytes(seed["ids"]), bytes(seed["vecs"])) if seed else (b"", b"")
    queries = materialize(packed.mapInArrow(
        _first_thresholds(k, dim, seed_ids, seed_vecs, rotation, head),
        "qblock long, qids binary, qvecs binary, floors binary, least double"), "topk-queries")

    n_shards = max(1, -(-n_blocks // SHARD_BLOCKS))
    left = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    right = blocks.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(n_shards)).cast("int"))
    pairs = left.join(right, (left["shard"] == right["shard"]) & (right["top"] >= left["least"])).select(
        "qblock", "qids", "qvecs", "floors", "ids", "vecs")
    found = pairs.mapInArrow(_search(k, dim, rotation, head), "query_id long, vec_id long, score long")
    # a repeated id counts once, also across shards
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
