"""SimHash near-dedup with vantage-point trees.

1. A task hashes the word shingles of each whole text (XXH64) and counts, bit by
   bit, in how many hashes the bit is set; equal fingerprints become one row.
2. Two fingerprints that differ in at most RADIUS = 3 bits differ in at most one bit of
   one of their two halves. So each half gets a vantage-point forest for radius 1: a
   node has a vantage point v and a bound m, and sends fingerprints with distance d <= m to its
   inner and the others to its outer shard. By the triangle inequality a pair within the
   radius r is split only if one has m - r < d <= m and the other m < d <= m + r; these boundary
   shells go, as two sides, to a shard of their own as well, which is split on in the same way.
3. The driver grows the upper nodes on a bounded sample (``SAMPLE`` fingerprints, at most
   ``2 * SAMPLE``), which only decides how well shards are balanced: every fingerprint is routed,
   and the routing is exact for any tree. Where a half cannot be told apart any more, nodes measure the whole fingerprint
   (radius 3). Shards that are too large all the same are dealt into blocks by hash, and
   every pair of blocks is a shard.
4. Tasks grow the tree on inside their shard, and compare what is left in rows of small
   blocks on whole fingerprints. They return a spanning forest of the links that they
   found, never all pairs: inside a group of near copies each fingerprint gives a link or few.
5. Alternating star contraction joins the forests to components.

Defined results: null and empty texts, and texts without words, have fingerprint
zero, which links like any other. Fewer than ``size`` words make one shingle of the whole
sequence. Rows that repeat an id are members like any other. A null id takes part;
its component is the smallest id it reaches, null if all of them are null.
A very long text is hashed in pieces, so that a task holds a bounded number of hashes beside
the text and its words. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import one_row_per_doc
from .near_dedup import components
from .shingles import mix

RADIUS, SHINGLE, SEED = 3, 3, 42
#: The driver's sample for the upper nodes; fingerprints of a shard; of an indivisible shard's block; compared directly in a task.
SAMPLE, SHARD, BLOCK, DIRECT = 16_384, 8_192, 65_536, 768
_U = np.uint64
#: (bits that are measured, radius): a pair within RADIUS is within the radius of one of the first two.
HALVES = ((0x00000000FFFFFFFF, RADIUS // 2), (0xFFFFFFFF00000000, RADIUS // 2))
WHOLE = (0xFFFFFFFFFFFFFFFF, RADIUS)


#: The bits of every byte, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# ---- fingerprints -----------------------------------------------------------

def fingerprint(body: bytes, size: int = SHINGLE, seed: int = SEED, piece: int = 1 << 15) -> int:
    """The SimHash of a text's shingles, repeats included."""
    words = body.lower().split()      # bytes: splits at 0x20 and 0x09-0x0D, lower-cases A-Z
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for a in range(0, n, piece):
        b = min(a + piece, n)
        shingles = map(b" ".join, zip(*(words[a + j:b + j] for j in range(size))))
        hashes = np.fromiter(map(digest, shingles, itertools.repeat(seed)), np.uint64, b - a)
        lanes = hashes.view(np.uint8).reshape(-1, 8)
        votes += np.concatenate([np.bincount(lanes[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int, seed: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter((fingerprint(texts[i].as_buffer().to_pybytes(), size, seed) for i in range(batch.num_rows)),
                                np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return run


# ---- vantage-point trees ----------------------------------------------------

def distances(points: np.ndarray, vantage, bits: int) -> np.ndarray:
    return np.bitwise_count((points ^ _U(vantage)) & _U(bits))


def shells(points: np.ndarray, node):
    """(inner, outer, inner shell, outer shell): places of the points in a node's shards."""
    bits, radius, vantage, bound = node
    d = distances(points, vantage, bits).astype(np.int64)
    inner = d <= bound
    return (np.flatnonzero(x) for x in (inner, ~inner, inner & (d > bound - radius), ~inner & (d <= bound + radius)))


def parts(points: np.ndarray, a: np.ndarray, b: np.ndarray | None, node):
    """The (a, b) shards below a node, as places. Without ``b`` the pairs of a are wanted, else those between a and b."""
    ai, ao, a_in, a_out = (a[x] for x in shells(points[a], node))
    if b is None:
        return [(ai, None), (ao, None), (a_in, a_out)]
    bi, bo, b_in, b_out = (b[x] for x in shells(points[b], node))
    return [(ai, bi), (ao, bo), (a_in, b_out), (a_out, b_in)]


def split(points: np.ndarray, a: np.ndarray, b: np.ndarray | None, half, rng):
    """A node for the shard, on its half or else on whole fingerprints; None if none helps."""
    shard = points[a if b is None else np.concatenate([a, b])]
    return choose(shard, half, rng) or choose(shard, WHOLE, rng)


#: Work on n points of a shard grows about as this power of n (boundary shells are met again).
_POWER = 1.5


def choose(shard: np.ndarray, metric, rng, tries: int = 12):
    """The (bits, radius, vantage, bound) that leaves the least work, or None if none leaves less than there is."""
    bits, radius = metric
    look = shard if len(shard) <= 2048 else shard[rng.integers(0, len(shard), 2048)]
    best, least = None, 0.95 * len(look) ** _POWER
    bounds = np.arange(65)
    for vantage in look[rng.integers(0, len(look), tries)]:
        below = np.cumsum(np.bincount(distances(look, vantage, bits), minlength=65)).astype(float)
        inner, outer = below, len(look) - below
        shell = below[np.minimum(bounds + radius, 64)] - np.where(bounds >= radius, below[np.maximum(bounds - radius, 0)], 0)
        work = inner ** _POWER + outer ** _POWER + shell ** _POWER
        work[(inner == 0) | (outer == 0)] = np.inf
        at = int(np.argmin(work))
        if work[at] < least:
            best, least = (bits, radius, int(vantage), at), work[at]
    return best


def grow(sample: np.ndarray, half, scale: float, shard: int, block: int, seed: int = 5):
    """Upper nodes for one half, grown on the sample; one of its points stands for ``scale`` of the table.

    Returns nodes in a list: (node, numbers of its children) or (None, blocks of the shard)."""
    rng, nodes = np.random.default_rng(seed), []
    # a shard whose sample is small says little about balance, so it is not split further here
    enough = max(shard / max(scale, 1), 16)

    def build(a, b):
        at = len(nodes)
        nodes.append(None)
        size = len(a) + (0 if b is None else len(b))
        both = b is None or (len(a) and len(b))
        node = split(sample, a, b, half, rng) if size > enough and both else None
        if node is None:
            nodes[at] = (None, max(1, int(np.ceil(size * scale / block))))
        else:
            nodes[at] = (node, [build(*c) for c in parts(sample, a, b, node)])
        return at

    build(np.arange(len(sample)), None)
    return nodes


_SHARD = "shard string, side int, fp long"


def routed(points: np.ndarray, nodes):
    """(name of the shard, side, places of its points) for every shard that some of the points belong to."""
    todo = [(0, np.arange(len(points)), None)]
    while todo:
        at, a, b = todo.pop()
        node, below = nodes[at]
        if node is None:
            yield from _blocks(str(at), points, a, b, below)
        else:
            todo += [(n, x, y) for n, (x, y) in zip(below, parts(points, a, b, node)) if len(x) or (y is not None and len(y))]


def _blocks(name: str, points: np.ndarray, a: np.ndarray, b: np.ndarray | None, blocks: int):
    """One shard, or all pairs of its blocks. Side 2: pairs of its own; 0 and 1: pairs between the two."""
    own = mix(points) % _U(blocks)
    for i in range(blocks):
        left = a[own[a] == i]
        if b is None:
            yield f"{name}.{i}", 2, left
        for j in range(blocks):
            if b is not None:
                yield f"{name}.{i}.{j}", 0, left
                yield f"{name}.{i}.{j}", 1, b[own[b] == j]
            elif j != i:
                yield f"{name}.{min(i, j)}.{max(i, j)}", int(i > j), left


def _route(trees):
    def run(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            found = [(f"{t}.{shard}", side, which) for t, nodes in enumerate(trees)
                     for shard, side, which in routed(points, nodes) if len(which)]
            if not found:
                continue
            n = [len(which) for *_, which in found]
            names = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(found)), n), pa.array([x[0] for x in found]))
            yield pa.RecordBatch.from_arrays(
                [names.cast(pa.string()), pa.array(np.repeat([x[1] for x in found], n).astype(np.int32)),
                 pa.array(points[np.concatenate([x[2] for x in found])].view(np.int64))], ["shard", "side", "fp"])

    return run


# ---- inside a shard ---------------------------------------------------------

class Forest:
    """A spanning forest of the links seen so far, over places 0 to n - 1."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {}
        self.links: list[tuple[int, int]] = []

    def link(self, x: int, y: int) -> None:
        p, q = int(self.label[x]), int(self.label[y])
        if p == q:
            return
        own, other = self.members.pop(p, [p]), self.members.pop(q, [q])
        if len(own) < len(other):
            p, own, other = q, other, own
        self.label[other] = p
        own += other
        self.members[p] = own
        self.links.append((x, y))


def compare(points: np.ndarray, a: np.ndarray, b: np.ndarray | None, radius: int, forest: Forest, cells: int = 1 << 21) -> None:
    """Compare all pairs directly, a few rows against all; only links between different trees are kept."""
    rows = min(256, max(1, cells // max(1, len(a if b is None else b))))
    for at in range(0, len(a), rows):
        left = a[at:at + rows]
        right = a[at + 1:] if b is None else b
        if not len(right):
            return
        near = np.bitwise_count(points[left][:, None] ^ points[right][None, :]) <= radius
        if b is None:              # row i meets the places after it only
            near &= np.arange(len(right))[None, :] >= np.arange(len(left))[:, None]
        some = np.flatnonzero(near.any(axis=1))
        while len(some):
            near_some = near[some] & (forest.label[left[some]][:, None] != forest.label[right][None, :])
            hit = near_some.any(axis=1)
            some, first = some[hit], near_some[hit].argmax(axis=1)
            for i, j in zip(left[some], right[first]):
                forest.link(int(i), int(j))


def join(points: np.ndarray, a: np.ndarray, b: np.ndarray | None, half, radius: int, forest: Forest, rng, direct: int) -> None:
    """Link every pair within the radius (of the whole) that the half brings together: grow the tree on, then compare."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if b is not None and not (len(a) and len(b)):
            continue
        size = len(a) + (0 if b is None else len(b))
        node = split(points, a, b, half, rng) if size > direct else None
        if node is None:
            compare(points, a, b, radius, forest)
        else:
            todo += parts(points, a, b, node)


def shard_links(points: np.ndarray, side: np.ndarray, half, radius: int = RADIUS, direct: int = DIRECT) -> np.ndarray:
    """(x, y) places of a spanning forest of a shard's links. side: 2 pairs of its own, 0 and 1 pairs between them."""
    forest, rng = Forest(len(points)), np.random.default_rng(11)
    if (side == 2).any():
        join(points, np.flatnonzero(side == 2), None, half, radius, forest, rng, direct)
    else:
        join(points, np.flatnonzero(side == 0), np.flatnonzero(side == 1), half, radius, forest, rng, direct)
    return np.array(forest.links, np.int64).reshape(-1, 2)


def _links(direct: int):
    def run(key, rows):
        points = rows.column("fp").to_numpy().view(np.uint64)
        half = HALVES[int(key[0].as_py().split(".")[0])]
        found = shard_links(points, rows.column("side").to_numpy(), half, direct=direct)
        own = points.view(np.int64)
        return pa.table({"a": own[found[:, 0]], "b": own[found[:, 1]]})

    return run


def fingerprint_links(fps: DataFrame, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK, direct: int = DIRECT) -> DataFrame:
    """(a, b) links that connect every component of the distinct fingerprints ``fp`` under RADIUS."""
    n = fps.count()
    every = max(1, n // sample)
    looked = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).toArrow().column(0).to_numpy()
    looked = np.sort(looked).view(np.uint64)
    trees = [grow(looked, half, n / max(1, len(looked)), shard, block) for half in HALVES]
    routed = fps.select("fp").mapInArrow(_route(trees), _SHARD)
    return routed.groupBy("shard").applyInArrow(_links(direct), "a long, b long")


def simhash_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, seed: int = SEED,
                  **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    base = one_row_per_doc(docs, doc_id, text)
    marked = materialize(base.mapInArrow(_fingerprints(size, seed), "doc_id long, fp long"), "simhash")
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    links = materialize(fingerprint_links(fps, **limits), "simhash-links")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    if links.isEmpty():
        owned = fps.select("fp", F.col("first_id").alias("component_id"))
    else:
        roots = components(links)
        owned = fps.join(roots.select(F.col("cid").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        least = materialize(owned.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-least")
        owned = owned.join(least, "root").select("fp", "component_id")
    return marked.join(materialize(owned, "simhash-owned"), "fp").select("doc_id", hexed, "component_id")
