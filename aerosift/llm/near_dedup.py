"""MinHash near-dedup with odd sketches.

1. A task hashes each whole text to its set of distinct five-word shingles. ``BANDS * ROWS``
   MinHash samples give ``BANDS`` band keys. ``SAMPLES`` further samples, the least shingle of each of as many
   bins, give an odd sketch: a bitmap of ``BITS`` parities in which each sample flips the bit
   chosen by its value. The population count of the XOR of two sketches estimates high similarities closely.
2. Documents with equal sets form one class. Classes that share a band key are
   candidates. At similarity 0.75 a pair shares none of the 40 bands of 4 rows
   with probability 2.5e-7, at 0.8 with 6e-10.
3. First round: every class is compared with one class, the smallest that it meets as
   the smallest of a bucket. Second round: with the smallest classes of its other buckets that are
   not in its component yet. The odd sketch drops clear misses (more than five
   deviations beyond the threshold); every other pair is decided on its full shingle sets.
4. The first round's links give each class one smaller neighbour; pointer jumping
   makes them components. Later links join components by alternating star contraction. A group of
   thousands of near copies gives a pair or few for each member and is one component then.
5. Third round: the members of buckets that still hold several components meet in one task for each
   bucket, or, where their texts exceed ``BUCKET_BYTES``, one for each pair of the bucket's blocks. A pair that reaches
   the similarity shares one of the rarest quarter of either set's shingles (rarity as counted among the members), so
   members whose rarest quarter is found in no other component leave at once: those that share a common passage only. Among
   the others sizes and sketches rule pairs out, full sets decide, and only links that join two
   components are returned. Now every candidate link is verified or inside a component.

Every decision uses whole sets; sketches only rule pairs out.

Defined results: null and empty texts, and texts without words, have no
shingles, are linked with nothing and stay. Fewer than five words make one
shingle of the whole sequence. Rows that repeat an id are members like any other
(their texts may differ); a row stays if its id is the smallest of its
component. A component of null ids only has a null ``component_id`` and its rows
stay. A very long text is hashed as a whole inside one task (about 40 bytes of memory for
each of its bytes). An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import one_row_per_doc
from .shingles import mix, shingle_sets, steps

BANDS, ROWS, SAMPLES, BITS = 40, 4, 1024, 4096
#: Text that a task of the third round holds, for one block of a bucket.
BUCKET_BYTES = 24 << 20
SIMILARITY_PERCENT = 75
_MINIMA = BANDS * ROWS
_rng = np.random.default_rng(4242)
_MULTIPLY = _rng.integers(0, 2**32, _MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, _MINIMA, dtype=np.uint64).astype(np.uint32)
_SALT = _rng.integers(0, 2**63, _MINIMA, dtype=np.uint64)
_BAND_SALT = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)


def most_flips(n_a, n_b, percent: int, functions=np, deviations: float = 5.0):
    """Largest XOR population count of a pair of sets of these sizes that may reach the similarity.

    The union has at most (n_a + n_b) * 100 / (100 + percent) shingles, so that many bins or ``SAMPLES`` have a sample; those
    that differ are at most binomial, and each flips two random bits. ``functions``: numpy, or Spark's functions for columns."""
    miss = 1 - percent / 100
    union = (n_a + n_b) * (100 / (100 + percent))
    bins = np.minimum(union, SAMPLES) if functions is np else functions.least(union, functions.lit(float(SAMPLES)))
    differ = bins * miss + functions.sqrt(bins * (miss * (1 - miss))) * deviations
    expected = (functions.exp(differ * (-4 / BITS)) * -1 + 1) * (BITS / 2)
    return expected + functions.sqrt(expected / 2) * deviations + 1


def odd_sketches(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Odd sketches of non-empty sorted sets: the least hash of each bin flips one bit. One row of 64-bit words for each set."""
    n_sets = len(bounds) - 1
    mixed = mix(values ^ np.uint64(0x6A09E667F3BCC909))
    of = np.repeat(np.arange(n_sets), np.diff(bounds))
    cell = of * SAMPLES + (mixed >> np.uint64(64 - int(SAMPLES).bit_length() + 1)).astype(np.int64)
    order = np.lexsort((mixed, cell))
    cell, mixed = cell[order], mixed[order]
    least = np.concatenate([[True], cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, bool)
    at = (cell[least] // SAMPLES) * BITS + (mix(mixed[least]) & np.uint64(BITS - 1)).astype(np.int64)
    parity = (np.bincount(at, minlength=n_sets * BITS) & 1).astype(np.uint8).reshape(n_sets, BITS)
    return np.packbits(parity, axis=1).view(np.int64)


def sketch_batch(bodies: list[bytes]):
    """(n_shingles, set keys, band keys, odd sketches) of a batch of documents."""
    bounds, values = shingle_sets(bodies)
    sizes = np.diff(bounds)
    some = np.flatnonzero(sizes)
    keys = [hashlib.blake2b(values[bounds[i]:bounds[i + 1]].tobytes(), digest_size=16).digest() if sizes[i] else None
            for i in range(len(bodies))]
    samples = np.empty((_MINIMA, len(some)), np.uint32)
    low = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    for k in range(_MINIMA if len(some) else 0):
        samples[k] = np.minimum.reduceat(low * _MULTIPLY[k] + _ADD[k], bounds[some])
    wide = mix(samples.astype(np.uint64) ^ _SALT[:, None])
    grouped = wide.reshape(BANDS, ROWS, -1)
    band = _BAND_SALT[:, None] * np.ones(len(some), np.uint64)
    for r in range(ROWS):
        band = mix(band ^ grouped[:, r] * np.uint64(2 * r + 3))
    odd = odd_sketches(np.concatenate([[0], np.cumsum(sizes[some])]), values)
    return sizes, keys, some, band.T.astype(np.int64), odd


_SKETCH = "doc_id long, place long, n long, key binary, bands array<long>, odd array<long>"


def _sketch(batches):
    for batch in batches:
        bodies = batch.column(1).cast(pa.binary()).to_pylist()
        for a, b in steps([len(x) for x in bodies]):
            sizes, keys, some, band, odd = sketch_batch(bodies[a:b])
            has = np.zeros(b - a, bool)
            has[some] = True
            bands, odds = [None] * (b - a), [None] * (b - a)
            for at, i in enumerate(some):
                bands[i], odds[i] = band[at], odd[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(odds, pa.list_(pa.int64()))],
                ["doc_id", "place", "n", "key", "bands", "odd"])


def flips(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches, word by word (compiled, unlike a higher-order function)."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, BITS // 64)), F.bit_count(a[0].bitwiseXOR(b[0])))


def may_link(n_a: Column, n_b: Column, odd_a: Column, odd_b: Column, percent: int) -> Column:
    """Sizes and sketches that do not rule the pair out."""
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (flips(odd_a, odd_b) <= most_flips(n_a, n_b, percent, F))


def _decide(percent: int):
    """(a, b, text_a, text_b) -> the linked pairs, on full sets."""
    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = (batch.column(i).cast(pa.binary()) for i in (2, 3))
            last, keep = None, []
            own = None
            for i in range(len(a)):
                if a[i] != last:
                    last, own = a[i], shingle_sets([left[i].as_py()])[1]
                other = shingle_sets([right[i].as_py()])[1]
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()),
                                              pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) class pairs those whose full sets reach the similarity; ``texts``: cid, text."""
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        _decide(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(cid, root) for every class with a link: alternating large-star and small-star rounds.

    Each round is written and read again; a hub's edges are aggregated per task
    before they meet, and its join is left to adaptive skew handling."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the smaller side is written, so that the join of a hub's edges can be split
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select("v", "m").union(least.select("u", "m")).toDF("u", "v")
        edges = materialize(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("cid"), F.col("v").alias("root"))
        mark = now


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    # ``place`` finds a class's text again, whatever its id is
    base = one_row_per_doc(docs, doc_id, text).withColumn("place", F.xxhash64("text"))
    sketched = materialize(base.mapInArrow(_sketch, _SKETCH), "near-sketches")
    classes = sketched.where("n > 0").groupBy("key", "n", "bands", "odd").agg(
        F.min("doc_id").alias("rep_id"), F.min("place").alias("place"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "near-classes")

    rows = classes.select("cid", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.min("cid").alias("center"), F.count("*").alias("m")).where("m > 1")
    shared = materialize(shared, "near-shared")       # a written side leaves the hot buckets of the join to be split
    members = materialize(rows.join(shared, "bucket"), "near-buckets")
    # the texts of all candidate classes, fetched once for all rounds
    wanted = members.select("cid").distinct().join(classes.select("cid", "key", "place"), "cid")
    texts = _texts_of(base, wanted)
    about = classes.select("cid", "n", "odd")

    def likely(pairs):
        """Pairs that sizes and sketches do not rule out."""
        sides = [about.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("odd").alias(f"odd_{c}")) for c in "ab"]
        return pairs.join(sides[1], "b").join(sides[0], "a").where(
            may_link(F.col("n_a"), F.col("n_b"), F.col("odd_a"), F.col("odd_b"), percent)).select("a", "b")

    # first round: one pair for each class, with the smallest center of all its buckets
    stars = members.where("cid <> center").select(F.col("center").alias("a"), F.col("cid").alias("b"))
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = materialize(verified(likely(first), texts, percent), "near-links")
    roots = _forest_roots(links.select(F.col("b").alias("cid"), F.col("a").alias("root")))

    # second round: centers of other buckets that are not in the class's component yet
    side = {c: roots.select(F.col("cid").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"}
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    other = stars.join(side["a"], "a", "left").join(side["b"], "b", "left").where(apart).select("a", "b").distinct()
    roots = _grow(roots, verified(likely(other.join(first, ["a", "b"], "left_anti")), texts, percent))

    # third round: buckets that still hold several components; their centers were compared with all members
    rooted = members.where("m > 2").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    split = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    split = materialize(split.select("bucket"), "near-split")
    rest = rooted.where("cid <> center").join(split, "bucket", "left_semi").select("bucket", "cid", "root")
    roots = _grow(roots, _within_buckets(materialize(rest, "near-rest"), about, texts, percent))

    owned = classes.select("key", "cid", "rep_id").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = owned.groupBy("root").agg(F.min("rep_id").alias("component_id"))
    owned = owned.join(least, "root").select("key", "component_id")
    return sketched.select("doc_id", "n", "key").join(owned, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _within_buckets(rest: DataFrame, about: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components inside buckets; ``rest``: bucket, cid, root."""
    full = rest.join(texts, "cid").join(about.select("cid", "odd"), "cid")
    sizes = rest.join(texts.select("cid", F.octet_length("text").alias("size")), "cid").groupBy("bucket").agg(
        F.ceil(F.sum("size") / BUCKET_BYTES).cast("int").alias("blocks"))
    full = full.join(materialize(sizes, "near-blocks"), "bucket").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = full.select("bucket", "cid", "root", "odd", "text", "own", other)
    return pairs.groupBy("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")).applyInArrow(
        _bucket_links(percent), "a long, b long")


def prefixes(bounds: np.ndarray, number: np.ndarray, count: np.ndarray, percent: int) -> np.ndarray:
    """Which shingles are among the rarest of their set that a set must share one of to reach the similarity.

    number: each value's place among the distinct shingles; count: how many sets hold a distinct shingle."""
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((number, count[number], of))
    place = np.empty(len(number), np.int64)
    place[order] = np.arange(len(number)) - np.repeat(bounds[:-1], n)
    return place < (n + (-percent * n) // 100 + 1)[of]


def linked_members(bodies: list[bytes], root: np.ndarray, odd: np.ndarray, side: np.ndarray | None, percent: int, rows: int = 64):
    """(i, j) of members whose links join components: a spanning forest between the roots.

    ``side``: pairs between the sides 0 and 1 only; None: all pairs."""
    sets = [shingle_sets([body])[1] for body in bodies]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    values = np.concatenate(sets)
    distinct, number, count = np.unique(values, return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(sets)), np.diff(bounds))
    order = np.argsort(number, kind="stable")
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    across = np.minimum.reduceat(root[of[order]], first) < np.maximum.reduceat(root[of[order]], first)
    stays = np.zeros(len(sets), bool)
    stays[of[prefixes(bounds, number, count, percent) & across[number]]] = True
    alive = np.flatnonzero(stays)
    label, n, found = np.unique(root, return_inverse=True)[1], np.diff(bounds), []
    words = odd.view(np.uint64)
    for at in range(0, len(alive), rows):
        left = alive[at:at + rows]
        right = alive[at + 1:] if side is None else alive
        a, b = n[left][:, None], n[right][None, :]
        may = (label[left][:, None] != label[right][None, :]) & (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent)
        if side is not None:
            may &= (side[left] == 0)[:, None] & (side[right] == 1)[None, :]
        else:
            may &= np.arange(len(right))[None, :] >= np.arange(len(left))[:, None]
        for k in np.flatnonzero(may.any(axis=1)):
            i, js = left[k], right[may[k]]
            js = js[label[js] != label[i]]
            js = js[np.bitwise_count(words[js] ^ words[i]).sum(axis=1, dtype=np.int64) <= most_flips(n[i], n[js], percent)]
            if not len(js):
                continue
            held = np.zeros(len(distinct), bool)
            held[number[bounds[i]:bounds[i + 1]]] = True
            for j in js:
                both = int(held[number[bounds[j]:bounds[j + 1]]].sum())
                if label[j] != label[i] and 100 * both >= percent * (n[i] + n[j] - both):
                    found.append((i, j))
                    label[label == label[j]] = label[i]
    return found


def _bucket_links(percent: int):
    def run(key, rows):
        one, two = key[1].as_py(), key[2].as_py()
        side = None if one == two else (rows.column("own").to_numpy() != one).astype(int)
        bodies = rows.column("text").cast(pa.binary()).to_pylist()
        odd = np.array(rows.column("odd").to_pylist(), np.int64).reshape(len(bodies), -1)
        cid = rows.column("cid").to_numpy()
        found = np.array(linked_members(bodies, rows.column("root").to_numpy(), odd, side, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": cid[found].min(axis=1), "b": cid[found].max(axis=1)})

    return run


def _forest_roots(parents: DataFrame) -> DataFrame:
    """(cid, root) of a forest of (cid, root) rows, one smaller parent for each cid, by pointer jumping."""
    while True:
        up = parents.select(F.col("cid").alias("root"), F.col("root").alias("above"))
        jumped = parents.join(up, "root", "left").select("cid", F.coalesce("above", "root").alias("root"),
                                                         F.col("above").isNotNull().alias("moved"))
        jumped = materialize(jumped, "near-roots")
        parents = jumped.select("cid", "root")
        if jumped.where("moved").isEmpty():
            return parents


def _grow(roots: DataFrame, found: DataFrame) -> DataFrame:
    """Roots with the links (a, b) that a round found: components of the few edges between roots."""
    found = materialize(found, "near-links")
    if found.isEmpty():
        return roots
    side = {c: roots.select(F.col("cid").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"}
    edges = found.join(side["a"], "a", "left").join(side["b"], "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    merged = components(edges)
    moved = roots.join(merged.select(F.col("cid").alias("root"), F.col("root").alias("above")), "root", "left").select(
        "cid", F.coalesce("above", "root").alias("root"))
    return materialize(moved.union(merged), "near-roots")


def _texts_of(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, text): one text of each wanted class, joined by the hash of the text; its set's key confirms it."""
    def own(batches):
        for batch in batches:
            bodies = batch.column(2).cast(pa.binary()).to_pylist()
            keep = []
            for a, b in steps([len(x) for x in bodies]):
                bounds, values = shingle_sets(bodies[a:b])
                keep += [a + i for i in range(b - a) if hashlib.blake2b(
                    values[bounds[i]:bounds[i + 1]].tobytes(), digest_size=16).digest() == batch.column(1)[a + i].as_py()]
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2)], ["cid", "text"])

    found = base.select("place", "text").join(wanted, "place").select("cid", "key", "text")
    return materialize(found.mapInArrow(own, "cid long, text string").dropDuplicates(["cid"]), "near-texts")
