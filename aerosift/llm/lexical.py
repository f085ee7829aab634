"""Ranked lexical search over K2-treaps of the term-document grid.

1. Items are read as sets of terms and searched in blocks of about ``TERMS`` (item, term)
   pairs; only a block's terms and items are held by the driver and sent to tasks. One pass over the
   documents writes each document's length and its counts of the block's terms.
2. From these come the table-wide statistics: documents, terms, documents of each term.
3. Each task takes its documents in ranges (at most ``COLUMNS`` documents and about ``CELLS``
   counts) and builds a K2-treap of the range: a quadtree over the grid of terms (rows) and
   documents (columns) that keeps non-empty cells only. A leaf holds the impact of one term in one
   document, every inner cell the largest impact below it.
4. An item descends the treap along all of its rows together. A state is a block of columns with one node for
   each row; the weighted sum of the nodes' maxima bounds the score of every document in the block. States are
   opened best bound first, in batches that grow; a block that cannot beat the item's tenth result so
   far (which is kept from range to range) is dropped. A block of one document has its exact score.
5. Each task returns its ten best for each item; two rankings, the first one salted, keep the best of all.

All numbers of a score are integers, except for a logarithm that the driver takes once for each term.

Defined results: a null or empty text, of a document or an item, has no terms: the document is not counted
and the item has no rows. Rows that repeat a doc_id are documents of their own; rows that repeat an item_id
are one item with the terms of all. A null doc_id loses every tie; a null item_id is an item. Very long texts
are counted in pieces. One item is never divided, so its terms bound the driver's memory from below. No documents or no
items give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import UPPER, text_of

TOP = 10
#: (item, term) pairs of a block; documents and counts of a range; bytes that are split into words at once.
TERMS, COLUMNS, CELLS, PIECE = 500_000, 8_192, 1 << 20, 1 << 20
#: States opened at once: the batch doubles from the first to the second figure.
BATCH = (8, 1_024)
SALT = 16
#: Bytes of terms: digits, letters, and all of every character beyond ASCII. A-Z are lower-cased, others become a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LAST = 2**63 - 1


# ---- terms ------------------------------------------------------------------

def count_terms(body: bytes, piece: int = PIECE) -> tuple[int, Counter]:
    """(terms with repeats, count of each term) of a text, split a piece at a time."""
    folded, counts, n, at = body.translate(_FOLD), Counter(), 0, 0
    while at < len(folded):
        stop = folded.find(b" ", at + piece) if at + piece < len(folded) else -1
        stop = len(folded) if stop < 0 else stop
        terms = folded[at:stop].split()
        counts.update(terms)
        n, at = n + len(terms), stop
    return n, counts


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, term) pairs."""
    folded = F.translate(text_of(items, text), UPPER, UPPER.lower())
    terms = F.explode(F.array_distinct(F.regexp_extract_all(folded, F.lit(_TERM), F.lit(0))))
    return items.select(items[item_id].cast("long").alias("item"), terms.alias("term")).distinct()


_COUNTED = "doc long, n long, terms array<int>, counts array<int>"


def _count(vocabulary: dict[bytes, int]):
    """(doc, text) -> length and counts of the vocabulary's terms, for documents with any term."""
    def run(batches):
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = []
            for i, doc in enumerate(docs):
                n, counts = count_terms(texts[i].as_buffer().to_pybytes())
                if n:
                    known = [(vocabulary[t], k) for t, k in counts.items() if t in vocabulary]
                    rows.append((doc, n, [t for t, _ in known], [k for _, k in known]))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              *[pa.array(c, pa.list_(pa.int32())) for c in cols[2:]]], ["doc", "n", "terms", "counts"])

    return run


def _holders(width: int):
    """Counted documents -> (term, documents that hold it) of the task."""
    def run(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=width)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(counts: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's impact in a document, before its weight: saturating in its count, less for long documents."""
    m = 100 - 90 + 90 * length * n_docs // n_terms
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


# ---- the treap --------------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """Bit i of a 32-bit number to bit 2 * i."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


class Treap:
    """Non-empty cells of the grid, level by level: ``most[k]`` maxima and ``child[k]`` places at level k - 1.

    Level 0 has the cells themselves; a cell of level k covers 2**k rows and columns."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, ids: np.ndarray, height: int):
        self.height, self.ids = height, ids
        code = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(code, kind="stable")
        code = code[order]
        self.most, self.child, self.least = [values[order]], [None], [ids]
        for _ in range(height):
            up = code >> np.uint64(2)
            new = np.concatenate([[True], up[1:] != up[:-1]])
            first = np.flatnonzero(new)
            child = np.full((len(first), 4), -1, np.int32)
            child[np.cumsum(new) - 1, (code & np.uint64(3)).astype(np.int64)] = np.arange(len(code), dtype=np.int32)
            self.child.append(child)
            self.most.append(np.maximum.reduceat(self.most[-1], first))
            low = self.least[-1]
            self.least.append(np.minimum.reduceat(low, np.arange(0, len(low), 2)))
            code = up[first]

    def below(self, level: int, blocks: np.ndarray, nodes: np.ndarray, rows: np.ndarray):
        """Both halves of some column blocks: their numbers, and each row's node in them (-1: no cell)."""
        half = ((rows >> (level - 1)) & 1) * 2
        table = self.child[level]
        found = [np.where(nodes >= 0, table[nodes, half + side], -1) for side in (0, 1)]
        return np.concatenate([2 * blocks, 2 * blocks + 1]), np.concatenate(found)

    def bounds(self, level: int, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.where(nodes >= 0, self.most[level][nodes], 0) @ weights


class Best:
    """An item's best results so far: highest score first, then smallest id."""

    def __init__(self, top: int):
        self.top, self.score, self.doc = top, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.top]
        self.score, self.doc = score[order], doc[order]

    def beaten_by(self, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which (bound, smallest id) may still enter."""
        if len(self.score) < self.top:
            return score > 0
        return (score > self.score[-1]) | ((score == self.score[-1]) & (doc < self.doc[-1]))


def search(treap: Treap, rows: np.ndarray, weights: np.ndarray, best: Best, batch: tuple[int, int] = BATCH) -> None:
    """Descend along all rows of an item together, best bound first."""
    top = treap.height
    root = np.zeros((1, len(rows)), np.int32)
    # open states by level: (bounds, smallest ids, column blocks, nodes)
    open_ = {top: (treap.bounds(top, root, weights), treap.least[top][:1], np.zeros(1, np.int64), root)}
    size = batch[0]
    while open_:
        for level in list(open_):
            bound, least, blocks, nodes = open_.pop(level)
            stay = best.beaten_by(bound, least)
            if stay.any():
                open_[level] = (bound[stay], least[stay], blocks[stay], nodes[stay])
        if not open_:
            return
        held = np.concatenate([x[0] for x in open_.values()])
        cut = np.partition(held, len(held) - size)[len(held) - size] if len(held) > size else 0
        size = min(2 * size, batch[1])
        made = []
        for level in list(open_):
            bound, least, blocks, nodes = open_.pop(level)
            go = bound >= cut
            if not go.all():
                open_[level] = (bound[~go], least[~go], blocks[~go], nodes[~go])
            if not go.any():
                continue
            if level == 0:
                best.add(bound[go], least[go])
                continue
            blocks, nodes = treap.below(level, blocks[go], nodes[go], rows)
            some = (nodes >= 0).any(axis=1)
            blocks, nodes = blocks[some], nodes[some]
            made.append((level - 1, (treap.bounds(level - 1, nodes, weights), treap.least[level - 1][blocks], blocks, nodes)))
        for level, new in made:
            old = open_.get(level)
            open_[level] = new if old is None else tuple(np.concatenate(x) for x in zip(old, new))


# ---- the search -------------------------------------------------------------

def _ranges(batches, columns: int, cells: int):
    """Counted documents in ranges of bounded size: (ids, lengths, row of each count, its column, counts)."""
    held, n, size = [], 0, 0
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        at = 0
        while at < batch.num_rows:
            fits = min(columns - n, int(np.searchsorted(np.cumsum(sizes[at:]), cells - size, "right")) + 1, batch.num_rows - at)
            held.append(batch.slice(at, fits))
            n, size, at = n + fits, size + int(sizes[at:at + fits].sum()), at + fits
            if n >= columns or size >= cells:
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


_FOUND = "item int, doc long, score long"


def _search(weights: np.ndarray, items: list[np.ndarray], n_docs: int, n_terms: int, top: int, columns: int, cells: int):
    """Counted documents -> the task's best results of each item."""
    def run(batches):
        best = [Best(top) for _ in items]
        for part in _ranges(batches, columns, cells):
            part = part.combine_chunks().to_batches()[0]
            ids, length = part.column(0).to_numpy(), part.column(1).to_numpy()
            rows, counts = (part.column(i).flatten().to_numpy() for i in (2, 3))
            if not len(rows):
                continue
            # columns by length and id, so that blocks hold documents alike
            order = np.lexsort((ids, length))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            of = np.repeat(np.arange(len(ids)), part.column(2).value_lengths().to_numpy())
            values = impacts(counts.astype(np.int64), length[of], n_docs, n_terms)
            height = max(len(weights) - 1, len(ids) - 1).bit_length()
            treap = Treap(rows, place[of], values, ids[order], height)
            for i, terms in enumerate(items):
                search(treap, terms, weights[terms], best[i])
        n = [len(b.score) for b in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(items)), n).astype(np.int32)),
                                          pa.array(np.concatenate([b.doc for b in best])),
                                          pa.array(np.concatenate([b.score for b in best]))], ["item", "doc", "score"])

    return run


def _ranked(found: DataFrame, keys: list, top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def lexical_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", top: int = TOP, terms: int = TERMS, columns: int = COLUMNS, cells: int = CELLS) -> DataFrame:
    """Each item's ``top`` highest-scoring documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    pairs = materialize(item_terms(items, item_id, item_text), "search-items")
    blocks = max(1, math.ceil(pairs.count() / terms))
    base = docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(_LAST)).alias("doc"), text_of(docs, text).alias("text"))
    results = [_search_block(base, pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i), top, columns, cells)
               for i in range(blocks)]
    results = [r for r in results if r is not None]
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = results[0]
    for r in results[1:]:
        found = found.union(r)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"),
                        F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "score")


def _search_block(base: DataFrame, pairs: DataFrame, top: int, columns: int, cells: int) -> DataFrame | None:
    """(item_id, rank, doc, score) of the items of one block, whose pairs are few enough for the driver."""
    spark = base.sparkSession
    own = pairs.orderBy("item", "term").collect()
    if not own:
        return None
    numbers = {t: i for i, t in enumerate(sorted({r.term for r in own}))}
    wanted: dict = {}
    for r in own:
        wanted.setdefault(r.item, []).append(numbers[r.term])
    vocabulary = {t.encode(): i for t, i in numbers.items()}
    counted = materialize(base.mapInArrow(_count(vocabulary), _COUNTED), "search-counts")
    size = counted.agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_terms")).first()
    if not size.n_docs:
        return None
    df = np.zeros(len(numbers), np.int64)
    held = counted.select("terms").mapInArrow(_holders(len(numbers)), "term int, df long")
    for r in held.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weights = np.array([weight(size.n_docs, int(x)) for x in df], np.int64)
    run = _search(weights, [np.array(t, np.int64) for t in wanted.values()], size.n_docs, size.n_terms, top, columns, cells)
    found = counted.mapInArrow(run, _FOUND)
    best = _ranked(_ranked(found, ["item", F.pmod(F.xxhash64("doc"), F.lit(SALT))], top).drop("rank"), ["item"], top)
    names = spark.createDataFrame(list(enumerate(wanted)), "item int, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc", "score")
