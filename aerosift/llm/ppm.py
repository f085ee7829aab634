"""Language-model scores by prediction by partial matching (PPM).

Training. Tasks count, over all whole training texts, every context of ``ORDER``
symbols with the symbol that follows (symbols are bytes, and an end after each
text), and every word. Counts are summed by a shuffle, so what is gathered
grows with the corpus. Keys travel in blocks: a row has many keys of one part, by
the context, and tasks add a part up at once; the number of parts grows with the
texts, so a part does not. Shorter contexts are sums of longer ones. Every counted
(context, symbol) pair, called a gram, stays in the written table and counts.

Probabilities (method C). A context with T occurrences and D different symbols
predicts a symbol seen c times with c / (T + D) and escapes with D / (T + D). After
an escape the next shorter context is asked with the symbols of the longer one
excluded from its counts; below order 0 all symbols not yet excluded are equally
likely. As a context's symbols are among those of its shorter contexts, all
exclusions depend on the last context only: E is what its symbols count in the
shorter one, whose T + D then is less by E.

Scoring. A symbol's probability depends on its gram only, so a document's score is
a sum over its grams. The at most ``PAIRS`` most frequent grams travel to the tasks
as the head; it saves work and changes no result. The documents' other grams go in blocks
to the parts of the counts, where their logs are looked up, and a block's sums come
back to its documents; this is done in ``SLICES`` slices of the parts whose sums are stored one after the other, so
the shuffle of a slice only is on disk. Grams that training has not seen are asked once
each, order by order: ``asked`` goes down to the first context that has the symbol, and
the logs come back up. These joins go by a pair or a context that at most
``SYMBOLS`` rows share on either side, but for the documents' own new grams, whose side can be split.

The base score is a smoothed unigram. Words that make up at least 1/``HEAD`` of the
training tokens (at most ``HEAD`` of them) travel to the tasks; all other words are
looked up by a join with the counts, so the base is exact for every word.

Defined results: a null text is empty: one end token. A null id is in no fold:
scored, not learned from, ``held_out`` null. Repeated rows count as often as they
occur and each gets its score. With no training text at all, symbols are equally likely and N and V
are 0. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, materialize, scratch_path, settings, shuffles_released
from .common import fold, one_row_per_doc, shuffle_partitions
from .shingles import mix, steps, words

ORDER, PAIRS, HEAD = 6, 1 << 20, 1 << 20
SYMBOLS, END = 257, 256
_BITS = 9
_PIECE = 256
#: Entries of the table of answers, a power of two.
_ASKED_BITS = 20
#: Slices of the grams that are looked up one after the other.
SLICES = 4
#: Bytes of text for each part of the keys; a part is added up and looked up at once.
_PART_BYTES = 1 << 22
#: Grams to look up that a task holds before it hands them on as blocks.
_ASKED = 1 << 18
#: Texts and blocks are long: rows that are decoded or sent to Python at a time.
_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.parquet.columnarReaderBatchSize": "512"}
#: Distinct keys a task adds up before it hands them on.
_HELD = 1 << 20
#: The end token's key among the word hashes.
END_WORD = np.uint64(0x5BD1E9955BD1E995)
_GRAM, _WORD = 0, 1


def symbols_of(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, starts): each text after ``ORDER`` end symbols and followed by one.

    Text i's own symbols (its bytes and its end) are symbols[starts[i]:starts[i] + len + 1]."""
    lengths = np.array([len(b) for b in bodies], np.int64)
    starts = np.cumsum(np.concatenate([[0], lengths[:-1] + 1])) + ORDER if len(bodies) else np.zeros(0, np.int64)
    out = np.full(int(lengths.sum()) + len(bodies) + ORDER, END, np.int64)
    flat = np.frombuffer(b"".join(bodies), np.uint8)
    at = np.arange(len(flat)) + np.repeat(np.arange(len(bodies)), lengths) + ORDER
    out[at] = flat
    return out, starts


def grams_of(bodies: list[bytes]) -> np.ndarray:
    """A key for each symbol of each text: the ``ORDER`` symbols before it and itself.

    What comes before a text is end symbols, never the text before it."""
    symbols, starts = symbols_of(bodies)
    key = np.zeros(len(symbols) - ORDER, np.int64)
    for j in range(ORDER + 1):
        key = (key << _BITS) | symbols[j:len(symbols) - ORDER + j]
    # the first ORDER symbols of a text must not see the previous text
    for j in range(ORDER):
        at = starts - ORDER + j
        at = at[at < len(key)]
        inside = np.concatenate([starts[1:], [len(symbols)]])[:len(at)] - starts[:len(at)] > j
        fill = 0
        for _ in range(ORDER - j):
            fill = (fill << _BITS) | END
        low = (1 << (_BITS * (j + 1))) - 1
        key[at[inside]] = (key[at[inside]] & low) | (fill << (_BITS * (j + 1)))
    return key


class Counter:
    """Keys and counts, kept sorted and merged when many have come in."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        u, n = np.unique(keys, return_counts=True)
        self.parts.append((u, n))
        self.size += len(u)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(counts, first)

    def full(self) -> bool:
        if self.size < 3 * _HELD // 2:
            return False
        self.parts = [self.merged()]
        self.size = len(self.parts[0][0])
        return self.size >= _HELD

    def batches(self, kind: int, parts: int):
        if not self.parts:
            return
        keys, counts = self.merged()
        self.parts, self.size = [], 0
        if len(keys):
            part, bounds, order = dealt(keys, kind, parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), packed(keys[order], bounds),
                                              packed(counts[order], bounds)], ["kind", "part", "keys", "counts"])


def dealt(keys: np.ndarray, kind: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, bounds, order): keys[order][bounds[i]:bounds[i + 1]] are those of part[i], in the order they had.

    Grams of the same context are in the same part."""
    own = (keys >> _BITS if kind == _GRAM else keys).astype(np.uint64)
    of = (mix(own) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(of.astype(np.uint16) if parts <= 1 << 16 else of, kind="stable")
    of = of[order]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    return of[first], np.concatenate([first, [len(of)]]), order


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Row i has the bytes of values[bounds[i]:bounds[i + 1]]."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column, kind) -> np.ndarray:
    """The values of all rows, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _counter(parts: int):
    def count(batches):
        held = {_GRAM: Counter(), _WORD: Counter()}
        for batch in batches:
            bodies = batch.column(0).cast(pa.binary()).to_pylist()
            for a, b in steps([len(x) for x in bodies]):
                held[_GRAM].add(grams_of(bodies[a:b]))
                w = words(bodies[a:b])[1]
                held[_WORD].add(np.concatenate([w, np.full(b - a, END_WORD)]).astype(np.int64))
                for kind, c in held.items():
                    if c.full():
                        yield from c.batches(kind, parts)
        for kind, c in held.items():
            yield from c.batches(kind, parts)
    return count


def _totals(group, table):
    """A part's blocks as counts, with the totals of each context."""
    kind, part = (x.as_py() for x in group)
    held = Counter()
    held.parts = [(unpacked(table["keys"], np.int64), unpacked(table["counts"], np.int64))]
    keys, n = held.merged()
    own = keys >> _BITS if kind == _GRAM else keys
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    d = np.diff(np.concatenate([first, [len(own)]]))
    return pa.table({"kind": pa.array(np.full(len(keys), kind, np.int32)), "part": pa.array(np.full(len(keys), part, np.int32)),
                     "key": keys, "n": n, "t": np.repeat(np.add.reduceat(n, first), d), "d": np.repeat(d, d)})


def corpus_counts(texts: DataFrame, parts: int) -> DataFrame:
    """(kind, part, key, n, t, d): grams and words of all rows of ``texts`` (one column, text).

    t, d: all occurrences and all different symbols of a gram's context. One shuffle, by the part, serves both."""
    blocks = texts.mapInArrow(_counter(parts), "kind int, part int, keys binary, counts binary")
    return blocks.groupBy("kind", "part").applyInArrow(_totals, "kind int, part int, key long, n long, t long, d long")


def context(key: Column) -> Column:
    return F.shiftright(key, _BITS)


def shorter(key: Column, k: int) -> Column:
    """The pair of order ``k`` that a longer pair's key ends with."""
    return key.bitwiseAND((1 << (_BITS * (k + 1))) - 1)


def head_grams(grams: DataFrame) -> pa.Table:
    """(key, log) of the most frequent grams, whole classes of counts, ``PAIRS`` grams at most."""
    level = F.floor(4 * F.log2(F.col("n").cast("double")))
    least, held = 1 << 10, 0
    for r in sorted(grams.groupBy(level.alias("level")).count().collect(), reverse=True):      # at most 256 rows
        held += r["count"]
        if held > PAIRS:
            break
        least = r["level"]
    return grams.where(level >= least).select("key", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("log")).toArrow()


def asked(keys: DataFrame, pairs: DataFrame, below: DataFrame | None, k: int) -> DataFrame:
    """(key, n, t, d, e): each pair of order ``k`` in ``keys`` (distinct) with its count and its context's totals.

    ``below`` has the pairs of the next shorter order. What training has not seen is null."""
    wanted = keys.select(context(F.col("key")).alias("ctx")).distinct()
    own = pairs.withColumn("ctx", context(F.col("key"))).join(wanted, "ctx", "left_semi")
    if below is None:
        own = own.withColumn("m", F.lit(1))
    else:
        own = own.withColumn("short", shorter(F.col("key"), k - 1)).join(
            below.select(F.col("key").alias("short"), F.col("n").alias("m")), "short")
    # a context has at most SYMBOLS pairs
    nodes = own.groupBy("ctx").agg(F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("m").alias("e"),
                                   F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("has"))
    return keys.withColumn("ctx", context(F.col("key"))).join(nodes, "ctx", "left").select(
        "key", F.try_element_at("has", "key").alias("n"), "t", "d", "e")


def unseen_logs(keys: DataFrame, grams: DataFrame) -> DataFrame:
    """(key, log) of distinct grams that training has not seen.

    A pair's probability, asked after a longer context with exclusion E, is 10^part / (total - E)."""
    spark, paths = grams.sparkSession, {}
    pairs = {ORDER: grams.select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        paths[k] = scratch_path(spark, "ppm-pairs")
        pairs[k + 1].groupBy(shorter(F.col("key"), k).alias("key")).agg(F.sum("n").alias("n")).write.parquet(paths[k])
        pairs[k] = spark.read.schema(pairs[ORDER].schema).parquet(paths[k])
    found = {}
    for k in range(ORDER, -1, -1):
        found[k] = materialize(asked(keys, pairs[k], pairs.get(k - 1), k), "ppm-asked")
        keys = found[k].where("n IS NULL").select(shorter(F.col("key"), k - 1).alias("key")).distinct()
    for path in paths.values():
        delete_path(spark, path)
    below = None
    for k in range(ORDER + 1):
        own = found[k]
        if below is None:
            own = own.withColumns({"low_part": F.lit(0.0), "low_total": F.lit(SYMBOLS)})
        else:
            own = own.withColumn("short", shorter(F.col("key"), k - 1)).join(below, "short", "left")
        part = F.when(F.col("t").isNull(), F.col("low_part")).when(F.col("n").isNotNull(), F.log10("n")).otherwise(
            F.log10("d") + F.col("low_part") - F.log10(F.col("low_total") - F.col("e")))
        total = F.when(F.col("t").isNull(), F.col("low_total")).otherwise(F.col("t") + F.col("d"))
        logs = own.select("key", part.alias("part"), total.alias("total"))
        below = logs.select(F.col("key").alias("short"), F.col("part").alias("low_part"), F.col("total").alias("low_total"))
    return materialize(logs.select("key", (F.col("part") - F.log10("total")).alias("log")), "ppm-new")


class Table:
    """A hash table of keys that are not negative, and a log for each."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(1.4 * max(len(keys), 1)))))
        self.shift, self.keys, self.logs = np.uint64(64 - bits), np.full(1 << bits, -1), np.zeros(1 << bits)
        slot = self._slot(keys)
        while len(keys):
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.keys[slot] < 0)
            self.keys[slot[put]], self.logs[slot[put]] = keys[put], logs[put]
            keys, logs, slot = keys[~put], logs[~put], (slot[~put] + 1) & ((1 << bits) - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, slot, -1)
        look = np.flatnonzero((seen != keys) & (seen >= 0))
        slot = slot[look]
        while len(look):
            slot = (slot + 1) & (len(self.keys) - 1)
            seen = self.keys[slot]
            hit = seen == keys[look]
            out[look[hit]] = slot[hit]
            go = ~hit & (seen >= 0)
            look, slot = look[go], slot[go]
        return out


def times_of(doc: np.ndarray, key: np.ndarray, docs: int) -> pa.ListArray:
    """For each document its different keys and how often it has each."""
    by = np.lexsort((key, doc))
    doc, key = doc[by], key[by]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([new, [len(doc)]]))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
        [pa.array(key[new]), pa.array(times.astype(np.int32))], ["key", "times"]))


class Trie:
    """The same model in memory, for counts that fit; the operator is tested against it.

    Nodes with their escapes, and a hash table of (node, symbol) -> log count and next node."""

    def __init__(self, pairs: pa.Table, nodes: pa.Table):
        k, key, n = (pairs.column(c).to_numpy() for c in ("k", "key", "n"))
        nk, ctx, t, d = (nodes.column(c).to_numpy() for c in ("k", "ctx", "t", "d"))
        if not len(nk):
            nk, ctx, t, d = np.zeros(1, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        order = np.lexsort((ctx, nk))
        nk, ctx, t, d = nk[order], ctx[order], t[order].astype(np.float64), d[order].astype(np.float64)
        first = np.searchsorted(nk, np.arange(ORDER + 2))

        def node(o, c):
            """Number of the node of order ``o`` and context ``c``, or -1."""
            own = ctx[first[o]:first[o + 1]]
            if not len(own):
                return np.full(len(c), -1)
            at = np.minimum(np.searchsorted(own, c), len(own) - 1)
            return np.where(own[at] == c, first[o] + at, -1)

        size = len(nk)
        self.suffix = np.zeros(size, np.int32)
        for o in range(2, ORDER + 1):
            rows = slice(first[o], first[o + 1])
            self.suffix[rows] = node(o - 1, ctx[rows] & ((1 << (_BITS * (o - 1))) - 1))
        # the node and the counts of each pair
        order = np.lexsort((key, k))
        k, key, n = k[order], key[order], n[order].astype(np.float64)
        owner = np.zeros(len(k), np.int64)
        for o in range(1, ORDER + 1):
            owner[k == o] = node(o, key[k == o] >> _BITS)
        symbol = key & (2**_BITS - 1)
        code = owner * SYMBOLS + symbol
        kept = np.bincount(owner, weights=n, minlength=size)
        # occurrences of symbols that are not kept escape, as does one more for each different symbol
        leave = np.maximum(t - kept + d, 1)
        shorter = self.suffix[owner].astype(np.int64) * SYMBOLS + symbol
        by = np.argsort(code)
        spot = by[np.minimum(np.searchsorted(code[by], shorter), max(len(code) - 1, 0))] if len(code) else np.zeros(0, np.int64)
        excluded = np.bincount(owner, weights=np.where(owner > 0, n[spot], 0), minlength=size)
        total = kept + leave
        after = np.maximum(kept[self.suffix] - excluded, 0) + leave[self.suffix]
        self.total, self.escape = (-np.log10(total)).astype(np.float32), np.log10(leave / total).astype(np.float32)
        self.total_after = (-np.log10(after)).astype(np.float32)
        self.escape_after = np.log10(leave[self.suffix] / after).astype(np.float32)
        self.rest = -math.log10(max(SYMBOLS - int((owner == 0).sum()), 1))
        # next node: the context with the symbol if it is a node, else as from the shorter context
        moves = np.zeros(len(k), np.int32)
        for o in range(ORDER + 1):
            mine = np.flatnonzero(k == o)
            target = node(o + 1, key[mine]) if o < ORDER else np.full(len(mine), -1)
            back = moves[spot[mine]] if o else np.zeros(len(mine), np.int32)
            moves[mine] = np.where(target >= 0, target, back)
        self._fill(code.astype(np.uint64), np.log10(n).astype(np.float32), moves)

    def _fill(self, code, logs, moves) -> None:
        bits = max(4, int(np.ceil(np.log2(1.4 * max(len(code), 1)))))
        empty = np.uint64(2**64 - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, empty)
        self.logs, self.moves = np.zeros(1 << bits, np.float32), np.zeros(1 << bits, np.int32)
        slot, self.probes = self._slot(code), 0
        while len(code):
            self.probes += 1
            first = np.zeros(len(code), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.keys[slot] == empty)
            self.keys[slot[put]], self.logs[slot[put]], self.moves[slot[put]] = code[put], logs[put], moves[put]
            code, logs, moves, slot = code[~put], logs[~put], moves[~put], (slot[~put] + 1) & ((1 << bits) - 1)

    def _slot(self, code):
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, code: np.ndarray) -> np.ndarray:
        """Slot of each (node, symbol) code, or -1."""
        code = code.astype(np.uint64)
        slot = self._slot(code)
        seen = self.keys[slot]
        hit = seen == code
        look = np.flatnonzero(~hit & (seen != np.uint64(2**64 - 1)))
        out = np.where(hit, slot, -1)
        slot = slot[look]
        while len(look):
            slot = (slot + 1) & (len(self.keys) - 1)
            seen = self.keys[slot]
            hit = seen == code[look]
            out[look[hit]] = slot[hit]
            go = ~hit & (seen != np.uint64(2**64 - 1))
            look, slot = look[go], slot[go]
        return out

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, next node) of a symbol at each node; answers are remembered in a table of fixed size."""
        if not hasattr(self, "asked"):
            self.asked = np.full(1 << _ASKED_BITS, -1)
            self.answers, self.after = np.zeros(1 << _ASKED_BITS, np.float32), np.zeros(1 << _ASKED_BITS, np.int32)
        code = state * SYMBOLS + symbol
        slot = ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _ASKED_BITS)).astype(np.int64)
        log, nxt = self.answers[slot], self.after[slot].astype(np.int64)
        new = np.flatnonzero(self.asked[slot] != code)
        if len(new):
            log[new], nxt[new] = self.ask(state[new], symbol[new])
            self.asked[slot[new]], self.answers[slot[new]], self.after[slot[new]] = code[new], log[new], nxt[new]
            # of several new codes in one slot the last one was stored: make the three tables agree
            clash = new[self.asked[slot[new]] != code[new]]
            self.asked[slot[clash]] = -1
        return log, nxt

    def ask(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Walk down the shorter contexts until one has the symbol."""
        slot = self._find(state * SYMBOLS + symbol)
        log = np.where(slot >= 0, self.logs[slot] + self.total[state], self.escape[state]).astype(np.float64)
        nxt = np.where(slot >= 0, self.moves[slot], 0).astype(np.int64)
        miss = np.flatnonzero(slot < 0)
        last = state[miss]
        while len(miss):
            ended = last == 0                    # below order 0
            log[miss[ended]] += self.rest
            miss, last = miss[~ended], last[~ended]
            if not len(miss):
                break
            at = self.suffix[last].astype(np.int64)
            slot = self._find(at * SYMBOLS + symbol[miss])
            hit = slot >= 0
            log[miss] += np.where(hit, self.logs[slot] + self.total_after[last], self.escape_after[last])
            nxt[miss[hit]] = self.moves[slot[hit]]
            miss, last = miss[~hit], at[~hit]
        return log, nxt

    def score(self, bodies: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included."""
        if not bodies:
            return np.zeros(0)
        symbols, starts = symbols_of(bodies)
        lengths = np.array([len(b) + 1 for b in bodies], np.int64)
        pieces = -(-lengths // _PIECE)
        doc = np.repeat(np.arange(len(bodies)), pieces)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[doc] + within * _PIECE
        size = np.minimum(lengths[doc] - within * _PIECE, _PIECE)
        order = np.argsort(-size, kind="stable")
        doc, begin, size, within = doc[order], begin[order], size[order], within[order]
        state = np.zeros(len(doc), np.int64)
        for j in range(ORDER):                # replay the symbols before the piece
            before = np.where(within > 0, symbols[begin - ORDER + j], END)
            state = self.step(state, before)[1]
        total = np.zeros(len(doc))
        active = np.searchsorted(-size, -np.arange(size[0]), "left")      # pieces longer than t
        for t in range(int(size[0])):
            a = active[t]
            log, state[:a] = self.step(state[:a], symbols[begin[:a] + t])
            total[:a] += log
        return np.bincount(doc, weights=total, minlength=len(bodies))


class Asked:
    """Grams to look up, held until there are many, then dealt out as blocks."""

    def __init__(self, parts: int):
        self.dealt_to, self.held, self.size = parts, [], 0

    def add(self, rows: np.ndarray, keys: np.ndarray) -> None:
        self.held.append((rows, keys))
        self.size += len(keys)

    def blocks(self) -> dict[str, pa.Array]:
        """A row for each part: each document's different grams, how often it has them, and its number after ``first``."""
        rows, keys = (np.concatenate([x[i] for x in self.held]) for i in (0, 1))
        self.held, self.size = [], 0
        first = rows[0]
        by = np.argsort(keys, kind="stable")      # rows ascend, so they do within a key
        rows, keys = rows[by], keys[by]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])]))
        times = np.diff(np.concatenate([new, [len(keys)]])).astype(np.int32)
        rows, keys = (rows[new] - first).astype(np.int32), keys[new]
        part, bounds, order = dealt(keys, _GRAM, self.dealt_to)
        return {"part": pa.array(part), "first": pa.array(np.full(len(part), first, np.int64)), "keys": packed(keys[order], bounds),
                "rows": packed(rows[order], bounds), "times": packed(times[order], bounds)}


def _sums(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, ascending, and the sum of each one's weights."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, weights.dtype)


_FOUND = "first long, rows binary, sums binary, new_rows binary, new_keys binary, new_times binary"


def _look_up(blocks, model):
    """Of each block of a part the sums by document, and the grams that the model does not have."""
    keys, rows, times = (unpacked(blocks[c], t) for c, t in (("keys", np.int64), ("rows", np.int32), ("times", np.int32)))
    sizes = pc.binary_length(blocks["keys"]).to_numpy().astype(np.int64) // 8
    known, logs = model["key"].to_numpy(), model["log"].to_numpy()
    order = np.argsort(known)
    known, logs = known[order], logs[order]
    spot = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    hit = known[spot] == keys if len(known) else np.zeros(len(keys), bool)
    block = np.repeat(np.arange(len(sizes)), sizes)
    codes, sums = _sums(block[hit] << 32 | rows[hit], times[hit] * logs[spot[hit]] if len(known) else np.zeros(0))
    at = np.arange(len(sizes) + 1)
    bounds, new = np.searchsorted(codes >> 32, at), np.searchsorted(block[~hit], at)
    return pa.table({"first": blocks["first"], "rows": packed((codes & 0xFFFFFFFF).astype(np.int32), bounds), "sums": packed(sums, bounds),
                     "new_rows": packed(rows[~hit], new), "new_keys": packed(keys[~hit], new), "new_times": packed(times[~hit], new)})


def _add_up(found):
    """(row, key, value) of the documents from ``first`` on: key null: a sum of logs; else a gram that the model does not have, and how often."""
    first = found["first"][0].as_py()
    rows, sums = _sums(unpacked(found["rows"], np.int32), unpacked(found["sums"], np.float64))
    new = unpacked(found["new_rows"], np.int32)
    return pa.table({"row": np.concatenate([rows, new]).astype(np.int64) + first,
                     "key": pa.chunked_array([pa.nulls(len(rows), pa.int64()), pa.array(unpacked(found["new_keys"], np.int64))]),
                     "value": np.concatenate([sums, unpacked(found["new_times"], np.int32)])})


_SCORED = ("row long, doc_id long, n_tokens long, in_head long, head_sum double, gram_sum double, rare array<struct<key: long, times: int>>, "
           "part int, first long, keys binary, rows binary, times binary")
_SCORED_ARROW = {"row": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "in_head": pa.int64(), "head_sum": pa.float64(),
                 "gram_sum": pa.float64(), "rare": pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int32())])),
                 "part": pa.int32(), "first": pa.int64(), "keys": pa.binary(), "rows": pa.binary(), "times": pa.binary()}


def filled(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """These columns of ``_SCORED``, the others null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in _SCORED_ARROW.items()], list(_SCORED_ARROW))


def gram_sums(blocks: DataFrame, model: DataFrame) -> DataFrame:
    """(row, key, value) as of ``_add_up``: the blocks' grams looked up in ``model``, stored for each of ``SLICES`` slices of the parts."""
    sums = None
    for s in range(SLICES):
        mine = F.col("part") % SLICES == s
        found = blocks.where(mine).groupBy("part").cogroup(model.where(mine).groupBy("part")).applyInArrow(_look_up, _FOUND)
        found = materialize(found.groupBy("first").applyInArrow(_add_up, "row long, key long, value double"), "ppm-sums")
        sums = found if sums is None else sums.unionByName(found)
    return sums


def ppm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Each step is stored, so its shuffle, the counts' above all, is deleted before the next one begins."""
    with shuffles_released(docs.sparkSession), settings(docs.sparkSession, _ROWS):
        return _scores(docs, doc_id, text)


def _scores(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    base = one_row_per_doc(docs, doc_id, text)
    learned = F.coalesce(fold(F.col("doc_id"), 5) != 1, F.lit(False))
    n_bytes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4 * shuffle_partitions(spark), n_bytes // _PART_BYTES)
    counts = materialize(corpus_counts(base.where(learned).select("text"), parts), "ppm-counts")
    grams = counts.where(F.col("kind") == _GRAM).select("part", "key", "n", "t", "d")
    known = counts.where(F.col("kind") == _WORD).select("key", "n")
    size = known.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, n_types = size["n"] or 0, size["v"]
    common = head_grams(grams)
    table = Table(common.column("key").to_numpy(), common.column("log").to_numpy())
    # at most HEAD words, by the share rule
    head = known.where(F.col("n") * HEAD >= n_train).toArrow()
    order = np.argsort(head.column("key").to_numpy())
    head_keys, head_counts = head.column("key").to_numpy()[order], head.column("n").to_numpy()[order]
    shared = spark.sparkContext.broadcast((table, head_keys, np.log10(head_counts + 0.5)))

    def score(batches):
        model, keys, logs = shared.value
        asked_for = Asked(parts)
        for batch in batches:
            rows = batch.column(2).to_numpy()
            bodies = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in steps([len(x) for x in bodies]):
                part = bodies[a:b]
                doc, w = words(part)
                doc = np.concatenate([doc, np.arange(b - a)])
                w = np.concatenate([w, np.full(b - a, END_WORD)]).astype(np.int64)
                spot = np.minimum(np.searchsorted(keys, w), max(len(keys) - 1, 0))
                hit = keys[spot] == w if len(keys) else np.zeros(len(w), bool)
                sums = np.bincount(doc[hit], weights=logs[spot[hit]], minlength=b - a).astype(float)
                in_head = np.bincount(doc[hit], minlength=b - a)
                g = grams_of(part)
                of = np.repeat(np.arange(b - a), [len(x) + 1 for x in part])
                at = model.find(g)
                quick = at >= 0
                gram_sum = np.bincount(of[quick], weights=model.logs[at[quick]], minlength=b - a).astype(float)
                asked_for.add(rows[a:b][of[~quick]], g[~quick])
                yield filled({"row": batch.column(2).slice(a, b - a), "doc_id": batch.column(0).slice(a, b - a),
                              "n_tokens": pa.array(np.bincount(doc, minlength=b - a).astype(np.int64)),
                              "in_head": pa.array(in_head.astype(np.int64)), "head_sum": pa.array(sums), "gram_sum": pa.array(gram_sum),
                              "rare": times_of(doc[~hit], w[~hit], b - a)})
                if asked_for.size >= _ASKED:
                    yield filled(asked_for.blocks())
        if asked_for.size:
            yield filled(asked_for.blocks())

    # one pass gives a row for each document, and rows without one that are blocks of grams to look up
    scored = materialize(base.withColumn("row", F.monotonically_increasing_id()).mapInArrow(score, _SCORED), "ppm-scored")
    blocks = scored.where("row IS NULL").select("part", "first", "keys", "rows", "times")
    scored = scored.where("row IS NOT NULL").select("row", "doc_id", "n_tokens", "in_head", "head_sum", "gram_sum", "rare")
    looked = scored.select("row", F.explode("rare").alias("w")).select("row", "w.key", "w.times").join(known, "key", "left")
    c = F.coalesce("n", F.lit(0))
    rare = looked.groupBy("row").agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_sum"),
                                     F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    sums = gram_sums(blocks, grams.select("part", "key", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("log")))
    # only texts that were not learned from have grams that training has not seen
    new = sums.where("key IS NOT NULL")
    logs = unseen_logs(materialize(new.select("key").distinct(), "ppm-unseen"), grams)
    left = sums.where("key IS NULL").select("row", "value").unionByName(
        new.join(logs, "key").select("row", (F.col("value") * F.col("log")).alias("value"))).groupBy("row").agg(F.sum("value").alias("left_sum"))
    floor = math.log10(n_train + 0.5 * (n_types + 1))
    return scored.drop("rare").join(rare, "row", "left").join(left, "row", "left").select(
        "doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens",
        (F.col("in_head") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("gram_sum") + F.coalesce("left_sum", F.lit(0.0))).alias("score"))
