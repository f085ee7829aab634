"""Repeated-passage dedup: a depth-limited radix sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier
(in a smaller doc_id, or earlier in the same document). The strings are the
suffixes cut at that depth; sorted by most-significant digits, equal groups at
full depth are exactly the repeated strings, and a suffix that is alone in its
group after any digit can be dropped: it cannot be repeated.

First digit. Every string of ``LENGTH`` bytes holds ``LENGTH - DIGIT + 1`` strings of
``DIGIT`` bytes; the one with the smallest hash stands for it. Equal strings have
equal stand-ins at equal offsets, so strings can be told apart by their stand-in
first, and neighbouring strings of a text share one: a text has about 3 % as
many stand-ins as bytes. Stand-ins are range-partitioned and sorted by (hash of
the digit, hash of the whole stretch its strings cover, document, place), which
also spreads a digit that a third of all documents share over many partitions.
One pass over that order drops digits that occur once.

Equal stretches. Where digit and stretch are equal (two hashes of 64 bits), all strings are; everything but
the first occurrence goes, and only the first goes on to the next digits.

Further digits. Groups of one digit with several different stretches fetch the
stretches' bytes, put all their strings in a table and sort on, eight bytes at
a time, dropping what is alone, down to full depth. A group of more than ``GROUP`` stretches
is too large for one task's table: it takes another digit pass through the shuffle first. The digit is widened by as
many bytes as every string still holds on one of its sides (32, 66, 83, 92, ... 100), strings with room on the
right take the bytes there, the others those on the left, and the two parts of each stretch are
sorted like stand-ins: unique digits go, equal parts are decided at once, groups that are small now are sorted in
a table. A stretch is at most two rows in each pass, and at the last one digits are whole strings.

Defined results: null texts and texts shorter than ``LENGTH`` lose nothing. Rows that
repeat an id are ordered by their text's hash: a string in both counts as earlier in the one
that sorts first. Rows with equal id and equal text are one text: neither is earlier, and both lose
alike what repeats elsewhere or inside. A null id sorts last. A very long text is hashed
as a whole inside one task, which takes about 60 bytes of memory for each of its bytes. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import shuffle_partitions, text_of
from .shingles import mix, powers, steps

LENGTH, DIGIT = 100, 32
#: Stretches that one task sorts together; larger groups take further digit passes first.
GROUP = 512
_rng = np.random.default_rng(991)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_SEED = np.uint64(0x2545F4914F6CDD1D)


class Rolling:
    """Hashes of any substrings of a buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray):
        self.up, self.down = powers(len(buf))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * self.up[:len(buf)], dtype=np.uint64)])

    def all(self, length: int) -> np.ndarray:
        """The substring of ``length`` bytes at every place."""
        n = len(self.sums) - length
        return mix(((self.sums[length:] - self.sums[:-length]) * self.down[:n]) ^ _SEED)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix(((self.sums[stop] - self.sums[start]) * self.down[start]) ^ _SEED)


def stand_ins(bodies: list[bytes]):
    """(document number, first string, strings, place of the digit, digit hash, stretch hash) of each stand-in.

    Positions are inside the document; the strings of a stand-in start at first, first + 1, ..."""
    lengths = np.array([len(b) for b in bodies], np.int64)
    buf = np.frombuffer(b"".join(bodies), np.uint8)
    width = LENGTH - DIGIT + 1
    if len(buf) < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    rolling = Rolling(buf)
    digit = rolling.all(DIGIT)
    # sliding minimum by doubling
    low, have = digit, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    doc_start = np.cumsum(lengths) - lengths
    new = np.ones(len(low), bool)
    np.not_equal(low[1:], low[:-1], out=new[1:])
    new[doc_start[doc_start < len(low)]] = True
    start = np.flatnonzero(new)
    of = np.searchsorted(doc_start, start, "right") - 1
    # a run's strings: up to the next run, and as long as they end inside the text
    count = np.minimum(np.append(start[1:], len(low)), (doc_start + lengths)[of] - LENGTH + 1) - start
    keep = count > 0
    start, count = start[keep], count[keep]
    # the leftmost smallest digit of the first string is the place (equal digits may repeat inside a string)
    place = np.full(len(start), -1)
    for j in range(width):
        hit = (place < 0) & (digit[start + j] == low[start])
        place[hit] = start[hit] + j
    # a run whose place falls behind its later strings is cut, so that every string holds the place
    over = start + count - 1 > place
    while over.any():
        more = np.flatnonzero(over)
        first = place[more] + 1
        rest = start[more] + count[more] - first
        count[more] = first - start[more]
        start, count = np.concatenate([start, first]), np.concatenate([count, rest])
        nxt = np.full(len(first), -1)
        for j in range(width):
            hit = (nxt < 0) & (digit[np.minimum(first + j, len(digit) - 1)] == low[first])
            nxt[hit] = first[hit] + j
        place = np.concatenate([place, nxt])
        over = np.concatenate([np.zeros(len(over), bool), first + rest - 1 > nxt])
    order = np.argsort(start, kind="stable")
    start, count, place = start[order], count[order], place[order]
    d = np.searchsorted(doc_start, start, "right") - 1
    # the stretch is told apart by its bytes and by where the digit lies in it
    stretch = mix(rolling.of(start, start + count - 1 + LENGTH) ^ ((place - start) * 512 + count).astype(np.uint64))
    return d, start - doc_start[d], count, place - doc_start[d], low[start], stretch


def pack_place(first, n, lag):
    """First string, number of strings and the digit's offset in the first, in one number that sorts by first."""
    return (first << 14) | (n << 7) | lag


def unpack_place(pos):
    return pos >> 14, (pos >> 7) & 127, pos & 127


_STAND_INS = "digit long, stretch long, doc long, version long, pos long"
_ORDER = ["digit", "stretch", "doc", "version", "pos"]


def _emitted(batches):
    """Stand-ins of (doc, version, text) rows, a few texts at a time."""
    for batch in batches:
        bodies = batch.column(2).cast(pa.binary()).to_pylist()
        for a, b in steps([len(x) for x in bodies]):
            row, first, n, place, digit, stretch = stand_ins(bodies[a:b])
            doc, version = (batch.column(i).slice(a, b - a).take(pa.array(row)).to_numpy() for i in (0, 1))
            yield digit.astype(np.int64), stretch.astype(np.int64), doc, version, pack_place(first, n, place - first)


def _sampled(every: int):
    """A sample of the stand-ins, for bounds: one of ``every``."""
    def run(batches):
        for columns in _emitted(batches):
            keep = mix(columns[1].view(np.uint64) ^ columns[4].astype(np.uint64)) % np.uint64(every) == 0
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], _ORDER)

    return run


def _dealt(bounds: np.ndarray):
    """Stand-ins with the number of their range; ``bounds`` are sorted rows of ``_ORDER``."""
    digits, rows = bounds[:, 0], list(map(tuple, bounds.tolist()))

    def run(batches):
        for columns in _emitted(batches):
            low, high = np.searchsorted(digits, columns[0], "left"), np.searchsorted(digits, columns[0], "right")
            part = high.copy()
            for i in np.flatnonzero(low < high):      # the digit is a bound itself: compare the rest of the row
                part[i] = bisect.bisect_right(rows, tuple(int(c[i]) for c in columns), int(low[i]), int(high[i]))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(part.astype(np.int32))], [*_ORDER, "part"])

    return run


def _by_range(base: DataFrame, parts: int, rows: int) -> DataFrame:
    """Stand-ins of ``base``, partitioned by ranges of ``_ORDER`` and sorted.

    The bounds come from a sample of the texts (about 8 for each partition) and of their stand-ins, so that texts are hashed
    once; any bounds give the same result. A digit of many rows is several bounds, and so several partitions."""
    every = max(1, rows // (8 * parts))
    looked = base.where(F.pmod(F.xxhash64("doc", "version"), F.lit(every)) == 0)
    found = looked.mapInArrow(_sampled(8), _STAND_INS).toArrow()
    table = np.stack([found.column(c).to_numpy() for c in _ORDER], axis=1) if found.num_rows else np.zeros((0, len(_ORDER)), np.int64)
    table = table[np.lexsort(table.T[::-1])]
    bounds = table[np.linspace(0, len(table), parts + 1).astype(int)[1:-1]] if len(table) >= parts else table
    dealt = base.mapInArrow(_dealt(bounds), _STAND_INS + ", part int")
    return dealt.repartitionById(len(bounds) + 1, "part").drop("part").sortWithinPartitions(*_ORDER)


_MARKS = ", head boolean, alone boolean, opening boolean"


def _marked(batches):
    """Rows sorted by ``_ORDER`` -> rows of repeated digits with marks, in one pass.

    head: first of its (digit, stretch) in this partition. alone: the digit has this stretch only.
    opening: belongs to the partition's first (digit, stretch), which may begin in an earlier partition.
    The first and last digit may go on in a neighbour, so they are never alone and never dropped. Only one
    row is held back: the first of the current digit, until a second stretch or the digit's end shows."""
    held = start = None            # the row held back; the partition's first (digit, stretch)
    now = (None, None)             # digit and stretch of the last row
    more = open_ = False           # the current digit: has further rows; its first row is out already
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        digit, stretch = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if start is None:
            start = (digit[0], stretch[0])
        new = np.concatenate([[True], digit[1:] != digit[:-1]])
        head = new | np.concatenate([[True], stretch[1:] != stretch[:-1]])
        goes_on = held is None and now[0] == digit[0]
        if goes_on and now[1] == stretch[0]:
            head[0] = False
        run = np.cumsum(new) - 1
        size, heads = np.bincount(run), np.bincount(run, weights=head)
        outer = digit == start[0]
        known = (run == 0) & ((goes_on and open_) | (more and (goes_on or held is not None)))
        keep = (size[run] > 1) | outer | known
        alone = (heads[run] == 1) & ~outer & ~((run == 0) & goes_on & open_)
        tail = run == run[-1]
        begin = int(np.argmax(tail))
        was = bool(run[-1] == 0 and (goes_on or held is not None))
        out = bool((run[-1] == 0 and goes_on and open_) or heads[-1] > 1 or outer[-1])
        more = bool(size[-1] > 1 or (was and more))
        keep[tail] = True
        alone[tail] = False
        held = None
        if not out:                # one stretch so far: hold its first row back
            keep[begin] = False
            held = batch.slice(begin, 1)
        open_, now = out, (digit[-1], stretch[-1])
        opening = (digit == start[0]) & (stretch == start[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(head), pa.array(alone), pa.array(opening)],
                                         [*batch.schema.names, "head", "alone", "opening"]).filter(pa.array(keep))
    if held is not None:
        flags = [pa.array([x]) for x in (True, False, False)]
        yield pa.RecordBatch.from_arrays([*held.columns, *flags], [*held.schema.names, "head", "alone", "opening"])


def msd_groups(words: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the strings of ``depth`` bytes that start at ``at`` by digits of eight bytes.

    ``words[i]`` is the eight bytes from i on. Returns (row numbers, group numbers) of
    the strings that are not alone; equal group numbers are equal strings of one input group."""
    rows = np.arange(len(at))
    ids = group
    for step in [*range(0, depth - 8 + 1, 8), *([depth - 8] if depth % 8 else [])]:
        if not len(rows):
            break
        digit = words[at[rows] + step]
        order = np.lexsort((digit, ids))
        rows, ids, digit = rows[order], ids[order], digit[order]
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (digit[1:] != digit[:-1])])
        ids = np.cumsum(new) - 1
        together = np.bincount(ids)[ids] > 1
        rows, ids = rows[together], ids[together]
    return rows, ids


def _eight_bytes(buf: np.ndarray) -> np.ndarray:
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(buf), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j:j + len(buf)]
    return out


_SPANS = "doc long, version long, start int, stop int"


def _spans(doc, version, start, stop):
    return pa.RecordBatch.from_arrays([doc, version, pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
                                      ["doc", "version", "start", "stop"])


def _strings_of(pos: np.ndarray, bodies: list[bytes]):
    """All strings of some stretches: row, start in the document, digit's offset, place in the joined bytes, those bytes."""
    first, n, lag = unpack_place(pos)
    begin = np.cumsum([0] + [len(x) for x in bodies])[:-1]
    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, first[row] + offset, lag[row] - offset, begin[row] + offset, np.frombuffer(b"".join(bodies), np.uint8)


def _sort_groups(batches):
    """Rows (digit, doc, version, pos, body), whole digits together, in document order -> spans that go."""
    def flush(parts):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        row, start, lag, at, buf = _strings_of(rows.column(3).to_numpy(), rows.column(4).to_pylist())
        # strings can only be equal if their digits lie at the same offset in them
        group = np.unique(rows.column(0).to_numpy(), return_inverse=True)[1][row].astype(np.int64) * LENGTH + lag
        found, ids = msd_groups(_eight_bytes(buf), at, group, LENGTH)
        if not len(found):
            return
        # rows come in document order, so the smallest row number of a group is its first occurrence
        order = np.lexsort((found, ids))
        found, ids = found[order], ids[order]
        gone = np.sort(found[1:][ids[1:] == ids[:-1]])
        cut = np.concatenate([[True], (np.diff(gone) > 1) | (row[gone][1:] != row[gone][:-1])])
        first, last = gone[cut], gone[np.concatenate([cut[1:], [True]])]
        take = pa.array(row[first])
        yield _spans(rows.column(1).take(take), rows.column(2).take(take), start[first], start[last] + LENGTH)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if size > (4 << 20):       # sort what is complete: up to the next change of digit
            change = np.flatnonzero(batch.column(0).to_numpy() != held[-1].column(0)[held[-1].num_rows - 1].as_py())
            if len(change):
                yield from flush([*held, batch.slice(0, int(change[0]))])
                batch, held, size = batch.slice(int(change[0])), [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from flush(held)


def widths() -> list[int]:
    """Digit widths of the passes: each string holds the next digit on one side of the last."""
    out = [DIGIT]
    while out[-1] < LENGTH:
        out.append((LENGTH + 1 + out[-1]) // 2)
    return out


def wider(pos: np.ndarray, bodies: list[bytes], digit: np.ndarray, old: int, new: int):
    """The two parts of each stretch under a digit of ``new`` bytes instead of ``old``.

    Returns (row, digit, stretch, pos, begin, end): the part's bytes are bodies[row][begin:end]."""
    first, n, lag = unpack_place(pos)
    row, more = np.arange(len(pos)), new - old
    # string i has its digit at lag - i; strings with at most LENGTH - new bytes left of it have room on the right
    cut = np.clip(lag - (LENGTH - new), 0, n)
    parts = []
    for at, count, shift in ((np.zeros_like(cut), cut, more), (cut, n - cut, 0)):
        some = count > 0
        parts.append((row[some], at[some], count[some], (lag - at - shift)[some], np.full(int(some.sum()), shift > 0)))
    row, at, count, lag, left = (np.concatenate(x) for x in zip(*parts))
    start = np.cumsum([0] + [len(x) for x in bodies])[:-1][row] + at
    rolling = Rolling(np.frombuffer(b"".join(bodies), np.uint8))
    place = start + lag
    # the old digit is part of the key, so that groups only become finer
    key = mix(rolling.of(place, place + new) ^ mix(digit[row].view(np.uint64) ^ left.astype(np.uint64)))
    end = at + count - 1 + LENGTH
    stretch = mix(rolling.of(start, start - at + end) ^ (lag * 512 + count).astype(np.uint64))
    return row, key.view(np.int64), stretch.view(np.int64), pack_place(first[row] + at, count, lag), at, end


_BODY = ["digit", "doc", "version", "pos", "body"]
_WIDE = _STAND_INS + ", body binary"


def _widened(old: int, new: int):
    """Stretches of large groups with their bytes -> their parts under the wider digit."""
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bodies = batch.column(4).to_pylist()
            row, digit, stretch, pos, begin, end = wider(batch.column(3).to_numpy(), bodies, batch.column(0).to_numpy(), old, new)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digit), pa.array(stretch), batch.column(1).take(take), batch.column(2).take(take), pa.array(pos),
                 pa.array([bodies[r][a:b] for r, a, b in zip(row, begin, end)], pa.binary())], [*_ORDER, "body"])

    return run


def _bodies(batches):
    """(doc, version, text, wanted stretches) -> a row per stretch with its bytes."""
    names = ["digit", "doc", "version", "pos", "body"]
    for batch in batches:
        texts, out = batch.column(2), {c: [] for c in names}
        for i, (doc, version, wanted) in enumerate(zip(*(batch.column(j).to_pylist() for j in (0, 1, 3)))):
            text = texts[i].as_buffer().to_pybytes()
            for w in wanted:
                first, n, _ = unpack_place(w["pos"])
                for c, v in zip(names, (w["digit"], doc, version, w["pos"], text[first:first + n - 1 + LENGTH])):
                    out[c].append(v)
        yield pa.RecordBatch.from_arrays([*[pa.array(out[c], pa.int64()) for c in names[:4]], pa.array(out["body"], pa.binary())], names)


def _cut(batches):
    """(doc, text, spans) -> what is left of each text."""
    for batch in batches:
        texts, spans = batch.column(1), batch.column(2)
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i in range(batch.num_rows):
            text, runs = texts[i].as_buffer().to_pybytes(), []
            for a, b in sorted((x["start"], x["stop"]) for x in spans[i].as_py() or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            edges = [0, *[x for r in runs for x in r], len(text)]
            n_bytes.append(len(text))
            n_removed.append(sum(b - a for a, b in runs))
            n_spans.append(len(runs))
            kept.append(b"".join(text[edges[j]:edges[j + 1]] for j in range(0, len(edges), 2)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)],
                                          pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "n_spans", "kept"])


_LAST = 2**63 - 1


def _first_and_same(marked: DataFrame):
    """(rows of marked that are first in their (digit, stretch), spans of the others)."""
    # a (digit, stretch) that began in an earlier partition is not first there: at most one key for each partition
    opening = F.broadcast(marked.where("head AND opening").select("digit", "stretch"))
    place = F.struct("doc", "version", "pos")
    firsts = marked.where("head").join(opening, ["digit", "stretch"], "left_semi").groupBy("digit", "stretch").agg(
        F.min(place).alias("first_place"))
    found = marked.join(F.broadcast(firsts), ["digit", "stretch"], "left").withColumn(
        "first", F.col("head") & (F.col("first_place").isNull() | (place == F.col("first_place"))))
    start, n = F.shiftright("pos", 14), F.shiftright("pos", 7).bitwiseAND(127)
    same = found.where("NOT first").select("doc", "version", start.cast("int").alias("start"),
                                           (start + n - 1 + LENGTH).cast("int").alias("stop"))
    return found.where("first AND NOT alone"), same


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""
    spark = docs.sparkSession
    ids = docs.groupBy(docs[doc_id].cast("long")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    repeated = (ids.most or 0) > 1
    # versions tell the texts of a repeated id apart; without repeated ids they are all 0
    version = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    base = docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(_LAST)).alias("doc"), text_of(docs, text).alias("text")).select(
        "doc", version.alias("version"), "text")
    once = base.dropDuplicates(["doc", "version"]) if repeated else base
    parts = shuffle_partitions(spark)
    marked = materialize(_by_range(once, parts, ids.rows or 0).mapInArrow(_marked, _STAND_INS + _MARKS), "suffix-marked")
    deeper, spans = _first_and_same(marked)
    deeper = deeper.select("digit", "doc", "version", "pos")

    texts = base.repartition(parts, "doc", "version")        # one exchange for both joins below
    wanted = deeper.groupBy("doc", "version").agg(F.collect_list(F.struct("digit", "pos")).alias("wanted"))
    held = (texts.dropDuplicates(["doc", "version"]) if repeated else texts).join(wanted, ["doc", "version"])
    deeper = held.select("doc", "version", "text", "wanted").mapInArrow(_bodies, "digit long, doc long, version long, pos long, body binary")
    for old, new in zip(widths(), [*widths()[1:], None]):
        deeper = materialize(deeper, "suffix-deeper")
        counts = deeper.groupBy("digit").count().where(F.col("count") > group).select("digit")
        large = materialize(counts, "suffix-large") if new else counts.limit(0)
        small = deeper.join(large, "digit", "left_anti")
        spans = spans.union(small.repartition("digit").sortWithinPartitions("digit", "doc", "version", "pos").mapInArrow(_sort_groups, _SPANS))
        if new is None or large.isEmpty():
            break
        wide = materialize(deeper.join(large, "digit", "left_semi").mapInArrow(_widened(old, new), _WIDE), "suffix-wide")
        sorted_ = wide.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
        marked = materialize(sorted_.mapInArrow(_marked, _WIDE + _MARKS), "suffix-marked")
        deeper, same = _first_and_same(marked)
        deeper, spans = deeper.select(*_BODY), spans.union(same)
    listed = spans.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = texts.join(listed, ["doc", "version"], "left").select("doc", "text", "spans").mapInArrow(
        _cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut.select(F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
