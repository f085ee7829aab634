"""Byte-level BPE by a tree of joins.

Encoding is a reduction over a tree: a piece (one match of the split pattern)
is cut into halves down to leaves of ``LEAF`` bytes, leaves are merged directly,
and neighbours are joined upward. A join re-encodes a window of tokens on both
sides of the seam. A token sequence is the encoding of its bytes exactly when
each adjacent pair of tokens is the encoding of that pair's bytes, and the
outer parts are encodings already, so only the two pairs at the window's edges
need a check. A side whose edge pair fails gets a window of twice the size;
a window that has grown to its whole side has no edge left there. So a join is
proven, not assumed, and long pieces cost about n log n instead of n squared.

Leaves of a batch are merged together as rows of one table: each round finds
every row's lowest-ranked pair and merges it. Matches of the split pattern are independent, so
above the piece the join of two encodings is concatenation, and decoding
concatenates bytes up the same tree. Each worker remembers the pieces it has
encoded, in a table of bounded size.

Defined results: a null text equals the empty text (no tokens). Rows with equal
or null ids each get a result. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_row_per_doc

LEAF = 32
#: Tokens taken from each side of a seam at first.
WINDOW = 4
#: Pieces a worker remembers; the table is emptied when it is full.
REMEMBERED = 400_000
#: Matches of one step through a long text, and bytes of text per step through a batch.
MATCHES, STEP_BYTES = 200_000, 4 << 20

_NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of a byte-level BPE and what merging with them needs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # every split of a token into two tokens: (left, right) -> rank of the whole
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        a = np.array(pairs, np.int64).reshape(-1, 3)
        self._fill(((a[:, 0] << 32) | a[:, 1]).astype(np.uint64), a[:, 2].astype(np.int32))
        self.pair_ok: dict[tuple[int, int], bool] = {}

    def _fill(self, keys, values) -> None:
        """Open-addressed table of the pairs, a quarter full at most."""
        bits = max(4, int(np.ceil(np.log2(4 * max(len(keys), 1)))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, _NONE, np.int32)
        slot = self._slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[slot] == np.uint64(2**64 - 1)
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.mask

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each concatenated pair, or _NONE; a negative token has none."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], _NONE)
        look = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != np.uint64(2**64 - 1)))
        slot, key = slot[look], keys[look]
        for _ in range(self.probes):
            if not len(look):
                break
            slot = (slot + 1) & self.mask
            hit = self.keys[slot] == key
            out[look[hit]] = self.values[slot[hit]]
            go = ~hit & (self.keys[slot] != np.uint64(2**64 - 1))
            look, slot, key = look[go], slot[go], key[go]
        out[(left < 0) | (right < 0)] = _NONE
        return out

    # ---- leaves -----------------------------------------------------------

    def merge_rows(self, leaves: list[bytes]) -> list[list[int]]:
        """Direct merges of short byte strings, all rows of a width class at once."""
        out: list[list[int] | None] = [None] * len(leaves)
        sizes = np.fromiter(map(len, leaves), np.int64, len(leaves))
        low = 0
        for width in (2, 4, 8, 12, 16, 24, LEAF, max(LEAF + 1, int(sizes.max(initial=0)))):
            at = np.flatnonzero((sizes > low) & (sizes <= width))
            for i in range(0, len(at), 1 << 15):
                rows = at[i:i + (1 << 15)]
                for j, ids in zip(rows.tolist(), self._merge_table([leaves[j] for j in rows.tolist()], sizes[rows], width)):
                    out[j] = ids
            low = width
        return [x if x is not None else [] for x in out]

    def _merge_table(self, leaves, sizes, width):
        flat = np.frombuffer(b"".join(leaf.ljust(width, b"\0") for leaf in leaves), np.uint8).reshape(-1, width)
        tokens = self.byte_rank[flat]
        tokens[np.arange(width) >= sizes[:, None]] = -1
        done = np.full_like(tokens, -1)
        rows = np.arange(len(tokens))
        ranks = self.pair_ranks(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(tokens), width - 1)
        columns = np.arange(width)
        while len(rows):
            best = ranks.argmin(1)                    # the first of the lowest: leftmost
            n = np.arange(len(rows))
            rank = ranks[n, best]
            end = rank == _NONE
            if end.any():
                done[rows[end]] = tokens[end]
                go = ~end
                rows, tokens, ranks, best, rank = rows[go], tokens[go], ranks[go], best[go], rank[go]
                n = np.arange(len(rows))
                if not len(rows):
                    break
            take = np.minimum(columns + (columns > best[:, None]), width - 1)
            tokens = np.take_along_axis(tokens, take, 1)
            tokens[n, best] = rank
            tokens[:, -1] = -1
            take = np.minimum(columns[:-1] + (columns[:-1] > best[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, take, 1)
            ranks[:, -1] = _NONE
            right = np.minimum(best + 1, width - 1)
            ranks[n, np.minimum(best, width - 2)] = np.where(best < width - 1, self.pair_ranks(tokens[n, best], np.where(
                best < width - 1, tokens[n, right], -1)), _NONE)
            has_left = np.flatnonzero(best > 0)
            ranks[has_left, best[has_left] - 1] = self.pair_ranks(
                tokens[has_left, best[has_left] - 1], tokens[has_left, best[has_left]])
        counts = (done >= 0).sum(1).tolist()
        return [row[:c] for row, c in zip(done.tolist(), counts)]

    def merge_window(self, data: bytes) -> list[int]:
        """Direct merges of one byte string in plain steps (windows and pairs are short)."""
        tokens = self.byte_rank[np.frombuffer(data, np.uint8)].tolist()
        ranks, bytes_of = self.ranks, self.bytes_of
        pair = [ranks.get(bytes_of[a] + bytes_of[b], _NONE) for a, b in zip(tokens, tokens[1:])]
        while pair:
            best = min(pair)
            if best == _NONE:
                break
            i = pair.index(best)
            tokens[i:i + 2] = [int(best)]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(bytes_of[tokens[i]] + bytes_of[tokens[i + 1]], _NONE)
            if i:
                pair[i - 1] = ranks.get(bytes_of[tokens[i - 1]] + bytes_of[tokens[i]], _NONE)
        return tokens

    # ---- joins ------------------------------------------------------------

    def stable(self, a: int, b: int) -> bool:
        """Whether the tokens a, b next to each other are the encoding of their bytes."""
        ok = self.pair_ok.get((a, b))
        if ok is None:
            ok = self.merge_window(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.pair_ok) >= REMEMBERED:
                self.pair_ok.clear()
            self.pair_ok[a, b] = ok
        return ok

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' bytes, from the encodings of each."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        lo = hi = WINDOW
        while True:
            cut, end = max(len(left) - lo, 0), min(hi, len(right))
            middle = left[cut:] + right[:end]
            data = b"".join([self.bytes_of[t] for t in middle])
            window = self.merge_window(data) if len(data) <= 4 * LEAF else self.encode_bytes(data)
            left_ok = cut == 0 or self.stable(left[cut - 1], window[0])
            right_ok = end == len(right) or self.stable(window[-1], right[end])
            if left_ok and right_ok:
                return left[:cut] + window + right[end:]
            lo, hi = (lo if left_ok else 2 * lo), (hi if right_ok else 2 * hi)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Encode by halves: leaves first, then joins level by level."""
        parts = self.merge_rows([data[i:i + LEAF] for i in range(0, len(data), LEAF)])
        return self._reduce(parts)

    def _reduce(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Encode many pieces: whole tokens directly, the others' leaves together, then joins."""
        out: list[list[int] | None] = [None] * len(pieces)
        leaves, spans = [], []
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = [rank]
            else:
                at = len(leaves)
                leaves.extend(p[j:j + LEAF] for j in range(0, len(p), LEAF))
                spans.append((i, at, len(leaves)))
        merged = self.merge_rows(leaves)
        for i, a, b in spans:
            out[i] = merged[a] if b - a == 1 else self._reduce(merged[a:b])
        return out

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


_LOADED: dict[str, Vocabulary] = {}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a rank file once per process. The file belongs to an installed package, so each worker has it."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = Vocabulary(ranks)
    return _LOADED[path]


#: Code points below this have their own compiled classes (Latin letters and signs).
_LATIN = 0x250
_LATIN_ONLY = re.compile(f"[\\x00-{chr(_LATIN - 1)}]*\\Z")


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The split pattern for texts of code points below ``_LATIN`` only.

    The classes for letters, numbers and white space become plain character lists, which
    the standard engine matches faster. None if the pattern uses other properties."""
    members = {k: "".join(f"\\u{c:04x}" for c in range(_LATIN) if regex.match(k, chr(c))) for k in (r"\p{L}", r"\p{N}", r"\s")}
    out, at, inside = [], 0, False
    while at < len(pattern):
        key = next((k for k in members if pattern.startswith(k, at)), None)
        if key:
            out.append(members[key] if inside else f"[{members[key]}]")
            at += len(key)
        elif pattern.startswith(r"\S", at) and not inside:
            out.append(f"[^{members[chr(92) + 's']}]")
            at += 2
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return re.compile("".join(out))


class Encoder:
    """Pieces remembered as their ids in decimal and as the bytes those ids decode to."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split, self.latin = vocabulary, regex.compile(pattern), latin_pattern(pattern)
        self.id_text = [str(i) for i in range(len(vocabulary.bytes_of))]
        self.ids_of: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def splitter(self, text: str):
        return self.latin if self.latin and _LATIN_ONLY.match(text) else self.split

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.ids_of]
        if len(self.ids_of) + len(new) > REMEMBERED:
            self.ids_of.clear()
            self.decoded.clear()
            new = list(pieces)
        v, id_text = self.vocabulary, self.id_text
        collecting = gc.isenabled()
        gc.disable()                    # many small lists, none of them in cycles
        try:
            for at in range(0, len(new), 1 << 16):
                part = new[at:at + (1 << 16)]
                for p, ids in zip(part, v.encode_pieces([p.encode() for p in part])):
                    self.ids_of[p] = ",".join([id_text[i] for i in ids])
                    self.decoded[p] = v.decode(ids)
        finally:
            if collecting:
                gc.enable()

    def digest(self, texts: list[str]):
        """(n_tokens, hash of the ids as text, hash of the decoded bytes) of each text."""
        steps = [None if len(t) * 2 > STEP_BYTES else self.splitter(t).findall(t) for t in texts]
        self.learn(set(itertools.chain.from_iterable(filter(None, steps))))
        out = []
        for pieces in steps:
            if pieces is None:
                out.append(None)        # the long ones come last: they may empty the tables
                continue
            ids = ",".join(map(self.ids_of.__getitem__, pieces)).encode()
            out.append((ids.count(b",") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(b"".join(map(self.decoded.__getitem__, pieces))).hexdigest()))
        return [self._long(t) if x is None else x for t, x in zip(texts, out)]

    def _long(self, text: str):
        """A long text in steps of MATCHES matches; only one step's pieces are in memory."""
        matches, n, ids, decoded = self.splitter(text).finditer(text), 0, hashlib.sha256(), hashlib.sha256()
        while step := [m.group() for m in itertools.islice(matches, MATCHES)]:
            self.learn(set(step))
            part = ",".join(map(self.ids_of.__getitem__, step)).encode()
            ids.update(b"," + part if n else part)
            decoded.update(b"".join(map(self.decoded.__getitem__, step)))
            n += part.count(b",") + 1
        return n, ids.hexdigest(), decoded.hexdigest()

    def ids(self, text: str) -> list[int]:
        pieces = self.splitter(text).findall(text)
        return list(itertools.chain.from_iterable(self.vocabulary.encode_pieces([p.encode() for p in pieces])))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_vocabulary(path), pattern)
    return _ENCODERS[path, pattern]


def _steps(batch):
    """Slices of a batch of about STEP_BYTES of text."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STEP_BYTES:
            yield ids[at:i + 1], texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield ids[at:], texts[at:]


def bpe_digest(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for ids, texts in _steps(batch):
                n, a, b = zip(*enc.digest(texts))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return one_row_per_doc(docs, doc_id, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids."""
    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for ids, texts in _steps(batch):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([enc.ids(t) for t in texts], pa.list_(pa.int32()))],
                                                 ["doc_id", "ids"])

    return one_row_per_doc(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: doc_id, body (bytes). Null ids decode to no bytes."""
    def run(batches):
        vocabulary = load_vocabulary(path)
        for batch in batches:
            bodies = [vocabulary.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, body binary")
