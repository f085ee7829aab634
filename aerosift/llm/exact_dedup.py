"""Exact dedup: compressed radix (Patricia) tries with owner nodes.

Texts are compared after every run of white space became one space. Each
task inserts its normalised byte strings into a Patricia trie whose terminal
nodes keep the smallest id and the number of rows. A trie over its byte budget
spills: the largest subtrees below the root hand their terminals on and are
dropped, so memory is bounded and nothing is lost (a terminal is a partial
result; partials of one text meet again at the owner). Partials are dealt by
length and content hash. The owner of a partition reads them in (length, hash)
order, so one trie holds one (length, hash) cell and its owner is final when
the cell ends. A text held by a third of all rows sends one partial per task.

Defined results: null text equals the empty text. Rows repeated with one id
count as group members; all rows with the smallest id stay. A null id never
owns a text unless all ids of the group are null; such a group has a null
``keep_id`` and all its rows stay. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, one_row_per_doc

#: Bytes of edges and nodes that one trie may hold before it spills.
TRIE_BYTES = 48 << 20
#: What a node costs besides its label.
_NODE_BYTES = 400
#: Rows and bytes of an output batch.
_OUT_ROWS, _OUT_BYTES = 2048, 8 << 20


class Node:
    """An edge label, the children by first byte, and the terminal's partial."""

    __slots__ = ("children", "count", "label", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.count, self.owner = label, {}, 0, None


def _smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


class PatriciaTrie:
    """Byte strings -> (smallest id, rows), prefixes shared along edges."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner, count: int = 1) -> None:
        node, at, end = self.root, 0, len(key)
        while at < end:
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.size += _NODE_BYTES + end - at
                node, at = child, end
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            # split the edge where the key leaves it
            same = self._common(label, key, at)
            upper = Node(label[:same])
            child.label = label[same:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            self.size += _NODE_BYTES
            node, at = upper, at + same
        node.owner = _smaller(node.owner, owner)
        node.count += count

    @staticmethod
    def _common(label: bytes, key: bytes, at: int) -> int:
        """Length of the common prefix of ``label`` and ``key[at:]``, by halving."""
        low, high = 0, min(len(label), len(key) - at)
        while low < high:
            mid = (low + high + 1) // 2
            if label[low:mid] == key[at + low:at + mid]:
                low = mid
            else:
                high = mid - 1
        return low

    def _terminals(self, node: Node, prefix: bytes):
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.count:
                yield prefix, node.owner, node.count
            stack.extend((c, prefix + c.label) for c in node.children.values())

    def spill(self, down_to: int):
        """Hand on the terminals of whole subtrees, largest first, until the
        trie is at most ``down_to`` bytes; ``spill(0)`` empties it."""
        weigh = {b: self._weight(c) for b, c in self.root.children.items()}
        for first in sorted(weigh, key=weigh.get, reverse=True):
            if self.size <= down_to:
                break
            child = self.root.children.pop(first)
            self.size -= weigh[first]
            yield from self._terminals(child, child.label)
        if down_to == 0:
            if self.root.count:
                yield b"", self.root.owner, self.root.count
            self.root, self.size = Node(b""), 0

    @staticmethod
    def _weight(node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += _NODE_BYTES + len(node.label)
            stack.extend(node.children.values())
        return total


_PARTIAL = "n_bytes long, digest binary, body binary, owner long, n long"
_OWNED = "n_bytes long, digest binary, keep_id long, group_size long"


def _batches(rows, schema: pa.Schema, size_of):
    """Arrow batches of bounded rows and bytes from an iterator of tuples."""
    held, n_bytes = [], 0
    for row in rows:
        held.append(row)
        n_bytes += size_of(row)
        if len(held) >= _OUT_ROWS or n_bytes >= _OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, n_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _combine(budget: int):
    """Task-side tries: rows (id, body) -> partials, one per distinct text unless spilled."""
    schema = pa.schema([("n_bytes", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
                        ("owner", pa.int64()), ("n", pa.int64())])

    def run(batches):
        def partials():
            trie = PatriciaTrie()

            def out(terminals):
                for body, owner, n in terminals:
                    yield len(body), hashlib.sha256(body).digest(), body, owner, n

            for batch in batches:
                for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    trie.insert(body, doc)
                    if trie.size > budget:
                        yield from out(trie.spill(budget // 2))
            yield from out(trie.spill(0))

        yield from _batches(partials(), schema, lambda r: r[0])

    return run


def _own():
    """Owner side: partials in (length, hash) order -> one row per distinct text."""
    schema = pa.schema([("n_bytes", pa.int64()), ("digest", pa.binary()), ("keep_id", pa.int64()),
                        ("group_size", pa.int64())])

    def run(batches):
        def owned():
            trie, cell = PatriciaTrie(), None
            for batch in batches:
                for n_bytes, digest, body, owner, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if cell != (n_bytes, digest):
                        if cell:
                            yield from (cell + t[1:] for t in trie.spill(0))
                        cell = (n_bytes, digest)
                    trie.insert(body, owner, n)
            if cell:
                yield from (cell + t[1:] for t in trie.spill(0))

        yield from _batches(owned(), schema, lambda r: 64)

    return run


def owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: n_bytes, digest (SHA-256), keep_id, group_size."""
    body = F.regexp_replace(F.col("text"), SPACE_RUN, " ").cast("binary")
    partials = one_row_per_doc(docs, doc_id, text).select("doc_id", body.alias("body")).mapInArrow(
        _combine(trie_bytes), _PARTIAL)
    return partials.repartition("n_bytes", "digest").sortWithinPartitions("n_bytes", "digest").mapInArrow(
        _own(), _OWNED)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The join back is on (length, digest); a group that holds a third of all
    rows is split there by adaptive skew handling, the owner side has one row."""
    body = F.regexp_replace(F.col("text"), SPACE_RUN, " ").cast("binary")
    members = one_row_per_doc(docs, doc_id, text).select(
        "doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.unhex(F.sha2(body, 256)).alias("digest"))
    return members.join(owners(docs, doc_id, text, trie_bytes), ["n_bytes", "digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
