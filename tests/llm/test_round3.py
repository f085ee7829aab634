"""Filter audit, SimHash near-dedup and ranked lexical search against brute force."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from aerosift.llm import filter_audit, lexical, queries, simhash

from ..conftest import SF_SMALL
from .conftest import EDGE_ROWS, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- filter audit ----------------------------------------------------------------

def brute_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    masks = []
    for i, text, source in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any((u or "") == t and j is not None and j < i for j, u, _ in rows)}
        good, toxic = (any(x[0] == i and x[k] == 1 for x in labels) and i is not None for k in (1, 2))
        masks.append((source or "", {k for k, v in fails.items() if v}, good, toxic))
    out = {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for step in range(1, 6):
                f, before = order[step - 1], set(order[:step - 1])
                removed = [m for m in own if f in m[1] and not before & m[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not set(order[:step]) & m[1] for m in own), len(removed), sum(f in m[1] and bool(before & m[1]) for m in own),
                    sum(m[1] == {f} for m in own), sum(m[2] for m in removed), sum(m[3] for m in removed)]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return collections.Counter((*k, *v) for k, v in out.items())


def test_filter_audit_of_edge_rows(spark):
    many = " ".join(f"w{i}" for i in range(250))
    extra = [(40, many), (41, many), (41, many), (42, many + " #"), (43, many.upper()), (44, "x " * 250), (None, many), (None, many)]
    rows = [(i, t, None if k % 3 == 0 else f"s{k % 2}") for k, (i, t) in enumerate(EDGE_ROWS + extra)]
    labels = [(40, 1, 0), (41, 1, 1), (41, 0, None), (4, None, 1), (5, 1, 0), (None, 1, 1), (99, 1, 1), (18, 1, 0)]
    kinds = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                          *[T.StructField(c, T.StringType()) for c in ("part", "mask", "n", "digest", "_id", "good")]])
    docs = spark.createDataFrame([(*r, *"zzzzzz") for r in rows], kinds)
    got = filter_audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert collections.Counter(map(tuple, got.collect())) == brute_audit(rows, labels)


def test_filter_audit_of_nothing_and_without_python(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    audit = filter_audit.filter_audit(empty, labels)
    assert audit.collect() == []
    assert not re.search("Python|Arrow|Pandas", audit._jdf.queryExecution().executedPlan().toString())


# ---- SimHash ------------------------------------------------------------------------

def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(int(a)), find(int(b))
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_simhash(rows):
    prints = np.array([brute_print(t) for _, t in rows], np.uint64)
    root = roots(len(rows), np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3))
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return collections.Counter((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root))


@pytest.mark.parametrize("limits", [{}, {"shard": 4, "block": 8, "direct": 2, "sample": 8}])
def test_simhash_dedup(spark, edge, empty, limits):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(400)]
    near = [(100 + k, " ".join(base[:k] + ["other"] + base[k + 1:])) for k in range(0, 400, 20)]
    rows = EDGE_ROWS + near
    assert collections.Counter(map(tuple, simhash.simhash_dedup(frame(spark, rows), **limits).collect())) == brute_simhash(rows)
    assert simhash.simhash_dedup(empty, **limits).collect() == []
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert collections.Counter(map(tuple, simhash.simhash_dedup(df, **limits).collect())) == brute_simhash(rows)


def test_a_fingerprint_does_not_depend_on_its_pieces():
    text = ("Ab c\n dé 漢 " * 300).encode()
    assert simhash.fingerprint(text) == simhash.fingerprint(text, piece=7) == brute_print(text.decode())


@pytest.mark.parametrize("shard, block, direct, sampled", [(200, 10**9, 50, 1.0), (300, 100, 64, 0.1), (10**9, 10**9, 10**9, 1.0)])
def test_trees_find_every_component_and_no_false_link(shard, block, direct, sampled):
    rng = np.random.default_rng(3)

    def near(center, n, flips):
        return [int(center) ^ int(np.bitwise_or.reduce([0, *(1 << int(b) for b in rng.integers(0, 63, rng.integers(0, flips + 1)))])) for _ in range(n)]

    points = [*map(int, rng.integers(0, 2**63, 1200)), *near(12345, 600, 6), 0, 1, 2**63, 2**64 - 1]
    for _ in range(20):
        points += near(rng.integers(0, 2**63), 30, 5)
    points += [int(x) & 0xFFFFFFFF | 7 << 40 for x in rng.integers(0, 2**63, 300)]      # one half alike
    points = np.unique(np.array(points, np.uint64))
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    looked = points[rng.random(len(points)) < sampled]
    links = []
    for half in simhash.HALVES:
        shards = collections.defaultdict(list)
        for name, side, which in simhash.routed(points, simhash.grow(looked, half, len(points) / len(looked), shard, block)):
            shards[name].append((side, which))
        for parts in shards.values():
            which = np.concatenate([w for _, w in parts])
            side = np.concatenate([np.full(len(w), s) for s, w in parts])
            found = simhash.shard_links(points[which], side, half, direct=direct)
            assert len(found) < max(1, len(which))
            links += [(which[i], which[j]) for i, j in found]
    assert all(close[a, b] for a, b in links)
    assert roots(len(points), links) == roots(len(points), np.argwhere(np.triu(close, 1)))


# ---- lexical search -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, top=10):
    docs = [(i, collections.Counter(brute_terms(t))) for i, t in docs]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n, total = len(docs), sum(d[2] for d in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(brute_terms(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, counts, length in docs:
            m = 100 - 90 + 90 * length * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in terms if t in counts)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return collections.Counter(out)


ITEMS = [(1, "one Two w1 w5 w9"), (2, "LOREM ipsum, dolor-sit"), (3, None), (4, "..."), (5, "é漢字 ñandú an other"), (5, "strange spaces"), (None, "a one"),
         (6, "nothing that occurs xyzzy"), (7, "word")]


@pytest.mark.parametrize("limits", [{}, {"columns": 3, "cells": 8, "terms": 4}, {"top": 2}])
def test_lexical_search(spark, edge, empty, limits):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = collections.Counter(map(tuple, lexical.lexical_search(edge, items, **limits).collect()))
    assert got == brute_search(EDGE_ROWS, ITEMS, limits.get("top", 10))
    if not limits:
        assert lexical.lexical_search(empty, items).collect() == [] == lexical.lexical_search(edge, items.limit(0)).collect()


def test_treap_search_equals_all_scores_in_any_batches():
    rng = np.random.default_rng(7)
    for t in range(30):
        v, c = int(rng.integers(1, 70)), int(rng.integers(1, 90))
        grid = np.where(rng.random((v, c)) < 0.2, rng.integers(1, 6, (v, c)), 0)
        rows, columns = np.nonzero(grid)
        if not len(rows):
            continue
        ids = rng.permutation(c * 3)[:c].astype(np.int64)
        treap = lexical.Treap(rows, columns, grid[rows, columns].astype(np.int64), ids, max(v - 1, c - 1).bit_length())
        terms = np.sort(rng.permutation(v)[:int(rng.integers(1, v + 1))])
        weights = rng.integers(0, 4, len(terms)).astype(np.int64)
        score = weights @ grid[terms]
        want = sorted((-s, i) for s, i in zip(score, ids) if s > 0)[:5]
        for batch in ((1, 1), (2, 8), (1024, 1024)):
            best = lexical.Best(5)
            lexical.search(treap, terms, weights, best, batch)
            assert [(-s, i) for s, i in zip(best.score, best.doc)] == want


def test_long_texts_are_counted_in_pieces_alike():
    body = ("Ab-c dé漢 x9\x00y " * 500).encode()
    whole = lexical.count_terms(body)
    assert whole == lexical.count_terms(body, piece=5) and whole[0] == len(brute_terms(body.decode()))


@pytest.mark.parametrize("name, columns", [
    ("op11_filter_audit", ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]),
    ("op12_simhash", ["doc_id", "fingerprint", "component_id"]), ("op13_lexical_search", ["item_id", "rank", "doc_id", "score"])])
def test_contracts_of_the_round(spark, name, columns):
    got = queries.REGISTRY[name](spark, SF_SMALL)
    assert got.columns[:len(columns)] == columns
    kinds = dict(got.dtypes)
    assert all(kinds[c] == ("int" if c in ("step", "rank") else "string" if c in ("part", "filter_order", "fingerprint") else "bigint") for c in columns)
