"""Exact, line, suffix and near dedup against brute force, on edge rows and on the small tables."""

import collections
import hashlib
import random
import re

import pytest

from aerosift.llm import exact_dedup, line_dedup, near_dedup, suffix_dedup
from aerosift.llm.exact_dedup import PatriciaTrie

from ..conftest import SF_SMALL
from .conftest import EDGE_ROWS, frame

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _sha(b):
    return hashlib.sha256(b).hexdigest()


def _documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.collect()]


def _rows(df, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in df.collect())


# ---- exact ------------------------------------------------------------------

def brute_exact(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = collections.defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out = []
    for i, t in norm:
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, _sha(t.encode())))
    return collections.Counter(out)


@pytest.mark.parametrize("budget", [1, 2000, exact_dedup.TRIE_BYTES])
def test_exact_dedup(spark, edge, budget):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert _rows(exact_dedup.exact_dedup(edge, trie_bytes=budget), *cols) == brute_exact(EDGE_ROWS)
    df, rows = _documents(spark)
    assert _rows(exact_dedup.exact_dedup(df, trie_bytes=budget), *cols) == brute_exact(rows)


def test_patricia_trie_matches_a_dictionary_and_spills_whole():
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 8))) for _ in range(600)]
    trie, expected, spilled = PatriciaTrie(), {}, collections.defaultdict(list)
    for i, k in enumerate(keys):
        trie.insert(k, i)
        owner, n = expected.get(k, (i, 0))
        expected[k] = (owner, n + 1)
        if i % 97 == 0:
            for key, owner, n in trie.spill(trie.size // 2):
                spilled[key].append((owner, n))
    for key, owner, n in trie.spill(0):
        spilled[key].append((owner, n))
    assert {k: (min(o for o, _ in v), sum(n for _, n in v)) for k, v in spilled.items()} == expected
    assert trie.size == 0


# ---- lines ------------------------------------------------------------------

def brute_lines(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACES).translate(lower)
    held = collections.defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 40:
                    held[key(line)].add(i)
    common = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or key(x) not in common or common[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


def test_line_dedup(spark, edge):
    cols = ("doc_id", "n_lines", "n_dropped", "kept_text")
    assert _rows(line_dedup.line_dedup(edge), *cols) == brute_lines(EDGE_ROWS)
    df, rows = _documents(spark)
    assert _rows(line_dedup.line_dedup(df), *cols) == brute_lines(rows)


def test_line_dedup_keeps_positions_of_other_texts_under_the_same_id(spark):
    common, own = "a common line that is long enough to be a key", "a unique line that only this one row has, at position 0"
    rows = [(1, common + "\nx"), (1, own + "\ny"), (1, own + "\ny"), *((i, common) for i in range(2, 7))]
    got = _rows(line_dedup.line_dedup(frame(spark, rows)).where("doc_id = 1"), "n_dropped", "kept_text")
    assert got == {(1, "x"): 1, (0, own + "\ny"): 2}


def test_line_dedup_runs_no_python(spark):
    df, _ = _documents(spark)
    plan = line_dedup.line_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- suffixes ---------------------------------------------------------------

def brute_suffix(rows):
    """Rows ordered by id (null last); rows of one id must have one text here."""
    out, seen = [], {}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    for r in order:
        body = (rows[r][1] or "").encode()
        for p in range(len(body) - 99):
            seen.setdefault(body[p:p + 100], (rows[r][0], p))
    for i, t in rows:
        body = (t or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - 99):
            if seen[body[p:p + 100]] != (i, p):
                gone[p:p + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(body), sum(gone), runs, kept))
    return collections.Counter(out)


@pytest.mark.parametrize("group", [2, suffix_dedup.GROUP])
def test_suffix_dedup(spark, edge, group):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    got = suffix_dedup.suffix_dedup(edge, group=group)
    rows = [r for r in EDGE_ROWS]
    got = collections.Counter(tuple(bytes(r[c]) if c == "kept" else r[c] for c in cols) for r in got.collect())
    assert got == brute_suffix(rows)
    df, rows = _documents(spark)
    got = suffix_dedup.suffix_dedup(df, group=group)
    assert collections.Counter(tuple(bytes(r[c]) if c == "kept" else r[c] for c in cols) for r in got.collect()) == brute_suffix(rows)


def _cut_rows(got):
    return collections.Counter(tuple(bytes(r[c]) if c == "kept" else r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept"))
                               for r in got.collect())


def test_suffix_dedup_leaves_a_repeated_row_whole(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    own, shared = text(400), text(150)
    rows = [(1, own)] * 300 + [(2, text(300)), (3, text(50) + shared), (4, shared + text(70))] + [(4, "no other has this " * 2)] + [(None, own[::-1])] * 2
    got = _cut_rows(suffix_dedup.suffix_dedup(frame(spark, rows)))
    assert {k[:4]: n for k, n in got.items() if k[0] in (1, None)} == {(1, 400, 0, 0): 300, (None, 400, 0, 0): 2}
    assert {k[2] for k in got if k[0] == 4} == {150, 0} and {k[2] for k in got if k[0] in (2, 3)} == {0}


@pytest.mark.parametrize("group", [1, 3])
def test_suffix_dedup_of_large_groups_takes_wider_digits(spark, group):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    lines = [text(n) for n in (40, 64, 70, 90, 99, 100, 101, 140, 260)]
    rows = [(i, text(rng.randint(0, 90)) + line[rng.randint(0, 3):] + text(rng.randint(0, 90))) for i, line in enumerate(lines * 9)]
    assert _cut_rows(suffix_dedup.suffix_dedup(frame(spark, rows), group=group)) == brute_suffix(rows)


def test_wider_digits_stay_inside_their_strings_and_agree():
    import numpy as np

    rng = random.Random(3)
    passage = bytes(rng.choice(b"abcdef") for _ in range(260))
    bodies = [bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 80))) + passage[rng.randint(0, 60):] for _ in range(6)]
    doc, first, n, place, digit, _ = suffix_dedup.stand_ins(bodies)
    pos = suffix_dedup.pack_place(first, n, place - first)
    held = [bodies[d][a:a + m - 1 + 100] for d, a, m in zip(doc, first, n)]
    digit = digit.astype(np.int64)
    for old, new in zip(suffix_dedup.widths(), suffix_dedup.widths()[1:]):
        row, digit, _, pos, begin, end = suffix_dedup.wider(pos, held, digit, old, new)
        doc, held = doc[row], [held[r][a:b] for r, a, b in zip(row, begin, end)]
        covered, alike = set(), {}
        for d, p, body, key in zip(doc, pos, held, digit):
            first, m, lag = (int(x) for x in suffix_dedup.unpack_place(p))
            assert body == bodies[d][first:first + m - 1 + 100]
            for i in range(m):
                assert (d, first + i) not in covered and 0 <= lag - i and lag - i + new <= 100
                covered.add((d, first + i))
                string = bodies[d][first + i:first + i + 100]
                assert alike.setdefault(string, (key, lag - i)) == (key, lag - i)
        assert len(covered) == sum(max(0, len(b) - 99) for b in bodies)


def test_stand_ins_cover_every_string_once_and_alike():
    rng = random.Random(5)
    for t in range(30):
        alphabet = b"ab" if t % 2 else b"abcdefgh "
        bodies = [bytes(rng.choice(alphabet) for _ in range(rng.choice([0, 5, 99, 100, 101, 130, 300, 900]))) for _ in range(5)]
        bodies += [b"a" * 400, b"ab" * 200]
        covered, alike = set(), {}
        for doc, first, n, place, digit, _ in zip(*suffix_dedup.stand_ins(bodies)):
            for k in range(first, first + n):
                assert (doc, k) not in covered and k <= place and place + suffix_dedup.DIGIT <= k + suffix_dedup.LENGTH
                covered.add((doc, k))
                assert alike.setdefault(bodies[doc][k:k + 100], (digit, place - k)) == (digit, place - k)
        assert len(covered) == sum(max(0, len(b) - 99) for b in bodies)


# ---- near copies ------------------------------------------------------------

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for x in range(len(rows)):
        least[find(x)].append(rows[x][0])
    out = []
    for x, (i, _) in enumerate(rows):
        comp = min((y for y in least[find(x)] if y is not None), default=None) if sets[x] else i
        out.append((i, len(sets[x]), comp, i == comp))
    return collections.Counter(out)


def test_near_dedup(spark, edge):
    cols = ("doc_id", "n_shingles", "component_id", "kept")
    assert _rows(near_dedup.near_dedup(edge), *cols) == brute_near(EDGE_ROWS)
    df, rows = _documents(spark)
    assert _rows(near_dedup.near_dedup(df), *cols) == brute_near(rows)


def test_near_dedup_chains_and_unlike_documents_that_share_a_passage(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    rows, chain = [], list(base)
    for i in range(40):                      # each a small step from the last: the ends are unlike
        at = rng.randrange(200)
        chain = chain[:at] + [word()] + chain[at + 1:]
        rows.append((100 + i, " ".join(chain)))
    passage = [word() for _ in range(60)]
    rows += [(200 + i, " ".join(passage + [word() for _ in range(30)])) for i in range(60)]     # similarity about 0.5
    rows += [(300 + i, " ".join(passage + [word() for _ in range(9)])) for i in range(60)]      # about the threshold
    rng.shuffle(rows)
    got = _rows(near_dedup.near_dedup(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute_near(rows)


@pytest.mark.parametrize("fn", [exact_dedup.exact_dedup, line_dedup.line_dedup, suffix_dedup.suffix_dedup, near_dedup.near_dedup])
def test_empty_table(empty, fn):
    assert fn(empty).collect() == []


def test_bucket_links_join_the_same_components_as_all_pairs_in_any_blocks():
    import numpy as np

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(80)]
    texts = [" ".join(passage[rng.randint(0, 30):] + [word() for _ in range(rng.randint(0, 25))]) for _ in range(150)]
    sets = [shingles(t) for t in texts]
    bodies = [t.encode() for t in texts]
    _, _, some, _, odd = near_dedup.sketch_batch(bodies)
    assert len(some) == len(bodies)

    def roots(edges, start):
        up = dict(enumerate(start))
        def find(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            a, b = find(int(a)), find(int(b))
            up[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(start))]

    true = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(true) > 100
    start = [i - i % 2 if i < 20 else i for i in range(len(sets))]       # some are in components already
    found = near_dedup.linked_members(bodies, np.array(start), odd, None, 75)
    assert {(max(p), min(p)) for p in found} <= set(true)
    assert roots(found, start) == roots(true, start)
    assert len(found) < len(sets)
    side = np.array([i % 2 for i in range(len(sets))])
    found = near_dedup.linked_members(bodies, np.array(start), odd, side, 75)
    assert roots(found, start) == roots([p for p in true if side[p[0]] != side[p[1]]], start)


def test_odd_sketches_rule_no_link_out_and_separate_clear_misses():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (4, 40, 400, 4000):
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2**63, 2 * n).astype(np.uint64))
            for k, linked in ((n // 8, True), (n // 2, False)):
                a, b = np.sort(pool[:n]), np.sort(pool[k:n + k])
                both = len(np.intersect1d(a, b))
                similar = both / (2 * n - both)
                odd = near_dedup.odd_sketches(np.array([0, n, 2 * n]), np.concatenate([a, b])).view(np.uint64)
                passes = np.bitwise_count(odd[0] ^ odd[1]).sum() <= near_dedup.most_flips(n, n, 75)
                if linked and similar >= 0.75:
                    assert passes
                elif not linked and n >= 4000:
                    assert not passes
