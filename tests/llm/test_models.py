"""PPM, quality, packing, top-k, BPE and PII against brute force, other libraries or held-out rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerosift.llm import bpe, packing, pii, ppm, quality, topk

from ..conftest import SF_MID, SF_SMALL
from .conftest import EDGE_ROWS, PII, frame

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _documents(spark, sf=SF_SMALL):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.collect()]


# ---- PPM --------------------------------------------------------------------

def brute_base(rows):
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 5
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    c = collections.Counter()
    for i, t in rows:
        if fold(i) not in (None, 1):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        score = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, None if i is None else fold(i) == 1, len(w), sum(c[x] > 0 for x in w), n, round(score, 6)))
    return collections.Counter(out)


def _base(df):
    return collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_ppm_base_scores(spark, edge):
    df, rows = _documents(spark)
    assert _base(ppm.ppm_scores(df)) == brute_base(rows)
    assert _base(ppm.ppm_scores(edge)) == brute_base(EDGE_ROWS)


def _trie(bodies):
    """The trie of some training texts, counted in plain Python."""
    pairs = collections.Counter()
    for b in bodies:
        symbols = [ppm.END] * ppm.ORDER + [*b, ppm.END]
        for p in range(ppm.ORDER, len(symbols)):
            for k in range(ppm.ORDER + 1):
                key = 0
                for s in symbols[p - k:p + 1]:
                    key = key << 9 | s
                pairs[k, key] += 1
    positions = sum(len(b) + 1 for b in bodies)
    kept = {x: n for x, n in pairs.items() if n * ppm.PAIRS >= positions}
    nodes = {}
    for (k, key), n in pairs.items():
        t, d, most = nodes.get((k, key >> 9), (0, 0, 0))
        nodes[k, key >> 9] = (t + n, d + 1, max(most, n))
    nodes = {x: v for x, v in nodes.items() if v[2] * ppm.PAIRS >= positions}
    return kept, nodes


def _ppm_log(kept, nodes, history, symbol):
    """Prediction by partial matching straight from its definition."""
    log, excluded = 0.0, set()
    for k in range(ppm.ORDER, -1, -1):
        ctx = 0
        for s in history[len(history) - k:]:
            ctx = ctx << 9 | s
        if (k, ctx) not in nodes:
            continue
        t, d, _ = nodes[k, ctx]
        own = {s: kept[k, ctx << 9 | s] for s in range(ppm.SYMBOLS) if (k, ctx << 9 | s) in kept}
        leave = max(t - sum(own.values()) + d, 1)
        left = {s: n for s, n in own.items() if s not in excluded}
        total = sum(left.values()) + leave
        if symbol in left:
            return log + math.log10(left[symbol] / total)
        log += math.log10(leave / total)
        excluded |= set(own)
    return log - math.log10(max(ppm.SYMBOLS - len(excluded), 1))


@pytest.mark.parametrize("share", [1 << 20, 40])
def test_ppm_trie_matches_its_definition_and_sums_to_one(monkeypatch, share):
    import pyarrow as pa

    monkeypatch.setattr(ppm, "PAIRS", share)
    rng = random.Random(3)
    bodies = [bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 60))) for _ in range(20)] + [b"the theory of the thing " * 4]
    kept, nodes = _trie(bodies)
    trie = ppm.Trie(pa.table({"k": [k for k, _ in kept], "key": [x for _, x in kept], "n": list(kept.values())}),
                    pa.table({"k": [k for k, _ in nodes], "ctx": [x for _, x in nodes], "t": [v[0] for v in nodes.values()],
                              "d": [v[1] for v in nodes.values()]}))
    for body in (b"", b"a", b"abc the zebra", b"the theory of " * 40):
        symbols = [ppm.END] * ppm.ORDER + [*body, ppm.END]
        want = sum(_ppm_log(kept, nodes, symbols[:p], symbols[p]) for p in range(ppm.ORDER, len(symbols)))
        assert trie.score([body])[0] == pytest.approx(want, rel=1e-5)
    for node in range(0, len(trie.suffix), 7):
        logs = trie.ask(np.full(ppm.SYMBOLS, node), np.arange(ppm.SYMBOLS))[0]
        assert (10.0 ** logs).sum() == pytest.approx(1, abs=1e-4)


def test_ppm_pieces_do_not_change_scores(monkeypatch):
    import pyarrow as pa

    kept, nodes = _trie([b"abcabcabd" * 5, b"bcd"])
    table = (pa.table({"k": [k for k, _ in kept], "key": [x for _, x in kept], "n": list(kept.values())}),
             pa.table({"k": [k for k, _ in nodes], "ctx": [x for _, x in nodes], "t": [v[0] for v in nodes.values()],
                       "d": [v[1] for v in nodes.values()]}))
    texts = [b"abcd" * 50, b"", b"a" * 97]
    whole = ppm.Trie(*table).score(texts)
    monkeypatch.setattr(ppm, "_PIECE", 7)
    assert np.allclose(ppm.Trie(*table).score(texts), whole)


def test_ppm_scores_use_every_pair_whatever_the_head(spark, empty, monkeypatch):
    """A small head, as at a large corpus, must not change the score: rare pairs count."""
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 5
    small = [(i, t[:300]) for i, t in _documents(spark)[1][:30]]
    short = [(i, t) for i, t in EDGE_ROWS if len(t or "") < 1000]
    for rows in (small, short, [(None, "ab")]):
        df, of = frame(spark, rows), [(i, (t or "").encode()) for i, t in rows]
        monkeypatch.setattr(ppm, "PAIRS", 1 << 40)
        kept, nodes = _trie([t for i, t in of if fold(i) not in (None, 1)])

        def log(body, kept=kept, nodes=nodes):
            symbols = [ppm.END] * ppm.ORDER + [*body, ppm.END]
            return sum(_ppm_log(kept, nodes, symbols[:p], symbols[p]) for p in range(ppm.ORDER, len(symbols)))

        monkeypatch.setattr(ppm, "PAIRS", 40)
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.score) for r in ppm.ppm_scores(df).collect()))
        want = sorted((i is None, i or 0, log(t)) for i, t in of)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-9)
    assert ppm.ppm_scores(empty).collect() == []


def test_grams_match_plain_counting():
    bodies = [b"", b"ab", b"abcdefgh", b"", b"xyz"]
    want = collections.Counter()
    for b in bodies:
        symbols = [ppm.END] * ppm.ORDER + [*b, ppm.END]
        for p in range(ppm.ORDER, len(symbols)):
            key = 0
            for s in symbols[p - ppm.ORDER:p + 1]:
                key = key << 9 | s
            want[key] += 1
    assert collections.Counter(ppm.grams_of(bodies).tolist()) == want


# ---- quality ----------------------------------------------------------------

def test_quality_on_held_out_labels(spark):
    df, _ = _documents(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = quality.quality_scores(df, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and got.count() == df.count()


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (None, 1, "x"), (3, None, "x"), (4, 1, "x"), (4, 0, "x"), (9, 1, "x")],
                                   "doc_id long, quality int, stats string")
    assert quality.quality_scores(edge, labels).count() == len(EDGE_ROWS)
    none = quality.quality_scores(edge, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(empty, labels).collect() == []


def test_isotonic_is_monotone_and_pools():
    at, share = quality.isotonic(np.arange(6.0), np.array([0, 3, 1, 2, 5, 5.0]), np.array([5, 5, 5, 5, 5, 5.0]))
    assert (np.diff(share) >= 0).all() and (np.diff(at) > 0).all() and len(at) < 6


# ---- packing ----------------------------------------------------------------

def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(1, 60), 7)))
        counts = np.array([rng.randint(1, 9) for _ in lengths])
        tokens = lengths * counts
        got = packing.optimal_boundaries(lengths, counts, tokens, 3)

        def cost(bounds, lengths=lengths, counts=counts):
            return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))

        best = min(cost([*c, lengths[-1]]) for k in range(3) for c in itertools.combinations(lengths[:-1], k))
        assert cost(got) == best and got[-1] == lengths[-1]


def test_packing(spark, edge, empty):
    df, rows = _documents(spark)
    for frame_, n in ((df, len(rows)), (edge, len(EDGE_ROWS))):
        got = packing.pack(frame_, shard_rows=7).collect()
        assert len(got) == n
        slots = collections.Counter((r.bucket_id, r.batch_id, r.batch_slot) for r in got)
        assert max(slots.values()) == 1
        for bucket, of in itertools.groupby(sorted(got, key=lambda r: (r.bucket_id, r.batch_id, r.batch_slot)), lambda r: r.bucket_id):
            of = list(of)
            room = max(packing.BUDGET // of[0].bucket_tokens, 1)
            assert [r.batch_id * room + r.batch_slot for r in of] == list(range(len(of)))      # full but for the last
            assert all(r.n_tokens <= r.bucket_tokens and r.n_padding == r.bucket_tokens - r.n_tokens for r in of)
    want = {i: len((t or "").encode().split()) + 1 for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in packing.pack(df).collect()} == want
    assert packing.pack(empty).collect() == []


def test_packing_pads_to_lengths_that_occur(spark):
    rows = [(i, "w " * (n - 1)) for i, n in enumerate([131, 131, 129, 5461, 5461, 5461, 300])]
    got = packing.pack(frame(spark, rows), buckets=2).collect()
    longest = collections.defaultdict(int)
    for r in got:
        longest[r.bucket_id] = max(longest[r.bucket_id], r.n_tokens)
    assert all(r.bucket_tokens == longest[r.bucket_id] for r in got)
    assert len({r.batch_id for r in got if r.n_tokens == 5461}) == 1        # three of 5,461 fit the budget


# ---- top-k ------------------------------------------------------------------

def brute_top(rows, k, is_query):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = {}
    for q, v in ok:
        if is_query(q):
            best = {}
            for c, w in ok:
                if c != q:
                    best[c] = max(best.get(c, -10**18), dot(v, w))
            for rank, (c, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]):
                out[q, rank + 1] = (c, s)
    return out


def test_top_k(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 440)]                                # ties
    rows += [(1000, None), (1050, []), (1100, [float("nan")] * 8), (1150, [None] * 8), (1200, [0.0] * 8), (None, rows[0][1]), (1250, [1.0, 2.0])]
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                         T.StructField("block", T.StringType()), T.StructField("norm", T.StringType())])
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], kind)
    rounded = [(r.vec_id, r.embedding) for r in df.collect()]
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", 2)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got.collect()} == brute_top(rounded, 5, lambda q: q % 50 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# ---- BPE --------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference_bpe():
    ranks = bpe.load_vocabulary(VOCABULARY).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library(reference_bpe):
    rng, enc = random.Random(3), bpe.encoder(VOCABULARY, public_tokenizers.PATTERN)
    for _ in range(800):
        text = "".join(rng.choice("aaaabcdefgthe ing\n\t 0123'sé漢²½\x1c\x85\xa0  !?*  ") for _ in range(rng.choice([1, 5, 40, 200])))
        assert enc.ids(text) == reference_bpe.encode_ordinary(text), repr(text)
        assert enc.vocabulary.decode(enc.ids(text)) == text.encode()
    for n in (100, 1000, 4000):
        for alphabet in ("a", "ab", "theing", "abcdefghijklmnopqrstuvwxyz", "*=", "漢字仮名"):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert enc.ids(text) == reference_bpe.encode_ordinary(text)


def test_bpe_digests(spark, edge, empty, reference_bpe, monkeypatch):
    for df, rows in (_documents(spark), (edge, EDGE_ROWS)):
        want = collections.Counter()
        for i, t in rows:
            ids = reference_bpe.encode_ordinary(t or "")
            want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
        got = bpe.bpe_digest(df, VOCABULARY, public_tokenizers.PATTERN).collect()
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.bpe_digest(empty, VOCABULARY, public_tokenizers.PATTERN).collect() == []


def test_bpe_long_texts_go_in_steps(reference_bpe, monkeypatch):
    monkeypatch.setattr(bpe, "STEP_BYTES", 100)
    monkeypatch.setattr(bpe, "MATCHES", 7)
    enc = bpe.Encoder(bpe.load_vocabulary(VOCABULARY), public_tokenizers.PATTERN)
    text = "the thing's 12 théories, and\n\n more " * 20
    ids = reference_bpe.encode_ordinary(text)
    assert enc.digest([text, "short"])[0] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                              hashlib.sha256(text.encode()).hexdigest())


def test_bpe_round_trip(spark, edge):
    encoded = bpe.bpe_encode(edge, VOCABULARY, public_tokenizers.PATTERN)
    back = bpe.bpe_decode(encoded, VOCABULARY).collect()
    assert collections.Counter((r.doc_id, bytes(r.body)) for r in back) == collections.Counter((i, (t or "").encode()) for i, t in EDGE_ROWS)


# ---- PII --------------------------------------------------------------------

STRICT = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out, counts = [], collections.Counter()
    for k, (kind, pattern) in enumerate(STRICT):
        for m in re.finditer(pattern, text or ""):
            s, digits = m.group(), re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if j % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for j, c in enumerate(digits[::-1])) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 12 <= len(digits) <= 19 and luhn,
                    "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
                counts[kind] += 1
    return counts, [x[2] for x in sorted(out)]


HARD = ["a@b.co_x@d.ef x@y.com.z@w.com .@a.b a@b", "1.2.3.4.5.6.7.8 0001.2.3.4 256.1.1.1 1.2.3.0000000000000000000255",
        "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111 4111  1111", "+1 (988) 555-2485 +49 30 1234567. +12 ++1234567890 +1(",
        "é漢 a@b.co 漢 1.2.3.4", "x" * 300 + "@" + "y" * 300 + ".com", "@" * 50, "1" * 5000, "1 " * 4000, "1." * 3000, "+1" * 200 + "-" * 400,
        "mail me at joe (at) example (dot) com", "" , "a@b.c" * 40, "1.1.1.1 " * 700]


def test_pii_base_spans(spark, edge, empty):
    small, rows = _documents(spark)
    hard = [(1000 + i, t) for i, t in enumerate(HARD)]
    for df, of in ((small, rows), (edge, EDGE_ROWS), (frame(spark, hard), hard)):
        want = collections.Counter()
        for i, t in of:
            counts, spans = brute_spans(t)
            want[i, counts["email"], counts["ip"], counts["card"], counts["phone"], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
        got = pii.pii_spans(df).collect()
        assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
        texts = collections.defaultdict(list)
        for i, t in of:
            texts[i].append(set(brute_spans(t)[1]))
        assert all(any(s <= set(r.spans.split(",")) for s in texts[r.doc_id]) for r in got)      # base spans stay
    assert pii.pii_spans(empty).collect() == []


def test_pii_adds_what_the_strict_patterns_miss_and_redacts(spark):
    # the card touches the phone: both strict matches fail their checks
    rows = [(i, f"text {i} mail{i}@host.example.com and 4524132264652876 or +1 (269) 555-3296 or 10.1.2.{i}") for i in range(60)]
    rows += [(100, "x +1 (269) 555-3296 4524132264652876 y"), (101, "nothing here 12-34"), (102, None)]
    df = frame(spark, rows)
    got = {r.doc_id: r for r in pii.pii_spans(df).collect()}
    assert "card:20:36" in got[100].spans and "phone:2:19" in got[100].spans and got[100].n_added == 2
    assert got[101].spans == "" and got[102].spans == ""
    clean = {r.doc_id: r for r in pii.redact(df).collect()}
    assert clean[100].text == "x [PHONE] [CARD] y" and clean[101].text == "nothing here 12-34" and clean[102].text is None
    assert clean[0].text == "text 0 [EMAIL] and [CARD] or [PHONE] or [IP]" and clean[0].key == "z"


def test_pii_runs_no_python(spark):
    df, _ = _documents(spark)
    plan = pii.with_candidates(df.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_estimate_prefers_consistent_votes():
    p, _ = pii.estimate({(0, "yyyyy"): 500, (0, "-nnnn"): 300, (0, "-y-y-"): 40, (0, "-n--n"): 60})
    assert p[0, "yyyyy"] > 0.95 and p[0, "-nnnn"] < 0.05 and p[0, "-y-y-"] > 0.5 > p[0, "-n--n"]
    assert PII


def test_pii_cuts_and_running_values(spark):
    text = "é😀x" * 300
    row = spark.createDataFrame([(text, [3, 1, 7, 0, 7, 2] * 200)], "text string, v array<int>").select(
        pii.blocks_of(F.col("text")).alias("b"), "v").select(
        *[pii.cut(F.col("b"), F.lit(a), F.lit(e)).alias(f"c{a}_{e}") for a, e in ((0, 0), (0, 900), (255, 258), (512, 512), (880, 900))],
        pii.running_sum(F.col("v")).alias("sums"), pii.running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("tops")).first()
    assert [row[i] for i in range(5)] == ["", text, text[255:258], "", text[880:900]]
    v = [3, 1, 7, 0, 7, 2] * 200
    assert row.sums == list(itertools.accumulate(v)) and row.tops == list(itertools.accumulate(v, max))


def test_pii_redaction_follows_the_spans(spark):
    """Random texts: the redacted text is what a plain reading of the spans gives, under clashing column names."""
    rng = random.Random(8)
    bits = ["call +33 6 12 34 56 78 ", "a.b@c.org", " card 4111 1111 1111 1111", "10.0.0.1", " 999.1.1.1", "jo (at) ex (dot) com ",
            "(555) 123-4567", "é😀", " word", "\n", "1", "+", "@", " x" * 150]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.choice([1, 6, 60]))), i) for i in range(40)] + [(90, None, 1), (91, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, candidates int")
    spans = {r.doc_id: r.spans for r in pii.pii_spans(df).collect()}
    out = pii.redact(df)
    assert out.columns == df.columns
    for r in out.collect():
        text, at, want = rows[[x[0] for x in rows].index(r.doc_id)][1], 0, ""
        for kind, start, end in (s.split(":") for s in filter(None, spans[r.doc_id].split(","))):
            if int(start) >= at:
                want += text[at:int(start)] + f"[{kind.upper()}]"
            at = max(at, int(end))
        assert r.text == (None if text is None else want + text[at:])


def test_ppm_looks_grams_up_in_parts_whose_sums_are_stored(spark, monkeypatch):
    from aerosift.llm import ppm

    monkeypatch.setattr(ppm, "PAIRS", 3)             # nearly all grams are looked up
    docs = spark.createDataFrame([(i, f"text {i * i} of {i % 5} words " * (i % 4)) for i in range(40)], "doc_id long, text string")
    monkeypatch.setattr(ppm, "SLICES", 1)
    whole = {r.doc_id: r.score for r in ppm.ppm_scores(docs).collect()}
    monkeypatch.setattr(ppm, "SLICES", 3)
    scored = ppm.ppm_scores(docs)
    got = {r.doc_id: r.score for r in scored.collect()}
    assert got.keys() == whole.keys() and all(abs(got[i] - whole[i]) < 1e-9 * max(1, abs(whole[i])) for i in whole)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(") == 1      # the rare words only


def test_ppm_counts_and_looks_up_blocks_of_keys(spark, monkeypatch):
    """Neither the counts nor the documents' grams go through a shuffle as a row for each key."""
    from aerosift.session import materialize

    plans, rows = {}, {}

    def stored(df, name, *more):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        out = materialize(df, name, *more)
        if name == "ppm-scored":
            rows[name] = out.count()
        return out

    monkeypatch.setattr(ppm, "materialize", stored)
    monkeypatch.setattr(ppm, "PAIRS", 3)             # nearly all grams are looked up
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(i, f"text {i * i} of {i % 5} words " * (i % 4)) for i in range(40)], "doc_id long, text string").coalesce(1)
    assert ppm.ppm_scores(docs).count() == 40
    assert rows["ppm-scored"] <= 40 + 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "Window" not in plans["ppm-counts"][0]
    assert len(plans["ppm-sums"]) == ppm.SLICES and not any("explode" in p for p in plans["ppm-sums"])
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch


@pytest.mark.parametrize("parts", [1, 7, 70_000])
def test_ppm_blocks_give_each_document_its_sum_and_its_new_grams(parts):
    import pyarrow as pa
    import pyarrow.compute as pc

    rng = np.random.default_rng(parts)
    keys, docs = rng.integers(0, 1 << 63, 200)[rng.integers(0, 200, 3000)], np.sort(rng.integers(5, 40, 3000)) + (3 << 33)
    model = dict(zip((known := np.unique(keys)[::2]).tolist(), rng.normal(size=len(known)).tolist()))
    asked = ppm.Asked(parts)
    for at in range(0, 3000, 1000):
        asked.add(docs[at:at + 1000], keys[at:at + 1000])
    blocks, found = pa.table(asked.blocks()), []
    for part in set(blocks["part"].to_pylist()):
        own = blocks.filter(pc.equal(blocks["part"], part))
        mine = [k for k in model if ppm.dealt(np.array([k]), ppm._GRAM, parts)[0][0] == part]
        found.append(ppm._look_up(own, pa.table({"key": pa.array(mine, pa.int64()), "log": pa.array([model[k] for k in mine], pa.float64())})))
    want, new = collections.Counter(), collections.Counter()
    out = ppm._add_up(pa.concat_tables(found)).to_pylist()
    for d, k in zip(docs.tolist(), keys.tolist()):
        if k in model:
            want[d] += model[k]
        else:
            new[d, k] += 1
    got = {r["row"]: r["value"] for r in out if r["key"] is None}
    assert got == pytest.approx(dict(want))
    assert sorted((r["row"], r["key"], r["value"]) for r in out if r["key"] is not None) == sorted((*x, n) for x, n in new.items())


def test_ppm_totals_of_a_part_add_blocks_up():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, 400, dtype=np.uint8).tobytes() for _ in range(3)]
    blocks = [ppm.dealt(np.unique(g := ppm.grams_of([t])), ppm._GRAM, 1) + (g,) for t in texts]
    table = pa.concat_tables(pa.table({"keys": ppm.packed(np.unique(g), b), "counts": ppm.packed(np.unique(g, return_counts=True)[1], b)})
                             for _, b, _, g in blocks)
    out = ppm._totals((pa.scalar(ppm._GRAM), pa.scalar(0)), table).to_pydict()
    n = collections.Counter(ppm.grams_of(texts).tolist())
    assert dict(zip(out["key"], out["n"])) == n
    t, d = collections.Counter(), collections.Counter()
    for k, c in n.items():
        t[k >> 9] += c
        d[k >> 9] += 1
    assert [t[k >> 9] for k in out["key"]] == out["t"] and [d[k >> 9] for k in out["key"]] == out["d"]
