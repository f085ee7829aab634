"""Personal data by weak supervision, in DataFrame expressions only.

1. Candidates. Per kind, the strict pattern with its check gives the base
   spans; a wider pattern (written-out addresses, card numbers and phone numbers
   that touch other digits) gives further candidates.
2. Labelers vote yes, no or nothing on each candidate: the strict pattern, the
   check of the digits or parts, a gazetteer (top-level domains, country codes,
   issuer digits, reserved networks), words before the span, and its edges.
3. Votes are counted per kind and vote pattern over all documents (a bounded
   number of patterns). Expectation-maximisation on these counts estimates how
   often each labeler is right on true and on false candidates.
4. The final span classifier learns, from the estimated labels of all
   candidates, how likely each span shape is, and adds that to the votes' log
   odds. Candidates above ``ACCEPT`` are spans. Base spans always stay.

Offsets are code points of the whole text, ends exclusive. Offsets come from the
lengths of what lies between matches, found in one linear pass of a pattern
``(gap)(match or end)``; character runs are matched possessively, so
long runs cost neither stack nor repeated scans. What lies around a span is cut from
blocks of the text, and overlaps are found by running maxima over sorted spans, so
the work on a text with many matches grows with its length.

Defined results: a null text is empty and has no spans. Rows with equal or null
ids each get their own result. With no candidates at all nothing is learned and
only base spans (none) are returned. Further columns are ignored. A text of any
length is read whole, by one task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import one_row_per_doc

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5
#: Code points in a block of text; a span's surroundings are cut from one or two.
BLOCK = 256

_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]"
#: Strict patterns. A run of local characters or digits starts at its first character after the last match.
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\(at\)|\[at\]|@) ?{_DOMAIN}++(?: ?(?:\(dot\)|\[dot\]|\.) ?{_DOMAIN}++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9])(?:[0-9]{4}([ -]?)[0-9]{4}\3[0-9]{4}\3[0-9]{1,4}|[0-9]{12,19})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ -])[0-9]{3}-[0-9]{4}(?![0-9])",
}
#: What a text must hold for a kind's patterns to be tried at all.
TRIGGER = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]+\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "card": r"[0-9](?:[ -]?[0-9]){11}",
           "phone": r"\+[0-9]|[0-9]{3}-[0-9]{4}"}
#: Fixed word lists of the gazetteer and context labelers.
TLDS = ("com org net edu gov mil int info biz io ai co me app dev de fr es uk eu it nl be ch at pt pl se no dk fi ie us ca mx br "
        "ar cl au nz jp kr cn in ru ua tr za").split()
COUNTRY_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 "
                 "92 351 352 353 354 358 380 420 421 971 972").split()
CUES = {"email": r"(?i)mail|contact|write to|correo|courriel|adresse", "ip": r"(?i)\bip\b|host|server|address|login",
        "card": r"(?i)card|visa|master|amex|credit|karte|carte|tarjeta", "phone": r"(?i)phone|call|tel|fax|mobile|telefon|llam"}
ANTI_CUES = r"(?i)version|isbn|invoice|order no|page|section|doi|build|rfc"
LABELERS = ("strict", "check", "gazetteer", "context", "edges")


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Prefix results of an associative ``op`` over an array of non-negative ints (0 is its neutral value), in chunks so
    that appending stays cheap."""
    chunk = 512

    def fold(xs, first, inclusive):
        start = F.struct(first.alias("s"), F.array().cast("array<int>").alias("a"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(
            op(acc["s"], x).alias("s"), F.concat(acc["a"], F.array(op(acc["s"], x) if inclusive else acc["s"])).alias("a")))["a"]

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / chunk).cast("int")),
                         lambda i: F.slice(values, i * chunk + 1, chunk))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, b: op(a, b)))
    return F.flatten(F.zip_with(chunks, fold(totals, F.lit(0), False), lambda c, first: fold(c, first, True)))


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def blocks_of(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points start..end of the text that ``blocks`` make up; reads only the blocks that hold them."""
    first = (start / BLOCK).cast("int")
    last = (F.greatest(end - 1, start) / BLOCK).cast("int")
    return F.substr(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""), start - first * BLOCK + 1,
                    F.greatest(end - start, F.lit(0)))


def with_matches(df: DataFrame, name: str, pattern: str, wanted: Column) -> DataFrame:
    """Add ``name``: array of (start, end, s) of the pattern's matches in column text, leftmost, not overlapping."""
    whole = rf"(?s)(.*?)(?:({pattern})|\z)"
    none = F.array().cast("array<string>")
    found = df.withColumns({f"_{name}_g": F.when(wanted, F.regexp_extract_all("text", F.lit(whole), 1)).otherwise(none),
                            f"_{name}_m": F.when(wanted, F.regexp_extract_all("text", F.lit(whole), 2)).otherwise(none)})
    g, m = F.col(f"_{name}_g"), F.col(f"_{name}_m")
    found = found.withColumn(f"_{name}_e", running_sum(F.zip_with(g, m, lambda a, b: F.length(a) + F.length(b))))
    spans = F.zip_with(m, F.col(f"_{name}_e"), lambda s, e: F.struct(
        (e - F.length(s)).cast("int").alias("start"), e.cast("int").alias("end"), s.alias("s")))
    return found.withColumn(name, F.filter(spans, lambda x: x["end"] > x["start"])).drop(
        f"_{name}_g", f"_{name}_m", f"_{name}_e")


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
        return total + twice

    return (F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0) & (digits != "")


def parts_at_most_255(s: Column) -> Column:
    bare = F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def passes(kind: str, s: Column) -> Column:
    """The contract's check on a strict match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return parts_at_most_255(s)
    digits = digits_of(s)
    return F.length(digits).between(12, 19) & luhn(digits) if kind == "card" else F.length(digits).between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "y").when(no, "n").otherwise("-")


def _gazetteer(kind: str, s: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(s, r"([A-Za-z0-9-]+)\z", 1)).isin(TLDS)
        return _vote(known, ~known)
    if kind == "ip":
        reserved = s.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\.") | s.rlike(r"^[0-9]\.[0-9]\.[0-9]\.[0-9]\z")
        return _vote(~reserved, reserved)
    if kind == "card":
        issuer = digits_of(s).rlike("^(?:4|5[1-5]|2[2-7]|3[0-9]|6)")
        return _vote(issuer, ~issuer)
    code = F.regexp_extract(s, r"^\+([0-9]{1,3})", 1)
    known = F.exists(F.array(*[F.lit(c) for c in COUNTRY_CODES]), lambda c: code.startswith(c))
    return _vote((code != "") & known, (code != "") & ~known)


def _check(kind: str, s: Column) -> Column:
    digits = digits_of(s)
    if kind == "email":
        ok = s.rlike(r"[A-Za-z]{2,}\z")
    elif kind == "ip":
        ok = F.when(s.contains(":"), F.lit(True)).otherwise(parts_at_most_255(s))
    elif kind == "card":
        ok = F.length(digits).between(12, 19) & luhn(digits)
    else:
        ok = F.length(digits).between(9, 15)
    return _vote(ok, ~ok)


def _candidate(kind: str, is_base: Column, x: Column) -> Column:
    s, blocks = x["s"], F.col("_blocks")
    before = cut(blocks, F.greatest(x["start"] - 40, F.lit(0)), x["start"])
    around = F.concat(F.right(before, F.lit(1)), cut(blocks, x["end"], x["end"] + 1))
    inside_word = around.rlike(r"[\p{L}\p{N}]")
    votes = F.concat(F.when(is_base, "y").otherwise("-"), _check(kind, s), _gazetteer(kind, s),
                     _vote(before.rlike(CUES[kind]), before.rlike(ANTI_CUES)), _vote(~inside_word, inside_word))
    shape = F.concat_ws("/", F.least(F.floor(F.length(s) / 5), F.lit(6)).cast("string"),
                        F.floor(F.length(digits_of(s)) * 3 / F.length(s)).cast("string"),
                        F.when(s.rlike(r"[ ()-]"), "s").otherwise("."))
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), is_base.alias("base"),
                    votes.alias("votes"), shape.alias("shape"))


def _passing(kind: str) -> Column:
    return F.filter(f"_{kind}", lambda x: passes(kind, x["s"]))


def _apart(kind: str) -> Column:
    """Wide matches that overlap no strict one of their kind: the strict ones win.

    Both lists are sorted and free of overlaps, so a wide match can only meet the last strict one that starts no later
    (its end is the running maximum) and the next entry of the merged list."""
    both = F.col(f"_{kind}_both")
    # zipped, not looked up: an array that only a lambda refers to would be computed anew for each element
    reach = F.zip_with(both, F.col(f"_{kind}_ends"), lambda x, e: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["s"].alias("s"), x["wide"].alias("wide"), e.alias("reach")))

    def free(x, i):
        after = F.get(both, i + 1)
        return (x["wide"] == 1) & (x["reach"] <= x["start"]) & ~F.coalesce(
            (after["wide"] == 0) & (after["start"] < x["end"]), F.lit(False))

    return F.transform(F.filter(reach, free), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["s"].alias("s")))


def _merged(kind: str) -> Column:
    """Strict (wide = 0) and wide (1) matches by start, at equal starts the strict one first."""
    def marked(name, wide):
        return F.transform(name, lambda x: F.struct(x["start"].alias("start"), F.lit(wide).alias("wide"), x["end"].alias("end"), x["s"].alias("s")))

    return F.array_sort(F.concat(marked(f"_{kind}", 0), marked(f"_{kind}_wide", 1)))


def _candidates(kind: str, name: str, base: bool) -> Column:
    return F.transform(name, lambda x: _candidate(kind, F.lit(base), x))


def with_candidates(docs: DataFrame) -> DataFrame:
    """Add ``candidates`` to rows with a column ``text`` that holds no nulls."""
    columns = []
    docs = docs.withColumns({f"_{kind}_wanted": F.col("text").rlike(TRIGGER[kind]) for kind in KINDS})
    docs = docs.withColumn("_blocks", F.when(F.greatest(*[F.col(f"_{kind}_wanted") for kind in KINDS]), blocks_of(F.col("text")))
                           .otherwise(F.array().cast("array<string>")))
    for kind in KINDS:
        wanted = F.col(f"_{kind}_wanted")
        docs = with_matches(docs, f"_{kind}", STRICT[kind], wanted)
        docs = with_matches(docs, f"_{kind}_wide", WIDE[kind], wanted)
        docs = docs.withColumn(f"_{kind}", _passing(kind)).withColumn(f"_{kind}_both", _merged(kind))
        docs = docs.withColumn(f"_{kind}_ends", running(F.transform(f"_{kind}_both", lambda x: F.when(
            x["wide"] == 0, x["end"]).otherwise(0)), F.greatest)).withColumn(f"_{kind}_wide", _apart(kind))
        columns += [_candidates(kind, f"_{kind}", True), _candidates(kind, f"_{kind}_wide", False)]
    return docs.withColumn("candidates", F.array_sort(F.concat(*columns), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]).cast("int"))).drop(
        "_blocks", *[f"_{k}{x}" for k in KINDS for x in ("", "_wide", "_wanted", "_both", "_ends")])


# ---- learning on counted vote patterns (driver; bounded number of patterns) ----

def estimate(counted: dict[tuple[int, str], float], rounds: int = 60) -> tuple[dict, dict]:
    """Expectation-maximisation per kind: (kind, votes) -> probability, and the labelers' reliabilities."""
    posterior, reliability = {}, {}
    for kind in sorted({k for k, _ in counted}):
        rows = [(v, n) for (k, v), n in counted.items() if k == kind]
        # start from the majority of votes
        p = {v: min(0.95, max(0.05, 0.5 + 0.2 * (v.count("y") - v.count("n")))) for v, _ in rows}
        for _ in range(rounds):
            prior = (sum(n * p[v] for v, n in rows) + 1) / (sum(n for _, n in rows) + 2)
            table = []
            for j in range(len(LABELERS)):
                one, zero = defaultdict(lambda: 0.5), defaultdict(lambda: 0.5)
                for v, n in rows:
                    one[v[j]] += n * p[v]
                    zero[v[j]] += n * (1 - p[v])
                # labelers are better than chance: a prior of one right vote each way
                one["y"] += 1
                zero["n"] += 1
                table.append({c: (one[c] / sum(one[x] for x in "yn-"), zero[c] / sum(zero[x] for x in "yn-")) for c in "yn-"})
            for v, _ in rows:
                odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][c][0] / table[j][c][1]) for j, c in enumerate(v))
                p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        reliability[kind] = (prior, table)
        posterior.update({(kind, v): p[v] for v, _ in rows})
    return posterior, reliability


def fit(candidates: DataFrame) -> dict[str, float]:
    """'kind|votes|shape' -> probability, from all candidates (column ``candidates``)."""
    counts = candidates.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(
        F.count("*").alias("n")).collect()      # bounded: kinds x vote patterns x shapes
    by_votes: dict[tuple[int, str], float] = defaultdict(float)
    for r in counts:
        by_votes[r["kind"], r["votes"]] += r["n"]
    posterior, reliability = estimate(by_votes)
    ones, total = defaultdict(lambda: 0.5), defaultdict(lambda: 1.0)
    for r in counts:
        ones[r["kind"], r["shape"]] += r["n"] * posterior[r["kind"], r["votes"]]
        total[r["kind"], r["shape"]] += r["n"]
    logit = lambda x: math.log(x / (1 - x))
    clip = lambda x: min(1 - 1e-9, max(1e-9, x))
    out = {}
    for r in counts:
        k = r["kind"]
        shape = ones[k, r["shape"]] / total[k, r["shape"]]
        odds = logit(clip(posterior[k, r["votes"]])) + logit(clip(shape)) - logit(clip(reliability[k][0]))
        out[f"{k}|{r['votes']}|{r['shape']}"] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return out


def accepted(model: dict[str, float], accept: float = ACCEPT) -> Column:
    """The spans among ``candidates``: base ones, and those that the classifier accepts."""
    good = [k for k, p in sorted(model.items()) if p >= accept]
    key = lambda c: F.concat_ws("|", c["kind"].cast("string"), c["votes"], c["shape"])
    return F.filter("candidates", lambda c: c["base"] | (key(c).isin(good) if good else F.lit(False)))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(
        ":", F.element_at(kinds, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda c: c["kind"] == kind)


def pii_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts per kind, base_sha256, spans, n_added."""
    found = materialize(with_candidates(one_row_per_doc(docs, doc_id, text)).select("doc_id", "candidates"), "pii-candidates")
    spans = accepted(fit(found))
    base = F.filter("candidates", lambda c: c["base"])
    counts = [F.size(_of_kind(base, i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                        _listed(spans).alias("spans"), (F.size(spans) - F.size(base)).cast("long").alias("n_added"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets, e.g. ``[EMAIL]``.

    Overlapping spans become one replacement, named after the first. A null text stays null. The rows are stored with
    their candidates, so that each pattern runs once; their columns must be of types that Parquet holds."""
    names = [c for c in docs.columns if c != text]
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(F.struct(F.col(f"`{text}`").isNull().alias("null"), *kept).alias("_rest"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = materialize(with_candidates(rows), "pii-candidates")
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    found = found.withColumn("_spans", accepted(fit(found)))
    found = found.withColumn("_ends", running(F.transform("_spans", lambda c: c["end"]), F.greatest)).withColumn(
        "_blocks", F.when(F.size("_spans") > 0, blocks_of(F.col("text"))).otherwise(F.array().cast("array<string>")))

    def piece(c, i):
        at = F.when(i > 0, F.get("_ends", i - 1)).otherwise(0)       # how far the spans before reach
        return F.when(c["start"] >= at, F.concat(cut(F.col("_blocks"), at, c["start"]), F.element_at(marks, c["kind"] + 1))).otherwise("")

    clean = F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.concat(
        F.array_join(F.transform("_spans", piece), ""), cut(F.col("_blocks"), F.element_at("_ends", -1), F.length("text"))))
    out = {c: F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(names)}
    out[text] = F.when(~F.col("_rest.null"), clean).alias(text)
    return found.select(*[out[c] for c in docs.columns])
