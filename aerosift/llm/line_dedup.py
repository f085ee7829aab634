"""Line dedup: range-partitioned line hashes and per-document keep bitmaps.

DataFrame operations only. Every line's key (white space stripped at both ends,
A-Z lower-cased) of at least ``min_chars`` code points is hashed (SHA-256, so
equal hashes are equal keys). Hashes are range-partitioned by (hash, document)
and sorted by (hash, document, position) inside each partition, so a key that
a third of all documents hold is spread over many partitions. One pass over
that order gives a row per (key, document) with its positions; counts and the
last document of each key are partial sums per partition before they meet. Keys found in
at least ``min_docs`` documents lose their lines everywhere but in the largest
doc_id. What each document loses comes back as a run-length compressed keep
bitmap (``keep_runs``: start and length of the runs of kept lines), not as text.

Defined results: a null or empty text has one empty line and loses nothing.
Rows that repeat a doc_id count as one document for the key counts, but each
text (told apart by a hash, the version) loses its own positions only; a null doc_id holds no keys and loses
nothing. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, lower_ascii, one_row_per_doc

MIN_CHARS, MIN_DOCS = 40, 5


def version(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def line_positions(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id, places) for each long line key of each document; a place is a version and a position."""
    line = docs.where("doc_id IS NOT NULL AND length(text) >= %d" % min_chars).select(
        "doc_id", version(F.col("text")).alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.btrim(F.col("line"), F.lit(SPACES))
    keyed = line.where(F.length(key) >= min_chars).select(
        F.unhex(F.sha2(lower_ascii(key).cast("binary"), 256)).alias("key"), "doc_id", "version", "pos")
    ranged = keyed.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "pos")
    return ranged.groupBy("key", "doc_id").agg(F.collect_set(F.struct("version", "pos")).alias("places"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, version, drops, keep_runs): sorted dropped positions and the runs of lines
    between them; only texts that lose a line have a row. The last run's
    length is open (-1), as the row does not know how many lines follow."""
    held = materialize(line_positions(docs, min_chars), "line-positions")     # read twice below
    common = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")).where(
        F.col("n_docs") >= min_docs).select("key", "last_doc")
    common = materialize(common, "line-common")      # a written side leaves a hot key of the join to be split
    drops = held.join(common, "key").where("doc_id < last_doc").select("doc_id", F.explode("places").alias("place")).groupBy(
        "doc_id", F.col("place.version").alias("version")).agg(F.sort_array(F.collect_set("place.pos")).alias("drops"))
    starts = F.concat(F.array(F.lit(0)), F.transform("drops", lambda p: p + 1))
    ends = F.concat(F.col("drops"), F.array(F.lit(-1)))
    runs = F.transform(F.arrays_zip(starts.alias("start"), ends.alias("stop")), lambda r: F.struct(
        r["start"].alias("start"), F.when(r["stop"] < 0, -1).otherwise(r["stop"] - r["start"]).alias("n")))
    return drops.select("doc_id", "version", "drops", F.filter(runs, lambda r: r["n"] != 0).alias("keep_runs"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
               min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, keep_runs, kept_text."""
    base = one_row_per_doc(docs, doc_id, text)
    bitmaps = keep_bitmaps(base, min_chars, min_docs)
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
        "keep_runs", lambda r: F.slice("lines", r["start"] + 1, F.when(r["n"] < 0, F.greatest(
            F.size("lines") - r["start"], F.lit(0))).otherwise(r["n"])))), "\n"))
    joined = base.withColumn("version", version(F.col("text"))).join(bitmaps, ["doc_id", "version"], "left").withColumn("lines", lines)
    lost = F.size(F.filter("drops", lambda p: p < F.size("lines")))
    return joined.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(lost).cast("long").alias("n_dropped"),
        "keep_runs", kept.alias("kept_text"))
