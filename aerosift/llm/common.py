"""Small pieces shared by the operators of this subpackage."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here: space and the controls 0x09-0x0D.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The whole text; a null text is the empty text."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z only. Pure ASCII strings take the fast path of ``lower``."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null, in no fold)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_row_per_doc(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text) only, so that further columns of any name cannot clash."""
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))


def sum_rows(frame: DataFrame) -> DataFrame:
    """(i, v array) -> element sums per i; tasks add up their own rows first."""
    def add(batches):
        held = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy()
                held[i] = held[i] + v if i in held else v
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                              pa.array([v for v in held.values()], pa.list_(pa.float64()))], ["i", "v"])

    kind = "i int, v array<double>"
    return frame.mapInArrow(add, kind).repartition("i").mapInArrow(add, kind)


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For local mode and shared installations; elsewhere pass ``--py-files`` to spark-submit."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
