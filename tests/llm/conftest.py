import pytest
from pyspark.sql import types as T

#: Extra columns whose names the operators use inside.
CLASH = ["key", "n", "bands", "odd", "place", "cid", "row", "digest", "body", "lines", "candidates", "stats", "doc", "version",
         "start", "shard", "length", "kept", "rest", "score", "keep_id", "_spans"]

LONG = "lorem ipsum dolor sit amet consectetur " * 3000
LINE = "this line is long enough to be a key of the dedup\n"
PII = "Write to a.b@mail.example.com or call +1 (269) 555-3296 4524132264652876 from 10.1.2.3, not 300.1.1.1."

EDGE_ROWS = [
    (1, None), (2, ""), (3, "   \t\n "), (4, "one two"), (5, "One  TWO"), (6, "one two"), (7, LONG), (8, LONG + "tail words here"),
    (9, LINE * 3 + "a"), (10, LINE + "b"), (11, "x\n" + LINE), (12, LINE), (13, LINE + LINE.upper()), (14, PII), (15, "é" * 200 + " ñandú 漢字 " * 30),
    (16, "a" * 5000), (17, "ab" * 300), (18, PII), (18, PII), (19, "one two"), (19, "another text under the same id"), (None, "no id"),
    (None, "one two"), (20, "\x00\x1c strange \x85 spaces 　 here"), (21, "word " * 4), (22, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
    (23, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w13"), (24, "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
]


@pytest.fixture(scope="session", autouse=True)
def llm_workers(spark):
    from aerosift.llm.common import workers_import

    workers_import(spark)


def frame(spark, rows):
    kinds = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
             T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    kinds += [T.StructField(c, T.StringType()) for c in CLASH]
    full = [(i, t, None, "src0", None if t is None else len(t), *["z"] * len(CLASH)) for i, t in rows]
    return spark.createDataFrame(full, T.StructType(kinds))


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE_ROWS)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
