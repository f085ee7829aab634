"""Registered queries against their DuckDB SQL, and the pipeline stage by stage."""

import collections

import duckdb
import pytest

import corpus_pipeline
from aerosift.llm import queries

from ..conftest import SF_SMALL
from .test_dedup import brute_exact, brute_near

CONTRACTS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_ppm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op5_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_topk": ["query_id", "rank", "vec_id", "score"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
}


def test_each_operator_has_its_query():
    assert [f"op{n}_" for n in range(1, 14)] == [k[:k.index("_") + 1] for k in sorted(queries.REGISTRY, key=lambda k: int(k[2:k.index("_")]))]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.REGISTRY[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    rows = collections.Counter(tuple(r[c] for c in want.columns) for r in got.collect())
    assert rows == collections.Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns(spark, name):
    got = queries.REGISTRY[name](spark, SF_SMALL)
    assert got.columns[:len(CONTRACTS[name])] == CONTRACTS[name]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kinds = docs.columns, docs.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF_SMALL)
        out = corpus_pipeline.materialize(out, f"test-{name}")
        if name != "packing":
            assert out.columns == columns and out.dtypes == kinds
        ids = sorted(r.doc_id for r in out.collect())
        if name == "quality":
            assert 0.6 * len(before) < len(ids) < len(before)
        elif name == "exact_dedup":
            assert ids == sorted(k[0] for k in brute_exact(before) if k[3])
        elif name == "near_dedup":
            assert ids == sorted(k[0] for k in brute_near(before) if k[3])
        else:
            assert ids == sorted(i for i, _ in before)
        docs = out
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == ids


def test_pipeline_of_edge_rows_and_nothing(spark, edge, empty):
    for docs in (edge.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= docs.count()
            docs = out
