"""Registered queries: one thin query per operator over the driver's tables.

``REGISTRY`` maps names to callables (spark, sf_dir) -> DataFrame; ``ORACLE``
holds DuckDB SQL where SQL can express the result on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, filter_audit, lexical, line_dedup, near_dedup, packing, pii, ppm, quality, simhash, suffix_dedup, topk
from .common import table, workers_import

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def register(name: str):
    def deco(fn):
        def query(spark, sf_dir):
            workers_import(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = query
        return query
    return deco


@register("op1_suffix_dedup")
def op1(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_ppm")
def op2(spark, sf_dir):
    return ppm.ppm_scores(table(spark, sf_dir, "documents"))


@register("op3_packing")
def op3(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op4_exact_dedup")
def op4(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op5_near_dedup")
def op5(spark, sf_dir):
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


@register("op6_bpe")
def op6(spark, sf_dir):
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


@register("op7_pii")
def op7(spark, sf_dir):
    return pii.pii_spans(table(spark, sf_dir, "documents"))


@register("op8_line_dedup")
def op8(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op9_topk")
def op9(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op10_quality")
def op10(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_filter_audit")
def op11(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_simhash")
def op12(spark, sf_dir):
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


@register("op13_lexical_search")
def op13(spark, sf_dir):
    return lexical.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op4_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM d JOIN g USING (body)
"""

ORACLE["op8_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), common AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), f AS (SELECT k.*, coalesce(doc_id < last_doc, false) AS dropped FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

ORACLE["op9_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (SELECT body, min(doc_id) AS first_id FROM d GROUP BY body),
good AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         len(words) < 200 AS A, 100 * len(list_distinct(words)) < 50 * len(words) AS B,
         100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 2 * length(body) AS C,
         regexp_matches(body, '[#$%&*|]') AS D, coalesce(d.doc_id > first_id, false) AS E, count(*) AS n
  FROM d JOIN firsts USING (body) LEFT JOIN good ON good.doc_id = d.doc_id GROUP BY ALL
), fails AS (
  SELECT *, CASE letter WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END AS failed,
         A::INT + B::INT + C::INT + D::INT + E::INT AS n_failed
  FROM cells, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS l(letter)
), orders AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS b),
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c), (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS d),
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step:step] AS letter, filter_order[1:step - 1] AS before
             FROM orders, range(1, 6) AS r(step)),
audited AS (
  SELECT part, filter_order, step, s.letter, failed, good, toxic, n, n_failed,
         (A AND contains(before, 'A')) OR (B AND contains(before, 'B')) OR (C AND contains(before, 'C'))
         OR (D AND contains(before, 'D')) OR (E AND contains(before, 'E')) AS gone
  FROM steps s JOIN fails f ON s.letter = f.letter
), summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (failed AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (failed AND n_failed = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (failed AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (failed AND NOT gone AND toxic), 0) AS toxic_lost
  FROM audited GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""

ORACLE["op13_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (SELECT r, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM sizes) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * total.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, total.docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * total.docs) // total.terms)))) AS BIGINT) AS score
  FROM items JOIN w USING (term) JOIN tf USING (term), total GROUP BY item_id, r, doc_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op1_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d)
), gone AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM strings) WHERE nth > 1
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
      SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM gone))
  GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_b,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last_b + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLE["op5_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                                 WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
), sizes AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(r, other) AS (SELECT r, r FROM w UNION SELECT reach.r, links.y FROM reach JOIN links ON links.x = reach.other),
least AS (SELECT reach.r AS r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.other GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN least USING (r) LEFT JOIN sizes USING (r)
"""
