"""One query per operator, over its whole table, and the DuckDB SQL for it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.adapter import read_table
from .bpe import bpe_round_trip
from .centroids import clusters
from .fingerprint import as_text, edited_fingerprints, likeness
from .html_text import main_text
from .importance import resample
from .langid import languages
from .mixing import mix
from .near_dup import near_duplicates
from .substring import near_passages
from .token_files import token_files
from .topk import top_k
from .toxicity import crc_bucket, toxicity
from .warc import page_of, read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@register("op1_exact_top_k", """
WITH v AS (SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op1(spark, sf):
    vectors = read_table(spark, sf, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@register("op2_fingerprints")
def op2(spark, sf):
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited_fingerprints(read_table(spark, sf, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(own).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"))


@register("op3_warc_salvage", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM m""")
def op3(spark, sf):
    path = scratch_path(spark, "llm-archives")
    write_archives(read_table(spark, sf, "pages"), path)
    found = read_archives(spark, path, bodies=False).filter(~F.col("quarantined"))
    return found.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


@register("op4_mixing")
def op4(spark, sf):
    mixed, names = mix(read_table(spark, sf, "documents"))
    return mixed.select("doc_id", "source", "lang", *[F.col(names[n]).alias(n) for n in ("topic", "tokens", "probability", "kept")])


@register("op5_toxicity")
def op5(spark, sf):
    docs = read_table(spark, sf, "documents")
    scored = toxicity(docs, read_table(spark, sf, "labels"), learn=crc_bucket(F.col("doc_id"), 5) != 0)
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@register("op6_minhash_near_dup")
def op6(spark, sf):
    return near_duplicates(read_table(spark, sf, "documents"), k=4, percent=80)


@register("op7_compact_windows")
def op7(spark, sf):
    return near_passages(read_table(spark, sf, "documents"))


@register("op8_bpe")
def op8(spark, sf):
    out = bpe_round_trip(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("text", 256).alias("decoded_sha256"))


@register("op9_token_files")
def op9(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files(read_table(spark, sf, "documents"), path, scratch_path(spark, "llm-token-files"), end_id=2)


@register("op10_language_id")
def op10(spark, sf):
    bucket = crc_bucket(F.col("doc_id"), 4)
    out = languages(read_table(spark, sf, "documents"), learn=bucket != 2)
    return out.select("doc_id", (bucket == 2).alias("held_out"), "lang_pred", "score")


@register("op11_html_text", """
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '(?s)</?(p|h1)>', chr(1), 'g') AS body FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), chr(1)) AS parts FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t""")
def op11(spark, sf):
    return main_text(read_table(spark, sf, "pages"))


def _cluster_rounds(rounds: int) -> str:
    """Assignments a0, a1, ... and centroids c1, c2, ... as one chain of DuckDB tables."""
    assign = ("a{0} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS best FROM (SELECT k.r, c.c, CAST(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS BIGINT) AS d "
              "FROM k, c{0} c) GROUP BY r)")
    move = ("c{1} AS MATERIALIZED (SELECT c{0}.c, coalesce(m.v, c{0}.v) AS v FROM c{0} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM "
            "(SELECT a.best.c AS c, i, sum(k.v[i]) AS s, count(*) AS n FROM a{0} a JOIN k USING (r), range(1, 65) t(i) GROUP BY 1, 2) GROUP BY c) m USING (c))")
    parts = [part.format(n, n + 1) for n in range(rounds) for part in (assign, move)]
    return ",\n".join([*parts, assign.format(rounds)])


@register("op12_centroid_clustering", f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM k WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 40)),
{_cluster_rounds(5)}
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN k USING (r) JOIN c5 ON c5.c = best.c""")
def op12(spark, sf):
    return clusters(read_table(spark, sf, "embeddings"), k=40, rounds=5)


_WORD_LIST = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@register("op13_importance_resampling", f"""
WITH tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) x(i))),
d AS MATERIALIZED (SELECT doc_id, {_WORD_LIST} AS w FROM documents),
dw AS MATERIALIZED (SELECT doc_id, unnest(w) AS w FROM d),
bw AS MATERIALIZED (SELECT unnest({_WORD_LIST}) AS w FROM benchmark),
h AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw))),
b AS MATERIALIZED (SELECT w, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                                             lambda c, byte: xor(c >> 8, t[CAST(xor(c, byte) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS bucket FROM h, tab),
s AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS s FROM dw JOIN b USING (w) GROUP BY bucket),
t AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM bw JOIN b USING (w) GROUP BY bucket),
g AS MATERIALIZED (SELECT i AS bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM dw) + 10000.0::DOUBLE) / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM bw) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
     FROM range(10000) x(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
m AS (SELECT doc_id, sum(gain) AS total, count(*) AS n FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY doc_id),
e AS (SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
f AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM f)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM f WHERE n_features >= 20) // 100 THEN place END AS BIGINT) AS rank FROM r""")
def op13(spark, sf):
    return resample(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
