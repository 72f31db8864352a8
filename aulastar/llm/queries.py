"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.llm import centroids, conversations, decontaminate, exact_dedup, html_extract, langid, mixing, ppm, quality, simhash, suffix_dedup, toxicity, word_bpe

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = f"regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = langid.predicted(docs, langid.fit(docs))
    return got.select("doc_id", quality.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", quality.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_corpus(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    got = word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_suffix_dedup, op3_language_id, op4_quality, op5_mixing, op6_html_extraction, op7_toxicity, op8_simhash, op9_lm_scoring, op10_exact_dedup,
                                op11_bpe, op12_centroid_clustering, op13_conversation_repair)
}

OP1_SQL = f"""
WITH w AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
 q AS (SELECT item_id, w, least(5, len(w)) AS k FROM w WHERE len(w) > 0),
 qs AS (SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS s FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM q)),
 qn AS (SELECT item_id, count(*) AS n_item FROM qs GROUP BY 1),
 d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
 ds AS (SELECT DISTINCT doc_id, list_slice(w, i, i + k - 1) AS s FROM (
   SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM qs) WHERE len(w) >= k)),
 m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN qs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM m JOIN qn USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9
"""

OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
 s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
 s1 AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) + 1] AS w FROM s0),
 s2 AS (SELECT *, 3 * source_size AS cap FROM s1),
 tot AS (SELECT sum(source_size)::BIGINT AS t FROM s2),
 -- one round of resharing per step: a source whose share passes its cap is full from then on
 water AS (
   SELECT 0 AS step, (SELECT t FROM tot)::DOUBLE / (SELECT sum(w) FROM s2)::DOUBLE AS lev
   UNION ALL
   SELECT step + 1, (SELECT t - (SELECT coalesce(sum(cap), 0) FROM s2 WHERE lev * w >= cap)::BIGINT FROM tot)::DOUBLE
                    / (SELECT sum(w) FROM s2 WHERE lev * w < cap)::DOUBLE
   FROM water WHERE step < 60 AND EXISTS (SELECT 1 FROM s2 WHERE lev * w < cap)),
 lvl AS (SELECT max(lev) AS lev FROM water),
 s3 AS (SELECT source, source_size, CASE WHEN lev * w >= cap THEN cap::DOUBLE ELSE lev * w END AS target FROM s2, lvl),
 s4 AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM s3),
 s5 AS (SELECT *, (rate - floor(rate)) * source_size AS goal FROM s4),
 b AS (SELECT *, floor(('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix-1'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE * 4096)::INTEGER AS bin FROM d),
 bw AS (SELECT source, bin, sum(size) AS words FROM b GROUP BY 1, 2),
 cum AS (SELECT source, bin + 1 AS k, sum(words) OVER (PARTITION BY source ORDER BY bin) AS upto FROM bw),
 e AS (SELECT s5.source, k, abs(upto::DOUBLE - goal) AS off FROM s5 JOIN cum ON s5.source IS NOT DISTINCT FROM cum.source
       UNION ALL SELECT source, 0, goal FROM s5),
 pick AS (SELECT source, k FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY off, k) AS rn FROM e) WHERE rn = 1)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN bin < k THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM b JOIN s5 ON b.source IS NOT DISTINCT FROM s5.source JOIN pick ON b.source IS NOT DISTINCT FROM pick.source
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
 g AS (SELECT n, count(*) AS group_size, arg_min(doc_id, (-length(t), doc_id)) AS keep_id FROM d GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM d JOIN g USING (n)
"""

NEAREST_SQL = """p{n} AS MATERIALIZED (SELECT row, id, v, c, d FROM (
   SELECT *, row_number() OVER (PARTITION BY row ORDER BY d, c) AS rn
   FROM (SELECT x.row, x.id, x.v, k.c, list_sum(list_transform(range(1, 65), lambda i: ((x.v[i] - k.v[i])::HUGEINT * (x.v[i] - k.v[i])::HUGEINT))) AS d FROM x, c{n} k)) WHERE rn = 1)"""

MOVED_SQL = """c{m} AS MATERIALIZED (SELECT k.c, coalesce(g.v, k.v) AS v FROM c{n} k LEFT JOIN (
   SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS v
   FROM (SELECT c, i, sum(x::HUGEINT) AS s, count(*)::HUGEINT AS n FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM p{n}) GROUP BY 1, 2) GROUP BY 1) g USING (c))"""

OP12_SQL = f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
   WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
 c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || id::VARCHAR) AS h, v FROM x WHERE id IS NOT NULL ORDER BY h, v LIMIT 16)),
 {NEAREST_SQL.format(n=0)}, {MOVED_SQL.format(n=0, m=1)}, {NEAREST_SQL.format(n=1)}, {MOVED_SQL.format(n=1, m=2)}, {NEAREST_SQL.format(n=2)}, {MOVED_SQL.format(n=2, m=3)}, {NEAREST_SQL.format(n=3)}
SELECT id AS vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
   sha256(array_to_string(list_transform(c3.v, lambda y: y::VARCHAR), ',')) AS centroid_sha256
FROM p3 JOIN c3 USING (c)
"""

ORACLE: dict[str, str] = {"op1_decontamination": OP1_SQL, "op5_mixing": OP5_SQL, "op10_exact_dedup": OP10_SQL, "op12_centroid_clustering": OP12_SQL}
