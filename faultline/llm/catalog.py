"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from faultline.llm import bpe_codec, exact_dedup, hard_negatives, kd_search, language_id, language_model, mixing, packing, pivot_clusters, simhash, suffix_dedup, token_counts, toxicity
from faultline.llm.shared import remainder, table


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_kd_search(spark, sf_dir):
    return kd_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_model(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scores = toxicity.score(docs, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe_codec(spark, sf_dir):
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_pareto_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, moved)


def op13_pivot_clusters(spark, sf_dir):
    return pivot_clusters.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {x.__name__: x for x in (op1_language_id, op2_kd_search, op3_simhash, op4_language_model, op5_packing, op6_exact_dedup, op7_toxicity, op8_bpe_codec, op9_suffix_dedup, op10_token_counts, op11_pareto_mix, op12_hard_negatives, op13_pivot_clusters)}

def _rounds(n: int) -> str:
    """SQL of ``n`` rounds of moving 40 centroids, and the last assignment ``a``."""
    near = lambda r: f"""
        SELECT vec_id, n, v, arg_min(c, (d, c)) AS c, min(d) AS d
        FROM (SELECT e.vec_id, e.n, e.v, k.c, CAST(list_sum(list_transform(list_zip(e.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM e, k{r} k)
        GROUP BY vec_id, n, v"""
    parts = []
    for r in range(n):
        parts.append(f"""a{r} AS ({near(r)}), s{r} AS (
            SELECT c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS m FROM a{r}, range(1, 65) t(i) GROUP BY c, i
        ), m{r} AS (SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY c),
        k{r + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM k{r} k LEFT JOIN m{r} m ON k.c = m.c)""")
    return ", ".join([*parts, f"a AS ({near(n)})"])


ORACLES = {
    "op2_kd_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op11_pareto_mix": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS draw
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS words, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS part
            FROM d GROUP BY source
        ), ordered AS (
            SELECT *, coalesce(sum(2 * words) OVER earlier, 0) AS held, sum(part) OVER () - coalesce(sum(part) OVER earlier, 0) AS open,
                   1.5::DOUBLE * sum(words) OVER () AS total
            FROM s WINDOW earlier AS (ORDER BY 2.0::DOUBLE * words / part, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), level AS (
            -- The first source, by words for its weight, that the level of the others does not fill.
            SELECT (total - held) / open AS level FROM ordered WHERE (total - held) / open * part <= 2 * words
            ORDER BY 2.0::DOUBLE * words / part, source NULLS LAST LIMIT 1
        ), t AS (
            SELECT source AS of, words, least(2.0::DOUBLE * words, level * part) AS target,
                   CASE WHEN words > 0 THEN least(2.0::DOUBLE, least(2.0::DOUBLE * words, level * part) / words) ELSE 0.0::DOUBLE END AS copies
            FROM s, level
        ), r AS (
            SELECT d.*, t.*, CAST(floor(copies) AS BIGINT) AS whole, copies - floor(copies) AS p,
                   (draw + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.of
        ), o AS (
            SELECT *, CASE WHEN p > 0 AND size > 0 THEN u / (1 - u) / (p / (1 - p)) END AS odds,
                   greatest(floor(target + 0.5) - sum(whole * size) OVER (PARTITION BY source), 0) AS remain
            FROM r
        ), c AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds / (1 + odds), doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o
        )
        SELECT doc_id, size, words AS source_size, target,
               CAST(whole * size + CASE WHEN odds IS NULL THEN 0 ELSE least(greatest(remain - before, 0), size) END AS BIGINT) AS taken
        FROM c
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10
    """,
    "op13_pivot_clusters": f"""
        WITH e AS (
            SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), k0 AS (
            SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS c, v FROM e WHERE vec_id IS NOT NULL
            WINDOW w AS (ORDER BY sha256('2:' || vec_id), v) QUALIFY row_number() OVER w <= 40
        ), {_rounds(5)}
        SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
        FROM a JOIN k5 k ON a.c = k.c
    """,
}
