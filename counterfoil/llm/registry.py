"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.llm import (
    bpe,
    dart_minhash,
    exact_dedup,
    language,
    mixing,
    quality,
    resampling,
    suffix_tree,
    token_counts,
    topk,
    toxicity,
    url_filter,
    vector_codes,
)
from counterfoil.llm.common import fold, table
from counterfoil.llm.url_filter import ALLOW, BLOCK, Rule

URL_RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), learns=fold("doc_id", 7) != 2)
    return scored.withColumn("held_out", fold("doc_id", 7) == 2)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = language.identify(docs, learns=fold("doc_id", 3) != 1)
    return judged.withColumn("held_out", fold("doc_id", 3) == 1)


def bpe_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> bpe.Vocabulary:
    return bpe.Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), bpe_vocabulary())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.classify(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        learns=fold("doc_id", 5) != 0,
    )
    return judged.withColumn("held_out", fold("doc_id", 5) == 0)


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        "quality",
        learns=fold("doc_id", 5) != 0,
    )
    return judged.withColumn("held_out", fold("doc_id", 5) == 0)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target, percent=10, least_words=20, seed="2024")


def count_model(name: str = "byte_bpe_50k.json") -> token_counts.Model:
    return token_counts.Model.read(public_tokenizers.path(name))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), count_model())


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_language": op4_language,
    "op5_bpe": op5_bpe,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_dart_minhash": op8_dart_minhash,
    "op9_quality": op9_quality,
    "op10_topk": op10_topk,
    "op11_resampling": op11_resampling,
    "op12_token_counts": op12_token_counts,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER = "substr(url, strpos(url, '://') + 3)"
_FITS = "((host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}'))"



def vector_codes_sql(parts: int = 4, count: int = 256, rounds: int = 4) -> str:
    """Every round as one assignment and one update; distance and index share one number."""
    steps = [
        """kept AS MATERIALIZED (
            SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r
            FROM (SELECT vec_id, label, list_transform(embedding,
                    lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v
                FROM embeddings
                WHERE embedding IS NOT NULL AND len(list_filter(embedding,
                    lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
        f"""parts AS MATERIALIZED (
            SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}]::DOUBLE[] AS x
            FROM kept, (SELECT range AS p FROM range({parts})))""",
        f"book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {count})",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
            SELECT r, p, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c)
                + list_inner_product(c, c) AS BIGINT) * {count} + e) AS m
            FROM parts JOIN book{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (
                SELECT p, e, list(f ORDER BY i) AS c FROM (
                    SELECT p, m % {count} AS e, i, floor(sum(x[i]) / count(*)) AS f
                    FROM near{k} JOIN parts USING (r, p), unnest(range(1, len(x) + 1)) AS t(i)
                    GROUP BY p, e, i)
                GROUP BY p, e)""")
            steps.append(f"""book{k + 1} AS MATERIALIZED (
                SELECT p, e, coalesce(n.c, b.c) AS c
                FROM book{k} b LEFT JOIN mean{k} n USING (p, e))""")
    return f"""WITH {", ".join(steps)}, coded AS (
            SELECT r, string_agg(lpad(lower(to_hex(m % {count})), 2, '0'), '' ORDER BY p) AS code,
                CAST(sum(m // {count}) AS BIGINT) AS error
            FROM near{rounds} GROUP BY r
        ), told AS (
            SELECT sha256(string_agg(array_to_string(c::BIGINT[], ','), ',' ORDER BY p, e))
                AS codebooks_sha256 FROM book{rounds}
        )
        SELECT vec_id, code, error,
            CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (r), told"""


SQL: dict[str, str] = {
    "op1_url_filter": f"""
        WITH parts AS (
            SELECT page_id,
                CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
                    THEN translate(regexp_extract({_AFTER}, '^[^/?#]*'), '{UPPER}', '{LOWER}')
                    ELSE '' END AS host,
                CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
                    THEN regexp_extract({_AFTER}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM pages
        ), ruled AS (
            SELECT *, CASE
                WHEN {_FITS.format("example.net", "/en/")} THEN 'example.net/en/'
                WHEN {_FITS.format("example.com", "/de/")} THEN 'example.com/de/'
                WHEN {_FITS.format("org", "/fr/")} THEN 'org/fr/'
                WHEN {_FITS.format("net", "/")} THEN 'net/' END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule,
            CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
    "op2_exact_dedup": f"""
        WITH norm AS (
            SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
            sha256(norm) AS text_sha256
        FROM norm WINDOW same AS (PARTITION BY norm)""",
    "op6_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)
                    AS size,
                md5(concat_ws('|', '11', CAST(doc_id AS VARCHAR), md5(text))) AS draw
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                    WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
            FROM sized GROUP BY source
        ), filled AS (
            -- ascending by size per weight, the clamped sources come first
            SELECT *, (1.5 * (sum(source_size) OVER ())::DOUBLE
                    - 2.0 * coalesce(sum(source_size) OVER earlier, 0)::DOUBLE)
                / (sum(weight) OVER ()
                    - coalesce(sum(weight) OVER earlier, 0)) AS level
            FROM sources
            WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), levelled AS (
            SELECT *, arg_min(level, source_size / weight)
                FILTER (level * weight <= 2.0 * source_size) OVER () AS final
            FROM filled
        ), targets AS (
            SELECT source, source_size,
                CASE WHEN final IS NULL OR final * weight > 2.0 * source_size
                    THEN 2.0 * source_size ELSE weight * final END AS target
            FROM levelled
        ), parts AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT)
                ELSE 0 END AS whole
            FROM targets
        ), placed AS (
            SELECT s.doc_id, s.size, p.source_size, p.target, p.whole,
                p.target - p.whole * p.source_size AS rest, substr(s.draw, 1, 3) AS cell,
                p.source,
                sum(s.size) OVER (PARTITION BY p.source ORDER BY s.draw, s.size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
            FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
        ), celled AS (
            SELECT *, max(upto) OVER (PARTITION BY source, cell) AS cell_end,
                min(upto - size) OVER (PARTITION BY source, cell) AS cell_start
            FROM placed
        )
        SELECT doc_id, size, source_size, target,
            CAST(size * least(2, whole + CASE
                WHEN rest < cell_start THEN 0
                WHEN rest >= cell_end THEN CASE WHEN rest > 0 THEN 1 ELSE 0 END
                WHEN upto - size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM celled""",
    "op10_topk": """
        WITH good AS (
            SELECT vec_id, row_number() OVER () AS r,
                list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding,
                lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(range(1, len(q.v) + 1),
                    lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM good q JOIN good c ON q.vec_id % 20 = 0 AND q.r <> c.r
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY r
                ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT * FROM ranked WHERE rank <= 20""",
    "op11_resampling": f"""
        WITH crc_table AS (
            SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1,
                    CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), b) ORDER BY b) AS t
            FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))
        ), doc_words AS (
            SELECT doc_id, rowid AS r, unnest(regexp_extract_all(translate(text, '{UPPER}',
                '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
        ), goal_words AS (
            SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
        ), spelled AS (
            SELECT word, list_transform(range(octet_length(encode(word))), lambda i:
                CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS bytes
            FROM (SELECT word FROM doc_words UNION SELECT word FROM goal_words)
        ), hashed AS (
            SELECT word, xor(list_reduce(bytes, lambda c, b:
                xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM spelled, crc_table
        ), raw AS (
            SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket
        ), goal AS (
            SELECT bucket, count(*) AS t FROM goal_words JOIN hashed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln(
                    ((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM raw) + 10000)::DOUBLE)
                    / ((coalesce(s, 0) + 1)::DOUBLE
                        * (coalesce((SELECT sum(t) FROM goal), 0) + 10000)::DOUBLE))) AS BIGINT)
                AS gain
            FROM raw FULL JOIN goal USING (bucket)
        ), weighed AS (
            SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total
            FROM doc_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
        ), noisy AS (
            SELECT doc_id, coalesce(n, 0) AS n_features,
                coalesce(CAST(floor(total / n) AS BIGINT), 0) AS weight,
                CAST('0x' || substr(sha256(concat('2024:', CAST(doc_id AS VARCHAR))), 1, 8)
                    AS BIGINT) AS h
            FROM (SELECT *, row_number() OVER () AS r FROM documents) LEFT JOIN weighed USING (r)
        ), scored AS (
            SELECT doc_id, n_features, weight, weight
                + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM noisy
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20
                ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                count(*) OVER (PARTITION BY n_features >= 20) AS fit
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
            CASE WHEN n_features >= 20 AND place <= 10 * fit // 100 THEN place END AS rank
        FROM ordered""",
    "op13_vector_codes": vector_codes_sql(),
}
