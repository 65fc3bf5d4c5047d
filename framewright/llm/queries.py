"""The operators' queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewright.llm._shared import prepared

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.substring_dedup import deduplicated

    return deduplicated(table(spark, sf_dir, "documents"), window=13)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.token_files import token_id_files

    return token_id_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.quality import scored, trained

    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")), columns=["doc_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.warc import archived

    rows = archived(table(spark, sf_dir, "pages")).where("gap is null")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), tokenizer_path(), window=4096, end_id=2)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.url_filter import judged, labelled_urls

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, labelled_urls(spark)).select("page_id", "host", "path", "rule", "verdict", "unwanted")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from framewright.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from framewright.llm.pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_simhash": op8_simhash,
    "op9_topk": op9_topk,
    "op10_pii": op10_pii,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), n AS (
            SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL
        ), k AS (
            SELECT r, doc_id, p, array_to_string(w[p:p + 12], ' ') AS words FROM n
        ), f AS (
            SELECT words, min(doc_id) AS m FROM k GROUP BY words HAVING min(doc_id) < max(doc_id)
        ), g AS (
            SELECT r, list_sort(list(DISTINCT q)) AS gone
            FROM (SELECT r, unnest(range(p, p + 13)) AS q FROM k JOIN f USING (words) WHERE doc_id > m) GROUP BY r
        ), kept AS (
            SELECT r, string_agg(x, ' ' ORDER BY i) AS t
            FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d)
            WHERE (r, i) NOT IN (SELECT (r, unnest(gone)) FROM g) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN g USING (r) LEFT JOIN kept USING (r)
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ), b AS (
            SELECT page_id, payload_bytes, h, array_to_string(list_transform(
                range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', h[i]) - 3, 4)), '') AS bits
            FROM p
        ), e AS (
            SELECT page_id, payload_bytes, array_to_string(list_transform(
                range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT)
                    + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT), 1)), '') AS payload_digest
            FROM b
        ), m AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS r FROM e
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN r IS NULL OR page_id = r THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
        FROM m
    """,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
}
