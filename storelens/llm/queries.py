"""Registered queries of the operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare
from .mixing import MIX_SQL


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def held_out(id_col: str = "doc_id"):
    """Documents that no classifier may learn from (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learnt from three quarters of the labels."""
    from .language_id import identify, train
    docs = _read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.9 or more."""
    from .embedding_dedup import near_vectors
    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4,096 tokens."""
    from .packing import pack_documents
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document shares with others, first holders included."""
    from .substring_dedup import repeated_passages
    return repeated_passages(_read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("id").alias("doc_id"), "start_byte", "n_bytes", F.col("first_id").alias("first_doc_id"), "removed")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    from .mixing import mix_sizes
    return mix_sizes(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    from .secret_scan import scan
    return scan(_read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "word_no", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


#: (verdict, host, path), as the contract of the query states them.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; listed are the urls of pages labelled toxic."""
    from .url_filter import filter_urls, host_and_path
    pages, labels = _read(spark, sf_dir, "pages").select("page_id", "url"), _read(spark, sf_dir, "labels")
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    host, path = host_and_path(F.col("url"))
    listed = pages.join(toxic, "page_id", "left_semi").select(F.concat(host, path).alias("key"))
    return filter_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


URL_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS s FROM pages),
h AS (SELECT page_id, s, regexp_extract(s, '^[^/?#]*', 0) AS raw FROM p),
k AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(s, length(raw) + 1), '^[^?#]*', 0) AS path FROM h),
listed AS (SELECT DISTINCT host || path AS key FROM k
           WHERE page_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND host || path <> ''),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT k.page_id, k.host, k.path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS rv
  FROM k LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY k.page_id, k.host, k.path)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.rv, CASE WHEN j.host || j.path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j
"""


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document by weighted Jaccard similarity of five-word runs."""
    from .near_dedup import document_groups
    return document_groups(_read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the line blocks that earlier documents hold."""
    from .line_dedup import line_dedup
    out = line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n", -1))).otherwise(0)
    return out.select("doc_id", lines.cast("long").alias("lines_left"), F.col("_gone").alias("lines_deleted"),
                      F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    from .fingerprints import edited_likeness
    return edited_likeness(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from .lexical_search import rank_documents
    return rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


RANK_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf CROSS JOIN whole GROUP BY term, docs),
part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS v
         FROM tf JOIN weight USING (term) JOIN size USING (doc_id) CROSS JOIN whole),
scored AS (SELECT item_id, doc_id, CAST(sum(v) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every whole document, learnt from two thirds of the labels."""
    from .quality_rules import score_quality

    def apart(id_col: str):
        return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1

    scored, _ = score_quality(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"), ~apart("id"))
    score = F.col("quality_score")
    return scored.select("doc_id", apart("doc_id").alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    import public_tokenizers

    from .token_alignment import aligned_documents
    out = aligned_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_embedding_near_dedup, op3_best_fit_packing, op4_substring_dedup, op5_source_mixing,
                                op6_secret_scan, op7_url_filters,
                                op8_minhash_near_dedup, op9_line_dedup, op10_document_fingerprints, op11_lexical_search, op12_quality_classifier,
                                op13_token_alignment)
}
ORACLES: dict[str, str] = {"op5_source_mixing": MIX_SQL, "op7_url_filters": URL_SQL, "op11_lexical_search": RANK_SQL}
