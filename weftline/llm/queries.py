"""The thin queries over the test tables: each calls its operator and derives the asked columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    best_fit,
    byte_cnn,
    centroids,
    fm_index,
    hash_tree,
    html_crf,
    line_crf,
    prefix_join,
    repeats,
    secrets,
    spelling_trie,
    sql,
    token_counts,
    warc,
)
from weftline.plans.registry import query, table

SHARDS = 8
TOKEN_LIMIT = 4096


GOOD_SCORE = 0.7


@query("op1_byte_cnn")
def op1_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.quality_scores(docs, network).select(
        "doc_id",
        byte_cnn.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"),
    )


@query("op2_best_fit")
def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


@query("op4_run_index", sql.REPEATS)
def op4_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).drop("text")


@query("op3_line_crf")
def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_crf.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text", "content_share")


@query("op5_fm_index", sql.CONTAMINATION)
def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fm_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op7_warc", sql.ARCHIVES)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest, records = warc.write_archives(pages, min_bytes=0)
    chunks = warc.read_archives(spark, manifest)
    held = F.sum(F.octet_length("data"))
    payload_bytes = F.when(F.first("record_type") == "response", held).otherwise(F.first("payload_bytes"))
    read = chunks.groupBy("record_id").agg(
        payload_bytes.alias("payload_bytes"),
        F.max_by("sha1", "number").alias("payload_digest"),
        F.first("record_type").alias("record_type"),
        F.first("refers_to").cast(pages.schema["page_id"].dataType).alias("refers_to"),
    )
    return records.select("record_id", "page_id").join(read, "record_id").drop("record_id")


@query("op9_prefix_join", sql.SIMILAR)
def op9_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.similar_components(table(spark, sf_dir, "documents"))


_NOW, _GROWN = hash_tree.shard_tree(SHARDS), hash_tree.shard_tree(SHARDS + 1)


@query(
    "op8_hash_tree",
    f"""
    WITH d AS (
      SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
             {sql.crc32("text")}::BIGINT AS text_crc32,
             ({hash_tree.place_sql("doc_id", _NOW)})::INTEGER AS shard,
             ({hash_tree.place_sql("doc_id", _GROWN)})::INTEGER AS grown_shard,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':slot'), 1, 3))::INTEGER AS slots
      FROM documents)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
           row_number() OVER (PARTITION BY shard ORDER BY slots, doc_id) - 1 AS slot
    FROM d
    """,
)
def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return hash_tree.assign(docs, "doc_id", _NOW, _GROWN)


@query("op10_html_crf")
def op10_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_crf.extract(pages).drop("html")


@query("op11_spelling_trie", sql.SPELLING)
def op11_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_trie.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_secret_structure")
def op12_secret_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_assign", "n_access", "n_hex")
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query("op13_equal_average", sql.CLUSTERED)
def op13_equal_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
