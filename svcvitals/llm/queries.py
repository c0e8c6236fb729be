"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from svcvitals.llm import decontaminate, html_extract, line_dedup, mixing, ngram_join, ranked_search, sharding, suffix_dedup, token_alignment, token_records, topk_search, toxicity, url_filter
from svcvitals.llm.columns import prepared, utf8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_records.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_records.read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(toxicity.training_rows(docs, _table(spark, sf_dir, "labels")))
    scored = toxicity.score_documents(docs, lexicon)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join_documents(_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(utf8(F.array_join("items", ",")), 256).alias("items_sha256"), "contaminated")


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 24)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store takes the documents in two deliveries, told apart by a hash of the id: the
    second one goes through the filters that the first one has filled."""
    docs = _table(spark, sf_dir, "documents")
    store = line_dedup.LineStore(spark, line_dedup.shards_for(docs))
    early = F.xxhash64("doc_id") < 0
    for delivery in (early, ~early):
        store.insert(docs.filter(delivery))
    return store.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(utf8(F.col("text")), 256).alias("kept_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    public_tokenizers.path("piece_bpe_32k.model"), packed=False, text=True)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                          F.when(F.col("groups") == "", "").otherwise(F.sha2(utf8(F.col("groups")), 256)).alias("groups_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


QUERIES = {f.__name__: f for f in (
    op1_token_records, op2_suffix_dedup, op3_exact_topk, op4_toxicity, op5_ngram_jaccard_join, op6_source_mixing,
    op7_benchmark_decontamination, op8_jump_sharding, op9_line_dedup, op10_url_filter,
    op11_token_alignment, op12_ranked_search, op13_html_extraction)}
