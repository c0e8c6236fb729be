"""Corpus pipeline: documents through five of the training-data operators, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet to the shared folder and rereads it as the next one's documents. All but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from svcvitals.llm import decontaminate, mixing, ngram_join, token_records, toxicity
from svcvitals.llm.columns import prepared
from svcvitals.sources.tables import materialize

#: Words of a shingle, and the Jaccard similarity in percent from which documents are near
#: copies, in the near-copy stage; the op5 query keeps its own contract.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def _judged(docs: DataFrame, judge, reject) -> DataFrame:
    """The rows of docs that ``judge`` does not ``reject``; its columns get names of their own
    meanwhile, so that no further column clashes with a judge's."""
    kept = [f"in_{k}_{c}" for k, c in enumerate(docs.columns)]
    names = dict(zip(docs.columns, kept))
    rest = tuple(k for k in kept if k != names["doc_id"])
    judged = judge(docs.toDF(*kept), id_col=names["doc_id"], text_col=names["text"], keep=rest)
    return judged.filter(~reject).select(*[F.col(k).alias(c) for c, k in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not predict to be toxic."""
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    return _judged(docs, lambda d, **cols: toxicity.score_documents(d, lexicon, **cols), F.col("predicted") == 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of linked documents; rows that share its id are
    one document, of which the first by text hash stays. Rows with a null id stay."""
    prepared(spark)
    joined = ngram_join.join_documents(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)
    stay = joined.filter("doc_id = component_id").select(F.col("doc_id").alias("stays")).distinct()
    kept = [f"in_{k}" for k in range(len(docs.columns))]
    doc_id, text = (F.col(kept[docs.columns.index(c)]) for c in ("doc_id", "text"))
    rows = docs.toDF(*kept)
    first = Window.partitionBy("stays").orderBy(F.xxhash64(text))
    chosen = rows.join(stay, doc_id == F.col("stays")).withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    return chosen.select(*kept).unionByName(rows.filter(doc_id.isNull())).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth of the words."""
    prepared(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _judged(docs, lambda d, **cols: decontaminate.find_benchmark(d, benchmark, **cols), F.col("contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit(docs)


def write_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, read back from the record files."""
    prepared(spark)
    manifest = token_records.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_records.read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_records", write_records),
]

#: SQL cannot express the learned lexicon, the hash draws or the tokenizer; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
