"""From raw documents to packed training windows, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``; every stage works on all rows it is given:

* toxicity: rows whose score reaches the threshold go (fitted on the labelled
  rows among those given);
* exact_dedup: of texts equal but for white space, the smallest id's row stays;
* near_dedup: of each component of near-duplicates (links from a similarity of
  0.8 on), the smallest id's row stays;
* secrets: no row goes; the values of secrets are replaced in the texts;
* packing: pieces of the documents in windows of 2048 ids.

The documents' columns are carried whole; a null text is kept through the
first four stages (its copies count as one text) and packed as an end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimtide.llm import exact_dedup, near_dedup, packing, secret_scan, toxicity
from claimtide.llm.tables import scratch, written

#: links of near_dedup, as ``near_dedup.PERCENT`` for its own query.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scorer = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, scorer, name="__toxicity").where(f"__toxicity < {toxicity.THRESHOLD}").drop("__toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with exact_dedup.DigestIndex(spark, scratch(spark, "pipeline-digests"), docs.schema["doc_id"].dataType.simpleString()) as index:
        return exact_dedup.distinct_texts(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_documents(docs, percent=NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL cannot express the classifier, the tokenizer and the packing; the run
#: is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
