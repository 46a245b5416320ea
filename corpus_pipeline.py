"""Corpus pipeline: documents -> language ID -> exact dedup -> SimHash near-dedup -> mixing -> BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the
shared folder and rereads as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import bpe, exact, langid, mixing, simhash
from corpusprep.llm.common import saved

# Target weights of the mix: the first ten sources count double.
MIX_WEIGHTS = {f"src{i}": 2.0 if i < 10 else 1.0 for i in range(20)}
SHINGLE, MAX_BITS = 3, 2
BPE_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and lies near a learned centroid. Null and empty texts go;
    repeated rows stay repeated. Without labelled rows nothing can be accepted."""
    model = langid.fit(docs.filter(langid.fold() != 2))
    lang, score, rejected = langid.private(docs, "lang", "score", "rejected")
    return langid.predict(docs, model, names=(lang, score, rejected)).filter(~F.col(rejected)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest doc_id. Null equals empty."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest doc_id. Texts without words are
    one group (fingerprint 0)."""
    return simhash.near_dedup(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; sources without a weight, and null, share one."""
    return mixing.mix(docs, MIX_WEIGHTS)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document (repeated rows too; a null text has no ids): ids as little-endian unsigned 32-bit integers, and the digest of the decoded bytes."""
    tokens = bpe.encode(docs.select("doc_id", "text", "source"), BPE_PATH, decoded_col="decoded")
    return tokens.select(
        "doc_id", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", bpe_tokens),
]

# Language ID, SimHash (XXH64) and BPE have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{i}")
    return docs
