"""End-to-end jobs over files, the way the reference is run (E1-E3), each one Spark plan.

  build_corpus       E1: documents + sentences + definitions CSV → train_clean / test_clean
  build_definitions  E2: lexicon CSV + stored API payloads → definitions CSV (+ run counters)
  make_split         E3a: clean train → JSONL partitioned by split + metadata counted in the same pass
  tokenize_splits    E3b: JSONL splits → byte-token Parquet partitioned by split
  score              E3c: any text column through a predictor → predictions CSV (quote all)
  evaluate           E3d: predictions vs references → corpus BLEU row

Intermediate results are written to files (the hand-over between jobs, as in the reference);
nothing is collected to the driver except the split's bounded histograms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bytetok as BT
from ..operators import align as AL
from ..operators import bleu as BL
from ..operators import dictionary as DI
from ..operators import scoring as SC
from ..operators import split as SP
from ..sources import readers as R
from ..sources import versions as V
from ..sources import writers as W

DOC_COLUMNS = ["oare_id", "transliteration", "translation"]
SENTENCE_COLUMNS = ["text_uuid", "sentence_uuid", "first_word_number", "translation"]


def build_corpus(spark: SparkSession, train_csv: str, sentences_csv: str, definitions_csv: str,
                 test_csv: str | None, out_dir: str) -> None:
    docs = R.ensure_columns(R.read_csv_strings(spark, train_csv, ordinal="doc_ordinal"), DOC_COLUMNS)
    docs = docs.select(*DOC_COLUMNS, "doc_ordinal")
    sents = R.read_csv_strings(spark, sentences_csv, ordinal="sent_ordinal").select(*SENTENCE_COLUMNS, "sent_ordinal")
    dictionary = DI.build_dictionary(R.read_definitions_csv(spark, definitions_csv))
    train = AL.build_clean_train(docs, sents, dictionary)
    W.write_csv(train, f"{out_dir}/train_clean")
    if test_csv:
        W.write_csv(AL.build_clean_test(R.read_csv_strings(spark, test_csv), dictionary), f"{out_dir}/test_clean")


def build_definitions(spark: SparkSession, lexicon_csv: str, payloads: DataFrame, out_dir: str,
                      param: str = "word=", name: str = "word", limit: int | None = None) -> DataFrame:
    """Writes the definitions CSV; returns the run counters (queued, written, fetched, reused).
    ``payloads`` holds (url, payload) for URLs already fetched; no network access happens here.
    ``limit`` is the reference's dry-run option (first N queued tokens in file order).

    A later run on the same ``out_dir`` resumes: it adds only tokens not stored yet and parses only URLs not
    stored yet. The CSV of each run is a version of its own; readers of ``definitions`` see all of them."""
    return add_definitions(DI.extract_lexicon(R.read_lexicon_csv(spark, lexicon_csv)), payloads, out_dir, param, name, limit)


def add_definitions(queue: DataFrame, payloads: DataFrame, out_dir: str, param: str, name: str, limit: int | None = None) -> DataFrame:
    spark, store = queue.sparkSession, f"{out_dir}/store"
    if limit is not None:
        queue = queue.orderBy("ordinal").limit(limit)
    stored = V.read_versions(spark, store, DI.STORE_SCHEMA)
    n = V.add_version(DI.new_definitions(queue, payloads, stored, param, name), store)
    added = spark.read.schema(DI.STORE_SCHEMA).parquet(f"{store}/version={n}")
    W.write_definitions(added, f"{out_dir}/definitions/version={n}")
    return DI.run_counters(added, queue.count())


def make_split(spark: SparkSession, train_clean_csv: str, out_dir: str) -> None:
    clean = R.read_csv_strings(spark, train_clean_csv)
    pairs = SP.prepare_pairs(clean, "transliteration_with_annotations", "translation",
                             keep=["oare_id", "sentence_uuid"])
    key = F.concat_ws("|", F.coalesce(F.col("oare_id"), F.lit("")), F.coalesce(F.col("sentence_uuid"), F.lit("")),
                      F.xxhash64("input_text", "target_text").cast("string"))
    split = SP.split_exact(pairs, key)
    counts = W.write_jsonl_by_split(split.select("input_text", "target_text", "split"), f"{out_dir}/pairs")
    W.write_split_meta(spark, counts, f"{out_dir}/meta")


def tokenize_splits(spark: SparkSession, split_dir: str, out_dir: str) -> None:
    pairs = R.read_pair_splits(spark, f"{split_dir}/pairs")
    ids = BT.byte_ids(F.col("input_text"))
    tok = pairs.select("split", ids.alias("input_ids"), BT.attention_mask(ids).alias("attention_mask"),
                       BT.byte_ids(F.col("target_text")).alias("labels"))
    W.write_parquet_by_split(tok, f"{out_dir}/tokens")


def score(df: DataFrame, key: str, text: str, predictor, out_path: str) -> None:
    W.write_csv(SC.predict(df.select(key, text), predictor, text), out_path, quote_all=True)


def evaluate(df: DataFrame, key: str, hyp: str, ref: str) -> DataFrame:
    return BL.bleu_from_stats(BL.bleu_stats(df, key, hyp, ref))
