"""Sinks (K1-K5): CSV with header, CSV quoting every field, JSONL keeping non-ASCII text, the
one-row metadata document, the definitions CSV, and Parquet partitioned by split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> None:
    """K1/K2: header row, '"' quoting with '"' escaping (RFC 4180), optionally every field quoted.
    Spaces at the ends of a value are part of it."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("quoteAll", quote_all).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one JSON object per line, UTF-8 text as is, NULL fields written (not dropped)."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_jsonl_by_split(df: DataFrame, path: str, splits: tuple[str, ...] = ("train", "validation"), mode: str = "overwrite") -> dict[str, int]:
    """K3 for all splits in one pass: a folder ``split=<name>`` each. The rows are counted while they are
    written (AG6): returns {"<name>_rows": n}."""
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in splits])
    counted.write.mode(mode).option("ignoreNullFields", False).partitionBy("split").json(path)
    return {f"{s}_rows": seen.get.get(f"{s}_rows", 0) for s in splits}


def write_split_meta(spark: SparkSession, counts: dict[str, int], path: str, mode: str = "overwrite") -> None:
    """K4: {"train_rows": n, "validation_rows": m}, one JSON object in one file."""
    row = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])
    row.coalesce(1).write.mode(mode).json(path)


def write_definitions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: word, raw_url, api_url, definition. Proper CSV quoting (the reference's hand-built
    lines break on commas and quotes inside words; that is not reproduced)."""
    write_csv(df.select("word", "raw_url", "api_url", "definition"), path, mode=mode)


def write_parquet_by_split(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Intermediate tables: Parquet partitioned by ``split`` (readers prune partitions)."""
    df.write.mode(mode).partitionBy("split").parquet(path)
