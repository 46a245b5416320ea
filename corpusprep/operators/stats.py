"""Length statistics (B5) and counts (AG6) per split, exact aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bytetok import MAX_LEN
from ..functions.tokens import py_strip, py_strip_sql

PERCENTILES = (50, 95)


def length_stats(df: DataFrame, group: str, cols: list[str], max_len: int = MAX_LEN) -> DataFrame:
    """Per group and text column: rows, non-blank rows, char/byte sums, averages, maxima and exact
    percentiles (their state is one counter per distinct length), and rows whose UTF-8 length exceeds ``max_len - 1`` bytes (they are truncated by the byte tokeniser)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        b = F.octet_length(F.coalesce(F.col(c), F.lit("")))
        aggs += [
            F.count_if(py_strip(F.coalesce(F.col(c), F.lit(""))) != "").alias(f"{c}_non_blank"),
            F.sum(F.length(F.coalesce(F.col(c), F.lit("")))).cast("long").alias(f"{c}_chars"),
            F.max(F.length(F.coalesce(F.col(c), F.lit("")))).alias(f"{c}_max_chars"),
            F.sum(b).cast("long").alias(f"{c}_bytes"),
            F.max(b).alias(f"{c}_max_bytes"),
            F.avg(b).alias(f"{c}_avg_bytes"),
            *[F.percentile(b, p / 100).alias(f"{c}_p{p}_bytes") for p in PERCENTILES],
            F.count_if(b > max_len - 1).alias(f"{c}_truncated"),
        ]
    return df.groupBy(group).agg(*aggs)


def length_stats_sql(base_sql: str, group: str, cols: list[str], max_len: int = MAX_LEN) -> str:
    parts = ["count(*) AS rows"]
    for c in cols:
        v = f"coalesce({c}, '')"
        parts += [
            f"count(*) FILTER (WHERE {py_strip_sql(v)} <> '') AS {c}_non_blank",
            f"CAST(sum(length({v})) AS BIGINT) AS {c}_chars",
            f"CAST(max(length({v})) AS INTEGER) AS {c}_max_chars",
            f"CAST(sum(octet_length(encode({v}))) AS BIGINT) AS {c}_bytes",
            f"CAST(max(octet_length(encode({v}))) AS INTEGER) AS {c}_max_bytes",
            f"avg(octet_length(encode({v}))) AS {c}_avg_bytes",
            *[f"quantile_cont(octet_length(encode({v})), {p / 100}) AS {c}_p{p}_bytes" for p in PERCENTILES],
            f"count(*) FILTER (WHERE octet_length(encode({v})) > {max_len - 1}) AS {c}_truncated",
        ]
    return f"SELECT {group}, {', '.join(parts)} FROM ({base_sql}) GROUP BY {group}"


# Fixed value: the sketch's documented single-sided rank error for k = 200 (99 % of the time).
KLL_K, KLL_ERROR = 200, 0.0133


def length_sketches(df: DataFrame, group: str, cols: list[str], k: int = KLL_K) -> DataFrame:
    """(group, column, sketch): a mergeable KLL sketch of the UTF-8 lengths of every text column, per group. A few
    kilobytes each whatever the rows: kept beside a split, merged with those of other splits or later runs."""
    sizes = F.array(*[F.struct(F.lit(c).alias("column"), F.octet_length(F.coalesce(F.col(c), F.lit(""))).cast("long").alias("size")) for c in cols])
    rows = df.select(F.col(group), F.explode(sizes).alias("s")).select(group, "s.*")
    return rows.groupBy(group, "column").agg(F.kll_sketch_agg_bigint("size", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str], k: int = KLL_K) -> DataFrame:
    """One sketch for the rows of all sketches that share ``by``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, ranks: tuple[float, ...]) -> DataFrame:
    """A row a sketch and rank: the length at that rank (0 to 1), and the rows that the sketch has seen."""
    found = [F.struct(F.lit(r).alias("rank"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(r)).alias("length")) for r in ranks]
    x = sketches.withColumn("rows", F.kll_sketch_get_n_bigint("sketch")).withColumn("found", F.explode(F.array(*found)))
    return x.select(*[c for c in sketches.columns if c != "sketch"], "found.rank", "found.length", "rows")


def rank_errors(quantiles: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """quantiles (column, rank, length, rows) plus how far the rank lies outside the exact ranks that the length
    has in df: from the share of smaller texts to that of texts not larger (0: it is exact)."""
    sizes = F.array(*[F.struct(F.lit(c).alias("column"), F.octet_length(F.coalesce(F.col(c), F.lit(""))).cast("long").alias("size")) for c in cols])
    counts = df.select(F.explode(sizes).alias("s")).select("s.*").groupBy("column", "size").count()
    x = counts.join(F.broadcast(quantiles), "column").groupBy("column", "rank", "length", "rows").agg(  # a few rows a column
        F.sum(F.when(F.col("size") < F.col("length"), F.col("count")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("size") <= F.col("length"), F.col("count")).otherwise(0)).alias("upto"))
    off = F.greatest(F.col("below") / F.col("rows") - F.col("rank"), F.col("rank") - F.col("upto") / F.col("rows"), F.lit(0.0))
    return x.select("column", "rank", "length", "rows", off.alias("error"))


def previews(df: DataFrame, keep: list[str], lengths: dict[str, int]) -> DataFrame:
    """The first characters of text columns, for reports (``<column>_preview``); NULL stays NULL."""
    return df.select(*keep, *[F.left(F.col(c), F.lit(n)).alias(f"{c}_preview") for c, n in lengths.items()])


def previews_sql(base_sql: str, keep: list[str], lengths: dict[str, int]) -> str:
    return f"SELECT {', '.join([*keep, *(f'left({c}, {n}) AS {c}_preview' for c, n in lengths.items())])} FROM ({base_sql})"
