"""Deterministic train/validation splits (G10, L2, L2b) and pair preparation.

``split_exact`` reproduces the reference's law: shuffle with a seed, the first
``max(1, int(0.1 * n))`` rows are validation, the rest train. The shuffle is a hash order
(md5 of seed and row key), and the cut is found without sorting the data or funnelling it
through one task: a histogram over the top 16 hash bits, then over the next 16 bits inside the
bucket that holds the cut, then the counts of the few keys of that sub-bucket. Each step reads the
key columns only and brings at most 65,536 counts to the driver.

``split_group`` keeps every row of a group (e.g. a document) on one side: threshold on the
hash of the group key (no leak between sides; counts are approximate by design).
``split_group_exact`` does so with the size of the law: whole groups in hash order until they hold
``max(1, int(0.1 * n))`` rows, so the last group alone decides how far the size is above it. A histogram of
rows over the groups' hashes is one of group sizes already, so no group is ever counted by itself
but those beside the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import row_identity
from ..functions.tokens import py_strip, py_strip_sql

SEED = 42
VALIDATION_SHARE = 0.1
LEVEL_BITS = 16


def prepare_pairs(df: DataFrame, input_col: str, target_col: str, keep: list[str] | None = None) -> DataFrame:
    """P3 NULL → '', P1 rename to input_text/target_text, P2 drop rows blank on either side."""
    keep = keep or []
    out = df.select(
        *keep,
        F.coalesce(F.col(input_col).cast("string"), F.lit("")).alias("input_text"),
        F.coalesce(F.col(target_col).cast("string"), F.lit("")).alias("target_text"),
    )
    return out.filter((py_strip(F.col("input_text")) != "") & (py_strip(F.col("target_text")) != ""))


def prepare_pairs_sql(base_sql: str, input_col: str, target_col: str, keep: list[str] | None = None) -> str:
    k = "".join(f"{c}, " for c in (keep or []))
    return f"""
SELECT * FROM (SELECT {k}coalesce(CAST({input_col} AS VARCHAR), '') AS input_text,
                      coalesce(CAST({target_col} AS VARCHAR), '') AS target_text FROM ({base_sql}))
WHERE {py_strip_sql('input_text')} <> '' AND {py_strip_sql('target_text')} <> ''"""


def order_hash(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key))


def validation_size(n: int, share: float = VALIDATION_SHARE) -> int:
    return max(1, int(n * share)) if n > 0 else 0


def _bits(h: Column, start_hex: int, n_hex: int) -> Column:
    return F.conv(F.substring(h, start_hex, n_hex), 16, 10).cast("long")


def _histogram(df: DataFrame, bucket: Column) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(bucket.alias("b")).count().collect()}


def _pick(hist: dict[int, int], rank: int) -> tuple[int, int]:
    """Bucket holding the ``rank``-th row (1-based) and the rank inside it."""
    seen = 0
    for b in sorted(hist):
        if seen + hist[b] >= rank:
            return b, rank - seen
        seen += hist[b]
    raise ValueError("rank beyond the data")


@dataclass(frozen=True)
class Cut:
    """Rows up to hash ``h`` (ties: up to key ``k``) go first; of the cut's own ``count`` rows, ``need``."""

    h: str
    k: str
    need: int
    count: int


def find_cut(keys: DataFrame, rank: int, hist: dict[int, int]) -> Cut:
    """The key of the ``rank``-th row of (_h hex hash, _k key) in their order. ``hist`` are the counts over
    the first 16 bits; a second histogram and the few keys of one sub-bucket give the rest."""
    hex_digits = LEVEL_BITS // 4
    b1, b2 = _bits(F.col("_h"), 1, hex_digits), _bits(F.col("_h"), 1 + hex_digits, hex_digits)
    top, rank = _pick(hist, rank)
    inside = keys.filter(b1 == top)
    sub, rank = _pick(_histogram(inside, b2), rank)
    # distinct keys of one 2^-32 share of the hash range, with their counts
    last = inside.filter(b2 == sub).groupBy("_h", "_k").count().orderBy("_h", "_k").collect()
    at, need = _pick(dict(enumerate(r["count"] for r in last)), rank)
    return Cut(last[at]["_h"], last[at]["_k"], need, last[at]["count"])


def _top_histogram(keys: DataFrame) -> dict[int, int]:
    return _histogram(keys, _bits(F.col("_h"), 1, LEVEL_BITS // 4))


def _named(c: Column) -> Column:
    return F.when(c, F.lit("validation")).otherwise(F.lit("train"))


COPIES = 10_000


def split_exact(df: DataFrame, key: Column, seed: int = SEED, share: float = VALIDATION_SHARE) -> DataFrame:
    """Adds ``split`` ('validation' | 'train').

    The cut value comes from histograms over the keys alone; rows then pass through with one
    comparison. Rows that share the cut key beyond the exact size are cut the same way, by a hash of
    the whole row; rows equal in all columns by their number. No step sorts rows or brings those of
    one key together, however many share it.
    """
    k = F.coalesce(key, F.lit(""))
    h = order_hash(k, seed)
    keys = df.select(h.alias("_h"), k.alias("_k"))
    hist = _top_histogram(keys)
    n_val = validation_size(sum(hist.values()), share)
    if n_val == 0:
        return df.withColumn("split", F.lit("train"))
    cut = find_cut(keys, n_val, hist)
    same = (h == cut.h) & (k == cut.k)
    before = (h < cut.h) | ((h == cut.h) & (k < cut.k))
    if cut.need == cut.count:
        return df.withColumn("split", _named(before | same))
    whole = row_identity(df)
    tied = df.filter(same).select(whole.alias("_h"), F.lit("").alias("_k"))
    row = find_cut(tied, cut.need, _top_histogram(tied))
    if row.need == row.count:
        return df.withColumn("split", _named(before | (same & (whole <= row.h))))
    copies = df.filter(same & (whole == row.h)).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    copies = copies.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
    copies = copies.repartition("_from").withColumn(
        "_i", F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("_n")) - 1)))
    copies = copies.select(*df.columns, _named(F.col("_i") < row.need).alias("split"))
    rest = df.filter(~(same & (whole == row.h)))
    return rest.withColumn("split", _named(before | (same & (whole < row.h)))).unionByName(copies)


def split_exact_sql(base_sql: str, key_sql: str, seed: int = SEED, share: float = VALIDATION_SHARE) -> str:
    return f"""
WITH b AS (SELECT *, md5('{seed}|' || {key_sql}) AS h_, {key_sql} AS k_ FROM ({base_sql})),
r AS (SELECT *, row_number() OVER (ORDER BY h_, k_) AS rn_, count(*) OVER () AS n_ FROM b)
SELECT * EXCLUDE (h_, k_, rn_, n_),
       CASE WHEN rn_ <= greatest(1, CAST(floor(n_ * {share}) AS BIGINT)) THEN 'validation' ELSE 'train' END AS split
FROM r"""


def split_group(df: DataFrame, group_key: Column, seed: int = SEED, share: float = VALIDATION_SHARE) -> DataFrame:
    """A group goes to validation when its hash falls below ``share`` (no shuffle)."""
    u = _bits(order_hash(group_key, seed), 1, 8)
    return df.withColumn("split", F.when(u < F.lit(int(share * 2**32)), "validation").otherwise("train"))


def split_group_sql(base_sql: str, group_key_sql: str, seed: int = SEED, share: float = VALIDATION_SHARE) -> str:
    u = f"CAST(('0x' || substring(md5('{seed}|' || {group_key_sql}), 1, 8)) AS BIGINT)"
    return f"SELECT *, CASE WHEN {u} < {int(share * 2**32)} THEN 'validation' ELSE 'train' END AS split FROM ({base_sql})"


def split_group_exact(df: DataFrame, group_key: Column, seed: int = SEED, share: float = VALIDATION_SHARE) -> DataFrame:
    """L2b with the size of the law: groups in hash order (ties by key) are validation until they hold
    ``max(1, int(share * n))`` rows together. Rows without a group key form one group."""
    k = F.coalesce(group_key, F.lit(""))
    h = order_hash(k, seed)
    keys = df.select(h.alias("_h"), k.alias("_k"))
    hist = _top_histogram(keys)
    n_val = validation_size(sum(hist.values()), share)
    if n_val == 0:
        return df.withColumn("split", F.lit("train"))
    cut = find_cut(keys, n_val, hist)
    return df.withColumn("split", _named((h < cut.h) | ((h == cut.h) & (k <= cut.k))))


def split_group_exact_sql(base_sql: str, group_key_sql: str, seed: int = SEED, share: float = VALIDATION_SHARE) -> str:
    return f"""
WITH b AS (SELECT *, coalesce({group_key_sql}, '') AS k_, md5('{seed}|' || coalesce({group_key_sql}, '')) AS h_ FROM ({base_sql})),
g AS (SELECT h_, k_, count(*) AS n_ FROM b GROUP BY h_, k_),
c AS (SELECT h_, k_, coalesce(sum(n_) OVER (ORDER BY h_, k_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_,
             greatest(1, CAST(floor(sum(n_) OVER () * {share}) AS BIGINT)) AS size_ FROM g)
SELECT b.* EXCLUDE (h_, k_), CASE WHEN before_ < size_ THEN 'validation' ELSE 'train' END AS split FROM b JOIN c ON b.h_ = c.h_ AND b.k_ = c.k_"""


def split_counts(split_df: DataFrame) -> DataFrame:
    """AG5/K4: the metadata document (train_rows, validation_rows) as one row."""
    return split_df.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "validation").alias("validation_rows"),
    )


def split_counts_sql(split_sql: str) -> str:
    return (f"SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, "
            f"count(*) FILTER (WHERE split = 'validation') AS validation_rows FROM ({split_sql})")
