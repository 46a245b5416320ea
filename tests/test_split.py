"""Split law, determinism and group split."""

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import split as SP


@pytest.mark.parametrize("n,expected", [(1, (0, 1)), (2, (1, 1)), (19, (18, 1)), (2521, (2269, 252))])
def test_exact_counts(spark, n, expected):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    c = SP.split_counts(SP.split_exact(df, F.col("k"))).collect()[0]
    assert (c.train_rows, c.validation_rows) == expected


def test_equal_keys_are_split_exactly(spark):
    same = spark.createDataFrame([("k", "t")] * 100, "k string, t string")
    c = SP.split_counts(SP.split_exact(same, F.col("k"))).collect()[0]
    assert (c.train_rows, c.validation_rows) == (90, 10)
    mixed = spark.createDataFrame([("k" if i % 3 else None, f"t{i % 7}") for i in range(1000)], "k string, t string")
    out = SP.split_exact(mixed, F.col("k"))
    c = SP.split_counts(out).collect()[0]
    assert (c.train_rows, c.validation_rows) == (900, 100)
    assert sorted(map(repr, out.drop("split").collect())) == sorted(map(repr, mixed.collect()))


def test_histograms_read_keys_only(spark, tmp_path):
    """The texts are not read while the cut is looked for: a plan of the histogram has the key alone."""
    spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("long text").alias("t")).write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    plan = df.select(SP.order_hash(F.col("k")).alias("_h")).groupBy(SP._bits(F.col("_h"), 1, 4)).count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string>" in plan
    out = SP.split_exact(df, F.col("k"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_same_split_for_any_partitioning(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    a = {r.k: r.split for r in SP.split_exact(df.repartition(3), F.col("k")).collect()}
    b = {r.k: r.split for r in SP.split_exact(df.repartition(11), F.col("k")).collect()}
    assert a == b


def test_blank_pairs_dropped_first(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), ("a", None), (" ", "x"), ("c", "d")], "i string, t string")
    got = sorted((r.input_text, r.target_text) for r in SP.prepare_pairs(df, "i", "t").collect())
    assert got == [("a", "b"), ("c", "d")]


def test_group_split_keeps_groups_together(spark):
    df = spark.range(2000).select((F.col("id") % 97).cast("string").alias("g"), F.col("id"))
    out = SP.split_group(df, F.col("g"))
    assert out.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_many_tied_rows_are_cut_by_their_hash(spark):
    """One key with all rows, all different or with large groups of copies: no window, no sort, exact sizes."""
    for rows in (spark.range(4000).select(F.lit("k").alias("k"), F.col("id").alias("v")),
                 spark.range(4000).select(F.lit("k").alias("k"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("v"))):
        out = SP.split_exact(rows, F.col("k"))
        c = SP.split_counts(out).collect()[0]
        assert (c.train_rows, c.validation_rows) == (3600, 400)
        assert sorted(r.v for r in out.collect()) == sorted(r.v for r in rows.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SinglePartition" not in plan
        again = SP.split_exact(rows.repartition(13), F.col("k"))
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
