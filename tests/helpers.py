"""Apply columns and chains to lists of strings."""


def run_col(spark, fn, values, col="x"):
    """Apply a Column function to a list of strings, keep input order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {col} string")
    return [r["o"] for r in df.select("i", fn(F.col(col)).alias("o")).orderBy("i").collect()]


def run_chain(spark, chain, values, col="x"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {col} string")
    return [r["o"] for r in chain.apply(df, col, "o").select("i", "o").orderBy("i").collect()]
