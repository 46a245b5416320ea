"""Versioned folders: every run of a resumable job adds ``version=<n>`` below one root.

A version counts once its job has committed (Spark's ``_SUCCESS`` mark); what a lost driver left behind is
overwritten by the next run. All access goes through Spark's file system, so any store will do.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending; none if the root is missing."""
    fs, p = _folder(spark, root)
    if not fs.exists(p):
        return []
    done = []
    for s in fs.listStatus(p):
        m = re.fullmatch(r"version=(\d+)", s.getPath().getName())
        if m and fs.exists(_folder(spark, f"{s.getPath()}/_SUCCESS")[1]):
            done.append(int(m.group(1)))
    return sorted(done)


def read_versions(spark: SparkSession, root: str, schema: str, upto: int | None = None) -> DataFrame:
    """Rows of all complete versions (up to one), or an empty table."""
    paths = [f"{root}/version={n}" for n in committed(spark, root) if upto is None or n <= upto]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def add_version(df: DataFrame, root: str) -> int:
    """Write df as the next version; returns its number."""
    n = max(committed(df.sparkSession, root), default=0) + 1
    df.write.mode("overwrite").parquet(f"{root}/version={n}")
    return n
