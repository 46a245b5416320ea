"""Helpers shared by the operators: shared work folders, saved tables, private column names."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import shared_dir, ship_package

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder; removed when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/corpusprep-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder made by work_dir, through Spark's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows reads files that survive the loss of any executor, with exact
    sizes for the planner and column pruning.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by saved(), once nothing reads it any more."""
    path = _FOLDERS.pop(df, None)
    if path:
        drop_dir(df.sparkSession, path)


def no_broadcast(df: DataFrame) -> DataFrame:
    """df as a side of a sort-merge join. A table with a row per document or fingerprint is small as a compressed
    file long before it is small as a hash table, which a broadcast join builds in the driver's memory."""
    return df.hint("merge")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def for_workers(spark: SparkSession) -> None:
    """Make the functions of this package importable in Python workers."""
    ship_package(spark)


def send_file(spark: SparkSession, path: str) -> str:
    """Send a file that the driver can read to all workers, once per application; returns the name by which workers
    find it with SparkFiles.get()."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of df, however they are cased."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def refuse(df: DataFrame, *names: str | None) -> None:
    """Raise if df has a column named like one that is to be added, in any case: a table with two such columns
    could not be used any further."""
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names if n}
    if clash:
        raise ValueError(f"the table already has {sorted(clash)}; pass other names")


def col(name: str):
    """A column by its literal name (dots and backquotes are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(df: DataFrame):
    """A 64-bit hash of a whole row: tells rows apart that share an id. Nulls and their place count."""
    parts = []
    for c in df.columns:
        parts += [F.xxhash64(col(c).cast("string") if df.schema[c].dataType.typeName() in ("map", "variant") else col(c)),
                  col(c).isNull()]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")
