"""Session helpers: local sessions for tests/bench, the shared folder, shipping the package."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Per driver process: the scratch folder of local sessions, the application that has the package.
_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusprep") -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master may go without the setting (tests); it then gets a scratch folder.
    On a cluster a missing setting is an error, never a machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
    if "dir" not in _SCRATCH:
        _SCRATCH["dir"] = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
    return _SCRATCH["dir"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder; removed when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/corpusprep-{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context's checkpoints at shared_dir(spark)."""
    folder = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that functions defined
    in it can run there wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if _SCRATCH.get("shipped") == app:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="corpusprep-zip-")) / "corpusprep_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SCRATCH["shipped"] = app


def spread(df: DataFrame) -> DataFrame:
    """Round-robin rows over the cluster when the scan has fewer partitions than there are cores.

    Text cleaning is CPU-bound per row. A large input already arrives in many splits and is left
    alone (no shuffle); a small file with a single row group would otherwise run in one task. Only
    the number of tasks depends on this, never the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
