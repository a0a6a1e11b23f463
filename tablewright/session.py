"""Session helpers: building a session for local runs and finding the shared
checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names
(a shared file system). A folder of our own is created only when that setting
is absent, which is the case in tests and local benchmarks.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, configured from the session if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A folder on the driver's disk is not visible to executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(written tables and checkpoints go there)")
        # Only reached in local runs with nothing configured (tests, benchmarks).
        configured = tempfile.mkdtemp(prefix="tablewright-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give Python workers on other machines this package, once for a session."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    _SENT.add(app)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"     # sent to the executors by Spark
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablewright-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads the table instead of
    recomputing the plan) and stores columnar, compressed data."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
