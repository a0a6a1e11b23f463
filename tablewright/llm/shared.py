"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import scratch_path

#: Rows that one Arrow batch may carry to a Python worker. Texts can be long,
#: so the default of 10,000 rows would not bound a worker's memory.
ARROW_ROWS = 256
_SENT: set[str] = set()


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before Python runs on executors: send them this package, and keep Arrow
    batches small (the session's setting is only ever lowered)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        _SENT.add(app)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"   # sent to the executors by Spark
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (of a type
    with an order). ``array_max`` takes the only element out; ``get`` would
    derive the type of the whole body again for every row."""
    return F.array_max(F.transform(F.array(value), body))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and re-read (not
    recomputed) when an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
