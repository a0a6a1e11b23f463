"""Incremental load: stream the rows of a growing folder of prepared tables
out as JSON messages.

A Structured Streaming query over the folder; every micro-batch (bounded by
``max_files_per_trigger``) is converted with :func:`to_messages` and written
to the sink. The checkpoint location (under the shared checkpoint folder by
default) records which files were sent, so a restarted query resumes where it
stopped and a lost executor only re-runs its tasks.

:func:`load_once` keeps a ledger at the sink besides: a batch that the query
runs again (it stopped after writing and before its checkpoint) writes nothing
twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright import config as C
from tablewright.session import scratch_path
from tablewright.sinks.messages import kafka_options, to_messages

LEDGER = "stream string, batch long, messages long, folder string"


def _rows(spark: SparkSession, source: str, schema, source_format: str, max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(schema).format(source_format)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(source))


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")


def stream_messages(spark: SparkSession, source: str, schema, fmt: str = "kafka",
                    path: str | None = None, checkpoint: str | None = None,
                    source_format: str = "parquet", max_files_per_trigger: int = 1,
                    available_now: bool = True, servers: str = C.KAFKA_SERVERS,
                    topic: str = C.KAFKA_TOPIC) -> StreamingQuery:
    msgs = to_messages(_rows(spark, source, schema, source_format, max_files_per_trigger))
    w = msgs.writeStream.option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    if fmt == "kafka":
        w = w.format("kafka").options(**kafka_options(servers, topic))
    else:
        w = w.format(fmt).option("path", path)
    return _triggered(w, available_now).start()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The batches that are loaded at ``path``: ``(stream, batch, messages, folder)``."""
    from tablewright.sources.side_tables import read_or_empty

    return read_or_empty(spark, f"{path.rstrip('/')}/_ledger", LEDGER, "parquet")


def write_batch_once(batch: DataFrame, number: int, path: str, stream: str) -> bool:
    """Write a batch of messages unless the ledger has it. Data come first, in a
    folder named by stream and batch that an interrupted attempt's data are
    replaced in; the ledger entry follows, and only batches with an entry are read."""
    spark, path = batch.sparkSession, path.rstrip("/")
    if ledger(spark, path).where((F.col("stream") == stream) & (F.col("batch") == number)).take(1):
        return False
    folder = f"stream={stream}/batch={number}"
    batch.write.mode("overwrite").text(f"{path}/{folder}")
    n = spark.read.text(f"{path}/{folder}").count()
    entry = spark.createDataFrame([(stream, number, n, folder)], LEDGER).coalesce(1)
    entry.write.mode("append").parquet(f"{path}/_ledger")
    return True


def load_once(spark: SparkSession, source: str, schema, path: str, checkpoint: str, source_format: str = "parquet",
              max_files_per_trigger: int = 1, available_now: bool = True) -> StreamingQuery:
    """Load the rows of the files that arrive at ``source`` as messages at ``path``,
    each file once, also if a batch is run again."""
    msgs = to_messages(_rows(spark, source, schema, source_format, max_files_per_trigger))

    def write(batch: DataFrame, number: int) -> None:
        # The id of the query is kept in its checkpoint, so a restarted query has the same.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        write_batch_once(batch.select("value"), number, path, stream)

    w = msgs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _triggered(w, available_now).start()


def loaded_messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages (``value``) of the batches in the ledger, and of no others."""
    path = path.rstrip("/")
    folders = [r["folder"] for r in ledger(spark, path).select("folder").collect()]   # a row for each batch
    if not folders:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{path}/{f}" for f in folders]).select("value")
