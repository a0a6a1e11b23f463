"""Rows as JSON messages, written to a message sink (Kafka by default).

Each row becomes one message whose value is a JSON object of all columns
(nulls written as ``null``; NaN is turned into null first so the text is
valid JSON). The Kafka write is Spark's batch Kafka sink with producer
``acks=all`` and 3 retries; a failed send fails the task and Spark retries it.
Connection settings come from arguments, overridable by the
``KAFKA_BOOTSTRAP_SERVERS`` / ``KAFKA_TOPIC`` / ``KAFKA_BATCH_SIZE``
environment variables, as in the stage being reproduced.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import config as C
from tablewright.functions.names import col


def nan_to_null(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` (JSON text of the row) and optionally ``key``."""
    clean = nan_to_null(df)
    value = F.to_json(F.struct(*[col(c) for c in clean.columns]), {"ignoreNullFields": "false"})
    cols = [value.alias("value")]
    if key:
        cols.insert(0, col(key).cast("string").alias("key"))
    return clean.select(*cols)


def kafka_settings(servers: str = C.KAFKA_SERVERS, topic: str = C.KAFKA_TOPIC,
                   batch_size: int = C.MESSAGE_BATCH_SIZE) -> dict:
    return {
        "servers": os.environ.get("KAFKA_BOOTSTRAP_SERVERS", servers),
        "topic": os.environ.get("KAFKA_TOPIC", topic),
        "batch_size": int(os.environ.get("KAFKA_BATCH_SIZE", batch_size)),
    }


def kafka_options(servers: str = C.KAFKA_SERVERS, topic: str = C.KAFKA_TOPIC) -> dict[str, str]:
    """Options of Spark's Kafka sink: every broker confirms, three retries."""
    s = kafka_settings(servers, topic)
    return {"kafka.bootstrap.servers": s["servers"], "topic": s["topic"], "kafka.acks": "all", "kafka.retries": "3"}


def write_messages(df: DataFrame, fmt: str = "kafka", path: str | None = None,
                   servers: str = C.KAFKA_SERVERS, topic: str = C.KAFKA_TOPIC,
                   extra: dict | None = None) -> int:
    """Write ``to_messages(df)`` and return the number of messages sent
    (counted during the write with an observation, no second pass). A message
    that cannot be sent fails the task; ``sinks.delivery`` counts them instead.
    ``fmt="kafka"`` needs the Spark Kafka connector on the classpath; any file
    format (``json``, ``text``, ``parquet``) writes the messages to ``path``."""
    sent = Observation("messages_sent")
    msgs = to_messages(df).observe(sent, F.count(F.lit(1)).alias("sent"))
    w = msgs.write
    if fmt == "kafka":
        w.format("kafka").options(**kafka_options(servers, topic), **(extra or {})).save()
    else:
        w.mode("overwrite").format(fmt).save(path)
    return int(sent.get["sent"])
