"""Delivery of messages with accounts of what was sent and what failed.

A Python data source writer hands the messages of every task to a transport in
batches, sends those that failed again, and counts. Its commit message carries
the task's account to the driver, which writes one report for the whole delivery
when all tasks are done. A task that is run again after an executor was lost sends
its messages again (at least once), but only the committed attempt is in the
report.

A transport is a callable made for each task, ``transport(task)``, whose ``send``
takes a list of values and returns the places of those it could not deliver (an
exception: all of them), and whose ``close`` says that the task is done.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tablewright import config as C
from tablewright.session import scratch_path, send_package
from tablewright.sinks.messages import to_messages
from tablewright.sinks.store import store_of

REPORT = "task long, sent long, failed long, batches long, resent long"


class FileTransport:
    """Messages as lines of one file for each task, in a shared folder. The file
    gets its name when the task is done, so a lost attempt leaves none."""

    def __init__(self, path: str, task: int):
        self.store, root = store_of(path)
        self.store.create_dir(root, recursive=True)
        self.final = f"{root}/part-{task:05d}.jsonl"
        self.at = f"{root}/_{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.at, compression=None)

    def send(self, values: list[str]) -> list[int]:
        self.out.write("".join(v + "\n" for v in values).encode("utf-8"))
        return []

    def close(self) -> None:
        self.out.close()
        self.store.move(self.at, self.final)


def file_transport(path: str) -> Callable[[int], FileTransport]:
    return lambda task: FileTransport(path, task)


@dataclass
class Account(WriterCommitMessage):
    task: int
    sent: int = 0
    failed: int = 0
    batches: int = 0
    resent: int = 0


def send_all(values: Iterator[list[str]], transport, account: Account, retries: int, pause: float = 0.0) -> Account:
    """Send every batch, and what of it failed up to ``retries`` times more."""
    for batch in values:
        account.batches += 1
        rest = batch
        for attempt in range(retries + 1):
            if attempt:
                account.resent += len(rest)
                time.sleep(pause * 2 ** (attempt - 1))
            try:
                failed = sorted(set(transport.send(rest)))
            except Exception:  # noqa: BLE001  (whatever a transport raises, its batch was not delivered)
                failed = range(len(rest))
            account.sent += len(rest) - len(failed)
            rest = [rest[k] for k in failed]
            if not rest:
                break
        account.failed += len(rest)
    return account


def batches_of(batches, size: int) -> Iterator[list[str]]:
    """The first column of Arrow batches as lists of ``size`` values."""
    held: list[str] = []
    for batch in batches:
        held += batch.column(0).to_pylist()
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held:
        yield held


def _source(transport: Callable, report: str, batch_size: int, retries: int, pause: float) -> type[DataSource]:
    class Writer(DataSourceArrowWriter):
        def write(self, iterator):
            task = TaskContext.get().partitionId()
            to = transport(task)
            account = send_all(batches_of(iterator, batch_size), to, Account(task), retries, pause)
            to.close()
            return account

        def commit(self, messages):
            store, root = store_of(report)
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/delivery.json", compression=None) as out:
                for m in messages:
                    if m is not None:
                        out.write((json.dumps(vars(m)) + "\n").encode())

    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return "delivery"

        def schema(self) -> str:
            return "value string"

        def writer(self, schema, overwrite):
            return Writer()

    return Delivery


def deliver(df: DataFrame, transport: Callable, batch_size: int = C.MESSAGE_BATCH_SIZE, retries: int = 3,
            pause: float = 0.1) -> DataFrame:
    """Send every row of ``df`` as a JSON message and return the report: for each
    task how many messages were sent and failed for good, in how many batches, and
    how many were sent again."""
    spark = df.sparkSession
    send_package(spark)
    report = scratch_path(spark, "delivery")
    spark.dataSource.register(_source(transport, report, batch_size, retries, pause))
    to_messages(df).select("value").write.format("delivery").mode("append").save()
    return spark.read.schema(REPORT).json(report)


def totals(report: DataFrame) -> DataFrame:
    """``(sent, failed)`` of a whole delivery."""
    return report.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "failed")])
