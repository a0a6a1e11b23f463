"""Delivery with a transport that fails on purpose, a ledger of loaded batches,
and the options of the Kafka sink."""

import json
import os

from tablewright.sinks import delivery as D
from tablewright.sinks.messages import kafka_options
from tablewright.streaming import messages as S


def flaky(path):
    """Made here, so that workers get the class itself and not its module."""
    class Flaky:
        """Fails a message once if its number is divisible by 7 and for good if by 50;
        raises on every fourth batch at first."""

        def __init__(self, path, task):
            self.files, self.seen, self.calls = D.FileTransport(path, task), set(), 0

        def send(self, values):
            self.calls += 1
            if self.calls % 4 == 0:
                raise ConnectionError("no answer")
            failed = []
            for k, v in enumerate(values):
                x = json.loads(v)["x"]
                if x % 50 == 0 or (x % 7 == 0 and x not in self.seen):
                    self.seen.add(x)
                    failed.append(k)
            self.files.send([v for k, v in enumerate(values) if k not in failed])
            return failed

        def close(self):
            self.files.close()

    return lambda task: Flaky(path, task)


def test_accounts_of_a_failing_transport(spark, tmp_dir):
    df = spark.range(1000).withColumnRenamed("id", "x").repartition(3)
    report = D.deliver(df, flaky(f"{tmp_dir}/out"), batch_size=40, retries=5, pause=0.0)
    rows = report.collect()
    assert len(rows) == 3 and sum(r.batches for r in rows) >= 25 and sum(r.resent for r in rows) > 100
    assert tuple(D.totals(report).first()) == (980, 20)
    arrived = sorted(json.loads(r.value)["x"] for r in spark.read.text(f"{tmp_dir}/out").collect())
    assert arrived == [x for x in range(1000) if x % 50]


def test_without_retries_every_failure_counts(spark, tmp_dir):
    report = D.deliver(spark.range(100).withColumnRenamed("id", "x").coalesce(1), flaky(f"{tmp_dir}/o"), 1000, retries=0)
    assert tuple(D.totals(report).first()) == (100 - len([x for x in range(100) if x % 7 == 0 or x % 50 == 0]),
                                               len([x for x in range(100) if x % 7 == 0 or x % 50 == 0]))


def test_delivery_of_nothing(spark, tmp_dir):
    report = D.deliver(spark.range(0).withColumnRenamed("id", "x"), D.file_transport(f"{tmp_dir}/none"))
    assert tuple(D.totals(report).first()) == (0, 0)


def test_only_finished_tasks_leave_files(tmp_dir):
    to = D.FileTransport(f"{tmp_dir}/f", 4)
    to.send(["a"])
    assert [f for f in os.listdir(f"{tmp_dir}/f") if not f.startswith("_")] == []
    to.close()
    assert os.listdir(f"{tmp_dir}/f") == ["part-00004.jsonl"]


def test_a_replayed_batch_writes_nothing_twice(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("src", "out", "ck"))
    load = lambda where: S.load_once(spark, src, "x long", out, where).awaitTermination(120)
    arrived = lambda: sorted(json.loads(r.value)["x"] for r in S.loaded_messages(spark, out).collect())
    assert S.loaded_messages(spark, out).count() == 0
    spark.range(5).withColumnRenamed("id", "x").coalesce(1).write.parquet(src)
    load(ck)
    assert arrived() == list(range(5))
    entries = S.ledger(spark, out).collect()
    # The batch is run again, with its own rows or with others.
    batch = spark.createDataFrame([('{"x":77}',)], "value string")
    assert not any(S.write_batch_once(batch, e.batch, out, e.stream) for e in entries)
    assert arrived() == list(range(5))
    # Data of an attempt that ended before its entry are not read, and are replaced.
    number = max(e.batch for e in entries) + 1
    batch.write.text(f"{out}/stream={entries[0].stream}/batch={number}")
    assert arrived() == list(range(5))
    spark.range(5, 8).withColumnRenamed("id", "x").coalesce(1).write.mode("append").parquet(src)
    load(ck)
    assert arrived() == list(range(8))
    load(ck)
    assert arrived() == list(range(8))


def test_kafka_options(monkeypatch):
    for name in ("KAFKA_BOOTSTRAP_SERVERS", "KAFKA_TOPIC"):
        monkeypatch.delenv(name, raising=False)
    assert kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "3"}
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "other:2")
    monkeypatch.setenv("KAFKA_TOPIC", "u")
    assert kafka_options("h:1", "t")["kafka.bootstrap.servers"] == "other:2" and kafka_options()["topic"] == "u"
