"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``. All but
the last return the columns of ``docs``; each works on all the rows it gets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import minhash, queries, secrets, toxicity
from tablewright.llm.shared import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not find toxic. It learns from the
    labelled rows of ``docs`` that are not held out. Each row is judged by its own
    text, also where an id repeats or is null; null and empty texts are scored as
    empty ones, and an empty table gives an empty table."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    return toxicity.score(rows, model, carry=("_row",)).where("predicted = 0").select("_row.*")


def row_key(docs: DataFrame) -> Column:
    """The same for rows of equal id and text only: 128 bits of a digest."""
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.substring(F.sha2(F.concat_ws(":", id_, F.coalesce(F.sha2("text", 256), F.lit("-"))), 256), 1, 32))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity 0.8): the one with the smallest id, null last, and of several texts
    of this id the one with the smallest key. Texts are judged one by one, so other
    texts of the same id stay; rows that repeat the kept one go. Null and empty
    texts and texts without words are in no group and stay, repeated or not. An
    empty table gives an empty table."""
    keyed = docs.select(row_key(docs).alias("_key"), "doc_id", "text")
    found = minhash.grouped(keyed, {"id": "doc_id", "key": "_key"}, width=5, percent=80)
    found = written(found.where("component is not null").groupBy("component", "id", "key").count(), "near-duplicates")
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("key"))
    best = found.groupBy("component").agg(F.min(rank).alias("best"))
    judged = found.join(best, "component").select("key", "count", (F.col("key") == F.col("best.key")).alias("kept"))
    # Written, so that Spark knows their size when it chooses how to join.
    judged = written(judged.where("not kept or count > 1"), "judged")
    dropped = judged.where("not kept").select(F.col("key").alias("_key"))
    again = judged.where("kept").select(F.col("key").alias("_key"))
    # Only rows that may be judged are shuffled with their texts.
    marked = minhash.maybe_among(docs.withColumn("_key", row_key(docs)), "_key", judged.select(F.col("key").alias("_key")))
    rest = marked.where("_maybe").join(dropped, "_key", "left_anti")
    out = marked.where("not _maybe")
    if not again.take(1):
        return out.unionByName(rest.select(*out.columns)).select(*docs.columns)
    once = rest.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    rest = rest.join(again, "_key", "left_anti").unionByName(once)
    return out.unionByName(rest.select(*out.columns)).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark; ``n_chars`` follows. Every
    row stays, repeated ones too; null texts stay null and keep their ``n_chars``;
    an empty table gives an empty table."""
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    n = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", n)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there. A null
    or empty text is one piece with the end id; repeated rows and rows without an
    id are packed each; an empty table gives no piece."""
    return queries.pack_documents(docs)
