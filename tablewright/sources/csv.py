"""Raw CSV scan: header, quoted multi-line fields, NA tokens to null.

Every column is read as STRING (no schema inference pass); the semantic types
come from the profile afterwards. ``row_id`` follows file order: files by
path, rows by position inside the file.

A line feed ends a record only outside quotes, so a file with quoted line feeds
cannot be cut at any line. It is cut all the same: lines are read in splits, and
whether a split begins inside quotes follows from the parity of all quotes before
it. One pass gives every split's parity and how many records end in it under
either beginning; a running sum over that table (a row for each split) gives each
split its beginning and its first record number. The second pass joins the lines
of a record within a split where they are; only the pieces of records that cross
a split are brought together, by record number. Neither rows nor ids are sorted.

Records with fewer fields than the header end in nulls; one with more raises an
error that shows it. Blank lines outside quotes are no records.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.config import NA_TOKENS
from tablewright.functions.names import col
from tablewright.session import send_package
from tablewright.sources.tables import spread

QUOTE = '"'


def null_na_tokens(df: DataFrame, columns=None) -> DataFrame:
    """Turn the NA tokens into null in the given (default: all string) columns."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(~F.array_contains(tokens, col(c)), col(c)))
    return out


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _stretches(batches) -> Iterator[tuple[str, int, object]]:
    """(file, start, lines) for every stretch of a batch that comes from one split."""
    import numpy as np
    import pyarrow.compute as pc
    for batch in batches:
        file, start, value = batch.columns
        if not len(file):
            continue
        moved = np.flatnonzero((np.diff(start.to_numpy()) != 0) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)) + 1
        edges = [0, *moved.tolist(), len(file)]
        for a, b in zip(edges, edges[1:]):
            yield file[a].as_py(), start[a].as_py(), value[a:b]


def _parity(lines, before: int):
    """For each line whether an odd number of quotes stands before its end."""
    import numpy as np
    import pyarrow.compute as pc
    quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
    return (np.cumsum(quotes) + before) % 2


def splits(lines: DataFrame) -> DataFrame:
    """``(file, start, parity, even, odd)``: of every split the parity of its quotes
    and how many records end in it if it begins outside or inside quotes."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        found: dict = {}
        for file, start, part in _stretches(batches):
            held = found.setdefault((file, start), [0, 0, 0])
            parity = _parity(part, held[0])
            written = ~pc.is_in(part, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            held[1] += int(np.count_nonzero((parity == 0) & written))
            held[2] += int(np.count_nonzero((parity == 1) & written))
            held[0] = int(parity[-1])
        yield pa.record_batch([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
                               *(pa.array([v[j] for v in found.values()], pa.int64()) for j in range(3))],
                              names=["file", "start", "parity", "even", "odd"])

    return lines.mapInArrow(run, "file string, start long, parity long, even long, odd long")


def beginnings(counted: DataFrame) -> DataFrame:
    """``(file, start, inside, first)``: whether a split begins inside quotes, and the
    number of the record that it begins with. Records of all files are numbered in
    one row, headers left out: a header has the number before its file's first."""
    of_file = Window.partitionBy("file").orderBy("start")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    quoted = counted.withColumn("inside", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    quoted = quoted.withColumn("ends", F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd")))
    placed = quoted.withColumn("before", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    # A quote that is never closed leaves a last record without an end.
    sizes = placed.groupBy("file").agg(F.greatest(F.sum("ends") + F.sum("parity") % 2 - 1, F.lit(0)).alias("rows"))
    sizes = sizes.withColumn("offset", F.coalesce(F.sum("rows").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))     # a row for each file
    return placed.join(sizes, "file").select("file", "start", "inside", (F.col("offset") + F.col("before") - 1).alias("first"),
                                             F.col("offset").alias("offset"))


def _records(lines: DataFrame, begin: dict) -> DataFrame:
    """``(id, part, whole, text)``: the records that end in the split they begin in,
    and the pieces of the others with their place (the split's start)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        names = ["id", "file", "part", "whole", "text"]

        def out(file, start, ids, whole, texts):
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array([file] * len(ids), pa.string()), pa.array([start] * len(ids), pa.int64()),
                                    pa.array(whole, pa.bool_()), pa.array(texts, pa.string())], names=names)

        at, open_, crosses, number, parity = None, [], False, 0, 0
        for file, start, part in _stretches(batches):
            if at != (file, start):
                if open_:
                    yield out(*at, [number], [False], ["\n".join(open_)])
                at, open_ = (file, start), []
                inside, number = begin[at]
                crosses, parity = bool(inside), int(inside)
            state = _parity(part, parity)
            parity = int(state[-1])
            texts = part.to_pylist()
            ends = (np.flatnonzero(state == 0) + 1).tolist()
            ids, whole, found, last = [], [], [], 0
            for end in ends:
                text = texts[last] if end - last == 1 and not open_ else "\n".join([*open_, *texts[last:end]])
                open_, last = [], end
                if text in ("", "\r") and not crosses:
                    continue
                ids.append(number), whole.append(not crosses), found.append(text)
                number, crosses = number + 1, False
            open_ += texts[last:]
            if ids:
                yield out(file, start, ids, whole, found)
        if open_:
            yield out(*at, [number], [False], ["\n".join(open_)])

    return lines.mapInArrow(run, "id long, file string, part long, whole boolean, text string")


def _names(header: str, sep: str) -> list[str]:
    """Column names: blank ones by their place, repeated ones with it appended."""
    raw = next(csv.reader([header], delimiter=sep, quotechar=QUOTE), [])
    raw = [n if n else f"_c{k}" for k, n in enumerate(raw)]
    small = [n.lower() for n in raw]
    return [f"{n}{k}" if small.count(n.lower()) > 1 else n for k, n in enumerate(raw)]


def csv_records(spark: SparkSession, path) -> tuple[DataFrame, list[str]]:
    """(``id``, ``text`` of every record but the headers; the files' headers)."""
    send_package(spark)
    lines = _lines(spark, path)
    rows = beginnings(splits(lines)).collect()          # a row for each split of the files
    begin = {(r["file"], r["start"]): (r["inside"], r["first"]) for r in rows}
    offsets = {r["file"]: r["offset"] for r in rows}
    pieces = _records(lines, begin)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "\n")
    crossing = pieces.where(~F.col("whole")).groupBy("id", "file").agg(joined.alias("text"))
    every = pieces.where("whole").select("id", "file", "text").unionByName(crossing)
    # A header may have the number of the last row of the file before.
    header_id = F.create_map(*[F.lit(x) for f, o in offsets.items() for x in (f, o - 1)]) if len(offsets) <= 256 else None
    if header_id is None:
        table = spark.createDataFrame([(f, o - 1) for f, o in offsets.items()], "_file string, _header long")
        every = every.join(table, F.col("file") == F.col("_file")).drop("_file")
    else:
        every = every.withColumn("_header", F.element_at(header_id, F.col("file"))) if offsets else every.withColumn("_header", F.lit(None).cast("long"))
    is_header = F.col("id") == F.col("_header")
    # The first split of a file holds its header unless the header itself crosses it.
    headers = [r["text"] for r in every.where(is_header).select("text").distinct().limit(2).collect()] if rows else []
    body = F.regexp_replace("text", "\r$", "")
    return every.where(~is_header).select("id", body.alias("text")), [re.sub("\r$", "", h) for h in headers]


def read_raw_csv(spark: SparkSession, path: str, row_id: str | None = "row_id",
                 sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All-string scan of a headed CSV (file or folder). Text that is not UTF-8 is
    read one task for each file."""
    if encoding.upper().replace("-", "") != "UTF8":
        return _read_files(spark, path, row_id, sep, encoding)
    records, headers = csv_records(spark, path)
    columns = {tuple(_names(h.removeprefix("﻿"), sep)) for h in headers}
    if len(columns) > 1:
        raise ValueError(f"the files of {path} have different headers: {' / '.join(sorted(map(str, columns)))}")
    if not columns:
        raise ValueError(f"{path} has no header")
    names = list(columns.pop())
    fields = [f"c{k}" for k in range(len(names))]
    parsed = F.from_csv("text", ", ".join(f"{f} string" for f in [*fields, "bad"]), {
        "sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    # Only records of another width are counted again, without their quoted parts.
    bare = F.regexp_replace("text", f"{QUOTE}[^{QUOTE}]*{QUOTE}", "")
    many = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    shown = F.concat(F.lit(f"record with more than {len(names)} fields: "), F.substring("text", 1, 200))
    checked = F.when(F.col("p.bad").isNotNull() & (many > len(names)), F.raise_error(shown).cast("string"))
    cells = [F.coalesce(checked, F.col("p.c0")), *[F.col(f"p.{f}") for f in fields[1:]]]
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    out = [F.when(~F.array_contains(tokens, x), x).alias(n) for x, n in zip(cells, names)]
    ids = [] if row_id is None else [F.col("id").alias(row_id)]
    return records.select("id", "text", parsed.alias("p")).select(*ids, *out)


def _read_files(spark: SparkSession, path: str, row_id: str | None, sep: str, encoding: str) -> DataFrame:
    df = (spark.read.option("header", True).option("multiLine", True)
          .option("escape", QUOTE).option("quote", QUOTE).option("sep", sep)
          .option("encoding", encoding).option("inferSchema", False)
          .option("mode", "FAILFAST").csv(path))
    df = null_na_tokens(df, df.columns)
    if row_id is None:
        # Such a file is read by one task; spread it for the work downstream
        # (no-op when there are more files than task slots).
        return spread(df)
    return file_order_ids(df, row_id)


def file_order_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Dense ids in file order (files by path, rows by position) without
    sorting the data, for files that are never split, so that each file sits
    in one partition in file order. One aggregate gives, per (partition,
    file), the row count and the first in-partition index; ordering that
    small table by path gives every file's offset. A file scan produces the
    same partitions when re-run, so the tags are stable."""
    spark = df.sparkSession
    tagged = (df.withColumn("_file", F.input_file_name())
              .withColumn("_seq", F.monotonically_increasing_id()))
    chunks = (tagged.groupBy("_file").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
              .collect())  # one row per file: bounded by the file listing
    rows, offset = [], 0
    for r in sorted(chunks, key=lambda r: r["_file"]):
        rows.append((r["_file"], offset, r["_first"]))
        offset += r["_n"]
    offsets = spark.createDataFrame(rows, "_file string, _offset long, _first long")
    return (tagged.join(F.broadcast(offsets), "_file")
            .withColumn(out, F.col("_offset") + F.col("_seq") - F.col("_first"))
            .drop("_file", "_seq", "_offset", "_first"))


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV with quoting that :func:`read_raw_csv` reads back."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quote", '"').option("quoteAll", True).csv(path))
