"""The split CSV scan against Python's csv module: any split size gives the same
records and ids."""

import csv
import io
import os
import random

import pytest

from tablewright.config import NA_TOKENS
from tablewright.sources.csv import _lines, read_raw_csv


def expected(texts):
    rows = []
    for text in texts:
        body = list(csv.reader(io.StringIO(text, newline="")))
        body = [r for r in body if r]
        width = len(body[0])
        rows += [[None if v in NA_TOKENS else v for v in r] + [None] * (width - len(r)) for r in body[1:]]
    return [(k, *r) for k, r in enumerate(rows)]


def made(rng, n, end):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "text", "other, quoted"])
    cells = ["plain", "", "NA", 'say "x"', "two\nlines", "a,b", "\n", '"', "\r\nx", "é漢😀", "null", " sp ", "x" * 50, "many\n" * 5]
    for k in range(n):
        w.writerow([k, rng.choice(cells), rng.choice(cells)])
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("size", ["37b", "300b", "1m"])
def test_any_split_gives_the_same_records(spark, tmp_dir, size):
    rng = random.Random(size)
    texts = [made(rng, 60, "\n"), made(rng, 1, "\n"), made(rng, 40, "\r\n"), made(rng, 0, "\n"), made(rng, 25, "\n").rstrip("\n")]
    for k, t in enumerate(texts):
        open(os.path.join(tmp_dir, f"f{k}.csv"), "w", newline="").write(t)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        if size != "1m":
            one = os.path.join(tmp_dir, "f0.csv")
            assert _lines(spark, one).rdd.getNumPartitions() > 4          # one file, many tasks
        got = [tuple(r) for r in read_raw_csv(spark, tmp_dir).orderBy("row_id").collect()]
        assert read_raw_csv(spark, tmp_dir, row_id=None).columns == ["id", "text", "other, quoted"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == expected(texts)


def written(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    open(path, "w", newline="", encoding="utf-8").write(text)
    return path


def test_surplus_fields_raise_and_missing_ones_are_null(spark, tmp_dir):
    path = written(tmp_dir, "a.csv", 'a,b,c\n1,2\n3,"x,y",z\n4\n')
    assert [tuple(r) for r in read_raw_csv(spark, path).orderBy("row_id").collect()] == [
        (0, "1", "2", None), (1, "3", "x,y", "z"), (2, "4", None, None)]
    for bad in ("1,2,3,4", '1,2,"3",', "1,2,3,"):
        path = written(tmp_dir, "b.csv", f"a,b,c\n1,2,3\n{bad}\n")
        with pytest.raises(Exception, match="more than 3 fields"):
            read_raw_csv(spark, path).select("row_id", "a").collect()


def test_headers(spark, tmp_dir):
    path = written(tmp_dir, "h.csv", '﻿x,X,,"two\nlines"\n1,2,3,4\n')
    df = read_raw_csv(spark, path)
    assert df.columns == ["row_id", "x0", "X1", "_c2", "two\nlines"] and tuple(df.first()) == (0, "1", "2", "3", "4")
    os.makedirs(os.path.join(tmp_dir, "mixed"))
    written(tmp_dir, "mixed/a.csv", "a,b\n1,2\n")
    written(tmp_dir, "mixed/b.csv", "a,c\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_raw_csv(spark, os.path.join(tmp_dir, "mixed"))
    assert read_raw_csv(spark, written(tmp_dir, "only.csv", "a,b\n")).count() == 0
    with pytest.raises(ValueError, match="no header"):
        read_raw_csv(spark, written(tmp_dir, "none.csv", ""))


def test_other_separators_encodings_and_an_open_quote(spark, tmp_dir):
    path = written(tmp_dir, "s.csv", 'a;b\n"1;2";x\n3;y\n')
    assert [tuple(r) for r in read_raw_csv(spark, path, sep=";").orderBy("row_id").collect()] == [(0, "1;2", "x"), (1, "3", "y")]
    path = os.path.join(tmp_dir, "latin.csv")
    open(path, "wb").write('a,b\né,"x\ny"\n'.encode("latin-1"))
    assert [tuple(r)[:2] for r in read_raw_csv(spark, path, None, encoding="ISO-8859-1").collect()] == [("é", "x\ny")]
    os.makedirs(os.path.join(tmp_dir, "open"))
    written(tmp_dir, "open/a.csv", 'a,b\n1,2\n3,"never\nclosed\n')
    written(tmp_dir, "open/b.csv", "a,b\n5,6\n")
    got = [tuple(r) for r in read_raw_csv(spark, os.path.join(tmp_dir, "open")).orderBy("row_id").collect()]
    assert [r[:2] for r in got] == [(0, "1"), (1, "3"), (2, "5")]
