from pyspark.sql import functions as F

from tablewright.operators.profile import detect_types, drop_sparse, null_profile, type_histogram


def types_of(df, **kw):
    return {r["column"]: (r["type"], r["hint"]) for r in detect_types(df, sample_rows=None, **kw).collect()}


def test_null_threshold_is_strict(spark):
    # 10 rows: a has 7 nulls (0.70, kept), b has 8 (0.80, dropped), c 6 (0.60).
    rows = [(None if i < 7 else "x", None if i < 8 else 1.0, None if i < 6 else i) for i in range(10)]
    df = spark.createDataFrame(rows, "a string, b double, c int")
    prof = {r["column"]: r for r in null_profile(df, 0.70).collect()}
    assert prof["a"]["null_ratio"] == 0.7 and not prof["a"]["dropped"]
    assert prof["b"]["dropped"] and prof["b"]["null_count"] == 8
    assert not prof["c"]["dropped"]
    assert drop_sparse(df, 0.70).columns == ["a", "c"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert null_profile(df).first()["null_count"] == 2


def test_numeric_categorical_threshold(spark):
    df = spark.createDataFrame([(i % 20, i % 21, str(i % 20) + ".0") for i in range(100)],
                               "a int, b int, c string")
    t = types_of(df)
    assert t["a"][0] == "numeric_categorical"      # 20 distinct
    assert t["b"][0] == "numeric"                  # 21 distinct
    assert t["c"][0] == "numeric_categorical"      # number text


def test_text_rules_and_shares(spark):
    n = 10
    rows = []
    for i in range(n):
        rows.append((
            " Y " if i % 2 else "N",                        # boolean after strip
            "{" if i < 6 else "x",                          # 0.6 > 0.5 -> dict
            "{" if i < 5 else "x",                          # 0.5 not > 0.5
            "[1]" if i < 6 else "x",                        # list json
            "a,b" if i < 4 else "x",                        # 0.4 > 0.3 -> csv
            "a,b" if i < 3 else "x",                        # 0.3 not > 0.3
            "True" if i % 2 else "False",                   # not Y/N, not a number
            "1d" if i % 2 else "2",                         # 1d is not a number
            None,                                           # all null
        ))
    df = spark.createDataFrame(rows, "yn string, d6 string, d5 string, l6 string, c4 string, "
                                     "c3 string, tf string, dd string, empty string")
    t = types_of(df)
    assert t["yn"] == ("boolean", None)
    assert t["d6"] == ("dict_json", "dict")
    assert t["d5"] == ("categorical", None)
    assert t["l6"] == ("list_json", "json")
    assert t["c4"] == ("list_json", "csv")
    assert t["c3"] == ("categorical", None)
    assert t["tf"] == ("numeric_categorical", None)
    assert t["dd"] == ("categorical", None)
    assert t["empty"] == ("numeric_categorical", None)


def test_no_list_columns_skip_list_rules(spark):
    df = spark.createDataFrame([("a, b",)] * 5, "address string")
    assert types_of(df)["address"] == ("list_json", "csv")
    assert types_of(df, no_list=["address"])["address"] == ("categorical", None)


def test_boolean_type_is_numeric_categorical(spark):
    df = spark.createDataFrame([(True,), (False,)], "b boolean")
    assert types_of(df)["b"][0] == "numeric_categorical"


def test_sample_uses_first_rows_in_order(spark):
    # The first 10 rows (by id) are numbers; later rows are text.
    rows = [(i, str(i) if i < 10 else "text") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v string")
    first = {r["column"]: r["type"] for r in detect_types(df, ["v"], ["id"], sample_rows=10).collect()}
    whole = {r["column"]: r["type"] for r in detect_types(df, ["v"], ["id"], sample_rows=None).collect()}
    assert first["v"] == "numeric_categorical" and whole["v"] == "categorical"


def test_type_histogram(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    h = {r["type"]: r["n_columns"] for r in type_histogram(detect_types(df, sample_rows=None)).collect()}
    assert h == {"numeric_categorical": 1, "categorical": 1}


def test_number_text_coercion(spark):
    from pyspark.sql import types as T

    from tablewright.functions.text import try_number
    vals = [" 3 ", "\t-2.5e1\n", " 7 ", "1d", "1f", "nan", "inf", ".5", "5.", "x1", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r["x"] for r in df.select(try_number(F.col("s"), T.StringType()).alias("x")).collect()]
    assert got == [3.0, -25.0, 7.0, None, None, None, float("inf"), 0.5, 5.0, None, None]


def test_types_on_empty_and_all_null_input(spark):
    # No values at all: every rule sees zero non-null cells (numbers by
    # default, no distinct values -> numeric_categorical), with or without rows.
    empty = spark.createDataFrame([], "a string, b int")
    assert types_of(empty) == {"a": ("numeric_categorical", None), "b": ("numeric_categorical", None)}
    nulls = spark.createDataFrame([(None, None)] * 5, "a string, b double")
    assert types_of(nulls) == {"a": ("numeric_categorical", None), "b": ("numeric_categorical", None)}


def test_many_columns_and_wide_distinct_counts(spark):
    # 40 columns in one typing pass; the bucket bound settles the wide ones
    # (100 distinct numbers) and the exact pass the narrow ones (5 values).
    cols = [f"c{i}" for i in range(40)]
    rows = [tuple((r % 5) if i % 2 else r for i in range(40)) for r in range(100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    t = types_of(df)
    assert all(t[c][0] == ("numeric_categorical" if i % 2 else "numeric") for i, c in enumerate(cols))


def test_null_profile_wide_and_narrow_forms_agree(spark):
    # 120 columns take the grouped form; the same columns 30 at a time the
    # single-row form.
    cols = [f"c{i}" for i in range(120)]
    rows = [tuple(None if (r + i) % (i % 7 + 2) == 0 else float(r) for i in range(120)) for r in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    wide = {r["column"]: tuple(r) for r in null_profile(df).collect()}
    narrow = {}
    for k in range(0, 120, 30):
        part = null_profile(df, columns=cols[k:k + 30]).collect()
        narrow.update({r["column"]: (r["column"], r["position"] + k, *tuple(r)[2:]) for r in part})
    assert wide == narrow
    expected = {c: sum(1 for row in rows if row[i] is None) for i, c in enumerate(cols)}
    assert {c: v[2] for c, v in wide.items()} == expected
    empty = spark.createDataFrame([], ", ".join(f"{c} double" for c in cols))
    assert {tuple(r)[2:] for r in null_profile(empty).collect()} == {(0, 0, 0.0, False)}
