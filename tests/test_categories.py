from collections import Counter

from pyspark.sql import functions as F

from tablewright.operators import categories as cat


def test_modes_tie_to_smallest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "x string")
    m = cat.modes(cat.value_counts(df, ["x"])).first()
    assert (m["mode"], m["count"]) == ("a", 2)


def test_dictionary_is_text_ordered(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 2, 1, 10, 3.5]], "x double")
    d = {r.value: r.code for r in cat.label_dictionary(cat.value_counts(df, ["x"])).collect()}
    assert d == {"1": 0, "10": 1, "2": 2, "3.5": 3}   # "10" < "2"
    d2 = {r.value: r.code for r in cat.label_dictionary(cat.value_counts(df, ["x"]), distinct_limit=0).collect()}
    assert d2 == d


def test_encode_decode_roundtrip_inline_and_join(spark):
    rows = [(i, f"name{i % 37}", None if i % 11 == 0 else f"t{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, n string, t string")
    d = cat.label_dictionary(cat.value_counts(df, ["n", "t"]))
    for inline_limit in (10_000, 0):
        enc = cat.label_encode(df, ["n", "t"], d, inline_limit=inline_limit)
        assert dict(enc.dtypes)["n"] == "bigint"
        dec = cat.label_decode(enc, ["n", "t"], d, inline_limit=inline_limit)
        assert sorted(map(tuple, dec.collect())) == sorted(map(tuple, df.collect()))


def test_unknown_value_encodes_to_null(spark):
    df = spark.createDataFrame([("a",)], "x string")
    d = cat.label_dictionary(cat.value_counts(spark.createDataFrame([("b",)], "x string"), ["x"]))
    assert cat.label_encode(df, ["x"], d).first()["x"] is None


def test_top_categories_match_brute_force(spark):
    vals = [f"v{(i * i) % 53}" for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = cat.top_categories(cat.value_counts(df, ["x"]), 20, salts=7).orderBy("rank").collect()
    cnt = Counter(vals)
    expect = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:20]
    assert [(r.value, r["count"]) for r in got] == expect
    assert all(r.more_exist for r in got) and [r.rank for r in got] == list(range(1, 21))


def test_category_summary(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    s = cat.category_summary(cat.value_counts(df, ["x"])).first()
    assert (s["count"], s["num_unique_values"]) == (3, 2)


def test_keys_of_long_ids_and_decimals(spark):
    df = spark.sql("""SELECT * FROM VALUES (9007199254740992L, 1.50BD), (9007199254740993L, 1.00BD),
                      (3000000000000000L, 0.00BD), (-7L, 20.00BD) AS t(id, d)""")
    got = {(r.column, r.value): r["count"] for r in cat.value_counts(df, ["id", "d"]).collect()}
    assert got == {(c, v): 1 for c, v in [
        ("id", "9007199254740992"), ("id", "9007199254740993"), ("id", "3000000000000000"), ("id", "-7"),
        ("d", "1.5"), ("d", "1"), ("d", "0"), ("d", "20")]}


def test_long_texts_and_a_value_in_most_rows_take_the_shuffle(spark):
    """One value in 90 % of the rows, nulls, and a dictionary of long texts: the
    hot value and the nulls need no match, and no task gets them all."""
    long = ["x" * 3000 + str(k) for k in range(300)]
    rows = [(i, long[0] if i % 10 else (None if i % 20 else long[i // 20 % 300])) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(4)
    counts = cat.value_counts(df, ["v"])
    d = cat.label_dictionary(counts)
    code = {r["value"]: r["code"] for r in d.collect()}
    want = sorted((i, code[v] if v else code[long[0]]) for i, v in rows)
    for limit in (0, 10**9):
        got = cat.label_encode(df, ["v"], d, broadcast_bytes=limit, counts=counts, fill={"v": long[0]})
        assert sorted(map(tuple, got.collect())) == want
    plain = cat.label_encode(df, ["v"], d, broadcast_bytes=0, counts=counts)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(((i, code.get(v)) for i, v in rows), key=repr)
    back = cat.label_decode(plain, ["v"], d, broadcast_bytes=0, counts=counts)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    # Broadcast follows counted bytes, not entries.
    plan = lambda limit: cat.label_encode(df, ["v"], d, broadcast_bytes=limit, counts=counts)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(2_000_000) and "strategy=broadcast" not in plan(100_000)
    assert [tuple(r) for r in cat.frequent_values(counts).collect()] == [("v", long[0])]


def test_rows_without_a_match_are_spread(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 50 == 0, F.concat(F.lit("rare"), F.col("id"))).otherwise("hot").alias("v"))
    counts = cat.value_counts(df, ["v"])
    d = cat.label_dictionary(counts)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = cat.label_encode(df, ["v"], d, inline_limit=0, broadcast_bytes=0, counts=counts)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(sizes) < 1500 and out.where("v is null").count() == 0
