import pytest

from tablewright.operators.lists import (cooccurrence_matrix, explode_list, item_counts, list_summary,
                                         pair_counts, row_item_sets, row_item_sets_from_side, top_items)


def explode(spark, values, hint):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    rows = explode_list(df, "v", hint, "id").collect()
    out = {}
    for r in rows:
        out.setdefault(r["row_id"], []).append(r["value"])
    return [out.get(i, []) for i in range(len(values))]


def test_json_hint_forms(spark):
    got = explode(spark, [
        '["a", "b", "a"]',       # duplicates kept
        "['x', 'y']",            # python quotes
        "[1, 2.5]",              # numbers as text
        "[]",                    # empty list -> nothing
        "[None, 'k']",           # null elements dropped
        "[[1, 2], 3]",           # one level only
        "[a, 'b",                # not bracketed at both ends -> comma split
        "[a, 'b]",               # bracketed but broken -> brackets removed, comma split
        "plain",                 # one element
        "   ",                   # blank -> nothing
        None,
        "{'k': 1}",              # a dict literal -> one item, its text
    ], "json")
    assert got[0] == ["a", "b", "a"]
    assert got[1] == ["x", "y"]
    assert got[2] == ["1", "2.5"]
    assert got[3] == []
    assert got[4] == ["k"]
    assert got[5] == ["[1,2]", "3"]
    assert got[6] == ["[a", "'b"]
    assert got[7] == ["a", "'b"]
    assert got[8] == ["plain"]
    assert got[9] == [] and got[10] == []
    assert got[11] == ["{'k': 1}"]


def test_python_literals(spark):
    got = explode(spark, [
        "[{'a': 1, 'b': None}]",           # one dict, one item
        "['say None, ok', None]",          # quoted text is left alone
        "['x', ('y','z')]",                # a tuple is a nested list
        "[True, 'x', 'true', False]",      # booleans keep their Python text
        "['it\\'s', \"say 'hi'\",]",       # escapes, other quotes, trailing comma
        "['caf\\xe9', 'a\\\\x41']",        # two-digit escapes, not after a backslash
        "{'a': True, 'b': (1, None)}",     # a dict keeps its text
        "['" + "long " * 20_000 + "']",
    ], "json")
    assert got[0] == ['{"a":1,"b":null}']
    assert got[1] == ["say None, ok"]
    assert got[2] == ["x", '["y","z"]']
    assert got[3] == ["True", "x", "true", "False"]
    assert got[4] == ["it's", "say 'hi'"]
    assert got[5] == ["café", "a\\x41"]
    assert got[6] == ["{'a': True, 'b': (1, None)}"]
    assert got[7] == ["long " * 20_000]


def test_dict_hint_keeps_object_text(spark):
    got = explode(spark, ['{"k": 69}', ' {"a": 1, "b": [1,2]} ', "{broken, x}"], "dict")
    assert got[0] == ['{"k": 69}']
    assert got[1] == ['{"a": 1, "b": [1,2]}']
    assert got[2] == ["{broken", "x}"]


def test_csv_hint(spark):
    got = explode(spark, ["a, b,,c ", "single", " , "], "csv")
    assert got == [["a", "b", "c"], ["single"], []]


def test_no_hint_splits_only_on_comma(spark):
    got = explode(spark, ["a,b", "ab"], None)
    assert got == [["a", "b"], ["ab"]]


def test_array_column(spark):
    df = spark.createDataFrame([(0, [1.5, None, 2.0]), (1, [])], "id long, v array<double>")
    rows = explode_list(df, "v", "json", "id").collect()
    assert sorted((r.row_id, r.value) for r in rows) == [(0, "1.5"), (0, "2.0")]


@pytest.fixture()
def baskets(spark):
    data = ['["a","b","c"]', '["a","b"]', '["a","a"]', '["c"]', '[]', '["b","d"]']
    return spark.createDataFrame(list(enumerate(data)), "id long, v string")


def brute_counts(data):
    import json
    from collections import Counter
    from itertools import combinations
    single, pairs = Counter(), Counter()
    for s in data:
        items = sorted(set(json.loads(s)))
        single.update(items)
        pairs.update(combinations(items, 2))
    return single, pairs


def test_item_and_pair_counts_match_brute_force(spark, baskets):
    data = [r.v for r in baskets.orderBy("id").collect()]
    single, pairs = brute_counts(data)
    sets = row_item_sets(baskets, "v", "json")
    counts = item_counts(sets)
    assert {r.value: r["count"] for r in counts.collect()} == dict(single)
    top = top_items(counts, 15)
    assert top == ["a", "b", "c", "d"]  # count desc, item asc
    got = {(r.item_a, r.item_b): r["count"] for r in pair_counts(sets, top).collect()}
    assert got == dict(pairs)
    # From the exploded side table the same numbers come out.
    side = explode_list(baskets, "v", "json", "id")
    sets2 = row_item_sets_from_side(side)
    assert {r.value: r["count"] for r in item_counts(sets2).collect()} == dict(single)
    assert {(r.item_a, r.item_b): r["count"] for r in pair_counts(sets2, top).collect()} == dict(pairs)


def test_pairs_restricted_to_top(spark, baskets):
    sets = row_item_sets(baskets, "v", "json")
    got = {(r.item_a, r.item_b) for r in pair_counts(sets, ["a", "b"]).collect()}
    assert got == {("a", "b")}


def test_matrix_and_summary(spark, baskets):
    sets = row_item_sets(baskets, "v", "json")
    counts = item_counts(sets)
    top = top_items(counts, 3)
    m = {(r.i, r.j): r["count"] for r in cooccurrence_matrix(counts, pair_counts(sets, top), top).collect()}
    # top = a(3), b(3), c(2); lower triangle including the diagonal
    assert m == {(0, 0): 3, (1, 0): 2, (1, 1): 3, (2, 0): 1, (2, 1): 1, (2, 2): 2}
    s = list_summary("v", counts).first()
    assert s.total_items_parsed == 3 + 3 + 2 + 1 and s.num_unique_elements == 4
