"""DuckDB SQL for each registered query, written independently of the Spark
code from the operator definitions (tables are pre-registered as views).
Numbers are rounded exactly like the Spark side.
"""

from __future__ import annotations

import re

# What Python's str.strip() takes off, by Python's own word.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WS = f"'{BLANKS}'"
# A number is digits with at most one point among or around them, and a power of ten.
NUM_RE = "'[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|(i|I)(n|N)(f|F)((i|I)(n|N)(i|I)(t|T)(y|Y))?)'"
BOOL_RE = "'[YN]'"


def num_text(x: str) -> str:
    return (f"(CASE WHEN {x} = floor({x}) AND abs({x}) < 1e15 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END)")


def is_number(s: str) -> str:
    return f"regexp_full_match(trim({s}, {WS}), {NUM_RE})"


LINEITEM_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

GAPS = """
SELECT row_number() OVER (ORDER BY {order}) - 1 AS row_id,
  l_orderkey, l_linenumber,
  CASE WHEN l_discount <> 0.0 THEN l_quantity END AS l_quantity,
  l_extendedprice, l_discount,
  CASE WHEN l_linenumber <> 7 THEN l_tax END AS l_tax,
  CASE WHEN l_tax <> CAST(0.08 AS DOUBLE) THEN l_returnflag END AS l_returnflag,
  CASE WHEN l_linenumber <> 1 THEN (CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END) END AS l_open,
  CAST(year(l_shipdate) AS VARCHAR) AS l_shipyear,
  CASE WHEN l_linenumber >= 6 THEN 'note-' || l_returnflag END AS l_note
FROM lineitem
""".replace("{order}", LINEITEM_ORDER)
GAPS_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_open", "l_shipyear", "l_note"]
GAPS_NUMERIC_TYPED = {"l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"}

TAGS = """
SELECT *, '["' || p_type || '", "' || p_brand || '", "' || split_part(p_name, ' ', 1) || '"]' AS p_tags
FROM part
"""

EVSQ = "SELECT *, value * value AS value_sq FROM events"

SQL: dict[str, str] = {}


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- profile ---------------------------------------------------------------

def _null_profile() -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax') else ''}) AS n{i}"
        for i, c in enumerate(GAPS_COLS))
    rows = union([f"SELECT '{c}' AS column, {i} AS position, n{i} AS null_count, row_count FROM c"
                  for i, c in enumerate(GAPS_COLS)])
    return f"""
WITH g AS ({GAPS}), c AS (SELECT count(*) AS row_count, {counts} FROM g)
SELECT column, position, null_count, row_count,
  round(null_count / row_count, 6) AS null_ratio, null_count / row_count > 0.7 AS dropped
FROM ({rows})
"""


SQL["null_profile"] = _null_profile()

TYPE_COLUMNS = {
    "events": [("event_id", "num"), ("ts", "text"), ("user_id", "num"), ("event_type", "text"),
               ("value", "num"), ("props", "text")],
    "orders": [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "text"),
               ("o_totalprice", "num"), ("o_orderdate", "text"), ("o_orderpriority", "text")],
    "customer": [("c_custkey", "num"), ("c_name", "text"), ("c_nationkey", "num"),
                 ("c_acctbal", "num"), ("c_mktsegment", "text")],
    "part": [("p_partkey", "num"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"),
             ("p_size", "num"), ("p_retailprice", "num")],
    "lineitem_gaps": [(c, "num" if c in GAPS_NUMERIC_TYPED else "text") for c in GAPS_COLS],
}


def _share(cond: str) -> str:
    return f"avg(CASE WHEN s IS NULL THEN NULL WHEN {cond} THEN 1.0 ELSE 0.0 END)"


def _type_select(table_name: str, source: str, column: str, pos: int, kind: str) -> str:
    if kind == "num":
        return (f"SELECT '{table_name}' AS table_name, '{column}' AS column, {pos} AS position, "
                f"CASE WHEN count(DISTINCT CAST({column} AS DOUBLE)) <= 20 THEN 'numeric_categorical' "
                f"ELSE 'numeric' END AS type, CAST(NULL AS VARCHAR) AS hint FROM {source}")
    t = f"trim(s, {WS})"
    numeric = f"count(s) = count(*) FILTER (WHERE {is_number('s')})"
    boolean = f"count(s) = count(*) FILTER (WHERE regexp_full_match({t}, {BOOL_RE}))"
    truth = "count(s) = count(*) FILTER (WHERE s IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false'))"
    brace = f"{_share(f'starts_with({t}, ' + chr(39) + '{' + chr(39) + ')')} > 0.5"
    bracket = f"{_share(f'starts_with({t}, ' + chr(39) + '[' + chr(39) + ')')} > 0.5"
    comma = f"{_share('contains(s, ' + chr(39) + ',' + chr(39) + ')')} > 0.3"
    kind_sql = (f"CASE WHEN {numeric} THEN (CASE WHEN count(DISTINCT TRY_CAST({t} AS DOUBLE)) <= 20 "
                f"THEN 'numeric_categorical' ELSE 'numeric' END) "
                f"WHEN {truth} THEN 'numeric_categorical' WHEN {boolean} THEN 'boolean' WHEN {brace} THEN 'dict_json' "
                f"WHEN {bracket} THEN 'list_json' WHEN {comma} THEN 'list_json' ELSE 'categorical' END")
    hint_sql = (f"CASE WHEN {numeric} OR {truth} OR {boolean} THEN NULL WHEN {brace} THEN 'dict' "
                f"WHEN {bracket} THEN 'json' WHEN {comma} THEN 'csv' ELSE NULL END")
    return (f"SELECT '{table_name}' AS table_name, '{column}' AS column, {pos} AS position, "
            f"{kind_sql} AS type, {hint_sql} AS hint "
            f"FROM (SELECT CAST({column} AS VARCHAR) AS s FROM {source})")


def _types(tables: list[str]) -> str:
    parts = []
    for name in tables:
        source = "g" if name == "lineitem_gaps" else name
        for pos, (c, kind) in enumerate(TYPE_COLUMNS[name]):
            parts.append(_type_select(name, source, c, pos, kind))
    return f"WITH g AS ({GAPS})\n" + union(parts)


SQL["column_types"] = _types(["events", "orders", "customer", "part", "lineitem_gaps"])
SQL["type_histogram"] = (f"SELECT type, count(*) AS n_columns FROM ({_types(['lineitem_gaps'])}) "
                         f"GROUP BY type")

SQL["incremental_profile"] = (f"SELECT p.column, p.position, p.null_count, p.row_count, t.type, t.hint FROM ({SQL['null_profile']}) p "
                              f"JOIN ({_types(['lineitem_gaps'])}) t ON p.column = t.column")

SQL["coerce_numeric"] = f"""
SELECT event_id, raw,
  CASE WHEN {is_number('raw')} THEN TRY_CAST(trim(raw, {WS}) AS DOUBLE) END AS number
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END AS raw
      FROM events)
"""

# --- clean statistics ------------------------------------------------------

SQL["medians"] = f"WITH g AS ({GAPS})\n" + union([
    f"SELECT '{c}' AS column, round(coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0), 6) AS median FROM g"
    for c in ["l_orderkey", "l_quantity", "l_extendedprice", "l_tax"]])


def _vc(source: str, cols: list[tuple[str, str]]) -> str:
    """(column, value, count) where each column is given as (name, value-sql)."""
    return union([f"SELECT '{c}' AS column, {v} AS value, count(*) AS count FROM {source} "
                  f"WHERE {c} IS NOT NULL GROUP BY {v}" for c, v in cols])


LI_VC = [("l_returnflag", "l_returnflag"), ("l_linestatus", "l_linestatus"),
         ("l_linenumber", "CAST(l_linenumber AS VARCHAR)"), ("l_discount", num_text("l_discount")),
         ("l_tax", num_text("l_tax"))]
SQL["value_counts"] = _vc("lineitem", LI_VC)
SQL["value_counts_big_ids"] = """
SELECT 'big_id' AS column, CAST(user_id + 9007199254740992 AS VARCHAR) AS value, count(*) AS count
FROM events GROUP BY user_id
"""

ORDERS_VC = [("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "o_orderpriority"),
             ("o_custkey", "CAST(o_custkey AS VARCHAR)")]


def _modes(vc: str) -> str:
    return f"""
SELECT column, value AS mode, count FROM (
  SELECT column, value, count,
         row_number() OVER (PARTITION BY column ORDER BY count DESC, value ASC) AS rn
  FROM ({vc})) WHERE rn = 1
"""


SQL["modes"] = _modes(_vc("orders", ORDERS_VC))

SQL["categorical_summary"] = f"""
SELECT column, CAST(sum(count) AS BIGINT) AS count, count(*) AS num_unique_values
FROM ({_vc('orders', ORDERS_VC)}) GROUP BY column
"""

SQL["impute"] = f"""
WITH g AS ({GAPS}),
med AS (SELECT coalesce(quantile_cont(l_quantity, 0.5), 0.0) AS m FROM g),
mo AS ({_modes(_vc('g', [('l_tax', num_text('l_tax')), ('l_returnflag', 'l_returnflag'), ('l_open', 'l_open')]))})
SELECT row_id,
  round(coalesce(l_quantity, (SELECT m FROM med)), 6) AS l_quantity,
  coalesce({num_text('l_tax')}, (SELECT mode FROM mo WHERE column = 'l_tax')) AS l_tax,
  coalesce(l_returnflag, (SELECT mode FROM mo WHERE column = 'l_returnflag')) AS l_returnflag,
  coalesce(l_open, (SELECT mode FROM mo WHERE column = 'l_open')) AS l_open
FROM g
"""

PART_VC = [("p_brand", "p_brand"), ("p_type", "p_type"), ("p_name", "p_name"),
           ("p_size", "CAST(p_size AS VARCHAR)")]


def _dictionary(vc: str) -> str:
    return (f"SELECT column, value, CAST(row_number() OVER (PARTITION BY column ORDER BY value) - 1 AS BIGINT) "
            f"AS code FROM ({vc})")


SQL["label_dictionary"] = _dictionary(_vc("part", PART_VC))


def _encoded_part() -> str:
    joins = "\n".join(
        f"LEFT JOIN d AS d{i} ON d{i}.column = '{c}' AND d{i}.value = {v.replace(c, 'p.' + c)}"
        for i, (c, v) in enumerate(PART_VC))
    sel = ", ".join(f"CAST(d{i}.code AS BIGINT) AS {c}" for i, (c, _) in enumerate(PART_VC))
    return f"""
WITH d AS ({_dictionary(_vc('part', PART_VC))})
SELECT p.p_partkey, {sel}
FROM part AS p
{joins}
"""


SQL["label_encode"] = _encoded_part()
SQL["label_encode_tail"] = SQL["label_encode"]
SQL["label_decode"] = ("SELECT p_partkey, p_brand, p_type, p_name, CAST(p_size AS VARCHAR) AS p_size "
                       "FROM part")

SQL["top_categories"] = f"""
WITH vc AS ({_vc('part', PART_VC)}),
r AS (SELECT column, value, count,
             row_number() OVER (PARTITION BY column ORDER BY count DESC, value ASC) AS rank,
             count(*) OVER (PARTITION BY column) AS n
      FROM vc)
SELECT column, CAST(rank AS INTEGER) AS rank, value, count, n > 20 AS more_exist FROM r WHERE rank <= 20
"""

# clean of the gapped lineitem (types on the whole table; see column_types)
CLEAN_NUMERIC = ["l_orderkey", "l_quantity", "l_extendedprice"]
CLEAN_CATEGORY = [("l_linenumber", "CAST(l_linenumber AS VARCHAR)"), ("l_discount", num_text("l_discount")),
                  ("l_tax", num_text("l_tax")), ("l_returnflag", "l_returnflag"), ("l_open", "l_open"),
                  ("l_shipyear", num_text("TRY_CAST(l_shipyear AS DOUBLE)"))]
CLEAN_ORDER = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_open", "l_shipyear"]


def _clean() -> str:
    meds = ", ".join(f"coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0) AS m_{c}" for c in CLEAN_NUMERIC)
    filled = []
    for c in CLEAN_ORDER:
        if c in CLEAN_NUMERIC:
            filled.append(f"coalesce(CAST({c} AS DOUBLE), (SELECT m_{c} FROM med)) AS {c}")
        else:
            v = dict(CLEAN_CATEGORY)[c]
            filled.append(f"coalesce({v}, (SELECT mode FROM mo WHERE column = '{c}')) AS {c}")
    joins = "\n".join(f"LEFT JOIN d AS d_{c} ON d_{c}.column = '{c}' AND d_{c}.value = f.{c}"
                      for c, _ in CLEAN_CATEGORY)
    sel = ", ".join(f"round(f.{c}, 6) AS {c}" if c in CLEAN_NUMERIC else f"CAST(d_{c}.code AS BIGINT) AS {c}"
                    for c in CLEAN_ORDER)
    return f"""
WITH g AS ({GAPS}),
med AS (SELECT {meds} FROM g),
vc AS ({_vc('g', CLEAN_CATEGORY)}),
mo AS ({_modes('SELECT * FROM vc')}),
d AS ({_dictionary('SELECT * FROM vc')}),
f AS (SELECT row_id, {', '.join(filled)} FROM g)
SELECT f.row_id, {sel}
FROM f
{joins}
"""


SQL["clean_table"] = _clean()
SQL["clean_dictionary"] = f"WITH g AS ({GAPS}), vc AS ({_vc('g', CLEAN_CATEGORY)})\n" + _dictionary("SELECT * FROM vc")

# --- lists -----------------------------------------------------------------

DOC_ITEMS = f"""
SELECT doc_id AS row_id, trim(v, {WS}) AS value
FROM (SELECT doc_id, unnest(string_split(trim(text, {WS}), ',')) AS v
      FROM documents WHERE text IS NOT NULL AND trim(text, {WS}) <> '')
WHERE trim(v, {WS}) <> ''
"""
SQL["explode_csv_list"] = DOC_ITEMS

TAG_ITEMS = f"""
SELECT p_partkey AS row_id, unnest(json_extract_string(p_tags, '$[*]')) AS value FROM ({TAGS})
"""
SQL["explode_json_list"] = TAG_ITEMS

SQL["explode_dict"] = f"""
SELECT event_id AS row_id, trim(props, {WS}) AS value FROM events
WHERE props IS NOT NULL AND trim(props, {WS}) <> ''
"""


def _item_counts(items: str) -> str:
    return f"SELECT value, count(*) AS count FROM (SELECT DISTINCT row_id, value FROM ({items})) GROUP BY value"


SQL["item_counts"] = _item_counts(TAG_ITEMS)

_TOP = f"""
items AS (SELECT DISTINCT row_id, value FROM ({TAG_ITEMS})),
ic AS (SELECT value, count(*) AS n FROM items GROUP BY value),
topi AS (SELECT * FROM (SELECT value, n, CAST(row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS INTEGER) AS i
                        FROM ic) WHERE i < 15),
ti AS (SELECT row_id, value FROM items WHERE value IN (SELECT value FROM topi)),
pc AS (SELECT a.value AS item_a, b.value AS item_b, count(*) AS count
       FROM ti AS a JOIN ti AS b ON a.row_id = b.row_id AND a.value < b.value GROUP BY 1, 2)
"""
SQL["top_pair_counts"] = f"WITH {_TOP} SELECT item_a, item_b, count FROM pc"
SQL["cooccurrence_matrix"] = f"""
WITH {_TOP}
SELECT r.i AS i, c.i AS j, r.value AS row_item, c.value AS col_item,
  CAST(CASE WHEN r.i = c.i THEN r.n ELSE coalesce(pc.count, 0) END AS BIGINT) AS count
FROM topi AS r JOIN topi AS c ON c.i <= r.i
LEFT JOIN pc ON pc.item_a = least(r.value, c.value) AND pc.item_b = greatest(r.value, c.value)
"""
SQL["list_summary"] = f"""
SELECT 'p_tags' AS column, CAST(coalesce(sum(count), 0) AS BIGINT) AS total_items_parsed,
       count(*) AS num_unique_elements FROM ({_item_counts(TAG_ITEMS)})
UNION ALL
SELECT 'text' AS column, CAST(coalesce(sum(count), 0) AS BIGINT) AS total_items_parsed,
       count(*) AS num_unique_elements FROM ({_item_counts(DOC_ITEMS)})
"""

# --- numeric EDA -----------------------------------------------------------

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EV_NUM = ["value", "value_sq", "user_id"]


def _long(source: str, cols: list[str]) -> str:
    return union([f"SELECT '{c}' AS column, CAST({c} AS DOUBLE) AS x FROM {source} WHERE {c} IS NOT NULL"
                  for c in cols])


SQL["numeric_summary"] = f"""
SELECT column, count(x) AS count, round(min(x), 6) AS min, round(max(x), 6) AS max,
       round(coalesce(avg(x), 0.0), 6) AS mean
FROM ({_long('lineitem', LI_NUM)}) GROUP BY column
"""


def _bounds(long_sql: str) -> str:
    return f"""
SELECT column, q1, med, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
FROM (SELECT column, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med,
             quantile_cont(x, 0.75) AS q3 FROM ({long_sql}) GROUP BY column)
"""


SQL["iqr_outliers"] = f"""
WITH e AS ({EVSQ}), l AS ({_long('e', EV_NUM)}), b AS ({_bounds('SELECT * FROM l')})
SELECT b.column, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(lower, 6) AS lower, round(upper, 6) AS upper,
       count(*) FILTER (WHERE x < lower OR x > upper) AS n_outliers
FROM b JOIN l USING (column) GROUP BY b.column, q1, q3, iqr, lower, upper
"""

SQL["remove_outliers"] = f"""
WITH e AS ({EVSQ}), b AS ({_bounds(_long('e', ['value', 'value_sq']))})
SELECT event_id, round(value, 6) AS value, round(value_sq, 6) AS value_sq FROM e
WHERE NOT coalesce(value < (SELECT lower FROM b WHERE column = 'value')
                   OR value > (SELECT upper FROM b WHERE column = 'value'), false)
  AND NOT coalesce(value_sq < (SELECT lower FROM b WHERE column = 'value_sq')
                   OR value_sq > (SELECT upper FROM b WHERE column = 'value_sq'), false)
"""

SQL["skewness_adjusted"] = f"""
WITH e AS ({EVSQ})
SELECT column, count(x) AS n, round(skewness(x), 6) AS skewness FROM ({_long('e', EV_NUM)}) GROUP BY column
"""

PLOT = f"""
SELECT event_id,
  CASE WHEN abs(s_v) > 2 THEN ln(1 + (value - m_v)) ELSE value END AS value,
  CASE WHEN abs(s_sq) > 2 THEN ln(1 + (value_sq - m_sq)) ELSE value_sq END AS value_sq
FROM e, (SELECT skewness(value) AS s_v, skewness(value_sq) AS s_sq, min(value) AS m_v,
                min(value_sq) AS m_sq FROM e)
"""
SQL["log_transform_skewed"] = f"""
WITH e AS ({EVSQ})
SELECT event_id, round(value, 6) AS value, round(value_sq, 6) AS value_sq FROM ({PLOT})
"""

SQL["box_stats"] = f"""
WITH e AS ({EVSQ}), pv AS ({PLOT}), l AS ({_long('pv', ['value', 'value_sq'])}),
b AS ({_bounds('SELECT * FROM l')})
SELECT b.column, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(least(min(x) FILTER (WHERE x >= lower AND x <= upper), q1), 6) AS whisker_lo,
  round(greatest(max(x) FILTER (WHERE x >= lower AND x <= upper), q3), 6) AS whisker_hi,
  count(*) FILTER (WHERE x < lower OR x > upper) AS n_fliers
FROM b JOIN l USING (column) GROUP BY b.column, q1, med, q3
"""

SQL["histogram50"] = f"""
WITH l AS ({_long('lineitem', LI_NUM)}),
r AS (SELECT column, min(x) AS lo0, max(x) AS hi0, count(x) AS n FROM l GROUP BY column),
p AS (SELECT column, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, n FROM r),
c AS (SELECT column, CAST(least(floor((x - lo) * (50.0 / (hi - lo))), 49) AS INTEGER) AS bin, count(*) AS cnt
      FROM l JOIN p USING (column) GROUP BY 1, 2),
g AS (SELECT column, lo, hi, n, CAST(t.b AS INTEGER) AS bin FROM p, range(50) AS t(b))
SELECT g.column, g.bin, round(lo + bin * ((hi - lo) / 50.0), 6) AS bin_lo,
  round(lo + (bin + 1) * ((hi - lo) / 50.0), 6) AS bin_hi, coalesce(cnt, 0) AS count,
  round(coalesce(cnt, 0) / (n * ((hi - lo) / 50.0)), 12) AS density
FROM g LEFT JOIN c USING (column, bin)
"""

SQL["kde200"] = f"""
WITH l AS ({_long('lineitem', LI_NUM)}),
p AS (SELECT column, min(x) AS lo, max(x) AS hi, count(x) AS n, 0.6 * stddev_samp(x) AS h
      FROM l GROUP BY column HAVING stddev_samp(x) > 0),
c AS (SELECT column, x, count(*) AS cnt FROM l GROUP BY 1, 2),
g AS (SELECT column, lo, hi, n, h, CAST(t.j AS INTEGER) AS point,
             CASE WHEN t.j = 199 THEN hi ELSE lo + t.j * ((hi - lo) / 199.0) END AS gx
      FROM p, range(200) AS t(j))
SELECT g.column, g.point, round(gx, 6) AS x,
  round(sum(cnt * exp(-0.5 * ((gx - c.x) / h) * ((gx - c.x) / h))) / (n * h * sqrt(2 * pi())), 12) AS density
FROM g JOIN c USING (column) GROUP BY g.column, g.point, gx, n, h
"""


def _pearson(source: str) -> str:
    parts = []
    for a in LI_NUM:
        for b in LI_NUM:
            parts.append(f"SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 9) AS pearson FROM {source}")
    return union(parts)


HEAD = f"(SELECT * FROM lineitem ORDER BY {LINEITEM_ORDER} LIMIT 10000)"
SQL["pearson_full"] = _pearson("lineitem")
SQL["pearson_head"] = _pearson(HEAD)
SQL["head_sample"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem ORDER BY {LINEITEM_ORDER} LIMIT 10000
"""
_SC = ["l_quantity", "l_extendedprice", "l_discount"]
SQL["scatter_points"] = union([
    f"SELECT l_orderkey * 10 + l_linenumber AS row_key, '{a}' AS x_col, '{b}' AS y_col, "
    f"{a} AS x, {b} AS y FROM {HEAD}" for a in _SC for b in _SC if a != b])

# --- features ----------------------------------------------------------------

# TPC-H domains of the two low-cardinality order columns.
ORDER_STATUS = ["F", "O", "P"]
ORDER_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _indicators(column: str, values: list[str]) -> str:
    return ", ".join(f"CAST({column} = '{v}' AS INTEGER) AS \"{column}__{v}\"" for v in values)


SQL["one_hot"] = (f"SELECT o_orderkey, {_indicators('o_orderstatus', ORDER_STATUS)}, "
                  f"{_indicators('o_orderpriority', ORDER_PRIORITY)} FROM orders")

SQL["feature_routing"] = f"""
WITH t AS ({_types(['orders'])}),
card AS (SELECT 'o_orderstatus' AS column, count(DISTINCT o_orderstatus) AS n FROM orders
         UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
         UNION ALL SELECT 'o_orderdate', count(DISTINCT CAST(o_orderdate AS VARCHAR)) FROM orders),
r AS (SELECT t.column, t.position,
             CASE WHEN t.type = 'numeric' THEN 'numeric'
                  WHEN coalesce(card.n, 0) <= 15 THEN 'one_hot' ELSE 'label' END AS route,
             CASE WHEN t.type = 'numeric' THEN 0 ELSE coalesce(card.n, 0) END AS cardinality
      FROM t LEFT JOIN card USING (column))
SELECT column, route, CAST(cardinality AS BIGINT) AS cardinality,
  CAST(row_number() OVER (ORDER BY CASE route WHEN 'numeric' THEN 0 WHEN 'one_hot' THEN 1 ELSE 2 END,
                                   position) - 1 AS INTEGER) AS position
FROM r
"""


def _std(x: str, source: str) -> str:
    return (f"(({x} - (SELECT avg({x}) FROM {source})) / "
            f"(SELECT CASE WHEN stddev_pop({x}) = 0 THEN 1.0 ELSE stddev_pop({x}) END FROM {source}))")


SQL["preprocessed"] = f"""
WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, * FROM orders),
d AS (SELECT CAST(o_orderdate AS VARCHAR) AS value,
             CAST(row_number() OVER (ORDER BY CAST(o_orderdate AS VARCHAR)) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT o_orderdate FROM orders))
SELECT row_id, round({_std('CAST(o_orderkey AS DOUBLE)', 'o')}, 6) AS o_orderkey,
  round({_std('CAST(o_custkey AS DOUBLE)', 'o')}, 6) AS o_custkey,
  round({_std('o_totalprice', 'o')}, 6) AS o_totalprice,
  {_indicators('o_orderstatus', ORDER_STATUS)}, {_indicators('o_orderpriority', ORDER_PRIORITY)},
  d.code AS o_orderdate
FROM o LEFT JOIN d ON d.value = CAST(o.o_orderdate AS VARCHAR)
"""

SQL["scaler_params"] = union([
    f"SELECT '{c}' AS column, round(avg({c}), 6) AS mean, "
    f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END, 6) AS std FROM lineitem"
    for c in LI_NUM])

SQL["standardize"] = ("SELECT l_orderkey, l_linenumber, "
                      + ", ".join(f"round({_std(c, 'lineitem')}, 6) AS {c}" for c in LI_NUM)
                      + " FROM lineitem")

# PCA of three standardised columns: eigenvalues of the 3x3 correlation matrix by
# the trigonometric formula, eigenvectors as cross products of rows of A - lambda I.
PCA = f"""
WITH e AS ({EVSQ}),
c AS (SELECT corr(value, value_sq) AS a, corr(value, user_id) AS b, corr(value_sq, user_id) AS d FROM e),
q AS (SELECT *, sqrt((a * a + b * b + d * d) / 3) AS p FROM c),
r AS (SELECT *, acos(a * b * d / (p * p * p)) / 3 AS phi FROM q),
l AS (SELECT *, 1 + 2 * p * cos(phi) AS l1, 1 + 2 * p * cos(phi + 2 * pi() / 3) AS l3 FROM r),
k AS (SELECT a, b, d, 1 AS i, l1 AS lam FROM l UNION ALL SELECT a, b, d, 2, 3 - l1 - l3 FROM l),
m AS (SELECT *, 1 - lam AS m FROM k),
x AS (SELECT i, lam, m * m - d * d AS x, b * d - a * m AS y, a * d - b * m AS z FROM m
      UNION ALL SELECT i, lam, d * b - m * a, m * m - b * b, a * b - d * m FROM m
      UNION ALL SELECT i, lam, a * d - b * m, b * a - m * d, m * m - a * a FROM m),
n AS (SELECT *, sqrt(x * x + y * y + z * z) *
             sign(CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN x WHEN abs(y) >= abs(z) THEN y ELSE z END) AS s
      FROM x),
v AS (SELECT i, lam, x / s AS x, y / s AS y, z / s AS z FROM n
      QUALIFY row_number() OVER (PARTITION BY i ORDER BY abs(s) DESC) = 1)
"""
SQL["pca_variance"] = PCA + """
SELECT 'PC' || i AS component, round(lam / 3, 6) AS explained_variance_ratio,
  round(sum(lam) OVER (ORDER BY i) / 3, 6) AS cumulative_variance_ratio FROM v
"""
SQL["pca_project"] = PCA + f"""
SELECT event_id, {", ".join(
    "round(" + " + ".join(f"{_std(c, 'e')} * (SELECT {w} FROM v WHERE i = {i})" for c, w in zip(EV_NUM, "xyz"))
    + f", 6) AS PC{i}" for i in (1, 2))}
FROM e
"""

# A raw table with a column of every kind.
MIXED = """
SELECT p_partkey, p_retailprice,
  CASE WHEN p_partkey > 150 THEN 'late-' || p_brand ELSE CAST(p_partkey AS VARCHAR) END AS p_late,
  CASE WHEN p_size <> 10 THEN (CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END) END AS p_large,
  CASE WHEN p_retailprice >= 1000 THEN 'Y' ELSE 'N' END AS p_flag,
  '{"size": ' || p_size || '}' AS p_dims, p_tags
FROM (""" + TAGS + ")"
SQL["clean_mixed_types"] = (f"WITH m AS ({MIXED})\nSELECT column, position, type, hint FROM (" + union(
    [_type_select("mixed", "m", c, i, k) for i, (c, k) in enumerate(
        [("p_retailprice", "num"), ("p_late", "text"), ("p_large", "text"), ("p_flag", "text"), ("p_dims", "text"),
         ("p_tags", "text")])]) + ")")
SQL["clean_mixed"] = f"""
WITH m AS ({MIXED}),
f AS (SELECT * REPLACE (coalesce(p_large, (SELECT p_large FROM m WHERE p_large IS NOT NULL GROUP BY p_large
                                           ORDER BY count(*) DESC, p_large LIMIT 1)) AS p_large) FROM m)
SELECT p_partkey, round(p_retailprice, 6) AS p_retailprice,
  {", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}" for c in ("p_late", "p_large", "p_flag"))}
FROM f
"""
SQL["clean_mixed_lists"] = f"""
WITH m AS (SELECT * FROM ({TAGS}))
SELECT 'p_dims' AS column, p_partkey AS row_id, '{{"size": ' || p_size || '}}' AS value FROM m
UNION ALL SELECT 'p_tags', p_partkey, unnest([p_type, p_brand, split_part(p_name, ' ', 1)]) FROM m
"""
SQL["explode_python_list"] = r"""
SELECT p_partkey AS row_id, unnest(CASE p_size % 6
  WHEN 0 THEN ['say None, ok', p_type]
  WHEN 1 THEN ['{"a":' || p_size || ',"b":null}', 'True']
  WHEN 2 THEN ['x', '["y","' || p_brand || '"]']
  WHEN 3 THEN ['it''s', p_brand]
  WHEN 4 THEN ['False', 'true', '2.5']
  ELSE ['café', 'a, b'] END) AS value
FROM part
"""

_NUM_STATS = ["count", "min", "max", "mean"]
SQL["summary_stats"] = f"""
WITH ct AS ({_clean()})
SELECT column, type, statistic, round(value, 6) AS value FROM (
""" + union(
    [f"SELECT '{c}' AS column, 'numeric' AS type, '{s}' AS statistic, "
     f"CAST({'coalesce(avg(' + c + '), 0.0)' if s == 'mean' else s + '(' + c + ')'} AS DOUBLE) AS value FROM ct"
     for c in CLEAN_NUMERIC for s in _NUM_STATS]
    + [f"SELECT '{c}', '{t}', '{s}', CAST({'count(' + c + ')' if s == 'count' else 'count(DISTINCT ' + c + ')'} AS DOUBLE) FROM ct"
       for c, t in [("l_linenumber", "numeric_categorical"), ("l_discount", "numeric_categorical"),
                    ("l_tax", "numeric_categorical"), ("l_returnflag", "categorical"),
                    ("l_open", "boolean"), ("l_shipyear", "numeric_categorical")]
       for s in ["count", "num_unique_values"]]) + ")"

# --- sources and sinks -------------------------------------------------------

SQL["json_messages"] = """
SELECT CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'o_orderstatus', o_orderstatus,
                        'o_totalprice', o_totalprice, 'o_orderdate', strftime(o_orderdate, '%Y-%m-%d'),
                        'o_orderpriority', o_orderpriority) AS VARCHAR) AS value
FROM orders
"""

SQL["delivered_messages"] = (f"SELECT value, (SELECT count(*) FROM orders) AS sent, CAST(0 AS BIGINT) AS failed "
                             f"FROM ({SQL['json_messages']})")

SQL["csv_roundtrip"] = """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, text, lang, source, n_chars FROM documents
"""


# --- text-heavy tables, array lists, streaming load --------------------------

TYPE_COLUMNS.update({
    "documents": [("doc_id", "num"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "num")],
    "pages": [("page_id", "num"), ("url", "text"), ("html", "text")],
    "conversations": [("conv_id", "num"), ("turn", "num"), ("role", "text"), ("text", "text")],
    "labels": [("doc_id", "num"), ("quality", "num"), ("toxic", "num")],
    "embeddings": [("vec_id", "num"), ("embedding", "text"), ("label", "num")],
    "benchmark": [("item_id", "num"), ("text", "text")],
})
SQL["column_types_text"] = _types(["documents", "pages", "conversations", "labels", "embeddings", "benchmark"])

SQL["explode_array_list"] = """
SELECT vec_id AS row_id, e AS value
FROM (SELECT vec_id, unnest(embedding) AS e FROM embeddings) WHERE e IS NOT NULL
"""

SQL["streamed_messages"] = SQL["json_messages"]
SQL["loaded_once"] = SQL["json_messages"]


def _incremental_fit() -> str:
    scaler = union([f"SELECT '{c}' AS col_x, avg({c}) AS mean, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END AS std FROM lineitem"
                    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])
    return (f"SELECT col_x, col_y, round(pearson, 6) AS pearson, round(mean, 6) AS mean, round(std, 6) AS std "
            f"FROM ({_pearson('lineitem')}) JOIN ({scaler}) USING (col_x)")


SQL["incremental_fit"] = _incremental_fit()


def _components(cols: list[str], source: str, k: int) -> str:
    """Leading eigenvectors of the correlation matrix: the matrix is squared and
    scaled until one direction is left, which is then taken out of it. A matrix is
    a list, row by row."""
    p = len(cols)
    square = (f"list_transform(range({p * p}), lambda x: list_sum(list_transform(range({p}), "
              f"lambda y: m[x // {p} * {p} + y + 1] * m[y * {p} + x % {p} + 1])))")
    trace = f"list_sum(list_transform(range({p}), lambda y: m[y * {p + 1} + 1]))"
    cells = ", ".join("1.0" if a == b else f"corr({a}, {b})" for a in cols for b in cols)
    steps = [f"c0 AS (SELECT [{cells}] AS c FROM ({source}))"]
    for j in range(k):
        steps.append(f"""r{j}(n, m) AS (SELECT 0, c FROM c{j} UNION ALL
  SELECT n + 1, list_transform(s, lambda x: x / list_sum(list_transform(range({p}), lambda y: s[y * {p + 1} + 1])))
  FROM (SELECT n, {square} AS s FROM r{j} WHERE n < 40))""")
        # Of the projection v v', the column of the largest diagonal entry is v times its largest entry.
        steps.append(f"""w{j} AS (SELECT list_transform(range({p}), lambda y: m[y * {p} + a + 1] / sqrt(m[a * {p + 1} + 1])) AS v
  FROM (SELECT m, list_position(list_transform(range({p}), lambda y: m[y * {p + 1} + 1]),
    list_max(list_transform(range({p}), lambda y: m[y * {p + 1} + 1]))) - 1 AS a FROM r{j} WHERE n = 40))""")
        steps.append(f"""e{j} AS (SELECT v, list_sum(list_transform(range({p * p}), lambda x: v[x // {p} + 1] * c[x + 1] * v[x % {p} + 1])) AS l
  FROM w{j}, c{j})""")
        steps.append(f"""c{j + 1} AS (SELECT list_transform(range({p * p}), lambda x: c[x + 1] - l * v[x // {p} + 1] * v[x % {p} + 1]) AS c
  FROM c{j}, e{j})""")
    names = "[" + ", ".join(f"'{c}'" for c in cols) + "]"
    rows = union([f"SELECT 'PC{j + 1}' AS component, unnest({names}) AS column, round(unnest(v), 5) AS loading, "
                  f"round(l / {p}, 5) AS explained_variance_ratio FROM e{j}" for j in range(k)])
    return "WITH RECURSIVE " + ",\n".join(steps) + "\n" + rows


SQL["pca_wide"] = _components(["value", "value_sq", "value_cu", "user_id", "event_id"],
                              "SELECT *, value * value AS value_sq, value * value * value AS value_cu FROM events", 4)


# ``column`` is a reserved word in DuckDB: quote it as an identifier.
SQL = {k: re.sub(r"(?<!['\"\w])column(?![\"'\w])", '"column"', v) for k, v in SQL.items()}

# Sinks and persisted parameters: a written table read back equals the query
# it was written from.
SQL["table_roundtrip"] = SQL["impute"]
SQL["side_table_roundtrip"] = SQL["explode_json_list"]
SQL["saved_features"] = SQL["preprocessed"]
