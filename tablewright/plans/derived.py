"""Inputs derived from the benchmark tables for the registered queries.

The benchmark tables have no nulls and no list-valued text columns, so a few
queries run on columns derived from them by value rules (never by row
subsets): gaps where a value condition holds, a Y/N flag, a tag list. The
same rules appear in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.ordinal import assign_row_id
from tablewright.sources.tables import table

# lineitem has no unique key ((orderkey, linenumber) repeats), so row order is
# defined over every column; fully equal rows are interchangeable.
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]


def lineitem_with_gaps(spark: SparkSession, folder: str, with_row_id: bool = True) -> DataFrame:
    """lineitem as a loosely typed wide table with missing values:

    * ``l_quantity`` missing where ``l_discount = 0``;
    * ``l_tax`` missing where ``l_linenumber = 7``;
    * ``l_returnflag`` missing where ``l_tax = 0.08``;
    * ``l_open`` = Y/N from ``l_linestatus``, missing where ``l_linenumber = 1``;
    * ``l_shipyear`` = ship year as text;
    * ``l_note`` text present only where ``l_linenumber >= 6`` (over 70 % missing).

    ``row_id`` numbers rows in :data:`LINEITEM_ORDER` (a distributed sort, so
    it is only computed when asked for).
    """
    li = table(spark, folder, "lineitem")
    ids = assign_row_id(li, LINEITEM_ORDER) if with_row_id else li.withColumn("row_id", F.lit(None).cast("long"))
    return ids.select("row_id",
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") != 0.0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice", "l_discount",
        F.when(F.col("l_linenumber") != 7, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_tax") != 0.08, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_linenumber") != 1,
               F.when(F.col("l_linestatus") == "O", "Y").otherwise("N")).alias("l_open"),
        F.year("l_shipdate").cast("string").alias("l_shipyear"),
        F.when(F.col("l_linenumber") >= 6, F.concat(F.lit("note-"), F.col("l_returnflag"))).alias("l_note"),
    )


def part_with_tags(spark: SparkSession, folder: str) -> DataFrame:
    """part with ``p_tags``: a JSON list text of the part type, the brand and
    the first word of the name, e.g. ``["ECONOMY", "Brand#2", "small"]``."""
    p = table(spark, folder, "part")
    first = F.split(F.col("p_name"), " ").getItem(0)
    tags = F.concat(F.lit('["'), F.col("p_type"), F.lit('", "'), F.col("p_brand"),
                    F.lit('", "'), first, F.lit('"]'))
    return p.withColumn("p_tags", tags)


def part_with_literals(spark: SparkSession, folder: str) -> DataFrame:
    """part with ``p_literal``: Python list literals that are no JSON (quoted
    and bare None, booleans, a dict, a tuple, escapes, a trailing comma),
    chosen by the remainder of ``p_size``."""
    p = table(spark, folder, "part")
    forms = [
        F.concat(F.lit("['say None, ok', None, '"), F.col("p_type"), F.lit("']")),
        F.concat(F.lit("[{'a': "), F.col("p_size").cast("string"), F.lit(", 'b': None}, True]")),
        F.concat(F.lit("['x', ('y', '"), F.col("p_brand"), F.lit("')]")),
        F.concat(F.lit("['it\\'s', \""), F.col("p_brand"), F.lit("\",]")),
        F.lit("[False, 'true', 2.5]"),
        F.lit("['caf\\xe9', 'a, b']"),
    ]
    out = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        out = F.when(F.col("p_size") % len(forms) == k, form).otherwise(out)
    return p.withColumn("p_literal", out)


def part_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """part as a raw table with a column of every kind: numbers, numbers that
    turn to text after the first 150 keys, True/False with gaps, Y/N, a list and
    a dict."""
    p = part_with_tags(spark, folder)
    return p.select(
        "p_partkey", "p_retailprice",
        F.when(F.col("p_partkey") > 150, F.concat(F.lit("late-"), F.col("p_brand")))
        .otherwise(F.col("p_partkey").cast("string")).alias("p_late"),
        F.when(F.col("p_size") != 10, F.when(F.col("p_size") > 25, "True").otherwise("False")).alias("p_large"),
        F.when(F.col("p_retailprice") >= 1000, "Y").otherwise("N").alias("p_flag"),
        F.concat(F.lit('{"size": '), F.col("p_size").cast("string"), F.lit("}")).alias("p_dims"),
        "p_tags")


def events_with_square(spark: SparkSession, folder: str) -> DataFrame:
    """events with ``value_sq = value * value`` (a strongly skewed column)."""
    e = table(spark, folder, "events")
    return e.withColumn("value_sq", F.col("value") * F.col("value"))
