"""Operator 13: Merkle manifest of a dataset.

A leaf is the hash of a row's fields. The leaves of a group (``lang``) are numbered
by their ids; every run of ``FAN`` neighbours makes a node of the next level, until
one is left, the group's subroot. The subroots, in the order of their groups, make
the root in the same way.

Nodes travel as text: an aligned block of ``BLOCK`` nodes keeps a level as one
string of hex digests. Fixed-width pieces of that string are hashed to the next
level's string, ``HEIGHT`` levels in a block; the pieces left and right of a node
within its run are its sibling segments. What a block comes to is a node of the
next round, so a round divides the number of nodes by ``BLOCK`` and the proofs of
the upper rounds are joined to blocks, not to rows. Everything is built of
DataFrame functions.

Numbers come from a range partition over (group, id): rows are sorted where they
are, and a row's number is its place there and the rows of its group in the
partitions before. The row's key breaks ties, so a hot group or id is split.

Cases: null fields count as ``-``; a null group is the first one, a null id the
first of its group; rows that repeat an id are leaves of their own, by their leaf
and then in any order (equal leaves are interchangeable); a lone leaf is its
group's subroot and a lone subroot the root, with no siblings at that level; an
empty table gives an empty result; texts of any length are hashed where they are
read and never shuffled; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import let, lower_ascii, written

#: Neighbours that make a node, and the levels that a block holds.
FAN, HEIGHT = 8, 3
BLOCK = FAN**HEIGHT
#: Hex digits of a digest.
WIDTH = 64
#: Rows that one range of the numbering should hold at most.
RANGE_ROWS = 500_000

SEGMENT = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (with ``grp``, ``id``, ``leaf`` and the unique ``key``) with ``pos``,
    the number within the group from 0 on, and ``total``, the rows of the group."""
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    order = ["grp", "id", "leaf", "key"]
    at = F.monotonically_increasing_id()               # partition and place in one number
    tagged = written(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("at", at), name)
    tagged = tagged.withColumn("part", F.shiftright("at", 33))
    # A row for each range and group at most.
    counted = tagged.groupBy("part", "grp").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select("part", "grp", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                             F.sum("rows").over(Window.partitionBy("grp")).alias("total"))
    return tagged.join(counted, ["part", "grp"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop(
        "part", "at", "first", "before", "key")


def _piece(level: Column, start: Column, width: Column) -> Column:
    """Fixed-width piece of a level: bytes, so that no character before it is read."""
    return F.substring(level, start * WIDTH + 1, width * WIDTH)


def _up(level: Column) -> Column:
    """The next level's string."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) / WIDTH - 1) / FAN).cast("int"))
    return let(level, lambda whole: F.encode(F.array_join(F.transform(
        runs, lambda r: F.sha2(_piece(whole, r * FAN, F.lit(FAN)), 256)), ""), "UTF-8"))


def _segment(level: Column, at: Column) -> Column:
    """What stands left and right of node ``at`` in its run."""
    inside = F.pmod(at, F.lit(FAN)).cast("int")
    begin = (at - inside).cast("int")
    return F.struct(_piece(level, begin, inside).cast("string").alias("left"),
                    _piece(level, (at + 1).cast("int"), F.lit(FAN - 1) - inside).cast("string").alias("right"))


def blocks(nodes: DataFrame, name: str) -> DataFrame:
    """A row for each aligned block of ``nodes`` (grp, pos, total, leaf and other
    columns): grp, block, total, ``rows`` (its nodes as an array of structs, by
    pos), ``levels`` (binary strings, the nodes' own level first) and ``top``."""
    carried = [c for c in nodes.columns if c not in ("grp", "total", "pos")]
    held = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", *carried))).alias("rows"))
    base = F.encode(F.array_join(F.transform("rows", lambda r: r["leaf"]), ""), "UTF-8")
    # A group that is a single block ends with the level that has one node.
    height = F.when(F.col("total") > BLOCK, F.lit(HEIGHT))
    for k in range(HEIGHT):
        height = height.when(F.col("total") <= FAN**k, F.lit(k))
    levels = F.aggregate(F.sequence(F.lit(1), F.lit(HEIGHT)), F.array(base), lambda out, k: F.when(
        k <= height.otherwise(F.lit(HEIGHT)), F.concat(out, F.array(_up(F.element_at(out, -1))))).otherwise(out))
    out = held.withColumn("levels", levels)
    # Written: the strings are computed once and read by the proofs below.
    return written(out.withColumn("top", F.element_at("levels", -1).cast("string")), name)


def proofs(level: DataFrame) -> DataFrame:
    """grp, block, total, ``row`` and ``own``, the row's sibling segments within its
    block from the lowest level up."""
    one = level.select("grp", "block", "total", "levels", F.posexplode("rows").alias("place", "row"))
    own = F.transform(F.sequence(F.lit(0), F.size("levels") - 2), lambda k: _segment(
        F.get("levels", k), F.floor(F.col("place") / F.pow(F.lit(float(FAN)), k)).cast("int")))
    return one.select("grp", "block", "total", "row", F.when(F.size("levels") > 1, own).otherwise(
        F.array().cast(SEGMENT)).alias("own"))


def _tree(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(the blocks of ``nodes``, each with ``above``: the segments of its top up to
    the group's last node; grp and that node as ``top``)."""
    rounds = [blocks(nodes, f"{name}-0")]
    while True:
        open_ = rounds[-1].where(F.col("total") > BLOCK).select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("leaf"))
        if not open_.take(1):
            break
        rounds.append(blocks(open_, f"{name}-{len(rounds)}"))
    ends = [r.where(F.col("total") <= BLOCK).select("grp", "top") for r in rounds]
    tops = ends[0]
    for more in ends[1:]:
        tops = tops.unionByName(more)
    none = F.array().cast(SEGMENT)
    above = None
    for k in range(len(rounds) - 1, -1, -1):
        if above is None:
            with_above = rounds[k].withColumn("above", none)
        else:
            with_above = rounds[k].join(above, ["grp", "block"], "left").withColumn("above", F.coalesce("above", none))
        if k:
            found = proofs(with_above).join(with_above.select("grp", "block", "above"), ["grp", "block"])
            above = written(found.select("grp", F.col("row.pos").alias("block"), F.concat("own", "above").alias("above")),
                            f"{name}-above-{k}")
    return with_above, tops


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             tampered: Column | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``leaf``, ``subroot``, ``root``, ``proof`` (array
    of left and right sibling segments, lowest level first), ``folded_root`` (the
    root that the siblings give with the leaf of the tampered row) and ``verified``.
    Where ``tampered`` holds, the text's A-Z are lower-cased for that leaf."""
    plain = [F.col(f"`{c}`") for c in fields]
    changed = [lower_ascii(F.col(f"`{c}`")) if c == text_col else F.col(f"`{c}`") for c in fields]
    is_tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    # Null is the first group; the mark before the others keeps their order.
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    rows = df.select(group.alias("grp"), F.col(id_col).alias("id"), leaf(plain).alias("leaf"),
                     F.when(is_tampered, leaf(changed)).alias("changed"))
    leaves = written(rows.withColumn("key", F.monotonically_increasing_id()), "leaves")
    base, subroots = _tree(numbered(leaves, "numbered"), "tree")
    subroots = written(subroots, "subroots")
    tops = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("top").alias("leaf"), F.col("grp").alias("key"))
    over, roots = _tree(numbered(written(tops, "tops"), "tops-numbered"), "top-tree")
    # A row for each group: its subroot, its segments and the root.
    up = proofs(over).join(over.select("grp", "block", "above"), ["grp", "block"]).join(roots, "grp").select(
        F.col("row.id").alias("grp"), F.col("row.leaf").alias("subroot"), F.concat("own", "above").alias("last"), F.col("top").alias("root"))
    up = written(up, "group-proofs")
    ends = base.select("grp", "block", "above").join(up, "grp")
    found = proofs(base).join(ends, ["grp", "block"])
    whole = found.select(F.col("row.id").alias(id_col), F.col("row.leaf").alias("leaf"), F.col("row.changed").alias("changed"),
                         "subroot", "root", F.concat("own", "above", "last").alias("proof"))
    folded = F.aggregate("proof", F.coalesce("changed", "leaf"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    return whole.select(id_col, "leaf", "subroot", "root", "proof", folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """Hash of the siblings, left to right and lowest level first."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
