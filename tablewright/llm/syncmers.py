"""Operator 5: document fingerprints of closed syncmers.

The letters of the sequence are words (pieces of at most ``PIECE`` characters
of the runs between white space). A k-mer is ``K`` words in a row; it is chosen
if the least hash of its inner substrings of ``S`` words stands at its first or
last place. The choice depends on the k-mer alone, so equal passages have equal
anchors wherever they stand, and an edit changes the anchors next to it only. A
fingerprint is all distinct anchor hashes of the whole text, each with the place
(words before it) of its first anchor. Everything is built of DataFrame functions.

Likeness matches by position: an anchor that two texts have in common counts if it
stands at the same place in both, or as far from its place as the common anchor
before or after it, as in a passage that moved as a whole. Common anchors that only
chance, or another order of the words, puts into both do not count. The likeness
is the share of these anchors in all anchors of the two.

A text without a chosen k-mer has its whole word sequence as its one anchor; a
text without words has none, and two such texts are alike (1). Null is empty.

For the next document, rows are dealt by ranges of the id (bounds from an
approximate quantile, a range for every ``RANGE_ROWS`` rows; from some 65 million
rows on ``MOST_RANGES`` longer ones, as the bounds are part of the plan), and the
first row of each range is also sent to the range before it, so a window over one
range sees the next document of every row. Texts are shuffled once; a row's
fingerprint is made where its range is, once, and the row before it takes it over
by the same window. An id is expected to be unique;
rows of one id are ordered by their text, null ids come first. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.shared import let

K, S, PIECE = 5, 2, 12
RANGE_ROWS, MOST_RANGES = 500, 131_072


def anchor(value: Column, place: Column) -> Column:
    return F.struct(value.alias("hash"), place.cast("int").alias("place"))


def anchors(text: Column) -> Column:
    """array<struct<hash bigint, place int>>: the chosen k-mers of a text, in order.
    A place is the number of the words before the anchor in its text."""
    words = F.transform(F.regexp_extract_all(text, F.lit(r"\S{1,%d}" % PIECE), F.lit(0)), lambda w: F.xxhash64(w))

    def chosen(h: Column) -> Column:
        inner = F.zip_with(h, F.slice(h, F.lit(S), F.size(h)), lambda a, b: F.xxhash64(a, b))

        def pick(s: Column) -> Column:
            wide = K - S
            at = F.filter(F.sequence(F.lit(0), F.size(h) - K), lambda i: F.least(F.get(s, i), F.get(s, i + wide)) <= F.least(
                *[F.get(s, i + j) for j in range(1, wide)]))
            return F.transform(at, lambda i: anchor(F.xxhash64(F.get(s, i), F.get(s, i + 2), F.get(h, i + 4)), i))

        return let(let(inner, pick), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(anchor(F.xxhash64(h), F.lit(0)))))

    return let(words, lambda h: F.when(F.size(h) == 0, F.array().cast("array<struct<hash:bigint,place:int>>")).when(
        F.size(h) < K, F.array(anchor(F.xxhash64(h), F.lit(0)))).otherwise(chosen(h)))


def fingerprint(text: Column) -> Column:
    """array<struct<hash, place>> of all anchors in the order of the hashes, the
    first place of each."""
    return let(F.sort_array(anchors(text)), lambda a: F.filter(
        a, lambda x, k: (k == 0) | (x["hash"] != F.get(a, k - 1)["hash"])))


def as_text(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.concat_ws("@", F.hex(x["hash"]), x["place"].cast("string"))), " ")


def likeness(one: Column, two: Column) -> Column:
    """Share of the anchors of two fingerprints that match by position (0 to 1)."""
    def tagged(prints: Column, tag: int) -> Column:
        return F.transform(prints, lambda x: F.struct(x["hash"].alias("hash"), F.lit(tag).alias("tag"), x["place"].alias("place")))

    # Sorted together, the two of a common anchor are neighbours.
    both = F.sort_array(F.concat(tagged(one, 0), tagged(two, 1)))
    common = let(both, lambda a: F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(a) - 2), lambda i: (F.get(a, i)["hash"] == F.get(a, i + 1)["hash"])),
        lambda i: F.struct(F.get(a, i)["place"].alias("place"), (F.get(a, i + 1)["place"] - F.get(a, i)["place"]).alias("moved")))))
    matched = let(common, lambda c: F.size(F.filter(c, lambda x, k: (x["moved"] == 0) | (
        F.coalesce(F.get(c, k - 1)["moved"] == x["moved"], F.lit(False))) | F.coalesce(F.get(c, k + 1)["moved"] == x["moved"], F.lit(False)))))
    total = F.size(one) + F.size(two)
    return F.when(total == 0, F.lit(1.0)).when((F.size(one) == 0) | (F.size(two) == 0), F.lit(0.0)).otherwise(
        let(matched, lambda n: n / (total - n)))


def _constants(values: list) -> Column:
    """Whole numbers (or lists of them) as one literal, however many."""
    kind = "array<array<bigint>>" if values and isinstance(values[0], list) else "array<bigint>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def _range_of(bounds: list[int], value: Column) -> Column:
    """How many of the (sorted) bounds are at most ``value``: over blocks of
    bounds first, then within one block."""
    step = max(1, round(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    if not blocks:
        return F.lit(0)
    heads, inner = _constants([b[0] for b in blocks]), _constants(blocks)
    return let(upto(heads), lambda k: F.when(k == 0, F.lit(0)).otherwise((k - 1) * step + upto(F.get(inner, k - 1))))


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, prints, next_text, next_prints) with the next row by id; after the
    last comes the first."""
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63))
    keys = df.select(order.alias("k"))
    rows = keys.count()
    ranges = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    bounds: list[int] = []
    if ranges > 1:
        bounds = sorted(set(keys.agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]))
    keyed = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), order.alias("k")).withColumn(
        "at", _range_of(bounds, F.col("k")))
    firsts = sorted(keys.withColumn("at", _range_of(bounds, F.col("k"))).groupBy("at").agg(F.min("k")).collect())
    # For each range its first id and the range before it; the first row of all also follows the last.
    first_of, before = ([None] * (len(bounds) + 1) for _ in range(2))
    for i, (at, k) in enumerate(firsts):
        first_of[at], before[at] = k, firsts[i - 1][0]
    is_first = F.get(_constants(first_of), F.col("at")) == F.col("k")
    ghost = F.when(is_first, F.get(_constants(before), F.col("at")).cast("int"))
    copies = keyed.withColumn("tie", F.xxhash64("text")).withColumn("dealt", F.explode(F.array_compact(F.array(
        F.struct(F.col("at").alias("at"), F.lit(0).alias("ghost")),
        F.when(ghost.isNotNull(), F.struct(ghost.alias("at"), F.lit(1).alias("ghost"))))))).select(
        "id", "text", "k", "tie", F.col("dealt.at").alias("range"), F.col("dealt.ghost").alias("ghost"))
    made = copies.repartition("range").withColumn("prints", fingerprint(F.col("text")))
    here = Window.partitionBy("range").orderBy("ghost", "k", "tie")
    both = made.withColumn("next", F.lead(F.struct("text", "prints")).over(here))
    return both.where("ghost = 0").select("id", "text", "prints", F.col("next.text").alias("next_text"), F.col("next.prints").alias("next_prints"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next: the edited text has its last quarter of code points replaced by
    the first as many of the next document."""
    rows = with_next(df, id_col, text_col)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("id", n.cast("long").alias("n_chars"), "prints", "next_prints",
                       let(edited, lambda e: F.struct(F.sha2(e, 256).alias("sha256"), fingerprint(e).alias("prints"))).alias("edited"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", F.col("edited.sha256").alias("edited_sha256"), as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited.prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited.prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"))
