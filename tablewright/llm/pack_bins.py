"""Operator 8: documents packed into as few sequences as possible.

A document is its ids and an end id. Only a longer one is cut, into pieces of
full length after a shorter first one, so sizes are whole numbers from 1 to the
capacity and the packing depends on nothing but how many pieces have which
size. Spark tokenizes, counts the sizes (at most ``capacity`` counts, whatever
the input) and later deals the pieces out; the search itself runs over the
counts on the driver.

Bin completion: the largest size left is placed first, beside each of its
undominated fillings in turn, fullest first; a filling is used as often as the
counts allow, and then less often, with the later ones for the rest. Fillings are
made one by one, as the search asks for them. A branch ends when the room wasted so
far shows that it cannot beat the best packing known. Best-fit decreasing is the
first packing known. The search ends at a proven lower bound, with the whole tree
(then the packing is the best) or after ``nodes`` steps, with the best so far.

Cases: null and empty texts are one piece with the end id only; repeated rows
are packed each; an id may be null; an empty table gives no piece; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.shared import prepare, written

#: Steps of the search: fillings that are tried or found dominated, and returns.
NODES = 4_000
#: Pieces that one group of the numbering should hold, and most groups a size is dealt to.
GROUP_PIECES, MOST_GROUPS = 2_000, 4_096

Pattern = tuple[tuple[int, ...], int]  # sizes of one sequence, and how many sequences have them


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: for each k, pieces over capacity - k
    stand alone, those over half share no sequence with each other, and pieces
    of at least k fill what is left."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for k in sorted({s for s in counts if 2 * s <= capacity} | {0}):
        alone = sum(n for s, n in counts.items() if s > capacity - k)
        half = {s: n for s, n in counts.items() if capacity - k >= s and 2 * s > capacity}
        small = sum(s * n for s, n in counts.items() if k <= s and 2 * s <= capacity)
        room = sum((capacity - s) * n for s, n in half.items())
        best = max(best, alone + sum(half.values()) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counts: all sequences with equal contents are
    treated at once. Open sequences are kept by their room."""
    open_at: dict[int, Counter] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_at if r >= size), default=None)
            if room is None:
                each = capacity // size
                full, rest = divmod(left, each)
                for k, n in ((each, full), (rest, 1)):
                    if k and n:
                        open_at.setdefault(capacity - k * size, Counter())[(size,) * k] += n
                break
            content, n = next(iter(open_at[room].items()))
            n, each = min(n, left), room // size
            n, each = (min(n, left // each), each) if left >= each else (1, left)
            open_at[room][content] -= n
            if not open_at[room][content]:
                del open_at[room][content]
            if not open_at[room]:
                del open_at[room]
            open_at.setdefault(room - each * size, Counter())[content + (size,) * each] += n
            left -= n * each
    return [(content, n) for group in open_at.values() for content, n in group.items()]


def _reach(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """For each place of ``sizes`` the sums up to ``room`` that pieces from there on
    can make, as the bits of a number. The last entry is of no pieces."""
    within = (1 << (room + 1)) - 1
    out = [1]
    for s in reversed(sizes):
        sums, many, step = out[-1], min(left[s], room // s), 1
        while many > 0:                    # 1, 2, 4, .. copies and the rest make any number of them
            n = min(step, many)
            sums |= sums << (n * s) & within
            many, step = many - n, 2 * step
        out.append(sums)
    return out[::-1]


def _of_sum(sizes: list[int], left: dict[int, int], reach: list[int], total: int) -> Iterator[tuple[int, ...]]:
    """All choices of pieces with just this sum, those with larger pieces first."""
    stack = [(0, total, ())]
    while stack:
        k, rest, chosen = stack.pop()
        if not rest:
            yield chosen
            continue
        while not reach[k + 1] >> rest & 1 and not (left[sizes[k]] and sizes[k] <= rest):
            k += 1
        s = sizes[k]
        for n in range(0, min(left[s], rest // s) + 1):     # the most copies last: taken first
            if reach[k + 1] >> (rest - n * s) & 1:
                stack.append((k + 1, rest - n * s, chosen + (s,) * n))


def dominated(filling: tuple[int, ...], sizes: list[int], left: dict[int, int], room: int) -> bool:
    """Whether a piece that is left out could replace pieces of the filling: some
    (or none) of less size where it still fits, or several of just its size.
    What it replaces fits wherever the piece would go, so another filling, with
    the piece, is as good in any packing."""
    slack = room - sum(filling)
    none, one, several = 1, 0, 0            # sums of no, one and more pieces
    for s in filling:
        several |= (one | several) << s
        one |= none << s
    sums, used = none | one | several, Counter(filling)
    for x in sizes:
        if left[x] > used.get(x, 0):
            low = max(0, x - slack)
            if sums >> low & ((1 << (x - low)) - 1) or several >> x & 1:
                return True
    return False


def fillings(counts: dict[int, int], largest: int, capacity: int, after: tuple[int, ...] | None = None) -> Iterator[tuple[int, ...] | None]:
    """Undominated fillings beside one piece of size ``largest``, one by one: the
    fullest first, of equal ones those with larger pieces; only those that come
    later than ``after``. None stands for a filling that was found dominated."""
    room = capacity - largest
    left = dict(counts)
    left[largest] -= 1
    sizes = [s for s in sorted(left, reverse=True) if left[s] > 0 and s <= room]
    if not sizes:
        if after is None:
            yield ()
        return
    if sizes[0] == room:                    # it dominates every other
        if after is None:
            yield (room,)
        return
    reach = _reach(sizes, left, room)
    for total in range(room if after is None else sum(after), -1, -1):
        if reach[0] >> total & 1:
            for filling in _of_sum(sizes, left, reach, total):
                if after is None or (-total, tuple(-s for s in filling)) > (-sum(after), tuple(-s for s in after)):
                    yield None if dominated(filling, sizes, left, room) else filling


def _branches(left: dict[int, int], capacity: int, after: tuple[int, ...] | None) -> Iterator[tuple | None]:
    """(content, how often, filling) of a search node: a filling is used as often
    as the counts allow, then less often (later fillings then go on beside the
    same size). None counts as a step without a branch."""
    largest = max(left)
    for filling in fillings(left, largest, capacity, after):
        if filling is None:
            yield None
            continue
        need = Counter((largest, *filling))
        for n in range(min(left[s] // k for s, k in need.items()), 0, -1):
            yield (largest, *filling), n, filling


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[Pattern]:
    """The fewest sequences found for ``counts`` pieces of each size. If the search
    ends before ``nodes`` steps, there are no fewer."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    size = sum(n for _, n in best)
    bound, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    # (pieces left, sequences so far, room wasted so far, path, branches to come)
    stack: list[tuple[dict[int, int], int, int, tuple | None, Iterator]] = [(counts, 0, 0, None, _branches(counts, capacity, None))]
    while stack and size > bound and nodes:
        nodes -= 1
        left, used, waste, path, branches = stack[-1]
        branch = next(branches, False)
        if branch is False:
            stack.pop()
            continue
        if branch is None:
            continue
        content, n, filling = branch
        waste += n * (capacity - sum(content))
        if waste > (size - 1) * capacity - total:          # no packing below this has fewer sequences
            continue
        need = Counter(content)
        rest = {s: m - need.get(s, 0) * n for s, m in left.items() if m > need.get(s, 0) * n}
        path, used = (path, (content, n)), used + n
        if rest:
            same = rest.get(content[0], 0) > 0
            stack.append((rest, used, waste, path, _branches(rest, capacity, filling if same else None)))
        elif used < size:
            best, size = [], used
            while path:
                path, pattern = path
                best.append(pattern)
    return best


def slots(patterns: list[Pattern], capacity: int, full: int) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first, stop, sequence, each, offset): the pieces of a size numbered
    first..stop-1 go ``each`` to a sequence, from number ``sequence`` and place
    ``offset`` on. ``full`` pieces of full length stand alone."""
    out, taken, number = [], Counter(), 0
    for content, n in [*patterns, *([((capacity,), full)] if full else [])]:
        offset = 0
        for size, each in sorted(Counter(content).items(), reverse=True):
            out.append((size, taken[size], taken[size] + n * each, number, each, offset))
            taken[size] += n * each
            offset += size * each
        number += n
    return out


def cut(df: DataFrame, make_encoder: Callable, capacity: int, end_id: int,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every whole text: id, piece, start, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema

    prepare(df.sparkSession)
    schema = T.StructType([df.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        for batch in batches:
            found = encoder.ids([t or "" for t in batch.column(1).to_pylist()])
            row, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(found):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for j, (a, b) in enumerate(zip(edges, edges[1:])):
                    row.append(k), piece.append(j), start.append(a), length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                   pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                  schema=arrow)

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int, nodes: int = NODES) -> DataFrame:
    """``pieces`` (with ``length``) with sequence_id and offset. Pieces of a size
    are numbered in two steps, within groups dealt by a hash and from group to
    group, so that a size that most pieces have is no single task's work."""
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    total = pieces.count()
    groups = max(1, min(MOST_GROUPS, total // GROUP_PIECES))
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64(*pieces.columns), F.lit(groups)).cast("int"))
    counted = written(keyed.groupBy("length", "_group").agg(F.count("*").alias("_n")), "piece-counts")
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    counted_before = counted.select("length", "_group", F.coalesce(before, F.lit(0)).alias("_before"))
    sizes = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("_n")).collect()}     # at most ``capacity`` rows
    full = sizes.pop(capacity, 0)
    table = spark.createDataFrame(
        slots(complete_bins(sizes, capacity, nodes), capacity, full),
        "length bigint, _first bigint, _stop bigint, _sequence bigint, _each bigint, _offset bigint")
    order = Window.partitionBy("length", "_group").orderBy(*pieces.columns)
    ranked = keyed.withColumn("_row", F.row_number().over(order)).join(counted_before, ["length", "_group"]).withColumn(
        "_rank", F.col("_row") - 1 + F.col("_before"))
    # The slots are bounded by the number of sizes and of search steps, not by the input.
    held = F.broadcast(table.withColumnRenamed("length", "_size"))
    dealt = ranked.join(held, (F.col("length") == F.col("_size")) & (F.col("_rank") >= F.col("_first"))
                        & (F.col("_rank") < F.col("_stop")))
    at = F.col("_rank") - F.col("_first")
    return dealt.select(*pieces.columns, (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
                        (F.col("_offset") + at % F.col("_each") * F.col("length")).cast("long").alias("offset"))


def pack(df: DataFrame, make_encoder: Callable, capacity: int = 1024, end_id: int = 2, nodes: int = NODES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return place(cut(df, make_encoder, capacity, end_id, id_col, text_col), capacity, nodes)
