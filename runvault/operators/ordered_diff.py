"""Ordered diff of two versions, line by line or cell by cell.

Items (lines, cells) of both sides get integer ids.  Items that are unique on both sides are
anchors; the longest chain of them that rises on both sides is kept, and it
cuts a pair into gaps.  Inside a gap the shortest edit script (Myers) is
searched, again between anchors that are unique within the gap.  A gap without
anchors that needs more than ``MAX_EDITS`` edits is matched by the k-th
occurrence of each item and its longest rising chain: still a valid script,
not always the shortest.

Scale notes
-----------
* Ids and counts are window values over (pair, item); items that stand on one side
  only are added or removed without further work.
* Only positions and ids of a pair, never its texts, meet in one row, to find the chain.
  Gaps are dealt out by (pair, gap), so the gaps of one huge pair are searched
  by many tasks.
* The script is joined back to the items by (pair, side, position): no hot key.

Null texts have no lines; a pair without any item gives no row.  A pair with one
side only is all added or all removed.  Null items are equal to each other.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_EDITS = 400


# ------------------------------------------------------------------ one pair, integers

def rising_chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``pairs`` (ordered by the first number) that rises in the second."""
    tails: list[int] = []           # smallest end of a chain of each length
    at: list[int] = []              # which pair that is
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        length = bisect_left(tails, j)
        before.append(at[length - 1] if length else -1)
        if length == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[length], at[length] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def shortest_script(a: list[int], b: list[int], limit: int = MAX_EDITS) -> list[tuple[int, int]] | None:
    """Kept positions of a shortest edit script (Myers' greedy search); ``None`` beyond ``limit`` edits."""
    far, trace = {1: 0}, []
    for edits in range(min(limit, len(a) + len(b)) + 1):
        trace.append(dict(far))
        for k in range(-edits, edits + 1, 2):
            down = k == -edits or (k != edits and far[k - 1] < far[k + 1])
            x = far[k + 1] if down else far[k - 1] + 1
            while x < len(a) and x - k < len(b) and a[x] == b[x - k]:
                x += 1
            far[k] = x
            if x >= len(a) and x - k >= len(b):
                return _walk_back(trace, len(a), len(b))
    return None


def _walk_back(trace: list[dict[int, int]], x: int, y: int) -> list[tuple[int, int]]:
    kept = []
    for edits in range(len(trace) - 1, -1, -1):
        far, k = trace[edits], x - y
        down = k == -edits or (k != edits and far[k - 1] < far[k + 1])
        from_k = k + 1 if down else k - 1
        from_x = far[from_k] if edits else 0
        from_y = from_x - from_k if edits else 0
        while x > from_x and y > from_y:
            x, y = x - 1, y - 1
            kept.append((x, y))
        x, y = from_x, from_y
    return kept[::-1]


def by_occurrence(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Kept positions when the k-th occurrence of an id may only meet the k-th on the other side."""
    places: dict[tuple[int, int], int] = {}
    seen: Counter = Counter()
    for j, x in enumerate(b):
        places[x, seen[x]] = j
        seen[x] += 1
    seen.clear()
    pairs = []
    for i, x in enumerate(a):
        if (j := places.get((x, seen[x]))) is not None:
            pairs.append((i, j))
        seen[x] += 1
    return rising_chain(pairs)


def kept_positions(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions (in a, in b) of the ids that an edit script from a to b keeps, rising in both."""
    kept, work = [], [(0, len(a), 0, len(b))]
    while work:
        i, i_end, j, j_end = work.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            kept.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            kept.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[y]: y for y in range(j, j_end) if in_b[b[y]] == 1}
        chain = rising_chain([(x, place[a[x]]) for x in range(i, i_end) if in_a[a[x]] == 1 and a[x] in place])
        if chain:
            kept += chain
            for (x, y), (x_end, y_end) in zip([(i - 1, j - 1), *chain], [*chain, (i_end, j_end)]):
                work.append((x + 1, x_end, y + 1, y_end))
        else:
            found = shortest_script(a[i:i_end], b[j:j_end])
            if found is None:
                found = by_occurrence(a[i:i_end], b[j:j_end])
            kept += [(i + x, j + y) for x, y in found]
    return sorted(kept)


# ------------------------------------------------------------------ Spark

_SIDE = "array<struct<pos:int,id:bigint,unique:boolean>>"


def _gap_schema(pair_type: str) -> str:
    return (f"pair {pair_type}, gap int, kept boolean, old_pos array<int>, old_id array<bigint>, "
            "new_pos array<int>, new_id array<bigint>")


def _columns(names: list[str]):
    types = {"gap": pa.int32(), "kept": pa.bool_(), "old_pos": pa.list_(pa.int32()), "new_pos": pa.list_(pa.int32()),
             "old_id": pa.list_(pa.int64()), "new_id": pa.list_(pa.int64())}

    def batch(pair: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pair, *[pa.array([r[k] for r in rows], types[n]) for k, n in enumerate(names)]], names=["pair", *names])
    return batch


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, old, new) to one row with the anchors kept and one row for each gap with ids on both sides."""
    batch_of = _columns(["gap", "kept", "old_pos", "old_id", "new_pos", "new_id"])
    for batch in batches:
        for n in range(batch.num_rows):
            old, new = batch.column(1)[n].as_py(), batch.column(2)[n].as_py()
            place = {r["id"]: k for k, r in enumerate(new) if r["unique"]}
            chain = rising_chain([(k, place[r["id"]]) for k, r in enumerate(old) if r["unique"]])
            rows = [(0, True, [old[i]["pos"] for i, _ in chain], [], [new[j]["pos"] for _, j in chain], [])]
            for gap, ((i, j), (i_end, j_end)) in enumerate(
                    zip([(-1, -1), *chain], [*chain, (len(old), len(new))]), 1):
                if i + 1 < i_end and j + 1 < j_end:
                    a, b = old[i + 1:i_end], new[j + 1:j_end]
                    rows.append((gap, False, [r["pos"] for r in a], [r["id"] for r in a],
                                 [r["pos"] for r in b], [r["id"] for r in b]))
            yield batch_of(batch.column(0).take(pa.array([n] * len(rows))), rows)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_gaps`` to (pair, old_pos, new_pos) of what is kept."""
    batch_of = _columns(["old_pos", "new_pos"])
    for batch in batches:
        rows = []
        for r in batch.select(["kept", "old_pos", "old_id", "new_pos", "new_id"]).to_pylist():
            old, new = r["old_pos"], r["new_pos"]
            if not r["kept"]:
                kept = kept_positions(r["old_id"], r["new_id"])
                old, new = [old[i] for i, _ in kept], [new[j] for _, j in kept]
            rows.append((old, new))
        yield batch_of(batch.column(0), rows)


def ordered_diff(items: DataFrame) -> DataFrame:
    """``pair, op, old_pos, new_pos, item``: the edit script from target to current.

    ``items`` has pair, side ('curr' | 'target'), pos (from 0, unique in a side) and
    item.  ``keep`` rows have both positions, ``remove`` rows the old one, ``add`` rows
    the new one.  Kept items rise on both sides, so the script can be replayed.
    """
    items = items.select("pair", "side", F.col("pos").cast("int").alias("pos"), "item")
    is_new = F.col("side") == "curr"
    same = Window.partitionBy("pair", "item")
    both = items.select(
        "pair", "pos", is_new.alias("is_new"),
        F.min(F.col("pos").cast("long") * 2 + is_new.cast("long")).over(same).alias("id"),
        F.count_if(is_new).over(same).alias("n_new"), F.count_if(~is_new).over(same).alias("n_old"),
    ).filter("n_new > 0 and n_old > 0")
    entry = F.struct("pos", "id", ((F.col("n_new") == 1) & (F.col("n_old") == 1)).alias("unique"))
    sides = both.groupBy("pair").agg(
        F.sort_array(F.collect_list(F.when(~F.col("is_new"), entry))).cast(_SIDE).alias("old"),
        F.sort_array(F.collect_list(F.when(F.col("is_new"), entry))).cast(_SIDE).alias("new"))
    pair_type = items.schema["pair"].dataType.simpleString()
    gaps = sides.mapInArrow(_gaps, _gap_schema(pair_type)).repartition("pair", "gap")
    kept = gaps.mapInArrow(_search, f"pair {pair_type}, old_pos array<int>, new_pos array<int>").select(
        "pair", F.inline(F.arrays_zip("old_pos", "new_pos")))
    ends = [F.struct(F.lit(side).alias("side"), F.col(pos).alias("pos"), F.col(other).alias("other"))
            for side, pos, other in (("target", "old_pos", "new_pos"), ("curr", "new_pos", "old_pos"))]
    both_ends = kept.select("pair", F.inline(F.array(*ends)))
    match = (F.col("i.pair").eqNullSafe(F.col("e.pair")) & (F.col("i.side") == F.col("e.side"))
             & (F.col("i.pos") == F.col("e.pos")))
    found = items.alias("i").join(both_ends.alias("e"), match, "left").select("i.*", "e.other")
    is_new, is_kept = F.col("side") == "curr", F.col("other").isNotNull()
    return found.filter(~(is_new & is_kept)).select(
        "pair", F.when(is_new, "add").when(is_kept, "keep").otherwise("remove").alias("op"),
        F.when(~is_new, F.col("pos")).alias("old_pos"),
        F.when(is_new, F.col("pos")).otherwise(F.col("other")).alias("new_pos"), "item")


def ordered_line_diff(texts: DataFrame, drop_last: bool = False) -> DataFrame:
    """``pair, op, old_pos, new_pos, line`` of texts (pair, side, text); ``drop_last``: without final lines."""
    lines = F.split("text", "\n")
    if drop_last:
        lines = F.slice(lines, 1, F.size(lines) - 1)
    items = texts.select("pair", "side", F.posexplode(lines).alias("pos", "item"))
    return ordered_diff(items).withColumnRenamed("item", "line")


def ordered_cell_diff(cells: DataFrame) -> DataFrame:
    """``pair, op, old_pos, new_pos, cell_type, source`` of notebooks (pair, side, pos, cell_type, source).

    Outputs, metadata and ids do not count, nor does the last cell of a notebook.
    Positions are places among the cells of a side.
    """
    order = Window.partitionBy("pair", "side").orderBy("pos")
    items = (cells.withColumn("_n", F.row_number().over(order) - 1)
             .withColumn("_last", F.lead("pos").over(order).isNull()).filter("not _last")
             .select("pair", "side", F.col("_n").alias("pos"), F.struct("cell_type", "source").alias("item")))
    return ordered_diff(items).select("pair", "op", "old_pos", "new_pos", "item.cell_type", "item.source")


def replay(diff: DataFrame, item: str = "line", separator: str = "\n") -> DataFrame:
    """``pair, curr_text, target_text, in_order`` put together again from a script.

    ``curr_text`` is what the script makes of the target (kept and added items by new
    position), ``target_text`` what it started from; ``in_order`` tells whether
    kept items rise on both sides.
    """
    def side(op: str, pos: str):
        rows = F.sort_array(F.collect_list(F.when(F.col("op") != op, F.struct(pos, F.coalesce(item, F.lit("")).alias("x")))))
        return F.array_join(F.transform(rows, lambda r: r["x"]), separator)
    kept = F.sort_array(F.collect_list(F.when(F.col("op") == "keep", F.struct("old_pos", "new_pos"))))["new_pos"]
    return diff.groupBy("pair").agg(side("remove", "new_pos").alias("curr_text"), side("add", "old_pos").alias("target_text"),
                                    (kept == F.array_sort(kept)).alias("in_order"))


def unified_text(diff: DataFrame, context: int = 1) -> DataFrame:
    """``pair, n_added, n_removed, diff``: changed lines and ``context`` lines around them, as text.

    ``diff`` is a line script.  Lines begin with ``-``, ``+`` or a blank; before each run of shown lines
    stands ``@@`` with the line numbers (from 1) that it starts from on both sides.  Pairs without a
    change give no row.
    """
    in_script = Window.partitionBy("pair").orderBy("gap", "rank", "pos")
    earlier = in_script.rowsBetween(Window.unboundedPreceding, -1)
    rows = (_in_gaps(diff)
            .withColumn("_old", F.count_if(F.col("op") != "add").over(earlier) + 1)
            .withColumn("_new", F.count_if(F.col("op") != "remove").over(earlier) + 1)
            .withColumn("_shown", F.max((F.col("op") != "keep").cast("int")).over(in_script.rowsBetween(-context, context)) == 1)
            .withColumn("_cut", F.col("_shown") & ~F.lag("_shown", 1, False).over(in_script)).filter("_shown"))
    sign = F.when(F.col("op") == "add", "+").when(F.col("op") == "remove", "-").otherwise(" ")
    head = F.format_string("@@ -%d +%d @@\n", "_old", "_new")
    text = F.concat(F.when(F.col("_cut"), head).otherwise(""), sign, F.coalesce("line", F.lit("")))
    return rows.groupBy("pair").agg(
        F.count_if(F.col("op") == "add").alias("n_added"), F.count_if(F.col("op") == "remove").alias("n_removed"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("gap", "rank", "pos", text.alias("t")))),
                                 lambda r: r["t"]), "\n").alias("diff"))


def _in_gaps(diff: DataFrame) -> DataFrame:
    """``diff`` with its order: ``gap`` (kept lines before a row), ``rank`` (removals, additions, then
    the kept line that ends the gap) and ``pos``."""
    def side(other: str, at: str) -> DataFrame:
        before = Window.partitionBy("pair").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return diff.filter(F.col("op") != other).withColumn(
            "gap", F.count_if(F.col("op") == "keep").over(before)).withColumn("pos", F.col(at))
    both = side("add", "old_pos").unionByName(side("remove", "new_pos").filter("op = 'add'"))
    return both.withColumn("rank", F.when(F.col("op") == "remove", 0).when(F.col("op") == "add", 1).otherwise(2))
