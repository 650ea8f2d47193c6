"""Overlap joins of integer intervals with equal keys, whatever the lengths of the intervals.

The number line is cut into cells, and cells into nodes of a binary tree: node (level, i) holds the 2**level cells from
i * 2**level on. An interval of n cells is covered by at most 2 log2(n) nodes that don't overlap, so a long one costs
some tens of rows and not one a cell. Two intervals share a cell exactly if the first cell of one lies in the other, and
a cell lies in an interval exactly if one node of its cover stands over the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

#: Bits of a cell: the width of a cell is 2**CELL, so that most intervals lie in one or two.
CELL = 20


def over(at: Column, level: Column | int) -> Column:
    """The node of a level that stands over a cell (or the cell over a number)."""
    return F.call_function("shiftright", at, F.lit(level) if isinstance(level, int) else level)


def cover(first: Column, last: Column, bits: int) -> Column:
    """Nodes (level, node) of `bits`-bit cells that cover first..last exactly, as an array."""
    up = lambda k: -over(-first, k)  # noqa: E731  first / 2**k, rounded up
    down = lambda k: over(last + 1, k)

    def at(k: Column) -> Column:
        odd_first, odd_last = up(k) % 2 != 0, down(k) % 2 != 0
        node = lambda i: F.struct(k.alias("level"), i.alias("node"))
        low = F.when(odd_first & (up(k) < down(k)), node(up(k)))
        high = F.when(odd_last & (up(k) + odd_first.cast("long") < down(k)), node(down(k) - 1))
        return F.filter(F.array(low, high), lambda x: x.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bits)), at))


def overlapping(few: DataFrame, many: DataFrame, keys: list[str], few_span: tuple[Column, Column], many_span: tuple[Column, Column], bits: int = CELL) -> DataFrame:
    """Pairs of rows of equal keys whose spans (low, high; nulls meet nothing) share a cell, each once; the exact test is the caller's.

    Columns: those of few, and those of many but the keys. few is written once as its cover. A row of many stands under
    one node for each level that covers of its keys have (mostly one: that of the cells), and one that is longer than a
    cell is covered too, for rows of few that begin inside it. A node over very many rows is one key; its rows are all
    part of the result, and skewed joins are split by Spark. The cover is many rows in a small file (millions in a few
    MB), and Spark would take the file's size for the table's and broadcast it, so the join is told to sort and merge.
    """
    names = [c for c in many.columns if c not in keys]
    levels = 63 - bits  # a shift by 64 would be none
    # Kind 0: the cover of few under the first cell of many; kind 1: the first cell of few under the cover of many.
    key = lambda kind, level, node: F.struct(F.lit(kind).alias("_kind"), level.cast("int").alias("_level"), node.alias("_node"))
    covered = lambda kind, first, last: F.transform(cover(first, last, levels), lambda x: key(kind, x["level"], x["node"]))
    first, last = over(few_span[0], bits), over(few_span[1], bits)
    cells = F.when(first == last, F.array(key(0, F.lit(0), first))).otherwise(covered(0, first, last))
    starts = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: key(1, k, over(first, k)))
    nodes = few.where(few_span[0].isNotNull() & few_span[1].isNotNull()).select(*keys, F.struct(*[c for c in few.columns if c not in keys]).alias("_few"), F.inline(F.concat(cells, starts)))
    nodes = staged(nodes, "cover")
    used = nodes.where("_kind = 0").groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))  # at most one a level

    rows = many.where(many_span[0].isNotNull() & many_span[1].isNotNull()).select(*keys, F.struct(*names).alias("_many"), over(many_span[0], bits).alias("_low"), over(many_span[1], bits).alias("_high"))
    low, high = F.col("_low"), F.col("_high")
    own = F.transform("_levels", lambda k: key(0, k, over(low, k)))
    long = F.when(low < high, covered(1, low + 1, high)).otherwise(F.array().cast("array<struct<_kind: int, _level: int, _node: bigint>>"))
    placed = rows.join(used, keys).select(*keys, "_many", F.inline(F.concat(own, long)))
    return nodes.hint("merge").join(placed, [*keys, "_kind", "_level", "_node"]).select(*keys, "_few.*", "_many.*")
