"""Sharding: minimax contiguous partition of ordered atomic groups.

Rows with equal texts form a group that is never split. Groups are ordered by a 128-bit hash of their text.
The smallest capacity for which a greedy pass over that order fills no more than the given number of shards
is found by binary search; the greedy pass with that capacity gives the cuts.

The order is summed up in ranges of the hash. A first pass has some thousand ranges; then only the ranges in
which a cut can fall for any capacity still possible are divided again, until they are single groups.
So the driver holds a bounded number of sums at a time, however many groups there are, and the capacity
is still the exact optimum. A cut is a value of the hash, so a row's shard is an expression: texts are never
shuffled, and neither are rows to be told their shard.

Slots number the rows of a shard. Rows are numbered inside small cells, ranges of the hash times salts of the
id, and a cell begins where the ones before it in the shard end; so a group of a third of all rows is
numbered by many tasks.

Defined results: a NULL text has no bytes and all NULL texts are one group, apart from the empty texts.
Every row weighs its bytes plus ``extra``. Repeated rows get slots of their own. Of an empty table nothing is
returned. With fewer groups than shards some shards stay empty. A group beyond every other shard's size has a
shard of its own, and the capacity is the smallest for the rest, so the largest shard is as small as can be. Extra columns are kept by ``with_shard``.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.llm.common import free_name, written

SHARDS = 16
# Bits of the hash by which the first ranges and each further division are made.
FIRST_BITS, MORE_BITS = 12, 8
# Below so many groups in doubtful ranges these are fetched one by one.
FETCHED = 100_000
CELL_BITS, CELL_ROWS, MOST_SALTS = 6, 100_000, 4096
_LEAST = -(1 << 63)
# The start of a shard without groups.
NEVER = (_LEAST, _LEAST)


class Range(NamedTuple):
    """Consecutive groups: the hash they begin at, their bytes, how many, and the bits they share."""

    first: tuple[int, int]
    size: int
    groups: int
    largest: int
    bits: int


def size_of(text: Column, extra: int = 1) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + extra).cast("long")


def _hash(text: Column) -> tuple[Column, Column]:
    """Equal for equal texts; NULL differs from every text."""
    return F.xxhash64(text.isNull(), text), F.xxhash64(F.lit(1), text, text.isNull())


def sizes(df: DataFrame, text: str = "text", extra: int = 1) -> DataFrame:
    """(a, b, size): the groups by hash, with the sum of their sizes."""
    a, b = _hash(F.col(text))
    return df.select(a.alias("a"), b.alias("b"), size_of(F.col(text), extra).alias("size")).groupBy("a", "b").agg(
        F.sum("size").alias("size")
    )


def _ranges(groups: DataFrame, bits: int) -> list[Range]:
    start = F.shiftleft(F.shiftright("a", 64 - bits), 64 - bits)
    rows = groups.groupBy(start.alias("start")).agg(F.sum("size"), F.count("*"), F.max("size")).collect()
    return sorted(Range((r[0], _LEAST), r[1], r[2], r[3], bits) for r in rows)


def _divided(groups: DataFrame, doubtful: list[Range]) -> list[Range]:
    """The same groups in finer ranges; single groups when they are few enough."""
    found: list[Range] = []
    few = sum(r.groups for r in doubtful) <= FETCHED
    for bits in sorted({r.bits for r in doubtful}):
        starts = [r.first[0] for r in doubtful if r.bits == bits]
        inside = groups.where(F.shiftleft(F.shiftright("a", 64 - bits), 64 - bits).isin(starts))
        if few or bits + MORE_BITS >= 64:
            found += [Range((r[0], r[1]), r[2], 1, r[2], 64) for r in inside.select("a", "b", "size").collect()]
        else:
            found += _ranges(inside, bits + MORE_BITS)
    return found


def greedy(ranges: list[Range], ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """How many ranges have been taken after each shard; None if some are left.

    A single group beyond the capacity takes a shard of its own.
    """
    taken, at = [], 0
    for _ in range(shards):
        after = bisect_right(ends, (ends[at - 1] if at else 0) + capacity)
        if after == at < len(ends) and ranges[at].groups == 1:
            after = at + 1
        at = after
        taken.append(at)
    return taken if at == len(ends) else None


def smallest_capacity(ranges: list[Range], ends: list[int], shards: int, least: int) -> int:
    """The least capacity, not below ``least``, with which the greedy pass takes all ranges."""
    low, high = least, ends[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy(ranges, ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def lower_bound(ranges: list[Range], shards: int) -> int:
    """No smaller capacity will do: groups beyond it take shards of their own, the others share the rest."""
    by_largest = sorted(ranges, key=lambda r: -r.largest)
    left, bound = sum(r.size for r in ranges), None
    for alone in range(min(shards, len(by_largest)) + 1):
        if alone:
            left -= by_largest[alone - 1].size
        if alone == shards and left:
            break
        fill = -(-left // (shards - alone)) if alone < shards else 0
        fill = max(fill, by_largest[alone].largest if alone < len(by_largest) else 0)
        if not alone or fill < by_largest[alone - 1].largest:
            bound = fill
    return max(bound, 1)


def cuts(groups: DataFrame, shards: int = SHARDS) -> list[tuple[int, int]]:
    """The hash at which each shard but the first begins."""
    ranges = _ranges(groups, FIRST_BITS)
    if not ranges:
        return []
    while True:
        ends = list(accumulate(r.size for r in ranges))
        least = lower_bound(ranges, shards)
        most = smallest_capacity(ranges, ends, shards, least)
        doubtful = _doubtful(ranges, ends, shards, least, most)
        if not doubtful:
            taken = greedy(ranges, ends, most, shards)
            return [ranges[at].first if at < len(ranges) else NEVER for at in taken[:-1]]
        rest = set(doubtful)
        ranges = sorted([r for r in ranges if r not in rest] + _divided(groups, doubtful))


def _doubtful(ranges: list[Range], ends: list[int], shards: int, least: int, most: int) -> list[Range]:
    """Ranges of several groups in which a shard may end for a capacity from ``least`` to ``most``."""
    if least == most:
        return []
    found, low, high = [], 0, 0
    for _ in range(shards):
        # The earliest end never enters a range that does not fit whole; the latest fills to the byte, or
        # ends with the large group it stands in.
        at = bisect_right(ends, low + least)
        low = ends[at - 1] if at else 0
        inside = bisect_right(ends, high)
        alone = ends[inside] if inside < len(ends) and ranges[inside].largest > least else 0
        high = min(max(high + most, alone), ends[-1])
        found += [r for r in ranges[at : bisect_right(ends, high) + 1] if r.groups > 1]
    return list(dict.fromkeys(found))


def shard_of(text: Column, starts: list[tuple[int, int]]) -> Column:
    """The shard of a text, an int from 0."""
    a, b = _hash(text)
    after = [F.when((a > x) | ((a == x) & (b >= y)), 1).otherwise(0) for x, y in starts if (x, y) != NEVER]
    return sum(after, F.lit(0)).cast("int")


def with_shard(df: DataFrame, shards: int = SHARDS, text: str = "text", into: str = "shard", extra: int = 1) -> DataFrame:
    """Add the shard of each row; ready for ``write.partitionBy``."""
    groups = written(sizes(df, text, extra), "shard-groups")
    return df.withColumn(into, shard_of(F.col(text), cuts(groups, shards)))


def assign(
    df: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text", extra: int = 1
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row."""
    a, b = _hash(F.col(text))
    shard = free_name([id_column], "shard")
    narrow = with_shard(df.select(id_column, text), shards, text, shard, extra).select(
        id_column,
        size_of(F.col(text), extra).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.col(shard).alias("shard"),
        a.alias("a"),
        b.alias("b"),
    )
    narrow = written(narrow, "shard-rows")
    salts = min(MOST_SALTS, max(16, narrow.count() // (CELL_ROWS << CELL_BITS) + 1))
    cells = narrow.withColumn("cell", F.shiftright("a", 64 - CELL_BITS)).withColumn(
        "salt", F.pmod(F.xxhash64(id_column), F.lit(salts)).cast("int")
    )
    key = ["shard", "cell", "salt"]
    # One row a cell: at most 2 ** CELL_BITS times the salts, and those of a cut cell once more.
    before = W.partitionBy("shard").orderBy("cell", "salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .select(*key, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = F.row_number().over(W.partitionBy(*key).orderBy("a", "b", id_column))
    return (
        cells.withColumn("inside", inside)
        .join(offsets, key)
        .select(id_column, "size", "text_crc32", "shard", (F.col("offset") + F.col("inside") - 1).alias("slot"))
    )
