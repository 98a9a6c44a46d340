"""Sharding by minimax contiguous partition of ordered, atomic groups.

Rows with equal text are one group and never parted.  Groups stand in the order
of their text's SHA-256, which spreads them evenly.  The smallest capacity for
which a greedy fill needs no more than the given number of shards is found by
binary search, and the shards are cut where that greedy fill cuts.

The search reads a directory of the ordered groups: blocks of a common hash
prefix with their total size.  With blocks, a greedy fill is bounded from both
sides: one that may cut anywhere inside a block never needs more than the true
one, one that cuts at block borders only never less.  Blocks that the two
bounds disagree on are split by longer prefixes until none is left, so the
result is exact while the directory stays within a fixed number of entries per
round, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnero.llm.common import numbered, stored, text_bytes

OVERHEAD = 16
#: Hexadecimal digits of the first directory, and entries that one refinement may add.
FIRST_DIGITS, ENTRIES = 3, 65_536


@dataclass
class Block:
    """Groups whose key begins with ``prefix``: total size, number, and the last key."""

    prefix: str
    size: int
    groups: int
    last: str


def fill(ends: list[int], blocks: list[Block], capacity: int, shards: int, cautious: bool) -> list[int] | None:
    """Cut positions of a greedy fill, as sizes from the start; None if ``shards`` do not suffice.

    ``ends[k]`` is the size of all blocks up to k.  A cautious fill cuts at block
    borders only, the other one also inside a block of several groups.
    """
    total, at, cuts = ends[-1] if ends else 0, 0, []
    while at < total:
        if len(cuts) == shards:
            return None
        reach = at + capacity
        k = bisect_right(ends, reach)
        border = ends[k - 1] if k else 0
        if not cautious and k < len(ends) and blocks[k].groups > 1:
            border = reach
        if border <= at:
            return None
        at = min(border, total)
        cuts.append(at)
    return cuts


def smallest(ends: list[int], blocks: list[Block], low: int, shards: int, cautious: bool) -> int:
    """The smallest capacity from ``low`` for which the fill succeeds."""
    high = max(low, ends[-1])
    while low < high:
        middle = (low + high) // 2
        if fill(ends, blocks, middle, shards, cautious) is None:
            low = middle + 1
        else:
            high = middle
    return low


def directory(groups: DataFrame, digits: int, within: list[str] | None = None) -> list[Block]:
    """Blocks of a common prefix of ``digits``, in order; at most 16 ** digits, or those below ``within``."""
    rows = groups
    if within is not None:
        rows = groups.where(F.substring("key", 1, len(within[0])).isin(within))
    made = (rows.groupBy(F.substring("key", 1, digits).alias("prefix"))
            .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("key").alias("last")).collect())
    return sorted((Block(*r) for r in made), key=lambda b: b.prefix)


def cut_keys(groups: DataFrame, shards: int, first_digits: int = FIRST_DIGITS, entries: int = ENTRIES) -> list[str]:
    """The last group key of each shard, for the smallest feasible capacity.

    ``groups`` has ``key`` (hexadecimal text) and ``size``, one row per group.
    """
    blocks = directory(groups, first_digits)
    if not blocks:
        return []
    largest = groups.agg(F.max("size")).first()[0]
    while True:
        ends, at = [], 0
        for block in blocks:
            at += block.size
            ends.append(at)
        low = smallest(ends, blocks, max(largest, -(-at // shards)), shards, cautious=False)
        high = smallest(ends, blocks, low, shards, cautious=True)
        early, late = fill(ends, blocks, low, shards, True), fill(ends, blocks, high, shards, False)
        # Without a cautious fill at the low capacity its cuts may lie anywhere before the late ones.
        known = fill(ends, blocks, high, shards, True)
        if low == high and early == late:
            return [blocks[bisect_right(ends, cut) - 1].last for cut in early]
        doubtful = _between(ends, blocks, low, high, shards)
        if not doubtful:  # every cut falls on a border: the cautious fill is the greedy fill
            return [blocks[bisect_right(ends, cut) - 1].last for cut in known]
        deep: dict[int, list[str]] = {}
        for k in doubtful:
            deep.setdefault(len(blocks[k].prefix), []).append(blocks[k].prefix)
        finer = []
        for digits, prefixes in deep.items():
            more = 1
            while len(doubtful) * 16 ** (more + 1) <= entries:
                more += 1
            finer += directory(groups, digits + more, prefixes)
        gone = set(doubtful)
        blocks = sorted([b for k, b in enumerate(blocks) if k not in gone] + finer, key=lambda b: b.prefix)


def _between(ends: list[int], blocks: list[Block], low: int, high: int, shards: int) -> list[int]:
    """Blocks of several groups in which a greedy fill of a capacity from low to high may cut."""
    doubtful, early, late, total = set(), 0, 0, ends[-1]
    for _ in range(shards):
        # Earliest next cut: low capacity from the earliest place, at a border; latest: anywhere.
        k = bisect_right(ends, early + low)
        early_next = ends[k - 1] if k and ends[k - 1] > early else early
        k = bisect_right(ends, late + high)
        late_next = min(total, late + high if k < len(ends) and blocks[k].groups > 1 else (ends[k - 1] if k else 0))
        first, last = bisect_right(ends, early_next), bisect_right(ends, late_next)
        doubtful.update(k for k in range(first, min(last + 1, len(blocks)))
                        if blocks[k].groups > 1 and (ends[k - 1] if k else 0) < late_next)
        early, late = early_next, late_next
        if early >= total:
            break
    return sorted(doubtful)


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard``: every row in one of the shards.

    ``size`` is the text's UTF-8 bytes plus 16; null counts as the empty text,
    in size, checksum and group.  Equal texts share a shard; the largest shard
    is as small as contiguous shards of whole groups allow (law ``bytes``).
    Slots count the rows of a shard from 0, in the order of the key's MD5 and
    the key; rows with equal keys stand in any order.  With fewer groups than
    shards some shards stay empty.  Repeated rows are placed one by one; other
    columns are ignored; an empty table gives no rows.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), (text_bytes(content) + OVERHEAD).alias("size"),
                       F.crc32(content.cast("binary")).alias("text_crc32"), F.sha2(content, 256).alias("key"))
    rows = stored(rows, "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = cut_keys(groups, shards)
    # The number of shards whose last key lies before the row's key.
    place = sum((F.when(F.col("key") > F.lit(last), 1).otherwise(0) for last in cuts[:-1]), F.lit(0))
    spread = F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 3)
    placed = rows.select("id", "size", "text_crc32", place.cast("int").alias("shard"))
    return numbered(placed, ["shard"], [F.col("id")], spread, "slot").select(
        F.col("id").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
