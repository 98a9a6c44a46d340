"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks.  With weight w (a share of 1), block j of
a source is released at slot floor(j / w) and due at slot ceil((j + 1) / w).
Each slot takes, of the released blocks, the one that is due first; the
deviation from every target stays below one block at every slot.

Weights are whole parts of a fixed total, so the schedule repeats after one
period of as many slots.  One period is worked out per set of sources that
still have blocks; everything else is arithmetic on columns: a document's
number in its source gives its block, and the block its slot.  A source that
has run out leaves, and the others go on with their weights scaled up.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnero.llm.common import numbered, stored

#: Documents of a block; parts that all weights add up to; sources that are told apart (the rest is one source).
BLOCK, PARTS, SOURCES = 64, 1000, 256
NO_SOURCE, REST = "(none)", "(rest)"


@dataclass
class Phase:
    """A stretch with the same sources: where it begins and, per source, its blocks and their slots in a period."""

    start: int
    period: int
    first: dict[str, int]
    last: dict[str, int]
    slots: dict[str, list[int]]


def windows(weight: int, period: int) -> list[tuple[int, int]]:
    """(release, due) of the blocks of one period for a share of weight / period."""
    return [(j * period // weight, -(-(j + 1) * period // weight)) for j in range(weight)]


def one_period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period, earliest due first among the released."""
    period = sum(weights.values())
    waiting = sorted((r, d, s) for s, w in weights.items() for r, d in windows(w, period))
    slots: dict[str, list[int]] = {s: [] for s in weights}
    ready: list[tuple[int, int, str]] = []
    at = 0
    for slot in range(period):
        while at < len(waiting) and waiting[at][0] <= slot:
            release, due, source = waiting[at]
            heapq.heappush(ready, (due, release, source))
            at += 1
        _, _, source = heapq.heappop(ready)
        slots[source].append(slot)
    return slots


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[Phase]:
    """The schedule until every source has run out; at most one phase per source."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    start, made = 0, []
    while left:
        live = {s: weights[s] for s in left}
        period, slots = sum(live.values()), one_period(live)

        def slot_of(source: str, block: int) -> int:
            return block // live[source] * period + slots[source][block % live[source]]

        length = min(slot_of(s, n - 1) for s, n in left.items()) + 1
        took = {s: length // period * w + sum(x < length % period for x in slots[s]) for s, w in live.items()}
        made.append(Phase(start, period, {s: done[s] for s in live}, {s: done[s] + took[s] for s in live}, slots))
        start += length
        for source, n in took.items():
            done[source] += n
            left[source] -= n
            if left[source] == 0:
                del left[source]
    return made


def parts_of(shares: dict[str, float], parts: int = PARTS) -> dict[str, int]:
    """Whole parts that add up to ``parts`` (or one per source, if there are more): largest remainders, at least one each."""
    total = sum(shares.values())
    exact = {s: parts * x / total for s, x in shares.items()}
    whole = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (whole[s] - exact[s], s))
    spare = parts - sum(whole.values())
    for source in by_rest[:max(0, spare)]:
        whole[source] += 1
    while spare < 0 and max(whole.values()) > 1:
        source = max(whole, key=lambda s: (whole[s] - exact[s] if whole[s] > 1 else -1e18, s))
        whole[source] -= 1
        spare += 1
    return whole


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, parts: int = PARTS,
        key: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` with ``mix_source, mix_block, mix_release, mix_due, mix_slot, mix_place``.

    ``weights`` are target shares by source; without them every source weighs
    the square root of its number of documents.  Sources beyond the largest
    ``SOURCES``, and those without a weight, form one source with the smallest
    weight; a null source is a source of its own.  ``mix_slot`` is the block's
    place in the mixture, ``mix_place`` the document's in its block; release and
    due are the block's window, counted from the start of its phase.  Every row
    gets one place, repeated rows and rows with null keys too; an empty table
    gives no rows.  Documents of a source are taken in the order of a hash of
    their key.
    """
    named = F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE))
    sizes = docs.groupBy(named.alias("s")).count().orderBy(F.col("count").desc(), "s").limit(SOURCES).collect()  # at most SOURCES rows
    counts = {r["s"]: r["count"] for r in sizes if weights is None or r["s"] in weights}
    rest = docs.count() - sum(counts.values()) if sizes else 0
    shares = {s: (weights[s] if weights is not None else n ** 0.5) for s, n in counts.items()}
    if rest:
        counts[REST], shares[REST] = rest, min(shares.values(), default=1.0)
    if not counts:
        return docs.limit(0).selectExpr("*", "'' mix_source", "0L mix_block", "0L mix_release", "0L mix_due", "0L mix_slot", "0 mix_place")
    whole = parts_of(shares, max(parts, len(shares)))
    made = phases(whole, {s: -(-n // block) for s, n in counts.items()})
    rows = [(s, [(p.first[s], p.last[s], p.start, p.period, whole[s], p.slots[s]) for p in made if s in p.first]) for s in counts]
    schema = "mix_source string, phases array<struct<first: bigint, last: bigint, start: bigint, period: bigint, weight: bigint, slots: array<int>>>"
    plan = docs.sparkSession.createDataFrame(rows, schema)

    kept = list(counts)
    tagged = docs.withColumn("mix_source", F.when(named.isin(kept), named).otherwise(F.lit(REST)))
    spread = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 3)
    placed = (numbered(tagged, ["mix_source"], [F.col(key)], spread, "mix_number")
              .withColumn("mix_block", F.floor(F.col("mix_number") / block).cast("bigint"))
              .join(F.broadcast(plan), "mix_source"))  # at most SOURCES + 1 rows, PARTS slots a phase
    phase = F.filter("phases", lambda p: (p["first"] <= F.col("mix_block")) & (F.col("mix_block") < p["last"]))[0]
    placed = placed.withColumn("_p", phase).withColumn("_j", F.col("mix_block") - F.col("_p.first"))
    cycle = F.floor(F.col("_j") / F.col("_p.weight")).cast("bigint")
    slot = F.col("_p.start") + cycle * F.col("_p.period") + F.get(F.col("_p.slots"), (F.col("_j") % F.col("_p.weight")).cast("int"))
    return (placed
            .withColumn("mix_release", F.expr("_j * _p.period div _p.weight"))
            .withColumn("mix_due", F.expr("((_j + 1) * _p.period + _p.weight - 1) div _p.weight"))
            .withColumn("mix_slot", slot.cast("bigint"))
            .withColumn("mix_place", (F.col("mix_number") % block).cast("int"))
            .select(*docs.columns, "mix_source", "mix_block", "mix_release", "mix_due", "mix_slot", "mix_place"))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """The mixture without the texts: ``doc_id, source`` and the ``mix_`` columns."""
    return mix(docs.select("doc_id", "source"), weights, block)


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """All documents with their own columns, sorted into the mixture's order.

    Only ids take part in the numbering; the texts are joined to their places
    and sorted once.  Rows that share an id share the places of that id's rows.
    """
    columns = docs.columns
    own = F.xxhash64(*columns)
    keyed = docs.select("doc_id", "source", own.alias("_own"))
    places = stored(mix(keyed, weights, block).select(
        F.col("doc_id").alias("_d"), F.col("_own").alias("_o"), "mix_slot", "mix_place"), "mix-places")
    first = places.groupBy("_d", "_o").agg(F.min(F.struct("mix_slot", "mix_place")).alias("_at"))
    joined = docs.withColumn("_own", own).join(first, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_own") == F.col("_o")), "left")
    return joined.orderBy("_at.mix_slot", "_at.mix_place", "doc_id").select(*columns)
