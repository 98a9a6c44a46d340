"""Interval overlap at scale: counting, listing pairs, and first-come admission.

Intervals are half-open.  Bookings that touch do not overlap.

*Counting* never builds pairs and looks nothing up.  For valid intervals the
number that overlap [a, b) is (how many start before b) - (how many end by a).
Starts, ends and the requests' own two instants stand in one stream; one window
per key and day runs both counts over it.  Where a key has rows over two days,
what earlier days have counted comes in as the day's first row.  So a day of one key is sorted in one task,
however long its intervals are, and a request's two rows are added up at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.operators.sequence import granted_in_order
from turnero.session import FEW, materialize

# At one instant, ends count before the requests' instants and starts after them.
_CARRY, _END, _ASK, _START = -1, 0, 1, 2


def _side(moment: str, kind: int, closes: bool | None = None) -> Column:
    return F.struct(F.col(moment).alias("_t"), F.lit(kind).alias("_kind"), F.lit(closes).cast("boolean").alias("_closes"))


def _edges(rows: DataFrame, keys: Sequence[str], start: str, end: str, *more: str) -> DataFrame:
    """One row per interval, with its start and its end as ``_sides``."""
    return rows.select(*keys, *more, F.array(_side(start, _START), _side(end, _END)).alias("_sides"))


def _carried(rows: DataFrame, keys: list[str], period: Callable[[Column], Column], starts: Column, ends: Column) -> DataFrame:
    """A row for each key and period of ``rows``, with how many starts ``_s`` and ends ``_e`` earlier periods have."""
    earlier = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per_part = rows.select(*keys, F.inline("_sides")).groupBy(*keys, period(F.col("_t")).alias("_p")).agg(
        F.sum(starts).alias("_s"), F.sum(ends).alias("_e"))
    return per_part.select(
        *keys, "_p", F.array(F.struct(F.lit(None).cast(rows.schema["_sides"].dataType.elementType["_t"].dataType).alias("_t"),
                                      F.lit(_CARRY).alias("_kind"), F.lit(None).cast("boolean").alias("_closes"))).alias("_sides"),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_s", "_e")))


def _swept(rows: DataFrame, keys: Sequence[str], period: Callable[[Column], Column] | None) -> DataFrame:
    """The ``_sides`` (_t, _kind, _closes) of ``rows``, one row each, plus how many starts and ends stand before and at each.

    ``period`` cuts time into parts that do not decrease; None when the keys already bound it.
    A row moves once where both sides fall into one period, and is cut in two after that.  Earlier periods are counted
    for the keys that have a row over two of them: elsewhere what starts in a period also ends there.
    """
    group = list(keys)
    starts, ends = (F.when(F.col("_kind") == kind, 1).otherwise(0).cast("long") for kind in (_START, _END))
    nothing = {"_s": F.lit(None).cast("long"), "_e": F.lit(None).cast("long")}
    if period is None:
        rows = rows.withColumns(nothing)
    else:
        group.append("_p")
        opens, closes = (period(F.col("_sides")[x]["_t"]) for x in (0, 1))
        over = rows.filter(~opens.eqNullSafe(closes)).select(*keys)
        crossing = over.count()
        carried = _carried(rows.join(F.broadcast(over), keys, "left_semi") if crossing <= FEW else rows, keys, period, starts, ends)
        parts = F.when(opens.eqNullSafe(closes), F.array(F.struct(opens.alias("_p"), F.col("_sides").alias("_sides")))).otherwise(
            F.array(*(F.struct(p.alias("_p"), F.array(F.col("_sides")[x]).alias("_sides")) for x, p in enumerate((opens, closes)))))
        rows = rows.select(*(c for c in rows.columns if c != "_sides"), F.inline(parts))
        rows = rows.unionByName(carried, allowMissingColumns=True) if crossing else rows.withColumns(nothing)
    points = rows.repartition(*group).select(*(c for c in rows.columns if c != "_sides"), F.inline("_sides")).withColumns(
        {"_s": F.coalesce("_s", starts), "_e": F.coalesce("_e", ends)})
    # Sorting compares a number first, which tells most groups apart at once; text keys share their beginnings.
    line = Window.partitionBy("_h", *group).orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return points.withColumn("_h", F.xxhash64(*group)).withColumns(
        {"_started": F.sum("_s").over(line), "_ended": F.sum("_e").over(line)})


def count_overlaps(intervals: DataFrame, requests: DataFrame, keys: Sequence[str], start: str, end: str, id_column: str,
                   period: Callable[[Column], Column] | None = None, interval_id: str | None = None,
                   leave_out: str | None = None, flag: str | None = None) -> DataFrame:
    """``id_column, solapes``: how many intervals overlap each request; NULL for an empty one.

    Both frames have ``keys``, ``start`` and ``end``; ``id_column`` tells the
    requests apart.  Intervals must be non-empty, as the tables' checks demand;
    those with a NULL key overlap nothing.  ``leave_out`` names a column with the
    ``interval_id`` of an interval not to count; requests that leave out the same
    one are sorted in one task.  ``flag`` names a boolean of the requests to return too.
    """
    keys = list(keys)
    present = intervals.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    asked = [F.col(id_column).alias("_id"), *([] if flag is None else [F.col(flag).alias("_flag")])]
    if leave_out is not None:
        # A request that leaves nothing out gets a key of its own, so such requests spread over tasks.
        own = F.coalesce(F.col(leave_out).cast("string"), F.concat(F.lit("~"), F.col(id_column).cast("string")))
        asked += [own.alias("_own"), F.struct(*keys, start, end).alias("_row")]
    sides = F.array(_side(start, _ASK, False), _side(end, _ASK, True)).alias("_sides")
    probes = requests.select(*keys, *asked, (F.col(start) < F.col(end)).alias("_real"), sides)
    counted = _swept(_edges(present, keys, start, end).unionByName(probes, allowMissingColumns=True), keys, period)
    counted = counted.filter("_id IS NOT NULL").withColumn(
        "_part", F.when(F.col("_real"), F.when(F.col("_closes"), F.col("_started")).otherwise(-F.col("_ended"))))
    group, more = ["_id"], [] if flag is None else ["_flag"]
    if leave_out is not None:
        left_out = present.select(F.col(interval_id).cast("string").alias("_own"), F.struct(*keys, start, end).alias("_out"))
        line = Window.partitionBy("_h", "_own").orderBy(F.col("_out").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = (counted.select("_id", "_own", "_row", "_closes", "_part", *more).unionByName(left_out, allowMissingColumns=True)
                   .withColumn("_h", F.xxhash64("_own")).withColumn("_out", F.max("_out").over(line)).filter("_id IS NOT NULL"))
        same = (F.col(f"_out.{start}") < F.col(f"_row.{end}")) & (F.col(f"_out.{end}") > F.col(f"_row.{start}"))
        for k in keys:
            same = same & (F.col(f"_out.{k}") == F.col(f"_row.{k}"))
        counted = counted.withColumn("_part", F.col("_part") - F.when(F.col("_closes") & same, 1).otherwise(0))
        group = ["_h", "_own", "_id"]
    return counted.groupBy(*group).agg(F.sum("_part").alias("solapes"), *(F.max(c).alias(flag) for c in more)).select(
        F.col("_id").alias(id_column), "solapes", *([] if flag is None else [flag]))


def count_mutual_overlaps(intervals: DataFrame, keys: Sequence[str], start: str, end: str, id_column: str,
                          period: Callable[[Column], Column] | None = None) -> DataFrame:
    """``id_column, solapes``: how many of the other intervals overlap each; an interval's edges are its own request."""
    keys = list(keys)
    present = intervals.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    swept = _swept(_edges(present, keys, start, end, id_column), keys, period).filter(F.col("_kind") != _CARRY)
    part = F.when(F.col("_kind") == _END, F.col("_started")).otherwise(-F.col("_ended"))
    return swept.select(id_column, part.alias("_part")).groupBy(id_column).agg((F.sum("_part") - 1).alias("solapes"))


def overlapping_pairs(intervals: DataFrame, key: str, id_column: str, start: str, end: str,
                      slot_seconds: int = 3600) -> DataFrame:
    """Every overlapping pair of one key: (key, id_a, id_b), id_a < id_b, each once.

    The later start of an overlapping pair lies inside the earlier interval, so
    the join is an equality on (key, slot of that start): earlier intervals are
    listed in every slot they touch, later ones only in their own.  Each pair
    meets in exactly one slot, and with slots near the usual length of an
    interval most candidates are results.
    """

    def slot(moment: Column) -> Column:
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.floor(F.timestamp_diff("SECOND", epoch, moment) / slot_seconds)

    base = intervals.filter(F.col(start) < F.col(end)).select(
        F.col(key), F.col(id_column).alias("i"), F.col(start).alias("s"), F.col(end).alias("e"))
    earlier = base.select(
        F.col(key), F.col("i").alias("i1"), F.col("s").alias("s1"), F.col("e").alias("e1"),
        F.explode(F.sequence(slot(F.col("s")), slot(F.col("e")))).alias("_slot"))
    later = base.select(F.col(key), F.col("i").alias("i2"), F.col("s").alias("s2"), slot(F.col("s")).alias("_slot"))
    in_order = (F.col("s1") < F.col("s2")) | ((F.col("s1") == F.col("s2")) & (F.col("i1") < F.col("i2")))
    return (earlier.join(later, [key, "_slot"]).filter(in_order & (F.col("e1") > F.col("s2")))
            .select(key, F.least("i1", "i2").alias("id_a"), F.greatest("i1", "i2").alias("id_b")))


def admit_in_order(requests: DataFrame, key: str, start: str, end: str, order: str, id_column: str) -> DataFrame:
    """Ids admitted when requests are taken in ``order`` and none may overlap an admitted one.

    Two exact reductions come first, so that the rest is bounded by the distinct
    instants and not by the number of requests: equal intervals of a key collapse
    to the earliest request, and a request that contains one taken earlier with
    the same start can never be admitted (either that one, or whatever blocked
    it, overlaps).  ``order`` must be unique per key; one-column frame ``id_column``.
    """
    first = (requests.filter(F.col(start) < F.col(end)).groupBy(key, start, end)
             .agg(F.min(F.struct(order, id_column)).alias("_r"))
             .withColumns({"_o": F.col(f"_r.{order}"), "_id": F.col(f"_r.{id_column}")}).drop("_r"))
    same_start = Window.partitionBy(key, start).orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    useful = (first.withColumn("_shortest", F.min(end).over(same_start))
              .filter(F.col("_shortest").isNull() | (F.col(end) < F.col("_shortest"))).drop("_shortest"))
    return granted_in_order(materialize(useful, "en-orden"), key, start, end, "_o", "_id").select(F.col("_id").alias(id_column))
