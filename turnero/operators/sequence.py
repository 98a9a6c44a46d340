"""Requests for time slots, decided one after another and still in parallel.

A request asks for a slot [start, end) of an employee.  It is granted if, once
all earlier requests are decided, no other booking of the employee overlaps the
slot.  A granted request puts its booking there, and takes it away from where it
was, so later requests can find the old slot free.

An employee's time is cut into cells that hold some thousand slots each, however
busy the employee is.  Every round walks each cell's requests in order, in one
task per cell.  A request whose slot lies in one cell is decided there and then,
if nothing undecided comes before it.  One that reaches over several cells is
granted when all of them are clear and refused when one is not; what it does to
the rest of its cells is open until the next round.  The first undecided request
of an employee is always decided, so the rounds end; a chain of requests takes as
many rounds as it crosses cells, not as many as it has requests.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.session import materialize

#: Slots of a cell, about.
CELL = 4096
#: Employees that a batch names, up to which their bookings are looked up by broadcast.
FEW = 200_000
_DAY, _MINUTE = 86_400_000_000, 60_000_000
_CLEAR, _BLOCKED, _OPEN = 1, 2, 0


def _micros(moment: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(moment))


def _whole(value: Column) -> Column:
    return F.floor(value).cast("long")


def _with_cells(rows: DataFrame) -> DataFrame:
    """``rows`` (k, s, e, ...) plus ``cells``, the cells of its employee that each slot touches, and ``one``, is that all of its time?

    An employee with few slots is one cell.  Of the others days are counted;
    days in a row share a cell while they hold few slots, and a day that holds
    too many is cut into equal minutes.  ``rows`` is read several times.
    """
    none = F.lit(-1).cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("block"), none.alias("day"), none.alias("part")))
    busy = rows.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > CELL).select("k")  # one in CELL rows at most
    if busy.isEmpty():
        return rows.withColumns({"cells": whole, "one": F.lit(True)})
    calm = rows.join(busy, "k", "left_anti").withColumns({"cells": whole, "one": F.lit(True)})
    hot = rows.join(busy, "k", "left_semi")
    per_day = hot.select("*", F.explode(F.sequence(_whole(F.col("s") / _DAY), _whole((F.col("e") - 1) / _DAY))).alias("d"))
    before = F.sum("n").over(Window.partitionBy("k").orderBy("d").rowsBetween(Window.unboundedPreceding, -1))
    grid = per_day.groupBy("k", "d").agg(F.count("*").alias("n")).select(
        "k", "d", _whole(F.coalesce(before, F.lit(0)) / CELL).alias("block"),
        F.when(F.col("n") > CELL, F.greatest(F.lit(1), _whole(1440 * CELL / F.col("n")))).alias("width"))
    placed = per_day.join(grid, ["k", "d"])
    opens, closes = F.greatest("s", F.col("d") * _DAY), F.least("e", (F.col("d") + 1) * _DAY)
    first, last = (_whole((x - F.col("d") * _DAY) / _MINUTE / F.col("width")) for x in (opens, closes - 1))
    cells = F.when(F.col("width").isNull(), F.array(F.struct("block", none.alias("day"), none.alias("part")))).otherwise(
        F.transform(F.sequence(first, last), lambda x: F.struct("block", F.col("d").alias("day"), x.alias("part"))))
    cut = placed.groupBy(*rows.columns).agg(F.array_distinct(F.flatten(F.collect_list(cells))).alias("cells")).withColumn("one", F.lit(False))
    return materialize(calm.unionByName(cut), "por-celda")


class _Booking:
    """What a cell knows of a booking: where it may be, and whether that is sure."""

    __slots__ = ("places", "sure", "next")

    def __init__(self) -> None:
        self.places: list[tuple[int, int]] = []
        self.sure, self.next = True, None

    def until(self, order, line: "_Timeline") -> None:
        """Take in what requests outside the cell did before ``order``."""
        if self.next is not None and self.next[0] < order:
            if self.next[1]:
                line.clear(self)
            elif self.places:
                self.sure = False
            self.next = None


class _Timeline:
    """The bookings of one cell."""

    def __init__(self) -> None:
        self.starts: list[tuple[int, int]] = []
        self.slots: dict[int, tuple[object, int]] = {}
        self.bookings: dict[object, _Booking] = {}
        self.longest, self.serial = 0, 0

    def put(self, name: object, booking: _Booking, start: int, end: int) -> None:
        self.serial += 1
        bisect.insort(self.starts, (start, self.serial))
        self.slots[self.serial] = (name, end)
        self.longest = max(self.longest, end - start)
        booking.places.append((start, self.serial))

    def clear(self, booking: _Booking) -> None:
        for place in booking.places:
            del self.starts[bisect.bisect_left(self.starts, place)]
            del self.slots[place[1]]
        booking.places, booking.sure = [], True

    def verdict(self, name: object, order, start: int, end: int) -> int:
        a = bisect.bisect_left(self.starts, (start - self.longest, 0))
        b = bisect.bisect_left(self.starts, (end, 0))
        found = _CLEAR
        for _, serial in self.starts[a:b]:
            if serial not in self.slots:
                continue
            other, until = self.slots[serial]
            if until > start and other != name:
                booking = self.bookings[other]
                booking.until(order, self)
                if serial in self.slots:
                    if booking.sure:
                        return _BLOCKED
                    found = _OPEN
        return found

    def request(self, name, order, start: int, end: int, known: bool | None, cells: int, after) -> int | None:
        """Decide a request as far as this cell can; its verdict, or None if it was decided before."""
        booking = self.bookings.setdefault(name, _Booking())
        booking.until(order, self)
        verdict = None if known is not None else self.verdict(name, order, start, end)
        if known or (verdict == _CLEAR and cells == 1):
            self.clear(booking)
            self.put(name, booking, start, end)
        elif known is None and verdict != _BLOCKED:
            self.put(name, booking, start, end)
            booking.sure = False
        booking.next = after
        return verdict


def _values(column: pa.Array) -> Iterable:
    """The values of a column for a loop; numbers come over as a whole."""
    if column.null_count == len(column):
        return repeat(None, len(column))
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy().tolist()
    return column.to_pylist()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts of the undecided requests; the rows come cell by cell, bookings' first slots before requests in order."""
    cell, line = None, _Timeline()
    for batch in batches:
        ids, touched, verdicts = [], [], []
        for k, block, day, part, b, o, i, s, e, known, n, after, granted in zip(*map(_values, batch.columns)):
            here = (k, block, day, part)
            if here != cell:
                cell, line = here, _Timeline()
            later = None if after is None else (after, granted)
            if i is None:
                booking = line.bookings.setdefault(b, _Booking())
                line.put(b, booking, s, e)
                booking.next = later
            else:
                verdict = line.request(b, o, s, e, known, n, later)
                if verdict is not None:
                    ids.append(i)
                    touched.append(n)
                    verdicts.append(verdict)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(touched, pa.int32()), pa.array(verdicts, pa.int32())],
                                             ["i", "cells", "verdict"])


def decide_in_order(requests: DataFrame, key: str, start: str, end: str, order: str, id_column: str,
                    booking: str | None = None, held: DataFrame | None = None) -> DataFrame:
    """``id_column, concedida``: for every request whether ``granted_in_order`` grants it."""
    granted = granted_in_order(requests, key, start, end, order, id_column, booking, held)
    return (requests.select(id_column).join(granted.withColumn("granted", F.lit(True)), id_column, "left")
            .select(id_column, F.coalesce("granted", F.lit(False)).alias("concedida")))


def granted_in_order(requests: DataFrame, key: str, start: str, end: str, order: str, id_column: str,
                     booking: str | None = None, held: DataFrame | None = None) -> DataFrame:
    """``id_column`` of the requests that are granted.

    ``requests`` are taken by ``order``, unique per ``key``.  ``held`` gives the
    slots (``booking``, ``key``, ``start``, ``end``) that bookings have at
    first; requests name the ``booking`` that they move.  Without ``booking``
    each request is for a booking of its own.  An empty slot is refused; a
    request without key meets nobody and is granted.  Both are read several
    times and should be stored.
    """
    name = id_column if booking is None else booking

    def plain(rows: DataFrame, o: Column, i: Column) -> DataFrame:
        return rows.filter(F.col(start) < F.col(end)).select(
            F.col(key).alias("k"), F.col(name).alias("b"), o.alias("o"), i.alias("i"), _micros(start).alias("s"), _micros(end).alias("e"))

    asked = plain(requests, F.col(order), F.col(id_column))
    kinds = {f.name: f.dataType for f in asked.schema.fields}
    rows = asked.filter("k IS NOT NULL")
    if held is not None:
        first = plain(held.filter(F.col(key).isNotNull()), F.lit(None).cast(kinds["o"]), F.lit(None).cast(kinds["i"]))
        named = rows.select("k").distinct()
        if named.count() <= FEW:  # employees that no request names are left out early
            first = first.join(F.broadcast(named), "k", "left_semi")
        rows = rows.unionByName(first)
    rows = _with_cells(rows)
    left = asked.filter("k IS NOT NULL").count()
    decided: DataFrame | None = None
    verdict_type = f"i {kinds['i'].simpleString()}, cells int, verdict int"
    nothing = F.lit(None).cast("boolean")
    while left:
        if decided is None:
            now = rows.withColumn("granted", nothing)
        else:
            now = rows.filter("i IS NOT NULL").join(decided, "i", "left").unionByName(rows.filter("i IS NULL").withColumn("granted", nothing))
        plainly = now.withColumns({"after": F.lit(None).cast(kinds["o"]), "stays": nothing})
        if held is not None:
            # The next request for the same booking that is not refused moves it away, or may do so.  A cell that is
            # all of an employee's time sees that request itself.
            following = Window.partitionBy("b").orderBy(F.col("o").asc_nulls_first()).rowsBetween(1, Window.unboundedFollowing)
            pending = F.when(F.col("i").isNotNull() & F.coalesce("granted", F.lit(True)),
                             F.struct("o", F.coalesce("granted", F.lit(False)).alias("granted")))
            shared = now.filter("NOT one").withColumn("next", F.first(pending, ignorenulls=True).over(following))
            plainly = plainly.filter("one").unionByName(shared.withColumns({"after": F.col("next.o"), "stays": F.col("next.granted")}).drop("next"))
        at = plainly.select("k", F.explode("cells").alias("cell"), "b", "o", "i", "s", "e", "granted", F.size("cells").alias("n"), "after", "stays")
        if decided is not None:
            busy = now.filter("i IS NOT NULL AND granted IS NULL").select("k", F.explode("cells").alias("cell")).distinct()
            at = at.join(busy, ["k", "cell"], "left_semi")
        walked = (at.select("k", "cell.*", "b", "o", "i", "s", "e", "granted", "n", "after", "stays").repartition("k", "block", "day", "part")
                  .sortWithinPartitions("k", "block", "day", "part", F.col("o").asc_nulls_first()).mapInArrow(_walk, verdict_type))
        told = walked.groupBy("i").agg(F.max(F.col("verdict") == _BLOCKED).alias("blocked"),
                                       (F.count_if(F.col("verdict") == _CLEAR) == F.max("cells")).alias("clear"))
        fresh = materialize(told.filter("blocked OR clear").select("i", (~F.col("blocked")).alias("granted")), "decididas")
        made = fresh.count()
        if not made:
            raise RuntimeError(f"{left} requests cannot be put in order; is {order} unique per {key}?")
        decided = fresh if decided is None else decided.unionByName(fresh)
        left -= made
    free = requests.filter(F.col(key).isNull() & (F.col(start) < F.col(end))).select(id_column)
    if decided is None:
        return free
    return decided.filter("granted").select(F.col("i").alias(id_column)).unionByName(free)
