"""Requests decided in order against a plain walk: chains, repeats, freed and taken slots, busy employees."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from turnero.operators import changes, sequence
from turnero.operators.sequence import decide_in_order

T0 = at("2026-01-01 00:00")
REQUEST = "id string, b string, k string, o int, s timestamp_ntz, e timestamp_ntz"


def walk(held, requests):
    """One request after another."""
    place = {b: (k, s, e) for b, k, s, e in held if s < e}
    granted = {}
    for i, b, k, _, s, e in sorted(requests, key=lambda r: r[3]):
        free = s < e and not any(c != b and k == other and x < e and y > s for c, (other, x, y) in place.items())
        granted[i] = free
        if free:
            place[b] = (k, s, e)
    return granted


def slot(rng, span):
    start = T0 + dt.timedelta(minutes=15 * rng.randrange(span))
    return start, start + dt.timedelta(minutes=rng.choice([0, 15, 30, 45, 600, 3000]))


@pytest.mark.parametrize("seed, cell, span, moves", [(0, 10, 400, True), (1, 4, 60, True), (2, 8, 300, False), (3, 4096, 300, True)])
def test_decisions_equal_a_walk(spark, monkeypatch, seed, cell, span, moves):
    """Small cells cut one employee's time, days and minutes into many; slots reach over several of them."""
    monkeypatch.setattr(sequence, "CELL", cell)
    rng = random.Random(seed)
    held = [(f"b{j}", rng.choice("xxxyz"), *slot(rng, span)) for j in range(60)] if moves else []
    of = {h[0]: h[1] for h in held}
    requests = []
    for j in range(120):
        b = rng.choice(held)[0] if moves else f"n{j}"
        requests.append((f"r{j}", b, of.get(b) or rng.choice("xxxyz"), j, *slot(rng, span)))
    frame = spark.createDataFrame(requests, REQUEST)
    first = spark.createDataFrame(held, "b string, k string, s timestamp_ntz, e timestamp_ntz") if moves else None
    got = decide_in_order(frame, "k", "s", "e", "o", "id", "b" if moves else None, first)
    want = walk(held, requests)
    assert {r.id: r.concedida for r in got.collect()} == want and 0 < sum(want.values()) < len(want)


def test_a_long_chain_of_one_employee_spreads_over_cells(spark):
    """32,000 requests, each overlapping the next: every other one is granted, in rounds over several tasks."""
    n = 32_000
    chain = spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("id"), F.lit("x").alias("k"), F.col("id").cast("int").alias("o"),
        (F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int") * 30)).alias("s"),
        (F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int") * 30 + 60)).alias("e"))
    cells = sequence._with_cells(chain.select("k", sequence._micros("s").alias("s"), sequence._micros("e").alias("e")))
    sizes = [r["count"] for r in cells.select("k", F.explode("cells").alias("c")).groupBy("k", "c").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 2 * sequence.CELL
    got = decide_in_order(chain, "k", "s", "e", "o", "id")
    odd = F.substring("id", 2, 9).cast("int") % 2 == 1
    assert got.filter(F.col("concedida") == odd).count() == 0 and got.count() == n


def test_edges(spark, make):
    empty = spark.createDataFrame([], REQUEST)
    assert decide_in_order(empty, "k", "s", "e", "o", "id").count() == 0
    rows = [("void", None, "x", 1, T0, T0), ("nobody", None, None, 2, T0, T0 + dt.timedelta(hours=1)),
            ("also_nobody", None, None, 3, T0, T0 + dt.timedelta(hours=1)), ("open", None, "x", 4, T0, None)]
    got = decide_in_order(spark.createDataFrame(rows, REQUEST), "k", "s", "e", "o", "id")
    assert {r.id: r.concedida for r in got.collect()} == {"void": False, "nobody": True, "also_nobody": True, "open": False}


def test_rescheduling_follows_the_requests(spark, make):
    """Slots swap through a free one, a left slot is taken, and a booking moves twice."""
    def booking(i, start, end, estado="CONFIRMADA"):
        return {"id_reserva": i, "id_empleado": "E", "estado": estado, "fecha_hora_inicio": at(f"2026-06-20 {start}"),
                "fecha_hora_fin": at(f"2026-06-20 {end}")}

    table = make("reserva", [booking("a", "09:00", "10:00"), booking("b", "10:00", "11:00"), booking("c", "15:00", "16:00"),
                             booking("closed", "12:00", "13:00", "COMPLETADA")])
    asked = [("q1", 1, "a", "10:00", "11:00"),      # b is there
             ("q2", 2, "b", "12:00", "13:00"),      # a finished booking holds nothing
             ("q3", 3, "a", "10:00", "11:00"),      # b has left
             ("q4", 4, "b", "09:00", "10:00"),      # so has a
             ("q5", 5, "a", "15:30", "16:30"),      # c never moves
             ("q6", 6, "closed", "20:00", "21:00"), ("q7", 7, "nobody", "20:00", "21:00"), ("q8", 8, "a", "21:00", "21:00"),
             ("q9", 9, "a", "10:30", "11:30")]      # overlaps only itself
    requests = spark.createDataFrame([(q, o, i, at(f"2026-06-20 {s}"), at(f"2026-06-20 {e}")) for q, o, i, s, e in asked],
                                     "id_solicitud string, orden int, id_reserva string, nuevo_inicio timestamp_ntz, nuevo_fin timestamp_ntz")
    snapshot, results = changes.reagendar_reserva(table, requests, "2026-06-01")
    done = {r.id_solicitud: (r.aplicado, r.fecha_hora_inicio) for r in results.collect()}
    assert {q: v[0] for q, v in done.items()} == {"q1": False, "q2": True, "q3": True, "q4": True, "q5": False, "q6": False,
                                                  "q7": False, "q8": False, "q9": True}
    assert done["q2"][1] == at("2026-06-20 12:00")
    now = {r.id_reserva: (r.fecha_hora_inicio, r.estado) for r in snapshot.collect()}
    assert now == {"a": (at("2026-06-20 10:30"), "PENDIENTE"), "b": (at("2026-06-20 09:00"), "PENDIENTE"),
                   "c": (at("2026-06-20 15:00"), "CONFIRMADA"), "closed": (at("2026-06-20 12:00"), "COMPLETADA")}


def test_a_booking_without_request_blocks_and_is_not_counted_apart(spark, make, monkeypatch):
    """Bookings that no request names stand in the same walk; a state outside the list blocks only once a request names it."""
    monkeypatch.setattr(changes, "validar_conflicto_horario", None)

    def booking(b, start, end, state="PENDIENTE", k="E1"):
        return {"id_reserva": b, "id_empleado": k, "fecha_hora_inicio": at(start), "fecha_hora_fin": at(end), "estado": state}

    reservas = make("reserva", [
        booking("R1", "2026-01-01 09:00", "2026-01-01 10:00"), booking("R2", "2026-01-01 11:00", "2026-01-01 12:00"),
        booking("R3", "2026-01-01 13:00", "2026-01-01 14:00", "CANCELADA"), booking("R4", "2026-01-01 15:00", "2026-01-01 16:00", "OTRA"),
        booking("R5", "2026-01-01 17:00", "2026-01-01 18:00", "OTRA"), booking("R6", "2026-01-01 20:00", "2026-01-01 21:00")])
    asked = spark.createDataFrame(
        [("Q1", 1, "R1", at("2026-01-01 11:30"), at("2026-01-01 12:30")), ("Q2", 2, "R1", at("2026-01-01 13:00"), at("2026-01-01 14:00")),
         ("Q3", 3, "R6", at("2026-01-01 15:30"), at("2026-01-01 16:30")), ("Q4", 4, "R6", at("2026-01-01 17:30"), at("2026-01-01 18:30")),
         ("Q5", 5, "R5", at("2026-01-01 22:00"), at("2026-01-01 23:00")), ("Q6", 6, "R6", at("2026-01-01 17:30"), at("2026-01-01 18:30"))],
        "id_solicitud string, orden int, id_reserva string, nuevo_inicio timestamp_ntz, nuevo_fin timestamp_ntz")
    _, answers = changes.reagendar_reserva(reservas, asked, "2026-01-01 00:00:00")
    assert {r.id_solicitud: r.aplicado for r in answers.collect()} == {
        "Q1": False, "Q2": True, "Q3": True, "Q4": False, "Q5": True, "Q6": True}


def test_a_calm_employee_is_decided_without_a_line_per_booking(spark):
    """One cell holds all of the employee's time, so nothing is sorted by booking, even where a booking is listed twice."""
    held = spark.createDataFrame([("b1", "x", T0, T0 + dt.timedelta(hours=1))] * 2, "b string, k string, s timestamp_ntz, e timestamp_ntz")
    asked = spark.createDataFrame([("r1", "b1", "x", 1, T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=3)),
                                   ("r2", "b2", "x", 2, T0, T0 + dt.timedelta(hours=1))], REQUEST)
    got = decide_in_order(asked, "k", "s", "e", "o", "id", "b", held)
    assert {r.id: r.concedida for r in got.collect()} == {"r1": True, "r2": True}
