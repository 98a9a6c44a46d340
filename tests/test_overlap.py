"""Overlap counting, pairs and admission against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from turnero.operators import joins
from turnero.operators import overlap as sweep
from turnero.operators.overlap import admit_in_order, count_overlaps, overlapping_pairs

SLOT = "k string, id string, orden int, s timestamp_ntz, e timestamp_ntz"


def intervals(seed: int, n: int, hot: float = 0.4) -> list[tuple]:
    """Random intervals over three months; one key holds a large share, some repeat exactly."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(4)}"
        start = at("2026-01-30 20:00:00") + dt.timedelta(minutes=15 * rng.randrange(400) * (1 + i % 3))
        rows.append((key, f"i{i:04d}", i, start, start + dt.timedelta(minutes=rng.choice([15, 45, 120, 3000]))))
    rows += [(k, f"{i}bis", o + n, s, e) for k, i, o, s, e in rows[::9]]
    rng.shuffle(rows)
    return rows


def overlap(a: tuple, b: tuple) -> bool:
    return a[0] == b[0] and a[3] < b[4] and a[4] > b[3]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_and_pairs_match_brute_force(spark, seed):
    base, asked = intervals(seed, 120), intervals(seed + 100, 80)
    frame = spark.createDataFrame(base, SLOT)
    counted = count_overlaps(frame, spark.createDataFrame(asked, SLOT), ["k"], "s", "e", "id", F.to_date)
    assert {r.id: r.solapes for r in counted.collect()} == {q[1]: sum(overlap(q, b) for b in base) for q in asked}
    pairs = overlapping_pairs(frame, "k", "id", "s", "e").collect()
    expected = {tuple(sorted((a[1], b[1]))) for a in base for b in base if a[1] < b[1] and overlap(a, b)}
    assert len(pairs) == len(expected)
    assert {(r.id_a, r.id_b) for r in pairs} == expected


@pytest.mark.parametrize("seed", [3, 4])
def test_admission_is_first_come_first_served(spark, seed):
    rows = intervals(seed, 150, hot=0.6)
    taken: list[tuple] = []
    for row in sorted(rows, key=lambda r: r[2]):
        if not any(overlap(row, t) for t in taken):
            taken.append(row)
    admitted = admit_in_order(spark.createDataFrame(rows, SLOT), "k", "s", "e", "orden", "id")
    assert sorted(r.id for r in admitted.collect()) == sorted(t[1] for t in taken)


def booking(i, start, end, emp="E", estado="PENDIENTE"):
    return {"id_reserva": i, "id_empleado": emp, "fecha_hora_inicio": at(start), "fecha_hora_fin": at(end),
            "estado": estado}


def test_conflict_edges(spark, make):
    booked = make("reserva", [
        booking("a", "2026-06-15 10:00", "2026-06-15 12:00"),
        booking("b", "2026-06-15 14:00", "2026-06-15 15:00", estado="CANCELADA"),
        booking("c", "2026-06-30 23:30", "2026-07-01 00:30"),
    ])
    cases = [  # id, start, end, excluded, conflict
        ("touches", "2026-06-15 12:00", "2026-06-15 13:00", None, False),
        ("contained", "2026-06-15 10:30", "2026-06-15 11:00", None, True),
        ("cancelled", "2026-06-15 14:10", "2026-06-15 14:20", None, False),
        ("itself", "2026-06-15 10:30", "2026-06-15 12:30", "a", False),
        ("excludes_other", "2026-06-15 10:30", "2026-06-15 12:30", "c", True),
        ("next_month", "2026-07-01 00:00", "2026-07-01 00:10", None, True),
        ("before_any", "2020-01-01 00:00", "2020-01-02 00:00", None, False),
        ("empty", "2026-06-15 11:00", "2026-06-15 11:00", None, None),
    ]
    asked = spark.createDataFrame(
        [(i, "E", at(s), at(e), x) for i, s, e, x, _ in cases],
        "id_solicitud string, id_empleado string, fecha_hora_inicio timestamp_ntz, fecha_hora_fin timestamp_ntz, "
        "id_excluir string")
    got = {r.id_solicitud: r.conflicto for r in joins.validar_conflicto_horario(booked, asked).collect()}
    assert got == {i: want for i, _, _, _, want in cases}


def test_availability_edges(spark, make):
    week = make("horario_laboral", [
        {"id_empleado": "E", "dia_semana": "LUNES", "hora_inicio": 480, "hora_fin": 720},
        {"id_empleado": "E", "dia_semana": "LUNES", "hora_inicio": 720, "hora_fin": 1080},
        {"id_empleado": "E", "dia_semana": "MARTES", "hora_inicio": 0, "hora_fin": 1440, "activo": False},
        {"id_empleado": "E", "dia_semana": "DOMINGO", "hora_inicio": 0, "hora_fin": 1440},
    ])
    blocks = make("bloqueo_horario", [
        {"id_empleado": "E", "fecha": dt.date(2026, 6, 15), "hora_inicio": 540, "hora_fin": 600},
        {"id_empleado": "E", "fecha": dt.date(2026, 6, 15), "hora_inicio": 900, "hora_fin": 960, "activo": False},
        {"id_empleado": "E", "fecha": dt.date(2026, 6, 14), "hora_inicio": 0, "hora_fin": 1439},
    ])
    monday, sunday, tuesday = dt.date(2026, 6, 15), dt.date(2026, 6, 14), dt.date(2026, 6, 16)
    cases = [
        ("inside", monday, 600, 660, True), ("blocked", monday, 570, 610, False), ("split_day", monday, 660, 780, False),
        ("released_block", monday, 900, 930, True), ("inactive_week", tuesday, 600, 660, False),
        ("last_minute", sunday, 1439, 1440, True), ("vacation", sunday, 1000, 1060, False),
        ("empty", monday, 600, 600, None),
    ]
    asked = spark.createDataFrame([(i, "E", d, a, b) for i, d, a, b, _ in cases],
                                  "id_solicitud string, id_empleado string, fecha date, hora_inicio int, hora_fin int")
    got = {r.id_solicitud: r.disponible for r in joins.empleado_disponible(week, blocks, asked).collect()}
    assert got == {i: want for i, _, _, _, want in cases}


def test_requests_with_seconds_round_outwards(spark):
    asked = spark.createDataFrame(
        [("a", "E", at("2026-06-15 10:00:30"), at("2026-06-15 10:59:30")),
         ("b", "E", at("2026-06-15 23:00:00"), at("2026-06-16 00:30:00"))],
        "id_solicitud string, id_empleado string, fecha_hora_inicio timestamp_ntz, fecha_hora_fin timestamp_ntz")
    rows = {r.id_solicitud: (r.hora_inicio, r.hora_fin) for r in joins.with_day_columns(asked).collect()}
    assert rows["a"] == (600, 660)
    assert rows["b"][1] < rows["b"][0]


def test_overlap_report_is_linear_in_a_hot_group(spark, make):
    """A thousand bookings of one slot are reported without building their half million pairs."""
    same = [booking(f"r{i:04d}", "2026-06-15 10:00", "2026-06-15 11:00") for i in range(1000)]
    hits = joins.reservas_en_conflicto(make("reserva", same))
    assert hits.agg(F.count("*"), F.min("conflictos"), F.max("conflictos")).first() == (1000, 999, 999)


def test_a_same_day_interval_moves_once(spark):
    """Rows are cut into their sides after the shuffle; intervals over midnight are still counted on both days."""
    frame = "i string, k string, s timestamp_ntz, e timestamp_ntz"
    held = spark.createDataFrame([("a", "x", at("2026-01-01 09:00"), at("2026-01-01 10:00")), ("b", "x", at("2026-01-01 23:00"), at("2026-01-03 01:00")),
                                  ("c", None, at("2026-01-01 09:00"), at("2026-01-01 10:00"))], frame)
    asked = spark.createDataFrame([("q1", "x", at("2026-01-01 09:30"), at("2026-01-01 23:30")), ("q2", "x", at("2026-01-02 12:00"), at("2026-01-02 13:00")),
                                   ("q3", "x", at("2026-01-03 01:00"), at("2026-01-03 02:00")), ("q4", None, at("2026-01-01 09:00"), at("2026-01-01 10:00")),
                                   ("q5", "x", at("2026-01-01 10:00"), at("2026-01-01 09:00"))], frame)
    counted = count_overlaps(held, asked, ["k"], "s", "e", "i", F.to_date)
    assert {r.i: r.solapes for r in counted.collect()} == {"q1": 2, "q2": 1, "q3": 0, "q4": 0, "q5": None}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Generate inline") < plan.index("RepartitionByExpression")


def test_earlier_days_are_counted_only_for_keys_with_rows_over_midnight(spark, capsys, monkeypatch):
    """Without such rows nothing is carried and two exchanges do; with few or many of them the counts are those of a plain check."""
    rng, start = random.Random(5), dt.datetime(2026, 1, 1)
    schema = "id string, k string, s timestamp_ntz, e timestamp_ntz"

    def rows(kind, key, n, minutes):
        found = []
        for i in range(n):
            begin = start + dt.timedelta(days=rng.randrange(4), minutes=rng.randrange(0, 1200, 30))
            found.append((f"{kind}-{key}-{i}", key, begin, begin + dt.timedelta(minutes=rng.choice(minutes))))
        return found

    days, nights = [30, 90, 200], [30, 600, 3000]
    calm = [rows(kind, "calm", 30, days) for kind in "bq"]
    late = [rows(kind, "late", 30, nights) for kind in "bq"]
    late[0].append(("b-late-m", "late", start + dt.timedelta(hours=20), start + dt.timedelta(days=1)))  # ends at midnight

    def plain(booked, asked):
        return {i: sum(k == other and x < e and y > s for _, other, x, y in booked) for i, k, s, e in asked}

    def counted(booked, asked):
        return sweep.count_overlaps(spark.createDataFrame(booked, schema), spark.createDataFrame(asked, schema), ["k"], "s", "e", "id", F.to_date)

    alone = counted(*calm)
    capsys.readouterr()
    alone.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    assert dict(alone.collect()) == plain(*calm)
    both = [c + n for c, n in zip(calm, late)]
    assert dict(counted(*both).collect()) == plain(*both)
    monkeypatch.setattr(sweep, "FEW", 0)
    assert dict(counted(*both).collect()) == plain(*both)
