"""Plan shape: what must hold when the data is a thousand times larger."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SF
from turnero.functions import sql
from turnero.operators import joins, lists, stats, visibility
from turnero.plans import queries
from turnero.sources import marketplace
from turnero.sources.marketplace import AS_OF_BOOKING, Marketplace


@pytest.fixture(scope="module")
def market(spark):
    return Marketplace(spark, SF)


def physical(frame, capsys) -> str:
    capsys.readouterr()
    frame.explain("formatted")
    return capsys.readouterr().out


# Queries that run a job while they are declared (writes, streams) are left out.
LAZY = [n for n in queries.PLANS if not n.startswith(("t", "i1", "i5", "c3", "c4")) and not n.endswith("_tabla")]


def test_no_query_pairs_rows_or_leaves_the_jvm(spark, capsys):
    for name in LAZY:
        plan = physical(queries.build(name)(spark, SF), capsys)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
            assert bad not in plan, (name, bad)


def test_filters_and_columns_reach_the_scan(market, capsys):
    plan = physical(lists.reservas_proximas(market.reserva, AS_OF_BOOKING), capsys)
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(fecha_hora_inicio" in pushed and "In(estado" in pushed
    plan = physical(stats.estadisticas_reservas_proveedor(market.reserva), capsys)
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "comentarios" not in read and "id_cliente" not in read


def test_a_report_shuffles_once(market, capsys):
    plan = physical(stats.estadisticas_reservas_proveedor(market.reserva), capsys)
    assert plan.count("hashpartitioning") == 1 and "partial_count" in plan


def test_predicates_match_the_registered_functions(spark, market):
    tables = market.tables()
    people = visibility.principals(market.auth_users)
    names = sql.register(spark, tables, people)
    assert len(names) == 12
    day = spark.sql("SELECT id_empleado, fecha, hora_inicio, hora_fin FROM bloqueo_horario LIMIT 1").first()
    one = spark.sql("SELECT id_empleado, id_reserva, fecha_hora_inicio AS a, fecha_hora_fin AS b, id_cliente, "
                    "id_proveedor FROM reserva WHERE estado = 'CONFIRMADA' LIMIT 1").first()
    got = spark.sql(f"""
        SELECT hay_conflicto('{one.id_empleado}', TIMESTAMP_NTZ'{one.a}', TIMESTAMP_NTZ'{one.b}') AS busy,
               hay_conflicto('nadie', TIMESTAMP_NTZ'{one.a}', TIMESTAMP_NTZ'{one.b}') AS idle,
               esta_disponible('{day.id_empleado}', DATE'{day.fecha}', {day.hora_inicio}, {day.hora_fin}) AS free,
               tiene_rol('A0', 'admin') AS boss, es_de_tipo('C1', 'PROVEEDOR') AS provider""").first()
    assert got.busy and not got.idle and got.boss and not got.provider

    def same(query: str, frame) -> None:
        assert sorted(map(tuple, spark.sql(query).collect())) == sorted(map(tuple, frame.collect())), query

    p, e, c = one.id_proveedor, one.id_empleado, one.id_cliente
    same(f"SELECT * FROM servicios_de_proveedor('{p}')", lists.servicios_por_proveedor(market.servicio, p))
    same(f"SELECT * FROM servicios_de_empleado('{e}', false)",
         lists.servicios_por_empleado(market.empleado_servicio, e, solo_activos=False))
    same(f"SELECT * FROM horario_de_empleado('{e}', 'LUNES')",
         lists.horario_laboral_por_empleado(market.horario_laboral, e, "LUNES"))
    same(f"SELECT * FROM bloqueos_de_empleado('{e}', DATE'1998-01-01')",
         lists.bloqueos_por_empleado(market.bloqueo_horario, e, "1998-01-01"))
    same(f"SELECT * FROM reservas_de_cliente('{c}')", lists.reservas_por_cliente(market.reserva, c))
    window = "TIMESTAMP_NTZ'1996-01-01 00:00:00', TIMESTAMP_NTZ'1999-01-01 00:00:00'"
    same(f"SELECT * FROM reservas_de_empleado('{e}', {window})",
         lists.reservas_por_empleado(market.reserva, e, "1996-01-01", "1999-01-01"))
    same(f"SELECT * FROM estadisticas_de_proveedor('{p}', {window})",
         stats.estadisticas_proveedor_rango(market.reserva, p, "1996-01-01", "1999-01-01"))
    same(f"SELECT * FROM empleados_de_proveedor('{p}')",
         stats.empleados_por_proveedor(market.empleado, market.empleado_servicio, p))


def test_pairs_join_on_equality(market, capsys):
    plan = physical(joins.conflictos_existentes(market.reserva), capsys)
    assert "_slot" in plan and "Join" in plan


def exchanges(plan: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


@pytest.mark.parametrize("name", ["j10_validar_conflicto_horario", "j12_empleado_disponible", "v7_check_overlaps"])
def test_overlaps_are_counted_in_one_sweep(spark, capsys, name):
    assert exchanges(physical(queries.build(name)(spark, SF), capsys)) <= 4


def test_sql_functions_push_their_filters(spark, market, capsys):
    sql.register(spark, market.tables())
    plan = physical(spark.sql("SELECT * FROM reservas_de_cliente('C7', 'COMPLETADA')"), capsys)
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(id_cliente,C7)" in pushed and "EqualTo(estado,COMPLETADA)" in pushed


def test_the_lines_of_the_bookings_move_once(spark, capsys, monkeypatch):
    monkeypatch.setattr(marketplace, "stored_once", lambda spark, folder, name, build: build())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(physical(Marketplace(spark, SF)._bookings(), capsys)) == 2  # lines and orders
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_parts_of_the_bookings_follow_the_lines(spark, capsys, monkeypatch):
    kept = {}

    def keep(spark, folder, name, build):
        kept["stored"] = build()
        return kept["stored"]

    monkeypatch.setattr(marketplace, "stored_once", keep)
    want = sorted(map(tuple, Marketplace(spark, SF).reserva.drop("l_orderkey").collect()), key=str)
    monkeypatch.setattr(marketplace, "LINES_PER_PART", 100)
    many = Marketplace(spark, SF)
    assert sorted(map(tuple, many.reserva.drop("l_orderkey").collect()), key=str) == want
    parts = -(-many.source("lineitem").count() // 100)
    plan = physical(kept["stored"], capsys)
    assert parts > 8 and exchanges(plan) == 2 and plan.count("hashpartitioning(l_orderkey#") == plan.count(f", {parts}), REPARTITION_BY_NUM")
    assert not {"id_reserva", "id_servicio", "id_empleado", "id_proveedor", "comentarios"} & set(kept["stored"].columns)
