"""Lists, joins, statistics, ingest and quality on literal fixtures."""

from __future__ import annotations

from tests.conftest import at
from turnero.functions.clock import clock_text, weekday_name
from turnero.operators import joins, lists, quality, stats
from turnero.sources import tables as store
from turnero.sources.schemas import CATEGORIAS_INICIALES, TABLES
from pyspark.sql import functions as F

NOW = "2026-06-01 12:00:00"


def test_declared_record_sizes():
    published = {"usuario": 504, "cliente": 192, "proveedor": 466, "admin": 325, "intento_login": 597,
                 "token_refresh": 913, "token_reset_password": 405, "email_verification_token": 596,
                 "categoria_servicio": 673, "servicio": 705, "empleado": 775, "empleado_servicio": 96,
                 "horario_laboral": 106, "bloqueo_horario": 137, "reserva": 688}
    assert {name: stats.declared_bytes(name) for name in published} == published
    assert len(TABLES) == 16 and sum(len(t.columns) for t in TABLES.values()) == 140


def test_sunday_and_clock(spark):
    row = spark.range(1).select(weekday_name(F.lit("2026-06-14").cast("date")), clock_text(F.lit(1439))).first()
    assert tuple(row) == ("DOMINGO", "23:59")


def test_range_ends(spark, make):
    table = make("reserva", [
        {"id_reserva": "now", "fecha_hora_inicio": at(NOW), "estado": "PENDIENTE"},
        {"id_reserva": "edge", "fecha_hora_inicio": at("2026-06-02 12:00:00"), "estado": "CONFIRMADA"},
        {"id_reserva": "late", "fecha_hora_inicio": at("2026-06-02 12:00:01"), "estado": "PENDIENTE"},
        {"id_reserva": "busy", "fecha_hora_inicio": at(NOW), "estado": "EN_PROGRESO"}])
    assert {r.id_reserva for r in lists.reservas_proximas(table, NOW).collect()} == {"now", "edge"}
    assert {r.id_reserva for r in lists.reservas_dia_actual(table, NOW).collect()} == {"now", "busy"}


def test_single_id_and_frame_of_ids_agree(spark, make):
    table = make("servicio", [{"id_servicio": "a", "id_proveedor": "p"}, {"id_servicio": "b", "id_proveedor": "q"},
                              {"id_servicio": "c", "id_proveedor": "p", "activo": False}])
    one = lists.servicios_por_proveedor(table, "p", solo_activos=False)
    many = lists.servicios_por_proveedor(table, spark.createDataFrame([("p",), ("p",)], "x string"), False)
    assert "id_proveedor" not in one.columns
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.drop("id_proveedor").collect()))
    assert lists.servicios_por_proveedor(table, "p").count() == 1


def test_provider_without_bookings_gets_zeros(spark, make):
    table = make("reserva", [{"id_proveedor": "p", "estado": "CANCELADA", "fecha_creacion": at(NOW)},
                             {"id_proveedor": "p", "estado": "PENDIENTE", "fecha_creacion": at(NOW)},
                             {"id_proveedor": "p", "estado": "PENDIENTE", "fecha_creacion": at(NOW)}])
    absent = stats.estadisticas_proveedor_rango(table, "x", "2026-01-01", "2026-12-31").collect()
    assert [tuple(map(float, r)) for r in absent] == [(0.0,) * 6]
    ids = spark.createDataFrame([("p",), ("x",)], "id string")
    batch = {r.id_proveedor: r for r in stats.estadisticas_proveedor_rango(
        table, ids, "2026-01-01", "2026-12-31").collect()}
    assert float(batch["p"].tasa_cancelacion) == 33.33 and batch["x"].total_reservas == 0


def test_lockout_threshold_and_window(spark, make):
    users = make("usuario", [{"id_usuario": u} for u in ("four", "five", "old")])
    rows = [("four", 4, "2026-06-01 11:30"), ("five", 5, "2026-06-01 11:30"), ("old", 4, "2026-06-01 11:30"),
            ("old", 1, "2026-06-01 11:00:00"), ("old", 1, "2026-06-01 12:00:01")]
    log = make("intento_login", [
        {"id_intento": f"{u}{k}{i}", "id_usuario": u, "fecha_hora": at(when), "exitoso": False,
         "direccion_ip": f"10.0.0.{9 - i % 2}"} for k, (u, n, when) in enumerate(rows) for i in range(n)])
    hits = stats.intentos_fallidos_recientes(users, log, NOW).collect()
    assert [(h.id_usuario, h.intentos_fallidos_count, h.ips_utilizadas) for h in hits] == [
        ("five", 5, "10.0.0.8, 10.0.0.9")]


def test_token_fan_out(spark, make):
    users = make("usuario", [{"id_usuario": "u"}, {"id_usuario": "none"}])
    live = {"id_usuario": "u", "fecha_creacion": at("2026-05-31"), "fecha_expiracion": at("2026-07-01")}
    rows = joins.tokens_activos(
        users, make("token_refresh", [{**live, "id_token": i, "revocado": False} for i in "ab"]),
        make("token_reset_password", [{**live, "id_token": i, "usado": False} for i in "cde"]),
        make("email_verification_token", []), NOW)
    assert sorted(r.id_usuario for r in rows.collect()) == ["none"] + ["u"] * 6


def test_insert_if_absent_and_defaults(spark):
    seed = store.with_defaults(store.literal_rows(
        spark, "id_categoria string, nombre_categoria string",
        [(f"K{i}", name) for i, (name, _) in enumerate(CATEGORIAS_INICIALES)]), "categoria_servicio", NOW)
    batch = seed.limit(0).unionByName(store.with_defaults(spark.createDataFrame(
        [("z", "Salud", None), ("y", "Nueva", False), ("x", "Nueva", None)],
        "id_categoria string, nombre_categoria string, activa boolean"), "categoria_servicio", NOW))
    rows = store.insert_if_absent(seed, batch, ["nombre_categoria"], "id_categoria").collect()
    assert len(rows) == 11
    assert [(r.id_categoria, r.activa) for r in rows if r.nombre_categoria == "Nueva"] == [("x", True)]


def test_generated_ids_are_distinct(spark):
    rows = store.with_defaults(spark.range(50).select(F.lit("n").alias("nombre_categoria")), "categoria_servicio", NOW)
    assert rows.select("id_categoria").distinct().count() == 50


def test_append_rejects_broken_rows(spark, make):
    base = make("servicio", [{"id_servicio": "a"}])
    batch = spark.createDataFrame([("b", "p", "corte", 30, 10), ("c", "p", "largo" * 40, 0, -1)],
                                  "id_servicio string, id_proveedor string, nombre_servicio string, "
                                  "duracion_minutos int, precio int")
    after, inserted, rejected = store.append_batch(base, batch, "servicio", NOW)
    assert after.count() == 2 and inserted.first().capacidad_maxima == 1
    assert sorted(rejected.first().reglas) == ["duracion_positiva", "nombre_servicio_largo", "precio_no_negativo"]


def test_null_passes_a_check_but_not_not_null(spark, make):
    rows = make("reserva", [{"id_reserva": "r", "fecha_hora_fin": None, "fecha_cancelacion": None, "estado": "NO_SHOW"}])
    assert [(r.regla, r.clave) for r in quality.check_rows(rows, "reserva").collect()] == [
        ("fecha_hora_fin_no_nulo", "r")]


def test_quality_report_of_a_clean_database_is_empty(spark):
    from tests.conftest import SF
    from turnero.sources.marketplace import Marketplace

    report = quality.quality_report({**Marketplace(spark, SF).tables()})
    assert report.filter("regla <> 'sin_solape'").count() == 0


def test_one_account_with_most_tokens_spreads_over_tasks(spark, make):
    """200,000 refresh tokens of one account are joined in several tasks; accounts without tokens stay."""
    one = make("token_refresh", [{"id_token": "t", "id_usuario": "hot", "revocado": False, "fecha_creacion": at("2026-01-01"),
                                  "fecha_expiracion": at("2027-01-01")}])
    ids = spark.range(200_000, numPartitions=8).select(F.col("id").cast("string").alias("id_token"))
    many = ids.crossJoin(F.broadcast(one.drop("id_token"))).select(*one.columns)
    users = make("usuario", [{"id_usuario": u, "email": u} for u in ("hot", "none")])
    reset = make("token_reset_password", [{"id_token": f"w{i}", "id_usuario": "hot", "usado": False, "fecha_creacion": at("2026-01-01"),
                                           "fecha_expiracion": at("2027-01-01")} for i in range(2)])
    # As with data too large to broadcast or to put together.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = joins.tokens_activos(users, many, reset, make("email_verification_token", []), "2026-06-01")
        parts = rows.filter("id_usuario = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in parts) == 400_000 and max(r["count"] for r in parts) <= 250_000 and len(parts) >= 3
    assert rows.filter("id_usuario = 'none'").collect()[0][2:] == (None,) * 6


def test_volume_profile_has_rows_per_page_and_pages(make):
    profile = stats.table_volume_profile(make("usuario", [{"id_usuario": f"u{i}", "email": "x" * 50} for i in range(100)]), "usuario").first()
    per_page = int(8092 // (profile.registro_promedio + 4))
    assert (profile.filas_por_pagina, profile.paginas, profile.bytes) == (per_page, -(-100 // per_page), -(-100 // per_page) * 8192)


def test_uniqueness_is_counted_in_parts_that_follow_the_rows(spark, make, monkeypatch):
    """Many keys are placed by value before they are counted, in more tasks the more there are; nulls and repeats as ever."""
    from turnero.operators import quality
    monkeypatch.setattr(quality, "KEYS_PER_TASK", 20)
    rows = [{"id_categoria": f"K{j % 90}", "nombre_categoria": None if j % 10 == 0 else f"n{j % 95}"} for j in range(100)]
    report = quality.check_unique({"categoria_servicio": make("categoria_servicio", rows)})
    got = sorted((r.regla, r.clave) for r in report.collect())
    assert got == sorted([*(("id_categoria_unico", f"K{j}") for j in range(10)),
                          *(("nombre_categoria_unico", f"n{j}") for j in range(1, 5))])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression") and ", 10\n" in plan
