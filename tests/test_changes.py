"""State changes on literal fixtures."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import at
from turnero import session
from turnero.operators import changes, joins

NOW = "2026-06-01 12:00:00"


def asked(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def by(frame, key):
    return {row[key]: row for row in frame.collect()}


def test_cancel_comments_and_stamps(spark, make):
    table = make("reserva", [
        {"id_reserva": "none", "estado": "PENDIENTE"}, {"id_reserva": "old", "estado": "CONFIRMADA", "comentarios": "a"},
        {"id_reserva": "done", "estado": "COMPLETADA", "comentarios": "z"}])
    requests = asked(spark, [("q1", 1, "none", None), ("q2", 2, "none", "tarde"), ("q3", 1, "old", "b"),
                             ("q4", 1, "done", "b"), ("q5", 1, "absent", "b")],
                     "id_solicitud string, orden int, id_reserva string, comentario string")
    snapshot, results = changes.cancelar_reserva(table, requests, NOW)
    rows, answers = by(snapshot, "id_reserva"), by(results, "id_solicitud")
    assert rows["none"].comentarios == "Cancelada por usuario"
    assert rows["old"].comentarios == "a | b"
    assert rows["old"].fecha_cancelacion == at(NOW) and rows["old"].updated_at == at(NOW)
    assert rows["done"].estado == "COMPLETADA" and rows["done"].fecha_cancelacion is None
    assert {k: a.aplicado for k, a in answers.items()} == {
        "q1": True, "q2": False, "q3": True, "q4": False, "q5": False}


def test_cancel_by_owner_only(spark, make):
    table = make("reserva", [{"id_reserva": "r", "id_cliente": "C1", "estado": "PENDIENTE"}])
    requests = asked(spark, [("q1", 1, "r", "C2", None), ("q2", 2, "r", "C1", None)],
                     "id_solicitud string, orden int, id_reserva string, id_cliente string, comentario string")
    snapshot, results = changes.cancelar_reserva(table, requests, NOW)
    assert snapshot.first().estado == "CANCELADA"
    assert {r.id_solicitud: r.aplicado for r in results.collect()} == {"q1": False, "q2": True}


def test_switch_twice_is_once(spark, make):
    table = make("servicio", [{"id_servicio": "s", "activo": True}, {"id_servicio": "t", "activo": False}])
    requests = asked(spark, [("q1", 1, "s"), ("q2", 2, "s"), ("q3", 1, "t")],
                     "id_solicitud string, orden int, id_servicio string")
    once, results = changes.desactivar_servicio(table, requests, NOW)
    twice, again = changes.desactivar_servicio(once, requests, "2026-07-01 00:00:00")
    assert {r.id_solicitud: r.aplicado for r in results.collect()} == {"q1": True, "q2": False, "q3": False}
    assert not again.filter("aplicado").count()
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_reschedule(spark, make):
    def row(i, start, end, estado="CONFIRMADA"):
        return {"id_reserva": i, "id_empleado": "E", "fecha_hora_inicio": at(f"2026-06-20 {start}"),
                "fecha_hora_fin": at(f"2026-06-20 {end}"), "estado": estado}

    table = make("reserva", [row("a", "10:00", "11:00"), row("b", "12:00", "13:00"), row("c", "15:00", "16:00"),
                             row("d", "17:00", "18:00", "CANCELADA")])
    moves = [("q1", 1, "a", "10:30", "11:30"),   # onto its own slot
             ("q2", 2, "b", "11:00", "11:45"),   # blocked by a, still at 10:00 in the snapshot or by q1
             ("q3", 3, "c", "13:00", "14:00"),   # free
             ("q4", 4, "d", "20:00", "21:00")]   # closed
    requests = asked(spark, [(q, o, i, at(f"2026-06-20 {s}"), at(f"2026-06-20 {e}")) for q, o, i, s, e in moves],
                     "id_solicitud string, orden int, id_reserva string, nuevo_inicio timestamp_ntz, "
                     "nuevo_fin timestamp_ntz")
    snapshot, results = changes.reagendar_reserva(table, requests, NOW)
    assert {r.id_solicitud: r.aplicado for r in results.collect()} == {
        "q1": True, "q2": False, "q3": True, "q4": False}
    rows = by(snapshot, "id_reserva")
    assert rows["a"].fecha_hora_inicio == at("2026-06-20 10:30") and rows["a"].estado == "PENDIENTE"
    assert rows["b"].estado == "CONFIRMADA"


def test_create_batch(spark, make):
    services = make("servicio", [{"id_servicio": "S", "activo": True}, {"id_servicio": "off", "activo": False}])
    week = make("horario_laboral", [{"id_empleado": "E", "dia_semana": "SABADO", "hora_inicio": 480, "hora_fin": 1080}])
    blocks = make("bloqueo_horario", [{"id_empleado": "E", "fecha": dt.date(2026, 6, 20), "hora_inicio": 600,
                                       "hora_fin": 660}])
    booked = make("reserva", [{"id_reserva": "r", "id_empleado": "E", "estado": "PENDIENTE",
                               "fecha_hora_inicio": at("2026-06-20 09:00"), "fecha_hora_fin": at("2026-06-20 09:30")}])
    cases = [  # id, service, start, end, reason
        ("q1", "off", "14:00", "15:00", "SERVICIO"),
        ("q2", "S", "19:00", "20:00", "DISPONIBILIDAD"),
        ("q3", "S", "10:30", "11:30", "DISPONIBILIDAD"),
        ("q4", "S", "09:15", "09:45", "CONFLICTO"),
        ("q5", "S", "12:00", "13:00", None),
        ("q6", "S", "12:30", "13:30", "SOLICITUD_ANTERIOR"),
        ("q7", "S", "13:00", "14:00", None),  # q6 was refused, so its slot is free
        ("q8", "S", "12:00", "13:00", "SOLICITUD_ANTERIOR"),
    ]
    requests = asked(spark, [(q, i, "C", s, "E", "P", at(f"2026-06-20 {a}"), at(f"2026-06-20 {b}"))
                             for i, (q, s, a, b, _) in enumerate(cases)],
                     "id_solicitud string, orden int, id_cliente string, id_servicio string, id_empleado string, "
                     "id_proveedor string, fecha_hora_inicio timestamp_ntz, fecha_hora_fin timestamp_ntz")
    snapshot, results = changes.crear_reserva(booked, services.filter("activo"), week, blocks, requests, NOW)
    assert {r.id_solicitud: r.motivo for r in results.collect()} == {c[0]: c[4] for c in cases}
    assert {r.id_reserva for r in snapshot.collect()} == {"r", "N-q5", "N-q7"}


def test_audit_is_null_safe_and_keeps_both_images(spark, make):
    old = make("usuario", [{"id_usuario": "a", "email": None}, {"id_usuario": "b", "email": "b"},
                           {"id_usuario": "c", "intentos_fallidos": 1}])
    new = make("usuario", [{"id_usuario": "a", "email": "n"}, {"id_usuario": "b", "email": "b"},
                           {"id_usuario": "c", "intentos_fallidos": 2}])
    rows = changes.auditar_cambios_sensibles(old, new, NOW).collect()
    assert [r.id_registro_afectado for r in rows] == ["a"]
    before, after = json.loads(rows[0].valores_anteriores), json.loads(rows[0].valores_nuevos)
    assert before["email"] is None and after["email"] == "n" and set(before) == set(old.columns)


def test_retention_edges(spark, make):
    tokens = make("token_refresh", [
        {"id_token": "gone", "fecha_expiracion": at("2026-05-01"), "revocado": False},
        {"id_token": "revoked", "fecha_expiracion": at("2026-05-01"), "revocado": True},
        {"id_token": "live", "fecha_expiracion": at("2026-07-01"), "revocado": False}])
    kept, removed = changes.limpiar_tokens_expirados(tokens, NOW)
    assert {r.id_token for r in kept.collect()} == {"revoked", "live"}
    assert kept.count() + removed.count() == 3
    reset = make("token_reset_password", [
        {"id_token": "used", "usado": True, "fecha_creacion": at("2026-05-31"), "fecha_expiracion": at("2026-07-01")},
        {"id_token": "later", "usado": True, "fecha_creacion": at("2026-06-02"), "fecha_expiracion": at("2026-07-01")}])
    log = make("intento_login", [{"id_intento": "old", "fecha_hora": at("2026-05-02 11:59:59")},
                                 {"id_intento": "edge", "fecha_hora": at("2026-05-02 12:00:00")}])
    tables, counts = changes.limpiar_datos_expirados(tokens, reset, make("email_verification_token", []), log, NOW)
    assert {r.tabla: r.eliminadas for r in counts.collect()} == {
        "token_refresh": 2, "token_reset_password": 1, "email_verification_token": 0, "intento_login": 1}
    assert [r.id_token for r in tables["token_reset_password"].collect()] == ["later"]
    assert [r.id_intento for r in tables["intento_login"].collect()] == ["edge"]


def test_last_request_wins_and_unknown_rows_answer_false(spark, make):
    users = make("usuario", [{"id_usuario": "u", "intentos_fallidos": 0}])
    requests = asked(spark, [("q1", 1, "u", 5), ("q2", 2, "u", 7), ("q3", 1, "x", 1)],
                     "id_solicitud string, orden int, id_usuario string, intentos int")
    snapshot, results = changes.actualizar_intentos_fallidos(users, requests, NOW)
    assert snapshot.first().intentos_fallidos == 7
    assert {r.id_solicitud: r.aplicado for r in results.collect()} == {"q1": True, "q2": True, "q3": False}


def test_consecutive_failures(spark, make):
    def attempt(user, when, ok):
        return {"id_usuario": user, "fecha_hora": at(when), "exitoso": ok}

    log = make("intento_login", [
        attempt("a", "2026-05-30 08:00", False), attempt("a", "2026-05-30 09:00", True),
        attempt("a", "2026-05-30 10:00", False), attempt("a", "2026-05-31 10:00", False),
        attempt("b", "2026-05-30 10:00", False), attempt("c", "2026-05-30 10:00", True),
        attempt("a", "2026-06-30 10:00", True)])  # after the clock
    got = {r.id_usuario: r.intentos for r in changes.fallos_consecutivos(log, NOW).collect()}
    assert got == {"a": 2, "b": 1, "c": 0}


def test_blocks_of_a_booking_over_midnight(spark, make):
    table = make("reserva", [{"id_reserva": "r", "estado": "CONFIRMADA", "fecha_hora_inicio": at("2026-06-20 23:00"),
                              "fecha_hora_fin": at("2026-06-21 00:30")}])
    rows = changes.bloqueos_de_reservas(table).orderBy("fecha").collect()
    assert [(str(r.fecha), r.hora_inicio, r.hora_fin) for r in rows] == [("2026-06-20", 1380, 1440),
                                                                         ("2026-06-21", 0, 30)]


def test_cascade(spark, make):
    tables = {
        "usuario": make("usuario", [{"id_usuario": "a"}, {"id_usuario": "b"}]),
        "admin": make("admin", [{"id_usuario": "a"}, {"id_usuario": "b", "creado_por": "a"}]),
        "intento_login": make("intento_login", [{"id_intento": "1", "id_usuario": "a"},
                                                {"id_intento": "2", "id_usuario": "b"}])}
    left = changes.delete_cascade(tables, "usuario", spark.createDataFrame([("a",)], "id string"), NOW)
    assert [r.id_usuario for r in left["usuario"].collect()] == ["b"]
    assert [(r.id_usuario, r.creado_por) for r in left["admin"].collect()] == [("b", None)]
    assert [r.id_intento for r in left["intento_login"].collect()] == ["2"]
    staff = {"empleado": make("empleado", [{"id_empleado": "e"}]),
             "horario_laboral": make("horario_laboral", [{"id_empleado": "e"}, {"id_empleado": "f"}])}
    left = changes.delete_cascade(staff, "empleado", spark.createDataFrame([("e",)], "id string"), NOW)
    assert left["horario_laboral"].agg(F.max("id_empleado")).first()[0] == "f"


def test_repeated_requests_answer_with_their_own_values(spark, make):
    users = make("usuario", [{"id_usuario": "u", "estado": "ACTIVO"}])
    asked = spark.createDataFrame(
        [("q1", 1, "u", at("2026-06-01 01:00"), "SUSPENDIDO"), ("q2", 2, "u", at("2026-06-01 02:00"), "BLOQUEADO"),
         ("q3", 3, "nobody", at("2026-06-01 03:00"), "BLOQUEADO")],
        "id_solicitud string, orden int, id_usuario string, hasta timestamp_ntz, nuevo_estado string")
    after, answers = changes.bloquear_usuario(users, asked, "2026-06-01")
    got = {r.id_solicitud: (r.aplicado, r.estado, r.bloqueado_hasta) for r in answers.collect()}
    assert got == {"q1": (True, "SUSPENDIDO", at("2026-06-01 01:00")), "q2": (True, "BLOQUEADO", at("2026-06-01 02:00")),
                   "q3": (False, None, None)}
    assert after.first().estado == "BLOQUEADO"


def test_purges_keep_rows_that_a_null_leaves_undecided(spark, make):
    unknown = [{"id_token": "a", "fecha_expiracion": at("2026-01-02")}]
    tokens = make("token_refresh", unknown).withColumn("revocado", F.lit(None).cast("boolean"))
    kept, removed = changes.limpiar_tokens_expirados(tokens, "2026-06-01")
    assert (kept.count(), removed.count()) == (1, 0)
    undated = make("token_refresh", unknown).withColumn("fecha_expiracion", F.lit(None).cast("timestamp_ntz"))
    left, counts = changes.limpiar_datos_expirados(
        undated, make("token_reset_password", []), make("email_verification_token", []), make("intento_login", []), "2026-06-01")
    assert left["token_refresh"].count() == 1 and counts.agg(F.sum("eliminadas")).first()[0] == 0


def test_large_sides_of_a_join_do_not_pass_through_the_driver(spark, make, capsys, monkeypatch):
    """However small their files are: services and weeks beyond ``FEW`` rows are met by key, and the answers are the same."""
    services = make("servicio", [{"id_servicio": f"S{i}", "activo": i != 4} for i in range(6)])
    week = make("horario_laboral", [{"id_empleado": f"E{i}", "dia_semana": "SABADO", "hora_inicio": 480, "hora_fin": 1080} for i in range(5)])
    blocks = make("bloqueo_horario", [{"id_empleado": "E1", "fecha": dt.date(2026, 6, 20), "hora_inicio": 600, "hora_fin": 660}])
    booked = make("reserva", [{"id_reserva": "r", "id_empleado": "E2", "estado": "PENDIENTE", "comentarios": "antes",
                               "fecha_hora_inicio": at("2026-06-20 09:00"), "fecha_hora_fin": at("2026-06-20 09:30")}])
    schema = ("id_solicitud string, orden int, id_cliente string, id_servicio string, id_empleado string, id_proveedor string, "
              "fecha_hora_inicio timestamp_ntz, fecha_hora_fin timestamp_ntz, comentarios string")
    cases = [("q1", "S4", "E0", 9), ("q2", None, "E0", 9), ("q3", "S9", "E0", 9), ("q4", "S1", "E1", 10), ("q5", "S1", "E2", 9),
             ("q6", "S1", "E3", 9), ("q7", "S2", "E3", 9), ("q8", "S2", "E9", 9), ("q9", "S3", "E4", 12), ("q9", "S3", "E4", 12)]
    requests = asked(spark, [(q, i, "C", s, e, "P", at(f"2026-06-20 {h:02}:00"), at(f"2026-06-20 {h:02}:45"), f"nota {q}")
                             for i, (q, s, e, h) in enumerate(cases)], schema)

    def made():
        capsys.readouterr()
        snapshot, results = changes.crear_reserva(booked, services.filter("activo"), week, blocks, requests, NOW)
        snapshot, results = (x.drop("created_at", "updated_at") for x in (snapshot, results))
        duty = joins._on_duty(week, spark.createDataFrame([("E1", "SABADO", 500, 600)], "id_empleado string, dia_semana string, hora_inicio int, hora_fin int"))
        for frame in (snapshot, results, duty):
            frame.explain()
        return [sorted(map(tuple, x.collect()), key=str) for x in (snapshot, results, duty)], capsys.readouterr().out

    few, plan = made()
    assert "BroadcastHashJoin" in plan
    monkeypatch.setattr(session, "FEW", 0)
    many, plan = made()
    assert many == few and "Broadcast" not in plan
    assert {(r[0], r[2]) for r in few[1]} == {
        ("q1", "SERVICIO"), ("q2", "SERVICIO"), ("q3", "SERVICIO"), ("q4", "DISPONIBILIDAD"), ("q5", "CONFLICTO"), ("q6", None),
        ("q7", "SOLICITUD_ANTERIOR"), ("q8", "DISPONIBILIDAD"), ("q9", None)}
    assert sorted(r[0] for r in few[0]) == ["N-q6", "N-q9", "N-q9", "r"]
