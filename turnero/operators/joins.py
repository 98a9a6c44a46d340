"""Joined views, booking conflicts and employee availability."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.functions.clock import Instant, day, instant, minute_of_day, weekday_name, weekday_rank
from turnero.operators.lists import Ids, active_bookings, pick
from turnero.operators.overlap import count_mutual_overlaps, count_overlaps, overlapping_pairs
from turnero.session import sized


PARTES = 8  # tasks that an account's tokens are dealt over

# accounts -------------------------------------------------------------------

def _with_profiles(usuarios: DataFrame, clientes: DataFrame, proveedores: DataFrame, admins: DataFrame) -> DataFrame:
    """Accounts with ``nombre`` and ``telefono`` of the profile their type calls for.

    An account of an unknown type, or without that profile, has NULL in both.
    """
    profiles = [
        ("CLIENTE", clientes, "nombre", "telefono"),
        ("PROVEEDOR", proveedores, "nombre_comercial", "telefono_contacto"),
        ("ADMIN", admins, "nombre_completo", "telefono"),
    ]
    rows, name, phone = usuarios, F.lit(None), F.lit(None)
    for kind, profile, name_column, phone_column in reversed(profiles):
        of_kind = F.col("tipo_usuario") == kind
        side = profile.select("id_usuario", F.col(name_column).alias(f"_n{kind}"),
                              F.col(phone_column).alias(f"_t{kind}"))
        rows = rows.join(side, "id_usuario", "left")
        name = F.when(of_kind, F.col(f"_n{kind}")).otherwise(name)
        phone = F.when(of_kind, F.col(f"_t{kind}")).otherwise(phone)
    return rows.withColumns({"_nombre": name, "_telefono": phone})


def usuario_completo(usuarios, clientes, proveedores, admins) -> DataFrame:
    rows = _with_profiles(usuarios, clientes, proveedores, admins)
    return rows.select("id_usuario", "email", "email_verificado", "estado", "tipo_usuario", "fecha_registro",
                       F.col("_nombre").alias("nombre_completo"), F.col("_telefono").alias("telefono"))


def login_lookup(usuarios, clientes, proveedores, admins, emails: Ids) -> DataFrame:
    """What a login needs to know about one email, a frame of emails, or all."""
    wanted, _ = pick(usuarios, "email", emails)
    rows = _with_profiles(wanted, clientes, proveedores, admins)
    return rows.select("id_usuario", "email", "password_hash", "email_verificado", "estado", "tipo_usuario",
                       "intentos_fallidos", "bloqueado_hasta", F.col("_nombre").alias("nombre_display"))


def _left_join_spread(rows: DataFrame, tokens: DataFrame, token_id: str, parts: int = PARTES) -> DataFrame:
    """``rows`` left-joined with ``tokens`` on id_usuario, an account's tokens dealt over ``parts`` tasks.

    A left join cannot be split on its right side, so accounts with tokens are
    joined part by part and those without are added.
    """
    part = F.pmod(F.xxhash64(token_id), F.lit(parts)).cast("int")
    every = rows.withColumn("_parte", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    matched = every.join(tokens.withColumn("_parte", part), ["id_usuario", "_parte"]).drop("_parte")
    without = rows.join(tokens.select("id_usuario").distinct(), "id_usuario", "left_anti")
    return matched.unionByName(without, allowMissingColumns=True)


def tokens_activos(usuarios, refresh, reset, verification, as_of: Instant = None) -> DataFrame:
    """Accounts with their live tokens; refresh and reset tokens multiply, users without any stay."""
    now = instant(as_of)

    def live(tokens: DataFrame, spent: str, prefix: str) -> DataFrame:
        alive = ~F.col(spent) & (F.col("fecha_expiracion") > now) & (F.col("fecha_creacion") <= now)
        return tokens.filter(alive).select("id_usuario", F.col("id_token").alias(f"{prefix}_token_id"),
                                           F.col("fecha_expiracion").alias(f"{prefix}_expiracion"))

    # An account has one verification token at most, and any number of the others.
    rows = usuarios.select("id_usuario", "email").join(live(verification, "usado", "verification"), "id_usuario", "left")
    rows = _left_join_spread(rows, live(reset, "usado", "reset"), "reset_token_id")
    rows = _left_join_spread(rows, live(refresh, "revocado", "refresh"), "refresh_token_id")
    return rows.select("id_usuario", "email", *(f"{prefix}_{c}" for prefix in ("refresh", "reset", "verification")
                                                for c in ("token_id", "expiracion")))


def admins_activos(admins: DataFrame, usuarios: DataFrame) -> DataFrame:
    active = admins.filter("activo").select("id_usuario", "nombre_completo", "codigo_empleado", "telefono",
                                            "fecha_asignacion", "activo")
    return active.join(usuarios.select("id_usuario", "email", "estado"), "id_usuario").orderBy(
        F.desc("fecha_asignacion"))


# employees ------------------------------------------------------------------

def _staff(empleados: DataFrame, *columns: str, active: bool = True) -> DataFrame:
    return (empleados.filter("activo") if active else empleados).select("id_empleado", *columns)


def servicios_por_empleado_view(empleados: DataFrame, asignaciones: DataFrame) -> DataFrame:
    active = asignaciones.filter("activo").select(
        "id_empleado", "id_servicio", F.col("activo").alias("asignacion_activa"), "fecha_asignacion")
    return _staff(empleados, "nombre_completo", "id_proveedor").join(active, "id_empleado")


def horario_semanal(empleados: DataFrame, horarios: DataFrame) -> DataFrame:
    active = horarios.filter("activo").select("id_empleado", "dia_semana", "hora_inicio", "hora_fin", "activo")
    rows = _staff(empleados, "nombre_completo", "id_proveedor").join(active, "id_empleado")
    return rows.orderBy("id_empleado", weekday_rank(F.col("dia_semana")), "hora_inicio")


def bloqueos_futuros(empleados: DataFrame, bloqueos: DataFrame, as_of: Instant = None) -> DataFrame:
    """Active blocks from the day of ``as_of`` on, of active and inactive employees."""
    ahead = bloqueos.filter(F.col("activo") & (F.col("fecha") >= day(as_of))).select(
        "id_empleado", "fecha", "hora_inicio", "hora_fin", "tipo_bloqueo", "id_reserva", "activo")
    rows = _staff(empleados, "nombre_completo", active=False).join(ahead, "id_empleado")
    return rows.orderBy("id_empleado", "fecha", "hora_inicio")


def empleado_servicio_completo(empleados: DataFrame, asignaciones: DataFrame) -> DataFrame:
    rows = asignaciones.select("id_empleado_servicio", "id_empleado", "id_servicio", "activo", "fecha_asignacion",
                               "created_at")
    return rows.join(_staff(empleados, "nombre_completo", "id_proveedor"), "id_empleado")


def agenda_proveedor_dia(empleados: DataFrame, bloqueos: DataFrame, id_proveedor: Ids,
                         fecha: Instant | dt.date = None) -> DataFrame:
    """Active blocks of a day for every employee of a provider, inactive employees included."""
    staff, keep = pick(empleados, "id_proveedor", id_proveedor)
    today = bloqueos.filter(F.col("activo") & (F.col("fecha") == day(fecha))).select(
        "id_empleado", "hora_inicio", "hora_fin", "tipo_bloqueo", "id_reserva")
    rows = _staff(staff, "nombre_completo", *keep, active=False).join(today, "id_empleado")
    return rows.drop("id_empleado").orderBy("nombre_completo", "hora_inicio")


# conflicts ------------------------------------------------------------------

def validar_conflicto_horario(reservas: DataFrame, solicitudes: DataFrame) -> DataFrame:
    """Per request: does an active booking of the employee overlap it?

    ``solicitudes``: id_solicitud (unique), id_empleado, fecha_hora_inicio,
    fecha_hora_fin and optionally id_excluir, a booking to leave out.  Returns
    id_solicitud, ``conflictos`` (how many) and ``conflicto``; the last two are
    NULL for an empty request.
    """
    booked = active_bookings(reservas).filter("fecha_hora_inicio < fecha_hora_fin").select(
        "id_reserva", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin")
    counted = count_overlaps(booked, solicitudes, ["id_empleado"], "fecha_hora_inicio", "fecha_hora_fin", "id_solicitud",
                             F.to_date, "id_reserva", "id_excluir" if "id_excluir" in solicitudes.columns else None)
    hits = F.col("solapes")
    return counted.select("id_solicitud", hits.alias("conflictos"), (hits > 0).alias("conflicto"))


def conflictos_existentes(reservas: DataFrame, slot_seconds: int = 3600) -> DataFrame:
    """All overlapping pairs of active bookings of one employee."""
    return overlapping_pairs(active_bookings(reservas), "id_empleado", "id_reserva", "fecha_hora_inicio",
                             "fecha_hora_fin", slot_seconds)


def reservas_en_conflicto(reservas: DataFrame) -> DataFrame:
    """Active bookings that overlap another one, with how many; linear in the bookings."""
    active = active_bookings(reservas).filter("fecha_hora_inicio < fecha_hora_fin").select(
        "id_reserva", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin")
    counted = count_mutual_overlaps(active, ["id_empleado"], "fecha_hora_inicio", "fecha_hora_fin", "id_reserva", F.to_date)
    return counted.filter("solapes > 0").select("id_reserva", F.col("solapes").alias("conflictos"))


# availability ---------------------------------------------------------------

def _on_duty(horarios: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (id_empleado, dia_semana, hora_inicio, hora_fin) plus ``en_horario``.

    One block must hold the whole request, so blocks are not merged: one that
    opens by the requested start must reach the requested end.  An employee's
    blocks of a weekday come as one list, at most one block per opening minute.
    """
    keys = ["id_empleado", "dia_semana"]
    active = horarios.filter("activo")
    longest = active.groupBy(*keys, "hora_inicio").agg(F.max("hora_fin").alias("hora_fin"))
    week = longest.groupBy(*keys).agg(F.collect_list(F.struct("hora_inicio", "hora_fin")).alias("_blocks"))
    start, end = F.col("hora_inicio"), F.col("hora_fin")
    covered = F.exists("_blocks", lambda b: (b["hora_inicio"] <= start) & (b["hora_fin"] >= end))
    return requests.join(sized(week, active.count()), keys, "left").withColumn("en_horario", F.coalesce(covered, F.lit(False))).drop("_blocks")


def empleado_disponible(horarios: DataFrame, bloqueos: DataFrame, solicitudes: DataFrame) -> DataFrame:
    """Per request (id_solicitud, id_empleado, fecha, hora_inicio, hora_fin in minutes): is the employee free?

    True when one weekly block of that weekday holds the request and no active
    dated block overlaps it.  Neither the employee's own flag nor the services
    assigned matter.  Returns id_solicitud and ``disponible``, NULL for an empty request.
    """
    duty = _on_duty(horarios, solicitudes.select("id_solicitud", "id_empleado", "fecha", "hora_inicio", "hora_fin",
                                                 weekday_name(F.col("fecha")).alias("dia_semana")))
    blocks = bloqueos.filter(F.col("activo") & (F.col("hora_inicio") < F.col("hora_fin"))).select(
        "id_empleado", "fecha", "hora_inicio", "hora_fin")
    counted = count_overlaps(blocks, duty, ["id_empleado", "fecha"], "hora_inicio", "hora_fin", "id_solicitud", flag="en_horario")
    free = F.col("en_horario") & (F.col("solapes") == 0)
    return counted.select("id_solicitud", F.when(F.col("solapes").isNotNull(), free).alias("disponible"))


def with_day_columns(solicitudes: DataFrame) -> DataFrame:
    """Timestamp requests plus fecha, hora_inicio and hora_fin; one that leaves its day becomes an empty one.

    Minutes round outwards, which is exact against blocks kept in whole minutes.
    """
    start, end = F.col("fecha_hora_inicio"), F.col("fecha_hora_fin")
    one_day = F.to_date(start) == F.to_date(end)
    return solicitudes.withColumns({
        "fecha": F.to_date(start), "hora_inicio": minute_of_day(start),
        "hora_fin": F.when(one_day, minute_of_day(end, up=True)).otherwise(-1)})
