"""Filtered and ordered listings of one table.

Parameterised listings take a literal id, a frame whose single column names
the ids, or None for every id; the last two keep the id in the result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.functions.clock import Instant, day, instant, minutes_between, shifted, weekday_rank
from turnero.sources.schemas import RESERVA_ACTIVA

Ids = str | DataFrame | None


def pick(rows: DataFrame, column: str, ids: Ids) -> tuple[DataFrame, list[str]]:
    """Rows of the wanted ids, and the id columns the result must keep."""
    if ids is None:
        return rows, [column]
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return rows.join(wanted, column, "left_semi"), [column]
    return rows.filter(F.col(column) == ids), []


def active_bookings(reservas: DataFrame) -> DataFrame:
    return reservas.filter(F.col("estado").isin(*RESERVA_ACTIVA))


# catalogue ------------------------------------------------------------------

def categorias_activas(categorias: DataFrame) -> DataFrame:
    active = categorias.filter("activa")
    return active.select("id_categoria", "nombre_categoria", "descripcion", "created_at").orderBy("nombre_categoria")


def categoria_by_id(categorias: DataFrame, id_categoria: Ids) -> DataFrame:
    rows, _ = pick(categorias, "id_categoria", id_categoria)
    return rows.select("id_categoria", "nombre_categoria", "activa")


def servicios_activos(servicios: DataFrame) -> DataFrame:
    columns = ["id_servicio", "id_proveedor", "nombre_servicio", "duracion_minutos", "precio", "descripcion",
               "capacidad_maxima", "created_at"]
    return servicios.filter("activo").select(*columns).orderBy("nombre_servicio")


def servicios_grupales(servicios: DataFrame) -> DataFrame:
    group = servicios.filter(F.col("capacidad_maxima") > 1)
    columns = ["id_servicio", "id_proveedor", "nombre_servicio", "capacidad_maxima", "precio", "activo"]
    return group.select(*columns).orderBy(F.desc("capacidad_maxima"))


def servicios_por_proveedor(servicios: DataFrame, id_proveedor: Ids, solo_activos: bool = True) -> DataFrame:
    rows, keep = pick(servicios.filter("activo") if solo_activos else servicios, "id_proveedor", id_proveedor)
    return rows.select(*keep, "id_servicio", "nombre_servicio", "duracion_minutos", "precio", "descripcion",
                       "capacidad_maxima", "activo").orderBy("nombre_servicio")


# schedules ------------------------------------------------------------------

def servicios_por_empleado(asignaciones: DataFrame, id_empleado: Ids, solo_activos: bool = True) -> DataFrame:
    rows, keep = pick(asignaciones.filter("activo") if solo_activos else asignaciones, "id_empleado", id_empleado)
    return rows.select(*keep, "id_servicio", "activo", "fecha_asignacion").orderBy(F.desc("fecha_asignacion"))


def horario_laboral_por_empleado(horarios: DataFrame, id_empleado: Ids, dia_semana: str | None = None,
                                 solo_activos: bool = True) -> DataFrame:
    rows, keep = pick(horarios.filter("activo") if solo_activos else horarios, "id_empleado", id_empleado)
    if dia_semana is not None:
        rows = rows.filter(F.col("dia_semana") == dia_semana)
    ordered = rows.orderBy(*keep, weekday_rank(F.col("dia_semana")), "hora_inicio")
    return ordered.select(*keep, "id_horario", "dia_semana", "hora_inicio", "hora_fin", "activo")


def bloqueos_por_empleado(bloqueos: DataFrame, id_empleado: Ids, desde: Instant | dt.date = None,
                          hasta: Instant | dt.date = None) -> DataFrame:
    """Active blocks from ``desde`` (today by default) through ``hasta`` (open end by default)."""
    rows, keep = pick(bloqueos.filter("activo"), "id_empleado", id_empleado)
    rows = rows.filter(F.col("fecha") >= day(desde))
    if hasta is not None:
        rows = rows.filter(F.col("fecha") <= day(hasta))
    return rows.select(*keep, "id_bloqueo", "fecha", "hora_inicio", "hora_fin", "tipo_bloqueo",
                       "id_reserva").orderBy(*keep, "fecha", "hora_inicio")


def agenda_dia_empleado(bloqueos: DataFrame, id_empleado: Ids, fecha: Instant | dt.date = None) -> DataFrame:
    rows, keep = pick(bloqueos.filter(F.col("activo") & (F.col("fecha") == day(fecha))), "id_empleado", id_empleado)
    length = (F.col("hora_fin") - F.col("hora_inicio")).alias("duracion_minutos")
    return rows.select(*keep, "hora_inicio", "hora_fin", "tipo_bloqueo", "id_reserva", length).orderBy(
        *keep, "hora_inicio")


def bloqueos_solapados(bloqueos: DataFrame, id_empleado: Ids, fecha: Instant | dt.date | None,
                       inicio: int, fin: int) -> DataFrame:
    """Active blocks of a day (None: of every day) that overlap the minutes [inicio, fin)."""
    rows, keep = pick(bloqueos.filter("activo"), "id_empleado", id_empleado)
    if fecha is not None:
        rows = rows.filter(F.col("fecha") == day(fecha))
    else:
        keep = [*keep, "fecha"]
    overlaps = (F.col("hora_inicio") < fin) & (F.col("hora_fin") > inicio)
    return rows.filter(overlaps).select(*keep, "id_bloqueo", "tipo_bloqueo", "hora_inicio", "hora_fin")


def tiene_horario(horarios: DataFrame, empleados: DataFrame, dia_semana: str, inicio: int, fin: int) -> DataFrame:
    """Per employee: is [inicio, fin] inside one active weekly block of that weekday?"""
    holds = (F.col("activo") & (F.col("dia_semana") == dia_semana)
             & (F.col("hora_inicio") <= inicio) & (F.col("hora_fin") >= fin))
    on_duty = horarios.filter(holds).groupBy("id_empleado").agg(F.lit(True).alias("_yes"))
    ids = empleados.select("id_empleado").distinct()
    return ids.join(on_duty, "id_empleado", "left").select(
        "id_empleado", F.coalesce("_yes", F.lit(False)).alias("tiene_horario_laboral"))


# bookings -------------------------------------------------------------------

def reservas_activas(reservas: DataFrame, id_cliente: Ids = None) -> DataFrame:
    rows, _ = pick(active_bookings(reservas), "id_cliente", id_cliente)
    return rows.select("id_reserva", "id_cliente", "id_servicio", "id_empleado", "id_proveedor", "fecha_hora_inicio",
                       "fecha_hora_fin", "estado", "fecha_creacion", "comentarios").orderBy("fecha_hora_inicio")


def reservas_por_cliente_all(reservas: DataFrame) -> DataFrame:
    return reservas.drop("created_at", "updated_at").orderBy(F.desc("fecha_creacion"))


def reservas_dia_actual(reservas: DataFrame, as_of: Instant = None, id_empleado: Ids = None) -> DataFrame:
    """Active bookings that start on the day of ``as_of``, as a pushable half-open range."""
    midnight = day(as_of).cast("timestamp_ntz")
    start = F.col("fecha_hora_inicio")
    today = active_bookings(reservas).filter((start >= midnight) & (start < shifted(midnight, days=1)))
    rows, _ = pick(today, "id_empleado", id_empleado)
    return rows.select("id_reserva", "id_empleado", "id_cliente", "id_servicio", "fecha_hora_inicio",
                       "fecha_hora_fin", "estado", "comentarios").orderBy("fecha_hora_inicio")


def reservas_proximas(reservas: DataFrame, as_of: Instant = None, horas: int = 24) -> DataFrame:
    """Pending or confirmed bookings that start within ``horas``, both ends included."""
    now = instant(as_of)
    soon = F.col("fecha_hora_inicio").between(now, shifted(now, hours=horas))
    rows = reservas.filter(soon & F.col("estado").isin("PENDIENTE", "CONFIRMADA"))
    return rows.select("id_reserva", "id_cliente", "id_servicio", "id_empleado", "id_proveedor",
                       "fecha_hora_inicio", "fecha_hora_fin", "estado", "comentarios").orderBy("fecha_hora_inicio")


def reservas_por_cliente(reservas: DataFrame, id_cliente: Ids, estado: str | None = None) -> DataFrame:
    rows, keep = pick(reservas, "id_cliente", id_cliente)
    if estado is not None:
        rows = rows.filter(F.col("estado") == estado)
    return rows.select(*keep, "id_reserva", "id_servicio", "id_empleado", "id_proveedor", "fecha_hora_inicio",
                       "fecha_hora_fin", "estado", "fecha_creacion").orderBy(F.desc("fecha_hora_inicio"))


def reservas_por_empleado(reservas: DataFrame, id_empleado: Ids, inicio: Instant, fin: Instant) -> DataFrame:
    """Bookings that *start* in [inicio, fin], both ends included."""
    starts = F.col("fecha_hora_inicio").between(instant(inicio), instant(fin))
    rows, keep = pick(reservas.filter(starts), "id_empleado", id_empleado)
    return rows.select(*keep, "id_reserva", "id_cliente", "id_servicio", "fecha_hora_inicio", "fecha_hora_fin",
                       "estado").orderBy("fecha_hora_inicio")


def duration(start: str = "fecha_hora_inicio", end: str = "fecha_hora_fin") -> Column:
    return minutes_between(F.col(start), F.col(end))


def historial_cliente(reservas: DataFrame, id_cliente: Ids) -> DataFrame:
    rows, keep = pick(reservas, "id_cliente", id_cliente)
    return rows.select(*keep, "id_reserva", "id_servicio", "id_proveedor", "fecha_hora_inicio", "fecha_hora_fin",
                       "estado", "comentarios", "fecha_creacion", "fecha_cancelacion",
                       duration().alias("duracion_minutos")).orderBy(F.desc("fecha_hora_inicio"))
