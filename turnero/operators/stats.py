"""Aggregate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.functions.clock import Instant, day, instant, shifted
from turnero.operators.lists import Ids, duration, pick
from turnero.sources.schemas import ESTADOS_RESERVA, KINDS, TABLES

# Lock-out rule.
VENTANA_HORAS = 1
MINIMO_FALLOS = 5
MAX_LISTA = 1000  # addresses that a list shows

# Result column of each booking state.
COLUMNA_ESTADO = {
    "PENDIENTE": "reservas_pendientes",
    "CONFIRMADA": "reservas_confirmadas",
    "EN_PROGRESO": "reservas_en_progreso",
    "COMPLETADA": "reservas_completadas",
    "CANCELADA": "reservas_canceladas",
    "NO_SHOW": "reservas_no_show",
}

ESTADOS_DEL_INFORME = ("PENDIENTE", "CONFIRMADA", "COMPLETADA", "CANCELADA")  # fixed value: states that A4 counts


def _percent(part: str, whole: str) -> Column:
    """part/whole in percent, two decimals half away from zero; NULL when whole is 0."""
    exact = F.col(part).cast("decimal(20,0)") * F.lit(100) / F.nullif(F.col(whole), F.lit(0))
    return F.round(exact, 2).cast("decimal(7,2)")


# catalogue ------------------------------------------------------------------

def estadisticas_servicios_proveedor(servicios: DataFrame, id_proveedor: Ids = None) -> DataFrame:
    rows, _ = pick(servicios, "id_proveedor", id_proveedor)
    return rows.groupBy("id_proveedor").agg(
        F.count("*").alias("total_servicios"),
        F.count_if("activo").alias("servicios_activos"),
        F.count_if(~F.col("activo")).alias("servicios_inactivos"),
        F.avg("precio").alias("precio_promedio"),
        F.min("precio").alias("precio_minimo"),
        F.max("precio").alias("precio_maximo"),
        F.avg("duracion_minutos").alias("duracion_promedio"))


def reporte_servicios_proveedor(servicios: DataFrame, id_proveedor: Ids = None) -> DataFrame:
    """The catalogue report with rounded averages, largest catalogues first."""
    return estadisticas_servicios_proveedor(servicios, id_proveedor).select(
        "id_proveedor", "total_servicios", "servicios_activos", "servicios_inactivos",
        F.round("precio_promedio", 0).alias("precio_promedio_cop"), "precio_minimo", "precio_maximo",
        F.round("duracion_promedio", 0).alias("duracion_promedio_min")).orderBy(F.desc("total_servicios"))


# bookings -------------------------------------------------------------------

def _state_counts(*states: str) -> list[Column]:
    return [F.count_if(F.col("estado") == s).alias(COLUMNA_ESTADO[s]) for s in states]


def estadisticas_reservas_proveedor(reservas: DataFrame) -> DataFrame:
    return reservas.groupBy("id_proveedor").agg(
        F.count("*").alias("total_reservas"), *_state_counts(*ESTADOS_RESERVA),
        F.avg(duration()).alias("duracion_promedio_minutos"))


def estadisticas_global_con_tasa(reservas: DataFrame) -> DataFrame:
    """Totals, cancellation rate and mean duration of every provider."""
    return estadisticas_reservas_proveedor(reservas).select(
        "id_proveedor", "total_reservas", "reservas_completadas", "reservas_canceladas", "reservas_no_show",
        _percent("reservas_canceladas", "total_reservas").alias("tasa_cancelacion_pct"),
        F.round("duracion_promedio_minutos", 0).alias("duracion_promedio_min")).orderBy(F.desc("total_reservas"))


def estadisticas_proveedor_rango(reservas: DataFrame, proveedores: str | DataFrame, inicio: Instant,
                                 fin: Instant) -> DataFrame:
    """State counts and cancellation rate of the bookings *created* in [inicio, fin].

    A literal provider gives exactly one row, of zeros when there is nothing;
    a frame of providers gives one row per provider in it.
    """
    created = reservas.filter(F.col("fecha_creacion").between(instant(inicio), instant(fin)))
    counts = [F.count("*").alias("total_reservas"), *_state_counts(*ESTADOS_DEL_INFORME)]
    names = ["total_reservas", *(COLUMNA_ESTADO[s] for s in ESTADOS_DEL_INFORME)]
    if isinstance(proveedores, DataFrame):
        ids = proveedores.select(F.col(proveedores.columns[0]).alias("id_proveedor")).distinct()
        rows = ids.join(created.groupBy("id_proveedor").agg(*counts), "id_proveedor", "left")
        rows = rows.select("id_proveedor", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))
    else:
        rows = created.filter(F.col("id_proveedor") == proveedores).agg(*counts)
    rate = F.coalesce(_percent("reservas_canceladas", "total_reservas"), F.lit(0))
    return rows.withColumn("tasa_cancelacion", rate)


# logins ---------------------------------------------------------------------

def _failures_by_address(intentos: DataFrame, as_of: Instant, ventana_horas: float) -> DataFrame:
    """Failures per user and address; a flood from one address is one row."""
    now = instant(as_of)
    recent = F.col("fecha_hora") > shifted(now, hours=-ventana_horas)
    failed = intentos.filter(~F.col("exitoso") & recent & (F.col("fecha_hora") <= now))
    return failed.groupBy("id_usuario", "direccion_ip").agg(F.count("*").alias("n"), F.max("fecha_hora").alias("ultimo"))


def _recent_failures(intentos: DataFrame, as_of: Instant, ventana_horas: float, minimo: int, max_lista: int) -> DataFrame:
    by_address = _failures_by_address(intentos, as_of, ventana_horas)
    per_user = by_address.groupBy("id_usuario").agg(
        F.sum("n").alias("fallos"), F.max("ultimo").alias("ultimo"), F.count("direccion_ip").alias("direcciones"))
    hits = per_user.filter(F.col("fallos") >= minimo)
    listed = hits.filter(F.col("direcciones") <= max_lista).select("id_usuario")
    lists = by_address.join(listed, "id_usuario", "left_semi").groupBy("id_usuario").agg(
        F.array_join(F.array_sort(F.collect_list("direccion_ip")), ", ").alias("ips"))
    return hits.join(lists, "id_usuario", "left")


def intentos_fallidos_recientes(usuarios: DataFrame, intentos: DataFrame, as_of: Instant = None,
                                ventana_horas: float = VENTANA_HORAS, minimo: int = MINIMO_FALLOS,
                                max_lista: int = MAX_LISTA) -> DataFrame:
    """Users with at least ``minimo`` failed logins strictly newer than the window's start.

    ``ips_utilizadas`` lists the addresses of a user that has up to ``max_lista``
    and is NULL beyond, as an attacker can use any number; ``direcciones`` counts
    them and ``direcciones_fallidas_recientes`` has them all, one row each.
    """
    hits = _recent_failures(intentos, as_of, ventana_horas, minimo, max_lista)
    return hits.join(usuarios.select("id_usuario", "email"), "id_usuario").select(
        "id_usuario", "email", F.col("fallos").alias("intentos_fallidos_count"),
        F.col("ultimo").alias("ultimo_intento"), F.col("ips").alias("ips_utilizadas"), "direcciones")


def direcciones_fallidas_recientes(intentos: DataFrame, as_of: Instant = None, ventana_horas: float = VENTANA_HORAS,
                                   minimo: int = MINIMO_FALLOS) -> DataFrame:
    """Every address with failures of the users that ``intentos_fallidos_recientes`` names."""
    by_address = _failures_by_address(intentos, as_of, ventana_horas)
    over = by_address.groupBy("id_usuario").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= minimo)
    return by_address.join(over, "id_usuario", "left_semi").select(
        "id_usuario", "direccion_ip", F.col("n").alias("fallos"), F.col("ultimo").alias("ultimo_intento"))


def usuarios_sospechosos(usuarios: DataFrame, intentos: DataFrame, as_of: Instant = None,
                         ventana_horas: float = VENTANA_HORAS, minimo: int = MINIMO_FALLOS,
                         max_lista: int = MAX_LISTA) -> DataFrame:
    """The same users with their account columns, most failures first."""
    hits = _recent_failures(intentos, as_of, ventana_horas, minimo, max_lista)
    account = usuarios.select("id_usuario", "email", "estado", "intentos_fallidos", "bloqueado_hasta")
    return hits.join(account, "id_usuario").select(
        *account.columns, F.col("fallos").alias("intentos_ultima_hora"),
        F.col("ultimo").alias("ultimo_intento_fallido"), F.col("ips").alias("ips_origen"), "direcciones").orderBy(
        F.desc("intentos_ultima_hora"))


# employees ------------------------------------------------------------------

def _counted(rows: DataFrame, column: Column, name: str) -> DataFrame:
    return rows.groupBy("id_empleado").agg(column.alias(name))


def _attach(base: DataFrame, *counts: DataFrame) -> DataFrame:
    """``base`` with per-employee counts, 0 where there are none.

    Each branch is reduced before the join, so the branches never multiply.
    """
    for side in counts:
        name = side.columns[1]
        base = base.join(side, "id_empleado", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return base


def empleados_activos_por_proveedor(empleados: DataFrame, asignaciones: DataFrame, horarios: DataFrame,
                                    bloqueos: DataFrame, as_of: Instant = None) -> DataFrame:
    ahead = bloqueos.filter(F.col("activo") & (F.col("fecha") >= day(as_of)))
    base = empleados.filter("activo").select("id_empleado", "id_proveedor", "nombre_completo", "telefono",
                                             "fecha_contratacion")
    return _attach(
        base,
        _counted(asignaciones.filter("activo"), F.count_distinct("id_servicio"), "total_servicios_asignados"),
        _counted(horarios.filter("activo"), F.count("id_horario"), "total_horarios_laborales"),
        _counted(ahead, F.count("id_bloqueo"), "total_bloqueos_futuros"))


def listar_empleados_activos(empleados: DataFrame, asignaciones: DataFrame, horarios: DataFrame,
                             id_proveedor: Ids) -> DataFrame:
    staff, keep = pick(empleados.filter("activo"), "id_proveedor", id_proveedor)
    base = staff.select(*keep, "id_empleado", "nombre_completo", "telefono", "fecha_contratacion")
    return _attach(
        base,
        _counted(asignaciones.filter("activo"), F.count_distinct("id_servicio"), "servicios_asignados"),
        _counted(horarios.filter("activo"), F.count("id_horario"), "dias_horario_configurados"),
    ).orderBy("nombre_completo")


def empleados_por_proveedor(empleados: DataFrame, asignaciones: DataFrame, id_proveedor: Ids,
                            solo_activos: bool = True) -> DataFrame:
    staff, keep = pick(empleados.filter("activo") if solo_activos else empleados, "id_proveedor", id_proveedor)
    base = staff.select(*keep, "id_empleado", "nombre_completo", "telefono", "activo")
    return _attach(base, _counted(asignaciones.filter("activo"), F.count_distinct("id_servicio"),
                                  "total_servicios_asignados")).orderBy("nombre_completo")


# storage profile ------------------------------------------------------------

# Row-store page model (bytes).
PAGINA = 8192
PAGINA_UTIL = 8092
CABECERA_FILA = 23
PUNTERO = 4


def fixed_bytes(table: str) -> int:
    """Bytes of a row that do not depend on its text: pointers, fixed columns, null bitmap, header."""
    columns = TABLES[table].columns
    variable = sum(KINDS[c.kind].width is None for c in columns)
    fixed = sum(KINDS[c.kind].width or 0 for c in columns)
    bitmap = -(-sum(c.nullable and c.name not in ("created_at", "updated_at") for c in columns) // 8)
    return PUNTERO * variable + fixed + bitmap + CABECERA_FILA


def declared_bytes(table: str) -> int:
    """Record length when every text column is as long as its declaration allows."""
    texts = [c for c in TABLES[table].columns if KINDS[c.kind].width is None]
    return fixed_bytes(table) + sum((c.max_len or 0) + 4 for c in texts)


def table_volume_profile(rows: DataFrame, table: str) -> DataFrame:
    """One row: rows, record bytes, rows per page, pages and bytes of a real table."""
    texts = [c.name for c in TABLES[table].columns if KINDS[c.kind].width is None]
    length = F.lit(0).cast("long")
    for name in texts:
        length = length + F.coalesce(F.octet_length(name) + 4, F.lit(0))
    base = F.lit(fixed_bytes(table)).cast("double")
    measured = rows.select(length.alias("v")).agg(
        F.count("*").alias("filas"), F.avg(F.col("v").cast("double")).alias("v_avg"), F.max("v").alias("v_max"))
    sized = measured.select(
        F.lit(table).alias("tabla"), "filas", (base + F.col("v_avg")).alias("registro_promedio"),
        (base + F.col("v_max")).cast("long").alias("registro_maximo"))
    per_page = F.floor(F.lit(float(PAGINA_UTIL)) / (F.col("registro_promedio") + PUNTERO))
    paged = sized.withColumn("filas_por_pagina", per_page)
    pages = F.coalesce(F.ceil(F.col("filas").cast("double") / F.col("filas_por_pagina")), F.lit(0))
    return paged.withColumn("paginas", pages).withColumn("bytes", F.col("paginas") * PAGINA)


def volume_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """The storage profile of every table, one row each."""
    profiles = [table_volume_profile(rows, name) for name, rows in tables.items()]
    result = profiles[0]
    for profile in profiles[1:]:
        result = result.unionByName(profile)
    return result
