"""The user-callable functions as temporary SQL functions, made from the operators.

A listing is declared by the operator that lists all rows, the column that the
function's first argument picks, and what each further argument asks of a column.
``register`` publishes the operator's rows as a view, reads the result's columns
off it, and writes the function as a filter of that view, which Spark inlines into
the caller's plan and pushes to the scan:

    SELECT * FROM servicios_de_proveedor('P1', false)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from turnero.operators import lists, stats
from turnero.sources.schemas import DIAS_SEMANA

Tables = dict[str, DataFrame]

_WEEKDAYS = "array(" + ", ".join(f"'{d}'" for d in DIAS_SEMANA) + ")"


@dataclass(frozen=True)
class Ask:
    """An argument: ``column test argument``; the test ``only`` keeps rows whose flag is set unless the argument is FALSE."""

    name: str
    kind: str
    column: str
    test: str = "="
    default: str | None = None

    def parameter(self) -> str:
        return f"{self.name} {self.kind}" + (f" DEFAULT {self.default}" if self.default else "")

    def clause(self) -> str:
        if self.test == "only":
            return f"(NOT {self.name} OR {self.column})"
        plain = f"{self.column} {self.test} {self.name}"
        return f"({self.name} IS NULL OR {plain})" if self.default == "NULL" else plain


@dataclass(frozen=True)
class Listing:
    rows: Callable[[Tables], DataFrame]
    key: str
    asks: tuple[Ask, ...] = ()


_ACTIVE_ONLY = Ask("solo_activos", "BOOLEAN", "activo", "only", "TRUE")
_ALWAYS = ("0001-01-01", "9999-12-31")

LISTINGS: dict[str, Listing] = {
    "servicios_de_proveedor": Listing(
        lambda t: lists.servicios_por_proveedor(t["servicio"], None, solo_activos=False), "id_proveedor", (_ACTIVE_ONLY,)),
    "servicios_de_empleado": Listing(
        lambda t: lists.servicios_por_empleado(t["empleado_servicio"], None, solo_activos=False), "id_empleado", (_ACTIVE_ONLY,)),
    "horario_de_empleado": Listing(
        lambda t: lists.horario_laboral_por_empleado(t["horario_laboral"], None, solo_activos=False), "id_empleado",
        (Ask("dia", "STRING", "dia_semana", default="NULL"), _ACTIVE_ONLY)),
    "bloqueos_de_empleado": Listing(
        lambda t: lists.bloqueos_por_empleado(t["bloqueo_horario"], None, _ALWAYS[0]), "id_empleado",
        (Ask("desde", "DATE", "fecha", ">=", "current_date()"), Ask("hasta", "DATE", "fecha", "<=", "NULL"))),
    "reservas_de_cliente": Listing(
        lambda t: lists.reservas_por_cliente(t["reserva"], None), "id_cliente", (Ask("en_estado", "STRING", "estado", default="NULL"),)),
    "reservas_de_empleado": Listing(
        lambda t: lists.reservas_por_empleado(t["reserva"], None, *_ALWAYS), "id_empleado",
        (Ask("desde", "TIMESTAMP_NTZ", "fecha_hora_inicio", ">="), Ask("hasta", "TIMESTAMP_NTZ", "fecha_hora_inicio", "<="))),
    "empleados_de_proveedor": Listing(
        lambda t: stats.empleados_por_proveedor(t["empleado"], t["empleado_servicio"], None, solo_activos=False), "id_proveedor",
        (_ACTIVE_ONLY,)),
}


def _listing(name: str, view: str, columns: list[tuple[str, str]], made: Listing) -> str:
    shown = [(c, kind) for c, kind in columns if c != made.key]
    asks = (Ask("de", "STRING", made.key), *made.asks)
    return (f"{name}({', '.join(a.parameter() for a in asks)}) RETURNS TABLE ({', '.join(f'{c} {kind}' for c, kind in shown)}) "
            f"RETURN SELECT {', '.join(c for c, _ in shown)} FROM {view} WHERE {' AND '.join(a.clause() for a in asks)}")


def _report() -> str:
    """A provider's bookings by state over a span of creation times; always one row."""
    counts = {"total_reservas": "count(*)"} | {
        stats.COLUMNA_ESTADO[s]: f"count_if(estado = '{s}')" for s in stats.ESTADOS_DEL_INFORME}
    rate = f"coalesce(round(try_divide(100.0 * {counts['reservas_canceladas']}, count(*)), 2), 0)"
    columns = ", ".join(f"{c} BIGINT" for c in counts)
    return (f"estadisticas_de_proveedor(de STRING, desde TIMESTAMP_NTZ, hasta TIMESTAMP_NTZ) "
            f"RETURNS TABLE ({columns}, tasa_cancelacion DECIMAL(7,2)) "
            f"RETURN SELECT {', '.join(counts.values())}, CAST({rate} AS DECIMAL(7,2)) "
            "FROM reserva WHERE id_proveedor = de AND fecha_creacion >= desde AND fecha_creacion <= hasta")


def _meet(one: tuple[str, str], two: tuple[str, str]) -> str:
    """Do two half-open spans overlap?"""
    return f"{one[0]} < {two[1]} AND {two[0]} < {one[1]}"


def _questions() -> list[str]:
    span = ("desde", "hasta")
    busy = ("SELECT 1 FROM reservas_en_pie AS r WHERE r.id_empleado = de AND (salvo IS NULL OR r.id_reserva <> salvo) AND "
            + _meet(("r.fecha_hora_inicio", "r.fecha_hora_fin"), span))
    duty = (f"SELECT 1 FROM horarios_vigentes AS h WHERE h.id_empleado = de AND h.dia_semana = {_WEEKDAYS}[weekday(dia)] "
            "AND h.hora_inicio <= desde AND h.hora_fin >= hasta")
    away = ("SELECT 1 FROM bloqueos_vigentes AS b WHERE b.id_empleado = de AND b.fecha = dia AND "
            + _meet(("b.hora_inicio", "b.hora_fin"), span))
    return [
        f"hay_conflicto(de STRING, desde TIMESTAMP_NTZ, hasta TIMESTAMP_NTZ, salvo STRING DEFAULT NULL) RETURNS BOOLEAN RETURN EXISTS ({busy})",
        f"esta_disponible(de STRING, dia DATE, desde INT, hasta INT) RETURNS BOOLEAN RETURN EXISTS ({duty}) AND NOT EXISTS ({away})",
    ]


def _roles() -> list[str]:
    return [f"{name}(quien STRING, cual STRING) RETURNS BOOLEAN RETURN EXISTS (SELECT 1 FROM principal WHERE uid = quien AND {column} = cual)"
            for name, column in (("tiene_rol", "role"), ("es_de_tipo", "tipo_usuario"))]


def register(spark: SparkSession, tables: Tables, principals: DataFrame | None = None) -> list[str]:
    """Create the views and functions; returns the function names."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    lists.active_bookings(tables["reserva"]).createOrReplaceTempView("reservas_en_pie")
    tables["horario_laboral"].filter("activo").createOrReplaceTempView("horarios_vigentes")
    tables["bloqueo_horario"].filter("activo").createOrReplaceTempView("bloqueos_vigentes")
    made = []
    for name, listing in LISTINGS.items():
        rows = listing.rows(tables)
        rows.createOrReplaceTempView(f"todo_{name}")
        made.append(_listing(name, f"todo_{name}", rows.dtypes, listing))
    made += [_report(), *_questions()]
    if principals is not None:
        principals.createOrReplaceTempView("principal")
        made += _roles()
    for text in made:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
    return [text.split("(")[0] for text in made]
