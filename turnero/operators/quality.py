"""Integrity rules as data-quality reports.

Every report has the columns ``tabla``, ``regla`` and ``clave`` (the key of the
offending row).  As in SQL, a rule that evaluates to NULL is not broken.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.operators.joins import reservas_en_conflicto
from turnero.sources.schemas import RESERVA_ACTIVA, TABLES

# Moves of a booking that the documented flow, cancellation and
# rescheduling allow.
PASOS_RESERVA = (
    ("PENDIENTE", "CONFIRMADA"),
    ("CONFIRMADA", "EN_PROGRESO"),
    ("EN_PROGRESO", "COMPLETADA"),
    ("CONFIRMADA", "NO_SHOW"),
    ("EN_PROGRESO", "NO_SHOW"),
    *((state, "CANCELADA") for state in RESERVA_ACTIVA),
    *((state, "PENDIENTE") for state in RESERVA_ACTIVA),
)


#: Values that a task of the uniqueness check holds, about.
KEYS_PER_TASK = 1_000_000


def row_rules(table: str) -> dict[str, Column]:
    """Rule name -> "this row breaks it" for every single-row rule of a table."""
    spec = TABLES[table]
    rules: dict[str, Column] = {}
    for column in spec.columns:
        value = F.col(column.name)
        if not column.nullable:
            rules[f"{column.name}_no_nulo"] = value.isNull()
        if column.max_len:
            rules[f"{column.name}_largo"] = F.length(value) > column.max_len
        if column.allowed:
            rules[f"{column.name}_valor"] = ~value.isin(*column.allowed)
    for name, predicate in spec.checks.items():
        rules[name] = ~F.expr(predicate)
    return rules


def broken_rules(table: str) -> Column:
    """Array with the names of the rules a row breaks."""
    names = [F.when(broken, F.lit(name)) for name, broken in row_rules(table).items()]
    return F.array_compact(F.array(*names))


def _report(rows: DataFrame, table: str, rule: Column | str, key: Column | str) -> DataFrame:
    name = F.lit(rule) if isinstance(rule, str) else rule
    value = F.col(key) if isinstance(key, str) else key
    return rows.select(F.lit(table).alias("tabla"), name.alias("regla"), value.cast("string").alias("clave"))


def _union(reports: Iterable[DataFrame]) -> DataFrame:
    result = None
    for report in reports:
        result = report if result is None else result.unionByName(report)
    return result


def check_rows(rows: DataFrame, table: str) -> DataFrame:
    """Rows that break a check, a length, an enumeration or a NOT NULL; one scan per table."""
    exploded = rows.select(F.col(TABLES[table].key).alias("_key"), F.explode(broken_rules(table)).alias("_rule"))
    return _report(exploded, table, F.col("_rule"), "_key")


def check_all_rows(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(check_rows(rows, name) for name, rows in tables.items())


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Values of a primary key or UNIQUE column that occur more than once (``clave`` is the value).

    One pass over each table, and one aggregation.  Keys hardly repeat, so of many rows a task would hold nearly
    all it reads: these are counted after the shuffle, in as many parts as keep each near ``KEYS_PER_TASK`` values.
    """
    values, found = [], []
    for name, rows in tables.items():
        spec = TABLES[name]
        columns = [spec.key, *(c for c in spec.unique if c != spec.key)]
        pairs = F.array(*(F.struct(F.lit(f"{c}_unico").alias("regla"), F.col(c).cast("string").alias("clave")) for c in columns))
        values.append(rows.select(F.lit(name).alias("tabla"), F.inline(pairs)).filter("clave IS NOT NULL"))
        found.append(rows.agg((F.count("*") * len(columns)).alias("n")))
    keys = _union(values)
    parts = -(-(_union(found).agg(F.sum("n")).first()[0] or 0) // KEYS_PER_TASK)
    if parts > 2:
        keys = keys.repartition(parts, "tabla", "regla", "clave")
    counted = keys.groupBy("tabla", "regla", "clave").agg(F.count("*").alias("n"))
    return counted.filter("n > 1").drop("n")


def _orphans(tables: dict[str, DataFrame], kind: str) -> DataFrame:
    reports = []
    for name, rows in tables.items():
        links = TABLES[name].parents if kind == "fk" else TABLES[name].logical_parents
        for column, parent in links.items():
            if parent not in tables:
                continue
            key = tables[parent].select(F.col(TABLES[parent].key).alias("_p"))
            child = rows.filter(F.col(column).isNotNull()).select(F.col(TABLES[name].key).alias("_key"), column)
            lost = child.join(key, F.col(column) == F.col("_p"), "left_anti")
            reports.append(_report(lost, name, f"{column}_{parent}", "_key"))
    return _union(reports)


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose parent is missing, for keys the database itself enforces."""
    return _orphans(tables, "fk")


def check_logical_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose parent is missing, for references that cross databases."""
    return _orphans(tables, "logical")


def check_subtypes(usuarios: DataFrame, profiles: dict[str, DataFrame]) -> DataFrame:
    """Client, provider and admin rows without an account of that type."""
    reports = []
    for name, rows in profiles.items():
        fitting = usuarios.filter(F.col("tipo_usuario") == name.upper()).select("id_usuario")
        misfit = rows.select("id_usuario").join(fitting, "id_usuario", "left_anti")
        reports.append(_report(misfit, name, "tipo_usuario", "id_usuario"))
    return _union(reports)


def check_state_path(antes: DataFrame, despues: DataFrame,
                     pasos: Iterable[tuple[str, str]] = PASOS_RESERVA) -> DataFrame:
    """Bookings whose state changed along a step that is not allowed; ``regla`` names the step."""
    new = despues.select("id_reserva", F.col("estado").alias("_new"))
    moved = antes.select("id_reserva", "estado").join(new, "id_reserva").filter(F.col("estado") != F.col("_new"))
    step = F.concat("estado", F.lit("->"), "_new")
    allowed = [f"{a}->{b}" for a, b in pasos]
    return _report(moved.filter(~step.isin(*allowed)), "reserva", step, "id_reserva")


def check_overlaps(reservas: DataFrame) -> DataFrame:
    """Active bookings that overlap another one of the same employee."""
    hits = reservas_en_conflicto(reservas)
    return _report(hits, "reserva", "sin_solape", "id_reserva")


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row rules, uniqueness, references and overlaps of a whole database in one frame."""
    profiles = {n: tables[n] for n in ("cliente", "proveedor", "admin") if n in tables}
    parts = [check_all_rows(tables), check_unique(tables), check_foreign_keys(tables), check_logical_keys(tables)]
    if "usuario" in tables and profiles:
        parts.append(check_subtypes(tables["usuario"], profiles))
    if "reserva" in tables:
        parts.append(check_overlaps(tables["reserva"]))
    return _union(p for p in parts if p is not None)
