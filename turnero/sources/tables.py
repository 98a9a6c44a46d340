"""Ingest and storage of booking tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnero.functions.clock import Instant, instant, shifted
from turnero.sources.schemas import NEW_ID, NOW, TABLES

VERIFICATION_HOURS = 24


def _default(column, as_of: Instant) -> Column | None:
    if column.default == NOW:
        return instant(as_of)
    if column.default == NEW_ID:
        return F.uuid()
    return None if column.default is None else F.lit(column.default)


def with_defaults(rows: DataFrame, table: str, as_of: Instant = None, fill_nulls: bool = True) -> DataFrame:
    """``rows`` in the table's column order and types.

    Absent columns take the declared default.  With ``fill_nulls`` (ingest) so
    do NULLs of NOT NULL columns; stored tables are read without it, so that
    filters on their columns still reach the scan.  A present key is never
    generated, and an explicit NULL in a nullable column stays NULL.
    """
    present = set(rows.columns)
    schema = TABLES[table].schema()
    cells = []
    for column in TABLES[table].columns:
        spark_type, default = schema[column.name].dataType, _default(column, as_of)
        if column.name not in present:
            value = F.lit(None) if default is None else default
        else:
            value = F.col(column.name)
            if isinstance(spark_type, T.TimestampNTZType):
                value = _utc(value, rows.schema[column.name].dataType)
            if fill_nulls and default is not None and not column.nullable and column.default != NEW_ID:
                value = F.coalesce(value, default)
        cells.append(value.cast(spark_type).alias(column.name))
    return rows.select(*cells)


def _utc(value: Column, stored: T.DataType) -> Column:
    if isinstance(stored, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))
    return value


def literal_rows(spark: SparkSession, schema: str, rows: Iterable[tuple]) -> DataFrame:
    """A handful of fixed rows as a plan of literals, which the optimizer can size and fold."""
    names = [field.split() for field in schema.split(",")]
    structs = [F.struct(*(F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, names))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def load_table(spark: SparkSession, path: str, table: str, as_of: Instant = None,
               fill_nulls: bool = True) -> DataFrame:
    """A parquet table as a typed frame with its declared defaults filled in."""
    return with_defaults(spark.read.parquet(path), table, as_of, fill_nulls)


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: Iterable[str], order: str) -> DataFrame:
    """Append the rows of ``batch`` whose natural key is new.

    Of rows that repeat a key within the batch the first by ``order`` counts.
    """
    keys = list(keys)
    first = Window.partitionBy(*keys).orderBy(order)
    single = batch.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    fresh = single.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def register_profiles(usuarios: DataFrame, registros: DataFrame, table: str, as_of: Instant = None) -> DataFrame:
    """Profile rows for a batch of sign-ups that know only the account's email."""
    found = registros.join(usuarios.select("email", "id_usuario"), "email")
    return with_defaults(found, table, as_of)


def issue_verification_tokens(usuarios: DataFrame, registros: DataFrame, as_of: Instant = None,
                              hours: int = VERIFICATION_HOURS) -> DataFrame:
    """Verification-token rows for sign-ups (email, id_token, token), valid for ``hours``."""
    found = registros.join(usuarios.select("email", "id_usuario"), "email")
    stamped = found.withColumn("fecha_expiracion", shifted(instant(as_of), hours=hours))
    return with_defaults(stamped, "email_verification_token", as_of)


def append_batch(existing: DataFrame, batch: DataFrame, table: str,
                 as_of: Instant = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Insert a multi-row batch: (snapshot, inserted rows, rejected rows).

    A row is inserted when it breaks no rule of the table; the rejected rows
    carry the names of the rules they break in ``reglas``.
    """
    from turnero.operators.quality import broken_rules

    rows = with_defaults(batch, table, as_of).withColumn("reglas", broken_rules(table))
    inserted = rows.filter(F.size("reglas") == 0).drop("reglas")
    rejected = rows.filter(F.size("reglas") > 0)
    return existing.unionByName(inserted, allowMissingColumns=True), inserted, rejected


def write_by_date(facts: DataFrame, path: str, moment: str, order: Iterable[str], grain: str = "month",
                  files: int | None = None, mode: str = "overwrite") -> None:
    """Write facts in one folder per month (or day, year) of ``moment``.

    Range partitioning on (period, order keys) samples the data, so a busy
    period is cut into several files instead of one task, and each file is
    sorted for min/max pruning on the order keys.
    """
    keys = list(order)
    dated = facts.withColumn("periodo", F.date_trunc(grain, F.col(moment)).cast("date"))
    spread = dated.repartitionByRange(*([files] if files else []), "periodo", *keys)
    spread.sortWithinPartitions("periodo", *keys).write.mode(mode).partitionBy("periodo").parquet(path)
