"""Booking tables derived from a star-schema parquet folder.

Customers, suppliers and nations become the three account types, parts become
services, order lines become bookings and the event log becomes the login and
token logs.  ``Marketplace`` is lazy: each attribute is a fresh plan, so a
query scans only the files and columns it uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnero.functions.clock import plus_minutes, shifted
from turnero.session import stored_once
from turnero.sources.schemas import CATEGORIAS_INICIALES, DIAS_SEMANA, ESTADOS_RESERVA, RESERVA_ACTIVA
from turnero.sources.tables import literal_rows, with_defaults

# Fixed clocks at which the derived tables are examined.
AS_OF_BOOKING = "1998-06-15 00:00:00"
AS_OF_AUTH = "2024-01-30 00:00:00"
REGISTERED = "2023-01-01 00:00:00"

# Order lines of a part while bookings are derived, at most on average.
LINES_PER_PART = 1_000_000

# Declared, so that reading a file starts no job to infer its schema.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

TABLE_NAMES = (
    "usuario", "cliente", "proveedor", "admin", "intento_login", "token_refresh", "token_reset_password",
    "email_verification_token", "categoria_servicio", "servicio", "empleado", "empleado_servicio",
    "horario_laboral", "bloqueo_horario", "reserva",
)


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), *(p.cast("string") for p in parts))


def _phone(key: Column) -> Column:
    return F.when(key % 4 != 0, F.concat(F.lit("+57 300 "), key.cast("string")))


class Marketplace:
    """The fifteen booking tables and the principals over ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLE_NAMES}

    def _stamped(self, rows: DataFrame, table: str, created: Column | str = REGISTERED) -> DataFrame:
        moment = _ntz(created) if isinstance(created, str) else created
        return with_defaults(rows.withColumns({"created_at": moment, "updated_at": moment}), table, REGISTERED,
                             fill_nulls=False)

    # accounts ---------------------------------------------------------------

    @cached_property
    def usuario(self) -> DataFrame:
        def account(source: str, key: str, prefix: str, kind: str) -> DataFrame:
            return self.source(source).select(F.col(key).cast("long").alias("k"), F.lit(prefix).alias("prefix"),
                                              F.lit(kind).alias("tipo_usuario"))

        people = account("customer", "c_custkey", "C", "CLIENTE").unionByName(
            account("supplier", "s_suppkey", "P", "PROVEEDOR")).unionByName(
            account("nation", "n_nationkey", "A", "ADMIN"))
        key = F.col("k")
        estado = (F.when(key % 10 == 0, "INACTIVO").when(key % 10 == 1, "SUSPENDIDO")
                  .when(key % 10 == 2, "BLOQUEADO").otherwise("ACTIVO"))
        uid = F.concat("prefix", key.cast("string"))
        rows = people.select(
            uid.alias("id_usuario"),
            F.concat(F.lower(uid), F.lit("@example.test")).alias("email"),
            F.md5(uid).alias("password_hash"),
            (key % 3 != 0).alias("email_verificado"),
            (key % 7).cast("int").alias("intentos_fallidos"),
            F.when(key % 10 == 2, _ntz("2024-02-01 00:00:00")).alias("bloqueado_hasta"),
            _ntz(REGISTERED).alias("fecha_registro"),
            estado.alias("estado"),
            "tipo_usuario",
        )
        return self._stamped(rows, "usuario")

    @cached_property
    def cliente(self) -> DataFrame:
        key = F.col("c_custkey")
        rows = self.source("customer").select(
            _id("C", key).alias("id_usuario"), F.col("c_name").alias("nombre"), _phone(key).alias("telefono"))
        return self._stamped(rows, "cliente")

    @cached_property
    def proveedor(self) -> DataFrame:
        key = F.col("s_suppkey")
        rows = self.source("supplier").select(
            _id("P", key).alias("id_usuario"), F.col("s_name").alias("nombre_comercial"),
            _id("K", F.col("s_nationkey") % 10).alias("id_categoria"),
            F.lit(None).cast("string").alias("direccion"), _phone(key).alias("telefono_contacto"))
        return self._stamped(rows, "proveedor")

    @cached_property
    def admin(self) -> DataFrame:
        key = F.col("n_nationkey")
        rows = self.source("nation").select(
            _id("A", key).alias("id_usuario"), F.col("n_name").alias("nombre_completo"),
            _id("EMP-", key).alias("codigo_empleado"), _phone(key).alias("telefono"),
            (_ntz(REGISTERED) + F.make_dt_interval(key.cast("int"))).alias("fecha_asignacion"),
            (key % 5 != 0).alias("activo"),
            F.when(F.col("n_regionkey") != key, _id("A", F.col("n_regionkey"))).alias("creado_por"))
        return self._stamped(rows, "admin")

    @cached_property
    def auth_users(self) -> DataFrame:
        """Session identities: account id and JSON metadata (role, tipo_usuario)."""
        people = self.usuario.select(
            F.col("id_usuario").alias("id"),
            F.when(F.col("id_usuario") == "A0", "admin").alias("role"), "tipo_usuario")
        staff = literal_rows(
            self.spark, "id string, role string, tipo_usuario string",
            [("X1", "soporte", None), ("X2", "security", None), ("X3", "service_account", None)])
        return people.unionByName(staff).select(
            "id", F.to_json(F.struct("role", "tipo_usuario")).alias("raw_user_meta_data"))

    # catalogue --------------------------------------------------------------

    @cached_property
    def categoria_servicio(self) -> DataFrame:
        """The seed categories, and one for every brand of part."""
        rows = literal_rows(
            self.spark, "id_categoria string, nombre_categoria string, descripcion string, activa boolean",
            [(f"K{i}", name, text, i != 9) for i, (name, text) in enumerate(CATEGORIAS_INICIALES)])
        brand = F.col("p_brand")
        brands = self.source("part").select(brand).distinct().select(
            _id("KB-", brand).alias("id_categoria"), brand.alias("nombre_categoria"), F.lit("Marca").alias("descripcion"),
            (F.length(brand) % 2 == 0).alias("activa"))
        return self._stamped(rows.unionByName(brands), "categoria_servicio")

    @cached_property
    def servicio(self) -> DataFrame:
        providers = self.source("supplier").agg(F.count("*")).scalar()
        size, key = F.col("p_size"), F.col("p_partkey")
        rows = self.source("part").select(
            _id("S", key).alias("id_servicio"), _id("P", key % providers).alias("id_proveedor"),
            F.col("p_name").alias("nombre_servicio"),
            (15 * (1 + size % 8)).alias("duracion_minutos"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("precio"),
            F.col("p_type").alias("descripcion"),
            (size % 5 != 0).alias("activo"),
            F.when(size % 6 == 0, 1 + size % 10).otherwise(1).alias("capacidad_maxima"))
        return self._stamped(rows, "servicio")

    # schedules --------------------------------------------------------------

    def _staff(self) -> DataFrame:
        """One row per employee: supplier key ``p``, slot ``j``, employee number ``n``."""
        slots = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
        return self.source("supplier").select(F.col("s_suppkey").alias("p"), "s_name", slots.alias("j")).withColumn(
            "n", 3 * F.col("p") + F.col("j"))

    @cached_property
    def empleado(self) -> DataFrame:
        rows = self._staff().select(
            _id("E", F.col("n")).alias("id_empleado"), _id("P", F.col("p")).alias("id_proveedor"),
            F.concat_ws(" / ", F.col("s_name"), F.col("j").cast("string")).alias("nombre_completo"),
            _phone(F.col("n")).alias("telefono"),
            ((F.col("p") + F.col("j")) % 7 != 0).alias("activo"),
            _ntz(REGISTERED).alias("fecha_contratacion"))
        return self._stamped(rows, "empleado")

    @cached_property
    def empleado_servicio(self) -> DataFrame:
        pairs = self.source("lineitem").select(
            (3 * F.col("l_suppkey") + F.col("l_linenumber") % 3).alias("n"), "l_partkey").distinct()
        rows = pairs.select(
            _id("ES", F.col("n"), F.lit("-"), F.col("l_partkey")).alias("id_empleado_servicio"),
            _id("E", F.col("n")).alias("id_empleado"), _id("S", F.col("l_partkey")).alias("id_servicio"),
            (F.col("l_partkey") % 4 != 0).alias("activo"),
            (_ntz(REGISTERED) + F.make_dt_interval((F.col("l_partkey") % 365).cast("int")))
            .alias("fecha_asignacion"))
        return self._stamped(rows, "empleado_servicio")

    @cached_property
    def horario_laboral(self) -> DataFrame:
        def block(number: int, start: int, end: int) -> Column:
            return F.struct(F.lit(number).alias("b"), F.lit(start).alias("hora_inicio"), F.lit(end).alias("hora_fin"))

        days = self._staff().select("n", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("d"))
        blocks = (F.when(F.col("d") == 6, F.array(block(0, 540, 840)))
                  .when(F.col("n") % 4 == 0, F.array(block(0, 480, 720), block(1, 780, 1080)))
                  .otherwise(F.array(block(0, 480, 1080))))
        names = F.array(*(F.lit(d) for d in DIAS_SEMANA))
        rows = days.select("n", "d", F.inline(blocks)).select(
            _id("H", F.col("n"), F.lit("-"), F.col("d"), F.lit("-"), F.col("b")).alias("id_horario"),
            _id("E", F.col("n")).alias("id_empleado"),
            F.element_at(names, F.col("d")).alias("dia_semana"), "hora_inicio", "hora_fin",
            ((F.col("n") + F.col("d")) % 9 != 0).alias("activo"))
        return self._stamped(rows, "horario_laboral")

    @cached_property
    def bloqueo_horario(self) -> DataFrame:
        day_minute = F.hour("fecha_hora_inicio") * 60 + F.minute("fecha_hora_inicio")
        length = F.timestamp_diff("MINUTE", F.col("fecha_hora_inicio"), F.col("fecha_hora_fin"))
        booked = self._bookings().filter(F.col("estado").isin(*RESERVA_ACTIVA)).select(
            F.concat(F.lit("B"), "id_reserva").alias("id_bloqueo"), "id_empleado", "id_reserva",
            F.col("fecha_hora_inicio").cast("date").alias("fecha"),
            day_minute.cast("int").alias("hora_inicio"), (day_minute + length).cast("int").alias("hora_fin"),
            F.lit("RESERVA").alias("tipo_bloqueo"), (F.col("l_orderkey") % 8 != 0).alias("activo"))
        away = self._staff().filter(F.col("n") % 11 == 0).select(
            _id("BV", F.col("n")).alias("id_bloqueo"), _id("E", F.col("n")).alias("id_empleado"),
            F.lit(None).cast("string").alias("id_reserva"), _ntz(AS_OF_BOOKING).cast("date").alias("fecha"),
            F.lit(0).alias("hora_inicio"), F.lit(1439).alias("hora_fin"),
            F.lit("VACACIONES").alias("tipo_bloqueo"), F.lit(True).alias("activo"))
        return self._stamped(booked.unionByName(away), "bloqueo_horario")

    # bookings ---------------------------------------------------------------

    def raw_bookings(self) -> DataFrame:
        """Every order line as a booking, before repeated line numbers are reduced."""
        return self._lines().join(self._orders(), "l_orderkey")

    def _lines(self) -> DataFrame:
        return self.source("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")

    def _orders(self) -> DataFrame:
        return self.source("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")

    def _bookings(self) -> DataFrame:
        """One booking per (order, line number): the first of the lines that share it.

        The only derived table that needs a join and a reduction, so it is
        stored once, without what follows from a row alone: most ids and the
        rest are made when it is read.  The lines move once, by order: the reduction
        and the join both find them there, sorted once for the two, in parts
        that follow their number, so that a part is sorted in memory.
        """
        def build() -> DataFrame:
            first = F.min(F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_quantity"))
            lines, orders = self._lines().filter("l_orderkey IS NOT NULL"), self._orders().filter("l_orderkey IS NOT NULL")
            parts = -(-self.source("lineitem").count() // LINES_PER_PART)  # the files' footers have the count
            if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
                lines, orders = (x.repartition(parts, "l_orderkey") for x in (lines, orders))
            else:
                lines = lines.repartition("l_orderkey")
            lines = lines.groupBy("l_orderkey", "l_linenumber").agg(first.alias("f"))
            return self._timed(lines.select("l_orderkey", "l_linenumber", "f.*").join(orders, "l_orderkey"))
        return self._as_bookings(stored_once(self.spark, self.folder, "reserva", build))

    def _timed(self, lines: DataFrame) -> DataFrame:
        """The lines with what filters of bookings ask for: client, start, state, creation."""
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        states = F.array(*(F.lit(s) for s in ESTADOS_RESERVA))
        return lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            _id("C", F.col("o_custkey")).alias("id_cliente"),
            plus_minutes(F.col("l_shipdate"), 480 + (37 * order + 53 * line) % 600).alias("fecha_hora_inicio"),
            F.element_at(states, ((order + line) % 6 + 1).cast("int")).alias("estado"),
            F.least("o_orderdate", "l_shipdate").alias("fecha_creacion"))

    def _as_bookings(self, lines: DataFrame) -> DataFrame:
        order, line, created = F.col("l_orderkey"), F.col("l_linenumber"), F.col("fecha_creacion")
        return lines.select(
            "l_orderkey",
            _id("R", order, F.lit("-"), line).alias("id_reserva"),
            "id_cliente", _id("S", F.col("l_partkey")).alias("id_servicio"),
            _id("E", 3 * F.col("l_suppkey") + line % 3).alias("id_empleado"),
            _id("P", F.col("l_suppkey")).alias("id_proveedor"),
            "fecha_hora_inicio",
            plus_minutes(F.col("fecha_hora_inicio"), 15 + 3 * F.col("l_quantity")).alias("fecha_hora_fin"),
            "estado",
            "fecha_creacion",
            F.when((order + line) % 6 == 4, shifted(created, hours=1)).alias("fecha_cancelacion"),
            F.when(line % 4 != 0, F.concat(F.lit("linea "), line.cast("string"))).alias("comentarios"),
        )

    @cached_property
    def reserva(self) -> DataFrame:
        return self._stamped(self._bookings(), "reserva", F.col("fecha_creacion"))

    @cached_property
    def reserva_sin_depurar(self) -> DataFrame:
        """The booking feed with the line numbers its source repeats."""
        return self._stamped(self._as_bookings(self._timed(self.raw_bookings())), "reserva", F.col("fecha_creacion"))

    # logs -------------------------------------------------------------------

    def _events(self, kind: str | None = None) -> DataFrame:
        events = self.source("events").select("event_id", "ts", "user_id", "event_type")
        return events if kind is None else events.filter(F.col("event_type") == kind)

    @cached_property
    def intento_login(self) -> DataFrame:
        return login_log(self._events())

    @cached_property
    def token_refresh(self) -> DataFrame:
        revoked = F.col("event_id") % 5 == 0
        rows = self._events("click").select(
            _id("T", F.col("event_id")).alias("id_token"), _id("C", F.col("user_id")).alias("id_usuario"),
            F.md5(F.col("event_id").cast("string")).alias("token"), F.col("ts").alias("fecha_creacion"),
            shifted(F.col("ts"), days=7).alias("fecha_expiracion"), revoked.alias("revocado"),
            F.when(revoked, shifted(F.col("ts"), hours=1)).alias("fecha_revocacion"),
            F.lit("web").alias("info_dispositivo"), _id("10.0.0.", F.col("event_id") % 17).alias("direccion_ip"))
        return self._stamped(rows, "token_refresh", F.col("fecha_creacion"))

    @cached_property
    def token_reset_password(self) -> DataFrame:
        used = F.col("event_id") % 3 == 0
        rows = self._events("view").select(
            _id("W", F.col("event_id")).alias("id_token"), _id("C", F.col("user_id")).alias("id_usuario"),
            F.md5(F.col("event_id").cast("string")).alias("token"), F.col("ts").alias("fecha_creacion"),
            shifted(F.col("ts"), days=1).alias("fecha_expiracion"), used.alias("usado"),
            F.when(used, shifted(F.col("ts"), hours=1)).alias("fecha_uso"),
            _id("10.0.0.", F.col("event_id") % 17).alias("direccion_ip_solicitud"))
        return self._stamped(rows, "token_reset_password", F.col("fecha_creacion"))

    @cached_property
    def email_verification_token(self) -> DataFrame:
        last = self._events("signup").groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("e"))
        rows = last.select(
            _id("V", F.col("e.event_id")).alias("id_token"), _id("C", F.col("user_id")).alias("id_usuario"),
            F.md5(F.col("e.event_id").cast("string")).alias("token"), F.col("e.ts").alias("fecha_creacion"),
            shifted(F.col("e.ts"), days=1).alias("fecha_expiracion"),
            (F.col("e.event_id") % 2 == 0).alias("usado"))
        return self._stamped(rows, "email_verification_token", F.col("fecha_creacion"))


def login_log(events: DataFrame) -> DataFrame:
    """Login attempts from an event log, batch or streaming."""
    failed = F.col("event_type") == "error"
    rows = events.select(
        _id("L", F.col("event_id")).alias("id_intento"), _id("C", F.col("user_id")).alias("id_usuario"),
        F.col("ts").alias("fecha_hora"), (~failed).alias("exitoso"),
        _id("10.0.0.", F.col("event_id") % 17).alias("direccion_ip"), F.lit("web").alias("info_dispositivo"),
        F.when(failed, "credenciales").alias("mensaje_error"), F.col("ts").alias("created_at"))
    return with_defaults(rows, "intento_login", REGISTERED, fill_nulls=False)
