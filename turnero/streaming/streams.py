"""Structured Streaming forms of the monitors, the change log and the audit.

Each function declares a streaming plan over an unbounded frame; ``run`` starts
one and waits.  Aggregations are bounded by a watermark.  ``run_windows`` writes
each window whenever it changes, so the windows still open at the end are there
too; ``newest_windows`` reads the last state of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from turnero.operators.changes import audit_rows
from turnero.operators.stats import MINIMO_FALLOS
from turnero.session import materialize, shared_dir


def event_time(moment: Column) -> Column:
    """A UTC wall-clock column as the TIMESTAMP that watermarks require."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), moment).cast("timestamp")


def wall_clock(moment: Column) -> Column:
    """Back from TIMESTAMP to UTC wall clock."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        files_per_trigger: int | None = None) -> DataFrame:
    """Files that land in ``path``, which may be a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what is available into a parquet folder, then stop."""
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """Table ``name`` of a folder as a stream, one file or a folder of part files.

    A stream wants a folder or a glob, so the last letter is written as a class.
    """
    return read_parquet_stream(spark, f"{folder.rstrip('/')}/{name}.parque[t]", schema)


def run_windows(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what is available, then stop: a batch writes the windows it changed under its id, again on replay."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    query = (stream.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.IntegerType(), True)])


def newest_windows(spark: SparkSession, sink: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last state that ``run_windows`` wrote of each window, open ones included; fails if no batch ever ran."""
    rows = spark.read.schema(_with_batch(schema)).parquet(sink)
    values = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*(c if c in keys else F.col(f"_last.{c}") for c in schema.names))


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], Any], checkpoint: str) -> StreamingQuery:
    """Process what is available with ``step(batch, batch_id)``, then stop."""
    query = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


# monitors -------------------------------------------------------------------

def _failures(intentos: DataFrame) -> DataFrame:
    return intentos.filter(~F.col("exitoso")).select(
        "id_usuario", "direccion_ip", event_time(F.col("fecha_hora")).alias("_t"))


def failed_login_monitor(intentos: DataFrame, ventana: str = "1 hour", paso: str = "5 minutes",
                         tardanza: str = "10 minutes", minimo: int = MINIMO_FALLOS) -> DataFrame:
    """Users with ``minimo`` failures in a sliding window: (inicio, fin, id_usuario, fallos, ultimo, direcciones).

    ``direcciones`` estimates the distinct addresses from a sketch, so a window's
    state stays small however many addresses attack; they are exact while few.
    ``failed_login_addresses`` lists them.
    """
    counted = (_failures(intentos).withWatermark("_t", tardanza).groupBy(F.window("_t", ventana, paso).alias("w"), "id_usuario")
               .agg(F.count("*").alias("fallos"), F.max("_t").alias("ultimo"),
                    F.hll_sketch_agg("direccion_ip").alias("vistas")))
    return counted.filter(F.col("fallos") >= minimo).select(
        wall_clock(F.col("w.start")).alias("inicio"), wall_clock(F.col("w.end")).alias("fin"), "id_usuario", "fallos",
        wall_clock(F.col("ultimo")).alias("ultimo"), F.hll_sketch_estimate("vistas").alias("direcciones"))


def failed_login_addresses(intentos: DataFrame, ventana: str = "1 hour", paso: str = "5 minutes",
                           tardanza: str = "10 minutes") -> DataFrame:
    """Every address that failed in a sliding window, one row each: (inicio, fin, id_usuario, direccion_ip, fallos)."""
    counted = (_failures(intentos).withWatermark("_t", tardanza)
               .groupBy(F.window("_t", ventana, paso).alias("w"), "id_usuario", "direccion_ip").agg(F.count("*").alias("fallos")))
    return counted.select(wall_clock(F.col("w.start")).alias("inicio"), wall_clock(F.col("w.end")).alias("fin"),
                          "id_usuario", "direccion_ip", "fallos")


def with_addresses(ventanas: DataFrame, direcciones: DataFrame) -> DataFrame:
    """Windows of ``failed_login_monitor`` with all their addresses as text ``ips``, and ``direcciones`` counted exactly.

    Both frames come from streams over the same windows; the addresses meet
    only here, so that no stream keeps a list as state.
    """
    keys = ["inicio", "fin", "id_usuario"]
    both = ventanas.select(*keys, "fallos", "ultimo").unionByName(direcciones.select(*keys, "direccion_ip"), allowMissingColumns=True)
    listed = both.groupBy(*keys).agg(F.max("fallos").alias("fallos"), F.max("ultimo").alias("ultimo"),
                                     F.array_sort(F.collect_set("direccion_ip")).alias("_ips")).filter("fallos IS NOT NULL")
    return listed.select(*keys, "fallos", "ultimo", F.when(F.size("_ips") > 0, F.array_join("_ips", ", ")).alias("ips"),
                         F.size("_ips").cast("bigint").alias("direcciones"))


def hourly_bookings(reservas: DataFrame, ventana: str = "1 hour", tardanza: str = "1 hour") -> DataFrame:
    """Bookings created per hour, provider and state: (inicio, id_proveedor, estado, reservas)."""
    timed = reservas.select("id_proveedor", "estado", event_time(F.col("fecha_creacion")).alias("_t"))
    counted = (timed.withWatermark("_t", tardanza)
               .groupBy(F.window("_t", ventana).alias("w"), "id_proveedor", "estado")
               .agg(F.count("*").alias("reservas")))
    return counted.select(wall_clock(F.col("w.start")).alias("inicio"), "id_proveedor", "estado", "reservas")


def audit_stream(images: DataFrame) -> DataFrame:
    """Audit rows from change records with ``antes``, ``despues``, ``fecha`` and ``uid``; keeps no state."""
    return audit_rows(images, F.col("fecha"), F.col("uid"))


# change log -----------------------------------------------------------------

#: Rows of a change log's bucket at first, about.
BUCKET_ROWS = 250_000
#: Folders of buckets that are read together as tables, at most.
FOLDERS = 16


def _name() -> str:
    return f"spark_catalog.default.turnero_{uuid.uuid4().hex}"


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int, by: str | None = None) -> None:
    """Write ``rows`` in Spark's buckets of ``key``, each in the order of its keys; ``by`` names a column to cut folders by.

    Spark keeps buckets for tables only, so there is one, without the files, while they are written.
    """
    name, writer = _name(), rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(by) if by else writer).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A folder that ``write_bucketed`` wrote: what joins or groups its rows by ``key`` need not move them."""
    name, quoted = _name(), path.replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{quoted}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


class ChangeLog:
    """A table in hash buckets of its key, and the rows that batches changed since, in the same buckets.

    A batch reads and writes only the buckets of the keys it names, by path, and
    only what it changes.  When a bucket has had ``merge_after`` changing batches
    the next one writes it anew, so a batch costs no more however long the log
    is.  Everything a batch writes lies under its id, and it starts from the
    list of folders that the batch before left: a replay overwrites its own
    output and nothing else.

    A bucket is sorted in one task, so a larger table is laid out in more of
    them; without ``buckets`` a log has as many as it was created with.  They
    are Spark's own buckets of the key, so a batch that names most of them
    reads them as such and joins their rows where they are; no list of their
    keys is sent to every task then.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType, buckets: int | None = None, merge_after: int = 8):
        self.spark, self.root, self.key, self.schema = spark, root, key, schema
        self._buckets, self.merge_after = buckets, merge_after

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            self._buckets = self.spark.read.schema("cubos int").parquet(f"{self.root}/cubos").first()[0]
        return self._buckets

    @classmethod
    def create(cls, rows: DataFrame, root: str, key: str, buckets: int | None = None, merge_after: int = 8) -> ChangeLog:
        """Lay ``rows`` out under ``root``; without ``buckets`` one for every ``BUCKET_ROWS`` of them, 16 at least."""
        if buckets is None:
            buckets = max(16, -(-rows.count() // BUCKET_ROWS))
        log = cls(rows.sparkSession, root, key, rows.schema, buckets, merge_after)
        log.spark.createDataFrame([(buckets,)], "cubos int").coalesce(1).write.mode("overwrite").parquet(f"{root}/cubos")
        held = log._write(rows.repartition(buckets, key), "base", -1, placed=True)
        log._remember({b: (-1, []) for b in held}, -1)
        return log

    def bucket(self, key: Column | str) -> Column:
        """The bucket of a key, as Spark counts them."""
        return F.pmod(F.hash(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, batch_id: int, placed: bool = False) -> set[int]:
        """Write ``rows`` by bucket, each in the order of its keys; the buckets that have any.

        ``placed`` says that a bucket's rows are in one task already.
        """
        path = f"{self.root}/{kind}/batch={batch_id}"
        rows = rows.select(*self.schema.names, self.bucket(self.key).alias("cubo"))
        write_bucketed(rows if placed else rows.repartition("cubo"), path, self.key, self.buckets, "cubo")
        return {r.cubo for r in self._read([path]).select("cubo").distinct().collect()}

    def _read(self, paths: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.IntegerType()), T.StructField("cubo", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", paths[0].split("/batch=")[0]).parquet(*paths)

    def _remember(self, layout: dict[int, tuple[int | None, list[int]]], batch_id: int) -> None:
        """The folders that make up each bucket after a batch; one row per bucket."""
        rows = [(b, base, log) for b, (base, log) in sorted(layout.items())]
        frame = self.spark.createDataFrame(rows, "cubo int, base int, log array<int>")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/carpetas/batch={batch_id}")

    def layout(self, batch_id: int) -> dict[int, tuple[int | None, list[int]]]:
        """The folders of each bucket after a batch; -1 before any."""
        rows = self.spark.read.schema("cubo int, base int, log array<int>").parquet(f"{self.root}/carpetas/batch={batch_id}")
        return {r.cubo: (r.base, list(r.log)) for r in rows.collect()}

    def last_batch(self) -> int:
        found = self.spark.read.schema("cubo int, base int, log array<int>, batch int").parquet(f"{self.root}/carpetas")
        return found.agg(F.max("batch")).first()[0]

    def _most(self, buckets: set[int] | dict) -> bool:
        return 2 * len(buckets) > self.buckets

    def _pieces(self, kind: str, held: list[tuple[int, int]], whole: bool) -> DataFrame:
        """The rows of these (batch, bucket); ``whole`` reads a batch's folder as a table in buckets."""
        if not whole:
            return self._read([f"{self.root}/{kind}/batch={v}/cubo={b}" for v, b in held])
        found = None
        for version in sorted({v for v, _ in held}):
            rows = read_bucketed(self.spark, f"{self.root}/{kind}/batch={version}", self.schema, self.key, self.buckets)
            rows = rows.filter(F.col("cubo").isin([b for v, b in held if v == version])).withColumn("batch", F.lit(version))
            found = rows if found is None else found.unionByName(rows)
        return found

    def rows(self, layout: dict[int, tuple[int | None, list[int]]]) -> DataFrame:
        """The newest image of every row of these buckets."""
        bases = [(v, b) for b, (v, _) in layout.items() if v is not None]
        logs = [(v, b) for b, (_, log) in layout.items() for v in log]
        whole = self._most(layout) and len({v for v, _ in bases}) + len({v for v, _ in logs}) <= FOLDERS
        base = self._pieces("base", bases, whole and bool(bases)).select(*self.schema.names)
        if not logs:
            return base
        newest = Window.partitionBy(self.key).orderBy(F.desc("batch"))
        last = self._pieces("log", logs, whole).withColumn("_n", F.row_number().over(newest)).filter("_n = 1")
        changed = last.select(self.key)
        return base.join(changed.hint("merge") if whole else changed, self.key, "left_anti").unionByName(last.select(*self.schema.names))

    def current(self, after: int | None = None) -> DataFrame:
        """The table after every batch, or after one of them."""
        return self.rows(self.layout(self.last_batch() if after is None else after))

    def named(self, keys: DataFrame) -> set[int]:
        """The buckets of these keys."""
        return {r.c for r in keys.select(self.bucket(self.key).alias("c")).distinct().collect()}  # at most one row per bucket

    def aimed(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """The rows that batch ``batch_id`` finds under ``keys``; only their buckets are read."""
        layout, wanted = self.layout(batch_id - 1), self.named(keys)
        named = keys.select(F.col(self.key)).distinct()
        found = self.rows({b: layout[b] for b in sorted(wanted & set(layout))})
        return found.join(named.hint("merge") if self._most(wanted) else named, self.key, "left_semi")

    def beside(self, batch: DataFrame) -> DataFrame | None:
        """``batch`` stored in parts that lie where the buckets of its keys are; None if it names few buckets."""
        if not self._most(self.named(batch)):
            return None
        path = shared_dir(self.spark, "lote")
        write_bucketed(batch.repartition(self.buckets, self.key), path, self.key, self.buckets)
        return read_bucketed(self.spark, path, batch.schema, self.key, self.buckets)

    def commit(self, images: DataFrame, batch_id: int, placed: bool = False) -> None:
        """Store the rows that a batch changed or added; ``placed`` says that a bucket's rows are in one task already."""
        layout = self.layout(batch_id - 1)
        for b in self._write(images, "log", batch_id, placed):
            base, log = layout.get(b, (None, []))
            layout[b] = (base, [*log, batch_id])
        full = {b: v for b, v in layout.items() if len(v[1]) > self.merge_after}
        if full:
            for b in self._write(self.rows(full), "base", batch_id):
                layout[b] = (batch_id, [])
        self._remember(layout, batch_id)


def change_step(log: ChangeLog, change: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
                results: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step that applies a change operator to the rows a batch aims at.

    ``change(rows, requests)`` returns (new rows, answers).  Only the rows
    whose key occurs in the batch are read into the operator, so this form is
    for changes that look at one row at a time.  Those that a change leaves
    alone are not stored.  A batch that names most of the buckets moves to them,
    once; the rows stay where they are and are read again where they are needed.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        moved = log.beside(batch)
        asked = batch if moved is None else moved
        aimed = log.aimed(asked, batch_id)
        aimed = materialize(aimed, "apuntadas") if moved is None else aimed
        new_rows, answers = change(aimed, asked)
        cells = [F.col(c) for c in log.schema.names]
        before = aimed.select(F.col(log.key).alias("_key"), F.struct(*cells).alias("_old"))
        before = before if moved is None else before.hint("merge")  # keeps a bucket's rows in one task
        changed = new_rows.join(before, F.col(log.key) == F.col("_key"), "left").filter(
            ~F.struct(*cells).eqNullSafe(F.col("_old"))).select(*log.schema.names)
        log.commit(changed, batch_id, placed=moved is not None)
        answers.write.mode("overwrite").parquet(f"{results}/batch={batch_id}")
    return step


# retention ------------------------------------------------------------------

RETENIDA, ELIMINADA = "RETENIDA", "ELIMINADA"


def expiry_feed(tabla: str, rows: DataFrame, id_column: str, moment: str, expires: Column, spent: Column | None = None) -> DataFrame:
    """Rows of a table as a retention feed: (tabla, id, momento, vence, gastada)."""
    used = F.lit(False) if spent is None else F.coalesce(spent, F.lit(False))
    return rows.select(F.lit(tabla).alias("tabla"), F.col(id_column).alias("id"), F.col(moment).alias("momento"),
                       expires.alias("vence"), used.alias("gastada"))


def expiry_stream(feed: DataFrame) -> DataFrame:
    """A retention feed without rows that have no id, ready for ``run_expiry``."""
    return feed.filter("id IS NOT NULL").select("tabla", "id", "momento", "vence", "gastada")


_ESTADO_RETENCION = T.StructType([T.StructField("clave", T.StringType()), T.StructField("vence", T.TimestampNTZType()),
                                  T.StructField("ida", T.BooleanType())])


def expiry_step(spark: SparkSession, sink: str, state: str, tardanza: str = "0 seconds") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step that says what becomes of every row: (tabla, id, accion, vence), RETENIDA and later ELIMINADA.

    The expiry of each row is kept under (tabla, id) in a ``ChangeLog``.  The
    feed's clock is its newest ``momento``: once it has passed the expiry by
    ``tardanza``, or as soon as a row comes that is spent, the row goes.  A newer
    row of the same id replaces the older; one that is gone stays gone.  Rows
    without expiry stay until they are spent.
    """
    def clock(batch_id: int) -> Any:
        return spark.read.schema("reloj timestamp_ntz").parquet(f"{state}/reloj/batch={batch_id}").first()[0]

    def step(batch: DataFrame, batch_id: int) -> None:
        log = ChangeLog(spark, f"{state}/filas", "clave", _ESTADO_RETENCION, buckets=64)
        if batch_id == 0:
            ChangeLog.create(spark.createDataFrame([], _ESTADO_RETENCION), log.root, log.key, log.buckets)
            spark.createDataFrame([(None,)], "reloj timestamp_ntz").write.mode("overwrite").parquet(f"{state}/reloj/batch=-1")
        # A row without moment counts as the newest.
        newest = F.max(F.struct(F.col("momento").isNull(), "momento", "vence"))
        came = materialize(batch.groupBy("tabla", "id").agg(
            newest.alias("_n"), F.max("gastada").alias("gastada"), F.max("momento").alias("momento")).select(
            F.concat_ws("/", "tabla", "id").alias("clave"), "tabla", "id", F.col("_n.vence").alias("nueva"), "gastada", "momento"), "llegadas")
        passed = came.agg((F.max("momento") - F.expr(f"INTERVAL {tardanza}")).alias("m")).select(
            F.greatest("m", F.lit(clock(batch_id - 1)).cast("timestamp_ntz")).alias("reloj"))
        passed.write.mode("overwrite").parquet(f"{state}/reloj/batch={batch_id}")
        now = F.lit(clock(batch_id)).cast("timestamp_ntz")
        held = log.rows(log.layout(batch_id - 1)).filter("clave IS NOT NULL")
        both = held.withColumn("_held", F.lit(True)).join(came.withColumn("_came", F.lit(True)), "clave", "full")
        both = both.filter("NOT coalesce(ida, FALSE)").withColumn("vence", F.when(F.col("_came"), F.col("nueva")).otherwise(F.col("vence")))
        both = both.withColumn("ida", F.coalesce("gastada", F.lit(False)) | F.coalesce(F.col("vence") < now, F.lit(False)))
        changed = materialize(both.filter("_came OR ida").select(
            "clave", F.coalesce("tabla", F.substring_index("clave", "/", 1)).alias("tabla"),
            F.coalesce("id", F.expr("substr(clave, instr(clave, '/') + 1)")).alias("id"), "vence", "ida",
            F.col("_held").isNull().alias("_nueva")), "cambiadas")
        log.commit(changed.select("clave", "vence", "ida"), batch_id)
        told = F.concat(F.when(F.col("_nueva"), F.array(F.lit(RETENIDA))).otherwise(F.array().cast("array<string>")),
                        F.when(F.col("ida"), F.array(F.lit(ELIMINADA))).otherwise(F.array().cast("array<string>")))
        changed.select("tabla", "id", F.explode(told).alias("accion"), "vence").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return step


def run_expiry(stream: DataFrame, sink: str, checkpoint: str, tardanza: str = "0 seconds") -> None:
    """Process what is available of an ``expiry_stream``, then stop; a batch writes under its id, again on replay."""
    run_batches(stream, expiry_step(stream.sparkSession, sink, f"{checkpoint}-estado", tardanza), checkpoint)


def expiry_outcome(spark: SparkSession, sink: str) -> DataFrame:
    """What ``run_expiry`` wrote, one row per row of the feed: (tabla, id, eliminada, vence)."""
    rows = spark.read.schema("tabla string, id string, accion string, vence timestamp_ntz, batch int").parquet(sink)
    return rows.groupBy("tabla", "id").agg(F.max(F.col("accion") == ELIMINADA).alias("eliminada"), F.max("vence").alias("vence"))
