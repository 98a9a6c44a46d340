"""Streams over several files and triggers agree with the batch operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF, at
from turnero.operators import changes, stats
from turnero.plans import queries
from turnero.session import shared_dir
from turnero.streaming import streams


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def files(spark, frames, name):
    path = shared_dir(spark, name)
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return path


def test_change_stream_applies_batches_once(spark, make):
    base = make("reserva", [{"id_reserva": f"r{i}", "estado": "PENDIENTE", "id_proveedor": "p"} for i in range(6)])
    schema = "id_solicitud string, orden int, id_reserva string, comentario string"
    batches = [spark.createDataFrame([("q1", 1, "r1", "a"), ("q2", 2, "r1", "b")], schema),
               spark.createDataFrame([("q3", 3, "r1", "c"), ("q4", 4, "r2", "d")], schema)]
    feed, answers = files(spark, batches, "feed"), shared_dir(spark, "answers")
    log = streams.ChangeLog.create(base, shared_dir(spark, "tabla"), "id_reserva")
    step = streams.change_step(log, lambda t, q: changes.cancelar_reserva(t, q, "2026-06-01"), answers)
    stream = streams.read_parquet_stream(spark, feed, batches[0].schema, files_per_trigger=1)
    streams.run_batches(stream, step, shared_dir(spark, "checkpoint"))
    remarks = {r.id_reserva: r.comentarios for r in log.current().collect()}
    assert remarks == {"r0": None, "r1": "a", "r2": "d", "r3": None, "r4": None, "r5": None}
    done = {r.id_solicitud: r.aplicado for r in spark.read.parquet(answers).collect()}
    assert done == {"q1": True, "q2": False, "q3": False, "q4": True}
    # a replayed batch overwrites its own output
    before = rows(log.current())
    step(batches[1], 1)
    assert rows(log.current()) == before
    assert {r.id_reserva: r.estado for r in log.current(after=0).collect()}["r2"] == "PENDIENTE"


def test_a_batch_reads_only_its_buckets_however_long_the_log(spark, make):
    """Forty batches over one row: every batch reads the same few files, and none of another bucket."""
    table = make("reserva", [{"id_reserva": f"r{i}", "estado": "PENDIENTE"} for i in range(200)])
    log = streams.ChangeLog.create(table, shared_dir(spark, "tabla"), "id_reserva", buckets=8, merge_after=3)
    one = spark.createDataFrame([("r7",)], "id_reserva string")
    home = one.select(log.bucket("id_reserva")).first()[0]
    read = []
    for batch in range(12):
        aimed = log.aimed(one, batch)
        assert all(f"/cubo={home}/" in f for f in aimed.inputFiles())
        read.append(len(aimed.inputFiles()))
        assert aimed.count() == 1
        log.commit(aimed.withColumn("comentarios", F.lit(f"lote {batch}")), batch)
    assert max(read) <= 1 + log.merge_after and read[-1] <= max(read[:5])
    now = {r.id_reserva: r.comentarios for r in log.current().collect()}
    assert len(now) == 200 and now["r7"] == "lote 11" and sum(v is not None for v in now.values()) == 1
    # rows can be added too, in a bucket of their own
    log.commit(make("reserva", [{"id_reserva": "nueva", "estado": "PENDIENTE"}]), 12)
    assert log.current().count() == 201 and log.aimed(spark.createDataFrame([("nueva",)], "id_reserva string"), 13).count() == 1


def test_failed_login_window_equals_the_batch_report(spark, make):
    def attempts(user, first, n, step=1):
        return [{"id_intento": f"{user}{first}{i}", "id_usuario": user, "exitoso": False, "direccion_ip": f"ip{i % 2}",
                 "fecha_hora": at(first) + dt.timedelta(minutes=step * i)} for i in range(n)]

    early = attempts("five", "2026-06-01 11:01", 5) + attempts("four", "2026-06-01 11:01", 4)
    late = attempts("clock", "2026-06-01 15:00", 1)  # moves the watermark past the windows above
    log = make("intento_login", early + late)
    feed = files(spark, [make("intento_login", early), make("intento_login", late)], "logins")
    stream = streams.read_parquet_stream(spark, feed, log.schema, files_per_trigger=1)
    monitor, sink = streams.failed_login_monitor(stream), shared_dir(spark, "sink")
    streams.run(monitor, sink, shared_dir(spark, "checkpoint"))
    window = spark.read.schema(monitor.schema).parquet(sink).filter(F.col("fin") == F.lit("2026-06-01 12:00:00"))
    users = make("usuario", [{"id_usuario": u} for u in ("five", "four", "clock")])
    batch = stats.intentos_fallidos_recientes(users, log, "2026-06-01 12:00:00")
    assert rows(window.select("id_usuario", "fallos", "ultimo", "direcciones")) == rows(
        batch.select("id_usuario", "intentos_fallidos_count", "ultimo_intento", "direcciones"))
    assert window.count() == 1
    listed, sink = streams.failed_login_addresses(stream), shared_dir(spark, "sink")
    streams.run(listed, sink, shared_dir(spark, "checkpoint"))
    found = spark.read.schema(listed.schema).parquet(sink).filter((F.col("fin") == F.lit("2026-06-01 12:00:00")) & (F.col("id_usuario") == "five"))
    assert rows(found.select("direccion_ip", "fallos")) == [("ip0", 3), ("ip1", 2)]


def test_many_addresses_are_counted_and_listed_as_rows(spark, make):
    """An attack from 3000 addresses: no list in one cell, an estimate in the stream, every address as a row."""
    log = make("intento_login", [{"id_intento": f"i{i}", "id_usuario": "u", "exitoso": False, "direccion_ip": f"10.0.{i // 250}.{i % 250}",
                                  "fecha_hora": at("2026-06-01 11:30")} for i in range(3000)])
    users = make("usuario", [{"id_usuario": "u"}])
    hit = stats.intentos_fallidos_recientes(users, log, "2026-06-01 12:00:00").first()
    assert (hit.intentos_fallidos_count, hit.direcciones, hit.ips_utilizadas) == (3000, 3000, None)
    assert stats.direcciones_fallidas_recientes(log, "2026-06-01 12:00:00").count() == 3000
    feed, sink = files(spark, [log], "logins"), shared_dir(spark, "sink")
    monitor = streams.failed_login_monitor(streams.read_parquet_stream(spark, feed, log.schema))
    streams.run_windows(monitor, sink, shared_dir(spark, "checkpoint"))
    seen = streams.newest_windows(spark, sink, monitor.schema, ["inicio", "fin", "id_usuario"]).collect()
    assert seen and all(r.fallos == 3000 and abs(r.direcciones - 3000) < 200 for r in seen)


def test_expiry_stream_holds_rows_until_the_feed_passes_them(spark):
    schema = "tabla string, id string, momento timestamp_ntz, vence timestamp_ntz, gastada boolean"

    def feed(*rows):
        return spark.createDataFrame([("t", i, at(m), v and at(v), g) for i, m, v, g in rows], schema)

    frames = [feed(("short", "2026-01-01", "2026-01-02", False), ("long", "2026-01-01", "2026-03-01", False),
                   ("used", "2026-01-01", "2026-03-01", False), ("born_used", "2026-01-01", "2026-03-01", True),
                   ("renewed", "2026-01-01", "2026-01-02", False), ("forever", "2026-01-01", None, False), (None, "2026-01-01", None, True)),
              feed(("renewed", "2026-01-01 12:00", "2026-02-20", False), ("clock", "2026-01-01 18:00", "2026-12-31", False)),
              feed(("used", "2026-01-03", "2026-03-01", True), ("clock", "2026-01-10", "2026-12-31", False)),
              feed(("late", "2026-01-10", "2026-01-05", False), ("short", "2026-01-10", "2026-12-31", False))]
    path = files(spark, frames, "feed")
    sink, checkpoint = shared_dir(spark, "sink"), shared_dir(spark, "checkpoint")
    stream = streams.expiry_stream(streams.read_parquet_stream(spark, path, frames[0].schema, files_per_trigger=1))
    streams.run_expiry(stream, sink, checkpoint)
    gone = {r.id: r.eliminada for r in streams.expiry_outcome(spark, sink).collect()}
    assert gone == {"short": True, "long": False, "used": True, "born_used": True, "renewed": False, "forever": False, "clock": False, "late": True}
    # running again over the same feed finds nothing new
    before = rows(spark.read.parquet(sink).select("tabla", "id", "accion"))
    streams.run_expiry(stream, sink, checkpoint)
    assert rows(spark.read.parquet(sink).select("tabla", "id", "accion")) == before


def test_streams_read_a_folder_of_files_and_keep_open_windows(spark):
    one, parts = SF, shared_dir(spark, "parts")
    spark.read.parquet(f"{one}/events.parquet").repartition(3).write.parquet(f"{parts}/events.parquet")
    whole = rows(queries.build("t2_failed_login_monitor")(spark, one))
    assert whole and rows(queries.build("t2_failed_login_monitor")(spark, parts)) == whole
    counts = queries.build("t4_expiry_stream")
    assert rows(counts(spark, parts)) == rows(counts(spark, one))


def test_windows_keep_the_last_state_over_triggers(spark, make):
    def booked(n, moment):
        return make("reserva", [{"id_reserva": f"{moment}{i}", "id_proveedor": "p", "estado": "PENDIENTE",
                                 "fecha_creacion": at(moment)} for i in range(n)])

    frames = [booked(2, "2026-06-01 10:10"), booked(3, "2026-06-01 10:40"), booked(1, "2026-06-01 11:05")]
    feed, sink = files(spark, frames, "bookings"), shared_dir(spark, "sink")
    hourly = streams.hourly_bookings(streams.read_parquet_stream(spark, feed, frames[0].schema, files_per_trigger=1))
    streams.run_windows(hourly, sink, shared_dir(spark, "checkpoint"))
    last = streams.newest_windows(spark, sink, hourly.schema, ["inicio", "id_proveedor", "estado"])
    assert rows(last) == [(at("2026-06-01 10:00"), "p", "PENDIENTE", 5), (at("2026-06-01 11:00"), "p", "PENDIENTE", 1)]


def test_every_address_of_a_window_is_in_its_list(spark, make):
    """The list is made of rows, so it is whole however long, and the count beside it is exact."""
    log = make("intento_login", [{"id_intento": f"i{i}", "id_usuario": u, "exitoso": False, "direccion_ip": u and f"10.0.{i // 250}.{i % 250}",
                                  "fecha_hora": at("2026-06-01 11:30")} for u, n in (("u", 1500), (None, 4), ("pocos", 2)) for i in range(n)])
    feed, sink, each = files(spark, [log], "logins"), shared_dir(spark, "sink"), shared_dir(spark, "sink")
    stream = streams.read_parquet_stream(spark, feed, log.schema)
    monitor = streams.failed_login_monitor(stream, "1 hour", "1 hour", minimo=3)
    streams.run_windows(monitor, sink, shared_dir(spark, "checkpoint"))
    listed = streams.failed_login_addresses(stream, "1 hour", "1 hour")
    streams.run_windows(listed, each, shared_dir(spark, "checkpoint"))
    keys = ["inicio", "fin", "id_usuario"]
    got = {r.id_usuario: r for r in streams.with_addresses(
        streams.newest_windows(spark, sink, monitor.schema, keys),
        streams.newest_windows(spark, each, listed.schema, [*keys, "direccion_ip"])).collect()}
    assert set(got) == {"u", None} and got["u"].direcciones == 1500
    assert got["u"].ips == ", ".join(sorted(f"10.0.{i // 250}.{i % 250}" for i in range(1500)))
    assert (got[None].fallos, got[None].ips, got[None].direcciones) == (4, None, 0)


def test_expiry_is_decided_in_spark_to_the_microsecond(spark, capsys):
    schema = "tabla string, id string, momento timestamp_ntz, vence timestamp_ntz, gastada boolean"
    rows_ = [("t", "a/b", at("2026-01-01"), at("2026-01-05 00:00:00.000100"), False),
             ("t", "justo", at("2026-01-01"), at("2026-01-05 00:00:00.000200"), False),
             ("t", "reloj", at("2026-01-05 00:00:00.000200"), at("2026-02-01"), False)]
    one = spark.createDataFrame(rows_, schema)
    path, sink = files(spark, [one], "feed"), shared_dir(spark, "sink")
    stream = streams.expiry_stream(streams.read_parquet_stream(spark, path, one.schema))
    capsys.readouterr()
    stream.explain()
    assert "InPandas" not in capsys.readouterr().out
    streams.run_expiry(stream, sink, shared_dir(spark, "checkpoint"))
    assert {r.id: r.eliminada for r in streams.expiry_outcome(spark, sink).collect()} == {"a/b": True, "justo": False, "reloj": False}


def test_a_larger_table_has_more_buckets(spark, tmp_path, monkeypatch):
    """A bucket is one task, so their number follows the rows; a log opened again finds it, whatever the limit is then."""
    monkeypatch.setattr(streams, "BUCKET_ROWS", 10)
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("v"))
    made = streams.ChangeLog.create(rows, str(tmp_path / "log"), "id")
    monkeypatch.setattr(streams, "BUCKET_ROWS", 100_000)
    again = streams.ChangeLog(spark, str(tmp_path / "log"), "id", rows.schema)
    assert made.buckets == again.buckets == 40 and len(made.layout(-1)) > 16
    again.commit(rows.filter("v < 50").withColumn("v", F.col("v") + 1000), 0)
    assert sorted(r.v for r in again.current().collect()) == [*range(50, 400), *range(1000, 1050)]


def test_a_batch_over_most_buckets_leaves_the_rows_where_they_are(spark, tmp_path, monkeypatch, capsys):
    """The rows are joined in their buckets, without an exchange; repeated keys and rows without key stay as they were."""
    table = spark.createDataFrame([(f"k{i}", i) for i in range(400)] + [("k7", 1007), (None, -1), (None, -2)], "id string, v int")
    log = streams.ChangeLog.create(table, str(tmp_path / "log"), "id", buckets=16)

    def add(rows, asked):
        most = asked.groupBy("id").agg(F.max("d").alias("d"))
        return (rows.join(most, "id").select("id", (F.col("v") + F.col("d")).alias("v")),
                asked.join(rows.select("id").distinct(), "id", "left_semi").select("q"))

    step = streams.change_step(log, add, str(tmp_path / "answers"))
    want = dict(table.filter("id IS NOT NULL AND v < 1000").collect())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch, (first, d) in enumerate([(0, 1000), (200, 5000)]):  # the second names k200 to k399, twice, and one that is not there
            keys = [*range(first, 400), *range(first, 400), 999]
            step(spark.createDataFrame([(f"q{n}", f"k{i}", d if n % 2 else 0) for n, i in enumerate(keys)], "q string, id string, d int"), batch)
            found = log.current()
            if batch == 0:
                capsys.readouterr()
                found.explain()
                assert "Exchange" not in capsys.readouterr().out
                # two rows had this key; a change stores one of its images
                seven = [r.v for r in found.filter("id = 'k7'").collect()]
                assert len(seven) == 1 and seven[0] in (7, 1007, 2007)
            for i in range(first, 400):
                want[f"k{i}"] += max(d if n % 2 else 0 for n, j in enumerate(keys) if j == i)
            now = rows(found.filter("id IS NULL OR id <> 'k7'"))
            assert now == sorted([*((k, v) for k, v in want.items() if k != "k7"), (None, -1), (None, -2)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert spark.read.parquet(str(tmp_path / "answers")).count() == 800 + 400
    monkeypatch.setattr(streams, "FOLDERS", 0)  # read by path
    assert rows(log.current()) == rows(found)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("turnero_")]
