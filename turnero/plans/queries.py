"""Registered queries: every operator over whole tables of a parquet folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnero.functions import sql
from turnero.functions.clock import shifted
from turnero.operators import changes, joins, lists, quality, stats, visibility
from turnero.plans import requests as req
from turnero.session import materialize, shared_dir
from turnero.sources import tables as store
from turnero.sources.marketplace import AS_OF_AUTH, AS_OF_BOOKING, Marketplace, login_log
from turnero.streaming import streams

DESDE, HASTA = "1996-01-01 00:00:00", "1999-12-31 23:59:59"
VENTANA_HORAS = 7 * 24  # a week, so that the sparse log has users over the threshold

Plan = Callable[[Marketplace], DataFrame]
PLANS: dict[str, Plan] = {}


def plan(name: str) -> Callable[[Plan], Plan]:
    def register(fn: Plan) -> Plan:
        PLANS[name] = fn
        return fn
    return register


def add(name: str, fn: Plan) -> None:
    PLANS[name] = fn


def ids(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column)


# ingest and storage ---------------------------------------------------------

@plan("i1_load_table")
def _(m: Marketplace) -> DataFrame:
    path = shared_dir(m.spark, "reserva")
    m.reserva.drop("estado", "updated_at", "comentarios").write.parquet(path)
    return store.load_table(m.spark, path, "reserva", AS_OF_BOOKING)


@plan("i2_insert_if_absent")
def _(m: Marketplace) -> DataFrame:
    parts = m.source("part").select(F.concat(F.lit("KP"), "p_partkey").alias("id_categoria"),
                                    F.col("p_type").alias("nombre_categoria"))
    again = m.categoria_servicio.select(F.concat(F.lit("R"), "id_categoria").alias("id_categoria"),
                                        "nombre_categoria")
    batch = store.with_defaults(parts.unionByName(again), "categoria_servicio", AS_OF_BOOKING)
    return store.insert_if_absent(m.categoria_servicio, batch, ["nombre_categoria"], "id_categoria")


@plan("i3_register_profiles")
def _(m: Marketplace) -> DataFrame:
    people = m.cliente.select(F.concat(F.lower("id_usuario"), F.lit("@example.test")).alias("email"), "nombre",
                              "telefono")
    return store.register_profiles(m.usuario, people, "cliente", AS_OF_AUTH)


@plan("i3_issue_verification_tokens")
def _(m: Marketplace) -> DataFrame:
    people = m.usuario.select("email", F.concat(F.lit("VT-"), "email").alias("id_token"),
                              F.sha2("email", 256).alias("token"))
    return store.issue_verification_tokens(m.usuario, people, AS_OF_AUTH)


@plan("i4_append_batch")
def _(m: Marketplace) -> DataFrame:
    batch = req.servicio_defectuoso(m).withColumn("id_servicio", F.concat(F.lit("N"), "id_servicio"))
    after, _, rejected = store.append_batch(m.servicio, batch.drop("capacidad_maxima"), "servicio", AS_OF_BOOKING)
    kept = after.select("id_servicio", "precio", "capacidad_maxima", F.lit(None).cast("string").alias("reglas"))
    refused = rejected.select("id_servicio", "precio", "capacidad_maxima",
                              F.array_join(F.array_sort("reglas"), ",").alias("reglas"))
    return kept.unionByName(refused)


@plan("i5_write_by_date")
def _(m: Marketplace) -> DataFrame:
    path = shared_dir(m.spark, "reserva-mes")
    store.write_by_date(m.reserva, path, "fecha_hora_inicio", ["id_empleado", "fecha_hora_inicio"])
    return m.spark.read.parquet(path).select("id_reserva", "id_empleado", "fecha_hora_inicio", "periodo")


# lists ----------------------------------------------------------------------

add("l1_categorias_activas", lambda m: lists.categorias_activas(m.categoria_servicio))
add("l2_categoria_by_id", lambda m: lists.categoria_by_id(m.categoria_servicio, ids(m.proveedor, "id_categoria")))
add("l3_servicios_activos", lambda m: lists.servicios_activos(m.servicio))
add("l4_servicios_grupales", lambda m: lists.servicios_grupales(m.servicio))
add("l5_servicios_por_proveedor", lambda m: lists.servicios_por_proveedor(m.servicio, ids(m.proveedor, "id_usuario")))
add("l6_servicios_por_empleado",
    lambda m: lists.servicios_por_empleado(m.empleado_servicio, ids(m.empleado, "id_empleado")))
add("l7_horario_laboral_por_empleado", lambda m: lists.horario_laboral_por_empleado(m.horario_laboral, None))
add("l8_bloqueos_por_empleado", lambda m: lists.bloqueos_por_empleado(m.bloqueo_horario, None, AS_OF_BOOKING))
add("l9_reservas_activas", lambda m: lists.reservas_activas(m.reserva))
add("l10_reservas_por_cliente_all", lambda m: lists.reservas_por_cliente_all(m.reserva))
add("l11_reservas_dia_actual", lambda m: lists.reservas_dia_actual(m.reserva, AS_OF_BOOKING))
add("l12_reservas_proximas", lambda m: lists.reservas_proximas(m.reserva, AS_OF_BOOKING))
add("l13_reservas_por_cliente", lambda m: lists.reservas_por_cliente(m.reserva, None, "COMPLETADA"))
add("l14_reservas_por_empleado", lambda m: lists.reservas_por_empleado(m.reserva, None, DESDE, HASTA))
add("l15_historial_cliente", lambda m: lists.historial_cliente(m.reserva, None))
add("l16_agenda_dia_empleado", lambda m: lists.agenda_dia_empleado(m.bloqueo_horario, None, AS_OF_BOOKING))
add("l17_bloqueos_solapados", lambda m: lists.bloqueos_solapados(m.bloqueo_horario, None, None, 600, 660))
add("l18_tiene_horario", lambda m: lists.tiene_horario(m.horario_laboral, m.empleado, "SABADO", 600, 660))

# joins ----------------------------------------------------------------------

add("j1_usuario_completo", lambda m: joins.usuario_completo(m.usuario, m.cliente, m.proveedor, m.admin))
add("j2_login_lookup", lambda m: joins.login_lookup(m.usuario, m.cliente, m.proveedor, m.admin, None))
add("j3_tokens_activos", lambda m: joins.tokens_activos(
    m.usuario, m.token_refresh, m.token_reset_password, m.email_verification_token, AS_OF_AUTH))
add("j4_admins_activos", lambda m: joins.admins_activos(m.admin, m.usuario))
add("j5_servicios_por_empleado_view", lambda m: joins.servicios_por_empleado_view(m.empleado, m.empleado_servicio))
add("j6_horario_semanal", lambda m: joins.horario_semanal(m.empleado, m.horario_laboral))
add("j7_bloqueos_futuros", lambda m: joins.bloqueos_futuros(m.empleado, m.bloqueo_horario, AS_OF_BOOKING))
add("j8_empleado_servicio_completo", lambda m: joins.empleado_servicio_completo(m.empleado, m.empleado_servicio))
add("j9_agenda_proveedor_dia",
    lambda m: joins.agenda_proveedor_dia(m.empleado, m.bloqueo_horario, None, AS_OF_BOOKING))
add("j10_validar_conflicto_horario", lambda m: joins.validar_conflicto_horario(m.reserva, req.traslados(m)).select(
    "id_solicitud", "conflictos", "conflicto"))
add("j11_conflictos_existentes", lambda m: joins.conflictos_existentes(m.reserva))
add("j12_empleado_disponible", lambda m: joins.empleado_disponible(
    m.horario_laboral, m.bloqueo_horario, req.consultas_disponibilidad(m)).select("id_solicitud", "disponible"))

# aggregates -----------------------------------------------------------------

@plan("a1_estadisticas_servicios_proveedor")
def _(m: Marketplace) -> DataFrame:
    rows = stats.estadisticas_servicios_proveedor(m.servicio)
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("precio_promedio", "duracion_promedio")})


@plan("a1_reporte_servicios_proveedor")
def _(m: Marketplace) -> DataFrame:
    rows = stats.reporte_servicios_proveedor(m.servicio)
    return rows.withColumns({c: F.col(c).cast("double") for c in ("precio_promedio_cop", "duracion_promedio_min")})


@plan("a2_estadisticas_reservas_proveedor")
def _(m: Marketplace) -> DataFrame:
    rows = stats.estadisticas_reservas_proveedor(m.reserva)
    return rows.withColumn("duracion_promedio_minutos", F.round("duracion_promedio_minutos", 6))


@plan("a3_estadisticas_global_con_tasa")
def _(m: Marketplace) -> DataFrame:
    rows = stats.estadisticas_global_con_tasa(m.reserva)
    return rows.withColumn("tasa_cancelacion_pct", F.col("tasa_cancelacion_pct").cast("double"))


@plan("a4_estadisticas_proveedor_rango")
def _(m: Marketplace) -> DataFrame:
    rows = stats.estadisticas_proveedor_rango(m.reserva, ids(m.proveedor, "id_usuario"), DESDE, HASTA)
    return rows.withColumn("tasa_cancelacion", F.col("tasa_cancelacion").cast("double"))


add("a5_intentos_fallidos_recientes", lambda m: stats.intentos_fallidos_recientes(
    m.usuario, m.intento_login, AS_OF_AUTH, VENTANA_HORAS))
add("a6_usuarios_sospechosos", lambda m: stats.usuarios_sospechosos(
    m.usuario, m.intento_login, AS_OF_AUTH, VENTANA_HORAS))
add("a5_direcciones_fallidas", lambda m: stats.direcciones_fallidas_recientes(m.intento_login, AS_OF_AUTH, VENTANA_HORAS))
add("a7_empleados_activos_por_proveedor", lambda m: stats.empleados_activos_por_proveedor(
    m.empleado, m.empleado_servicio, m.horario_laboral, m.bloqueo_horario, AS_OF_BOOKING))
add("a8_listar_empleados_activos", lambda m: stats.listar_empleados_activos(
    m.empleado, m.empleado_servicio, m.horario_laboral, None))
add("a9_empleados_por_proveedor", lambda m: stats.empleados_por_proveedor(
    m.empleado, m.empleado_servicio, None, solo_activos=False))
add("a10_table_volume_profile", lambda m: stats.volume_profile(m.tables()))


# state changes --------------------------------------------------------------

def change(name: str, fn: Callable[[Marketplace], changes.Changed], snapshot: tuple[str, ...] | None = None) -> None:
    """Register the answers of a change as ``name`` and the table it leaves as ``name_tabla``."""
    add(name, lambda m: fn(m)[1])
    if snapshot:
        add(f"{name}_tabla", lambda m: fn(m)[0].select(*snapshot))


_RESERVA = ("id_reserva", "estado", "fecha_hora_inicio", "fecha_hora_fin", "fecha_cancelacion", "comentarios",
            "updated_at")
_USUARIO = ("id_usuario", "estado", "bloqueado_hasta", "intentos_fallidos", "updated_at")
_FLAG = ("activo", "updated_at")

change("c1_confirmar_reserva",
       lambda m: changes.confirmar_reserva(m.reserva, req.confirmaciones(m), AS_OF_BOOKING), _RESERVA)
change("c2_cancelar_reserva",
       lambda m: changes.cancelar_reserva(m.reserva, req.cancelaciones(m), AS_OF_BOOKING), _RESERVA)
change("c3_reagendar_reserva",
       lambda m: changes.reagendar_reserva(m.reserva, req.reagendas(m), AS_OF_BOOKING), _RESERVA)
change("c4_crear_reserva", lambda m: changes.crear_reserva(
    m.reserva, m.servicio.filter("activo"), m.horario_laboral, m.bloqueo_horario, req.reservas_nuevas(m),
    AS_OF_BOOKING), _RESERVA)
add("c5_mantener_sellos", lambda m: changes.mantener_sellos(
    m.reserva, req.reservas_editadas(m), "id_reserva", AS_OF_BOOKING).select(*_RESERVA))


def _audit(m: Marketplace) -> DataFrame:
    return changes.auditar_cambios_sensibles(m.usuario, req.usuarios_editados(m), AS_OF_AUTH)


def _audit_fields(rows: DataFrame) -> DataFrame:
    """Audit rows with the JSON images opened, so engines that format JSON differently agree."""
    def field(column: str, name: str):
        return F.get_json_object(column, f"$.{name}").alias(f"{name}_{column[8:]}")

    return rows.select("nombre_tabla", "id_registro_afectado", "operacion", "modificado_por", "fecha_modificacion",
                       *(field(c, n) for c in ("valores_anteriores", "valores_nuevos") for n in changes.SENSIBLES))


add("c6_auditar_cambios_sensibles", lambda m: _audit_fields(_audit(m)))


def _verify(m: Marketplace) -> changes.Changed:
    tokens = m.email_verification_token
    return changes.verificar_email(m.usuario, tokens, tokens.withColumn("usado", F.lit(True)), AS_OF_AUTH)


change("c7_verificar_email", _verify, ("id_usuario", "email_verificado", "updated_at"))


def _lock(m: Marketplace) -> changes.Changed:
    hits = stats.intentos_fallidos_recientes(m.usuario, m.intento_login, AS_OF_AUTH, VENTANA_HORAS)
    return changes.bloquear_usuario_por_intentos(m.usuario, req.todas(hits, "id_usuario"), AS_OF_AUTH)


def _suspend(m: Marketplace) -> changes.Changed:
    asked = req.usuarios_con_estado(m, "INACTIVO").withColumns({
        "hasta": F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"), "nuevo_estado": F.lit("SUSPENDIDO")})
    return changes.bloquear_usuario(m.usuario, asked, AS_OF_AUTH)


def _recount(m: Marketplace) -> changes.Changed:
    failures = changes.fallos_consecutivos(m.intento_login, AS_OF_AUTH)
    asked = failures.withColumns({"id_solicitud": F.concat(F.lit("Q"), "id_usuario"), "orden": F.col("id_usuario")})
    return changes.actualizar_intentos_fallidos(m.usuario, asked, AS_OF_AUTH)


change("c8_bloquear_usuario_por_intentos", _lock, _USUARIO)
change("c9_bloquear_usuario", _suspend, _USUARIO)
change("c10_actualizar_intentos_fallidos", _recount, _USUARIO)
change("c11_resetear_intentos_fallidos", lambda m: changes.resetear_intentos_fallidos(
    m.usuario, req.usuarios_con_estado(m, "BLOQUEADO"), AS_OF_AUTH), _USUARIO)
add("c12_limpiar_tokens_expirados",
    lambda m: changes.limpiar_tokens_expirados(m.token_refresh, AS_OF_AUTH)[0].select("id_token", "revocado"))


def _purge(m: Marketplace):
    return changes.limpiar_datos_expirados(m.token_refresh, m.token_reset_password, m.email_verification_token,
                                           m.intento_login, AS_OF_AUTH, dias=10)


add("c13_limpiar_datos_expirados", lambda m: _purge(m)[1])


@plan("c13_limpiar_datos_expirados_tabla")
def _(m: Marketplace) -> DataFrame:
    kept = _purge(m)[0]
    parts = [rows.select(F.lit(name).alias("tabla"),
                         F.col("id_intento" if name == "intento_login" else "id_token").alias("id"))
             for name, rows in kept.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


change("c14_desactivar_servicio", lambda m: changes.desactivar_servicio(
    m.servicio, req.todas(m.servicio, "id_servicio"), AS_OF_BOOKING), ("id_servicio", *_FLAG))
change("c14_activar_servicio", lambda m: changes.activar_servicio(
    m.servicio, req.todas(m.servicio, "id_servicio"), AS_OF_BOOKING), ("id_servicio", *_FLAG))
change("c15_desactivar_empleado", lambda m: changes.desactivar_empleado(
    m.empleado, req.todas(m.empleado, "id_empleado"), AS_OF_BOOKING), ("id_empleado", *_FLAG))
change("c15_activar_empleado", lambda m: changes.activar_empleado(
    m.empleado, req.todas(m.empleado, "id_empleado"), AS_OF_BOOKING), ("id_empleado", *_FLAG))
change("c16_asignar_servicio", lambda m: changes.asignar_servicio(
    m.empleado_servicio, req.asignaciones_pedidas(m), AS_OF_BOOKING),
    ("id_empleado_servicio", "id_empleado", "id_servicio", "activo", "fecha_asignacion"))
change("c16_remover_servicio", lambda m: changes.remover_servicio(
    m.empleado_servicio, req.asignaciones_pedidas(m), AS_OF_BOOKING), ("id_empleado_servicio", *_FLAG))
change("c17_crear_bloqueo", lambda m: changes.crear_bloqueo(
    m.bloqueo_horario, changes.bloqueos_de_reservas(m.reserva), AS_OF_BOOKING),
    ("id_bloqueo", "id_empleado", "id_reserva", "fecha", "hora_inicio", "hora_fin", "tipo_bloqueo", "activo"))
change("c17_eliminar_bloqueo", lambda m: changes.eliminar_bloqueo(
    m.bloqueo_horario, req.todas(m.bloqueo_horario, "id_bloqueo"), AS_OF_BOOKING), ("id_bloqueo", *_FLAG))
change("c18_update_servicio", lambda m: changes.update_fields(
    m.servicio, req.precios_nuevos(m), ["id_servicio", "id_proveedor"], ["nombre_servicio", "precio"],
    AS_OF_BOOKING), ("id_servicio", "nombre_servicio", "precio", "updated_at"))
change("c18_update_categoria", lambda m: changes.update_fields(
    m.categoria_servicio, req.categorias_nuevas(m), ["id_categoria"], ["nombre_categoria", "activa"], AS_OF_BOOKING),
    ("id_categoria", "nombre_categoria", "activa", "updated_at"))
change("c18_update_empleado", lambda m: changes.update_fields(
    m.empleado, req.empleados_nuevos(m), ["id_empleado", "id_proveedor"], ["nombre_completo", "telefono", "notas"],
    AS_OF_BOOKING), ("id_empleado", "nombre_completo", "telefono", "notas", "updated_at"))
change("c18_update_horario", lambda m: changes.update_fields(
    m.horario_laboral, req.dias_libres(m), ["id_empleado", "dia_semana"], ["activo"], AS_OF_BOOKING),
    ("id_horario", *_FLAG))


@plan("c19_delete_cascade")
def _(m: Marketplace) -> DataFrame:
    doomed = m.usuario.filter(F.col("estado") == "INACTIVO").select("id_usuario")
    names = ("usuario", "cliente", "proveedor", "admin", "intento_login", "token_refresh", "token_reset_password",
             "email_verification_token")
    left = changes.delete_cascade({n: m.table(n) for n in names}, "usuario", doomed, AS_OF_AUTH)
    result = None
    for name in names:
        key = changes.TABLES[name].key
        creator = F.col("creado_por") if name == "admin" else F.lit(None).cast("string")
        part = left[name].select(F.lit(name).alias("tabla"), F.col(key).alias("id"), creator.alias("creado_por"))
        result = part if result is None else result.unionByName(part)
    return result


# quality --------------------------------------------------------------------

add("v1_check_rows", lambda m: quality.check_all_rows(req.tablas_defectuosas(m)))
add("v2_check_unique", lambda m: quality.check_unique({
    **m.tables(), "reserva": m.reserva_sin_depurar, "usuario": req.usuario_repetido(m), "token_refresh": req.token_repetido(m)}))


@plan("v3_check_foreign_keys")
def _(m: Marketplace) -> DataFrame:
    return quality.check_foreign_keys({**m.tables(), "usuario": m.usuario.filter("estado <> 'INACTIVO'"),
                                       "empleado": m.empleado.filter("activo")})


@plan("v4_check_logical_keys")
def _(m: Marketplace) -> DataFrame:
    live = m.tables()
    return quality.check_logical_keys({**live, "servicio": m.servicio.filter("activo"),
                                       "empleado": m.empleado.filter("activo"),
                                       "categoria_servicio": m.categoria_servicio.filter("activa"),
                                       "cliente": m.cliente.filter("telefono IS NOT NULL")})


add("v5_check_subtypes", lambda m: quality.check_subtypes(
    req.usuario_defectuoso(m), {"cliente": m.cliente, "proveedor": m.proveedor, "admin": m.admin}))
add("v6_check_state_path", lambda m: quality.check_state_path(m.reserva, req.reservas_avanzadas(m)))
add("v7_check_overlaps", lambda m: joins.reservas_en_conflicto(m.reserva))

# visibility -----------------------------------------------------------------


def grants(name: str, *tables: str) -> None:
    def build(m: Marketplace) -> DataFrame:
        parts = [visibility.grants(m.table(t), t, m.empleado) for t in tables]
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result
    add(name, build)


grants("r1_visible_usuario", "usuario")
grants("r2_visible_cliente_proveedor", "cliente", "proveedor")
grants("r3_visible_admin", "admin")
grants("r4_visible_intento_login", "intento_login")
grants("r5_visible_tokens", "token_refresh", "token_reset_password", "email_verification_token")
add("r6_visible_auditoria", lambda m: visibility.grants(_audit(m), "registro_auditoria").drop("id").groupBy(
    "tabla", "alcance", "beneficiario").agg(F.count("*").alias("filas")))
grants("r7_visible_categoria", "categoria_servicio")
grants("r8_visible_servicio", "servicio")
grants("r9_visible_empleado", "empleado")
grants("r10_visible_agenda", "empleado_servicio", "horario_laboral", "bloqueo_horario")
grants("r11_visible_reserva", "reserva")


def writes(table: str, cambios: Callable[[Marketplace], DataFrame], as_of: str) -> None:
    add(f"r12_check_changes_{table}", lambda m: visibility.check_changes(
        cambios(m), table, visibility.principals(m.auth_users), m.empleado, as_of))


writes("reserva", req.cambios_reserva, AS_OF_BOOKING)
writes("usuario", req.cambios_usuario, AS_OF_AUTH)
writes("servicio", req.cambios_servicio, AS_OF_BOOKING)
writes("horario_laboral", req.cambios_horario, AS_OF_BOOKING)
writes("token_refresh", req.cambios_token, AS_OF_AUTH)
writes("cliente", req.cambios_cliente, AS_OF_AUTH)
writes("admin", req.cambios_admin, AS_OF_AUTH)
writes("categoria_servicio", req.cambios_categoria, AS_OF_BOOKING)
writes("bloqueo_horario", req.cambios_bloqueo, AS_OF_BOOKING)
writes("intento_login", req.cambios_intento, "2024-04-15 00:00:00")
add("r13_role_predicates", lambda m: visibility.role_predicates(visibility.principals(m.auth_users)))
add("r14_access_matrix", lambda m: visibility.access_matrix(
    m.tables() | {"registro_auditoria": _audit(m)}, visibility.principals(m.auth_users)))


# streams --------------------------------------------------------------------

def _stored(m: Marketplace, rows: DataFrame, name: str) -> str:
    path = shared_dir(m.spark, name)
    rows.write.parquet(path)
    return path


@plan("t1_change_stream")
def _(m: Marketplace) -> DataFrame:
    asked = req.cancelaciones(m)
    feed = _stored(m, asked, "t1-feed")
    log = streams.ChangeLog.create(m.reserva, shared_dir(m.spark, "t1-tabla"), "id_reserva")
    step = streams.change_step(log, lambda rows, batch: changes.cancelar_reserva(rows, batch, AS_OF_BOOKING),
                               shared_dir(m.spark, "t1-answers"))
    stream = streams.read_parquet_stream(m.spark, feed, asked.schema)
    streams.run_batches(stream, step, shared_dir(m.spark, "t1-checkpoint"))
    return log.current().select(*_RESERVA)


def _logins(m: Marketplace) -> DataFrame:
    return login_log(streams.read_table_stream(m.spark, m.folder, "events", m.source("events").schema))


@plan("t2_failed_login_monitor")
def _(m: Marketplace) -> DataFrame:
    sink = shared_dir(m.spark, "t2-sink")
    monitor = streams.failed_login_monitor(_logins(m), "24 hours", "6 hours", minimo=3)
    streams.run_windows(monitor, sink, shared_dir(m.spark, "t2-checkpoint"))
    windows = streams.newest_windows(m.spark, sink, monitor.schema, ["inicio", "fin", "id_usuario"])
    each = shared_dir(m.spark, "t2-ips")
    addresses = streams.failed_login_addresses(_logins(m), "24 hours", "6 hours")
    streams.run_windows(addresses, each, shared_dir(m.spark, "t2-checkpoint"))
    return streams.with_addresses(windows, streams.newest_windows(
        m.spark, each, addresses.schema, ["inicio", "fin", "id_usuario", "direccion_ip"]))


@plan("t2_failed_login_addresses")
def _(m: Marketplace) -> DataFrame:
    sink = shared_dir(m.spark, "t2-direcciones")
    monitor = streams.failed_login_addresses(_logins(m))
    streams.run_windows(monitor, sink, shared_dir(m.spark, "t2-checkpoint"))
    return streams.newest_windows(m.spark, sink, monitor.schema, ["inicio", "fin", "id_usuario", "direccion_ip"])


@plan("t3_audit_stream")
def _(m: Marketplace) -> DataFrame:
    old = m.usuario.select("id_usuario", F.struct(*m.usuario.columns).alias("antes"))
    edited = req.usuarios_editados(m)
    new = edited.select("id_usuario", F.struct(*edited.columns).alias("despues"))
    images = old.join(new, "id_usuario").select(
        "antes", "despues", F.lit(AS_OF_AUTH).cast("timestamp_ntz").alias("fecha"), F.lit("A0").alias("uid"))
    feed = _stored(m, images, "t3-feed")
    audited = streams.audit_stream(streams.read_parquet_stream(m.spark, feed, images.schema))
    sink = shared_dir(m.spark, "t3-sink")
    streams.run(audited, sink, shared_dir(m.spark, "t3-checkpoint"))
    return _audit_fields(m.spark.read.schema(audited.schema).parquet(sink))


def _expired(m: Marketplace) -> DataFrame:
    """The event log as a stream of tokens and logins, held until they expire, ten days for logins."""
    live = Marketplace(m.spark, m.folder)
    live.source = lambda name: streams.read_table_stream(m.spark, m.folder, name, m.source(name).schema)
    feeds = [streams.expiry_feed("token_refresh", live.token_refresh, "id_token", "fecha_creacion", F.col("fecha_expiracion")),
             streams.expiry_feed("token_reset_password", live.token_reset_password, "id_token", "fecha_creacion",
                                 F.col("fecha_expiracion"), F.col("usado")),
             streams.expiry_feed("intento_login", live.intento_login, "id_intento", "fecha_hora", shifted(F.col("fecha_hora"), days=10))]
    sink = shared_dir(m.spark, "t4-sink")
    streams.run_expiry(streams.expiry_stream(feeds[0].unionByName(feeds[1]).unionByName(feeds[2])), sink,
                       shared_dir(m.spark, "t4-checkpoint"))
    return streams.expiry_outcome(m.spark, sink)


@plan("t4_expiry_stream")
def _(m: Marketplace) -> DataFrame:
    return _expired(m).groupBy("tabla").agg(F.count_if("eliminada").alias("eliminadas"),
                                            F.count_if(~F.col("eliminada")).alias("conservadas"))


add("t4_expiry_stream_tabla", lambda m: _expired(m).filter("NOT eliminada").select("tabla", "id", "vence"))


@plan("t5_hourly_bookings")
def _(m: Marketplace) -> DataFrame:
    feed = _stored(m, m.reserva, "t5-feed")
    hourly = streams.hourly_bookings(streams.read_parquet_stream(m.spark, feed, m.reserva.schema), "24 hours")
    sink = shared_dir(m.spark, "t5-sink")
    streams.run_windows(hourly, sink, shared_dir(m.spark, "t5-checkpoint"))
    return streams.newest_windows(m.spark, sink, hourly.schema, ["inicio", "id_proveedor", "estado"])


# SQL functions --------------------------------------------------------------

def sql_function(name: str, call: str, *unions: str) -> None:
    """Register a query that calls one of the SQL functions for many rows.

    Spark 4.1 cannot plan a function with EXISTS over a view that is a union; ``unions`` are written as tables first.
    """
    def build(m: Marketplace) -> DataFrame:
        people = visibility.principals(m.auth_users)
        tables = m.tables() | {t: materialize(m.table(t), t) for t in unions}
        sql.register(m.spark, tables, materialize(people, "principal") if "usuario" in unions else people)
        return m.spark.sql(call)
    add(f"f_{name}", build)


_SPAN = f"TIMESTAMP_NTZ'{DESDE}', TIMESTAMP_NTZ'{HASTA}'"
sql_function("servicios_de_proveedor",
             "SELECT p.id_usuario AS id_proveedor, f.* FROM proveedor AS p, LATERAL servicios_de_proveedor(p.id_usuario) AS f")
sql_function("servicios_de_empleado",
             "SELECT e.id_empleado, f.* FROM empleado AS e, LATERAL servicios_de_empleado(e.id_empleado, FALSE) AS f")
sql_function("horario_de_empleado",
             "SELECT e.id_empleado, f.* FROM empleado AS e, LATERAL horario_de_empleado(e.id_empleado, 'LUNES') AS f")
sql_function("bloqueos_de_empleado", "SELECT e.id_empleado, f.* FROM empleado AS e, "
             f"LATERAL bloqueos_de_empleado(e.id_empleado, DATE'{DESDE[:10]}', DATE'{AS_OF_BOOKING[:10]}') AS f")
sql_function("reservas_de_cliente",
             "SELECT c.id_usuario AS id_cliente, f.* FROM cliente AS c, LATERAL reservas_de_cliente(c.id_usuario, 'COMPLETADA') AS f")
sql_function("reservas_de_empleado",
             f"SELECT e.id_empleado, f.* FROM empleado AS e, LATERAL reservas_de_empleado(e.id_empleado, {_SPAN}) AS f")
sql_function("empleados_de_proveedor",
             "SELECT p.id_usuario AS id_proveedor, f.* FROM proveedor AS p, LATERAL empleados_de_proveedor(p.id_usuario) AS f")
sql_function("estadisticas_de_proveedor",
             "SELECT p.id_usuario AS id_proveedor, f.* EXCEPT (tasa_cancelacion), CAST(f.tasa_cancelacion AS DOUBLE) AS tasa_cancelacion "
             f"FROM proveedor AS p, LATERAL estadisticas_de_proveedor(p.id_usuario, {_SPAN}) AS f")
sql_function("hay_conflicto", """
    SELECT id_reserva, hay_conflicto(id_empleado, fecha_hora_inicio, fecha_hora_fin, id_reserva) AS conflicto
    FROM reserva WHERE fecha_hora_inicio < fecha_hora_fin""")
sql_function("esta_disponible", """
    SELECT id_bloqueo, esta_disponible(id_empleado, fecha, hora_inicio - 30, hora_inicio) AS disponible FROM bloqueo_horario""",
             "bloqueo_horario")
sql_function("tiene_rol", "SELECT id_usuario, tiene_rol(id_usuario, 'admin') AS es_admin FROM usuario", "usuario")
sql_function("es_de_tipo", "SELECT id_usuario, es_de_tipo(id_usuario, 'CLIENTE') AS es_cliente FROM usuario", "usuario")


# entry ----------------------------------------------------------------------

def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: PLANS[name](Marketplace(spark, folder))
