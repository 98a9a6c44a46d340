"""Change requests and faulty feeds derived from whole tables.

They give the registered queries something to decide on: one request per row
of the table it aims at, with arguments that make some apply and some not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.functions.clock import minute_of_day, shifted
from turnero.sources.marketplace import Marketplace
from turnero.sources.schemas import ESTADOS_RESERVA


def _moved(reservas: DataFrame, **units: int) -> dict[str, Column]:
    return {"fecha_hora_inicio": shifted(F.col("fecha_hora_inicio"), **units),
            "fecha_hora_fin": shifted(F.col("fecha_hora_fin"), **units)}


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumns({"id_solicitud": F.concat(F.lit("Q"), key), "orden": F.col(key)})


def traslados(m: Marketplace) -> DataFrame:
    """Every booking asks for the slot twenty minutes later, leaving itself out."""
    rows = m.reserva.select("id_reserva", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin")
    return _numbered(rows.withColumns(_moved(rows, mins=20)), "id_reserva").select(
        "id_solicitud", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin", F.col("id_reserva").alias("id_excluir"))


def consultas_disponibilidad(m: Marketplace) -> DataFrame:
    """Every booking asks whether its employee is free half an hour later."""
    rows = m.reserva.select("id_reserva", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin")
    later = _numbered(rows.withColumns(_moved(rows, mins=30)), "id_reserva")
    start, end = F.col("fecha_hora_inicio"), F.col("fecha_hora_fin")
    return later.select("id_solicitud", "id_empleado", F.to_date(start).alias("fecha"),
                        minute_of_day(start).alias("hora_inicio"), minute_of_day(end, up=True).alias("hora_fin"))


def reservas_nuevas(m: Marketplace) -> DataFrame:
    """Every booking is asked for again one day later."""
    rows = m.reserva.select("id_reserva", "id_cliente", "id_servicio", "id_empleado", "id_proveedor",
                            "fecha_hora_inicio", "fecha_hora_fin", "comentarios")
    return _numbered(rows.withColumns(_moved(rows, days=1)), "id_reserva").drop("id_reserva")


def confirmaciones(m: Marketplace) -> DataFrame:
    """Every booking is confirmed, those without remarks by a provider that does not own them."""
    owner = F.when(F.col("comentarios").isNull(), "P-ajeno").otherwise(F.col("id_proveedor"))
    return _numbered(m.reserva.select("id_reserva", owner.alias("id_proveedor")), "id_reserva")


def cancelaciones(m: Marketplace) -> DataFrame:
    remark = F.when(~F.col("id_empleado").endswith("5"), F.concat(F.lit("motivo "), "id_servicio"))
    return _numbered(m.reserva.select("id_reserva", remark.alias("comentario")), "id_reserva")


def reagendas(m: Marketplace) -> DataFrame:
    """Every booking asks for a slot twenty minutes later, and then for the one its employee's next booking had at first.

    So bookings move twice, in chains, into slots that others have left, taken or kept.
    """
    moved = _moved(m.reserva, mins=20)
    later = m.reserva.select("id_reserva", moved["fecha_hora_inicio"].alias("nuevo_inicio"),
                             moved["fecha_hora_fin"].alias("nuevo_fin"))
    following = Window.partitionBy("id_empleado").orderBy("fecha_hora_inicio", "id_reserva")
    next_slot = m.reserva.select("id_reserva", F.lead("fecha_hora_inicio").over(following).alias("nuevo_inicio"),
                                 F.lead("fecha_hora_fin").over(following).alias("nuevo_fin"))
    first = _numbered(later, "id_reserva")
    second = next_slot.filter("nuevo_inicio IS NOT NULL").withColumns({
        "id_solicitud": F.concat(F.lit("S"), "id_reserva"), "orden": F.concat("id_reserva", F.lit("+"))})
    return first.unionByName(second)


def reservas_editadas(m: Marketplace) -> DataFrame:
    """New images of every booking: pending ones cancelled, cancelled ones reopened."""
    state = F.col("estado")
    return m.reserva.withColumn(
        "estado", F.when(state == "PENDIENTE", "CANCELADA").when(state == "CANCELADA", "PENDIENTE").otherwise(state))


def reservas_avanzadas(m: Marketplace) -> DataFrame:
    """New images whose state moved as many steps round the list as the start minute says."""
    states = F.array(*(F.lit(s) for s in ESTADOS_RESERVA))
    position = F.array_position(states, F.col("estado")) - 1 + F.minute("fecha_hora_inicio")
    return m.reserva.withColumn("estado", F.element_at(states, (position % 6 + 1).cast("int")))


def usuarios_editados(m: Marketplace) -> DataFrame:
    """New images of every account: some emails change, locked accounts open."""
    return m.usuario.withColumns({
        "email": F.when(F.col("intentos_fallidos") == 3, F.concat(F.lit("x"), "email")).otherwise(F.col("email")),
        "estado": F.when(F.col("estado") == "BLOQUEADO", "ACTIVO").otherwise(F.col("estado"))})


def usuario_repetido(m: Marketplace) -> DataFrame:
    """Accounts of which the inactive share e-mail addresses."""
    shared = F.concat(F.substring("id_usuario", 1, 2), F.lit("@example.test"))
    return m.usuario.withColumn("email", F.when(F.col("estado") == "INACTIVO", shared).otherwise(F.col("email")))


def token_repetido(m: Marketplace) -> DataFrame:
    """Refresh tokens of which an account's revoked ones are the same."""
    shared = F.concat(F.lit("T-"), "id_usuario")
    return m.token_refresh.withColumn("token", F.when(F.col("revocado"), shared).otherwise(F.col("token")))


def usuarios_con_estado(m: Marketplace, estado: str) -> DataFrame:
    return _numbered(m.usuario.filter(F.col("estado") == estado).select("id_usuario"), "id_usuario")


def todas(rows: DataFrame, key: str) -> DataFrame:
    """One bare request per row."""
    return _numbered(rows.select(key), key)


def asignaciones_pedidas(m: Marketplace) -> DataFrame:
    """One request per booking for its (employee, service) pair, so pairs repeat."""
    rows = m.reserva.select("id_reserva", "id_empleado", "id_servicio")
    return _numbered(rows, "id_reserva").drop("id_reserva")


def precios_nuevos(m: Marketplace) -> DataFrame:
    """Every service gets a new name and price; group services are claimed by someone else."""
    owner = F.when(F.col("capacidad_maxima") > 1, "P-ajeno").otherwise(F.col("id_proveedor"))
    rows = m.servicio.select(
        "id_servicio", owner.alias("id_proveedor"),
        F.concat("nombre_servicio", F.lit(" premium")).alias("nombre_servicio_nuevo"),
        (F.col("precio") + 10).cast("decimal(10,2)").alias("precio_nuevo"))
    return _numbered(rows, "id_servicio")


def categorias_nuevas(m: Marketplace) -> DataFrame:
    """Every category is renamed and switched on."""
    rows = m.categoria_servicio.select(
        "id_categoria", F.concat("nombre_categoria", F.lit(" y más")).alias("nombre_categoria_nuevo"),
        F.lit(True).alias("activa_nuevo"))
    return _numbered(rows, "id_categoria")


def empleados_nuevos(m: Marketplace) -> DataFrame:
    """Every employee gets new contact data; those without a phone are claimed by someone else."""
    owner = F.when(F.col("telefono").isNull(), "P-ajeno").otherwise(F.col("id_proveedor"))
    rows = m.empleado.select(
        "id_empleado", owner.alias("id_proveedor"), F.concat("nombre_completo", F.lit(" López")).alias(
            "nombre_completo_nuevo"), F.lit("+57 310").alias("telefono_nuevo"), F.lit("nota").alias("notas_nuevo"))
    return _numbered(rows, "id_empleado")


def dias_libres(m: Marketplace) -> DataFrame:
    """Every employee takes Saturdays off."""
    rows = m.empleado.select("id_empleado", F.lit("SABADO").alias("dia_semana"), F.lit(False).alias("activo_nuevo"))
    return _numbered(rows, "id_empleado")


# faulty feeds ---------------------------------------------------------------

def usuario_defectuoso(m: Marketplace) -> DataFrame:
    return m.usuario.withColumns({
        "email": F.when(F.col("estado") == "BLOQUEADO", F.rpad("email", 120, "x")).otherwise(F.col("email")),
        "tipo_usuario": F.when(F.col("intentos_fallidos") == 6, "OTRO").otherwise(F.col("tipo_usuario"))})


def servicio_defectuoso(m: Marketplace) -> DataFrame:
    return m.servicio.withColumns({
        "nombre_servicio": F.when(F.col("duracion_minutos") != 30, F.col("nombre_servicio")),
        "duracion_minutos": F.col("duracion_minutos") - 60,
        "precio": (F.col("precio") - 1000).cast("decimal(10,2)")})


def reserva_defectuosa(m: Marketplace) -> DataFrame:
    start = F.col("fecha_hora_inicio")
    return m.reserva.withColumns({
        "estado": F.when((F.col("estado") == "NO_SHOW") & F.col("comentarios").isNull(), "ARCHIVADA")
        .otherwise(F.col("estado")),
        "fecha_hora_fin": F.when(F.minute(start) == 30, start).otherwise(F.col("fecha_hora_fin")),
        "fecha_cancelacion": shifted(F.col("fecha_cancelacion"), hours=-2)})


def tablas_defectuosas(m: Marketplace) -> dict[str, DataFrame]:
    return {**m.tables(), "usuario": usuario_defectuoso(m), "servicio": servicio_defectuoso(m),
            "reserva": reserva_defectuosa(m)}


# change batches for the write policies --------------------------------------

def _changes(rows: DataFrame, key: str, cases: list[tuple[str, Column, str, dict[str, Column] | None]]) -> DataFrame:
    """Per row and case (name, uid, command, edits): a change with its images."""
    image = F.struct(*rows.columns)
    none = F.lit(None).cast(rows.select(image.alias("s")).schema["s"].dataType)
    items = []
    for name, uid, command, edits in cases:
        edited = F.struct(*((edits or {}).get(c, F.col(c)).cast(rows.schema[c].dataType).alias(c)
                            for c in rows.columns))
        items.append(F.struct(
            F.concat_ws("/", key, F.lit(name)).alias("id_cambio"), uid.alias("uid"), F.lit(command).alias("comando"),
            (none if command == "INSERT" else image).alias("antes"),
            (none if command == "DELETE" else edited).alias("despues")))
    return rows.select(F.inline(F.array(*items)))


def cambios_reserva(m: Marketplace) -> DataFrame:
    client, provider = F.col("id_cliente"), F.col("id_proveedor")
    return _changes(m.reserva, "id_reserva", [
        ("cancela", client, "UPDATE", {"estado": F.lit("CANCELADA")}),
        ("comenta", client, "UPDATE", {"comentarios": F.lit("nota")}),
        ("cede", provider, "UPDATE", {"id_proveedor": F.lit("P1")}),
        ("soporte", F.lit("X1"), "UPDATE", {"estado": F.lit("CONFIRMADA")}),
        ("crea", client, "INSERT", None),
        ("crea_ajena", provider, "INSERT", None),
        ("borra", F.lit("A0"), "DELETE", None),
        ("borra_propia", client, "DELETE", None),
    ])


def cambios_usuario(m: Marketplace) -> DataFrame:
    own = F.col("id_usuario")
    return _changes(m.usuario, "id_usuario", [
        ("correo", own, "UPDATE", {"email": F.lit("otro@example.test")}),
        ("clave", own, "UPDATE", {"password_hash": F.lit("h")}),
        ("sin_correo", own, "UPDATE", {"email": F.lit(None)}),
        ("ajeno", F.lit("C1"), "UPDATE", {"password_hash": F.lit("h")}),
        ("admin", F.lit("A0"), "UPDATE", {"estado": F.lit("INACTIVO")}),
        ("servicio", F.lit("X3"), "UPDATE", {"estado": F.lit("BLOQUEADO")}),
        ("alta", F.lit("A0"), "INSERT", None),
        ("baja", own, "DELETE", None),
    ])


def cambios_servicio(m: Marketplace) -> DataFrame:
    owner = F.col("id_proveedor")
    return _changes(m.servicio, "id_servicio", [
        ("precio", owner, "UPDATE", {"precio": F.lit(1)}),
        ("cede", owner, "UPDATE", {"id_proveedor": F.lit("P1")}),
        ("desactiva", owner, "UPDATE", {"activo": F.lit(False)}),
        ("cliente", F.lit("C1"), "UPDATE", {"precio": F.lit(1)}),
        ("admin", F.lit("A0"), "UPDATE", {"activo": F.lit(True)}),
        ("crea", owner, "INSERT", None),
        ("borra", owner, "DELETE", None),
        ("borra_admin", F.lit("A0"), "DELETE", None),
    ])


def cambios_horario(m: Marketplace) -> DataFrame:
    """Changes to weekly blocks by the first provider, by an admin and by support."""
    return _changes(m.horario_laboral, "id_horario", [
        ("propio", F.lit("P1"), "UPDATE", {"hora_fin": F.col("hora_fin") + 30}),
        ("traslada", F.lit("P1"), "UPDATE", {"id_empleado": F.lit("E0")}),
        ("admin", F.lit("A0"), "UPDATE", {"activo": F.lit(False)}),
        ("soporte", F.lit("X1"), "UPDATE", {"activo": F.lit(False)}),
        ("crea", F.lit("P1"), "INSERT", None),
        ("borra", F.lit("A0"), "DELETE", None),
        ("borra_servicio", F.lit("X3"), "DELETE", None),
    ])


def cambios_token(m: Marketplace) -> DataFrame:
    own = F.col("id_usuario")
    return _changes(m.token_refresh, "id_token", [
        ("revoca", own, "UPDATE", {"revocado": F.lit(True)}),
        ("extiende", own, "UPDATE", {"fecha_expiracion": shifted(F.col("fecha_expiracion"), days=9)}),
        ("cede", own, "UPDATE", {"revocado": F.lit(True), "id_usuario": F.lit("C1")}),
        ("emite", F.lit(None).cast("string"), "INSERT", None),
        ("purga", own, "DELETE", None),
        ("purga_servicio", F.lit("X3"), "DELETE", None),
    ])


def cambios_cliente(m: Marketplace) -> DataFrame:
    own, phone = F.col("id_usuario"), {"telefono": F.lit("1")}
    return _changes(m.cliente, "id_usuario", [
        ("telefono", own, "UPDATE", phone),
        ("ajeno", F.lit("C1"), "UPDATE", phone),
        ("admin", F.lit("A0"), "UPDATE", phone),
        ("alta", F.lit("A0"), "INSERT", None),
        ("alta_propia", own, "INSERT", None),
        ("baja", F.lit("A0"), "DELETE", None),
        ("baja_servicio", F.lit("X3"), "DELETE", None),
    ])


def cambios_admin(m: Marketplace) -> DataFrame:
    return _changes(m.admin, "id_usuario", [
        ("admin", F.lit("A0"), "UPDATE", {"activo": F.lit(False)}),
        ("propio", F.col("id_usuario"), "UPDATE", {"activo": F.lit(False)}),
        ("soporte", F.lit("X1"), "UPDATE", {"activo": F.lit(False)}),
        ("baja", F.lit("A0"), "DELETE", None),
        ("baja_servicio", F.lit("X3"), "DELETE", None),
    ])


def cambios_categoria(m: Marketplace) -> DataFrame:
    return _changes(m.categoria_servicio, "id_categoria", [
        ("admin", F.lit("A0"), "UPDATE", {"activa": F.lit(False)}),
        ("proveedor", F.lit("P1"), "UPDATE", {"activa": F.lit(False)}),
        ("crea", F.lit("A0"), "INSERT", None),
        ("crea_anonimo", F.lit(None).cast("string"), "INSERT", None),
        ("borra", F.lit("A0"), "DELETE", None),
    ])


def cambios_bloqueo(m: Marketplace) -> DataFrame:
    return _changes(m.bloqueo_horario, "id_bloqueo", [
        ("crea", F.lit(None).cast("string"), "INSERT", None),
        ("propio", F.lit("P1"), "UPDATE", {"activo": F.lit(False)}),
        ("admin", F.lit("A0"), "UPDATE", {"activo": F.lit(False)}),
        ("borra", F.lit("A0"), "DELETE", None),
        ("borra_servicio", F.lit("X3"), "DELETE", None),
    ])


def cambios_intento(m: Marketplace) -> DataFrame:
    own = F.col("id_usuario")
    return _changes(m.intento_login, "id_intento", [
        ("registra", F.lit(None).cast("string"), "INSERT", None),
        ("edita", own, "UPDATE", {"exitoso": F.lit(True)}),
        ("purga_propia", own, "DELETE", None),
        ("purga_ajena", F.lit("C1"), "DELETE", None),
        ("purga_admin", F.lit("A0"), "DELETE", None),
    ])
