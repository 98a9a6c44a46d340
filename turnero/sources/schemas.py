"""Column contracts of the sixteen booking tables.

One specification drives the Spark schema, the ingest defaults, the integrity
rules and the storage profile.  Times of day are minutes since midnight;
timestamps are UTC wall clock (``TIMESTAMP_NTZ``), so no result depends on the
session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NOW = "now"          # default: the operator's clock
NEW_ID = "new_id"    # default: a generated identifier

# States, roles and names every client of the tables shares.
ESTADOS_USUARIO = ("ACTIVO", "INACTIVO", "SUSPENDIDO", "BLOQUEADO")
TIPOS_USUARIO = ("CLIENTE", "PROVEEDOR", "ADMIN")
ESTADOS_RESERVA = ("PENDIENTE", "CONFIRMADA", "EN_PROGRESO", "COMPLETADA", "CANCELADA", "NO_SHOW")
RESERVA_ACTIVA = ("PENDIENTE", "CONFIRMADA", "EN_PROGRESO")
RESERVA_CERRADA = ("COMPLETADA", "CANCELADA", "NO_SHOW")
TIPOS_BLOQUEO = ("RESERVA", "VACACIONES", "PERMISO", "ADMINISTRATIVO")
DIAS_SEMANA = ("LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO")
CATEGORIAS_INICIALES = (
    ("Belleza y Spa", "Servicios de belleza, cuidado personal, spa y bienestar"),
    ("Salud", "Servicios médicos, odontológicos, terapéuticos y de salud"),
    ("Deportes y Fitness", "Gimnasios, entrenadores personales, clases deportivas"),
    ("Educación", "Clases particulares, tutorías, cursos y capacitaciones"),
    ("Hogar", "Servicios de limpieza, mantenimiento, reparaciones del hogar"),
    ("Tecnología", "Soporte técnico, desarrollo de software, consultoría IT"),
    ("Eventos", "Organización de eventos, fotografía, catering, música"),
    ("Mascotas", "Veterinaria, peluquería canina, paseo de mascotas"),
    ("Transporte", "Servicios de transporte, mudanzas, delivery"),
    ("Profesionales", "Consultoría legal, contable, financiera y otros servicios profesionales"),
)


@dataclass(frozen=True)
class Kind:
    """A storage kind: its Spark type and its fixed width (None = variable)."""

    spark: T.DataType
    width: int | None


KINDS = {
    "uuid": Kind(T.StringType(), 16),
    "text": Kind(T.StringType(), None),
    "bool": Kind(T.BooleanType(), 1),
    "int": Kind(T.IntegerType(), 4),
    "money": Kind(T.DecimalType(10, 2), 8),
    "instant": Kind(T.TimestampNTZType(), 8),
    "date": Kind(T.DateType(), 4),
    "minutes": Kind(T.IntegerType(), 8),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    nullable: bool = False
    default: object = None
    max_len: int | None = None
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    columns: tuple[Column, ...]
    unique: tuple[str, ...] = ()
    # rule name -> SQL predicate over the row; NULL passes
    checks: dict[str, str] = field(default_factory=dict)
    # column -> parent table, enforced inside one database
    parents: dict[str, str] = field(default_factory=dict)
    # column -> parent table that lives in another database
    logical_parents: dict[str, str] = field(default_factory=dict)
    created: str = "created_at"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, KINDS[c.kind].spark, True) for c in self.columns])

    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _id(name: str = "", nullable: bool = False, default: object = None) -> Column:
    return Column(name, "uuid", nullable, default)


def _text(name: str, size: int | None, nullable: bool = False, default: object = None, allowed=None) -> Column:
    return Column(name, "text", nullable, default, size, allowed)


def _flag(name: str, default: object = None) -> Column:
    return Column(name, "bool", False, default)


def _at(name: str, nullable: bool = False, default: object = None) -> Column:
    return Column(name, "instant", nullable, default)


_CREATED = _at("created_at", True, NOW)
_UPDATED = _at("updated_at", True, NOW)
_VIDA = "fecha_expiracion > fecha_creacion"

_SPECS = (
    Table(
        "usuario", "id_usuario",
        (_id("id_usuario", default=NEW_ID), _text("email", 100), _text("password_hash", 255),
         _flag("email_verificado", False), Column("intentos_fallidos", "int", False, 0),
         _at("bloqueado_hasta", True), _at("fecha_registro", default=NOW),
         _text("estado", 20, default="ACTIVO", allowed=ESTADOS_USUARIO),
         _text("tipo_usuario", 20, allowed=TIPOS_USUARIO), _CREATED, _UPDATED),
        unique=("email",), created="fecha_registro",
    ),
    Table(
        "cliente", "id_usuario",
        (_id("id_usuario"), _text("nombre", 100), _text("telefono", 20, True), _CREATED, _UPDATED),
        parents={"id_usuario": "usuario"},
    ),
    Table(
        "proveedor", "id_usuario",
        (_id("id_usuario"), _text("nombre_comercial", 150), _id("id_categoria"), _text("direccion", 200, True),
         _text("telefono_contacto", 20, True), _CREATED, _UPDATED),
        parents={"id_usuario": "usuario"}, logical_parents={"id_categoria": "categoria_servicio"},
    ),
    Table(
        "admin", "id_usuario",
        (_id("id_usuario"), _text("nombre_completo", 150), _text("codigo_empleado", 50, True),
         _text("telefono", 20, True), _at("fecha_asignacion", default=NOW), _flag("activo", True),
         _id("creado_por", True), _CREATED, _UPDATED),
        parents={"id_usuario": "usuario", "creado_por": "admin"},
    ),
    Table(
        "intento_login", "id_intento",
        (_id("id_intento", default=NEW_ID), _id("id_usuario"), _at("fecha_hora", default=NOW), _flag("exitoso"),
         _text("direccion_ip", 45), _text("info_dispositivo", 255, True), _text("mensaje_error", 200, True),
         _CREATED),
        parents={"id_usuario": "usuario"}, created="fecha_hora",
    ),
    Table(
        "token_refresh", "id_token",
        (_id("id_token", default=NEW_ID), _id("id_usuario"), _text("token", 500),
         _at("fecha_creacion", default=NOW), _at("fecha_expiracion"), _flag("revocado", False),
         _at("fecha_revocacion", True), _text("info_dispositivo", 255, True), _text("direccion_ip", 45), _CREATED),
        unique=("token",),
        checks={"vida_positiva": _VIDA, "revocacion_posterior": "fecha_revocacion >= fecha_creacion"},
        parents={"id_usuario": "usuario"}, created="fecha_creacion",
    ),
    Table(
        "token_reset_password", "id_token",
        (_id("id_token", default=NEW_ID), _id("id_usuario"), _text("token", 255),
         _at("fecha_creacion", default=NOW), _at("fecha_expiracion"), _flag("usado", False),
         _at("fecha_uso", True), _text("direccion_ip_solicitud", 45), _CREATED),
        unique=("token",),
        checks={"vida_positiva": _VIDA, "uso_posterior": "fecha_uso >= fecha_creacion",
                "uso_vigente": "fecha_uso <= fecha_expiracion"},
        parents={"id_usuario": "usuario"}, created="fecha_creacion",
    ),
    Table(
        "email_verification_token", "id_token",
        (_id("id_token", default=NEW_ID), _id("id_usuario"), _text("token", 500),
         _at("fecha_creacion", default=NOW), _at("fecha_expiracion"), _flag("usado", False), _CREATED, _UPDATED),
        unique=("id_usuario", "token"),
        checks={"vida_positiva": _VIDA,
                "vida_maxima": "fecha_expiracion <= timestampadd(HOUR, 48, fecha_creacion)"},
        parents={"id_usuario": "usuario"}, created="fecha_creacion",
    ),
    Table(
        "registro_auditoria", "id_registro",
        (_id("id_registro", default=NEW_ID), _text("nombre_tabla", 100), _id("id_registro_afectado"),
         _text("operacion", 10), _id("modificado_por", True), _at("fecha_modificacion", default=NOW),
         _text("valores_anteriores", None, True), _text("valores_nuevos", None, True),
         _text("direccion_ip", None, True), _text("agente_usuario", None, True)),
        created="fecha_modificacion",
    ),
    Table(
        "categoria_servicio", "id_categoria",
        (_id("id_categoria", default=NEW_ID), _text("nombre_categoria", 100), _text("descripcion", 500, True),
         _flag("activa", True), _CREATED, _UPDATED),
        unique=("nombre_categoria",),
    ),
    Table(
        "servicio", "id_servicio",
        (_id("id_servicio", default=NEW_ID), _id("id_proveedor"), _text("nombre_servicio", 100),
         Column("duracion_minutos", "int"), Column("precio", "money"), _text("descripcion", 500, True),
         _flag("activo", True), Column("capacidad_maxima", "int", False, 1), _CREATED, _UPDATED),
        checks={"duracion_positiva": "duracion_minutos > 0", "precio_no_negativo": "precio >= 0",
                "capacidad_no_negativa": "capacidad_maxima >= 0"},
        logical_parents={"id_proveedor": "proveedor"},
    ),
    Table(
        "empleado", "id_empleado",
        (_id("id_empleado", default=NEW_ID), _id("id_proveedor"), _text("nombre_completo", 150),
         _text("telefono", 20, True), _flag("activo", True), _at("fecha_contratacion", True),
         _text("notas", 500, True), _CREATED, _UPDATED),
        logical_parents={"id_proveedor": "proveedor"},
    ),
    Table(
        "empleado_servicio", "id_empleado_servicio",
        (_id("id_empleado_servicio", default=NEW_ID), _id("id_empleado"), _id("id_servicio"),
         _flag("activo", True), _at("fecha_asignacion", default=NOW), _CREATED, _UPDATED),
        parents={"id_empleado": "empleado"}, logical_parents={"id_servicio": "servicio"},
    ),
    Table(
        "horario_laboral", "id_horario",
        (_id("id_horario", default=NEW_ID), _id("id_empleado"), _text("dia_semana", 10, allowed=DIAS_SEMANA),
         Column("hora_inicio", "minutes"), Column("hora_fin", "minutes"), _flag("activo", True),
         _CREATED, _UPDATED),
        checks={"horas_validas": "hora_fin > hora_inicio"}, parents={"id_empleado": "empleado"},
    ),
    Table(
        "bloqueo_horario", "id_bloqueo",
        (_id("id_bloqueo", default=NEW_ID), _id("id_empleado"), _id("id_reserva", True), Column("fecha", "date"),
         Column("hora_inicio", "minutes"), Column("hora_fin", "minutes"),
         _text("tipo_bloqueo", 20, default="RESERVA", allowed=TIPOS_BLOQUEO), _flag("activo", True),
         _CREATED, _UPDATED),
        checks={"horas_validas": "hora_fin > hora_inicio"}, parents={"id_empleado": "empleado"},
        logical_parents={"id_reserva": "reserva"},
    ),
    Table(
        "reserva", "id_reserva",
        (_id("id_reserva", default=NEW_ID), _id("id_cliente"), _id("id_servicio"), _id("id_empleado"),
         _id("id_proveedor"), _at("fecha_hora_inicio"), _at("fecha_hora_fin"),
         _text("estado", 20, default="PENDIENTE", allowed=ESTADOS_RESERVA), _at("fecha_creacion", default=NOW),
         _at("fecha_cancelacion", True), _text("comentarios", 500, True), _CREATED, _UPDATED),
        checks={"fechas_validas": "fecha_hora_fin > fecha_hora_inicio",
                "cancelacion_posterior": "fecha_cancelacion >= fecha_creacion"},
        logical_parents={"id_cliente": "cliente", "id_servicio": "servicio", "id_empleado": "empleado",
                         "id_proveedor": "proveedor"},
        created="fecha_creacion",
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _SPECS}
