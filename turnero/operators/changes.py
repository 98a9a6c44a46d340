"""Bulk state changes as pure functions of snapshots.

Every operator takes the current table and a frame of requests and returns
``(snapshot, results)``: the table after the batch, and one row per request
with ``aplicado`` (was a row changed?) and the returned columns.

Requests carry ``id_solicitud`` (unique), ``orden`` (unique per key, the order
in which they arrived), the key they aim at and their arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.functions.clock import Instant, instant, minute_of_day, shifted
from turnero.operators.joins import empleado_disponible, validar_conflicto_horario, with_day_columns
from turnero.operators.lists import active_bookings
from turnero.operators.overlap import admit_in_order
from turnero.operators.sequence import granted_in_order
from turnero.session import materialize, sized
from turnero.sources.schemas import RESERVA_ACTIVA, RESERVA_CERRADA, TABLES
from turnero.sources.tables import with_defaults

Changed = tuple[DataFrame, DataFrame]

COMENTARIO_CANCELACION = "Cancelada por usuario"  # fixed value
HORAS_BLOQUEO = 24                                # fixed value
DIAS_RETENCION = 30                               # fixed value


# core -----------------------------------------------------------------------

def _reduce(requests: DataFrame, keys: Sequence[str], args: Sequence[str], last: bool) -> DataFrame:
    """One request per key: the first or last in arrival order, with map-side combine."""
    best = F.max if last else F.min
    packed = F.struct("orden", "id_solicitud", *(a for a in args if a != "orden"))
    return (requests.groupBy(*keys).agg(best(packed).alias("_req"))
            .select(*keys, *(F.col(f"_req.{c}").alias(f"_{c}") for c in ("id_solicitud", *args)),
                    F.lit(True).alias("_asked")))


def _apply(table: DataFrame, requests: DataFrame, keys: Sequence[str], sets: dict[str, Column], as_of: Instant,
           guard: Column | None = None, args: Sequence[str] = (), last: bool = False) -> DataFrame:
    """The table with ``_hit`` and ``_id_solicitud``; set columns of hit rows replaced.

    ``sets`` and ``guard`` see the old row; an argument ``x`` is ``_x``.
    """
    joined = table.join(_reduce(requests, keys, args, last), list(keys), "left")
    hit = F.col("_asked").isNotNull() & (F.lit(True) if guard is None else guard)
    marked = joined.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    values = _with_stamps(table, sets, as_of)
    cells = [F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c)
             if c in values else F.col(c) for c in table.columns]
    return marked.select(*cells, "_hit", "_id_solicitud")


def _with_stamps(table: DataFrame, sets: dict[str, Column], as_of: Instant) -> dict[str, Column]:
    """Update maintenance: ``updated_at``, and ``fecha_cancelacion`` on the way into CANCELADA."""
    now, values = instant(as_of), dict(sets)
    if "updated_at" in table.columns and "revocado" not in table.columns and "usado" not in table.columns:
        values["updated_at"] = now
    if "fecha_cancelacion" in table.columns and "estado" in values:
        enters = (F.col("estado") != "CANCELADA") & (values["estado"] == "CANCELADA")
        values["fecha_cancelacion"] = F.when(enters, now).otherwise(F.col("fecha_cancelacion"))
    return values


def _answers(applied: DataFrame, requests: DataFrame, returning: Sequence[str]) -> DataFrame:
    """One row per request; the requests that changed rows carry the returned columns."""
    done = applied.filter("_hit").select(F.col("_id_solicitud").alias("id_solicitud"), *returning,
                                         F.lit(True).alias("_done"))
    return requests.select("id_solicitud").join(done, "id_solicitud", "left").select(
        "id_solicitud", F.coalesce("_done", F.lit(False)).alias("aplicado"), *returning)


def _snapshot(applied: DataFrame) -> DataFrame:
    return applied.drop("_hit", "_id_solicitud")


def transition(table: DataFrame, requests: DataFrame, keys: Sequence[str], guard: Column, sets: dict[str, Column],
               as_of: Instant, returning: Sequence[str], args: Sequence[str] = ()) -> Changed:
    """A guarded change whose effect makes its own guard false.

    The first request per key can apply, later ones find the row already
    changed.  ``keys`` holds the row key and any owner column the request must
    match.
    """
    applied = _apply(table, requests, keys, sets, as_of, guard, args)
    return _snapshot(applied), _answers(applied, requests, returning)


def overwrite(table: DataFrame, requests: DataFrame, keys: Sequence[str], sets: dict[str, Column], as_of: Instant,
              returning: Sequence[str] = (), args: Sequence[str] = ()) -> Changed:
    """An unguarded change: every request that finds its row applies and the last one stays.

    ``sets`` looks at the request alone, so each request is answered with the
    values that it set itself, also when a later one replaced them.
    """
    applied = _apply(table, requests, keys, sets, as_of, None, args, last=True)
    # Rows that share the keys (a weekday's blocks) answer a request once.
    values = _with_stamps(table, sets, as_of)
    columns = [c for c in returning if c not in keys]
    found = applied.filter("_hit").groupBy(*keys).agg(
        F.lit(True).alias("_done"), *(F.any_value(c).alias(c) for c in columns if c not in values))
    asked = requests.select("id_solicitud", *keys, *(F.col(a).alias(f"_{a}") for a in args))
    cells = [F.when(F.col("_done"), values[c].cast(table.schema[c].dataType)).alias(c) if c in values else F.col(c)
             for c in columns]
    answers = asked.join(found, list(keys), "left").select(
        "id_solicitud", F.coalesce("_done", F.lit(False)).alias("aplicado"), *cells)
    return _snapshot(applied), answers


# bookings -------------------------------------------------------------------

def confirmar_reserva(reservas: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Pending bookings of the requesting provider become confirmed."""
    return transition(reservas, solicitudes, ["id_reserva", "id_proveedor"], F.col("estado") == "PENDIENTE",
                      {"estado": F.lit("CONFIRMADA")}, as_of, ["id_reserva", "estado", "updated_at"])


def cancelar_reserva(reservas: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Open bookings become cancelled; ``comentario`` is appended to earlier remarks.

    When the requests carry ``id_cliente`` only that client's booking is cancelled.
    """
    keys = ["id_reserva", *(["id_cliente"] if "id_cliente" in solicitudes.columns else [])]
    remark = F.coalesce("_comentario", F.lit(COMENTARIO_CANCELACION))
    earlier = F.coalesce(F.concat("comentarios", F.lit(" | ")), F.lit(""))
    return transition(reservas, solicitudes, keys, ~F.col("estado").isin(*RESERVA_CERRADA),
                      {"estado": F.lit("CANCELADA"), "comentarios": F.concat(earlier, remark)}, as_of,
                      ["id_reserva", "estado", "fecha_cancelacion", "updated_at"], ["comentario"])


def reagendar_reserva(reservas: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Open bookings move to (nuevo_inicio, nuevo_fin) and become pending again, request by request in ``orden``.

    A move must not overlap another active booking of the employee as it stands
    once all earlier requests are decided: a slot left by an earlier move is
    free, one taken by it is not, and a booking can move several times.  The
    order must be unique per employee.  Each request is answered with its own
    values; the snapshot has the last ones.
    """
    slot = ["fecha_hora_inicio", "fecha_hora_fin"]
    active = active_bookings(reservas).select("id_reserva", "id_empleado", *slot)
    # A booking in none of the listed states stands in nobody's way until a request names it.
    other = F.when(~F.col("estado").isin(*RESERVA_ACTIVA), F.struct(*slot)).alias("_otro")
    open_rows = reservas.filter(~F.col("estado").isin(*RESERVA_CERRADA)).select("id_reserva", "id_empleado", other)
    moves = materialize(solicitudes.filter(F.col("nuevo_inicio") < F.col("nuevo_fin")).select(
        "id_solicitud", "orden", "id_reserva", "nuevo_inicio", "nuevo_fin").join(open_rows, "id_reserva"), "traslados")
    named = moves.filter("_otro IS NOT NULL").select("id_reserva", "id_empleado", "_otro.*").distinct()
    granted = granted_in_order(
        moves.withColumnsRenamed(dict(zip(["nuevo_inicio", "nuevo_fin"], slot))), "id_empleado", *slot, "orden", "id_solicitud",
        "id_reserva", active.unionByName(named))
    accepted = moves.join(granted, "id_solicitud", "left_semi")
    applied = _apply(reservas, accepted, ["id_reserva"],
                     {"fecha_hora_inicio": F.col("_nuevo_inicio"), "fecha_hora_fin": F.col("_nuevo_fin"),
                      "estado": F.lit("PENDIENTE")}, as_of, None, ["nuevo_inicio", "nuevo_fin"], last=True)
    answered = solicitudes.join(granted.withColumn("_done", F.lit(True)), "id_solicitud", "left")
    done = F.coalesce("_done", F.lit(False))
    answers = answered.select(
        "id_solicitud", done.alias("aplicado"), F.when(done, F.col("id_reserva")).alias("id_reserva"),
        F.when(done, F.col("nuevo_inicio")).alias("fecha_hora_inicio"),
        F.when(done, F.col("nuevo_fin")).alias("fecha_hora_fin"), F.when(done, F.lit("PENDIENTE")).alias("estado"))
    return _snapshot(applied), answers


def crear_reserva(reservas: DataFrame, servicios: DataFrame, horarios: DataFrame, bloqueos: DataFrame,
                  solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Admit a batch of booking requests.

    A request needs a service that exists in ``servicios`` (pass the active ones
    to demand that too), an available employee and no overlap with an active
    booking or with a request admitted before it.  Results say why a request
    was refused in ``motivo``.
    """
    known = servicios.select("id_servicio", F.lit(True).alias("_servicio"))
    slots = solicitudes.select("id_solicitud", "id_empleado", "fecha_hora_inicio", "fecha_hora_fin")
    busy = validar_conflicto_horario(reservas, slots).drop("conflictos")
    free = empleado_disponible(horarios, bloqueos, with_day_columns(slots))
    # Admission and answers both read the checks; they are worked out once, and stored without the requests' columns,
    # of which each reader moves the few that it needs.
    asked, offered = solicitudes.count(), known.count()
    checked = materialize(busy.join(sized(free, asked), "id_solicitud"), "dictamenes")
    fit = checked.filter(F.col("disponible") & ~F.col("conflicto")).select("id_solicitud")
    possible = (solicitudes.select("id_servicio", "orden", *slots.columns).join(sized(fit), "id_solicitud")
                .join(sized(known, offered), "id_servicio"))
    admitted = admit_in_order(possible, "id_empleado", "fecha_hora_inicio", "fecha_hora_fin", "orden",
                              "id_solicitud").withColumn("_ok", F.lit(True))
    decided = (solicitudes.join(sized(known, offered), "id_servicio", "left").join(sized(checked, asked), "id_solicitud")
               .join(sized(admitted), "id_solicitud", "left"))
    reason = (F.when(F.col("_servicio").isNull(), "SERVICIO")
              .when(~F.coalesce("disponible", F.lit(False)), "DISPONIBILIDAD")
              .when(F.coalesce("conflicto", F.lit(True)), "CONFLICTO")
              .when(F.col("_ok").isNull(), "SOLICITUD_ANTERIOR"))
    new_id = F.concat(F.lit("N-"), "id_solicitud")
    answered = decided.select("id_solicitud", "fecha_hora_inicio", new_id.alias("_nuevo"), reason.alias("motivo"))
    # A request without a reason is one that is admitted and whose service exists.
    taken = solicitudes.join(sized(admitted), "id_solicitud").join(sized(known, offered), "id_servicio")
    inserted = with_defaults(taken.select(*solicitudes.columns).withColumns(
        {"id_reserva": new_id, "estado": F.lit("PENDIENTE")}), "reserva", as_of)
    made = F.col("motivo").isNull()
    results = answered.select("id_solicitud", made.alias("aplicado"), "motivo",
                              F.when(made, F.col("_nuevo")).alias("id_reserva"),
                              F.when(made, F.col("fecha_hora_inicio")).alias("fecha_hora_inicio"))
    return reservas.unionByName(inserted), results


# update maintenance and audit -----------------------------------------------

def mantener_sellos(antes: DataFrame, despues: DataFrame, key: str, as_of: Instant = None) -> DataFrame:
    """Stamp updated rows: new images in ``despues`` of rows in ``antes``.

    Sets ``updated_at``; a booking that enters CANCELADA also gets
    ``fecha_cancelacion``, and one that leaves it keeps the old stamp.
    """
    now = instant(as_of)
    if "fecha_cancelacion" not in despues.columns:
        updated = despues.join(antes.select(key), key, "left_semi")
        return updated.withColumn("updated_at", now).select(*despues.columns)
    joined = despues.join(antes.select(key, F.col("estado").alias("_old")), key)
    enters = (F.col("_old") != "CANCELADA") & (F.col("estado") == "CANCELADA")
    return joined.withColumns({
        "fecha_cancelacion": F.when(enters, now).otherwise(F.col("fecha_cancelacion")),
        "updated_at": now}).select(*despues.columns)


SENSIBLES = ("password_hash", "email", "estado")  # fixed value: audited account columns


def sensitive_change(before: str = "antes", after: str = "despues") -> Column:
    """Does a row with both images differ in an audited column (NULL-safe)?"""
    changed = F.lit(False)
    for name in SENSIBLES:
        changed = changed | ~F.col(f"{before}.{name}").eqNullSafe(F.col(f"{after}.{name}"))
    return changed


def audit_rows(images: DataFrame, as_of: Column, modificado_por: Column | None = None) -> DataFrame:
    """Audit rows of account updates given as two struct columns ``antes`` and ``despues``."""
    json = {"ignoreNullFields": "false"}
    who = F.lit(None).cast("string") if modificado_por is None else modificado_por
    key = F.col("despues.id_usuario")
    return images.filter(sensitive_change()).select(
        F.sha2(F.concat_ws("|", F.lit("usuario"), key, as_of.cast("string"), F.to_json("despues", json)), 256)
        .alias("id_registro"),
        F.lit("usuario").alias("nombre_tabla"), key.alias("id_registro_afectado"), F.lit("UPDATE").alias("operacion"),
        who.alias("modificado_por"), as_of.alias("fecha_modificacion"),
        F.to_json("antes", json).alias("valores_anteriores"), F.to_json("despues", json).alias("valores_nuevos"),
        F.lit(None).cast("string").alias("direccion_ip"), F.lit(None).cast("string").alias("agente_usuario"))


def auditar_cambios_sensibles(antes: DataFrame, despues: DataFrame, as_of: Instant = None,
                              modificado_por: Column | None = None) -> DataFrame:
    """Compare two snapshots of the accounts and write one audit row per sensitive change."""
    old = antes.select("id_usuario", F.struct(*antes.columns).alias("antes"))
    new = despues.select("id_usuario", F.struct(*despues.columns).alias("despues"))
    return audit_rows(old.join(new, "id_usuario"), instant(as_of), modificado_por)


# accounts -------------------------------------------------------------------

def verificar_email(usuarios: DataFrame, tokens_antes: DataFrame, tokens_despues: DataFrame,
                    as_of: Instant = None) -> Changed:
    """Accounts whose verification token went from unused to used become verified.

    The result frame lists the accounts, one row each.
    """
    spent = (tokens_despues.filter("usado").select("id_token", "id_usuario")
             .join(tokens_antes.filter(~F.col("usado")).select("id_token"), "id_token", "left_semi"))
    accounts = spent.select("id_usuario").distinct()
    flagged = usuarios.join(accounts.withColumn("_hit", F.lit(True)), "id_usuario", "left")
    now = instant(as_of)
    snapshot = flagged.withColumns({
        "email_verificado": F.col("email_verificado") | F.col("_hit").isNotNull(),
        "updated_at": F.when(F.col("_hit"), now).otherwise(F.col("updated_at"))}).select(*usuarios.columns)
    return snapshot, accounts


def bloquear_usuario_por_intentos(usuarios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Lock accounts for ``horas`` (24 where NULL or absent)."""
    asked = solicitudes if "horas" in solicitudes.columns else solicitudes.withColumn("horas", F.lit(HORAS_BLOQUEO))
    until = instant(as_of) + F.make_dt_interval(F.lit(0), F.coalesce("_horas", F.lit(HORAS_BLOQUEO)))
    return overwrite(usuarios, asked, ["id_usuario"], {"bloqueado_hasta": until, "estado": F.lit("BLOQUEADO")},
                     as_of, ["bloqueado_hasta", "estado"], ["horas"])


def bloquear_usuario(usuarios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Set (hasta, nuevo_estado) as requested."""
    return overwrite(usuarios, solicitudes, ["id_usuario"],
                     {"bloqueado_hasta": F.col("_hasta"), "estado": F.col("_nuevo_estado")}, as_of,
                     ["bloqueado_hasta", "estado"], ["hasta", "nuevo_estado"])


def actualizar_intentos_fallidos(usuarios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Set the failure counter to ``intentos``."""
    return overwrite(usuarios, solicitudes, ["id_usuario"], {"intentos_fallidos": F.col("_intentos")}, as_of,
                     ["intentos_fallidos"], ["intentos"])


def fallos_consecutivos(intentos: DataFrame, as_of: Instant = None) -> DataFrame:
    """Failures of each user since the last success up to ``as_of``: (id_usuario, intentos).

    The log is reduced to days first; only the day of the last success is read
    row by row.
    """
    log = intentos.filter(F.col("fecha_hora") <= instant(as_of)).select(
        "id_usuario", "fecha_hora", "exitoso", F.to_date("fecha_hora").alias("_dia"))
    daily = log.groupBy("id_usuario", "_dia").agg(
        F.count_if(~F.col("exitoso")).alias("_fallos"),
        F.max(F.when(F.col("exitoso"), F.col("fecha_hora"))).alias("_exito"))
    last = daily.groupBy("id_usuario").agg(F.max("_exito").alias("_ultimo"))
    later = daily.join(last, "id_usuario").filter(
        F.col("_ultimo").isNull() | (F.col("_dia") > F.to_date("_ultimo"))).select("id_usuario", "_fallos")
    split_day = last.filter(F.col("_ultimo").isNotNull()).withColumn("_dia", F.to_date("_ultimo"))
    tail = (log.filter(~F.col("exitoso")).join(split_day, ["id_usuario", "_dia"])
            .filter(F.col("fecha_hora") > F.col("_ultimo")).groupBy("id_usuario").agg(F.count("*").alias("_fallos")))
    total = later.unionByName(tail).groupBy("id_usuario").agg(F.sum("_fallos").alias("_n"))
    return last.join(total, "id_usuario", "left").select(
        "id_usuario", F.coalesce("_n", F.lit(0)).cast("int").alias("intentos"))


def resetear_intentos_fallidos(usuarios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Clear counter and lock and make the account ACTIVO, also from SUSPENDIDO."""
    sets = {"intentos_fallidos": F.lit(0), "bloqueado_hasta": F.lit(None), "estado": F.lit("ACTIVO")}
    return overwrite(usuarios, solicitudes, ["id_usuario"], sets, as_of,
                     ["intentos_fallidos", "bloqueado_hasta", "estado"])


# retention ------------------------------------------------------------------

def limpiar_tokens_expirados(refresh: DataFrame, as_of: Instant = None) -> Changed:
    """Drop expired refresh tokens that were not revoked: (kept, removed); rows a NULL leaves undecided are kept."""
    gone = F.coalesce((F.col("fecha_expiracion") < instant(as_of)) & ~F.col("revocado"), F.lit(False))
    return refresh.filter(~gone), refresh.filter(gone)


def limpiar_datos_expirados(refresh: DataFrame, reset: DataFrame, verification: DataFrame, intentos: DataFrame,
                            as_of: Instant = None, dias: int = DIAS_RETENCION) -> tuple[dict, DataFrame]:
    """Purge expired or used tokens and old login attempts.

    Returns the kept tables by name and one row per table with the number of
    rows removed.  Rows stamped after ``as_of``, and rows a NULL leaves
    undecided, are kept and not counted.
    """
    now = instant(as_of)
    expired = F.col("fecha_expiracion") < now
    rules = {
        "token_refresh": (refresh, expired),
        "token_reset_password": (reset, expired | F.col("usado")),
        "email_verification_token": (verification, expired | F.col("usado")),
        "intento_login": (intentos, F.col("fecha_hora") < shifted(now, days=-dias)),
    }
    kept, counts = {}, None
    for name, (rows, gone) in rules.items():
        removed = F.coalesce(gone & (F.col(TABLES[name].created) <= now), F.lit(False))
        kept[name] = rows.filter(~removed)
        count = rows.agg(F.count_if(removed).alias("eliminadas")).select(F.lit(name).alias("tabla"), "eliminadas")
        counts = count if counts is None else counts.unionByName(count)
    return kept, counts


# catalogue and staff --------------------------------------------------------

def _switch(table: DataFrame, requests: DataFrame, key: str, active: bool, as_of: Instant) -> Changed:
    flag = F.col("activo")
    return transition(table, requests, [key], ~flag if active else flag, {"activo": F.lit(active)}, as_of,
                      [key, "activo", "updated_at"])


def desactivar_servicio(servicios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    return _switch(servicios, solicitudes, "id_servicio", False, as_of)


def activar_servicio(servicios: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    return _switch(servicios, solicitudes, "id_servicio", True, as_of)


def desactivar_empleado(empleados: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    return _switch(empleados, solicitudes, "id_empleado", False, as_of)


def activar_empleado(empleados: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    return _switch(empleados, solicitudes, "id_empleado", True, as_of)


def asignar_servicio(asignaciones: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Insert an active assignment per request, also when the pair already exists."""
    new = solicitudes.withColumn("id_empleado_servicio", F.concat(F.lit("N-"), "id_solicitud"))
    rows = with_defaults(new.select("id_empleado_servicio", "id_empleado", "id_servicio"), "empleado_servicio", as_of)
    answers = new.select("id_solicitud", F.lit(True).alias("aplicado"), "id_empleado_servicio")
    return asignaciones.unionByName(rows), answers


def remover_servicio(asignaciones: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Switch off every active assignment of the pair."""
    applied = _apply(asignaciones, solicitudes, ["id_empleado", "id_servicio"], {"activo": F.lit(False)}, as_of,
                     F.col("activo"))
    once = applied.filter("_hit").select("_hit", "_id_solicitud").distinct()
    return _snapshot(applied), _answers(once, solicitudes, [])


def crear_bloqueo(bloqueos: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    """Insert an active block per request; ``tipo_bloqueo`` defaults to RESERVA."""
    new = solicitudes.withColumn("id_bloqueo", F.concat(F.lit("N-"), "id_solicitud"))
    columns = ["id_bloqueo", "id_empleado", "id_reserva", "fecha", "hora_inicio", "hora_fin", "tipo_bloqueo"]
    rows = with_defaults(new.select(*(c for c in columns if c in new.columns)), "bloqueo_horario", as_of)
    answers = new.select("id_solicitud", F.lit(True).alias("aplicado"), "id_bloqueo")
    return bloqueos.unionByName(rows), answers


def bloqueos_de_reservas(reservas: DataFrame) -> DataFrame:
    """Block requests for confirmed bookings, one per day a booking touches."""
    start, end = F.col("fecha_hora_inicio"), F.col("fecha_hora_fin")
    last_instant = shifted(end, secs=-1)
    days = F.explode(F.sequence(F.to_date(start), F.to_date(last_instant)))
    rows = reservas.filter(F.col("estado") == "CONFIRMADA").select("*", days.alias("fecha"))
    first, last = F.col("fecha") == F.to_date(start), F.col("fecha") == F.to_date(last_instant)
    closes = F.when(last & (F.to_date(end) == F.col("fecha")), minute_of_day(end, up=True)).otherwise(1440)
    return rows.select(
        F.concat_ws("-", F.lit("B"), "id_reserva", F.col("fecha").cast("string")).alias("id_solicitud"),
        "id_empleado", "id_reserva", "fecha", F.when(first, minute_of_day(start)).otherwise(0).alias("hora_inicio"),
        closes.alias("hora_fin"))


def eliminar_bloqueo(bloqueos: DataFrame, solicitudes: DataFrame, as_of: Instant = None) -> Changed:
    return _switch(bloqueos, solicitudes, "id_bloqueo", False, as_of)


def update_fields(table: DataFrame, solicitudes: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  as_of: Instant = None) -> Changed:
    """Set ``columns`` to the request's values where key and owner match.

    Requests name the new values as the columns with suffix ``_nuevo``.
    """
    args = [f"{c}_nuevo" for c in columns]
    sets = {c: F.col(f"_{c}_nuevo") for c in columns}
    return overwrite(table, solicitudes, keys, sets, as_of, [*keys, *columns, "updated_at"], args)


# deletion -------------------------------------------------------------------

def delete_cascade(tables: dict[str, DataFrame], table: str, ids: DataFrame, as_of: Instant = None) -> dict:
    """Remove rows by key with everything that hangs on them.

    Children whose reference may be NULL keep their row and lose the
    reference.  ``ids`` has one column; returns every table of ``tables``.
    """
    result = dict(tables)
    doomed = {table: ids.select(F.col(ids.columns[0]).alias("_gone")).distinct()}
    queue = [table]
    while queue:
        parent = queue.pop(0)
        key = TABLES[parent].key
        gone = doomed[parent]
        result[parent] = result[parent].join(gone, F.col(key) == F.col("_gone"), "left_anti")
        for name, spec in TABLES.items():
            for column in (c for c, p in spec.parents.items() if p == parent and name in result):
                if next(c for c in spec.columns if c.name == column).nullable:
                    result[name] = _forget(result[name], column, gone, as_of)
                elif not any(name in t.parents.values() for t in TABLES.values()):
                    result[name] = result[name].join(gone, F.col(column) == F.col("_gone"), "left_anti")
                elif name not in doomed:
                    children = tables[name].join(gone, F.col(column) == F.col("_gone"), "left_semi")
                    doomed[name] = children.select(F.col(spec.key).alias("_gone"))
                    queue.append(name)
    return result


def _forget(rows: DataFrame, column: str, gone: DataFrame, as_of: Instant) -> DataFrame:
    marked = rows.join(gone, F.col(column) == F.col("_gone"), "left")
    lost = F.col("_gone").isNotNull()
    return marked.withColumns({
        column: F.when(~lost, F.col(column)),
        "updated_at": F.when(lost, instant(as_of)).otherwise(F.col("updated_at"))}).select(*rows.columns)
