"""Row visibility and write permission as data operators.

A table's read rule is a small declaration: an optional public flag, the
columns that name an owner, and the roles that see everything.  From it come

* ``visible_to``: the rows one principal sees, a plain filter;
* ``grants``: who may see each row, as (alcance, beneficiario) pairs.  The
  relation stays linear in the rows because "everyone" and "every admin" are
  one pair each and not one row per person;
* ``access_matrix``: visible-row counts of every principal and table, computed
  from totals and owner counts without pairing rows with principals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.functions.clock import Instant, instant, shifted
from turnero.session import materialize
from turnero.sources.schemas import TABLES
from turnero.sources.tables import literal_rows

PARENT_OWNER = "_dueno"  # provider of the row's employee, joined in where needed


@dataclass(frozen=True)
class ReadRule:
    owners: tuple[str, ...] = ()
    roles: tuple[str, ...] = ()
    public: str | None = None

    @property
    def through_employee(self) -> bool:
        return PARENT_OWNER in self.owners


_STAFF = ("admin", "soporte", "service_account")

READ_RULES: dict[str, ReadRule] = {
    "usuario": ReadRule(("id_usuario",), ("admin", "service_account")),
    "cliente": ReadRule(("id_usuario",), _STAFF),
    "proveedor": ReadRule(("id_usuario",), _STAFF),
    "admin": ReadRule((), ("admin", "service_account")),
    "intento_login": ReadRule(("id_usuario",), ("admin", "security", "service_account")),
    "token_refresh": ReadRule(("id_usuario",), ("service_account",)),
    "token_reset_password": ReadRule(("id_usuario",), ("service_account",)),
    "email_verification_token": ReadRule(("id_usuario",), ("service_account",)),
    "registro_auditoria": ReadRule((), ("admin",)),
    "categoria_servicio": ReadRule((), ("admin", "service_account"), "activa"),
    "servicio": ReadRule(("id_proveedor",), _STAFF, "activo"),
    "empleado": ReadRule(("id_proveedor",), _STAFF),
    "empleado_servicio": ReadRule((PARENT_OWNER,), _STAFF),
    "horario_laboral": ReadRule((PARENT_OWNER,), _STAFF),
    "bloqueo_horario": ReadRule((PARENT_OWNER,), _STAFF),
    "reserva": ReadRule(("id_cliente", "id_proveedor"), _STAFF),
}


@dataclass(frozen=True)
class Principal:
    """Who asks.  ``uid`` None is an anonymous visitor."""

    uid: str | None = None
    role: str | None = None
    tipo_usuario: str | None = None


# principals -----------------------------------------------------------------

def principals(auth_users: DataFrame) -> DataFrame:
    """(uid, role, tipo_usuario) from session identities with JSON metadata."""
    meta = F.col("raw_user_meta_data")
    return auth_users.select(F.col("id").alias("uid"), F.get_json_object(meta, "$.role").alias("role"),
                             F.get_json_object(meta, "$.tipo_usuario").alias("tipo_usuario"))


def role_predicates(people: DataFrame) -> DataFrame:
    """The role tests as columns; FALSE, not NULL, where metadata is absent."""
    def holds(column: str, value: str) -> Column:
        return F.coalesce(F.col(column) == value, F.lit(False))

    return people.select(
        F.col("uid").alias("id_usuario_actual"), holds("role", "admin").alias("es_admin"),
        holds("tipo_usuario", "CLIENTE").alias("es_cliente"), holds("tipo_usuario", "PROVEEDOR").alias("es_proveedor"),
        holds("role", "service_account").alias("es_cuenta_servicio"))


# reading --------------------------------------------------------------------

def _with_owner(rows: DataFrame, table: str, empleados: DataFrame | None) -> DataFrame:
    if not READ_RULES[table].through_employee:
        return rows
    owner = empleados.select("id_empleado", F.col("id_proveedor").alias(PARENT_OWNER))
    return rows.join(owner, "id_empleado", "left")


def visible_to(rows: DataFrame, table: str, who: Principal, empleados: DataFrame | None = None) -> DataFrame:
    """The rows of ``table`` that one principal may read."""
    rule = READ_RULES[table]
    if who.role in rule.roles and who.uid is not None:
        return rows
    tests = [F.col(rule.public)] if rule.public else []
    if who.uid is not None:
        tests += [F.col(owner) == who.uid for owner in rule.owners if owner != PARENT_OWNER]
        if rule.through_employee:
            own_staff = empleados.filter(F.col("id_proveedor") == who.uid).select("id_empleado")
            return rows.join(own_staff, "id_empleado", "left_semi")
    allowed = F.lit(False)
    for test in tests:
        allowed = allowed | test
    return rows.filter(allowed)


def grants(rows: DataFrame, table: str, empleados: DataFrame | None = None) -> DataFrame:
    """(tabla, id, alcance, beneficiario): publico/*, rol/<role>, propio/<uid>, each pair once per row."""
    rule = READ_RULES[table]
    pairs = [F.struct(F.lit("rol").alias("alcance"), F.lit(r).alias("beneficiario")) for r in rule.roles]
    if rule.public:
        pairs.append(F.when(F.col(rule.public), F.struct(F.lit("publico").alias("alcance"),
                                                         F.lit("*").alias("beneficiario"))))
    for owner in rule.owners:
        pairs.append(F.when(F.col(owner).isNotNull(),
                            F.struct(F.lit("propio").alias("alcance"), F.col(owner).alias("beneficiario"))))
    owned = _with_owner(rows, table, empleados)
    pair = F.explode(F.array_distinct(F.array_compact(F.array(*pairs)))).alias("_g")
    return owned.select(F.lit(table).alias("tabla"), F.col(TABLES[table].key).alias("id"), pair).select(
        "tabla", "id", "_g.alcance", "_g.beneficiario")


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _counted(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabla, uid, total, publicas, propias), from one pass over each table.

    The row with NULL uid has the table's total and public rows; the others what
    each owner sees beyond the public ones.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def per_row(name: str, rows: DataFrame) -> DataFrame:
        rule = READ_RULES[name]
        public = F.coalesce(F.col(rule.public), F.lit(False)) if rule.public else F.lit(False)
        owners = ["id_empleado"] if rule.through_employee else [o for o in rule.owners if o != PARENT_OWNER]
        total = F.struct(F.lit(None).cast("string").alias("uid"), one.alias("total"),
                         public.cast("long").alias("publicas"), none.alias("propias"))
        counts = F.array(total)
        if owners:
            owned = F.filter(F.array_distinct(F.array(*owners)), lambda o: o.isNotNull() & ~public)
            counts = F.concat(counts, F.transform(owned, lambda o: F.struct(
                o.alias("uid"), none.alias("total"), none.alias("publicas"), one.alias("propias"))))
        return rows.select(F.lit(name).alias("tabla"), F.inline(counts))

    sums = [F.sum(c).alias(c) for c in ("total", "publicas", "propias")]
    counted = _union([per_row(n, rows) for n, rows in tables.items()]).groupBy("tabla", "uid").agg(*sums)
    child = [n for n in tables if READ_RULES[n].through_employee]
    if not child:
        return counted
    # Rows are counted per employee first, so the join meets one row per employee and table.
    staff = tables["empleado"].select(F.col("id_empleado").alias("uid"), F.col("id_proveedor").alias("dueno"))
    through = F.col("tabla").isin(*child) & F.col("uid").isNotNull()
    passed = counted.join(staff, "uid", "left").withColumn("uid", F.when(through, F.col("dueno")).otherwise(F.col("uid")))
    kept = passed.filter((F.col("total") > 0) | F.col("uid").isNotNull())
    return kept.groupBy("tabla", "uid").agg(*sums)


def access_matrix(tables: dict[str, DataFrame], people: DataFrame) -> DataFrame:
    """(uid, tabla, visibles) for every principal, anonymous included as NULL uid."""
    both = materialize(_counted(tables), "matriz")  # read twice below
    counted = both.filter("uid IS NULL").select("tabla", "total", "publicas")
    owned = both.filter("uid IS NOT NULL").select("tabla", "uid", "propias")
    # an empty table still has its row
    names = literal_rows(people.sparkSession, "tabla string", [(name,) for name in tables])
    totals = names.join(counted, "tabla", "left").fillna(0, ["total", "publicas"])
    anonymous = literal_rows(people.sparkSession, "uid string, role string, tipo_usuario string", [(None,) * 3])
    everyone = people.unionByName(anonymous)
    roles = sorted({role for rule in READ_RULES.values() for role in rule.roles})
    seen_by = [(role, F.array(*(F.lit(t) for t in tables if role in READ_RULES[t].roles)).cast("array<string>"))
               for role in roles]
    role_tables = F.create_map(*(item for role, names in seen_by for item in (F.lit(role), names)))
    asked = everyone.select("uid", "role", F.explode(F.array(*(F.lit(t) for t in tables))).alias("tabla"))
    # totals has one row per table, so it is always small enough to broadcast
    joined = asked.join(F.broadcast(totals), "tabla").join(owned, ["tabla", "uid"], "left")
    sees_all = F.coalesce(F.array_contains(F.element_at(role_tables, F.col("role")), F.col("tabla")), F.lit(False))
    seen = F.when(sees_all, F.col("total")).otherwise(F.col("publicas") + F.coalesce("propias", F.lit(0)))
    return joined.select("uid", "tabla", seen.alias("visibles"))


# writing --------------------------------------------------------------------

class Row:
    """Column access for a policy test: an image (or NULL), the principal and the clock."""

    def __init__(self, image: str, now: Column):
        self.image = image
        self.now = now

    def __getitem__(self, name: str) -> Column:
        return F.col(PARENT_OWNER + self.image) if name == PARENT_OWNER else F.col(f"{self.image}.{name}")

    def own(self, column: str) -> Column:
        return self[column] == F.col("uid")

    @staticmethod
    def role(*names: str) -> Column:
        return F.col("_role").isin(*names)

    @staticmethod
    def kind(name: str) -> Column:
        return F.col("_tipo") == name


Test = Callable[[Row], Column]


@dataclass(frozen=True)
class WriteRule:
    """One permissive policy.  ``check`` None means the new image must pass ``using``."""

    name: str
    commands: tuple[str, ...]
    using: Test | None = None
    check: Test | None = None


def _true(_: Row) -> Column:
    return F.lit(True)


def _present(*columns: str) -> Test:
    """A comparison of columns of the new image with themselves: true unless one is NULL."""
    def test(row: Row) -> Column:
        result = F.lit(True)
        for column in columns:
            result = result & (row[column] == row[column])
        return result
    return test


def _role_rule(name: str, commands: tuple[str, ...], *roles: str) -> WriteRule:
    def test(row: Row) -> Column:
        return row.role(*roles)
    return WriteRule(name, commands, test, test)


ALL = ("INSERT", "UPDATE", "DELETE")


def _account_profile(label: str, frozen: tuple[str, ...]) -> WriteRule:
    return WriteRule(label, ("UPDATE",), lambda r: r.own("id_usuario"), _present(*frozen))


def _token_use(label: str, done: str) -> WriteRule:
    return WriteRule(
        label, ("UPDATE",),
        lambda r: r.own("id_usuario") & ~r[done] & (r["fecha_expiracion"] > r.now),
        lambda r: _present("id_usuario")(r) & r[done])


def _through_employee(child: str, insert: bool = True) -> tuple[WriteRule, ...]:
    update = WriteRule(f"{child}_propio_update", ("UPDATE",), lambda r: r.own(PARENT_OWNER) | r.role("admin"),
                       _present("id_empleado"))
    if not insert:
        return (update,)
    return (WriteRule(f"{child}_propio_insert", ("INSERT",), None,
                      lambda r: r.own(PARENT_OWNER) & r.kind("PROVEEDOR")), update)


def _owned_by_provider(table: str) -> tuple[WriteRule, ...]:
    return (
        WriteRule(f"{table}_propio_insert", ("INSERT",), None, lambda r: r.own("id_proveedor") & r.kind("PROVEEDOR")),
        WriteRule(f"{table}_propio_update", ("UPDATE",), lambda r: r.own("id_proveedor") | r.role("admin"),
                  _present("id_proveedor")),
        WriteRule(f"{table}_propio_desactivar", ("UPDATE",), lambda r: r.own("id_proveedor"),
                  lambda r: _present("id_proveedor")(r) & ~r["activo"]),
        _role_rule(f"{table}_admin_delete", ("DELETE",), "admin"),
    )


def _service(table: str) -> WriteRule:
    return _role_rule(f"{table}_service_account", ALL, "service_account")


WRITE_RULES: dict[str, tuple[WriteRule, ...]] = {
    "usuario": (
        WriteRule("usuario_propio_update", ("UPDATE",), lambda r: r.own("id_usuario"),
                  lambda r: r.own("id_usuario") & _present("email", "tipo_usuario", "fecha_registro")(r)),
        _role_rule("usuario_admin", ("INSERT", "DELETE"), "admin"),
        _service("usuario"),
    ),
    "cliente": (
        _account_profile("cliente_propio_update", ("id_usuario",)),
        _role_rule("cliente_backend_insert", ("INSERT",), "admin", "service_account"),
        _service("cliente"),
    ),
    "proveedor": (
        _account_profile("proveedor_propio_update", ("id_usuario", "id_categoria")),
        WriteRule("proveedor_admin_update", ("UPDATE",), lambda r: r.role("admin"), _true),
        _service("proveedor"),
    ),
    "admin": (_role_rule("admin_admin", ALL, "admin"), _service("admin")),
    "token_refresh": (
        WriteRule("token_refresh_insert", ("INSERT",), None, _true),
        WriteRule("token_refresh_revocar", ("UPDATE",), lambda r: r.own("id_usuario"),
                  lambda r: _present("id_usuario")(r) & r["revocado"]),
        WriteRule("token_refresh_expirado", ("DELETE",), lambda r: (r["fecha_expiracion"] < r.now) | r["revocado"]),
        _service("token_refresh"),
    ),
    "token_reset_password": (
        WriteRule("token_reset_password_insert", ("INSERT",), None, _true),
        _token_use("token_reset_password_usar", "usado"),
        _service("token_reset_password"),
    ),
    "email_verification_token": (
        WriteRule("email_verification_token_insert", ("INSERT",), None, _true),
        _token_use("email_verification_token_usar", "usado"),
        _service("email_verification_token"),
    ),
    "intento_login": (
        WriteRule("intento_login_insert", ("INSERT",), None, _true),
        WriteRule("intento_login_antiguo", ("DELETE",), lambda r: r["fecha_hora"] < shifted(r.now, days=-90)),
        _service("intento_login"),
    ),
    "registro_auditoria": (),
    "categoria_servicio": (_role_rule("categoria_admin", ALL, "admin"), _service("categoria_servicio")),
    "servicio": (*_owned_by_provider("servicio"), _service("servicio")),
    "empleado": (*_owned_by_provider("empleado"), _service("empleado")),
    "empleado_servicio": (*_through_employee("empleado_servicio"), _service("empleado_servicio")),
    "horario_laboral": (*_through_employee("horario_laboral"), _service("horario_laboral")),
    "bloqueo_horario": (
        WriteRule("bloqueo_horario_insert", ("INSERT",), None, _true),
        *_through_employee("bloqueo_horario", insert=False),
        _service("bloqueo_horario"),
    ),
    "reserva": (
        WriteRule("reserva_cliente_insert", ("INSERT",), None, lambda r: r.own("id_cliente") & r.kind("CLIENTE")),
        WriteRule("reserva_cliente_update", ("UPDATE",), lambda r: r.own("id_cliente"),
                  lambda r: _present("id_cliente")(r) & r["estado"].isin("CANCELADA", "NO_SHOW")),
        WriteRule("reserva_proveedor_update", ("UPDATE",), lambda r: r.own("id_proveedor") | r.role("admin"),
                  _present("id_proveedor")),
        _role_rule("reserva_admin_delete", ("DELETE",), "admin"),
        _service("reserva"),
    ),
}

# Columns that the written policy says an owner cannot change, although the
# rules above compare them only with themselves.
DOCUMENTED_FROZEN: dict[str, tuple[str, ...]] = {
    "usuario": ("email", "tipo_usuario", "fecha_registro"),
    "cliente": ("id_usuario",),
    "proveedor": ("id_usuario", "id_categoria"),
    "token_refresh": ("id_usuario",),
    "token_reset_password": ("id_usuario",),
    "email_verification_token": ("id_usuario",),
    "servicio": ("id_proveedor",),
    "empleado": ("id_proveedor",),
    "empleado_servicio": ("id_empleado",),
    "horario_laboral": ("id_empleado",),
    "bloqueo_horario": ("id_empleado",),
    "reserva": ("id_proveedor", "id_cliente"),
}


def _any(tests: list[Column]) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | F.coalesce(test, F.lit(False))
    return result


def _readable(table: str, row: Row) -> Column:
    rule = READ_RULES[table]
    tests = [row.role(*rule.roles), *(row.own(owner) for owner in rule.owners)]
    return _any([*tests, *([row[rule.public]] if rule.public else [])])


#: A principal with more changes than this is looked up apart from the others.
HOT_PRINCIPAL = 100_000


def _with_roles(changes: DataFrame, people: DataFrame) -> DataFrame:
    """``changes`` with the role and type of their principal.

    Anonymous changes and those of a principal that makes very many stay where
    they are; only the others move to meet their principals, so no task gets
    all the changes of one.
    """
    roles = people.select("uid", F.col("role").alias("_role"), F.col("tipo_usuario").alias("_tipo"))
    # one principal in HOT_PRINCIPAL changes at most, so always small enough to broadcast
    hot = changes.groupBy("uid").agg(F.count("*").alias("_n")).filter(F.col("uid").isNotNull() & (F.col("_n") > HOT_PRINCIPAL))
    known = F.broadcast(hot.select("uid").join(roles, "uid", "left").withColumn("_hot", F.lit(True)))
    marked = changes.join(known, "uid", "left")
    apart = F.col("_hot").isNotNull() | F.col("uid").isNull()
    others = marked.filter(~apart).drop("_hot", "_role", "_tipo").join(roles, "uid", "left")
    return marked.filter(apart).drop("_hot").unionByName(others)


def check_changes(changes: DataFrame, table: str, people: DataFrame, empleados: DataFrame | None = None,
                  as_of: Instant = None) -> DataFrame:
    """Split a change batch into allowed and denied.

    ``changes``: id_cambio, uid, comando, and the images ``antes`` and
    ``despues`` as structs of the table (NULL where the command has none).
    The old image must pass the USING side of one policy of the command and
    the new image the CHECK side of one; an UPDATE or DELETE that reads rows
    must also be able to see them.  ``doc_gap`` marks changes that are allowed
    although the written policy says otherwise.
    """
    rules, now = WRITE_RULES[table], instant(as_of)
    rows = _with_roles(changes, people)
    if READ_RULES[table].through_employee:
        for image in ("antes", "despues"):
            owner = empleados.select(F.col("id_empleado").alias("_e"),
                                     F.col("id_proveedor").alias(PARENT_OWNER + image))
            # Changes without this image get a key of their own, so they spread over tasks.
            nobody = F.concat(F.lit("\0"), F.xxhash64("id_cambio").cast("string"))
            rows = rows.join(owner, F.coalesce(F.col(f"{image}.id_empleado"), nobody) == F.col("_e"), "left").drop("_e")
    old, new = Row("antes", now), Row("despues", now)

    def using(command: str) -> Column:
        return _any([r.using(old) for r in rules if command in r.commands and r.using])

    def check(command: str) -> Column:
        return _any([(r.check or r.using)(new) for r in rules if command in r.commands])

    update = using("UPDATE") & check("UPDATE") & _readable(table, old) & _readable(table, new)
    allowed = (F.when(F.col("comando") == "INSERT", check("INSERT"))
               .when(F.col("comando") == "UPDATE", update)
               .when(F.col("comando") == "DELETE", using("DELETE") & _readable(table, old))
               .otherwise(False))
    moved = F.lit(False)
    for column in DOCUMENTED_FROZEN.get(table, ()):
        moved = moved | ~old[column].eqNullSafe(new[column])
    if table == "reserva":
        # The written policy lets a client only cancel or mark a no-show.
        as_client = old.own("id_cliente") & ~F.coalesce(old.own("id_proveedor"), F.lit(False))
        moved = moved | (as_client & ~new["estado"].isin("CANCELADA", "NO_SHOW"))
    plain = ~F.coalesce(F.col("_role").isin("admin", "service_account"), F.lit(False))
    gap = allowed & (F.col("comando") == "UPDATE") & plain & F.coalesce(moved, F.lit(False))
    return rows.select("id_cambio", "uid", "comando", allowed.alias("permitido"), gap.alias("doc_gap"))
