"""Row visibility: one principal, the grants relation and the matrix agree with the policies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from turnero.operators import visibility as v

PEOPLE = [
    v.Principal("A", "admin", "ADMIN"), v.Principal("S", "soporte"), v.Principal("Q", "security"),
    v.Principal("V", "service_account"), v.Principal("c1", None, "CLIENTE"), v.Principal("p1", None, "PROVEEDOR"),
    v.Principal(),
]


@pytest.fixture(scope="module")
def tables(make):
    return {
        "usuario": make("usuario", [{"id_usuario": u} for u in ("A", "c1", "p1")]),
        "token_refresh": make("token_refresh", [{"id_token": "t", "id_usuario": "A"}]),
        "intento_login": make("intento_login", [{"id_intento": "l", "id_usuario": "c1"}]),
        "servicio": make("servicio", [{"id_servicio": "on", "id_proveedor": "p1"},
                                      {"id_servicio": "off", "id_proveedor": "p1", "activo": False},
                                      {"id_servicio": "other", "id_proveedor": "p2", "activo": False}]),
        "empleado": make("empleado", [{"id_empleado": "e1", "id_proveedor": "p1"},
                                      {"id_empleado": "e2", "id_proveedor": "p2"}]),
        "horario_laboral": make("horario_laboral", [{"id_horario": "h1", "id_empleado": "e1"},
                                                    {"id_horario": "h2", "id_empleado": "e2"}]),
        "reserva": make("reserva", [{"id_reserva": "r1", "id_cliente": "c1", "id_proveedor": "p1"},
                                    {"id_reserva": "r2", "id_cliente": "c2", "id_proveedor": "p1"},
                                    {"id_reserva": "r3", "id_cliente": "p1", "id_proveedor": "p1"}]),
    }


# rows each principal of PEOPLE may read
TRUTH = {
    "usuario": ["A c1 p1", "", "", "A c1 p1", "c1", "p1", ""],
    "token_refresh": ["t", "", "", "t", "", "", ""],
    "intento_login": ["l", "", "l", "l", "l", "", ""],
    "servicio": ["off on other", "off on other", "on", "off on other", "on", "off on", "on"],
    "empleado": ["e1 e2", "e1 e2", "", "e1 e2", "", "e1", ""],
    "horario_laboral": ["h1 h2", "h1 h2", "", "h1 h2", "", "h1", ""],
    "reserva": ["r1 r2 r3", "r1 r2 r3", "", "r1 r2 r3", "r1", "r1 r2 r3", ""],
}


def test_single_principal(tables):
    for name, expected in TRUTH.items():
        key = v.TABLES[name].key
        for who, want in zip(PEOPLE, expected):
            seen = v.visible_to(tables[name], name, who, tables["empleado"]).collect()
            assert " ".join(sorted(r[key] for r in seen)) == want, (name, who)


def test_grants_expand_to_the_same_rows(tables):
    for name, expected in TRUTH.items():
        pairs = [tuple(r) for r in v.grants(tables[name], name, tables["empleado"]).collect()]
        assert len(pairs) == len(set(pairs))
        for who, want in zip(PEOPLE, expected):
            held = {("publico", "*"), ("rol", who.role), ("propio", who.uid)}
            seen = {i for _, i, scope, grantee in pairs if (scope, grantee) in held}
            assert " ".join(sorted(seen)) == want, (name, who)


def test_matrix_counts_the_same_rows(spark, tables):
    people = spark.createDataFrame([(p.uid, p.role, p.tipo_usuario) for p in PEOPLE if p.uid],
                                   "uid string, role string, tipo_usuario string")
    counts = {(r.uid, r.tabla): r.visibles for r in v.access_matrix(tables, people).collect()}
    assert counts == {(who.uid, name): len(want.split()) for name, expected in TRUTH.items()
                      for who, want in zip(PEOPLE, expected)}


def test_policy_inventory():
    """One rule per (policy, command) group that writes; commands nobody may run stay closed."""
    commands = {t: {c for rule in rules for c in rule.commands} for t, rules in v.WRITE_RULES.items()}
    assert commands["registro_auditoria"] == set()
    assert all(commands[t] == {"INSERT", "UPDATE", "DELETE"} for t in commands if t != "registro_auditoria")
    assert set(v.READ_RULES) == set(v.WRITE_RULES) == set(v.TABLES)


def test_changes_of_a_hot_principal_are_not_gathered(spark, make, monkeypatch):
    """Many changes of one principal, anonymous ones and repeated principals: the same answers as without any hot one."""
    staff = make("empleado", [{"id_empleado": "e1", "id_proveedor": "p1"}, {"id_empleado": "e2", "id_proveedor": "p2"}])
    blocks = make("bloqueo_horario", [{"id_bloqueo": f"b{i}", "id_empleado": f"e{i % 3}"} for i in range(12)])
    image = F.struct(*blocks.columns)
    nothing = F.lit(None).cast(blocks.select(image.alias("s")).schema["s"].dataType)
    parts = [blocks.select(F.concat_ws("/", "id_bloqueo", F.lit(f"{u}{c}")).alias("id_cambio"), F.lit(u).cast("string").alias("uid"),
                           F.lit(c).alias("comando"), (nothing if c == "INSERT" else image).alias("antes"), (nothing if c == "DELETE" else image).alias("despues"))
             for u in (None, "A", "p1", "x") for c in ("INSERT", "UPDATE", "DELETE")]
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    people = spark.createDataFrame([("A", "admin", "ADMIN"), ("A", "admin", "ADMIN"), ("p1", None, "PROVEEDOR")], "uid string, role string, tipo_usuario string")

    def answers():
        return sorted(map(tuple, v.check_changes(changes, "bloqueo_horario", people, staff, "2026-06-01").collect()), key=str)

    calm = answers()
    assert len(calm) == 12 * 3 * 5 and any(r[3] for r in calm)
    monkeypatch.setattr(v, "HOT_PRINCIPAL", 4)
    assert answers() == calm
