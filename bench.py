"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the local cores.  Every query is planned and fully computed into
the no-op sink, so no column is pruned away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from turnero.plans import queries
from turnero.session import build_session

HEADLINE = (
    "l9_reservas_activas",
    "l12_reservas_proximas",
    "l15_historial_cliente",
    "j1_usuario_completo",
    "j3_tokens_activos",
    "j7_bloqueos_futuros",
    "j10_validar_conflicto_horario",
    "j11_conflictos_existentes",
    "j12_empleado_disponible",
    "a1_estadisticas_servicios_proveedor",
    "a2_estadisticas_reservas_proveedor",
    "a3_estadisticas_global_con_tasa",
    "a4_estadisticas_proveedor_rango",
    "a5_intentos_fallidos_recientes",
    "a7_empleados_activos_por_proveedor",
    "c1_confirmar_reserva_tabla",
    "c2_cancelar_reserva_tabla",
    "c4_crear_reserva",
    "c13_limpiar_datos_expirados",
    "v2_check_unique",
    "v7_check_overlaps",
    "r11_visible_reserva",
    "r12_check_changes_reserva",
    "r14_access_matrix",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark_sql_shuffle_partitions": cpus, "spark_ui_enabled": "false", "spark_driver_memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    # Start-up costs (class loading, first scan) belong to no query.
    queries.build("a2_estadisticas_reservas_proveedor")(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        begin = time.perf_counter()
        queries.build(name)(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
