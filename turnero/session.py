"""Session settings and the shared folder that survives executor loss."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Runtime settings the operators rely on; all can be overridden by the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "turnero", master: str | None = None, **settings: str) -> SparkSession:
    """Create or reuse a session; ``settings`` use ``_`` for ``.`` in names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty location for written tables, under ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary
    folder; on a cluster a machine-local folder would be lost with its node.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="turnero-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back.

    For a result that several branches of one plan use: they share the files
    instead of computing it again, and a lost executor costs no recomputation.
    """
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Rows that a join sends to every task, at most.
FEW = 200_000


def sized(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows`` as the right side of a join: sent to every task if they are few, else met by key.

    Spark's own check goes by the bytes of compressed files, however many rows
    follow from them, and what it sends passes through the driver.  ``most`` is
    a number of rows that they do not exceed; without it they are counted.
    """
    return F.broadcast(rows) if (rows.count() if most is None else most) <= FEW else rows.hint("merge")


_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def stored_once(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from ``source``, written by its first user and read by the rest.

    Kept per application, in the shared folder.
    """
    key = (spark.sparkContext.applicationId, source, name)
    if key not in _STORED:
        path, rows = shared_dir(spark, name), build()
        rows.write.parquet(path)
        _STORED[key] = path, rows.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)
