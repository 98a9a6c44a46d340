"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnero.session import shared_dir

# The tables' columns that the operators read, with the types they are read as.
COLUMNS = {
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>"},
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of a folder, one file or a folder of part files."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs no recomputation of what is stored.
    """
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def numbered(rows: DataFrame, by: list[str], order: list[Column], spread: Column, out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, into column ``out``.

    One group may hold any share of the rows, so no window covers a group.
    ``spread`` cuts every group into parts of bounded number (a short text or
    number computed from the row); a window numbers a part, and the parts'
    counts, added up in order, say where it begins.  The order is
    (``spread``, ``order``).
    """
    part = "_part"
    cut = rows.withColumn(part, spread)
    keys = [*by, part]
    sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*(F.col(k).alias(f"_k_{k}") for k in keys), before.alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    numbers = cut.withColumn("_within", within)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return (numbers.join(starts, same, "left")
            .withColumn(out, (F.col("_before") + F.col("_within")).cast("bigint"))
            .select(*rows.columns, out))
