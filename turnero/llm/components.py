"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnero.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Alternates two steps until the edges stay as they are: every node links its
    larger neighbours to the smallest node it sees, then its smaller neighbours
    and itself.  Each step is an aggregate with map-side combine and one inner
    join that Spark can split when one node has very many edges.  Each round is
    written to the shared folder.  Edges with a null end and loops are ignored;
    no edges give no rows.
    """
    larger = F.greatest(a, b)
    now = stored(edges.where((F.col(a) != F.col(b))).select(larger.alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (both.join(low, F.col("a") == F.col("n")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = (large.join(low, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        now = stored(small, "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
