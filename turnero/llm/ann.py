"""Nearest neighbours by inner product: inverted lists and an adaptive dimension scan.

Vectors are assigned to the nearest of a bounded number of centroids.  A query
probes the lists of its best centroids.  In a list the vectors are rotated by a
fixed random rotation and stand in blocks of columns.  After each block a test
asks whether a candidate can still enter the query's best: by rotation, the
partial distance over d of D columns, scaled by D / d, strays from the true one
by no more than a factor 1 + c / sqrt(d) but with tiny probability, so a
candidate beyond that bound is given up and its other blocks are never read.
The queries of a list read a block together, as one product of matrices, until
few candidates are alive.
Inner products become distances through the lengths: |q - x|^2 = |q|^2 + |x|^2
- 2 q.x, so "better than t" is "nearer than sqrt(|q|^2 + |x|^2 - 2 t)".

A query's lists are looked through in steps, the best first, each step a few
times as many lists as all before it.  What a step finds gives the bound that the
next one faces, and only what reaches the bound leaves a task: about the asked
number a step, not a number for each list.

Equal vectors are one vector from the start, with their smallest ids; no more
than the asked number plus one of them can ever be returned.  Long lists are
cut into chunks, which are searched by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored

#: Vectors on which centroids are fitted, at most; lists, at most.
SAMPLE, LISTS = 16_384, 4096
#: Vectors of a list, on average, while there are fewer than LISTS lists.
PER_LIST = 1024
#: Share of the lists that a query probes, and lists at least.  Measured on evenly spread unit vectors of
#: 64 columns, the hardest case: 0.5 finds about 0.9 of the true neighbours, 0.65 about 0.95.
PROBED, PROBES = 0.65, 8
#: Lists of a query's first step; lists of all steps up to one, for each list of the steps before it.
FIRST, WIDER = 2, 4
#: Columns of a block; strictness of the test; vectors of a chunk; queries that search a chunk together.
BLOCK, STRICT, CHUNK, TOGETHER = 16, 2.6, 4096, 2048
#: Pairs of queries and vectors that are scanned at a time; share of them alive below which they go on one by one.
PAIRS, ALIVE = 1 << 18, 0.1
SEED = 7


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids_of(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from a fixed random start."""
    rng = np.random.default_rng(SEED)
    centers = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        near = nearest(sample, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers ** 2).sum(axis=1) - 2 * rows @ centers.T, axis=1)


def scan(queries: np.ndarray, blocks: list[np.ndarray], partial_sq: list[np.ndarray], keep: int, at_least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of the candidates that may be among a query's best ``keep``, by rotated column blocks.

    ``blocks[b]`` has the b-th columns of all candidates, ``partial_sq[b]`` the
    squared length over the columns up to block b.  The first few candidates
    are read whole; they and ``at_least`` give the bounds that the others face.
    The queries pass a block together while most candidates are alive, pair by
    pair after that.  Pairs come query by query.
    """
    n, dims, lengths = len(blocks[0]), queries.shape[1], partial_sq[-1]
    first = min(n, 4 * keep)
    start = queries @ np.hstack([b[:first] for b in blocks]).T
    bound = np.maximum(at_least, np.partition(start, first - keep, axis=1)[:, first - keep] if first > keep else -np.inf)
    whole = (queries ** 2).sum(axis=1)
    rows, places = np.repeat(np.arange(len(queries)), first), np.tile(np.arange(first), len(queries))
    if n == first:
        return rows, places
    product, row, place, at = np.zeros((len(queries), n - first)), None, None, 0
    for b, block in enumerate(blocks):
        columns = queries[:, at:at + block.shape[1]]
        product += columns @ block[first:].T if row is None else np.einsum("ij,ij->i", columns[row], block[place])
        at += block.shape[1]
        if at < dims:
            # partial distance * sqrt(dims / at) <= (1 + STRICT / sqrt(at)) * reach, squared and solved for the product
            reach = (1 + STRICT / np.sqrt(at)) ** 2 * at / dims
            of_query = ((queries[:, :at] ** 2).sum(axis=1) - reach * (whole - 2 * bound)) / 2 - 1e-9 * whole
            of_place = (partial_sq[b] - reach * lengths) / 2 - 1e-9 * lengths
            if row is None:
                stay = product >= of_query[:, None] + of_place[first:]
                if np.count_nonzero(stay) < ALIVE * stay.size:
                    row, place = np.nonzero(stay)
                    product, place = product[stay], place + first
            else:
                stay = product >= of_query[row] + of_place[place]
                product, row, place = product[stay], row[stay], place[stay]
    low = bound - 1e-6 * (1 + np.abs(bound))
    if row is None:
        row, place = np.nonzero(product >= low[:, None])
        place = place + first
    else:
        stay = product >= low[row]
        row, place = row[stay], place[stay]
    rows, places = np.concatenate((rows, row)), np.concatenate((places, place))
    order = np.argsort(rows, kind="stable")
    return rows[order], places[order]


def edges_of(rows: np.ndarray, scores: np.ndarray, keep: int, low: np.ndarray) -> np.ndarray:
    """What a score must reach in each row to be among the row's best ``keep``: ``low`` at least; ``rows`` ascend."""
    order = np.lexsort((-scores, rows))
    counts = np.bincount(rows, minlength=len(low))
    full = np.flatnonzero(counts >= keep)
    out = low.copy()
    out[full] = np.maximum(out[full], scores[order][(np.cumsum(counts) - counts)[full] + keep - 1])
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part: an id, and a vector of the commonest length, finite and not all zero."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<float>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()
                      & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.where(F.size("v") == F.lit(common["n"] if common else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", probed: float = PROBED) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query row its ``k`` nearest other rows found.

    Null, zero or non-finite vectors, those holding nulls, those of another
    length than most, and rows without an id take no part.  Repeated rows count
    once.  Ties go to the smaller id.  With fewer than k + 1 rows all are
    returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    rows = usable(vectors, key, vector).withColumn("c", F.xxhash64("v", F.reverse("v")))  # the vector's class
    first = Window.partitionBy("c").orderBy("id")
    few = rows.select("id", "c", "v").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = stored(few.groupBy("c").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")), "vectors")  # k + 1 ids at most
    total = classes.count()
    if total == 0:
        return spark.createDataFrame([], empty)
    asking_rows = rows.withColumnRenamed("id", key).where(is_query).select(F.col(key).alias("id"), "c")
    queries = stored(asking_rows.distinct(), "query-ids")
    sample = matrix(classes.orderBy(F.xxhash64("c")).limit(SAMPLE).select("v").toPandas()["v"])  # at most SAMPLE rows
    lists = int(max(1, min(LISTS, total // PER_LIST, len(sample) // 16)))
    centers, turn = centroids_of(sample, lists), rotation(sample.shape[1])
    lists = len(centers)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"list": nearest(matrix(batch["v"]), centers).astype("int32"), "c": batch["c"], "v": batch["v"]})

    filed = stored(classes.select("c", "v").mapInPandas(assign, "list int, c bigint, v array<float>"), "lists")
    sizes = {r["list"]: r["count"] for r in filed.groupBy("list").count().collect()}  # at most LISTS rows
    size = np.array([sizes.get(i, 0) for i in range(lists)])
    asked = stored(classes.join(queries.select("c").distinct(), "c").select("c", "v"), "asked")
    probes = max(PROBES, int(np.ceil(probed * lists)))
    chunks = np.maximum(1, -(-size // CHUNK))

    def probe(low: int, high: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        """The asks for a query's lists from the ``low``-th best up to the ``high``-th."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            together = max(1, 16_384 // (high - low))
            for whole in batches:
                for at in range(0, len(whole), together):
                    batch = whole[at:at + together]
                    order = np.argsort(-(matrix(batch["v"]) @ centers.T), axis=1, kind="stable")
                    held = np.cumsum(size[order], axis=1)
                    # Lists are probed until they are enough in number and hold enough vectors.
                    need = np.maximum(probes, np.minimum((held < 4 * (k + 1)).sum(axis=1) + 1, lists))
                    order = order[:, low:high]
                    row, column = np.nonzero((np.arange(low, low + order.shape[1]) < need[:, None]) & (size[order] > 0))
                    target = order[row, column]
                    times = chunks[target]
                    row, target = np.repeat(row, times), np.repeat(target, times)
                    chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    yield pd.DataFrame({"list": target.astype("int32"), "chunk": chunk.astype("int32"), **{
                        c: batch[c].to_numpy()[row] for c in ("c", "floor", "v")}})
        return run

    by_list = F.element_at(F.array(*[F.lit(int(x)) for x in chunks]), F.col("list") + 1)
    chunked = filed.withColumn("chunk", F.pmod(F.xxhash64("c"), by_list).cast("int"))

    def look(_: tuple, asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks) and len(held):
            x, q = matrix(held["v"]), matrix(asks["v"])
            turned, asked_turned = x @ turn, q @ turn
            cuts = range(0, x.shape[1], BLOCK)
            blocks = [np.ascontiguousarray(turned[:, a:a + BLOCK]) for a in cuts]
            partial = list(np.cumsum([(b ** 2).sum(axis=1) for b in blocks], axis=0))
            ids, asking, floor = held["c"].to_numpy(), asks["c"].to_numpy(), asks["floor"].to_numpy()
            together = max(1, PAIRS // len(x))
            for a in range(0, len(q), together):
                part = slice(a, a + together)
                row, place = scan(asked_turned[part], blocks, partial, k + 1, floor[part])
                scores = np.einsum("ij,ij->i", x[place], q[part][row])
                # Classes that tie at the edge all stay: their ids decide later.
                stay = scores >= edges_of(row, scores, k + 1, floor[part])[row]
                out.append(pd.DataFrame({"q": asking[part][row[stay]], "c": ids[place[stay]], "score": scores[stay]}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "c": [], "score": []}).astype({"q": "int64", "c": "int64", "score": "float64"})

    group, best, edges = ["list", "chunk", "part"], None, steps(probes, lists)
    for low, high in zip(edges, edges[1:]):
        parts = _parts(total, min(high, probes) - low, lists)
        floors = asked.withColumn("floor", F.lit(float("-inf"))) if best is None else asked.join(bounds(best, k), F.col("c") == F.col("q"), "left").select(
            "c", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
        asking = floors.mapInPandas(probe(low, high), "list int, chunk int, c bigint, floor double, v array<float>").withColumn(
            "part", F.pmod(F.xxhash64("c", "list"), F.lit(parts)).cast("int"))
        kept = chunked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        found = asking.groupBy(*group).cogroup(kept.groupBy(*group)).applyInPandas(look, "q bigint, c bigint, score double")
        ranked = (found if best is None else best.unionByName(found)).withColumn("n", F.rank().over(Window.partitionBy("q").orderBy(F.col("score").desc())))
        best = stored(ranked.where(F.col("n") <= k + 1).drop("n"), "nearest")
    ids = best.join(classes.select(F.col("c").alias("k"), "ids"), F.col("c") == F.col("k")).select("q", "c", "score", F.explode("ids").alias("id"))
    top = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    ids = ids.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
    ranked = ids.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score", "c"))).alias("best"))  # k + 1 at most
    own = queries.join(ranked, F.col("c") == F.col("q"))
    others = F.slice(F.filter("best", lambda x: (x["id"] != F.col("id")) | (x["c"] != F.col("q"))), 1, k)
    return own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def steps(probes: int, lists: int) -> list[int]:
    """Where the steps of a query's lists begin, and the end of the last one; the last holds what is left over."""
    edges, edge = [0], FIRST
    while edge < lists and (edge == FIRST or 2 * edge <= probes):
        edges.append(edge)
        edge *= WIDER
    return [*edges, lists]


def bounds(best: DataFrame, k: int) -> DataFrame:
    """``q, floor``: the score that a class must reach to be among the best ``k + 1`` of a query; null while there are fewer."""
    return best.groupBy("q").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("floor"))


def _parts(total: int, probes: int, lists: int) -> int:
    """Into how many parts the queries of a list are cut: a row in twenty probes this share of the lists."""
    return max(1, int(total / 20 * probes / lists / TOGETHER))


def exact(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """What ``search`` gives when every list is probed to the end; for measuring recall."""
    return search(vectors, is_query, k, key, vector, probed=1.0)
