"""Hard negatives: rotated one-bit codes, popcount estimates, and residual intervals that never err.

Vectors are integers: every component x becomes floor(256 x).  A vector is
rotated and coded by the signs of its components; the code vector (the signs
over the root of the dimensions) and the vector's product with it, their
alignment, are kept.  What the aligned code vector leaves is rotated and coded
again, a few times over, so that

    <q, x> = sum of alignment * <q rotated, code vector>, and <q, what is left>.

The anchor's rotated components are cut to a few bits, so a product with a code
vector is a sum of popcounts; the cut's exact length bounds its error.  What is
left stands at a right angle to the last code vector, so Cauchy-Schwarz with the
part of the anchor that does so too bounds its product.  Both give an interval
that holds the true score.  Candidates whose interval cannot matter are dropped
after each code; the others are scored in 64-bit integers.

Anchors are the query set.  They come in blocks of bounded size, and every block
is sent to the tasks that hold the candidates.  Each task returns the best few
of its candidates per anchor, which are merged.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; of rows that share an id the one with the smallest label
and then vector counts; a shorter vector stands for one with zeros at its end;
scaled components beyond 2^31 count as 2^31; an anchor without others of its
label has no positive, a pair without negatives no row; empty tables give no
rows.  Equal scores rank by id.  Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored

#: Codes of a vector; bits that an anchor's components are cut to.
CODES, BITS = 4, 8
#: Vectors of a chunk; components of a block of anchors, after which it is closed.
CHUNK, BLOCK = 4096, 1 << 19
#: Rounding of the estimates, as a share of the two lengths' product.
SLACK = 1e-9
SEED = 13

CODED = "dims int, ids binary, labels binary, vectors binary, codes binary, alignments binary, rests binary"


def prepared(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """``id, label, v``: the rows that take part, one per id, with integer components."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), (F.col("label") if label is None else label).cast("bigint").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))
    edge = float(1 << 31)
    scaled = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * 256, F.lit(edge)), F.lit(-edge))))
    return rows.select("id", F.struct("label", scaled.alias("v")).alias("r")).groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*")


def rotations(dims: int) -> list[np.ndarray]:
    """Random orthogonal matrices, the same everywhere."""
    rng, made = np.random.default_rng(SEED), []
    for _ in range(CODES):
        q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
        made.append(q * np.sign(np.diag(r)))
    return made


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit cells."""
    raw = np.packbits(bits, axis=1, bitorder="little")
    wide = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    wide[:, :raw.shape[1]] = raw
    return np.ascontiguousarray(wide).view("<u8")


def code(vectors: np.ndarray, turns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every vector the codes, alignments, and lengths of what each code leaves."""
    left, root = vectors.astype(float), np.sqrt(vectors.shape[1])
    codes, alignments, rests = [], [], []
    for turn in turns:
        left = left @ turn
        signs = np.where(left >= 0, 1.0, -1.0)
        along = np.abs(left).sum(axis=1) / root
        left = left - along[:, None] * signs / root
        codes.append(packed(signs > 0))
        alignments.append(along)
        rests.append(np.sqrt((left ** 2).sum(axis=1)))
    return np.stack(codes), np.stack(alignments), np.stack(rests)


def coded(rows: DataFrame, dims: int) -> DataFrame:
    """The vectors in chunks, with their codes; a chunk is in the order of labels."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = rotations(dims)
        ids, labels, vectors = [], [], []

        def chunk() -> pa.RecordBatch:
            x = np.zeros((len(ids), dims), np.int64)
            for row, v in zip(x, vectors):
                row[:len(v)] = v
            by = np.lexsort((ids, labels))
            x = x[by]
            codes, alignments, rests = code(x, turns)
            cells = [np.array(ids, np.int64)[by], np.array(labels, np.int64)[by], x, codes, alignments, rests]
            return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                                              ["dims", "ids", "labels", "vectors", "codes", "alignments", "rests"])

        for batch in batches:
            of = batch.column("v")
            offsets, flat = of.offsets.to_numpy(), of.values.to_numpy(zero_copy_only=False)
            for k, (one, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())):
                ids.append(one)
                labels.append(label)
                vectors.append(flat[offsets[k]:offsets[k + 1]].copy())
                if len(ids) >= CHUNK:
                    yield chunk()
                    ids, labels, vectors = [], [], []
        if ids:
            yield chunk()

    return stored(rows.mapInArrow(chunks, CODED), "one-bit-codes")


class Chunk:
    """A chunk of candidates, and the intervals of their scores with an anchor."""

    def __init__(self, row: dict) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(n, row["dims"])
        self.codes = np.frombuffer(row["codes"], "<u8").reshape(CODES, n, -1)
        self.alignments = np.frombuffer(row["alignments"]).reshape(CODES, n)
        self.rests = np.frombuffer(row["rests"]).reshape(CODES, n)
        self.ones = np.bitwise_count(self.codes).sum(axis=2, dtype=np.int64)
        self.lengths = np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1))

    def survivors(self, anchor: "Anchor", among: np.ndarray, choose: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The places of ``among`` that ``choose`` keeps, code after code, given the ends of their intervals."""
        estimate, blur = np.zeros(len(among)), np.zeros(len(among))
        for s, cut in enumerate(anchor.cuts):
            if not len(among):
                break
            along = self.alignments[s, among]
            counts = np.bitwise_count(self.codes[s, among][:, None, :] & cut.planes[None]).sum(axis=2, dtype=np.float64)
            inner = (2 * (cut.low * self.ones[s, among] + cut.step * (counts @ cut.worth)) - cut.total) / anchor.root
            estimate = estimate + along * inner
            blur = blur + along * cut.error
            # Of the anchor, only what stands at a right angle to the code vector meets what is left.
            across = np.sqrt(np.maximum(anchor.square - np.maximum(np.abs(inner) - cut.error, 0) ** 2, 0))
            reach = self.rests[s, among] * across + blur + SLACK * anchor.length * self.lengths[among] + SLACK
            stay = choose(estimate - reach, estimate + reach)
            among, estimate, blur = among[stay], estimate[stay], blur[stay]
        return among

    def scores(self, anchor: "Anchor", places: np.ndarray) -> np.ndarray:
        return self.vectors[places] @ anchor.vector


class _Cut:
    """An anchor's rotated components, cut to bits: low + step * sum of 2^j plane j."""

    def __init__(self, rotated: np.ndarray) -> None:
        self.low = float(rotated.min())
        self.step = (float(rotated.max()) - self.low) / ((1 << BITS) - 1)
        units = np.rint((rotated - self.low) / self.step).astype(np.int64) if self.step else np.zeros(len(rotated), np.int64)
        self.planes = packed((units[None] >> np.arange(BITS)[:, None]) & 1)
        self.worth = (1 << np.arange(BITS)).astype(float)
        near = self.low + self.step * units
        self.total, self.error = float(near.sum()), float(np.sqrt(((rotated - near) ** 2).sum()))


class Anchor:
    def __init__(self, key: int, label: int, vector: np.ndarray, turns: list[np.ndarray]) -> None:
        self.key, self.label, self.vector = key, label, vector
        rotated, self.cuts, self.root = vector.astype(float), [], np.sqrt(len(vector))
        self.square = float((rotated ** 2).sum())
        self.length = np.sqrt(self.square)
        for turn in turns:
            rotated = rotated @ turn
            self.cuts.append(_Cut(rotated))


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


class Positives:
    """The best ``k`` others of the anchor's label so far."""

    def __init__(self, anchor: Anchor, k: int) -> None:
        self.anchor, self.k = anchor, k
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look(self, chunk: Chunk) -> None:
        a, b = np.searchsorted(chunk.labels, (self.anchor.label, self.anchor.label + 1))
        among = np.arange(a, b)
        among = among[chunk.ids[among] != self.anchor.key]

        def choose(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            bound = float(self.score[-1]) if len(self.score) == self.k else -np.inf
            if len(low) > self.k:
                bound = max(bound, np.partition(low, len(low) - self.k)[len(low) - self.k])
            return high >= bound

        kept = chunk.survivors(self.anchor, among, choose)
        score, ids = np.concatenate((self.score, chunk.scores(self.anchor, kept))), np.concatenate((self.id, chunk.ids[kept]))
        best = _top(score, ids, self.k)
        self.score, self.id = score[best], ids[best]


class Negatives:
    """For each positive of an anchor, the best ``k`` rows of other labels so far whose scores lie within its limits."""

    def __init__(self, anchor: Anchor, limits: list[tuple[int, int]], k: int) -> None:
        self.anchor, self.k, self.limits = anchor, k, limits
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in limits]

    def look(self, chunk: Chunk) -> None:
        among = np.flatnonzero(chunk.labels != self.anchor.label)

        def choose(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(low), bool)
            for (least, most), (score, _) in zip(self.limits, self.best):
                bound = max(least, int(score[-1]) if len(score) == self.k else least)
                sure = low[(low >= least) & (high <= most)]
                if len(sure) >= self.k:
                    bound = max(bound, np.partition(sure, len(sure) - self.k)[len(sure) - self.k])
                stay |= (high >= bound) & (low <= most)
            return stay

        kept = chunk.survivors(self.anchor, among, choose)
        scores, ids = chunk.scores(self.anchor, kept), chunk.ids[kept]
        for j, ((least, most), (score, held)) in enumerate(zip(self.limits, self.best)):
            fit = (scores >= least) & (scores <= most)
            score, held = np.concatenate((score, scores[fit])), np.concatenate((held, ids[fit]))
            best = _top(score, held, self.k)
            self.best[j] = score[best], held[best]


def _limits(score: int, least: int, most: int) -> tuple[int, int]:
    """The whole numbers n with least * score <= 100 n <= most * score."""
    return -(-least * score // 100), most * score // 100


def _blocks(rows: DataFrame, dims: int) -> Iterator[list[tuple[int, int, list[int]]]]:
    held = []
    for row in rows.toLocalIterator():
        held.append((row["id"], row["label"], row["v"]))
        if len(held) * dims >= BLOCK:
            yield held
            held = []
    if held:
        yield held


def _anchors(block: list[tuple[int, int, list[int]]], dims: int) -> list[Anchor]:
    turns = rotations(dims)
    return [Anchor(key, label, np.array(v + [0] * (dims - len(v)), np.int64), turns) for key, label, v in block]


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of rows ``id, label, v`` (``prepared``).

    Per anchor its first ``positives`` others of its label, and for each of
    these the first ``negatives`` rows of another label whose score is from
    ``least`` to ``most`` per cent of the positive's.
    """
    spark, result = rows.sparkSession, None
    rows = stored(rows, "labelled-vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if dims:
        held = coded(rows, dims)
        for block in _blocks(rows.where(is_anchor), dims):
            sent = spark.sparkContext.broadcast(block)

            def nearest(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                asked = [Positives(a, positives) for a in _anchors(sent.value, dims)]
                for batch in batches:
                    for row in batch.to_pylist():
                        chunk = Chunk(row)
                        for one in asked:
                            one.look(chunk)
                for one in asked:
                    if len(one.id):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one.id), one.anchor.key)), pa.array(one.id), pa.array(one.score)],
                                                         ["anchor", "id", "score"])

            found = held.mapInArrow(nearest, "anchor bigint, id bigint, score bigint")
            order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
            best = stored(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives), "positives")
            # So many rows for each anchor of the block.
            limits: dict[int, list[tuple[int, int]]] = {}
            for row in best.collect():
                limits.setdefault(row["anchor"], []).append((row["id"], row["score"]))
            bounds = spark.sparkContext.broadcast(limits)

            def hard(batches: Iterator[pa.RecordBatch], sent=sent, bounds=bounds) -> Iterator[pa.RecordBatch]:
                asked = []
                for a in _anchors(sent.value, dims):
                    pairs = [(p, s, *_limits(s, least, most)) for p, s in bounds.value.get(a.key, [])]
                    pairs = [p for p in pairs if p[2] <= p[3]]
                    if pairs:
                        asked.append((pairs, Negatives(a, [p[2:] for p in pairs], negatives)))
                for batch in batches:
                    for row in batch.to_pylist():
                        chunk = Chunk(row)
                        for _, one in asked:
                            one.look(chunk)
                for pairs, one in asked:
                    for (p, s, _, _), (score, ids) in zip(pairs, one.best):
                        if len(ids):
                            cells = [np.full(len(ids), one.anchor.key), np.full(len(ids), p), ids, np.full(len(ids), s), score]
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

            part = stored(held.mapInArrow(hard, "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"), "negatives")
            result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
