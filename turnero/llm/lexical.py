"""Ranked lexical search: impact vectors in buckets of like length, pruned by Cauchy-Schwarz bounds.

A document's vector has, for every query term that it holds, its impact
``(10^9 tf) div (1000 tf + 20 m)`` times the root of the term's weight; a query's
vector has the roots of its terms' weights.  Their product is the score.  The
vectors are ordered by length and cut into buckets.  A bucket whose longest
vector times the query's length stays below the query's bound (the k-th best
score known so far) is passed over.  Inside a bucket the query's heaviest
coordinates are looked up; what the others can add is bounded by the lengths
that are left of both vectors, and documents that cannot reach the bound are
dropped.  Survivors are scored again, exactly, in 64-bit integers.

The longest vectors are searched first, to give the others a bound.  Queries
come in blocks of bounded size; a block is sent to the tasks that hold buckets.

Defined results: a null text has no terms; the rows of one item id are one item,
whose terms are those of all its rows; every document row is a document of its
own, also if it repeats another; equal scores rank by id, a null id last; a query
without known terms, an empty table on either side, and documents without a
common term give no rows.  Further columns of either table are not looked at.
Texts are read whole, whatever their length.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored
from turnero.llm.words import Cutter

#: Query terms of a block, with repeats, after which it is closed.
BLOCK = 1 << 16
#: Documents, and terms in them, after which a bucket is closed.
BUCKET, POSTINGS = 4096, 1 << 20
#: Share of a query's squared length that its looked-up coordinates hold; share of the buckets searched first.
FOCUS, FIRST = 0.8, 0.04
#: Bounds are floating-point numbers; they give way by this share.
SLACK = 1e-9

VECTORS = "row bigint, id bigint, n bigint, codes array<int>, tf array<int>"
WEIGHED = "row bigint, id bigint, codes array<int>, impacts array<bigint>, length double"
BUCKETS = "longest double, ids array<bigint>, lengths array<double>, codes array<int>, starts array<int>, docs array<int>, impacts array<bigint>"


def items(queries: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, terms``: the distinct terms of every item that has any."""
    rows = queries.select(F.col(item).alias("item"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["item"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in batches:
            owner = batch.column(0)
            for some in cutter.windows(batch.column(1)):
                for i, a, b in some.parts:
                    terms = [some.distinct[k] for k in np.unique(some.inverse[a:b])]
                    yield pa.RecordBatch.from_arrays([owner.take(pa.array([i] * len(terms), pa.int64())), pa.array(terms, pa.binary())], ["item", "term"])

    terms = rows.mapInArrow(cut, f"item {kind}, term binary").distinct()
    return terms.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _blocks(rows: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row["item"], [bytes(t) for t in row["terms"]]))
        size += len(held[-1][1])
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def term_counts(documents: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """``row, id, n, codes, tf``: every document's number of terms, and its counts of the given ones by their place."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast({t: k for k, t in enumerate(terms)})  # at most BLOCK terms and one item's more
    many = max(1, len(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, cutter, serial = sent.value, Cutter(), itertools.count(TaskContext.get().partitionId() << 36)
        for batch in batches:
            n, pairs, counts = np.zeros(batch.num_rows, np.int64), [], []
            for some in cutter.windows(batch.column(1)):
                place = np.array([code.get(w, -1) for w in some.distinct], np.int64)
                doc = np.zeros(len(some.inverse), np.int64)
                for i, a, b in some.parts:
                    n[i] += b - a
                    doc[a:b] = i
                codes = place[some.inverse] if len(place) else np.zeros(0, np.int64)
                pair, tf = np.unique((doc * many + codes)[codes >= 0], return_counts=True)
                pairs.append(pair)
                counts.append(tf)
            # A long text comes in several windows.
            pair, at = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]), return_inverse=True)
            tf = np.zeros(len(pair), np.int64)
            np.add.at(tf, at, np.concatenate([*counts, np.zeros(0, np.int64)]))
            offsets = np.searchsorted(pair, np.arange(batch.num_rows + 1) * many).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int32))) for x in (pair % many, tf)]
            rows = pa.array([next(serial) for _ in range(batch.num_rows)], pa.int64())
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), pa.array(n), *lists], ["row", "id", "n", "codes", "tf"])

    rows = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("t"))
    return stored(rows.mapInArrow(count, VECTORS), "term-counts")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return offsets - offsets[0], column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]


def _weighed(counts: DataFrame, weights: np.ndarray, documents: int, terms: int) -> DataFrame:
    """Impacts and lengths; documents without a weighing term are left out, as their scores are 0."""
    sent = counts.sparkSession.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            offsets, codes = _lists(batch.column("codes"))
            tf = _lists(batch.column("tf"))[1].astype(np.int64)
            m = 50 + 50 * batch.column("n").to_numpy(zero_copy_only=False) * documents // terms
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            impacts = 1_000_000_000 * tf // (1000 * tf + 20 * m[owner])
            length = np.sqrt(np.bincount(owner, w[codes] * impacts.astype(float) ** 2, batch.num_rows))
            made = [batch.column("row"), batch.column("id"), batch.column("codes"),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(impacts)), pa.array(length)]
            yield pa.RecordBatch.from_arrays(made, ["row", "id", "codes", "impacts", "length"]).filter(pa.array(length > 0))

    return counts.mapInArrow(weigh, WEIGHED)


def _bucket(ids: list, lengths: list, codes: list, impacts: list) -> pa.RecordBatch:
    flat, values = np.concatenate(codes).astype(np.int64), np.concatenate(impacts)
    docs = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
    by = np.argsort(flat, kind="stable")
    flat, docs, values = flat[by], docs[by], values[by]
    held, starts = np.unique(flat, return_index=True)
    row = {"longest": [lengths[0]], "ids": [ids], "lengths": [lengths], "codes": [held], "starts": [np.append(starts, len(flat))],
           "docs": [docs], "impacts": [values]}
    kinds = {"longest": pa.float64(), "ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.float64()), "codes": pa.list_(pa.int32()),
             "starts": pa.list_(pa.int32()), "docs": pa.list_(pa.int32()), "impacts": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(row[n], kind) for n, kind in kinds.items()], list(kinds))


def buckets(weighed: DataFrame) -> DataFrame:
    """The vectors from long to short, so many in a row; equal lengths are told apart by row, so any number of copies spreads."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, codes, impacts, size = [], [], [], [], 0
        for batch in batches:
            offsets, flat = _lists(batch.column("codes"))
            values = _lists(batch.column("impacts"))[1]
            for k, (one, length) in enumerate(zip(batch.column("id").to_pylist(), batch.column("length").to_pylist())):
                a, b = offsets[k], offsets[k + 1]
                ids.append(one)
                lengths.append(length)
                codes.append(flat[a:b])
                impacts.append(values[a:b])
                size += b - a
                if len(ids) >= BUCKET or size >= POSTINGS:
                    yield _bucket(ids, lengths, codes, impacts)
                    ids, lengths, codes, impacts, size = [], [], [], [], 0
            codes, impacts = [c.copy() for c in codes], [c.copy() for c in impacts]  # else they keep the whole batch
        if ids:
            yield _bucket(ids, lengths, codes, impacts)

    order = [F.col("length").desc(), F.col("row")]
    return stored(weighed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(fill, BUCKETS), "impact-buckets")


class _Best:
    """The k best of an item so far."""

    def __init__(self, k: int, bound: int) -> None:
        self.k, self.bound = k, bound
        self.score, self.id, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        top = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[top], ids[top], null[top]
        if len(top) == self.k:
            self.bound = max(self.bound, int(self.score[-1]))


def _look(bucket: dict, weights: np.ndarray, wanted: list[np.ndarray], best: list[_Best]) -> None:
    """Search one bucket for every item; ``wanted`` has each item's codes, the heaviest first."""
    lengths, longest, n = bucket["lengths"], bucket["longest"], len(bucket["lengths"])
    codes, starts, docs, impacts = bucket["codes"], bucket["starts"], bucket["docs"], bucket["impacts"]
    for terms, top in zip(wanted, best):
        w = weights[terms].astype(float)
        if not len(terms) or math.sqrt(w.sum()) * longest * (1 + SLACK) < top.bound:
            continue
        focus = int(np.searchsorted(np.cumsum(w), FOCUS * w.sum())) + 1
        at = np.searchsorted(codes, terms)
        here = (at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == terms)
        part, seen = np.zeros(n), np.zeros(n)
        for k in np.flatnonzero(here[:focus]):
            a, b = starts[at[k]], starts[at[k] + 1]
            value = w[k] * impacts[a:b]
            part[docs[a:b]] += value
            seen[docs[a:b]] += value * impacts[a:b]
        # Whatever the other coordinates hold, their product is at most that of the lengths left.
        rest = math.sqrt(w[focus:].sum()) * np.sqrt(np.maximum(lengths * lengths * (1 + SLACK) - seen, 0))
        alive = (part + rest) * (1 + SLACK) >= top.bound
        if not alive.any():
            continue
        score = np.zeros(n, np.int64)
        for k in np.flatnonzero(here):
            a, b = starts[at[k]], starts[at[k] + 1]
            score[docs[a:b]] += weights[terms[k]] * impacts[a:b]
        alive &= score >= top.bound
        top.add(score[alive], bucket["ids"][alive], bucket["null"][alive])


def _searched(held: DataFrame, names: list, kind: str, weights: np.ndarray, wanted: list[np.ndarray], bounds: list[int], k: int) -> DataFrame:
    """``item, id, score``: of each task's buckets the best ``k`` for each item, none below the item's bound."""
    sent = held.sparkSession.sparkContext.broadcast((names, weights, wanted, bounds))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, wanted, bounds = sent.value
        best, owner = [_Best(k, b) for b in bounds], None
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c)[i] for c in batch.schema.names}
                ids = one.pop("ids").values
                plain = {c: x.as_py() if c == "longest" else x.values.to_numpy(zero_copy_only=False) for c, x in one.items()}
                null = ids.is_null().to_numpy(zero_copy_only=False)
                _look(plain | {"ids": ids.fill_null(0).to_numpy(zero_copy_only=False), "null": null}, weights, wanted, best)
        for name, top in zip(names, best):
            if len(top.id):
                owner = pa.array([name] * len(top.id), ITEM_KINDS.get(kind))
                yield pa.RecordBatch.from_arrays([owner, pa.array(top.id, mask=top.null), pa.array(top.score)], ["item", "id", "score"])

    return held.mapInArrow(look, f"item {kind}, id bigint, score bigint")


ITEM_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _best_first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, queries: DataFrame, k: int = 50, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, rank, key, score``: of every item the ``k`` documents with the highest scores above 0."""
    kind = queries.schema[item].dataType.simpleString()
    if kind not in ITEM_KINDS:
        raise ValueError(f"items are told apart by one of {', '.join(ITEM_KINDS)}, not {kind}")
    result = None
    for block in _blocks(items(queries, item, text)):
        terms = sorted({t for _, own in block for t in own})
        place = {t: c for c, t in enumerate(terms)}
        counts = term_counts(documents, terms, key, text)
        held = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not held[1]:
            continue
        # At most as many rows as the block has terms.
        df = counts.select(F.explode("codes").alias("code")).groupBy("code").count().collect()
        weights = np.zeros(len(terms), np.int64)
        for row in df:
            weights[row["code"]] = math.floor(1000 * math.log((2 * held[0] + 2) / (2 * row["count"] + 1)))
        names = [name for name, _ in block]
        wanted = [np.array(sorted((place[t] for t in own if weights[place[t]] > 0), key=lambda c: (-weights[c], c)), np.int64) for _, own in block]
        filed = buckets(_weighed(counts, weights, *held))
        edge = filed.agg(F.percentile_approx("longest", 1 - FIRST)).first()[0]
        if edge is None:
            continue
        first = stored(_searched(filed.where(F.col("longest") >= edge), names, kind, weights, wanted, [1] * len(names), k), "first-found")
        # One row per item of the block.
        known = {r["item"]: r["score"] for r in _best_first(first, k).where(F.col("rank") == k).select("item", "score").collect()}
        rest = _searched(filed.where(F.col("longest") < edge), names, kind, weights, wanted, [known.get(name, 1) for name in names], k)
        found = stored(first.unionByName(rest), "found")
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = documents.sparkSession.createDataFrame([], f"item {kind}, id bigint, score bigint")
    return _best_first(result, k).select(F.col("item").alias(item), "rank", F.col("id").alias(key), "score")
