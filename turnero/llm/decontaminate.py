"""Benchmark passages in training documents: an FM-index per shard, searched for every window of the benchmark.

A shard is some million words of documents, as they stand in a partition.  Its
FM-index (``fm_index``) is built once and stored; any set of test phrases can be
searched in it afterwards.  A window is ``WINDOW`` consecutive words of an item;
an item of fewer words, but not none, is one window.  Windows are counted by
backward search, all of one length together; occurrences are located by sampled
positions, and their spans are merged.

The benchmark is the query set.  It comes in blocks of bounded size, each of
which is sent to the tasks that hold the shards.

Defined results: a null text has no words; an item without words has no window;
an item of null id marks words but is not counted in ``n_items``; rows of one
item id are one item; every row of ``documents`` is a document of its own, also
if it repeats another; texts of any length are indexed whole, in pieces that
overlap by a window less a word; empty tables give no rows, and an empty
benchmark finds nothing.  Further columns of either table are not looked at.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored
from turnero.llm.fm_index import Index
from turnero.llm.words import Cutter

#: Words of a window.
WINDOW = 10
#: Words of a shard, and of a block of the benchmark, after which it is closed; words of a benchmark row, at most.
SHARD, BLOCK, PIECE = 1 << 20, 1 << 20, 1 << 17

INDEX = ("docs array<struct<key:bigint,id:{id},words:bigint,at:bigint,start:bigint>>, n bigint, words array<binary>, "
         "counts binary, levels array<binary>, marks binary, samples binary")
HITS = "key bigint, items array<string>, spans array<struct<a:bigint,b:bigint>>"
FOUND = pa.schema([("key", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])


def _index_schema(key: pa.DataType) -> pa.Schema:
    whole, raw = pa.int64(), pa.binary()
    doc = pa.struct([("key", whole), ("id", key), ("words", whole), ("at", whole), ("start", whole)])
    return pa.schema([("docs", pa.list_(doc)), ("n", whole), ("words", pa.list_(raw)), ("counts", raw), ("levels", pa.list_(raw)),
                      ("marks", raw), ("samples", raw)])


class _Shard:
    """Documents' words on their way into an index."""

    def __init__(self) -> None:
        self.symbols: dict[bytes, int] = {}
        self.text: list[np.ndarray] = []
        self.docs: list[dict] = []
        self.size = 0

    def add(self, doc: dict, words: np.ndarray, fresh: int) -> None:
        if self.docs and self.docs[-1]["key"] == doc["key"]:
            self.docs[-1]["words"] += fresh
        else:
            self.close()
            self.docs.append(doc | {"words": fresh, "at": self.size})
        self.text.append(words)
        self.size += len(words)

    def close(self) -> None:
        """The end mark of the last document."""
        if self.docs:
            self.text.append(np.zeros(1, np.int32))
            self.size += 1

    def tail(self, n: int) -> tuple[list[bytes], int]:
        """The last words of the last document, and the number of its words up to the end."""
        whole = np.concatenate(self.text)[self.docs[-1]["at"]:]
        names = list(self.symbols)
        return [names[s - 1] for s in whole[len(whole) - min(n, len(whole)):]], self.docs[-1]["start"] + len(whole)

    def index(self) -> dict:
        self.close()
        offsets = np.array([d["at"] for d in self.docs] + [self.size], np.int64)
        made = Index.build(np.concatenate(self.text), offsets, pa.array(list(self.symbols), pa.binary()))
        return {"docs": self.docs} | made.dump()


def build(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per shard: its documents and its FM-index, for phrases of up to ``window`` words."""
    rows = documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
    schema = INDEX.format(id=rows.schema["id"].dataType.simpleString())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, shard, number = Cutter(), _Shard(), itertools.count(TaskContext.get().partitionId() << 36)
        for batch in batches:
            made = _index_schema(batch.column(0).type)
            ids = batch.column(0).to_pylist()
            last, doc = -1, {}
            for cut in cutter.windows(batch.column(1)):
                overlap, start = [], 0
                if shard.size and shard.size + len(cut.inverse) > SHARD:
                    if cut.parts[0][0] == last:
                        overlap, start = shard.tail(window - 1)
                    yield pa.RecordBatch.from_pylist([shard.index()], made)
                    shard = _Shard()
                symbols = shard.symbols
                here = np.fromiter((symbols.setdefault(w, len(symbols) + 1) for w in cut.distinct), np.int32, len(cut.distinct))
                words = here[cut.inverse] if len(here) else np.zeros(0, np.int32)
                for i, a, b in cut.parts:
                    if i != last:
                        last, doc = i, {"key": next(number), "id": ids[i], "start": 0}
                    elif overlap or start:
                        doc = doc | {"start": start - len(overlap)}
                        shard.add(doc, np.array([symbols.setdefault(w, len(symbols) + 1) for w in overlap], np.int32), 0)
                        overlap, start = [], 0
                    shard.add(doc, words[a:b], b - a)
        if shard.docs:
            yield pa.RecordBatch.from_pylist([shard.index()], made)

    return stored(rows.mapInArrow(shards, schema), "fm-index")


def phrases(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item, words``: the items' words; a long item in pieces, so that every window is in one of them."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in batches:
            items, held, last = batch.column(0).to_pylist(), [], -1

            def row(i: int, words: list[bytes]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([items[i]], pa.string()), pa.array([words], pa.list_(pa.binary()))], ["item", "words"])

            for some in cutter.windows(batch.column(1)):
                for i, a, b in some.parts:
                    if i != last and held:
                        yield row(last, held)
                    held = (held if i == last else []) + [some.distinct[k] for k in some.inverse[a:b]]
                    last = i
                    while len(held) > PIECE:
                        yield row(i, held[:PIECE])
                        held = held[PIECE - window + 1:]
            if held:
                yield row(last, held)

    return rows.mapInArrow(cut, "item string, words array<binary>")


def _blocks(rows: DataFrame) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The phrases, so many words at a time."""
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row["item"], [bytes(w) for w in row["words"]]))
        size += len(held[-1][1])
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Windows:
    """The distinct windows of a block, by length, with the items that hold each."""

    def __init__(self, block: list[tuple[str | None, list[bytes]]], window: int) -> None:
        codes: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in block if i is not None})
        number = {i: k for k, i in enumerate(self.items)}
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, words in block:
            line = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
            m = min(window, len(line))
            by_length.setdefault(m, []).append((np.lib.stride_tricks.sliding_window_view(line, m), number.get(item, -1)))
        self.words = pa.array(list(codes), pa.binary())
        self.sets = []
        for parts in by_length.values():
            lines, at = np.unique(np.concatenate([p for p, _ in parts]), axis=0, return_inverse=True)
            owner = np.repeat([k for _, k in parts], [len(p) for p, _ in parts])
            pairs = np.unique(np.stack((at.reshape(-1), owner), axis=1)[owner >= 0], axis=0)
            self.sets.append((lines, pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(lines) + 1))))

    def find(self, index: Index, docs: list[dict]) -> Iterator[dict]:
        """For each document with a hit: the items found in it and the merged spans of its words."""
        symbols = index.symbols(self.words)
        offsets = np.array([d["at"] for d in docs], np.int64)
        edges = np.zeros(index.n + 1, np.int64)
        held = []
        for lines, owners, owned in self.sets:
            low, high = index.count(symbols[lines])
            phrase = np.repeat(np.arange(len(lines)), high - low)
            rows = np.arange(len(phrase)) - np.repeat(np.cumsum(high - low) - high, high - low)
            place = index.locate(rows)
            np.add.at(edges, place, 1)
            np.add.at(edges, place + lines.shape[1], -1)
            doc = np.searchsorted(offsets, place, side="right") - 1
            seen = np.unique(doc * len(lines) + phrase)
            doc, phrase = seen // max(1, len(lines)), seen % max(1, len(lines))
            count = owned[phrase + 1] - owned[phrase]
            which = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(owned[phrase], count)
            held.append(np.unique(np.repeat(doc, count) * len(self.items) + owners[which]))
        covered = np.concatenate(([0], (np.cumsum(edges) > 0).astype(np.int8)))
        change = np.diff(covered)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        pairs = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
        owner_doc = pairs // max(1, len(self.items))
        span_doc = np.searchsorted(offsets, starts, side="right") - 1
        for d in np.unique(span_doc):
            a, b = np.searchsorted(span_doc, (d, d + 1))
            i, j = np.searchsorted(owner_doc, (d, d + 1))
            shift = docs[d]["start"] - docs[d]["at"]
            yield {"key": docs[d]["key"], "items": [self.items[k % len(self.items)] for k in pairs[i:j]],
                   "spans": [{"a": x + shift, "b": y + shift} for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())]}


def search(index: DataFrame, wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, items, spans`` of every document of ``index`` with a window of ``wanted``: spans of words, [a, b).

    A document can have several rows, as it lies in several pieces or as the
    phrases came in several blocks.
    """
    spark, found = index.sparkSession, None
    for block in _blocks(wanted):
        sent = spark.sparkContext.broadcast(block)

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows = None
            for batch in batches:
                windows = windows or _Windows(sent.value, window)
                for k in range(batch.num_rows):
                    one = {n: batch.column(n)[k] for n in batch.schema.names}
                    docs = one.pop("docs").as_py()
                    plain = {n: x.values if n == "words" else x.as_py() for n, x in one.items()}
                    hits = list(windows.find(Index.load(**plain), docs))
                    if hits:
                        yield pa.RecordBatch.from_pylist(hits, FOUND)

        part = stored(index.mapInArrow(look, HITS), "benchmark-hits")
        found = part if found is None else found.unionByName(part)
        sent.unpersist()
    return spark.createDataFrame([], HITS) if found is None else found


def merged_spans(hits: DataFrame) -> DataFrame:
    """``key, a, b``: the hits' spans per document, those that meet or overlap made one."""
    line = Window.partitionBy("key").orderBy("a", "b")
    before = F.max("b").over(line.rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.select("key", F.inline("spans")).withColumn("opens", F.when(before >= F.col("a"), 0).otherwise(1))
    grouped = spans.withColumn("island", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("key", "island").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("island")


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Per document: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``spans``.

    ``spans`` lists the words to remove as (from, to), ``to`` not included, in
    order; null where there are none.  ``items_sha256`` is over the ids of the
    items found, sorted as strings and joined by commas.
    """
    index = build(documents, key, window=window)
    hits = search(index, phrases(benchmark, window=window), window)
    docs = index.select(F.inline("docs")).groupBy("key").agg(F.any_value("id").alias("id"), F.sum("words").alias("n_words"))
    spans = merged_spans(hits).groupBy("key").agg(
        F.sum(F.col("b") - F.col("a")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))
    items = hits.select("key", F.explode("items").alias("item")).groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    joined = docs.join(spans, "key", "left").join(items, "key", "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), "spans")


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _without(texts: Column, spans: Column) -> Column:
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, span in batches:
            out = []
            for t, s in zip(text, span):
                if t is not None and s is not None and len(s):
                    at = [m.span() for m in _WORD.finditer(t)]
                    edges = [0, *(x for one in s for x in (at[one["a"]][0], at[one["b"] - 1][1])), len(t)]
                    t = "".join(t[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2))
                out.append(t)
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(cut, "string")(texts, spans)


def decontaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``documents``, all columns kept, without the words of benchmark passages; the characters around them stay."""
    name, taken = "row", {c.lower() for c in documents.columns}
    while name in taken:
        name = "_" + name
    rows = stored(documents.withColumn(name, F.monotonically_increasing_id()), "documents")
    marked = contaminated(rows.select(name, F.col(text).alias("text")), benchmark, name, window).where("contaminated")
    marked = marked.select(F.col(name).alias("at"), F.struct(F.col("spans")).alias("cut"))
    spans = rows.alias("d").join(marked.alias("m"), F.col(f"d.{name}") == F.col("m.at"), "left")
    whole, parts = F.col(f"d.{text}"), F.col("m.cut.spans")
    return spans.select(*(F.when(parts.isNull(), whole).otherwise(_without(whole, parts)).alias(c) if c == text else F.col(f"d.{c}")
                          for c in documents.columns))
