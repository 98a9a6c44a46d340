"""Repeated paragraphs and passages: MinHash banding, exact checks, removal by components.

Paragraphs (lines of enough words) are compared as sets of five-word shingles.
MinHash bands, tuned for recall at the wanted similarity, file every distinct
paragraph; those that meet in a band are checked with their exact Jaccard
similarity; components of the links are the classes, of which one occurrence
stays.  A bucket is first checked against its smallest member, which needs as
many pairs as members; only buckets whose members are then not all in one
component are checked pair by pair, in chunks, so no link is lost.

A passage that was pasted into the middle of other text is no paragraph.  For
it texts are also cut where a hash of a word is smallest among its neighbours:
cuts that depend on the passage alone, so its inner pieces are equal wherever
it stands.  Runs of pieces that other documents hold too are repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored
from turnero.llm.components import connected_components

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Words of a paragraph and of a run of repeated pieces, at least; neighbours on each side that a cut looks at.
PARAGRAPH_WORDS, RUN_WORDS, NEIGHBOURS = 20, 20, 4
#: Members of a bucket that is joined with itself, at most; members of a larger one that are checked pair by pair at a time.
SMALL, CHUNK = 64, 256
#: Bits of a set's sketch, by which most pairs of a larger bucket are told apart.
SKETCH = 1024
#: Words of a piece or paragraph that its place can tell.
MOST = (1 << 20) - 1
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def tuned(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = 3) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` hashes that catch a pair of ``similarity`` with chance ``recall``."""
    miss = 1 - similarity ** rows
    return int(np.ceil(np.log(1 - recall) / np.log(miss))), rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (lower case in A-Z, cut at ASCII white space), and the first word of each line that has one."""
    digest, hashes, lines = xxhash.xxh64_intdigest, [], []
    for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n"):
        words = line.split()
        if words:
            lines.append(len(hashes))
            hashes += map(digest, words)
    return np.array(hashes, np.uint64), np.array(lines, np.int64)


def words_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of every run of five words; of fewer words the whole run."""
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        out = out * np.uint64(_STEP) + mixed(words[k:k + n] + np.uint64(k + 1))
    return mixed(out)


def paragraphs(words: np.ndarray, lines: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first word, number of words) of the lines with enough words."""
    ends = np.append(lines[1:], len(words))
    return [(int(a), int(b - a)) for a, b in zip(lines, ends) if b - a >= least]


def identity(words: np.ndarray) -> int:
    """Signed 64-bit hash of a row of words."""
    return int(np.frombuffer(xxhash.xxh64_digest(words.tobytes(), 1), ">i8")[0])


def bands_of(words: np.ndarray, spans: list[tuple[int, int]], bands: int, rows: int) -> list[list[int]]:
    """For each paragraph (of five words or more) one signed hash per band of the MinHash of its shingles.

    All paragraphs of a text are taken together: one row of the array is one
    hash function over all shingles, cut at the paragraphs for the minima.
    """
    if not spans:
        return []
    found = np.append(shingles(words), np.uint64(0))
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(_STEP))[:, None]
    low = np.empty((len(seeds), len(spans)), np.uint64)
    at = 0
    while at < len(spans):
        upto = at + 1  # whole paragraphs of some ten thousand words at a time
        while upto < len(spans) and spans[upto][0] + spans[upto][1] - spans[at][0] < 16_384:
            upto += 1
        first = spans[at][0]
        part = found[first:spans[upto - 1][0] + spans[upto - 1][1] - SHINGLE + 2]
        product = (part ^ seeds) * (seeds | np.uint64(1))
        product ^= product >> np.uint64(31)
        borders = np.array([(a - first, a - first + n - SHINGLE + 1) for a, n in spans[at:upto]]).ravel()
        low[:, at:upto] = np.minimum.reduceat(product, borders, axis=1)[:, ::2]
        at = upto
    key = np.zeros((bands, len(spans)), np.uint64)
    for r in range(rows):
        key = mixed(key * np.uint64(_STEP) + low[r::rows])
    return mixed(key + np.arange(bands, dtype=np.uint64)[:, None]).view(np.int64).T.tolist()


def pieces(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and hash of the pieces between cuts that depend on nearby words alone."""
    n, w = len(words), NEIGHBOURS
    none = np.zeros(0, np.int64)
    if n < 2 * w + 1:
        return none, none, none
    x = mixed(words)
    inner = x[w:n - w]
    cut = np.ones(len(inner), bool)
    for k in range(1, w + 1):
        cut &= (inner < x[w - k:n - w - k]) & (inner <= x[w + k:n - w + k])
    at = np.flatnonzero(cut) + w
    if len(at) < 2:
        return none, none, none
    powers = np.cumprod(np.full(n, _STEP, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(x + np.uint64(1)) * powers)))
    inverse = pow(_STEP, -1, 1 << 64)
    back = np.cumprod(np.full(n, inverse, np.uint64))
    hashes = mixed((sums[at[1:]] - sums[at[:-1]]) * back[at[:-1]]).view(np.int64)
    return at[:-1], np.diff(at), hashes


def cut_up(docs: DataFrame, bands: int, rows: int, least: int = PARAGRAPH_WORDS) -> DataFrame:
    """``doc_id, hash, place, bands`` of every paragraph, and without bands of every piece; stored.

    ``place`` is the first word times 2 ** 20 plus the number of words.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paras, found, held = [], [], 0
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"]):
                words, lines = word_hashes(text or "")
                spans = paragraphs(words, lines, least)
                for (a, n), keys in zip(spans, bands_of(words, spans, bands, rows)):
                    paras.append((doc, identity(words[a:a + n]), a << 20 | min(n, MOST), keys))
                first, size, hashes = pieces(words)
                found.append((np.full(len(first), doc, np.int64), hashes, first << 20 | np.minimum(size, MOST)))
                held += len(first) + 16 * len(spans)
                if held > 200_000:
                    yield from frames(paras, found)
                    paras, found, held = [], [], 0
            yield from frames(paras, found)

    def frames(paras: list, found: list) -> Iterator[pd.DataFrame]:
        if paras:
            yield pd.DataFrame(paras, columns=names)
        if found:
            doc, hashes, place = map(np.concatenate, zip(*found))
            yield pd.DataFrame({"doc_id": doc, "hash": hashes, "place": place, "bands": None})

    names = ["doc_id", "hash", "place", "bands"]
    return stored(docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, hash bigint, place bigint, bands array<bigint>"), "cut-up")


def _check(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    one = sets.select(F.col("pid").alias("a"), F.col("found").alias("fa"))
    two = sets.select(F.col("pid").alias("b"), F.col("found").alias("fb"))
    joined = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("fa", "fb"))
    return joined.where(common >= F.lit(similarity) * (F.size("fa") + F.size("fb") - common)).select("a", "b")


def sketches(found: list[np.ndarray]) -> np.ndarray:
    """For each set of hashes the bits that its members set, of SKETCH, as rows of 64-bit words."""
    bits = np.zeros((len(found), SKETCH), bool)
    for row, one in zip(bits, found):
        row[one & (SKETCH - 1)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def _check_buckets(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between members of a bucket that lie in different components.

    The smallest member has been checked against all others, so it and buckets
    of two are done.  Buckets of up to SMALL members are joined with themselves,
    each pair checked where it is formed; larger ones go chunk against chunk.
    """
    sizes = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("pid").alias("hub"), F.count(F.lit(1)).alias("n"))
    mixed_ones = members.join(sizes.where("lo <> hi and n > 2").select("key", "hub", "n"), "key").where("pid <> hub").drop("hub")
    small = mixed_ones.where(F.col("n") <= SMALL).join(sets, "pid")
    one = small.select("key", F.col("pid").alias("a"), F.col("component").alias("ca"), F.col("found").alias("fa"))
    two = small.select("key", F.col("pid").alias("b"), F.col("component").alias("cb"), F.col("found").alias("fb"))
    least, most, common = F.least(F.size("fa"), F.size("fb")), F.greatest(F.size("fa"), F.size("fb")), F.size(F.array_intersect("fa", "fb"))
    close = one.join(two, "key").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (least >= F.lit(similarity) * most)
                                       & (common >= F.lit(similarity) * (least + most - common))).select("a", "b")
    large = mixed_ones.where(F.col("n") > SMALL)
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    rows = (large.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("pid", F.lit(3)), F.col("chunks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("key", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), "chunk", "pid", "component")
            .join(sets, "pid"))

    def compare(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        arrays = held["found"].tolist()
        found, bits, n = [frozenset(x.tolist()) for x in arrays], sketches(arrays), np.array([len(x) for x in arrays])
        pids, chunk = held["pid"].tolist(), held["chunk"].to_numpy()
        parent = {c: c for c in held["component"]}

        def root(c: int) -> int:
            while parent[c] != c:
                c = parent[c]
            return c

        links, component = [], held["component"].tolist()
        for i, one in enumerate(found):
            # A bit that the other set lacks is a shingle that it lacks.
            most = np.minimum(n[i] - np.bitwise_count(bits[i] & ~bits[:i]).sum(axis=1, dtype=np.int64),
                              n[:i] - np.bitwise_count(bits[:i] & ~bits[i]).sum(axis=1, dtype=np.int64))
            able = most >= similarity * (n[i] + n[:i] - most)
            if key[1] != key[2]:
                able &= chunk[:i] != chunk[i]
            for j in np.flatnonzero(able).tolist():
                if root(component[i]) != root(component[j]):
                    common = len(one & found[j])
                    if common >= similarity * (len(one) + len(found[j]) - common):
                        parent[root(component[i])] = root(component[j])
                        links.append((pids[i], pids[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return close.unionByName(rows.groupBy("key", "c1", "c2").applyInPandas(compare, "a bigint, b bigint")).distinct()


def paragraph_classes(docs: DataFrame, cut: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, place, pid, component`` of every paragraph; copies share a pid, similar ones a component."""
    found = cut.where("bands is not null").withColumnRenamed("hash", "pid")
    where = found.select("doc_id", "place", "pid")
    unique = found.groupBy("pid").agg(F.min(F.struct("doc_id", "place", "bands")).alias("x"))
    keys = unique.select("pid", "x.doc_id", "x.place", F.explode("x.bands").alias("key"))
    bucket = Window.partitionBy("key")  # distinct paragraphs with one hash in a band, numbers alone
    met = stored(keys.withColumn("hub", F.min("pid").over(bucket)).withColumn("n", F.count(F.lit(1)).over(bucket)).where("n > 1").drop("n"), "met-paragraphs")
    # The shingle sets of the paragraphs that met another, cut anew from one document that has them.
    need = met.groupBy("doc_id").agg(F.collect_set(F.struct("place", "pid")).alias("spans"))  # of one document
    wanted = docs.select("doc_id", "text").join(need, "doc_id")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, spans in zip(batch["text"], batch["spans"]):
                words, out = (text or "").encode("utf-8", "surrogatepass").lower().split(), []
                for span in spans:
                    first = span["place"] >> 20
                    part = words_of(words[first:first + (span["place"] & MOST)])
                    if identity(part) == span["pid"]:  # rows that repeat an id may hold another text
                        out.append((span["pid"], np.unique(shingles(part)).view(np.int64)))
                yield pd.DataFrame(out, columns=["pid", "found"])

    sets = stored(wanted.mapInPandas(sets_of, "pid bigint, found array<bigint>").dropDuplicates(["pid"]), "shingle-sets")
    stars = met.where("pid <> hub").select(F.col("pid").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(_check(stars, sets, similarity), "paragraph-links")
    joined = connected_components(links, "a", "b")
    members = met.select("key", "pid").join(joined, F.col("pid") == F.col("node"), "left").select("key", "pid", F.coalesce("component", "pid").alias("component"))
    more = _check_buckets(members, sets, similarity)
    final = connected_components(links.unionByName(more), "a", "b")
    return where.join(final, F.col("pid") == F.col("node"), "left").select(
        "doc_id", "place", "pid", F.coalesce("component", "pid").alias("component"))


def repeated_paragraphs(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """Paragraphs whose class spans documents: ``doc_id, kind, first_word, n_words, class_id, removed``."""
    found = stored(paragraph_classes(docs, cut), "paragraph-classes")
    classes = found.groupBy("component").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("last")).where(
        F.col("first.doc_id") != F.col("last")).select(F.col("component").alias("of"), "first")
    return found.join(classes, F.col("component") == F.col("of")).select(
        "doc_id", F.lit("paragraph").alias("kind"), F.shiftright("place", 20).alias("first_word"),
        F.col("place").bitwiseAND(F.lit(MOST)).cast("bigint").alias("n_words"), F.col("first.doc_id").alias("class_id"),
        ((F.col("doc_id") != F.col("first.doc_id")) | (F.col("place") != F.col("first.place"))).alias("removed")).distinct()


def repeated_passages(cut: DataFrame, least: int = RUN_WORDS) -> DataFrame:
    """Runs of pieces that other documents hold too: ``doc_id, kind, first_word, n_words, class_id, removed``."""
    found = cut.where("bands is null").select("doc_id", F.col("hash").alias("piece"), "place")
    shared = found.groupBy("piece").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where(
        "owner <> last").select(F.col("piece").alias("of"), "owner")
    hits = found.join(shared, F.col("piece") == F.col("of")).select(
        "doc_id", F.shiftright("place", 20).alias("at"), F.col("place").bitwiseAND(F.lit(MOST)).cast("bigint").alias("words"), "owner").distinct()
    order = Window.partitionBy("doc_id").orderBy("at")  # the pieces of one document
    starts = F.when(F.col("at") == F.lag(F.col("at") + F.col("words")).over(order), 0).otherwise(1)
    runs = hits.withColumn("start", starts).withColumn("run", F.sum("start").over(order)).groupBy("doc_id", "run").agg(
        F.min("at").alias("first_word"), F.sum("words").alias("n_words"), F.min("owner").alias("class_id"))
    return runs.where(F.col("n_words") >= least).select(
        "doc_id", F.lit("passage").alias("kind"), "first_word", "n_words", "class_id", (F.col("class_id") != F.col("doc_id")).alias("removed"))


def repeats(docs: DataFrame) -> DataFrame:
    """Every repeated paragraph and passage of every document.

    ``first_word`` and ``n_words`` say where it stands among the document's
    words; ``class_id`` is the smallest document with it; ``removed`` is false
    for the occurrence that stays.  Null texts count as empty; rows without an
    id take no part; rows that repeat an id are one document with the texts of
    all of them; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null")
    cut = cut_up(rows, *tuned())
    return repeated_paragraphs(rows, cut).unionByName(repeated_passages(cut))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed paragraphs and passages cut out of their texts, word by word, lines kept."""
    spans = repeats(docs).where("removed").groupBy(F.col("doc_id").alias("_d")).agg(
        F.array_sort(F.collect_list(F.struct("first_word", "n_words"))).alias("_spans"))  # of one document
    columns = docs.columns

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for text, found in zip(batch["text"], batch["_spans"]):
                if found is None or text is None:
                    texts.append(text)
                    continue
                gone = {w for s in found for w in range(s["first_word"], s["first_word"] + s["n_words"])}
                at, lines = 0, []
                for line in text.split("\n"):
                    words = line.encode("utf-8", "surrogatepass").split()
                    keep = [w for k, w in enumerate(words, at) if k not in gone]
                    if len(keep) == len(words):
                        lines.append(line)
                    elif keep:
                        lines.append(b" ".join(keep).decode("utf-8", "surrogatepass"))
                    at += len(words)
                texts.append("\n".join(lines))
            batch["text"] = texts
            yield batch[columns]

    return docs.join(spans, F.col("doc_id") == F.col("_d"), "left").select(*columns, "_spans").mapInPandas(cut, docs.schema)
