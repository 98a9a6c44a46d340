"""SimHash near-duplicates, compared bit-sliced.

Fingerprints that differ in at most r bits agree wholly in all but r of any
r + 2 bit bands, that is in at least two of them.  So a fingerprint is filed
under every pair of its bands, and only fingerprints in one such bucket are
compared.  A bucket is compared in blocks: the fingerprints of a block stand as
bit planes (plane i holds bit i of all of them), one comparison takes a plane
at a time for a whole block, adds the differing bits into vertical carry-save
counters, and gives the block up once every counter has passed the radius.

Copies are one fingerprint from the start.  A large bucket is cut into chunks
and each pair of chunks is compared by itself, so no task holds a bucket.  A
chunk pair returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored
from turnero.llm.components import connected_components

BITS = 64
#: Fingerprints of one bucket that are compared at a time; a chunk pair holds twice as many.
CHUNK = 2048
SEED = 42


def fingerprint(text: str | None, width: int) -> int:
    """SimHash of the word shingles, repeats included; as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts.tolist(), ends[k - 1:].tolist())], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text instead of the text."""
    keep = [f for f in docs.schema if f.name != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[out] = np.array([fingerprint(t, width) for t in batch[text]], np.int64)
            yield batch.drop(columns=[text])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + f", {out} bigint"
    return docs.mapInPandas(run, schema)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes: row i holds bit i of all values, 64 values in a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near(value: int, vertical: np.ndarray, radius: int) -> np.ndarray:
    """Lanes of the block whose value differs from ``value`` in at most ``radius`` bits.

    ``counters[c]`` is bit c of every lane's distance so far; a carry out of the
    top counter, or a count over the radius, marks a lane as far.
    """
    width = (radius + 1).bit_length()
    counters = [np.zeros(vertical.shape[1], np.uint64) for _ in range(width)]
    far = np.zeros(vertical.shape[1], np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i in range(BITS):
        carry = vertical[i] ^ full if value >> (BITS - 1 - i) & 1 else vertical[i].copy()
        for c in range(width):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        far |= carry
        if i > radius and i % 4 == 3:
            far |= _over(counters, radius)
            if (far == full).all():
                return np.zeros(0, np.int64)
    far |= _over(counters, radius)
    return np.flatnonzero(np.unpackbits((~far).view(np.uint8), bitorder="little"))


def _over(counters: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose vertical count is greater than ``limit``."""
    greater = np.zeros_like(counters[0])
    equal = ~greater
    for c in range(len(counters) - 1, -1, -1):
        if limit >> c & 1:
            equal &= counters[c]
        else:
            greater |= equal & counters[c]
            equal &= ~counters[c]
    return greater


def links(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``left``, or of those between ``left`` and ``right``."""
    values = left if right is None else np.concatenate((left, right))
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    against = values if right is None else right
    shift = 0 if right is None else len(left)
    block = planes(against.astype(np.int64).view(np.uint64))
    for k, value in enumerate(left.tolist()):
        first = (k + 1) // 64 if right is None else 0  # blocks before it have met this value
        lanes = near(value & 0xFFFFFFFFFFFFFFFF, block[:, first:], radius) + 64 * first
        for lane in lanes.tolist():
            if lane < len(against) and (right is not None or lane > k):
                x, y = root(k), root(lane + shift)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((value, int(values[lane + shift])))
    return found


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 bands that cover all bits."""
    count, out, at = radius + 2, [], 0
    for k in range(count):
        width = BITS // count + (k < BITS % count)
        out.append((at, width))
        at += width
    return out


def near_pairs(values: DataFrame, fp: str, radius: int) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all that lie within ``radius`` bits."""
    def band(shift: int, width: int) -> Column:
        return F.shiftrightunsigned(F.col(fp), shift).bitwiseAND(F.lit((1 << width) - 1))

    bands = _bands(radius)
    keys = []
    for n, (x, y) in enumerate(combinations(bands, 2)):
        keys.append(F.xxhash64(F.lit(n), band(*x), band(*y)))  # two keys that share a hash are compared in vain
    filed = values.select(F.col(fp).alias("fp"), F.explode(F.array(*keys)).alias("key"))
    # A bucket's size decides its chunks; most buckets hold one fingerprint and end here.
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filed = filed.join(sizes, "key")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    chunk = F.pmod(F.xxhash64("fp", F.lit(7)), chunks).cast("int")
    filed = (filed.withColumn("chunks", chunks).withColumn("chunk", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("key", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), "chunk", "fp"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy(np.int64)
        if key[1] == key[2]:
            found = links(np.sort(values), None, radius)
        else:
            mine = rows["chunk"].to_numpy() == key[1]
            found = links(values[mine], values[~mine], radius)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return filed.groupBy("key", "c1", "c2").applyInPandas(compare, "a bigint, b bigint")


def components(docs: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` of every document.

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles of
    ``width`` words count as often as they occur (fewer words: the whole
    sequence).  A text without words, null included, has fingerprint zero and
    links like any other.  Documents whose fingerprints differ in at most
    ``radius`` bits are linked; ``component_id`` is the smallest key that links
    reach (null only where every key there is null).  Repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows.
    """
    made = stored(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), width), "fingerprints")
    unique = stored(made.groupBy("fp").agg(F.min("key").alias("least")), "fingerprint-classes")
    joined = connected_components(near_pairs(unique, "fp", radius), "a", "b")
    classes = unique.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    least = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    of_fp = classes.join(least, "c").select(F.col("fp").alias("f"), "component_id")
    return made.join(of_fp, F.col("fp") == F.col("f")).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: its smallest key.

    Rows that repeat that key keep one row, the one with the smallest text; rows
    without a key are kept (nothing tells which document they are).
    """
    found = components(docs.where(F.col(key).isNotNull()), width, radius, key, text)
    keep = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("_keep")).distinct()
    kept = docs.join(keep, F.col(key) == F.col("_keep"), "left_semi")
    first = Window.partitionBy(key).orderBy(text, F.xxhash64(*[c for c in docs.columns if c not in (key, text)] or [F.lit(0)]))
    kept = kept.withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return kept.unionByName(docs.where(F.col(key).isNull()))
