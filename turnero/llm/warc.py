"""WARC archives with a two-level capture index.

Writing: every page is one record.  Records are dealt to archives of bounded
size and written through Spark's text writer as gzip files, so any file system
it knows will do; a record's place in the text of its archive is the running sum
of the lengths before it.  Of records
with the same payload one carries it (``response``), the others point to it
(``revisit``) with the HTTP header of their own.

Index: one line per capture, keyed by the URL with its host reversed and sorted
by key.  Lines form blocks that are stored compressed; a sparse directory holds
each block's first key.  A look-up searches the directory by bisection, opens
the one block that can hold the key, bisects in it, and reads the record's byte
range from its archive.  An archive moves to its ranges as it lies there,
compressed, and is opened in the task that cuts it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored
from turnero.session import shared_dir

#: Bytes of records, before compression, aimed at for one archive; a larger record has a larger archive.
ARCHIVE_BYTES = 4 << 20
#: Lines of an index block, and blocks of the directory: the larger table has longer blocks.
LINES, BLOCKS = 256, 65_536
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: five hexadecimal digits are four base32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def host_key(url: Column) -> Column:
    """Sort key of a URL: host reversed by label, then port, path and query, all but the path in lower case."""
    rest = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?", "")
    host = F.lower(F.regexp_extract(rest, "^([^/:?#]*)", 1))
    tail = F.regexp_replace(rest, "^[^/:?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), tail)


@dataclass
class Archives:
    """Where the archives and their index lie."""

    folder: str
    blocks: str
    archives: int


def write(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, lines: int = LINES) -> Archives:
    """Write ``pages`` (``page_id, url, html``) as archives and build their index.

    Null html is an empty payload, a null url an empty one.  A record is a
    revisit if another with an equal payload of at least ``least_bytes`` has a
    smaller page id (null ids count as larger than any); repeated rows with the
    smallest id are responses all.  An empty table gives no archives.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", base32_sha1(F.col("body").cast("binary"))).withColumn("size", F.octet_length("body").cast("bigint"))
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "url", "digest").cast("binary"))
    rows = rows.withColumn("name", name)
    facts = stored(rows.drop("body"), "warc-facts")
    owners = stored(facts.groupBy("digest", "size").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n")), "warc-owners")
    repeats = owners.where((F.col("n") > 1) & (F.col("size") >= least_bytes)).select(F.col("digest").alias("d"), F.col("size").alias("z"), "owner")
    totals = owners.agg(F.sum(F.col("size") + 500 * F.col("n")), F.sum("n")).first()
    archives = max(1, -(-(totals[0] or 0) // archive_bytes))
    archive = F.pmod(F.xxhash64("name"), F.lit(archives)).cast("int")
    # Decisions are made without the texts, which are moved once: to their archive, behind their decision.
    facts = facts.join(repeats, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("z")), "left")
    facts = facts.withColumn("revisit", F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))).withColumn("archive", archive)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    length = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    one_line = F.regexp_replace("url", "[\\r\\n]", "%0A")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:md5:"), F.col("name"), F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "), one_line,
        F.lit("\r\nWARC-Page-ID: "), page, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("revisit"), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To-Page-ID: "),
            F.col("owner").cast("string"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length, F.lit(END), http)
    heads = stored(facts.select("page_id", host_key(one_line).alias("url_key"), "name", "archive", "revisit", head.alias("head"),
                                (F.octet_length(head) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))).cast("bigint").alias("length")), "warc-heads")
    order = Window.partitionBy("archive").orderBy("page_id", "name")  # one archive, of bounded size
    placed = heads.select("url_key", "page_id", "name", "archive", "length").withColumn(
        "offset", F.coalesce(F.sum(F.col("length") + len(END)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    folder = shared_dir(spark, "warc")
    # In an archive every text stands before its head; repeated rows have as many equal texts as heads.
    keyed = [heads.select("archive", "page_id", "name", F.lit(0).alias("kind"), F.col("head").alias("value"), "revisit"),
             rows.select(archive.alias("archive"), "page_id", "name", F.lit(1).alias("kind"), F.col("body").alias("value"), F.lit(False).alias("revisit"))]
    both = keyed[0].unionByName(keyed[1]).repartition(max(1, min(archives, 4096)), "archive")
    pairs = Window.partitionBy("archive").orderBy("page_id", "name", F.col("kind").desc())
    text = F.last(F.when(F.col("kind") == 1, F.col("value")), ignorenulls=True).over(pairs.rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("body", text).where("kind = 0")
    value = F.when(F.col("revisit"), F.col("value")).otherwise(F.concat("value", F.col("body")))
    both.select("archive", value.alias("value")).write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(folder)
    blocks = index(placed, totals[1] or 0, lines)
    return Archives(folder, blocks, archives)


def line_key(url_key: str, page: int | None, name: str) -> str:
    """Sort key of an index line; unique but for repeated rows."""
    return f"{url_key} {'' if page is None else page} {name}"


def index(captures: DataFrame, rows: int, lines: int = LINES) -> str:
    """Write the compressed blocks of a capture index; returns their folder."""
    lines = max(lines, -(-rows // (BLOCKS // 2)))
    spark = captures.sparkSession

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, int, int, int]] = []

        def block() -> pd.DataFrame:
            data = zlib.compress(json.dumps(held, ensure_ascii=False).encode("utf-8", "surrogatepass"))
            return pd.DataFrame({"first_key": [held[0][0]], "last_key": [held[-1][0]], "n_lines": [len(held)], "data": [data]})

        for batch in batches:
            for key, archive, offset, length in zip(batch["key"], batch["archive"], batch["offset"], batch["length"]):
                held.append((key, int(archive), int(offset), int(length)))
                if len(held) == lines:
                    yield block()
                    held = []
        if held:
            yield block()

    keyed = captures.select(F.concat_ws(" ", "url_key", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "name").alias("key"), "archive", "offset", "length")
    parts = max(1, min(BLOCKS // 2, -(-rows // (lines * 8))))
    blocks = keyed.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInPandas(
        pack, "first_key string, last_key string, n_lines bigint, data binary")
    folder = shared_dir(spark, "warc-index")
    blocks.write.parquet(folder)
    return folder


def directory(spark: SparkSession, archives: Archives) -> list[str]:
    """First keys of all blocks in order: at most BLOCKS of them."""
    return [r[0] for r in spark.read.parquet(archives.blocks).select("first_key").orderBy("first_key").collect()]


def locate(keys: DataFrame, archives: Archives) -> DataFrame:
    """``keys`` (column ``key``) with ``archive, offset, length`` of every capture that has the key; others go.

    The directory is broadcast (bounded by BLOCKS); each key meets one block,
    and only the blocks that are asked for are opened.
    """
    spark = keys.sparkSession
    first = spark.sparkContext.broadcast(directory(spark, archives))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts = first.value
        for batch in batches:
            # Repeated rows may spread one key over blocks: the earliest block whose end can hold it, and those that begin with it.
            spans = [(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k)) for k in batch["key"]]
            pairs = [(firsts[b], k) for k, (low, high) in zip(batch["key"], spans) for b in range(low, high)]
            yield pd.DataFrame(pairs, columns=["first_key", "key"], dtype="object")

    wanted = keys.select("key").distinct().mapInPandas(search, "first_key string, key string")
    per_block = wanted.groupBy("first_key").agg(F.collect_set("key").alias("keys"))  # at most the lines of a block, or keys it lacks
    blocks = spark.read.parquet(archives.blocks).select("first_key", "data")
    opened = blocks.join(per_block, "first_key")

    def open_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for data, asked in zip(batch["data"], batch["keys"]):
                rows = json.loads(zlib.decompress(data).decode("utf-8", "surrogatepass"))
                sorted_keys = [r[0] for r in rows]
                for key in asked:
                    for k in range(bisect_left(sorted_keys, key), bisect_right(sorted_keys, key)):
                        found.append(tuple(rows[k]))
            yield pd.DataFrame(found, columns=["key", "archive", "offset", "length"])

    return opened.mapInPandas(open_block, "key string, archive int, offset bigint, length bigint")


def parse(record: bytes) -> dict:
    """Header fields and payload facts of one record; the payload digest is computed anew."""
    head, _, rest = record.partition(END.encode())
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(END.encode())
    declared = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit:
        actual = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if actual != digest or len(payload) != declared:
            raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload it declares")
    page, owner = fields.get("WARC-Page-ID", ""), fields.get("WARC-Refers-To-Page-ID", "")
    return {"page_id": int(page) if page else None, "url": fields.get("WARC-Target-URI", ""), "payload_bytes": declared, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": int(owner) if owner else None,
            "html": None if revisit else payload.decode("utf-8")}


def read(spans: DataFrame, archives: Archives, payload: bool = False) -> DataFrame:
    """The records of byte ranges ``archive, offset, length``, parsed; with ``payload`` the text of responses too.

    Ranges of one archive are read together from its bytes (an archive is bounded).
    """
    spark = spans.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archives.folder).select(
        F.regexp_extract("path", "/archive=([0-9]+)/", 1).cast("int").alias("archive"), "content")
    grouped = spans.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for packed, wanted in zip(batch["content"], batch["spans"]):
                content = gzip.decompress(packed)
                rows = [parse(content[x["offset"]:x["offset"] + x["length"]]) for x in wanted]
                made = pd.DataFrame(rows, columns=names)
                for column in ("page_id", "refers_to", "payload_bytes"):
                    made[column] = made[column].astype("Int64")
                yield made

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["html"] * payload
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + (", html string" if payload else "")
    joined = files.join(grouped, "archive").select("content", "spans")
    return joined.mapInPandas(cut, schema)


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, look every capture up in the index, and read it back.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    """
    archives = write(pages, least_bytes)
    keys = pages.sparkSession.read.parquet(archives.blocks)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                yield pd.DataFrame({"key": [r[0] for r in json.loads(zlib.decompress(data).decode("utf-8", "surrogatepass"))]})

    spans = locate(keys.select("data").mapInPandas(listed, "key string"), archives)
    return read(spans, archives).drop("url")
