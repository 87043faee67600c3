"""WARC archives and a two-level capture index (operator 5).

Records are dealt by ranges of their reversed-host URL keys (``com,example)/path``), so each partition writes one archive
whose keys follow on those of the one before. Beside each archive stands its index: the sorted capture lines in compressed
blocks, and a sparse directory with the first key and place of each block. A top table has one row per archive, so as many rows
as there are partitions; it is all that is sent to every executor.

Reading goes by keys: the archive of a key is found by binary search of the top table, its first block by binary search of that
archive's directory, its capture lines by two binary searches of the block, and its records by range reads. Keys are looked up
in bulk (``read``): a row per key and block is dealt by block, so the captures of a hot key are read by many tasks.

Of records with equal payloads of at least ``min_bytes``, the one of smallest page id (nulls last, then of smallest URL) is a
response and the others are revisits that refer to it; every other record is a response. A revisit's payload size and digest
are read from the response it refers to.

Records are the same bytes however often they are written: their ids are made of page id, URL, digest and a number among equal
rows, their date is a parameter. Files are named by attempt, and the top table, which Spark commits once per partition, tells
whose files count; so tasks may be repeated or run twice at once. The folder is reached by ``pyarrow.fs`` (local, HDFS, S3, GCS);
it must be shared.

Defined results: a null payload is empty; null URLs have the empty key and null ids an empty record id, and are read back as
nulls. Repeated rows and ids are records of their own (the revisits among them refer to the response's id). Very long
payloads are kept whole. An empty table gives an empty archive. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Capture lines in an index block.
BLOCK = 512
LEVEL = 1
#: Bytes that one range read of neighbouring records fetches at most; one longer record is read alone.
READ = 4 << 20
#: Characters to which the bounds of an archive are cut in the top table.
BOUND = 256
#: The date of records where none is given: archives are reproducible.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """``http://www.Example.com:8080/a?b`` as ``com,example,www:8080)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, digest: str, nth: int = 0) -> str:
    """The id of the ``nth`` of equal rows."""
    own = hashlib.sha1(f"{'-' if url is None else '+' + url}\n{digest}".encode()).hexdigest()[:24]
    return f"<urn:page:{_text(page_id)}:{own}:{nth}>"


def record(row: dict, payload: bytes, nth: int = 0, date: str = DATE) -> bytes:
    """One WARC record as a gzip member."""
    response = row["kind"] == "response"
    head = {"WARC-Type": row["kind"], "WARC-Record-ID": record_id(row["page_id"], row["url"], row["digest"], nth), "WARC-Date": date}
    if row["url"] is not None:
        head["WARC-Target-URI"] = _line(row["url"])
    head["WARC-Payload-Digest"] = f"sha1:{row['digest']}"
    if not response:
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = record_id(row["first_id"], row["first_url"], row["digest"])
        if row["first_url"] is not None:
            head["WARC-Refers-To-Target-URI"] = _line(row["first_url"])
        head["WARC-Refers-To-Date"] = date
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if response else b"")
    head["Content-Type"] = "application/http; msgtype=response"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _text(value) -> str:
    return "" if value is None else str(value)


def _number(text: str) -> int | None:
    return int(text) if text else None


def parse(member: bytes) -> dict:
    """A record's headers and payload, from its gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers | {"payload": block.partition(b"\r\n\r\n")[2]}


class Folder:
    """Files of one archive, written whole and read by ranges."""

    def __init__(self, uri: str):
        self.fs, self.path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))

    def write(self, name: str, chunks) -> None:
        self.fs.create_dir(self.path, recursive=True)
        part = f"{self.path}/.{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part, compression=None) as out:
            for x in chunks:
                out.write(x)
        self.fs.move(part, f"{self.path}/{name}")

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.path}/{name}")


def _with_keys(batch: pa.RecordBatch, column: int = 1) -> pa.Array:
    return pa.array([url_key(u) for u in batch.column(column).to_pylist()], pa.string())


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, key, html, size, digest, kind, first_id and first_url (of the response of equal payloads) of every row. Rows
    that repeat a response are responses here."""

    def run(batches):
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(2))
            digests = [payload_digest(data[a:b].tobytes()) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, _with_keys(batch), pa.array(np.diff(offsets)), pa.array(digests, pa.string())], ["page_id", "url", "html", "key", "size", "digest"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(run, "page_id bigint, url string, html string, key string, size bigint, digest string")
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", F.col("url").isNull().alias("m"), "url")
    first = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    first = first.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("shared"))
    first = common.materialise(first, "copies")  # so that both sides of the join are plain exchanges, whose hot keys can be split
    out = rows.join(first, "digest", "left")
    revisit = F.col("shared") & ~(F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")))
    out = out.withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
    return out.select("page_id", "url", "key", "html", "size", "digest", "kind", "first_id", "first_url", F.coalesce("shared", F.lit(False)).alias("shared"))


def write(pages: DataFrame, uri: str, min_bytes: int = 0, date: str = DATE, block: int = BLOCK) -> DataFrame:
    """Writes archives and their index under ``uri``; returns the top table, a row per archive: first_key, last_key (cut to ``BOUND``
    characters, the last one then raised), archive, blocks, records."""
    parts = common.partitions(pages.sparkSession)
    order = ["key", "salt", "page_id", "url", "digest"]
    rows = classify(pages, min_bytes).withColumn("salt", F.xxhash64("page_id", "url", "digest"))  # equal rows come together
    rows = rows.repartitionByRange(parts, "key", "salt").sortWithinPartitions(*order).drop("salt")

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        folder, place, before, nth = Folder(uri), 0, None, 0
        blocks: list[tuple[str, str, bytes, int]] = []
        lines: list[tuple[str, str]] = []

        def close():
            if lines:
                packed = zlib.compress("\n".join(f"{json.dumps(k)}\t{x}" for k, x in lines).encode(), LEVEL)
                blocks.append((lines[0][0], lines[-1][0], packed, len(lines)))
                lines.clear()

        def members():
            nonlocal place, before, nth
            for batch in batches:
                data, offsets = common.text_bytes(batch.column(3))
                meta = batch.select(["page_id", "url", "key", "digest", "kind", "first_id", "first_url", "shared"]).to_pylist()
                for row, a, b in zip(meta, offsets.tolist(), offsets[1:].tolist()):
                    now = row["page_id"], row["url"], row["digest"]
                    nth = nth + 1 if now == before else 0
                    if nth and row["shared"]:  # a repeated row visits the first of its kind again
                        row["kind"] = "revisit"
                    before = now
                    member = record(row, data[a:b].tobytes(), nth, date)
                    lines.append((row["key"], json.dumps([place, len(member)])))
                    place += len(member)
                    if len(lines) == block:
                        close()
                    yield member
            close()

        folder.write(f"{name}.warc.gz", members())
        folder.write(f"{name}.cdx", [packed for _, _, packed, _ in blocks])
        starts = np.cumsum([0, *(len(packed) for _, _, packed, _ in blocks)]).tolist()
        sparse = "\n".join(json.dumps([first, last, start, len(packed)]) for (first, last, packed, _), start in zip(blocks, starts))
        folder.write(f"{name}.dir", [zlib.compress(sparse.encode(), LEVEL)])
        if blocks:
            first, last = blocks[0][0][:BOUND], blocks[-1][1]
            last = last if len(last) <= BOUND else last[:BOUND] + chr(0x10FFFF)
            row = [first, last, name, len(blocks), sum(n for _, _, _, n in blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["first_key", "last_key", "archive", "blocks", "records"])

    return common.materialise(rows.mapInArrow(run, "first_key string, last_key string, archive string, blocks bigint, records bigint"), "archives")


def read_directory(folder: Folder, archive: str) -> list[list]:
    """The sparse directory of an archive: first key, last key, start and length of each index block."""
    with folder.open(f"{archive}.dir") as file:
        text = zlib.decompress(file.read()).decode()
    return [json.loads(x) for x in text.split("\n")] if text else []


def read_lines(folder: Folder, archive: str, start: int, length: int) -> tuple[list[str], list[list[int]]]:
    """Keys and places (start and length of the record) of an index block."""
    with folder.open(f"{archive}.cdx") as file:
        file.seek(start)
        lines = zlib.decompress(file.read(length)).decode().split("\n")
    pairs = [line.split("\t", 1) for line in lines]
    return [json.loads(k) for k, _ in pairs], [json.loads(x) for _, x in pairs]


def _spans(ranges: list, key: str):
    """The ranges (first key, last key, ...) of a sorted list that may hold a key: found by bisection, ends included."""
    at = bisect_left(ranges, key, key=lambda r: r[1])
    while at < len(ranges) and ranges[at][0] <= key:
        yield ranges[at]
        at += 1


def find_blocks(archives: list[tuple], folder: Folder, keys):
    """(key, archive, start, length) of the index blocks that hold each of some keys; keys in order open each directory once."""
    opened: tuple[str, list] = ("", [])
    for key in keys:
        for _, _, archive in _spans(archives, key):
            if opened[0] != archive:
                opened = archive, read_directory(folder, archive)
            for _, _, start, length in _spans(opened[1], key):
                yield key, archive, start, length


def read_captures(folder: Folder, archive: str, start: int, length: int, keys):
    """The records of some keys in one block: two bisections for each key, range reads of at most ``READ`` bytes or one record."""
    found, places = read_lines(folder, archive, start, length)
    wanted = sorted({i for key in keys for i in range(bisect_left(found, key), bisect_right(found, key))})
    with folder.open(f"{archive}.warc.gz") as file:
        while wanted:
            a, size = places[wanted[0]]
            n = 1
            while n < len(wanted) and places[wanted[n]][0] == a + size and size + places[wanted[n]][1] <= READ:
                size += places[wanted[n]][1]
                n += 1
            file.seek(a)
            data = file.read(size)
            for i in wanted[:n]:
                at, own = places[i]
                yield parse(data[at - a : at - a + own])
            wanted = wanted[n:]


def top_table(archives: DataFrame) -> list[tuple]:
    """first_key, last_key and archive of each archive, in order: a row per partition that wrote."""
    return sorted((r.first_key, r.last_key, r.archive) for r in archives.select("first_key", "last_key", "archive").collect())


def look_up(uri: str, archives: list[tuple], url: str) -> list[dict]:
    """The captures of one URL; ``archives`` as ``top_table`` gives them."""
    folder = Folder(uri)
    found = (r for _, archive, start, length in find_blocks(archives, folder, [url_key(url)]) for r in read_captures(folder, archive, start, length, [url_key(url)]))
    return [r for r in found if r.get("WARC-Target-URI") == _line(url)]


def read(archives: DataFrame, uri: str, keys: DataFrame) -> DataFrame:
    """The captures of many keys (a column ``key``, without repeats): page_id, payload_bytes, payload_digest, record_type,
    refers_to, record_id, refers_id; payload_bytes is null for revisits."""
    spark = archives.sparkSession
    parts = common.partitions(spark)
    top = spark.sparkContext.broadcast(top_table(archives))

    def locate(batches):
        folder = Folder(uri)
        for batch in batches:
            found = [*zip(*find_blocks(top.value, folder, batch.column(0).to_pylist()))] or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["key", "archive", "start", "length"])

    def fetch(batches):
        folder = Folder(uri)
        now, own = None, []

        def rows():
            out = []
            for r in read_captures(folder, *now, own):
                digest, response = r["WARC-Payload-Digest"].removeprefix("sha1:"), r["WARC-Type"] == "response"
                if response and payload_digest(r["payload"]) != digest:
                    raise ValueError(f"{now}: the payload of {r['WARC-Record-ID']} differs from its digest")
                refers = r.get("WARC-Refers-To")
                out.append((_page(r["WARC-Record-ID"]), len(r["payload"]) if response else None, digest, r["WARC-Type"], _page(refers), r["WARC-Record-ID"], refers))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "refers_id"])

        for batch in batches:
            for key, *place in zip(*(c.to_pylist() for c in batch.columns)):
                if place != now:
                    if own:
                        yield rows()
                    now, own = place, []
                own.append(key)
        if own:
            yield rows()

    # keys in order, so that a task opens few directories; then blocks, so that a hot key is read by many tasks
    places = keys.select("key").repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(locate, "key string, archive string, start bigint, length bigint")
    places = places.repartition(parts, "archive", "start").sortWithinPartitions("archive", "start", "key")
    return places.mapInArrow(fetch, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, refers_id string")


def _page(record: str | None) -> int | None:
    """The page id in a record id."""
    return _number(record[10:-1].split(":")[0]) if record else None


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with the payload size and digest of revisits taken from the responses they refer to; a revisit whose response is not
    there, or has another digest, raises an error."""
    captures = common.materialise(captures, "captures")
    wanted = captures.where("refers_id is not null").select("refers_id").distinct()
    targets = captures.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"))
    targets = common.materialise(targets.join(wanted, "refers_id", "left_semi"), "targets")  # plain exchanges again: hot responses can be split
    both = captures.join(targets, "refers_id", "left")
    revisit = F.col("record_type") == "revisit"
    digest = F.when(~revisit, F.col("payload_digest")).when(F.col("d") == F.col("payload_digest"), F.col("d")).otherwise(F.raise_error(F.concat(F.lit("no such payload: "), "record_id")))
    return both.select("page_id", F.when(revisit, F.col("n")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def distinct_keys(pages: DataFrame) -> DataFrame:
    """The keys of the URLs of a table, without repeats."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sorted({url_key(u) for u in batch.column(0).to_pylist()}), pa.string())], ["key"])

    return pages.select("url").mapInArrow(run, "key string").distinct()


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes all pages, and reads the captures of all their URLs back through the index."""
    uri = common.fresh_path(pages.sparkSession, "warc")
    archives = write(pages, uri, min_bytes)
    return resolved(read(archives, uri, distinct_keys(pages)))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h FROM p),
b AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(g * 5 + 1 AS INT), 5) AS INT) >> s) & 31 AS INT) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM d
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
