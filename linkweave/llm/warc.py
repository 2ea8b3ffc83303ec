"""WARC archives with a two-level capture index.

Pages are ordered by their reversed-host URL key (range partitions, sorted within), and every task
writes archives of one gzip member per record. The index lines of an archive, which are in key order
as well, are written next to it in compressed blocks of ``BLOCK_LINES``; the directory, a table with the
first and last key and the place of each block, is the only other thing kept. A look-up finds its block by
binary search in the directory, of which a task only gets its own part, its line by binary search in the
block, and neighbouring records by one range read. ``round_trip`` looks every page up so; ``read_archives``
reads all blocks, also by stretches.

Of pages with equal payloads the one with the largest id is written as response; the others are
revisit records that name it and keep its HTTP headers but no payload.

Files are written and read through ``pyarrow.fs`` in the shared folder, under names that hold the task
attempt; only files that the directory names are ever read, so repeated or lost attempts do no harm.

Defined results: a null or empty payload is an empty payload and equals other empty ones; rows that
repeat (same id and payload) are all responses; a null id is never referred to and is a response; a null
or malformed URL gets a key of its own and keeps its record; other columns are ignored; an empty table
gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.batches import slices, small_batches, tidy
from linkweave.sources.storage import fresh_path, materialise

BLOCK_LINES = 2000
ARCHIVE_BYTES = 64 << 20
#: Bytes that are read at once, and bytes of payload of a writing task, of which there are at most so many.
SPAN_BYTES = 8 << 20
TASK_BYTES = 256 << 20
MOST_TASKS = 1 << 16
#: Characters of a task's first and last keys that every task gets to know: at most some 16 MB.
BOUND_CHARS = 128
#: Rows of 16 bytes, some 64 as a hashed relation: at most 16 MB go to every executor.
BROADCAST_ROWS = 1 << 18
DIRECTORY_SCHEMA = "part long, first_key string, last_key string, archive string, index string, at long, size long, lines long, bytes long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_ID = "urn:page:"


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: the host reversed, so that a domain's captures are neighbours."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    key = F.when(url.isNull(), F.lit("!")).when(host == "", F.concat(F.lit("!"), url)).otherwise(key)
    return F.translate(key, "\t\n", "  ")  # they separate fields and lines of the index


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m.group()):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """One record; the payload is checked against its digest, a revisit has none."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    number = lambda name: int(x) if (x := fields.get(name, "").strip("<>").removeprefix(_ID)) else None
    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    if kind == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"payload of record {fields['warc-record-id']} does not fit its digest")
    url = fields.get("warc-target-uri")
    return {"page_id": number("warc-record-id"), "url": None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("warc-refers-to"), "payload": payload if kind == "response" else None}


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _referred(pages: DataFrame) -> tuple[DataFrame, int]:
    """(page, keeper) for pages whose payload a page with a larger id has, groups are only aggregated; and the
    bytes of all payloads."""
    hashed = materialise(pages.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")), "digests")
    total = hashed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    groups = materialise(hashed.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1"), "payloads")
    return materialise(hashed.join(groups, "sha").filter("page_id <> keeper").select(F.col("page_id").alias("page"), "keeper").distinct(), "revisits"), total


def write_archives(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, date: str = "1970-01-01T00:00:00Z", block_lines: int = BLOCK_LINES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives and index blocks; returns the directory, a table that was written as well."""
    spark = df.sparkSession
    small_batches(spark)
    folder = folder or fresh_path(spark, "warc")
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    revisits, total = _referred(pages)
    keyed = pages.join(F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits, F.col("page_id") == F.col("page"), "left")
    # a revisit's payload is not stored, but its size and digest are
    keyed = keyed.select(url_key(F.col("url")).alias("key"), "page_id", "url", "payload", "keeper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        number, size, lines, out = 0, 0, [], None

        def close() -> pa.RecordBatch:
            """Close the archive and write its index blocks."""
            out.close()
            rows, at = [], 0
            with files.open_output_stream(f"{root}/{stem}-{number}.cdx", compression=None) as index:
                for begin in range(0, len(lines), block_lines):
                    part = lines[begin : begin + block_lines]
                    block = zlib.compress("\n".join("\t".join(map(str, x)) for x in part).encode())
                    index.write(block)
                    rows.append((task.partitionId(), part[0][0], part[-1][0], f"{folder}/{stem}-{number}.warc.gz", f"{folder}/{stem}-{number}.cdx", at, len(block), len(part), part[-1][1] + part[-1][2] - part[0][1]))
                    at += len(block)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[f.split()[0] for f in DIRECTORY_SCHEMA.split(", ")])

        for batch in batches:
            for part in slices(batch, 3):
                for key, page_id, url, payload, keeper in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if out is None:
                        out, size, lines = files.open_output_stream(f"{root}/{stem}-{number}.warc.gz", compression=None), 0, []
                    gzip = zlib.compressobj(4, zlib.DEFLATED, 31)
                    member = gzip.compress(record(page_id, url, payload, keeper, date)) + gzip.flush()
                    out.write(member)
                    lines.append((key, size, len(member)))
                    size += len(member)
                    if size >= archive_bytes:
                        yield close()
                        out, number = None, number + 1
        if out is not None:
            yield close()

    ordered = keyed.repartitionByRange(_tasks(spark, total), "key", "page_id").sortWithinPartitions("key", "page_id")
    return materialise(ordered.mapInArrow(tidy(run), DIRECTORY_SCHEMA), "directory")


def _tasks(spark, size: int) -> int:
    return min(MOST_TASKS, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def _lines(files, root: str, at: int, size: int) -> list[tuple[str, int, int]]:
    """The lines (key, place, size) of an index block."""
    with files.open_input_file(root) as index:
        index.seek(at)
        lines = zlib.decompress(index.read(size)).decode().split("\n")
    return [(key, int(place), int(length)) for key, place, length in (x.split("\t") for x in lines)]


def spans(places: Iterable[tuple[int, int]], most: int = SPAN_BYTES) -> Iterator[list[tuple[int, int]]]:
    """Records (place, size) in ascending order -> stretches without a gap, of at most ``most`` bytes unless one
    record is larger."""
    held: list[tuple[int, int]] = []
    for at, size in places:
        if held and (at != sum(held[-1]) or at + size - held[0][0] > most):
            yield held
            held = []
        held.append((at, size))
    if held:
        yield held


def read_span(source, span: list[tuple[int, int]]) -> list[dict]:
    """The records of a stretch, by one range read."""
    source.seek(span[0][0])
    raw = source.read(sum(span[-1]) - span[0][0])
    return [parse(zlib.decompress(raw[at - span[0][0] : at - span[0][0] + size], 31)) for at, size in span]


def _records(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))


def _fetch(archive: str, places: Iterable[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    files, path = _open(archive)
    with files.open_input_file(path) as source:
        for span in spans(places):
            yield _records(read_span(source, span))


def read_archives(directory: DataFrame) -> DataFrame:
    """All records, block by block: an index block's records are one stretch of its archive."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, index = _open(row["index"])
                yield from _fetch(row["archive"], [x[1:] for x in _lines(files, index, row["at"], row["size"])])

    size = directory.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return directory.repartition(_tasks(directory.sparkSession, size)).mapInArrow(tidy(run), RECORD_SCHEMA)


def find_blocks(directory: list[dict], firsts: list[str], key: str) -> Iterator[dict]:
    """The blocks of a sorted directory that may hold a key, by binary search."""
    i = max(0, bisect.bisect_left(firsts, key) - 1)  # equal keys may begin in the block before
    while i < len(firsts) and firsts[i] <= key:
        if directory[i]["last_key"] >= key:
            yield directory[i]
        i += 1


def look_up(directory: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of the given URLs.

    The first and last keys of every writing task (at most ``MOST_TASKS``, each cut to ``BOUND_CHARS``) go to
    all tasks; a key finds by binary search whose archives may hold it. There it meets the task's part of the
    directory, sorted, finds its blocks by binary search, its lines in a block by binary search again, and
    neighbouring records are read together.
    """
    spark = directory.sparkSession
    keys = urls.select(url_key(F.col(url_col)).alias("key")).distinct()
    ends = directory.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
    ends = ends.select("part", F.substring("low", 1, BOUND_CHARS).alias("low"), F.substring("high", 1, BOUND_CHARS).alias("high"))
    bounds = spark.sparkContext.broadcast(sorted((r.low, r.high, r.part) for r in ends.collect()))

    def route(batches):
        lows = [x[0] for x in bounds.value]
        for batch in batches:
            part, key = [], []
            for k in batch.column(0).to_pylist():
                cut = k[:BOUND_CHARS]
                i = bisect.bisect_right(lows, cut) - 1
                while i >= 0 and bounds.value[i][1] >= cut:
                    part.append(bounds.value[i][2])
                    key.append(k)
                    i -= 1
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(key, pa.string())], names=["part", "key"])

    def search(batches):
        part, own, firsts, block, lines, places = None, [], [], None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, own, firsts = row["part"], [], []
                if row["asked"] is None:
                    own.append(row)
                    firsts.append(row["first_key"])
                    continue
                key = row["asked"]
                for found in find_blocks(own, firsts, key):
                    if block is None or (found["index"], found["at"]) != (block["index"], block["at"]):
                        if block is not None:
                            yield from _fetch(block["archive"], places)
                        files, index = _open(found["index"])
                        block, lines, places = found, _lines(files, index, found["at"], found["size"]), []
                    a = bisect.bisect_left(lines, key, key=lambda x: x[0])
                    b = bisect.bisect_right(lines, key, key=lambda x: x[0])
                    places += [x[1:] for x in lines[a:b]]
        if block is not None:
            yield from _fetch(block["archive"], places)

    routed = keys.mapInArrow(tidy(route), "part long, key string")
    asked = routed.select("part", F.col("key").alias("asked"), F.col("key").alias("order"), *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in DIRECTORY_SCHEMA.split(", ")) if c != "part"])
    rows = directory.withColumns({"asked": F.lit(None).cast("string"), "order": F.col("first_key")}).unionByName(asked)
    size = directory.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    sorted_rows = rows.repartition(_tasks(spark, size), "part").sortWithinPartitions("part", F.col("asked").isNotNull(), "order", "archive", "at")
    return sorted_rows.mapInArrow(tidy(search), RECORD_SCHEMA)


def round_trip(df: DataFrame) -> DataFrame:
    """Write the pages, look every page's URL up in the archives: one row per page."""
    return look_up(write_archives(df), df.select(F.col("url"))).drop("payload", "url")
