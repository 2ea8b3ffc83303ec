"""Packs of whole documents, and exchanges between them of compact sorted arrays.

Several operators have to compare every position of every text with every other. A row per position
would make the shuffle many times larger than the texts. Here the documents are first packed into
chunks (a few MB of text, compressed; longer texts in overlapping pieces); each chunk then sends every bucket of the hash space one small
blob, and a bucket answers each chunk with one blob. What a chunk sends is distinct within the chunk,
so a passage with a million copies costs one entry per chunk, never one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.batches import release, small_batches, tidy
from linkweave.sources.storage import materialise

PACK_SCHEMA = "chunk long, n_bytes long, blob binary"
MAIL_SCHEMA = "bucket long, chunk long, blob binary"
PACK_BYTES = 3 << 20
CHUNKS_PER_BUCKET = 8


Cut = Callable[[pa.Buffer, int], Iterator[tuple[bytes, int]]]


def pack(df: DataFrame, key: str, text: str, pack_bytes: int = PACK_BYTES, cut: Cut | None = None) -> DataFrame:
    """Chunks of documents as compressed Arrow streams.

    Null texts stay null. A document larger than ``pack_bytes`` is cut into pieces by ``cut``, which yields each
    piece and how many of its bytes it owns; without it the document is a chunk of its own. The packs are
    made anew wherever they are read, which costs less than keeping a copy of the corpus; so that
    every reading, also one after an executor was lost, meets the same chunks, rows must come straight
    from a scan. Rows in an order that a shuffle left open are first written to the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = batches if cut is None else _pieces(batches, pack_bytes, cut)
        for chunk, size, table in _chunks(rows, pack_bytes):
            row = {"chunk": [chunk], "n_bytes": [size], "blob": [to_blob(table)]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("blob", pa.binary())]))

    return _scanned(df, key, text).mapInArrow(tidy(run), PACK_SCHEMA)


def _scanned(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text) in an order that every reading meets again."""
    small_batches(df.sparkSession)
    slim = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        slim = materialise(slim, "rows", "zstd")
    return slim


def _pieces(batches: Iterator[pa.RecordBatch], pack_bytes: int, cut: Cut) -> Iterator[pa.RecordBatch]:
    """id and text with the row's number, the piece's number (-1: a whole text) and the bytes it owns."""
    row = TaskContext.get().partitionId() << 32

    def rows(ids, texts, first, count, parts, own):
        numbers = pa.array(np.arange(first, first + count) if count > 1 else np.full(count, first), pa.int64())
        return pa.RecordBatch.from_arrays([ids, texts, numbers, pa.array(parts, pa.int32()), pa.array(own, pa.int64())], names=["id", "text", "row", "part", "own"])

    for batch in batches:
        ids, texts, count = batch.column(0), batch.column(1), batch.num_rows
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        whole = rows(ids, texts, row, count, np.full(count, -1), lengths)
        at = 0
        for i in np.flatnonzero(lengths > pack_bytes).tolist():
            if i > at:
                yield whole.slice(at, i - at)
            for part, (piece, own) in enumerate(cut(texts[i].as_buffer(), pack_bytes)):
                yield rows(ids.slice(i, 1), pa.array([piece], pa.binary()), row + i, 1, [part], [own])
            at = i + 1
        if at < count:
            yield whole.slice(at)
        row += count


def _chunks(batches: Iterator[pa.RecordBatch], pack_bytes: int) -> Iterator[tuple[int, int, pa.Table]]:
    """(chunk, bytes of text, rows)."""
    base = TaskContext.get().partitionId() << 32
    number = 0
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> tuple[int, int, pa.Table]:
        nonlocal number, held, size
        out = base + number, size, pa.Table.from_batches(held).combine_chunks()
        number, held, size = number + 1, [], 0
        return out

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = 0
        while begin < len(lengths):
            room = np.cumsum(lengths[begin:])
            count = max(1 if not held else 0, int(np.searchsorted(room, pack_bytes - size, "right")))
            if count:
                held.append(batch.slice(begin, count))
                size += int(room[count - 1])
                begin += count
            if begin < len(lengths) or size >= pack_bytes:
                yield flush()
    if held:
        yield flush()


def to_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


class Texts:
    """One chunk: ``ids`` and the bytes of all texts with their offsets (null texts are empty)."""

    def __init__(self, rows: bytes | pa.Table):
        table = rows if isinstance(rows, pa.Table) else pa.ipc.open_stream(rows).read_all().combine_chunks()
        column = table.column(1)
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.binary())
        self.null = column.is_null().to_numpy(zero_copy_only=False)
        column = pc.fill_null(column, b"")
        buffers = column.buffers()
        self.offsets = np.frombuffer(buffers[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        self.data = data[self.offsets[0] : self.offsets[-1]]
        self.offsets = self.offsets - self.offsets[0]
        ids = table.column(0)
        self.no_id = ids.is_null().to_numpy()
        self.ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        #: number of the row, of the piece (-1: a whole text), and bytes that the piece owns
        cut = table.num_columns > 2
        self.row, self.part, self.own = (table.column(i).to_numpy() for i in (2, 3, 4)) if cut else (np.zeros(len(self.ids), np.int64), np.full(len(self.ids), -1, np.int32), np.diff(self.offsets))

    def __len__(self) -> int:
        return len(self.ids)

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.no_id)


_LEVEL = 1


def squeeze(values: np.ndarray) -> bytes:
    """Ascending unsigned integers: differences, byte planes, zstd."""
    if not len(values):
        return b""
    step = values.copy()
    step[1:] -= values[:-1]
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=_LEVEL).compress(planes.tobytes())


def expand(blob: bytes, kind=np.uint64) -> np.ndarray:
    if not blob:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    step = np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(step, dtype=kind)


def planes(values: np.ndarray) -> bytes:
    """Any fixed-width integers: byte planes, zstd."""
    if not len(values):
        return b""
    return zstandard.ZstdCompressor(level=_LEVEL).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def unplanes(blob: bytes, kind) -> np.ndarray:
    if not blob:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def join_blobs(parts: list[bytes]) -> bytes:
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return head + b"".join(parts)


def split_blobs(blob: bytes) -> list[bytes]:
    count = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, count, 8)
    out, at = [], 8 + 8 * count
    for size in sizes:
        out.append(bytes(blob[at : at + size]))
        at += int(size)
    return out


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending 64-bit keys; a bucket is a range of the key space."""
    width = (1 << 64) // buckets
    return np.searchsorted(keys, np.array([i * width for i in range(1, buckets)], np.uint64)).tolist()


def send(packs: DataFrame, emit: Callable[[int, Texts], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Each chunk's blobs for the buckets."""

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob"), strict=True):
                rows = list(emit(chunk, Texts(blob.as_py())))
                yield mail([b for b, _ in rows], [chunk] * len(rows), [x for _, x in rows])

    return packs.select("chunk", "blob").mapInArrow(tidy(run), MAIL_SCHEMA)


def send_packed(df: DataFrame, key: str, text: str, pack_bytes: int, emit: Callable[[int, Texts], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``send`` for texts that are read only once: no packs are made."""

    def run(batches):
        for chunk, _, table in _chunks(batches, pack_bytes):
            rows = list(emit(chunk, Texts(table)))
            yield mail([b for b, _ in rows], [chunk] * len(rows), [x for _, x in rows])

    return _scanned(df, key, text).mapInArrow(tidy(run), MAIL_SCHEMA)


def mail(buckets, chunks, blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(chunks, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "chunk", "blob"])


def answer(sent: DataFrame, reply: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Every bucket answers the chunks that wrote to it."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rows = list(reply(table.column("chunk").to_pylist(), table.column("blob").to_pylist()))
        out = pa.Table.from_batches([mail([bucket] * len(rows), [c for c, _ in rows], [x for _, x in rows])])
        release()
        return out

    return sent.groupBy("bucket").applyInArrow(run, MAIL_SCHEMA)


def send_after(packs: DataFrame, replies: DataFrame, emit: Callable[[Texts, list[tuple[int, bytes]]], list[tuple[int, bytes]]]) -> DataFrame:
    """A further round: each chunk's blobs for the buckets, made from the answers it got."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = list(zip(right.column("bucket").to_pylist(), right.column("blob").to_pylist(), strict=True))
        out = [mail([], [], [])]
        for chunk, blob in zip(left.column("chunk").to_pylist(), left.column("blob"), strict=True):
            rows = emit(Texts(blob.as_py()), answers)
            out.append(mail([b for b, _ in rows], [chunk] * len(rows), [x for _, x in rows]))
        release()
        return pa.Table.from_batches(out)

    return packs.select("chunk", "blob").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, MAIL_SCHEMA)


def meet(packs: DataFrame, replies: DataFrame, work: Callable[[Texts, list[tuple[int, bytes]]], pa.Table], schema: str) -> DataFrame:
    """Each chunk together with the answers, as pairs of bucket and blob, that it got."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = list(zip(right.column("bucket").to_pylist(), right.column("blob").to_pylist(), strict=True))
        tables = [work(Texts(blob.as_py()), answers) for blob in left.column("blob")]
        release()
        return pa.concat_tables(tables) if tables else empty

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    empty = to_arrow_schema(_parse_datatype_string(schema)).empty_table()
    return packs.select("chunk", "blob").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def collect(replies: DataFrame, work: Callable[[list[tuple[int, bytes]]], pa.Table], schema: str) -> DataFrame:
    """All answers, as pairs of bucket and blob, that a chunk got."""

    def run(table: pa.Table) -> pa.Table:
        out = work(list(zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist(), strict=True)))
        release()
        return out

    return replies.groupBy("chunk").applyInArrow(run, schema)


PIECE_SCHEMA = "row long, part int, n_own long, body binary, gone binary"


def piece_columns(texts: Texts, own: dict[int, tuple[int, bytes, np.ndarray]]) -> dict[str, pa.Array]:
    """Columns of ``PIECE_SCHEMA``, null for whole texts; ``own`` names, by text, the number of units that a piece
    owns, their bytes, and the marks of removed units, those after its own included."""
    kept = [own.get(i) for i in range(len(texts))]
    is_piece = texts.part >= 0
    return {
        "row": pa.array(texts.row, pa.int64(), mask=~is_piece),
        "part": pa.array(texts.part, pa.int32(), mask=~is_piece),
        "n_own": pa.array([x and x[0] for x in kept], pa.int64()),
        "body": pa.array([x and x[1] for x in kept], pa.binary()),
        "gone": pa.array([x and planes(x[2].astype(np.uint8)) for x in kept], pa.binary()),
    }


def assemble(found: DataFrame, fold: Callable[[], object], schema: str) -> DataFrame:
    """Rows of whole texts as they are, and one row for each text in pieces.

    Its pieces come in their order to one task, which holds one at a time. ``fold()`` has ``add(body, gone)``
    for the units of a piece and ``row()`` for the result's columns. What a piece removes beyond its own units
    counts for the pieces after it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    shape = to_arrow_schema(_parse_datatype_string(schema))
    found = materialise(found, "pieces", "zstd")

    def run(batches):
        row, key, state, carry = None, None, None, np.zeros(0, bool)

        def done():
            return pa.RecordBatch.from_pylist([{"doc_id": key, **state.row()}], schema=shape)

        for batch in batches:
            names = ("doc_id", "row", "n_own", "body", "gone")
            for doc_id, number, n_own, body, gone in zip(*(batch.column(c) for c in names), strict=True):
                if number.as_py() != row:
                    if state is not None:
                        yield done()
                    row, key, state, carry = number.as_py(), doc_id.as_py(), fold(), np.zeros(0, bool)
                own = n_own.as_py()
                marks = unplanes(gone.as_py(), np.uint8).astype(bool)
                if len(carry) > len(marks):
                    marks, carry = carry, marks
                marks[: len(carry)] |= carry
                state.add(body.as_py(), marks[:own])
                carry = marks[own:].copy()
        if state is not None:
            yield done()

    whole = found.filter("part is null").select(shape.names)
    parts = found.filter("part is not null").repartition("row").sortWithinPartitions("row", "part")
    return whole.unionByName(parts.mapInArrow(tidy(run), schema))


def plan(df: DataFrame, text: str, pack_bytes: int | None = None) -> tuple[int, int]:
    """(bytes of text in a pack, number of buckets) for an input."""
    return plan_pieces(df, text, pack_bytes)[:2]


def plan_pieces(df: DataFrame, text: str, pack_bytes: int | None = None) -> tuple[int, int, bool]:
    """(bytes of text in a pack, number of buckets, whether a text is longer than a pack) for an input.

    Chunks times buckets is the number of blobs, so both sizes grow with the input, from ``PACK_BYTES``
    to what an executor holds: a chunk takes some hundred times its size while it is worked on. A bucket
    serves ``CHUNKS_PER_BUCKET`` chunks' worth of text. Tests give ``pack_bytes``.
    """
    size, longest = (x or 0 for x in df.agg(F.sum(F.octet_length(text)), F.max(F.octet_length(text))).first())
    if pack_bytes is None:
        memory = df.sparkSession.sparkContext.getConf().get("spark.executor.memory", "1g").lower()
        units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
        unit = units.get(memory.rstrip("b")[-1:], 1)
        most = int(float(memory.rstrip("bkmgt"))) * unit // 600
        pack_bytes = max(PACK_BYTES, min(size // 20_000, most))
    return pack_bytes, 4 + size // (CHUNKS_PER_BUCKET * pack_bytes), longest > pack_bytes
