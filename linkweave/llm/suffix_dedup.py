"""Dedup of repeated byte strings by column-wise construction of suffix orders.

The construction sorts a collection of strings from the right: each round inserts one symbol of every
string, takes the order of the suffixes one symbol longer from the order before by one stable sort, and
updates the common prefixes of neighbours by range minima. The symbols that the next round inserts,
read in the current order, are the column's part of the collection's Burrows-Wheeler transform.

A round per symbol of the longest document over one collection of all documents would need as many
passes over everything as that document has bytes. So the collection is cut first, without loss:

1. Of each window of 200 bytes the k-gram with the least hash is its anchor; equal windows have equal
   anchors at equal offsets. A chunk sends hashes of its anchors and of their contexts (the bytes that
   any window with this anchor can touch: 168 before, 200 from its begin).
2. Anchors that occur once are settled, as are contexts that occur twice or more. What is left, contexts
   that differ although their anchors are equal, goes to the anchor's bucket, each context once, and
   the bucket constructs suffix orders and common prefixes of its contexts in 368 rounds. A window is
   repeated where a neighbour shares 200 bytes.
3. An anchor with more than ``HOT`` different contexts is not gathered: its windows are sent as hashes,
   which spread over all buckets.

A text longer than a pack is cut into pieces, each with the 199 bytes that follow it, so every window is in one
piece; an anchor that windows of two pieces share enters once for each, with what each piece holds of its
context. The pieces' results are put together in their order, one at a time.

Defined results: null text is empty; a text shorter than the window keeps all its bytes; repeated rows
repeat their windows, so all their bytes from length 200 on go; other columns are ignored; an empty
table gives an empty result. Hashes have 64 bits; unequal strings share one with a chance of 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from linkweave.llm import exchange as X
from linkweave.llm import rolling as R
from linkweave.sources.storage import materialise

WINDOW = 200
GRAM = 32
HOT = 20_000
PIECE_BYTES = 1 << 19
#: Contexts that are ordered together; an anchor's are never parted.
PART = 4096
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut_bytes(window: int) -> X.Cut:
    """Pieces, each followed by the bytes that its last windows reach."""

    def cut(text: pa.Buffer, size: int) -> Iterator[tuple[bytes, int]]:
        for begin in range(0, len(text), size):
            yield text[begin : min(begin + size + window - 1, len(text))].to_pybytes(), min(size, len(text) - begin)

    return cut


class Anchors:
    """Anchors of a chunk's windows, ordered by anchor hash and context hash."""

    def __init__(self, texts: X.Texts, window: int, gram: int):
        self.texts, self.window, self.left = texts, window, window - gram
        parts = [self._find(begin, end, gram) for begin, end in self._pieces()]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.uint64)] * 2
        order = np.lexsort((columns[6], columns[5]))
        self.pos, self.first, self.last, self.low, self.high, self.anchor, self.context = (c[order] for c in columns)

    def _pieces(self) -> list[tuple[int, int]]:
        """Ranges of whole texts, so that the arrays over all positions stay small."""
        out, begin, offsets = [], 0, self.texts.offsets
        while begin < len(self.texts):
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, "right")) - 1)
            out.append((begin, end))
            begin = end
        return out

    def _find(self, begin: int, end: int, gram: int) -> tuple[np.ndarray, ...]:
        """pos, first and last window, context's low and high, anchor hash, context hash."""
        shift = int(self.texts.offsets[begin])
        offsets = self.texts.offsets[begin : end + 1] - shift
        data = self.texts.data[shift : shift + int(offsets[-1])]
        counts = np.maximum(np.diff(offsets) - self.window + 1, 0)
        if not counts.any():
            return (*[np.zeros(0, np.int64)] * 5, *[np.zeros(0, np.uint64)] * 2)
        prefix = R.prefix_hashes(data)
        at = np.arange(len(data) - gram + 1)
        grams = R.window_hashes(prefix, at, at + gram)
        least = sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), self.left + 1)
        starts = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        chosen = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edge = np.ones(len(chosen), bool)
        edge[1:] = chosen[1:] != chosen[:-1]  # windows of two texts never share an anchor
        first = np.flatnonzero(edge)
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        pos = chosen[first]
        text = np.searchsorted(offsets, pos, "right") - 1
        low, high = np.maximum(offsets[text], pos - self.left), np.minimum(offsets[text + 1], pos + self.window)
        context = R.mix(R.window_hashes(prefix, low, high) ^ R.mix((pos - low).astype(np.uint64)))
        # anchors are least hashes and lie at the low end of the key space; mixed again they fill it evenly
        return pos + shift, starts[first] + shift, starts[last] + shift, low + shift, high + shift, R.mix(grams[pos]), context

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows that begin at ``at``."""
        return R.window_hashes(R.prefix_hashes(self.texts.data), at, at + self.window) if len(at) else np.zeros(0, np.uint64)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Where distinct (anchor, context) pairs begin in the order, and how often each occurs."""
        new = np.ones(len(self.anchor), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.context[1:] != self.context[:-1])
        begin = np.flatnonzero(new)
        return begin, np.diff(np.concatenate([begin, [len(new)]]))

    def matrix(self, which: np.ndarray) -> np.ndarray:
        """Contexts as rows, aligned at their anchors; cells outside the text are 0."""
        columns = self.pos[which][:, None] - self.left + np.arange(self.left + self.window)
        inside = (columns >= self.low[which][:, None]) & (columns < self.high[which][:, None])
        return np.where(inside, self.texts.data[np.clip(columns, 0, len(self.texts.data) - 1)], 0).astype(np.uint8)


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum over ``width`` keys from every position on, by minima within blocks from both sides."""
    full = -(-len(keys) // width) * width + width
    padded = np.full(full, np.iinfo(np.uint64).max)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: full - width + 1], forward[width - 1 :])


def repeated_columns(contexts: np.ndarray, left: np.ndarray, right: np.ndarray, before: int, window: int) -> np.ndarray:
    """For every context and each of its first ``before`` + 1 columns whether the window that begins there
    also begins at that column of another context.

    Column by column from the right: ``order`` holds the contexts by their suffixes, ``common`` the
    common prefix of each with the one before it. 0 stands for the end of a text and matches nothing.
    """
    count, columns = contexts.shape
    out = np.zeros((count, before + 1), bool)
    if count < 2:
        return out
    place = np.arange(columns)
    inside = (place >= (before - left)[:, None]) & (place < (before + right)[:, None])
    symbols = np.ascontiguousarray(np.where(inside, contexts.astype(np.uint16) + 1, 0).astype(np.uint16).T)
    order, common = np.arange(count), np.zeros(count + 1, np.int32)
    for column in range(columns - 1, -1, -1):
        inserted = symbols[column][order]
        by = np.argsort(inserted, kind="stable")
        order, inserted = order[by], inserted[by]
        same = np.flatnonzero((inserted[1:] == inserted[:-1]) & (inserted[1:] > 0))
        longer = np.zeros(count + 1, np.int32)
        if len(same):
            ends = np.empty(2 * len(same), np.int64)
            ends[0::2], ends[1::2] = by[same] + 1, by[same + 1] + 1
            longer[same + 1] = 1 + np.minimum.reduceat(common, ends)[::2]
        common = longer
        if column <= before:
            out[order, column] = np.maximum(common[:-1], common[1:]) >= window
    return out


def by_anchor(contexts: np.ndarray, left: np.ndarray, right: np.ndarray, before: int, window: int, gram: int) -> np.ndarray:
    """``repeated_columns`` of a bucket, some anchors at a time: only contexts with one anchor can match."""
    key = np.zeros(len(contexts), np.uint64)
    for column in range(before, before + gram):
        key = key * np.uint64(0x100000001B3) + contexts[:, column]
    order = np.argsort(key, kind="stable")
    ends = np.flatnonzero(np.concatenate([key[order][1:] != key[order][:-1], [True]])) + 1
    out, begin = np.zeros((len(contexts), before + 1), bool), 0
    while begin < len(order):
        # up to PART contexts, or all of one anchor
        at = max(int(np.searchsorted(ends, begin, "right")), int(np.searchsorted(ends, begin + PART, "right")) - 1)
        part = order[begin : ends[at]]
        out[part] = repeated_columns(contexts[part], left[part], right[part], before, window)
        begin = int(ends[at])
    return out


def _pack_bytes(matrix: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(matrix.tobytes())


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT, keep_text: bool = False, pack_bytes: int | None = None) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of the rest; with ``keep_text`` the rest."""
    pack_bytes, buckets, cut = X.plan_pieces(df, text_col, pack_bytes)
    packs = X.pack(df, id_col, text_col, pack_bytes, cut_bytes(window))
    before = window - gram
    width = before + window

    def emit_anchors(chunk, texts):
        a = Anchors(texts, window, gram)
        begin, times = a.entries()
        keys, context = a.anchor[begin], a.context[begin]
        edges = [0, *X.bucket_edges(keys, buckets), len(keys)]
        for bucket, (i, j) in enumerate(zip(edges, edges[1:])):
            if j > i:
                yield bucket, X.join_blobs([X.squeeze(keys[i:j]), X.planes(context[i:j]), X.planes((times[i:j] > 1).astype(np.uint8))])

    def reply_anchors(chunks, blobs):
        parts = [X.split_blobs(b) for b in blobs]
        anchors = [X.expand(p[0]) for p in parts]
        sizes = np.array([len(x) for x in anchors])
        anchor = np.concatenate(anchors)
        context = np.concatenate([X.unplanes(p[1], np.uint64) for p in parts])
        many = np.concatenate([X.unplanes(p[2], np.uint8) for p in parts]).astype(bool)
        order = np.lexsort((context, anchor))  # stable: chunks stay in the order in which they came
        a, c = anchor[order], context[order]
        new_anchor = np.ones(len(a), bool)
        new_anchor[1:] = a[1:] != a[:-1]
        new = new_anchor.copy()
        new[1:] |= c[1:] != c[:-1]
        of_anchor, of_pair = np.cumsum(new_anchor) - 1, np.cumsum(new) - 1
        different = np.bincount(of_anchor[new])[of_anchor]
        repeated = (np.bincount(of_pair)[of_pair] > 1) | (np.bincount(of_pair, many[order]) > 0)[of_pair]
        code = repeated.astype(np.uint8)
        code[(different > 1) & new] |= 2
        code[(different > hot) & (code & 2 > 0)] |= 4
        back = np.empty(len(a), np.uint8)
        back[order] = code
        at = 0
        for chunk, size in zip(chunks, sizes.tolist(), strict=True):
            own = back[at : at + size]
            at += size
            if own.any():
                yield chunk, X.join_blobs([b"a", X.planes(own)])

    first = materialise(X.answer(X.send(packs, emit_anchors), reply_anchors), "anchors", "uncompressed")

    def codes_of(a: Anchors, answers) -> tuple[np.ndarray, np.ndarray, list[int]]:
        begin, _ = a.entries()
        edges = [0, *X.bucket_edges(a.anchor[begin], buckets), len(begin)]
        code = np.zeros(len(begin), np.uint8)
        for bucket, blob in answers:
            kind, *rest = X.split_blobs(blob)
            if kind == b"a":
                code[edges[bucket] : edges[bucket + 1]] = X.unplanes(rest[0], np.uint8)
        return begin, code, edges

    def windows_of(a: Anchors, which: np.ndarray) -> np.ndarray:
        """The windows that belong to anchors, each to one."""
        counts = a.last[which] - a.first[which] + 1
        return np.repeat(a.first[which] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(which) else np.zeros(0, np.int64)

    def emit_contexts(texts, answers):
        a = Anchors(texts, window, gram)
        begin, code, edges = codes_of(a, answers)
        out = []
        for bucket, (i, j) in enumerate(zip(edges, edges[1:])):
            own = np.flatnonzero((code[i:j] & 6) == 2) + i
            if len(own):
                at = begin[own]
                out.append((bucket, X.join_blobs([b"c", X.squeeze((own - i).astype(np.uint32)), _pack_bytes(a.matrix(at)), X.planes((a.pos[at] - a.low[at]).astype(np.uint16)), X.planes((a.high[at] - a.pos[at]).astype(np.uint16)), X.planes((code[own] & 1).astype(np.uint8))])))
        at = windows_of(a, begin[code & 4 > 0])
        keys = np.sort(a.hashes(at))
        ends = [0, *X.bucket_edges(keys, buckets), len(keys)]
        out += [(bucket, X.join_blobs([b"w", X.squeeze(keys[i:j])])) for bucket, (i, j) in enumerate(zip(ends, ends[1:])) if j > i]
        return out

    def reply_contexts(chunks, blobs):
        rows, matrices, lefts, rights, settled, hashed = [], [], [], [], [], []
        for chunk, blob in zip(chunks, blobs, strict=True):
            kind, *rest = X.split_blobs(blob)
            if kind == b"w":
                hashed.append((chunk, X.expand(rest[0])))
                continue
            index = X.expand(rest[0], np.uint32)
            rows.append((chunk, index))
            matrices.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(rest[1]), np.uint8).reshape(len(index), width))
            lefts.append(X.unplanes(rest[2], np.uint16))
            rights.append(X.unplanes(rest[3], np.uint16))
            settled.append(X.unplanes(rest[4], np.uint8))
        if rows:
            found = by_anchor(np.concatenate(matrices), np.concatenate(lefts).astype(np.int64), np.concatenate(rights).astype(np.int64), before, window, gram)
            at = 0
            for (chunk, index), done in zip(rows, settled, strict=True):
                own = found[at : at + len(index)]
                at += len(index)
                some = own.any(1) & (done == 0)
                if some.any():
                    yield chunk, X.join_blobs([b"c", X.squeeze(index[some]), _pack_bytes(np.packbits(own[some], axis=1))])
        if hashed:
            every = np.sort(np.concatenate([k for _, k in hashed]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            for chunk, keys in hashed:
                own = np.unique(keys[R.member(keys, twice)])
                if len(own):
                    yield chunk, X.join_blobs([b"w", X.squeeze(own)])

    second = X.answer(X.send_after(packs, first, emit_contexts), reply_contexts)

    def work(texts, answers):
        a = Anchors(texts, window, gram)
        begin, code, edges = codes_of(a, answers)
        times = np.diff(np.concatenate([begin, [len(a.anchor)]]))
        covered = np.zeros(len(texts.data) + 1, np.int32)

        def cover(starts, count=window):
            np.add.at(covered, starts, 1)
            np.add.at(covered, starts + count, -1)

        # every window of an anchor whose context is repeated: one stretch
        whole = np.flatnonzero(np.repeat(code & 1 > 0, times))
        np.add.at(covered, a.first[whole], 1)
        np.add.at(covered, a.last[whole] + window, -1)
        for bucket, blob in answers:
            kind, *rest = X.split_blobs(blob)
            if kind == b"c":
                index = X.expand(rest[0], np.uint32).astype(np.int64) + edges[bucket]
                bits = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(rest[1]), np.uint8).reshape(len(index), -1), axis=1)[:, : before + 1]
                row, column = np.nonzero(bits)
                cover(a.pos[begin[index[row]]] - before + column)
        named = [X.expand(rest[0]) for _, blob in answers for kind, *rest in [X.split_blobs(blob)] if kind == b"w"]
        if named:
            at = windows_of(a, begin[code & 4 > 0])
            cover(at[R.member(a.hashes(at), np.sort(np.concatenate(named)))])
        return _result(texts, np.cumsum(covered[:-1]) > 0, keep_text)

    out = X.meet(packs, first.unionByName(second), work, f"{RESULT_SCHEMA}, {X.PIECE_SCHEMA}")
    names = RESULT_SCHEMA.replace(" long", "").replace(" string", "").replace(" binary", "").split(", ")
    out = X.assemble(out, lambda: _Kept(keep_text), RESULT_SCHEMA) if cut else out.select(names)
    return out if keep_text else out.drop("kept")


class _Kept:
    """The result of a text whose bytes come in pieces."""

    def __init__(self, keep_text: bool):
        self.size = self.removed = self.spans = 0
        self.digest, self.open = hashlib.sha256(), False
        self.text: list[bytes] | None = [] if keep_text else None

    def add(self, body: bytes, gone: np.ndarray) -> None:
        self.size += len(gone)
        self.removed += int(gone.sum())
        self.spans += int((gone & ~np.concatenate([[self.open], gone[:-1]])).sum())
        self.open = bool(gone[-1])
        rest = np.frombuffer(body, np.uint8)[~gone].tobytes()
        self.digest.update(rest)
        if self.text is not None:
            self.text.append(rest)

    def row(self) -> dict:
        return {"n_bytes": self.size, "n_removed": self.removed, "n_spans": self.spans, "kept_sha256": self.digest.hexdigest(), "kept": None if self.text is None else b"".join(self.text)}


def _result(texts: X.Texts, gone: np.ndarray, keep_text: bool) -> pa.Table:
    offsets = texts.offsets
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[offsets[1:]] - total[offsets[:-1]]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    full = offsets[:-1][np.diff(offsets) > 0]
    begins[full] = gone[full]
    runs = np.concatenate([[0], np.cumsum(begins)])
    spans = runs[offsets[1:]] - runs[offsets[:-1]]
    digest, kept, pieces = [], [], {}
    for i, n in enumerate(removed.tolist()):
        own = texts.data[offsets[i] : offsets[i + 1]]
        if texts.part[i] >= 0:
            n_own = int(texts.own[i])
            pieces[i] = n_own, own[:n_own].tobytes(), gone[offsets[i] : offsets[i + 1]]
            digest.append(None)
            kept.append(None)
            continue
        rest = (own[~gone[offsets[i] : offsets[i + 1]]] if n else own).tobytes()
        digest.append(hashlib.sha256(rest).hexdigest())
        kept.append(rest if keep_text else None)
    return pa.table({"doc_id": texts.id_array(), "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string()), "kept": pa.array(kept, pa.binary()), **X.piece_columns(texts, pieces)})
