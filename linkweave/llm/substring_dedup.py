"""Substring dedup of words by fixed-block anchors.

With windows of 13 words and blocks of 7, every window of a reference text holds exactly one of its
non-overlapping blocks (13 = 2 * 7 - 1). So it is enough to index each text's blocks 0, 7, 14, ... and
to probe them with every rolling window of 7 words of every text. Hits are then extended: the windows
around them are told apart by the hash of all their words, and each gets the smallest document in
which it starts; runs of removed windows make up the maximal repeats.

Both rounds are exchanges between chunks of documents and buckets of the hash space (``exchange``).
A chunk sends each hash once, so a passage in a third of all documents weighs one entry per chunk.
Window hashes have 64 bits; two different windows share one with a chance of 2**-64.

A text longer than a pack is cut between words into pieces, each with the 12 words that follow it, so every
window is in one piece; the pieces' results are put together in their order, one at a time. Memory is bounded
by the pack and by the 13 longest words in a row, not by the text.

Defined results: a null text has no words; a text shorter than the window keeps all its words; of rows
with the same id none is smaller than the other; a null id counts as larger than all ids; windows never
cross documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkweave.llm import exchange as X
from linkweave.llm import rolling as R

WINDOW = 13
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


_SPACE, _WORD = re.compile(rb"[\t-\r ]"), re.compile(rb"[^\t-\r ]+")


def cut_words(window: int) -> X.Cut:
    """Pieces of whole words, each followed by the words that its last windows reach."""

    def cut(text: pa.Buffer, size: int) -> Iterator[tuple[bytes, int]]:
        begin = 0
        while begin < len(text):
            gap = _SPACE.search(text, begin + size)
            end = gap.start() if gap else len(text)
            own = text[begin:end].to_pybytes()
            yield b" ".join([own, *(m.group() for m in islice(_WORD.finditer(text, end), window - 1))]), len(own)
            begin = end

    return cut


class Words:
    """The words of a chunk and the hashes of its windows."""

    def __init__(self, texts: X.Texts, window: int):
        self.block = (window + 1) // 2
        self.starts, self.ends, self.text_of = R.word_bounds(texts.data, texts.offsets)
        hashes = R.window_hashes(R.prefix_hashes(texts.data), self.starts, self.ends)
        self.prefix = R.prefix_hashes(hashes)
        count = len(self.starts)
        first = np.searchsorted(self.text_of, np.arange(len(texts)))
        self.place = np.arange(count) - first[self.text_of] if count else np.zeros(0, np.int64)
        self.owned = self.starts < (texts.offsets[:-1] + texts.own)[self.text_of]
        self.windows = R.in_one_text(self.text_of, window)
        self.windows = self.windows[self.owned[self.windows]]
        #: only texts that hold a window take part
        long = np.bincount(self.text_of, minlength=len(texts)) >= window if count else np.zeros(0, bool)
        self.probes = R.in_one_text(self.text_of, self.block)
        if count:
            self.probes = self.probes[long[self.text_of[self.probes]]]
        self.count, self.window = count, window

    def hash(self, at: np.ndarray, size: int) -> np.ndarray:
        return R.window_hashes(self.prefix, at, at + size)

    def candidates(self, hit: np.ndarray) -> np.ndarray:
        """The windows that hold a probe that hit."""
        seen = np.zeros(self.count + 1, np.int32)
        np.cumsum(hit, out=seen[1:])
        return self.windows[seen[self.windows + self.window - self.block + 1] > seen[self.windows]]


def _low(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys.astype(np.uint32))


def _hits(words: Words, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    """Marks of the probes that the buckets named."""
    keys = words.hash(words.probes, words.block)
    order = np.argsort(keys)
    edges = [0, *X.bucket_edges(keys[order], buckets), len(keys)]
    hit = np.zeros(words.count, bool)
    for bucket, blob in answers:
        part = order[edges[bucket] : edges[bucket + 1]]
        hit[words.probes[part]] = R.member(keys[part].astype(np.uint32), X.expand(blob, np.uint32))
    return hit


def _smaller_elsewhere(keys: np.ndarray, answers: list[tuple[int, bytes]]) -> np.ndarray:
    named = np.sort(np.concatenate([X.expand(blob) for _, blob in answers])) if answers else np.zeros(0, np.uint64)
    return R.member(keys, named)


def _least(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the least id of each, and where each key is among them."""
    every, back = np.unique(keys, return_inverse=True)
    least = np.full(len(every), np.iinfo(np.int64).max)
    np.minimum.at(least, back, ids)
    return every, least, back


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False, pack_bytes: int | None = None) -> DataFrame:
    """One row per document: words, removed words, digest of what is kept; with ``keep_text`` the kept text."""
    pack_bytes, buckets, cut = X.plan_pieces(df, text_col, pack_bytes)
    packs = X.pack(df, id_col, text_col, pack_bytes, cut_words(window))

    def emit_anchors(chunk, texts):
        words = Words(texts, window)
        keys = words.hash(words.probes, words.block)
        aligned = words.place[words.probes] % words.block == 0
        order = np.argsort(keys)
        keys, aligned = keys[order], aligned[order]
        edges = [0, *X.bucket_edges(keys, buckets), len(keys)]
        for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                yield bucket, X.join_blobs([X.squeeze(_low(keys[a:b])), X.squeeze(_low(keys[a:b][aligned[a:b]]))])

    def reply_anchors(chunks, blobs):
        pairs = [X.split_blobs(blob) for blob in blobs]
        probes = [X.expand(p, np.uint32) for p, _ in pairs]
        every = np.sort(np.concatenate(probes))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        index = np.sort(np.concatenate([X.expand(i, np.uint32) for _, i in pairs]))
        shared = shared[R.member(shared, index)]
        for chunk, own in zip(chunks, probes, strict=True):
            found = own[R.member(own, shared)]
            if len(found):
                yield chunk, X.squeeze(found)

    first = X.answer(X.send(packs, emit_anchors), reply_anchors)

    def emit_windows(texts, answers):
        words = Words(texts, window)
        at = words.candidates(_hits(words, answers, buckets))
        keys, least, _ = _least(words.hash(at, window), texts.ids[words.text_of[at]])
        ids, code = np.unique(least, return_inverse=True)
        edges = [0, *X.bucket_edges(keys, buckets), len(keys)]
        return [(bucket, X.join_blobs([X.squeeze(keys[a:b]), X.planes(ids), X.planes(code[a:b].astype(np.uint32))])) for bucket, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]

    def reply_windows(chunks, blobs):
        keys, ids = [], []
        for blob in blobs:
            k, table, code = X.split_blobs(blob)
            keys.append(X.expand(k))
            code = X.unplanes(code, np.uint32)
            ids.append(X.unplanes(table, np.int64)[code])
        every, least, back = _least(np.concatenate(keys), np.concatenate(ids))
        at = 0
        for chunk, k, own in zip(chunks, keys, ids, strict=True):
            smaller = least[back[at : at + len(k)]] < own
            at += len(k)
            if smaller.any():
                yield chunk, X.squeeze(k[smaller])

    second = X.answer(X.send_after(packs, first, emit_windows), reply_windows)

    def work(texts, answers):
        words = Words(texts, window)
        keys = words.hash(words.windows, window)
        ids = texts.ids[words.text_of[words.windows]]
        _, least, back = _least(keys, ids)
        gone = (least[back] < ids) | _smaller_elsewhere(keys, answers)
        cover = np.zeros(words.count + 1, np.int32)
        np.add.at(cover, words.windows[gone], 1)
        np.add.at(cover, words.windows[gone] + window, -1)
        removed = np.cumsum(cover[:-1]) > 0
        return _result(texts, words, removed, keep_text)

    out = X.meet(packs, second, work, f"{RESULT_SCHEMA}, {X.PIECE_SCHEMA}")
    names = RESULT_SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    out = X.assemble(out, lambda: _Kept(keep_text), RESULT_SCHEMA) if cut else out.select(names)
    return out if keep_text else out.drop("kept")


class _Kept:
    """The result of a text whose words come in pieces."""

    def __init__(self, keep_text: bool):
        self.words = self.removed = 0
        self.digest, self.first = hashlib.sha256(), True
        self.text: list[bytes] | None = [] if keep_text else None

    def add(self, body: bytes, gone: np.ndarray) -> None:
        kept = [w for w, g in zip(body.split(), gone.tolist(), strict=True) if not g]
        self.words += len(gone)
        self.removed += len(gone) - len(kept)
        if kept:
            text = b" ".join(kept) if self.first else b" " + b" ".join(kept)
            self.first = False
            self.digest.update(text)
            if self.text is not None:
                self.text.append(text)

    def row(self) -> dict:
        text = None if self.text is None else b"".join(self.text).decode("utf-8", "replace")
        return {"n_words": self.words, "n_removed": self.removed, "kept_sha256": self.digest.hexdigest(), "kept": text}


def _result(texts: X.Texts, words: Words, removed: np.ndarray, keep_text: bool) -> pa.Table:
    n_words = np.bincount(words.text_of, minlength=len(texts))
    n_removed = np.bincount(words.text_of[removed], minlength=len(texts))
    raw, at = texts.data.tobytes(), texts.offsets.tolist()
    ends = np.cumsum(n_words)
    keep = ~removed
    digest, kept, pieces = [], [], {}
    for i, end in enumerate(ends.tolist()):
        own = raw[at[i] : at[i + 1]].split()
        if texts.part[i] >= 0:
            n_own = int(words.owned[end - len(own) : end].sum())
            pieces[i] = n_own, b" ".join(own[:n_own]), removed[end - len(own) : end]
            digest.append(None)
            kept.append(None)
            continue
        if n_removed[i]:
            own = [w for w, k in zip(own, keep[end - len(own) : end].tolist(), strict=True) if k]
        text = b" ".join(own)
        digest.append(hashlib.sha256(text).hexdigest())
        kept.append(text.decode("utf-8", "replace") if keep_text else None)
    return pa.table({"doc_id": texts.id_array(), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string()), "kept": pa.array(kept, pa.string()), **X.piece_columns(texts, pieces)})
