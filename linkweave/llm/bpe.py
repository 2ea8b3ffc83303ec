"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are cut into pre-tokens once, chunk by chunk. A chunk sends its distinct words to buckets by hash,
and every position with the number of its word on to where the ids will come; a bucket encodes every
distinct word of the whole corpus that falls to it once and answers each chunk with the ids of its words;
there the ids are put back at the words' positions. Decoding joins the ids of a chunk with the table of
token bytes, whose size is that of the vocabulary, and puts the bytes together by position.

A long text is cut and put together in pieces; in memory are its bytes and four bytes a pre-token. One
pre-token is encoded as a whole, of whatever length.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows each get a
row; other columns are ignored, whatever their names; an empty table gives an empty result. Text that
is no valid UTF-8 is read with replacement characters. A text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm import exchange as X

#: Characters of a text that are cut at a time, and matches at the end of a piece that what follows may change.
PIECE_CHARS = 1 << 20
AHEAD = 4
#: A byte that no UTF-8 text has.
SEPARATOR = b"\xff"
#: Words that are put together at a time.
STEP = 1 << 18
RESULT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded binary"


def portable(pattern: str) -> str:
    r"""``\s`` as the Unicode property, which is what the tokenizer library means by it."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


#: In ASCII and these Latin blocks, letters, numbers and spaces are known by range.
LETTERS, NUMBERS, SPACES = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9", r"\t-\r "
_WIDE = re.compile(f"[^\x00-\x7f{LETTERS}]")


def narrow(pattern: str) -> str:
    """The pattern for texts of ASCII and Latin letters only, for the faster of the two regex engines."""
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\[sS]|\[|\])", pattern):
        inside = part == "[" or inside and part != "]"
        named = {r"\p{L}": LETTERS, r"\p{N}": NUMBERS, r"\s": SPACES}.get(part)
        out.append(f"[^{SPACES}]" if part == r"\S" else part if named is None else named if inside else f"[{named}]")
    return "".join(out)


@functools.cache
def splitter(pattern: str):
    """Finds the matches of a pattern of letters, numbers, spaces and literals in a text."""
    import regex

    wide, fast = regex.compile(portable(pattern)).findall, re.compile(narrow(pattern)).findall
    return lambda text: wide(text) if _WIDE.search(text) else fast(text)


@functools.cache
def word_encoder(path: str):
    """The tokenizer library's merge loop for one word, or ours where it has none."""
    ranks = load_ranks(path)
    try:
        import tiktoken

        return tiktoken.Encoding("words", pat_str="", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    except (ImportError, AttributeError):
        return lambda word: encode_word(word, ranks)


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@functools.cache
def token_table(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours with the least rank until none merge; long words use a heap of pairs."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    find, none = ranks.get, 1 << 62
    scores = [find(a + b, none) for a, b in zip(parts, parts[1:])]
    while scores:
        least = min(scores)
        if least == none:
            break
        i = scores.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i < len(scores):
            scores[i] = find(parts[i] + parts[i + 1], none)
        if i:
            scores[i - 1] = find(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    import heapq

    count = len(word)
    after, before, end = list(range(1, count + 1)), list(range(-1, count - 1)), list(range(1, count + 1))
    alive = [True] * count
    heap = [(r, i, i + 2) for i in range(count - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else count
        if not alive[i] or j >= count or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[i] < count:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if before[i] >= 0 and (r := ranks.get(word[before[i] : stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i < count:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def pieces(text: str, pattern: str, size: int = PIECE_CHARS) -> Iterator[list[str]]:
    """The matches of the pattern in a text, some at a time. A long text is read in pieces; the last matches of a
    piece, which what follows may change, are found again with the next one."""
    find, at = splitter(pattern), 0
    while len(text) - at > size:
        width = size
        while True:
            part = text[at : at + width]
            own = find(part)
            if at + width >= len(text) or sum(map(len, own)) != len(part):  # the end, or a pattern that leaves gaps
                yield find(text[at:])
                return
            if len(own) > AHEAD:
                break
            width *= 2
        del own[-AHEAD:]
        at += sum(map(len, own))
        yield own
    yield find(text[at:])


class _Numbers(dict):
    """Words to numbers in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return self[word]


def _explode(texts: X.Texts, pattern: str, buckets: int) -> tuple[list[list[str]], bytes]:
    """(the chunk's distinct words by bucket, in the order in which they are met; ids of the documents, their
    numbers of words, every word's bucket, and every position's word)."""
    numbers, found, counts = _Numbers(), [], []
    raw, at = texts.data.tobytes(), texts.offsets.tolist()
    for a, b in zip(at, at[1:]):
        size = 0
        for own in pieces(raw[a:b].decode("utf-8", "replace"), pattern) if b > a else ():
            found.append(np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)))
            size += len(own)
        counts.append(size)
    mine: list[list[str]] = [[] for _ in range(buckets)]
    bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in numbers), np.uint32, len(numbers))
    for word, k in zip(numbers, bucket.tolist()):
        mine[k].append(word)
    positions = np.concatenate(found) if found else np.zeros(0, np.uint32)
    parts = [X.planes(texts.ids), X.planes(texts.no_id.astype(np.uint8)), X.planes(np.array(counts, np.uint32)), X.planes(bucket), *_pack_numbers(positions, len(numbers))]
    return mine, X.join_blobs(parts)


def _pack_numbers(positions: np.ndarray, count: int) -> tuple[bytes, bytes, bytes]:
    """Numbers in the order in which they are met: 0 where the next new one stands, otherwise by frequency."""
    times = np.bincount(positions, minlength=count)
    frequent = np.argsort(-times, kind="stable")[: int((times > 1).sum())].astype(np.uint32)
    rank = np.zeros(count, np.uint32)
    rank[frequent] = np.arange(1, len(frequent) + 1)
    most = np.maximum.accumulate(positions.astype(np.int64)) if len(positions) else np.zeros(0, np.int64)
    code = np.where(np.diff(most, prepend=-1) > 0, 0, rank[positions])
    return X.planes(frequent), X.planes(np.minimum(code, 255).astype(np.uint8)), X.planes((code[code >= 255] - 255).astype(np.uint32))


def _unpack_numbers(frequent: bytes, short: bytes, rest: bytes) -> np.ndarray:
    code = X.unplanes(short, np.uint8).astype(np.int64)
    code[code == 255] += X.unplanes(rest, np.uint32)
    new = code == 0
    known = np.concatenate([[0], X.unplanes(frequent, np.uint32)]).astype(np.int64)
    return np.where(new, np.cumsum(new) - 1, known[code])


def decode_ids(ids: np.ndarray, tokens: pa.Table) -> pa.Array:
    """The bytes of every id: the distinct ids are joined with the token-byte table (id, piece), and the bytes
    joined back by position."""
    present = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    joined = pa.table({"id": pa.array(present.astype(np.uint32))}).join(tokens, "id", join_type="inner", use_threads=False).combine_chunks()
    row = np.zeros(int(present[-1]) + 1 if len(present) else 0, np.int64)
    row[joined.column("id").to_numpy()] = np.arange(len(joined))
    if len(joined) != len(present):
        raise ValueError("ids that the vocabulary lacks")
    piece = joined.column("piece")
    return piece.chunk(0).take(pa.array(row[ids])) if piece.num_chunks else pa.array([], pa.large_binary())


@functools.cache
def token_rows(path: str) -> pa.Table:
    """The token-byte table; its size is that of the vocabulary."""
    ranks = load_ranks(path)
    return pa.table({"id": pa.array(list(ranks.values()), pa.uint32()), "piece": pa.array(list(ranks), pa.large_binary())})


def _flat(taken: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of a binary array and its offsets."""
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    return memoryview(taken.buffers()[2] or b""), offsets


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_payload: bool = False, pack_bytes: int | None = None) -> DataFrame:
    """One row per document: number of ids, digests, and with ``keep_payload`` ids (little-endian u32) and decoded bytes."""
    pack_bytes, buckets = X.plan(df, text_col, pack_bytes)

    def emit(chunk, texts):
        mine, positions = _explode(texts, pattern, buckets)
        for bucket, words in enumerate(mine):
            if words:
                yield bucket, X.join_blobs([b"w", zstandard.ZstdCompressor(level=6).compress(SEPARATOR.join(w.encode() for w in words))])
        # positions wait in any bucket for the words' ids
        yield zlib.crc32(str(chunk).encode()) % buckets, X.join_blobs([b"p", positions])

    def reply(chunks, blobs):
        one = word_encoder(ranks_path)
        asked = []
        for chunk, blob in zip(chunks, blobs, strict=True):
            kind, body = X.split_blobs(blob)
            if kind == b"p":
                yield chunk, blob
            else:
                asked.append((chunk, pa.array(zstandard.ZstdDecompressor().decompress(body).split(SEPARATOR), pa.large_binary())))
        if not asked:
            return
        every = pc.unique(pa.chunked_array([words for _, words in asked]))
        codes = list(map(one, every.to_pylist()))
        counts = np.fromiter(map(len, codes), np.uint32, len(codes))
        ids = np.fromiter(chain.from_iterable(codes), np.uint32, int(counts.sum()))
        begin = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        for chunk, words in asked:
            place = pc.index_in(words, every).to_numpy()
            n = counts[place].astype(np.int64)
            take = np.repeat(begin[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            yield chunk, X.join_blobs([b"i", X.planes(counts[place]), X.planes(ids[take])])

    replies = X.answer(X.send_packed(df, id_col, text_col, pack_bytes, emit), reply)

    def work(answers):
        parts = [(bucket, X.split_blobs(blob)) for bucket, blob in answers]
        (positions,) = (rest[0] for _, (kind, *rest) in parts if kind == b"p")
        by_bucket = [rest for _, (kind, *rest) in sorted((x for x in parts if x[1][0] == b"i"), key=lambda x: x[0])]
        counts = np.concatenate([np.zeros(0, np.uint32), *(X.unplanes(r[0], np.uint32) for r in by_bucket)])
        ids = np.concatenate([np.zeros(0, np.uint32), *(X.unplanes(r[1], np.uint32) for r in by_bucket)])
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64) * 4])
        words = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
        *heads, frequent, short, rest = X.split_blobs(positions)
        own, no_id, sizes, bucket = (X.unplanes(x, kind) for x, kind in zip(heads, (np.int64, np.uint8, np.uint32, np.uint32), strict=True))
        place = np.empty(len(bucket), np.int64)
        place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
        words = words.take(pa.array(place))
        numbers = _unpack_numbers(frequent, short, rest)
        tokens = token_rows(ranks_path)
        n, digest, back, payload, plain = [], [], [], [], []
        edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        doc = 0
        while doc < len(own):
            # documents with some words together, or a part of a long one at a time
            last = max(doc + 1, int(np.searchsorted(edge, edge[doc] + STEP, "right")) - 1)
            one, two = hashlib.sha256(), hashlib.sha256()
            kept: tuple[list[bytes], list[bytes]] = ([], [])
            total, at = 0, int(edge[doc])
            while True:
                stop = min(int(edge[last]), at + STEP) if last == doc + 1 else int(edge[last])
                raw, at_word = _flat(words.take(pa.array(numbers[at:stop])))
                flat = np.frombuffer(raw, "<u4")[: at_word[-1] // 4]
                text, at_id = _flat(decode_ids(flat, tokens))
                if last == doc + 1:
                    one.update(raw[: at_word[-1]])
                    two.update(text[: at_id[-1]])
                    total += len(flat)
                    if keep_payload:
                        kept[0].append(bytes(raw[: at_word[-1]]))
                        kept[1].append(bytes(text[: at_id[-1]]))
                    at = stop
                    if at < edge[last]:
                        continue
                    n.append(total)
                    digest.append(one.hexdigest())
                    back.append(two.hexdigest())
                    payload.append(b"".join(kept[0]) if keep_payload else None)
                    plain.append(b"".join(kept[1]) if keep_payload else None)
                    break
                for a, b in zip(edge[doc:last].tolist(), edge[doc + 1 : last + 1].tolist()):
                    i, j = int(at_word[a - at]), int(at_word[b - at])
                    k, m = int(at_id[i // 4]), int(at_id[j // 4])
                    n.append((j - i) // 4)
                    digest.append(hashlib.sha256(raw[i:j]).hexdigest())
                    back.append(hashlib.sha256(text[k:m]).hexdigest())
                    payload.append(bytes(raw[i:j]) if keep_payload else None)
                    plain.append(bytes(text[k:m]) if keep_payload else None)
                break
            doc = last
        return pa.table({"doc_id": pa.array(own, pa.int64(), mask=no_id.astype(bool)), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(digest, pa.string()), "decoded_sha256": pa.array(back, pa.string()), "ids": pa.array(payload, pa.binary()), "decoded": pa.array(plain, pa.binary())})

    out = X.collect(replies, work, RESULT_SCHEMA)
    return out if keep_payload else out.drop("ids", "decoded")


def decode(ids: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Text bytes from an array column of ids: a join with the token-byte table (bounded by the vocabulary), put together by position."""
    spark = ids.sparkSession
    tokens = F.broadcast(spark.createDataFrame(list(enumerate(token_table(ranks_path))), "id int, piece binary"))
    slim = ids.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias(id_col), F.col(ids_col).alias("ids"))
    placed = slim.select("row", F.posexplode("ids").alias("pos", "id")).join(tokens, "id")
    texts = placed.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("piece")))), lambda x: x.piece).alias("pieces"))
    return slim.join(texts, "row", "left").select(id_col, F.unhex(F.coalesce(F.array_join("pieces", ""), F.lit(""))).alias("decoded"))
