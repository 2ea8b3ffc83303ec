"""The best candidates of every entity, found block by block, so that pairs are neither written nor shuffled.

A block is a key of a signal with its rows of both sides. Each block scores its pairs and hands on an entity's
best ``k`` in it; the best of all blocks together are the best of the union, as a pair that is among an entity's
first ``k`` overall is so in every block that has it. For the same reason its first signal is not lost.
Large blocks are cut into cells of both sides, for which the same holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.sources.storage import materialise

#: Rows of either side of a cell; cells of this size have four million pairs.
LEFT_ROWS, RIGHT_ROWS = 1024, 4096
#: Pairs of a task, rows read before their cells are scored, pairs whose scores are held, and pairs of names at a time.
TASK_PAIRS, GROUP_ROWS, CHUNK, LANES = 20_000_000, 20_000, 1 << 18, 1 << 15
WORD = 64
FOUND = "source1_entity_id string, o int, candidate_entity_id array<string>, score array<double>"
SEPARATOR = "\x1f"


def cells(left: DataFrame, right: DataFrame, s1: DataFrame, cands: DataFrame) -> DataFrame:
    """Rows of both sides (side 0 and 1) with name and tokens, dealt by cell and sorted. ``left`` and ``right``
    have entity_id, o (the signal's place) and block."""
    keys = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    keys = materialise(keys, "keys")
    n = lambda side: F.count_if(F.col("side") == side)
    blocks = materialise(keys.groupBy("o", "block").agg(n(0).alias("n1"), n(1).alias("n2")).filter("n1 > 0 and n2 > 0"), "blocks")
    pairs = blocks.agg(F.sum(F.col("n1") * F.col("n2")).cast("double")).first()[0] or 0.0
    tasks = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -int(-pairs // TASK_PAIRS))
    pieces = lambda n, rows: F.ceil(F.col(n) / rows).cast("int")
    blocks = blocks.withColumns({"p1": pieces("n1", LEFT_ROWS), "p2": pieces("n2", RIGHT_ROWS)}).drop("n1", "n2")
    parts = []
    for side, df in ((0, s1), (1, cands)):
        own, other, mine, theirs = ("p1", "p2", "i", "j") if side == 0 else ("p2", "p1", "j", "i")
        rows = keys.filter(F.col("side") == side).join(blocks, ["o", "block"])
        rows = rows.withColumn(mine, F.pmod(F.xxhash64("entity_id"), F.col(own)).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        text = df.select("entity_id", F.coalesce("name_canonical", F.lit("")).alias("name"), F.coalesce(F.array_join(F.array_distinct("addr_tokens"), SEPARATOR), F.lit("")).alias("tokens"))
        parts.append(rows.join(text, "entity_id").select("o", "block", "i", "j", "side", "entity_id", "name", "tokens"))
    cell = ["o", "block", "i", "j"]
    return parts[0].unionByName(parts[1]).repartition(tasks, *cell).sortWithinPartitions(*cell, "side", "entity_id")


def best_in_cells(df: DataFrame, k: int, indel: bool, digits: int | None) -> DataFrame:
    """Each entity's best ``k`` of every cell, by scores of so many digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            yield from score_cells(table, k, indel, digits)
        trim()

    return df.mapInArrow(run, FOUND)


def trim() -> None:
    """Gives freed memory back, as a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GROUP_ROWS:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = cell_starts(table)
            if len(starts) > 1:
                yield table.slice(0, starts[-1])
                table = table.slice(starts[-1])
            held, rows = table.to_batches(), table.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def cell_starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in ("o", "block", "i", "j"):
        column = table[name].combine_chunks()
        codes = (column.dictionary_encode().indices if name == "block" else column).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def first_of(*keys: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it in any key."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


class Names:
    """Distinct names as code points."""

    def __init__(self, names: list[str]):
        self.names = names
        self.length = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
        points, codes = np.unique(np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32), return_inverse=True)
        self.letters = max(1, len(points))
        self.at = offsets(self.length)
        self.codes = codes.astype(np.int32)
        # letter by letter, so that a step over all names reads one row
        self.columns = np.zeros((int(self.length.max(initial=0)), len(names)), dtype=np.int32)
        self.columns[spans(np.zeros(len(names), dtype=np.int64), self.length), np.repeat(np.arange(len(names)), self.length)] = self.codes

    def masks(self, which: np.ndarray, word: int = 0) -> np.ndarray:
        """A row of bits for every letter of the names ``which``, for WORD letters of theirs, the first or later ones."""
        n = np.clip(self.length[which] - word * WORD, 0, WORD)
        out = np.zeros((len(which), self.letters), dtype=np.uint64)
        place = spans(np.zeros(len(which), dtype=np.int64), n)
        np.bitwise_or.at(out.reshape(-1), np.repeat(np.arange(len(which)) * self.letters, n) + self.codes[spans(self.at[which] + word * WORD, n)], np.uint64(1) << place.astype(np.uint64))
        return out.reshape(-1)

    def similarity(self, a: np.ndarray, b: np.ndarray, indel: bool) -> np.ndarray:
        """From 0 to 100 for pairs of names; 0 where one is empty."""
        out = np.zeros(len(a))
        for low in range(0, len(a), LANES):
            part = slice(low, low + LANES)
            x, y = a[part], b[part]
            la, lb = self.length[x], self.length[y]
            value = self._common(x, y) if indel else self._edits(x, y)
            with np.errstate(invalid="ignore", divide="ignore"):
                value = 200.0 * value / (la + lb) if indel else 100 * (1 - value / np.maximum(la, lb))
            out[part] = np.where((la == 0) | (lb == 0), 0.0, value)
        return out

    def _lanes(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order by the length of ``b``, masks of the distinct ``a`` and each lane's row in them, how many lanes are
        through at each step."""
        order = np.argsort(self.length[b].astype(np.uint16), kind="stable")
        which, row = np.unique(a[order], return_inverse=True)
        b = b[order]
        return order, self.masks(which), row * self.letters, b, np.searchsorted(self.length[b], np.arange(len(self.columns)), "right")

    def _long(self, a: np.ndarray, out: np.ndarray, b: np.ndarray, f) -> np.ndarray:
        for i in np.flatnonzero(self.length[a] > WORD):
            out[i] = f(self.names[a[i]], self.names[b[i]])
        return out

    def _edits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Levenshtein distances by bit-parallel columns (Myers 1999, Hyyro 2003), a lane for each pair."""
        order, masks, row, text, through = self._lanes(a, b)
        m = self.length[a[order]]
        one, last = np.uint64(1), (np.maximum(m, 1) - 1).astype(np.uint64)
        vp, vn, edits = np.full(len(a), ~np.uint64(0)), np.zeros(len(a), dtype=np.uint64), m.copy()
        for j in range(int(self.length[text].max(initial=0))):
            on = slice(through[j], None)
            p, n = vp[on], vn[on]
            eq = masks[row[on] + self.columns[j][text[on]]]
            d = (((eq & p) + p) ^ p) | eq | n
            hp, hn = n | ~(p | d), p & d
            edits[on] += ((hp >> last[on]) & one).astype(np.int64) - ((hn >> last[on]) & one).astype(np.int64)
            x = (hp << one) | one
            vn[on] = x & d
            vp[on] = (hn << one) | ~(x | d)
        out = np.empty(len(a), dtype=np.int64)
        out[order] = edits
        long = np.flatnonzero(self.length[a] > WORD)
        if len(long):
            out[long] = self._edits_in_words(a[long], b[long])
        return out

    def _edits_in_words(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Levenshtein distances where ``a`` takes several words, which hand on the steps at their last bits."""
        order, _, row, text, through = self._lanes(a, b)
        which = np.unique(a)
        m = self.length[a[order]]
        words = -(-int(m.max()) // WORD)
        masks = [self.masks(which, w) for w in range(words)]
        one, top, last, end = np.uint64(1), np.uint64(WORD - 1), ((m - 1) % WORD).astype(np.uint64), (m - 1) // WORD
        vp, vn, edits = np.full((words, len(a)), ~np.uint64(0)), np.zeros((words, len(a)), dtype=np.uint64), m.copy()
        for j in range(int(self.length[text].max(initial=0))):
            on = slice(through[j], None)
            letter = row[on] + self.columns[j][text[on]]
            up, down = np.full(len(letter), one), np.zeros(len(letter), dtype=np.uint64)
            for w in range(words):
                p, n = vp[w, on], vn[w, on]
                eq = masks[w][letter] | down
                d = (((eq & p) + p) ^ p) | eq | n
                hp, hn = n | ~(p | d), p & d
                edits[on] += np.where(end[on] == w, ((hp >> last[on]) & one).astype(np.int64) - ((hn >> last[on]) & one).astype(np.int64), 0)
                x, y = (hp << one) | up, (hn << one) | down
                up, down = hp >> top, hn >> top
                vn[w, on] = x & d
                vp[w, on] = y | ~(x | d)
        out = np.empty(len(a), dtype=np.int64)
        out[order] = edits
        return out

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of longest common subsequences (Hyyro 2004)."""
        from linkweave.functions.similarity import lcs_length

        order, masks, row, text, through = self._lanes(a, b)
        state = np.full(len(a), ~np.uint64(0))
        for j in range(int(self.length[text].max(initial=0))):
            on = slice(through[j], None)
            s = state[on]
            both = s & masks[row[on] + self.columns[j][text[on]]]
            state[on] = (s + both) | (s - both)
        out = np.empty(len(a), dtype=np.int64)
        out[order] = np.bitwise_count(~state)
        return self._long(a, out, b, lcs_length)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein's distance, for names of any length."""
    if not a:
        return len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    ones, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    p, n, edits = ones, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        d = ((((eq & p) + p) ^ p) | eq | n) & ones
        hp, hn = n | (ones & ~(p | d)), p & d
        edits += bool(hp & last) - bool(hn & last)
        x = (hp << 1 | 1) & ones
        n = x & d
        p = (hn << 1 | (ones & ~(x | d))) & ones
    return edits


def score_cells(table: pa.Table, k: int, indel: bool, digits: int | None) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of each left row of every cell, ties by id; rows of a cell are sorted by side and id."""
    table = table.combine_chunks()
    column = lambda name: table[name].combine_chunks()
    starts = cell_starts(table)
    cell = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
    side, o = column("side").to_numpy(), column("o").to_numpy()
    ids, coded = column("entity_id"), column("name").dictionary_encode()
    name, names = coded.indices.to_numpy(), Names(coded.dictionary.to_pylist())
    joined = column("tokens")
    lists = pc.split_pattern(joined, SEPARATOR)
    n_tokens = np.where(pc.equal(joined, "").to_numpy(zero_copy_only=False), 0, lists.value_lengths().to_numpy())
    flat = lists.flatten()
    token = flat.filter(pc.not_equal(flat, "")).dictionary_encode().indices.to_numpy().astype(np.int64)
    token_at = offsets(n_tokens)
    kinds = int(token.max(initial=0)) + 1

    right = np.flatnonzero(side == 1)
    in_cell = np.bincount(cell[right], minlength=len(starts))
    right_at = offsets(in_cell)  # of a cell's first right row
    left = np.flatnonzero(side == 0)
    left = left[in_cell[cell[left]] > 0]
    left = left[np.lexsort((name[left], cell[left]))]
    # distinct right names of a cell, and each right row's place among them
    by_name = np.lexsort((name[right], cell[right]))
    new = first_of(cell[right][by_name], name[right][by_name])
    right_names, name_cell = name[right][by_name][new], cell[right][by_name][new]
    names_in, place = np.bincount(name_cell, minlength=len(starts)), np.empty(len(right), dtype=np.int64)
    names_at = offsets(names_in)
    place[by_name] = np.cumsum(new) - 1 - names_at[cell[right][by_name]]
    # right rows by cell and token
    size = n_tokens[right]
    posted = np.repeat(np.arange(len(right)), size)
    key = cell[right][posted] * kinds + token[spans(token_at[right], size)]
    by_key = np.argsort(key, kind="stable")
    key, posted = key[by_key], posted[by_key]

    pairs = offsets(in_cell[cell[left]])
    low = 0
    while low < len(left):
        high = max(low + 1, int(np.searchsorted(pairs, pairs[low] + CHUNK, "right")) - 1)
        rows = left[low:high]
        c, n = cell[rows], in_cell[cell[rows]]
        at = offsets(n)
        new = first_of(c, name[rows])
        wide = names_in[c[new]]
        similar = names.similarity(np.repeat(name[rows][new], wide), right_names[spans(names_at[c[new]], wide)], indel)
        partner = spans(right_at[c], n)
        score = similar[np.repeat(offsets(wide)[np.cumsum(new) - 1], n) + place[partner]]
        # shared tokens
        owner = np.repeat(np.arange(len(rows)), n_tokens[rows])
        wanted = c[owner] * kinds + token[spans(token_at[rows], n_tokens[rows])]
        first, end = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
        hit = posted[spans(first, end - first)]
        shared = np.bincount(np.repeat(at[owner] - right_at[c[owner]], end - first) + hit, minlength=at[-1])
        union = np.repeat(n_tokens[rows], n) + n_tokens[right][partner] - shared
        score = 0.7 * score + 30.0 * (shared / np.maximum(union, 1))
        level = np.unique(score, return_inverse=True)[1] if digits is None else np.floor(score * 10**digits + 0.5).astype(np.int64)
        keep, kept = best_of_rows(level, c, n, at, k)
        pick = partner[keep]
        ends = pa.array(offsets(kept), type=pa.int32())
        found = [pa.ListArray.from_arrays(ends, ids.take(pa.array(right[pick]))), pa.ListArray.from_arrays(ends, pa.array(score[keep]))]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(o[rows], type=pa.int32()), *found], ["source1_entity_id", "o", "candidate_entity_id", "score"])
        low = high


def best_of_rows(score: np.ndarray, c: np.ndarray, n: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of every row's ``k`` highest scores, the earlier of equal ones, and how many each row has."""
    marked = np.zeros(len(score), dtype=bool)
    first = np.flatnonzero(first_of(c))
    for low, high in zip(first, np.append(first[1:], len(c)), strict=True):
        part, width = slice(at[low], at[high]), int(n[low])
        if width <= k:
            marked[part] = True
            continue
        order = score[part].reshape(-1, width) * width + np.arange(width - 1, -1, -1)
        edge = np.partition(order, width - k, axis=1)[:, width - k]
        marked[part] = (order >= edge[:, None]).reshape(-1)
    return np.flatnonzero(marked), np.minimum(n, k)
