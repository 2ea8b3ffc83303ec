"""Features of pairs, found where the texts of both entities lie, so that texts don't travel with every pair.

Entities are dealt to a grid of cells: a candidate to one column ``j`` and all rows, an S1 entity to one row ``i`` and
all columns, a pair to the one cell that has both. A cell codes its texts once and compares pairs by vectors. Cells
have a bounded number of entities and, on average, of pairs; so an entity travels about as often as the square root
of their number, however many pairs it is in.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from linkweave.functions.similarity import metaphone
from linkweave.operators.best import LANES, Names, first_of, offsets, spans, trim

S1, CAND = "source1_entity_id", "candidate_entity_id"
#: Entities of a side of a cell, pairs of a cell, pairs whose texts are coded together.
CELL_ROWS, CELL_PAIRS, CHUNK = 300_000, 2_000_000, 1 << 16
#: Products of two sets' sizes up to which all their members are compared with one another.
SMALL_SETS = 1024
#: What each feature reads, and how.
FEATURES: dict[str, tuple[str, str]] = {
    "feat_name_jaccard": ("name_tokens", "jaccard"), "feat_name_overlap": ("name_tokens", "overlap"),
    "feat_addr_jaccard": ("addr_tokens", "jaccard"), "feat_addr_overlap": ("addr_tokens", "overlap"),
    "feat_name_tfidf": ("name_weights", "dot"), "feat_addr_tfidf": ("addr_weights", "dot"),
    "feat_name_levenshtein": ("name_canonical", "levenshtein"), "feat_name_jaro_winkler": ("name_canonical", "jaro_winkler"),
    "feat_addr_levenshtein": ("addr_normalized", "levenshtein"), "feat_phonetic_match": ("name_canonical", "phonetic"),
    "feat_pincode_match": ("addr_pincode", "equal_filled"), "feat_country_match": ("country", "equal"), "indel": ("name_canonical", "indel"),
}
FLAGS = ("phonetic", "equal_filled", "equal")


def compare(pairs: DataFrame, s1: DataFrame, cands: DataFrame, wanted: list[str]) -> DataFrame:
    """``pairs`` with the features ``wanted``. Missing texts are '', missing tokens and weights none, a missing country
    equals nothing; where ids repeat, each pair of rows counts. All three are read twice, so better written tables.
    ``*_weights`` are maps of tokens."""
    carried = [f for f in pairs.schema if f.name not in (S1, CAND)]
    columns = list(dict.fromkeys(FEATURES[name][0] for name in wanted))
    spark = pairs.sparkSession
    n, n1, n2 = pairs.count(), max(1, s1.count()), max(1, cands.count())
    wish = max(4 * spark.sparkContext.defaultParallelism, n / CELL_PAIRS)
    q = max(-(-n2 // CELL_ROWS), min(n2, round((wish * n2 / n1) ** 0.5)), 1)
    p = max(-(-n1 // CELL_ROWS), min(n1, round(wish / q)), 1)
    row = lambda c: F.pmod(F.xxhash64(c), F.lit(p)).cast("int")
    column = lambda c: F.pmod(F.xxhash64(c), F.lit(q)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    lists = [StructField(f"__c{k}", ArrayType(f.dataType)) for k, f in enumerate(carried)]
    packed = StructType([StructField("__i", IntegerType()), StructField("__j", IntegerType()), StructField("__id", StringType()), StructField("__cands", ArrayType(StringType())), *lists])
    rows = pairs.select(row(S1).alias("__i"), column(CAND).alias("__j"), S1, CAND, *[F.col(f.name).alias(f"__c{k}") for k, f in enumerate(carried)]).mapInArrow(pack, packed)
    parts = [rows.withColumn("__side", F.lit(2))]
    for side, df in ((0, cands), (1, s1)):
        read = []
        for name in columns:
            read += [F.map_keys(name).alias(name), F.map_values(name).alias(f"{name}_of")] if name.endswith("weights") else [F.col(name)]
        at = [every(p).alias("__i"), column("entity_id").alias("__j")] if side == 0 else [row("entity_id").alias("__i"), every(q).alias("__j")]
        parts.append(df.select(*at, F.col("entity_id").alias("__id"), F.lit(side).alias("__side"), *read))
    both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    dealt = both.repartitionById(p * q, (F.col("__i") * q + F.col("__j")).cast("int")).sortWithinPartitions("__i", "__j", "__side", "__id")
    schema = StructType([StructField(S1, StringType()), StructField(CAND, StringType()), *carried, *[StructField(name, IntegerType() if FEATURES[name][1] in FLAGS else DoubleType()) for name in wanted]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cells(batches):
            yield from compare_cell(table, len(carried), wanted)
            trim()

    found = dealt.mapInArrow(run, schema)
    return found.select(*pairs.columns, *wanted)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An entity's pairs of a batch and cell as one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        i, j, ids = batch.column(0), batch.column(1), batch.column(2)
        a, b, s = i.to_numpy(), j.to_numpy(), ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.lexsort((b, a, s))
        new = np.flatnonzero(first_of(s[order], a[order], b[order]))
        ends = pa.array(np.append(new, len(order)), type=pa.int32())
        head, order = pa.array(order[new]), pa.array(order)
        lists = [pa.ListArray.from_arrays(ends, batch.column(k).take(order)) for k in range(3, batch.num_columns)]
        yield pa.RecordBatch.from_arrays([i.take(head), j.take(head), ids.take(head), *lists], ["__i", "__j", "__id", "__cands", *batch.schema.names[4:]])


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table a cell."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        i, j = batch.column("__i").to_numpy(), batch.column("__j").to_numpy()
        starts = np.flatnonzero(first_of(i, j))
        for low, high in zip(starts, np.append(starts[1:], len(i)), strict=True):
            if held and last != (i[low], j[low]):
                yield pa.Table.from_batches(held)
                held = []
            last = i[low], j[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def places(ids: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of each wanted id in sorted ``ids``; the row after the last for one that is absent."""
    if not len(ids):
        return np.zeros(len(wanted), dtype=np.int64), np.ones(len(wanted), dtype=np.int64)
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    starts = np.flatnonzero(first_of(codes))
    sizes = np.diff(np.append(starts, len(ids)))
    at = pc.fill_null(pc.index_in(wanted, value_set=ids.take(pa.array(starts)), skip_nulls=True), -1).to_numpy()
    return np.append(starts, len(ids))[at], np.append(sizes, 1)[at]


def compare_cell(table: pa.Table, n_carried: int, wanted: list[str]) -> Iterator[pa.RecordBatch]:
    side = table["__side"].to_numpy()
    ends = np.searchsorted(side, [1, 2])
    right, left, lists = (table.slice(low, high - low).combine_chunks() for low, high in ((0, ends[0]), (ends[0], ends[1]), (ends[1], len(side))))
    if not lists.num_rows:
        return
    whole = lambda t, name: t[name].combine_chunks()
    flat = [whole(lists, name).flatten() for name in ("__cands", *[f"__c{k}" for k in range(n_carried)])]
    parent = np.repeat(np.arange(lists.num_rows), pc.list_value_length(whole(lists, "__cands")).to_numpy())
    ids = whole(lists, "__id")
    a, na = (x[parent] for x in places(whole(left, "__id"), ids))
    b, nb = places(whole(right, "__id"), flat[0])
    pair = np.arange(len(parent))
    if na.max(initial=1) > 1 or nb.max(initial=1) > 1:  # repeated ids
        pair = np.repeat(pair, na * nb)
        k = spans(np.zeros(len(na), dtype=np.int64), na * nb)
        a, b = a[pair] + k // nb[pair], b[pair] + k % nb[pair]
    for low in range(0, len(pair), CHUNK):
        part = slice(low, low + CHUNK)
        chunk = Chunk(left, right, a[part], b[part])
        found = [chunk.feature(name) for name in wanted]
        take = pa.array(pair[part])
        out = [ids.take(pa.array(parent[pair[part]])), *[x.take(take) for x in flat], *found]
        names = [S1, CAND, *[f"c{k}" for k in range(n_carried)], *wanted]
        yield from pa.Table.from_arrays(out, names).to_batches(max_chunksize=1 << 14)


class Chunk:
    """Pairs of rows of both tables; the row after a table's last has no texts."""

    def __init__(self, left: pa.Table, right: pa.Table, a: np.ndarray, b: np.ndarray):
        self.rows, self.codes = [], []
        for rows, n in ((a, left.num_rows), (b, right.num_rows)):
            found, code = np.unique(rows, return_inverse=True)
            self.rows.append(pa.array(found, mask=found >= n))  # a null takes a null
            self.codes.append(code)
        self.tables = left, right
        self.known: dict[str, tuple] = {}

    def _both(self, name: str) -> pa.Array:
        """A column of the distinct rows, left ones first."""
        return pa.concat_arrays([t[name].combine_chunks().take(rows) for t, rows in zip(self.tables, self.rows, strict=True)])

    def _once(self, name: str, f: Callable[[], tuple]) -> tuple:
        if name not in self.known:
            self.known[name] = f()
        return self.known[name]

    def _texts(self, name: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct texts, the distinct pairs of them, and which one each pair is."""

        def find():
            coded = pc.fill_null(self._both(name), "").dictionary_encode()
            code, n = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            x, y = code[self.codes[0]], code[len(self.rows[0]) + self.codes[1]]
            once, which = np.unique(x * n + y, return_inverse=True)
            return coded.dictionary.to_pylist(), once // n, once % n, which

        return self._once(name, find)

    def _names(self, name: str) -> Names:
        return self._once(f"{name} coded", lambda: (Names(self._texts(name)[0]),))[0]

    def _shared(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes of both token sets of every pair and of what they share."""

        def find():
            column = self._both(name)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            coded = column.flatten().dictionary_encode(null_encoding="encode")
            kinds = len(coded.dictionary) + 1
            key = np.unique(np.repeat(np.arange(len(size)), size) * kinds + coded.indices.to_numpy())
            size = np.bincount(key // kinds, minlength=len(size))
            sets = Sets(size, key % kinds, None)
            x, y = self.codes[0], len(self.rows[0]) + self.codes[1]
            return size[x], size[y], sets.shared(x, y)

        return self._once(name, find)

    def feature(self, name: str) -> pa.Array:
        column, how = FEATURES[name]
        if how in ("jaccard", "overlap"):
            n1, n2, shared = self._shared(column)
            return pa.array(shared if how == "overlap" else shared / np.maximum(n1 + n2 - shared, 1))
        if how == "dot":
            keys, values = self._both(column), self._both(f"{column}_of")
            size = pc.fill_null(pc.list_value_length(keys), 0).to_numpy().astype(np.int64)
            coded = keys.flatten().dictionary_encode()
            sets = Sets(size, coded.indices.to_numpy().astype(np.int64), values.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            return pa.array(sets.shared(self.codes[0], len(self.rows[0]) + self.codes[1]))
        if how == "equal":
            code = pc.fill_null(self._both(column).dictionary_encode().indices, -1).to_numpy()
            x, y = code[self.codes[0]], code[len(self.rows[0]) + self.codes[1]]
            return pa.array(((x == y) & (x >= 0)).astype(np.int32))
        texts, x, y, which = self._texts(column)
        if how == "equal_filled":
            filled = np.array([t != "" for t in texts])
            return pa.array(((x == y) & filled[x]).astype(np.int32)[which])
        if how == "phonetic":
            sounds: dict[str, int] = {"": 0}
            code = np.array([sounds.setdefault(sound(t.split(" ", 1)[0]), len(sounds)) for t in texts])
            return pa.array(((code[x] == code[y]) & (code[x] > 0)).astype(np.int32)[which])
        names = self._names(column)
        value = names.similarity(x, y, True) if how == "indel" else by_lanes(levenshtein if how == "levenshtein" else jaro_winkler, names, x, y)
        return pa.array(value[which])


sound = functools.lru_cache(maxsize=1 << 16)(metaphone)


def by_lanes(f: Callable[[Names, np.ndarray, np.ndarray], np.ndarray], names: Names, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a))
    for low in range(0, len(a), LANES):
        part = slice(low, low + LANES)
        out[part] = f(names, a[part], b[part])
    return out


def levenshtein(names: Names, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - distance / longer length; two empty names are equal."""
    la, lb = names.length[a], names.length[b]
    swap = la > lb  # the distance is symmetric, and short patterns need one word
    x, y = np.where(swap, b, a), np.where(swap, a, b)
    longer = names.length[y]
    edits = np.where(names.length[x] == 0, longer, names._edits(x, y))
    return np.where(longer == 0, 1.0, 1 - edits / np.maximum(longer, 1))


def jaro_winkler(names: Names, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As ``similarity.jaro_winkler``, a lane for each pair: taken letters are bits."""
    from linkweave.functions.similarity import jaro_winkler as one_by_one

    la, lb = names.length[a], names.length[b]
    out = np.where((la == 0) & (lb == 0), 1.0, 0.0)
    for i in np.flatnonzero((np.maximum(la, lb) > 64) & (np.minimum(la, lb) > 0)):
        out[i] = one_by_one(names.names[a[i]], names.names[b[i]])
    lanes = np.flatnonzero((np.maximum(la, lb) <= 64) & (np.minimum(la, lb) > 0))
    lanes = lanes[np.argsort(la[lanes], kind="stable")]
    a, b, la, lb = a[lanes], b[lanes], la[lanes], lb[lanes]
    which, row = np.unique(b, return_inverse=True)
    masks, row = names.masks(which), row * names.letters
    through = np.searchsorted(la, np.arange(65), "right")
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    ones, one = ~np.uint64(0), np.uint64(1)
    taken, left = np.zeros(len(a), dtype=np.uint64), np.zeros(len(a), dtype=np.uint64)
    for i in range(int(la.max(initial=0))):
        on = slice(through[i], None)
        r = reach[on]
        window = (ones << np.maximum(i - r, 0).astype(np.uint64)) & (ones >> np.maximum(63 - i - r, 0).astype(np.uint64))
        open_ = masks[row[on] + names.columns[i][a[on]]] & window & ~taken[on]
        taken[on] |= open_ & (~open_ + one)
        left[on] |= (open_ != 0).astype(np.uint64) << np.uint64(i)
    letters = []
    for bits, text in ((left, a), (taken, b)):
        lane, place = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        letters.append(names.codes[names.at[text[lane]] + place])
    matched = np.bitwise_count(left).astype(np.int64)
    swapped = np.bincount(lane, weights=letters[0] != letters[1], minlength=len(a)).astype(np.int64) // 2
    some = np.maximum(matched, 1)
    jaro = np.where(matched == 0, 0.0, (matched / la + matched / lb + (matched - swapped) / some) / 3)
    same, alive = np.zeros(len(a), dtype=np.int64), np.ones(len(a), dtype=bool)
    for i in range(min(4, len(names.columns))):
        alive &= (la > i) & (lb > i) & (names.columns[i][a] == names.columns[i][b])
        same += alive
    out[lanes] = np.where(jaro <= 0.7, jaro, jaro + 0.1 * same * (1 - jaro))
    return out


class Sets:
    """Sets of codes, with a value of each member or none."""

    def __init__(self, size: np.ndarray, members: np.ndarray, values: np.ndarray | None):
        self.size, self.members, self.values, self.at = size, members, values, offsets(size)

    def _columns(self, which: np.ndarray, missing: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Member by member, so that a step over all sets reads one row."""
        n = self.size[which]
        place, owner, source = spans(np.zeros(len(which), dtype=np.int64), n), np.repeat(np.arange(len(which)), n), spans(self.at[which], n)
        codes = np.full((int(n.max(initial=0)), len(which)), missing, dtype=np.int32)
        codes[place, owner] = self.members[source]
        if self.values is None:
            return codes, None
        values = np.zeros(codes.shape)
        values[place, owner] = self.values[source]
        return codes, values

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many members both sets have, or the sum of their values' products."""
        out = np.zeros(len(a))
        small = self.size[a] * self.size[b] <= SMALL_SETS
        for i in np.flatnonzero(~small):
            out[i] = self._one(a[i], b[i])
        lanes = np.flatnonzero(small)
        lanes = lanes[np.lexsort((self.size[b[lanes]], self.size[a[lanes]]))]
        for low in range(0, len(lanes), LANES):
            part = lanes[low : low + LANES]
            x, values_x = self._columns(a[part], -1)
            y, values_y = self._columns(b[part], -2)
            through = np.searchsorted(self.size[a[part]], np.arange(len(x)), "right")
            total = np.zeros(len(part))
            for i in range(len(x)):
                on = slice(through[i], None)
                for j in range(len(y)):
                    same = x[i][on] == y[j][on]
                    total[on] += same if self.values is None else same * values_x[i][on] * values_y[j][on]
            out[part] = total
        return out

    def _one(self, a: int, b: int) -> float:
        x, y = (slice(self.at[k], self.at[k + 1]) for k in (a, b))
        _, i, j = np.intersect1d(self.members[x], self.members[y], assume_unique=True, return_indices=True)
        return float(len(i)) if self.values is None else float(np.sum(self.values[x][i] * self.values[y][j]))
