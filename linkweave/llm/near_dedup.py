"""Near duplicates by a chosen-path set similarity join.

1. One scan gives every document its number of distinct shingles, a hash of its whole shingle set and a
   sketch of minwise tokens. Documents with equal sets form a class, represented by its smallest id.
2. Ten trees: the root chooses sketch coordinates (always one, a second with probability
   1/lambda - 1, where lambda follows from the threshold, see ``branching``), and documents branch by their tokens there; nodes larger than ``NODE`` branch again,
   with coordinates chosen by the node's path. Small nodes are compared exhaustively on sketches, far
   below the threshold, and leave a spanning forest of the pairs that may be alike.
3. Components of that forest, if small, are compared on full sets in one task each. A larger one is cut
   into blocks that share its leader, which settles most of a group of copies. Documents that stay apart
   from the leader are compared with the others of their small nodes on their ``KEPT`` lowest shingle
   hashes, which are whole sets for most documents and far sharper than sketches for the others, so that
   hardly more pairs than the links come out; of these, the whole sets of shingle hashes travel. Nodes that
   are still large on the last level are compared so in blocks. A comparison is left out only if its two
   documents are known to be in one component already, so no link that could change a component is lost.

A pair at the threshold that meets none but large nodes down to the last level is missed with a chance
of at most ``MISS``, its sketch's deviation from the true similarity included (``missed``); links are
confirmed on full sets, by counts.

Defined results: null or empty texts (or only white space) have no shingles and are linked with
nothing; fewer words than the shingle's make one shingle; repeated rows with one id form one class and
each get a row; rows with a null id get their own row, component null, not kept; other columns are
ignored by ``near_duplicates`` and kept by ``drop_near``; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm import rolling as R
from linkweave.llm.batches import slices, small_batches, text_bytes, tidy
from linkweave.llm.components import components
from linkweave.sources.storage import materialise

SHINGLE = 5
COORDINATES = 64
TREES = 10
#: Greatest chance to miss a pair at the threshold in the deepest nodes.
MISS = 1e-4
#: Documents of a node that are compared with each other, at 256 bytes (a sketch) or 1 KB (lowest hashes) each.
NODE = 2048
DEPTH = 6
#: Chance that the sketches of a pair at the threshold agree so little that it isn't looked at again.
UNLIKE = 1e-6
#: Lowest shingle hashes by which pairs are looked at in the nodes of a large component.
KEPT = 256
#: Documents, and shingles, of a component that are compared in one task.
BLOCK = 512
BLOCK_SHINGLES = 300_000
PIECE_BYTES = 1 << 19
#: Rows of 16 bytes: at most 16 MB go to every executor.
BROADCAST_ROWS = 1 << 20
_FACTORS = np.random.default_rng(85).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def missed(threshold: float, branch: float, trees: int, depth: int) -> float:
    """Chance that no tree brings a pair at the threshold together in a node of the given depth. The sketch
    has a binomial number of equal coordinates; given it, a level keeps each branch with that share."""
    total = 0.0
    for k in range(COORDINATES + 1):
        apart = 0.0
        for _ in range(depth):
            together = k / COORDINATES * (1 - apart)
            apart = (1 - together) * (1 - (1 / branch - 1) * together)
        total += math.comb(COORDINATES, k) * threshold**k * (1 - threshold) ** (COORDINATES - k) * apart**trees
    return total


@functools.cache
def branching(threshold: float, trees: int, depth: int) -> float:
    """The greatest lambda, at most the threshold, in hundredths, that misses no more than ``MISS``; at
    least 0.5, where every node takes two coordinates."""
    steps = range(int(threshold * 100), 49, -1)
    return next((i / 100 for i in steps if missed(threshold, i / 100, trees, depth) <= MISS), 0.5)


@functools.cache
def alike(threshold: float, count: int = COORDINATES) -> int:
    """How many of ``count`` draws agree at least, but for ``UNLIKE``, by the binomial distribution."""
    less = 0.0
    for k in range(count + 1):
        less += math.comb(count, k) * threshold**k * (1 - threshold) ** (count - k)
        if less > UNLIKE:
            return k
    return count


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, ascending."""
    starts, ends, text_of = R.word_bounds(R.lower_ascii(data), offsets)
    hashes = R.window_hashes(R.prefix_hashes(R.lower_ascii(data)), starts, ends)
    prefix = R.prefix_hashes(hashes)
    at = R.in_one_text(text_of, size)
    count = np.bincount(text_of, minlength=len(offsets) - 1)
    short = np.flatnonzero((count > 0) & (count < size))
    first = np.searchsorted(text_of, short)
    begin = np.concatenate([at, first])
    values = R.window_hashes(prefix, begin, np.concatenate([at + size, first + count[short]]))
    owner = np.concatenate([text_of[at], short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], values[new]


def sketches(owner: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """Minwise tokens, one row per text that has shingles (others: zeros)."""
    out = np.zeros((texts, COORDINATES), np.uint32)
    if len(owner):
        present, first = np.unique(owner, return_index=True)
        for i, factor in enumerate(_FACTORS):
            out[present, i] = np.minimum.reduceat(((values * factor) >> np.uint64(32)).astype(np.uint32), first)
    return out


def _features(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = text_bytes(part.column(1))
                owner, values = shingles(data, offsets, size)
                n = np.bincount(owner, minlength=len(part))
                mixed, twice = R.mix(values), R.mix(values ^ np.uint64(0x5851F42D4C957F2D))
                one, two = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
                if len(owner):
                    present, first = np.unique(owner, return_index=True)
                    one[present], two[present] = np.add.reduceat(mixed, first), np.add.reduceat(twice, first)
                rows = sketches(owner, values, len(part))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "n", "h1", "h2", "sketch"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "doc_id long, n long, h1 long, h2 long, sketch binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _branch(rows: DataFrame, lam: float) -> DataFrame:
    """(node, class_id, sketch) -> (node, class_id) one level below."""

    def run(batches):
        for batch in batches:
            node = batch.column("node").to_numpy().view(np.uint64)
            matrix = _matrix(batch.column("sketch"))
            out_node, out_id = [], []
            ids = batch.column("class_id").to_numpy()
            for turn in range(2):
                draw = R.mix(node + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % (1 << 64)))
                coordinate = (draw % np.uint64(COORDINATES)).astype(np.int64)
                chosen = np.ones(len(node), bool) if turn == 0 else (R.mix(draw) >> np.uint64(11)) * 2.0**-53 < 1 / lam - 1
                token = matrix[np.arange(len(node)), coordinate].astype(np.uint64)
                below = R.mix(node ^ R.mix(token + (coordinate.astype(np.uint64) << np.uint64(40))))
                out_node.append(below[chosen].view(np.int64))
                out_id.append(ids[chosen])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_node)), pa.array(np.concatenate(out_id))], names=["node", "class_id"])

    return rows.select("node", "class_id", "sketch").mapInArrow(tidy(run), "node long, class_id long").distinct()


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Sets:
    """Union-find over positions."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _forest(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, class_id, sketch) of small nodes -> edges to the least of those whose sketches are alike, by any steps."""
    need = alike(threshold)

    def run(batches):
        for group in runs(batches, 1):
            ids, matrix = group.column("class_id").to_numpy(), _matrix(group.column("sketch"))
            tree = np.arange(len(ids))
            for i in range(len(ids) - 1):
                rest = np.flatnonzero(tree[i + 1 :] != tree[i]) + i + 1
                near = rest[(matrix[rest] == matrix[i]).sum(1) >= need]
                if len(near):
                    tree[np.isin(tree, tree[near])] = tree[i]
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, tree, ids)
            off = least[tree] != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids[off]), pa.array(least[tree][off])], names=["a", "b"])

    return rows.select("node", "class_id", "sketch").repartition("node").sortWithinPartitions("node").mapInArrow(tidy(run), "a long, b long")


def _candidates(reps: DataFrame, trees: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges whose components hold every pair that the trees bring together, and the nodes (node, class_id, large)
    of all levels."""
    node = reps.withColumn("node", F.explode(F.array(*[F.xxhash64(F.lit(f"tree-{t}")) for t in range(trees)])))
    lam = branching(threshold, trees, DEPTH)
    rows = materialise(_branch(node, lam), "nodes")
    levels: list[DataFrame] = []
    for depth in range(DEPTH):
        counts = materialise(rows.groupBy("node").count().filter("count > 1"), "counts")
        held = materialise(rows.join(counts, "node").select("node", "class_id", (F.col("count") > NODE).alias("large")), "held")
        levels.append(held if depth == DEPTH - 1 else held.filter("not large"))
        large = held.filter("large")
        if depth == DEPTH - 1 or large.isEmpty():
            break
        rows = materialise(_branch(large.join(reps, "class_id"), lam), "nodes")
    every_node = reduce(DataFrame.unionByName, levels)
    edges = _forest(every_node.filter("not large").join(reps, "class_id"), threshold)
    # they agree in all coordinates chosen along six levels: linked for the exact comparison
    last = levels[-1].filter("large")
    first = last.groupBy("node").agg(F.min("class_id").alias("b"))
    return edges.unionByName(last.join(first, "node").select(F.col("class_id").alias("a"), "b")), every_node


class _Group:
    """Shingle sets of a group's texts as codes, for exact intersections of one with all."""

    def __init__(self, texts: pa.ChunkedArray, size: int):
        counts, parts = [], []
        for chunk in texts.chunks:
            for part in slices(pa.RecordBatch.from_arrays([chunk], names=["text"]), 0, PIECE_BYTES):
                owner, values = shingles(*text_bytes(part.column(0)), size)
                counts.append(np.bincount(owner, minlength=len(part)))
                parts.append(values)
        self.n = np.concatenate(counts)
        every, code = np.unique(np.concatenate(parts), return_inverse=True)
        self.code = code.astype(np.int32)
        self.mark = np.zeros(len(every), bool)
        self.edge = np.concatenate([[0], np.cumsum(self.n)])

    def links(self, i: int, begin: int, least: int, most: int) -> np.ndarray:
        """The texts from ``begin`` on that are linked with text ``i``."""
        own = self.code[self.edge[i] : self.edge[i + 1]]
        self.mark[own] = True
        seen = np.concatenate([[0], np.cumsum(self.mark[self.code[self.edge[begin] :]])])
        self.mark[own] = False
        both = np.diff(seen[self.edge[begin:] - self.edge[begin]])
        return np.flatnonzero(most * both >= least * (self.n[i] + self.n[begin:] - both)) + begin


def _confirm(rows: DataFrame, size: int, least: int, most: int) -> DataFrame:
    """(comp, block, class_id, text) -> (comp, block, class_id, label), linked on full sets within a block."""

    def run(batches):
        for table in runs(batches, 2):
            ids = table.column("class_id").to_numpy()
            group, sets, count = _Group(table.column("text"), size), Sets(len(ids)), len(ids)
            open_sets = count
            for i in range(count - 1):
                if open_sets == 1:
                    break
                for j in group.links(i, i + 1, least, most).tolist():
                    open_sets -= sets.join(i, j)
            root = np.array([sets.find(i) for i in range(count)])
            label = np.full(count, np.iinfo(np.int64).max)
            np.minimum.at(label, root, ids)
            yield pa.RecordBatch.from_arrays([pa.array(table.column(0).combine_chunks().to_numpy()), pa.array(table.column(1).combine_chunks().to_numpy()), pa.array(ids), pa.array(label[root])], names=["comp", "block", "class_id", "label"])

    return rows.select("comp", "block", "class_id", "text").repartition("comp", "block").sortWithinPartitions("comp", "block").mapInArrow(tidy(run), "comp long, block long, class_id long, label long")


class _Lowest:
    """The lowest shingle hashes of some documents, by document and as postings."""

    def __init__(self, raw: list[bytes], n: np.ndarray):
        self.lists = [np.frombuffer(x, np.uint32) for x in raw]
        self.size = np.array([len(x) for x in self.lists], np.int64)
        self.whole = n <= self.size
        self.top = np.array([(1 << 32) - 1 if w else int(x[-1]) for x, w in zip(self.lists, self.whole)], np.int64)
        values = np.concatenate([*self.lists, np.zeros(0, np.uint32)])
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], np.repeat(np.arange(len(self.lists)), self.size)[order]

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many of ``own`` every document has."""
        begin = np.searchsorted(self.values, own, "left")
        count = np.searchsorted(self.values, own, "right") - begin
        at = np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)
        return np.bincount(self.owner[at], minlength=len(self.lists))

    def alike(self, own: np.ndarray, whole: bool, may: np.ndarray, least: int, most: int) -> np.ndarray:
        """The documents of ``may`` (a mask) that can be linked with the one that has ``own``. Up to the smaller of
        two tops both lists are complete, so their union there is a sample of the sets' union, and all of it
        if both sets are whole."""
        top = (1 << 32) - 1 if whole else int(own[-1])
        both = self.shared(own)
        mine = np.searchsorted(own, np.minimum(top, self.top), "right")
        need = np.where(self.whole & whole, least / most, alike(least / most, KEPT) / KEPT) - 1e-9
        some = np.flatnonzero(may & (both >= need * mine))
        theirs = np.array([self.size[j] if self.top[j] <= top else np.searchsorted(self.lists[j], top, "right") for j in some], np.int64)
        return some[both[some] >= need[some] * (mine[some] + theirs - both[some])]


def _lowest(rows: DataFrame, size: int) -> DataFrame:
    """(class_id, label, open, text) -> (class_id, label, open, n, low), n as the row itself has it."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 3, PIECE_BYTES):
                owner, values = shingles(*text_bytes(part.column(3)), size)
                edge = np.searchsorted(owner, np.arange(len(part) + 1))
                low = [(values[i : min(j, i + KEPT)] >> np.uint64(32)).astype(np.uint32).tobytes() for i, j in zip(edge, edge[1:])]
                out = pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(edge), pa.int64()), pa.array(low, pa.binary())], names=["class_id", "label", "open", "n", "low"])
                yield out.filter(pc.greater(out.column("n"), 0))

    return rows.select("class_id", "label", "open", "text").mapInArrow(tidy(run), "class_id long, label long, open boolean, n long, low binary")


def _apart(every_node: DataFrame, lowest: DataFrame, least: int, most: int, block: int) -> DataFrame:
    """(a, b) with a < b: pairs of a node whose labels differ, one of them open, that sizes and lowest hashes allow
    to be linked. lowest: class_id, label, open, n, low. Of a large node the open documents (side 1) meet
    all documents (side 0) in blocks; in a small node a document is on both sides (2) or not open (0)."""

    def run(batches):
        for group in runs(batches, 3):
            ids, label, n, side = (group.column(c).to_numpy() for c in ("class_id", "label", "n", "side"))
            raw = group.column("low").to_pylist()
            body = np.flatnonzero(side != 1)
            sets = _Lowest([raw[j] for j in body], n[body])
            a, b = [], []
            for i in np.flatnonzero(side > 0):
                may = (label[body] != label[i]) & (most * np.minimum(n[body], n[i]) >= least * np.maximum(n[body], n[i]))
                may &= (side[body] != 2) | (ids[body] > ids[i])  # else they meet from the other side
                if may.any():
                    own = np.frombuffer(raw[i], np.uint32)
                    near = ids[body[sets.alike(own, n[i] <= len(own), may, least, most)]]
                    a.append(np.minimum(near, ids[i]))
                    b.append(np.maximum(near, ids[i]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    # first the nodes of open documents, so that the others of a large group are not looked at elsewhere
    opened = lowest.filter("open").select("class_id", F.lit(True).alias("open")).distinct()
    asked = every_node.join(opened.select("class_id"), "class_id", "left_semi").select("node").distinct()
    rows = materialise(every_node.join(materialise(asked, "asked"), "node", "left_semi"), "askednodes")
    zero = F.lit(0).cast("long")
    small = rows.filter("not large").select("node", zero.alias("block"), zero.alias("part"), "class_id", F.lit(2).alias("side"))
    chunk = max(block, NODE)
    large = rows.filter("large").join(opened, "class_id", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    sizes = large.groupBy("node").agg(F.ceil(F.count("*") / chunk).alias("blocks"), F.ceil(F.count_if("open") / chunk).alias("parts"))
    large = large.join(materialise(sizes, "opennodes"), "node")
    every = lambda c: F.explode(F.sequence(zero, F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("class_id"), F.col(c))
    body = large.withColumn("block", own("blocks")).withColumn("part", every("parts")).withColumn("side", F.lit(0))
    probes = large.filter("open").withColumn("part", own("parts")).withColumn("block", every("blocks")).withColumn("side", F.lit(1))
    both = reduce(DataFrame.unionByName, (x.select("node", "block", "part", "class_id", "side") for x in (small, body, probes))).join(lowest, "class_id")
    both = both.withColumn("side", F.when(F.col("side") == 2, F.when(F.col("open"), 2).otherwise(0)).otherwise(F.col("side")))
    both = both.select("node", "block", "part", "class_id", "label", "n", "side", "low")
    return both.repartition("node", "block", "part").sortWithinPartitions("node", "block", "part").mapInArrow(tidy(run), "a long, b long").distinct()


def _linked(pairs: DataFrame, texts: DataFrame, size: int, least: int, most: int, block: int) -> DataFrame:
    """The pairs that are linked on full sets. The set of ``a`` meets those of its partners one by one; an ``a``
    with many partners meets them in several tasks."""

    def sets(batches):
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES):
                owner, values = shingles(*text_bytes(part.column(1)), size)
                edge = np.searchsorted(owner, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([values[i:j].tobytes() for i, j in zip(edge, edge[1:])], pa.binary())], names=["class_id", "hashes"])

    def run(batches):
        key, own = None, []
        for batch in batches:
            a, b = [], []
            for left, part, right, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (left, part) != key:
                    key, own = (left, part), []
                values = np.frombuffer(raw, np.uint64)
                if right is None:
                    own.append(values)
                    continue
                for x in own:
                    both = int(R.member(values, x).sum())
                    if most * both >= least * (len(x) + len(values) - both):
                        a.append(left)
                        b.append(right)
                        break
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    hashes = materialise(texts.select("class_id", "text").join(wanted, "class_id", "left_semi").mapInArrow(tidy(sets), "class_id long, hashes binary"), "hashes", "uncompressed")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / block).alias("parts"))
    cut = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    partners = cut.select("a", "part", "b").join(hashes, F.col("b") == F.col("class_id")).select("a", "part", "b", "hashes")
    first = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).join(hashes, F.col("a") == F.col("class_id"))
    rows = first.select("a", "part", F.lit(None).cast("long").alias("b"), "hashes").unionByName(partners)
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).mapInArrow(tidy(run), "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 85, most: int = 100, size: int = SHINGLE, trees: int = TREES, block: int = BLOCK) -> DataFrame:
    """One row per row: doc_id, n_shingles, class_id, component_id, kept. Linked: most * |A and B| >= least * |A or B|."""
    small_batches(df.sparkSession)
    found = materialise(_features(df, id_col, text_col, size), "sets")
    solid = found.filter("n > 0 and doc_id is not null")
    classes = materialise(solid.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("class_id")), "classes")
    reps = solid.select("doc_id", "sketch").join(classes.select("class_id"), F.col("doc_id") == F.col("class_id")).select("class_id", "sketch").dropDuplicates(["class_id"])
    reps = materialise(reps, "reps", "uncompressed")
    edges, every_node = _candidates(reps, trees, least / most)
    supers = components(edges)
    supers = materialise(supers.join(classes.select("class_id", "n"), F.col("id") == F.col("class_id")).select("label", "class_id", "n"), "supers")
    sizes = materialise(supers.groupBy("label").agg(F.count("*").alias("count"), F.sum("n").alias("total")), "sizes")
    share = F.greatest(F.col("count") / block, F.col("total") / BLOCK_SHINGLES)
    members = supers.join(sizes, "label").select(F.col("label").alias("comp"), "class_id", "n", F.when(share <= 2, 0).otherwise(F.ceil(share)).alias("blocks"))
    members = materialise(members.withColumn("block", F.when(F.col("blocks") > 0, F.pmod(F.xxhash64("class_id"), F.col("blocks"))).otherwise(0).cast("long")), "members")
    small = members.count() <= BROADCAST_ROWS
    texts = df.select(F.col(id_col).cast("long").alias("class_id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(members) if small else members, "class_id").drop("n")
    # the leader of a large component goes to each of its blocks
    here = F.when((F.col("blocks") > 0) & (F.col("class_id") == F.col("comp")), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    spread = texts.withColumn("home", F.col("block")).withColumn("block", F.explode(here))
    local = materialise(_confirm(spread, size, least, most), "local")
    links = local.select(F.col("class_id").alias("a"), F.col("label").alias("b"))
    large = members.filter("blocks > 0")
    if not large.isEmpty():
        # in a large component the leader has the smallest id, so what is linked to it has its label
        off = local.filter("label <> comp").join(large.select("class_id"), "class_id").select("comp").distinct()
        off = materialise(off, "open")
        if not off.isEmpty():
            labels = local.join(large.select("class_id"), "class_id").join(off, "comp", "left_semi")
            labels = materialise(labels.select("class_id", "label", (F.col("label") != F.col("comp")).alias("open")).distinct(), "labels")
            whose = texts.select("class_id", "text").join(F.broadcast(labels) if small else labels, "class_id")
            lowest = materialise(_lowest(whose, size), "lowest", "uncompressed")
            pairs = materialise(_apart(every_node, lowest, least, most, block), "pairs")
            links = links.unionByName(_linked(pairs, texts.filter("blocks > 0"), size, least, most, block))
        final = components(links)
    else:
        final = links.select(F.col("a").alias("id"), F.col("b").alias("label")).distinct()  # rows may repeat
    named = classes.join(final.withColumnRenamed("id", "i"), F.col("class_id") == F.col("i"), "left").select(F.col("n").alias("n_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), "class_id", "label")
    rows = found.select("doc_id", "n", "h1", "h2")
    out = rows.join(named, (F.col("n") == F.col("n_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")), "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("label", "class_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each component stays, with all its columns."""
    gone = near_duplicates(df, id_col, text_col, **how).filter("not kept and doc_id is not null").select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(gone, df[id_col] == gone["__gone"], "left_anti")
