"""Boosted trees, forests and logistic models of all folds, fitted together over packed rows.

Rows are written once, in blocks of columns, with their folds. A pass over the blocks serves every fold: trees add up
histograms of binned values, of a split's smaller side only, and the linear models gradients and Hessians. Sums are
made in Arrow batches; where those of all tasks are large they are added up piece by piece on the executors, so what the
driver gets is bounded, whatever the rows.
Draws depend on a row's hash, not on where it lies, so reruns agree.

The definitions are MLlib's: its splits, gains, weights, losses, early stopping and standardised penalty. The linear
models are Newton's optimum instead of the fiftieth step towards it, and values have 32 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.best import first_of, trim
from linkweave.sources.storage import discard, materialise

S1, CAND = "source1_entity_id", "candidate_entity_id"
MISSING = -999.0
#: Rows of a task that packs; what it writes is held as a whole.
TASK_ROWS = 40_000
#: Bins of a column, rows (about) that their bounds are found on, pieces of a sum, boosted trees between two writings of margins.
BINS, SAMPLE, PIECES, CARRIED = 32, 20_000, 12, 8
PACKED = f"n int, {S1} array<string>, {CAND} array<string>, label binary, fold binary, hash binary, moments binary, sample binary, values binary"
#: Bytes of all tasks' sums that the driver adds up itself; more are added up on the executors before.
GATHERED = 32 << 20
#: A positive row in a block's sum that counts rows as well.
POSITIVE = float(1 << 24)
#: Gains below it are rounding.
LEAST_GAIN = 1e-12


# --- rows


def context_names(columns: list[str], limit: int) -> list[str]:
    return ["_grp_candidate_count", *[f"_grp_{c}_{kind}" for c in columns[:limit] for kind in ("diff_max", "zscore", "pct_rank")]]


def dealt(df: DataFrame, grouped: bool, n_rows: int = 0) -> DataFrame:
    """Rows of an S1 entity together, if their context is wanted; in so many tasks that each has about ``TASK_ROWS`` of known many rows."""
    if not grouped:
        return df
    tasks = -(-n_rows // TASK_ROWS)
    enough = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartition(S1) if enough else df.repartition(tasks, S1)).sortWithinPartitions(S1)


def whole_groups(batches: Iterable[pa.RecordBatch], grouped: bool) -> Iterator[pa.Table]:
    """Tables of about a batch; those of ``grouped`` rows end where an S1 entity's rows end."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if not grouped:
            yield table
            continue
        low = 0
        if held:
            changed = np.flatnonzero(first_of(codes(pa.concat_arrays([held[-1][S1].combine_chunks()[-1:], batch.column(S1)])))[1:])
            if not len(changed):
                held.append(table)
                continue
            low = int(changed[0])
            yield pa.concat_tables([*held, table.slice(0, low)]).combine_chunks()
        last = int(np.flatnonzero(first_of(codes(batch.column(S1).slice(low))))[-1]) + low
        if last > low:
            yield table.slice(low, last - low).combine_chunks()
        held = [table.slice(last)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def codes(ids: pa.Array) -> np.ndarray:
    return ids.dictionary_encode(null_encoding="encode").indices.to_numpy()


def context(table: pa.Table, columns: list[str], limit: int) -> dict[str, np.ndarray]:
    """``features.group_context`` of whole groups that lie together; null is NaN."""
    starts = np.flatnonzero(first_of(codes(table[S1].combine_chunks())))
    size = np.diff(np.append(starts, table.num_rows))
    group = np.repeat(np.arange(len(starts)), size)
    out = {"_grp_candidate_count": np.add.reduceat(table[CAND].combine_chunks().is_valid().to_numpy(zero_copy_only=False).astype(np.float64), starts)[group]}
    with np.errstate(invalid="ignore", divide="ignore"):
        for name in columns[:limit]:
            column = table[name].combine_chunks()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            c = column.to_numpy(zero_copy_only=False).astype(np.float64)
            n = np.add.reduceat(known.astype(np.int64), starts)
            mean = np.add.reduceat(np.where(known, c, 0.0), starts) / n
            away = c - mean[group]
            spread = np.where(n > 1, np.sqrt(np.add.reduceat(np.where(known, away * away, 0.0), starts) / np.maximum(n - 1, 1)), 0.0)
            out[f"_grp_{name}_diff_max"] = c - np.maximum.reduceat(np.where(known, c, -np.inf), starts)[group]
            out[f"_grp_{name}_zscore"] = away / (spread[group] + 1e-5)
            state = np.where(known, np.isnan(c), 2).astype(np.int8)  # numbers, NaN, null
            value = np.where(state == 0, c, 0.0)
            order = np.lexsort((value, state, group))
            first = np.flatnonzero(first_of(group[order], state[order], value[order]))
            ties = np.diff(np.append(first, len(order)))
            rank = np.empty(len(order))
            rank[order] = np.repeat(first - starts[group[order[first]]] + 1 + (ties - 1) / 2, ties)
            out[f"_grp_{name}_pct_rank"] = np.where(known, rank / n[group], np.nan)
    return out


def filled(table: pa.Table, columns: list[str], found: dict[str, np.ndarray]) -> np.ndarray:
    """A row of 32-bit numbers for every column of ``found`` or ``table``; null, NaN and absent columns are ``MISSING``."""
    out = np.full((len(columns), table.num_rows), MISSING, dtype=np.float32)
    for k, name in enumerate(columns):
        if name in found or name in table.column_names:
            x = found[name] if name in found else table[name].to_numpy().astype(np.float64)
            out[k] = np.where(np.isnan(x), MISSING, x)
    return out


def pack(df: DataFrame, truth: DataFrame, columns: list[str], grouped: list[str], limit: int, folds: int, share: float, n_rows: int = 0) -> DataFrame:
    """Blocks of the rows of ``df``, which has ids, fold and ``columns``, save those that are the context of ``grouped``. Label 1
    for pairs that are in the truth, whose rows come along. A block has its ``moments`` and about ``share`` of its rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for both in whole_groups(batches, True):
            true = both["__true"].combine_chunks().to_numpy(zero_copy_only=False)
            entity = np.cumsum(first_of(codes(both[S1].combine_chunks())))
            # a null equals nothing
            key = np.where(both[S1].is_valid().to_numpy() & both[CAND].is_valid().to_numpy(), entity * (both.num_rows + 1) + codes(both[CAND].combine_chunks()), -1)
            label = (np.isin(key, key[true]) & (key >= 0)).astype(np.uint8)[~true]
            table = both.filter(pa.array(~true)).combine_chunks()
            if not table.num_rows:
                continue
            ends = pa.array([0, table.num_rows], type=pa.int32())
            ids = [pa.ListArray.from_arrays(ends, table[c].combine_chunks()) for c in (S1, CAND)]
            row = {"n": table.num_rows, "label": label.tobytes()} | {c: table[c].to_numpy().astype(kind).tobytes() for c, kind in (("fold", np.int16), ("hash", np.int64))}
            values = filled(table, columns, context(table, grouped, limit) if grouped else {})
            block = Block(row | {"values": values.tobytes()}, len(columns))
            kept = block.draw(0, 0) < share
            sample = np.vstack([values[:, kept], label[None, kept]]).astype(np.float32)
            small = [row["label"], row["fold"], row["hash"], moments(block, folds).tobytes(), sample.tobytes(), values.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([table.num_rows], type=pa.int32()), *ids, *[pa.array([x], type=pa.binary()) for x in small]], ["n", S1, CAND, "label", "fold", "hash", "moments", "sample", "values"])
        trim()

    made = context_names(grouped, limit) if grouped else []
    read = [F.col(c).cast("double").alias(c) for c in columns if c not in made]
    rows = df.select(S1, CAND, F.col("fold").cast("int").alias("fold"), F.xxhash64(S1, CAND).alias("hash"), F.lit(False).alias("__true"), *read)
    rows = rows.unionByName(truth.select(S1, CAND, F.lit(True).alias("__true")), allowMissingColumns=True)
    return materialise(dealt(rows, True, n_rows).mapInArrow(run, PACKED), "rows", "zstd")


class Block:
    """What a block has of ``values``, ``bins`` and ``margin``, a row of them for every column or fold."""

    def __init__(self, row: dict, n_columns: int):
        n = self.n = row["n"]
        self.row = row
        self.label, self.fold, self.hash = (np.frombuffer(row[c], dtype=kind) for c, kind in (("label", np.uint8), ("fold", np.int16), ("hash", np.int64)))
        self.values = np.frombuffer(row["values"], dtype=np.float32).reshape(n_columns, n) if "values" in row else None
        self.bins = np.frombuffer(row["bins"], dtype=np.uint8).reshape(n_columns, n) if "bins" in row else None
        self.margin = np.frombuffer(row["margin"], dtype=np.float64).reshape(-1, n) if "margin" in row else None

    def draw(self, *seed: int) -> np.ndarray:
        """A number from 0 to 1 for every row."""
        x = self.hash.view(np.uint64) + np.random.SeedSequence(seed).generate_state(1, np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            cells = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            yield {name: x.values if isinstance(x, pa.ListScalar) else x.as_py() for name, x in cells.items()}


def summed(df: DataFrame, n_columns: int, size: int, step: Callable[[Block, np.ndarray], None], *read: str) -> np.ndarray:
    """What ``step`` adds to ``size`` sums over all blocks."""
    edges = np.linspace(0, size, min(PIECES, size) + 1).astype(int)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for row in rows_of(batches):
            total = np.zeros(size) if total is None else total
            step(Block(row, n_columns), total)
        trim()
        if total is not None:
            pieces = [total[low:high].tobytes() for low, high in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), type=pa.int32()), pa.array(pieces, type=pa.binary())], ["piece", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for row in rows_of(batches):
            piece = np.frombuffer(row["sums"])
            held[row["piece"]] = held[row["piece"]] + piece if row["piece"] in held else piece
        yield pa.RecordBatch.from_arrays([pa.array(held, type=pa.int32()), pa.array([x.tobytes() for x in held.values()], type=pa.binary())], ["piece", "sums"])

    form = "piece int, sums binary"
    found = df.select("n", "label", "fold", "hash", *read).mapInArrow(part, form)
    if "tasks" not in vars(df):
        df.tasks = df.rdd.getNumPartitions()
    if df.tasks * size * 8 > GATHERED:  # one row a piece and task; the exchange is of fixed size
        found = found.repartition("piece").mapInArrow(add, form)
    out = np.zeros(size)
    for row in found.collect():
        out[edges[row.piece] : edges[row.piece + 1]] += np.frombuffer(row.sums)
    return out


def sampled(df: DataFrame, n_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Values by column, and labels, of the rows that were put apart."""
    kept = np.concatenate([np.frombuffer(r.sample, dtype=np.float32).reshape(n_columns + 1, -1) for r in df.select("sample").collect()], axis=1)
    kept = kept[:, np.lexsort(kept)]  # whatever the order of blocks
    return kept[:-1], kept[-1]


def bounds(sample: np.ndarray) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, from a sample of rows without their labels: halfway between neighbouring
    values, all of them where there are at most ``BINS``, else at about equal shares of the sample."""
    out = []
    for x in sample:
        values, counts = np.unique(x, return_counts=True)
        values = values.astype(np.float64)
        cut = np.arange(len(values) - 1)
        if len(values) > BINS:
            wanted, ends = np.arange(1, BINS) * len(x) / BINS, np.cumsum(counts)[:-1]
            after = np.clip(np.searchsorted(ends, wanted), 1, len(ends) - 1)
            cut = np.unique(after - (wanted - ends[after - 1] <= ends[after] - wanted))
        out.append((values[cut] + values[cut + 1]) / 2)
    return out


def binned(values: np.ndarray, limits: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(limit, x, "left").astype(np.uint8) for x, limit in zip(values, limits, strict=True)])


def write_bins(df: DataFrame, limits: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            bins = binned(Block(row, len(limits)).values, limits)
            yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("n", "label", "fold", "hash")} | {"bins": bins.tobytes()}], schema=pa.schema([("n", pa.int32()), *[(k, pa.binary()) for k in ("label", "fold", "hash", "bins")]]))

    return materialise(df.select("n", "label", "fold", "hash", "values").mapInArrow(run, "n int, label binary, fold binary, hash binary, bins binary"), "bins", "zstd")


# --- trees


class Tree:
    """Nodes as in a heap: those of ``i`` are 2i+1 (bin at most ``cut``) and 2i+2. ``column`` is -1 in a leaf."""

    def __init__(self, depth: int):
        self.depth, n = depth, 2 ** (depth + 1) - 1
        self.column, self.cut, self.value, self.gain = np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)

    def ends(self, bins: np.ndarray, rows: np.ndarray, ways: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes where some of ``rows`` end, and these; only by the nodes of ``ways``, if given. A node's rows are split at once."""
        open_ = [(0, rows)]
        while open_:
            node, at = open_.pop()
            if not len(at) or ways is not None and node not in ways:
                continue
            if self.column[node] < 0:
                yield node, at
            else:
                right = bins[self.column[node]][at] > int(self.cut[node])
                open_ += (2 * node + 2, at[right]), (2 * node + 1, at[~right])

    def predict(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros(bins.shape[1])
        for node, at in self.ends(bins, np.arange(len(out)) if rows is None else rows):
            out[at] = self.value[node]
        return out if rows is None else out[rows]

    def state(self) -> dict:
        return {"depth": self.depth, **{k: getattr(self, k).tolist() for k in ("column", "cut", "value", "gain")}}

    @classmethod
    def of(cls, state: dict) -> Tree:
        tree = cls(state["depth"])
        for k in ("column", "cut", "value", "gain"):
            setattr(tree, k, np.array(state[k]))
        return tree


class Growing(Tree):
    """A tree on its way. ``sums`` of a node are count, weight and weighted target by column and bin."""

    def __init__(self, depth: int, least: int, columns: Callable[[int], np.ndarray]):
        super().__init__(depth)
        self.least, self.columns = least, columns
        self.sums: dict[int, np.ndarray] = {}

    def split(self, node: int, sums: np.ndarray, purity: bool) -> tuple[int, int] | None:
        """Sets the node's value and best split; its children, or none for a leaf. ``purity``: of 0/1 targets."""
        n, w, g = sums
        chosen = self.columns(node)
        total_n, total_w, total_g = (x[chosen[0]].sum() for x in sums)
        self.value[node] = total_g / total_w if total_w > 0 else 0.0
        if node >= 2**self.depth - 1 or total_n < 2 * self.least or total_w <= 0 or purity and min(total_g, total_w - total_g) <= LEAST_GAIN * total_w:
            return None
        left = [np.cumsum(x[chosen], axis=1)[:, :-1] for x in sums]
        right = [t - x for t, x in zip((total_n, total_w, total_g), left, strict=True)]
        fits = (left[0] >= max(self.least, 1)) & (right[0] >= max(self.least, 1)) & (left[1] > 0) & (right[1] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, left[2] ** 2 / left[1] + right[2] ** 2 / right[1] - total_g**2 / total_w, -np.inf)
        best = int(np.argmax(gain))
        if not gain.flat[best] > LEAST_GAIN * total_w:
            return None
        i, cut = divmod(best, gain.shape[1])
        self.column[node], self.cut[node], self.gain[node] = chosen[i], cut, gain[i, cut]
        for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
            self.value[child] = side[2][i, cut] / side[1][i, cut]
        return (2 * node + 1, 2 * node + 2) if left[0][i, cut] <= right[0][i, cut] else (2 * node + 2, 2 * node + 1)


def places(tree: Tree, nodes: Iterable[int]) -> tuple[Tree, dict[int, int], set[int]]:
    """The splits of a tree on its way, the place of each of ``nodes``, and the nodes on the way to them."""
    partial, slots = Tree(tree.depth), {node: i for i, node in enumerate(nodes)}
    partial.column, partial.cut, ways = tree.column, tree.cut, set(slots)
    for node in slots:
        while node:
            node = (node - 1) // 2
            ways.add(node)
    return partial, slots, ways


def placed(found: tuple[Tree, dict[int, int], set[int]], bins: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``rows`` that end in one of the nodes, and its place."""
    tree, slots, ways = found
    parts = [(slots[node], at) for node, at in tree.ends(bins, rows, ways) if node in slots]
    if not parts:
        return rows[:0], rows[:0]
    return np.concatenate([at for _, at in parts]), np.repeat([slot for slot, _ in parts], [len(at) for _, at in parts])


def subset(size: int, n_columns: int, *seed: int) -> Callable[[int], np.ndarray]:
    return lambda node: np.sort(np.random.default_rng((*seed, node)).choice(n_columns, size, replace=False))


def residual(label: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    y = 2.0 * label - 1
    return y if margin is None else 4 * y / (1 + np.exp(np.clip(2 * y * margin, -700, 700)))


def boost(df: DataFrame, n_columns: int, folds: list[int], positive: float, *, trees: int, rate: float = 0.1, depth: int = 5, least: int = 25, share: float = 0.8, columns: float = 0.8, tolerance: float = 0.01, seed: int = 42) -> dict[int, list[Tree]]:
    """Boosted trees (logistic loss) of every fold, which its own rows stop. A fold's first tree weighs 1, the others ``rate``;
    leaves have the weight in them."""
    size = int(np.ceil(columns * n_columns))
    found: dict[int, list[Tree]] = {k: [] for k in folds}
    best: dict[int, tuple[float, int]] = {}
    open_, table, written = list(folds), df, 0

    def margins(block: Block, k: int, rows: np.ndarray, done: list[Tree], carried: int) -> np.ndarray | None:
        start = None if block.margin is None else block.margin[folds.index(k)][rows]
        for tree in done[carried:]:
            more = tree.predict(block.bins, rows)
            start = more if start is None else start + more
        return start

    def losses(now: list[int]) -> Callable[[Block, np.ndarray], None]:
        """Adds up the loss of folds' own rows, and their weight."""
        done, since = {k: found[k] for k in now}, written

        def step(block: Block, out: np.ndarray) -> None:
            for i, k in enumerate(now):
                held = np.flatnonzero(block.fold == k)
                y, w = 2.0 * block.label[held] - 1, np.where(block.label[held] == 1, positive, 1.0)
                out[2 * i] += np.sum(w * 2 * np.logaddexp(0, -2 * y * margins(block, k, held, done[k], since)))
                out[2 * i + 1] += np.sum(w)

        return step

    def stop(t: int, now: list[int], sums: np.ndarray) -> None:
        """Stops the folds whose last tree, the t-th, lowered their own rows' loss too little."""
        for k, (loss, weight) in zip(now, sums.reshape(-1, 2), strict=True):
            loss = loss / max(weight, 1e-300)
            if t == 0:
                best[k] = loss, 1
            elif best[k][0] - loss < tolerance * max(loss, 0.01):
                open_.remove(k)
            elif loss < best[k][0]:
                best[k] = loss, t + 1

    def read() -> list[str]:
        return ["bins", "margin"] if written else ["bins"]

    for t in range(trees):
        if t and t % CARRIED == 0:
            table, old = carry(table, n_columns, {k: found[k][written:] for k in folds}, folds, read()), table
            if written:
                discard(old)
            written = t
        growing = {k: Growing(depth, least, subset(size, n_columns, seed, k, t)) for k in open_}
        wanted: dict[int, list[int]] = {k: [0] for k in open_}
        pairs: dict[int, dict[int, int]] = {k: {} for k in open_}  # the larger child of each smaller one
        for level in range(depth):
            plans = {k: (places(growing[k], nodes), found[k]) for k, nodes in wanted.items() if nodes}
            if not plans:
                break
            now = list(open_) if t and not level else []  # the pass of a tree's root has the loss after the tree before
            sums, rest = histograms(table, n_columns, plans, margins, written, positive, share, (seed, t), losses(now), 2 * len(now), read())
            stop(t - 1, now, rest)
            for k in {*growing} - {*open_}:
                del growing[k], wanted[k], pairs[k]
            for k, nodes in wanted.items():
                tree, below, grown = growing[k], {}, []
                for node in nodes:
                    tree.sums[node] = sums[k][plans[k][0][1][node]]
                    if node in pairs[k]:
                        tree.sums[pairs[k][node]] = tree.sums.pop((node - 1) // 2) - tree.sums[node]
                        grown.append(pairs[k][node])
                    grown.append(node)
                for node in grown:
                    children = tree.split(node, tree.sums[node], False)
                    if children is None:
                        del tree.sums[node]
                    else:
                        below[children[0]] = children[1]
                pairs[k], wanted[k] = below, list(below)
        for k, tree in growing.items():
            done = Tree(depth)
            done.column, done.cut, done.gain, done.value = tree.column, tree.cut, tree.gain, tree.value * (rate if t else 1.0)
            found[k].append(done)
        if not open_:
            break
    if open_:
        now = list(open_)
        stop(trees - 1, now, summed(table, n_columns, 2 * len(now), losses(now), *read()))
    if written:
        discard(table)
    return {k: v[: best[k][1]] for k, v in found.items()}


def histograms(df: DataFrame, n_columns: int, plans: dict[int, tuple], margins: Callable, written: int, positive: float, share: float, seed: tuple[int, int], rest: Callable[[Block, np.ndarray], None], n_rest: int, read: list[str]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Count, weight and weighted residual of the rows that each fold draws, by place, column and bin; and what ``rest`` sums."""
    starts = np.concatenate([[0], np.cumsum([len(slots) * n_columns * BINS * 3 for (_, slots, _), _ in plans.values()])]).astype(int)

    def step(block: Block, out: np.ndarray) -> None:
        for i, (k, (found, done)) in enumerate(plans.items()):
            rows, slot = placed(found, block.bins, np.flatnonzero((block.fold != k) & (block.draw(*seed, k) < share)))
            if not len(rows):
                continue
            label = block.label[rows]
            value = residual(label, margins(block, k, rows, done, written)) * np.where(label == 1, positive, 1.0)
            both, base, n = 1 + label * POSITIVE, slot * BINS, len(found[1])
            sums = out[starts[i] : starts[i + 1]].reshape(n, 3, n_columns, BINS)
            for c in range(n_columns):
                at = base + block.bins[c][rows]
                counted = np.bincount(at, both, n * BINS).reshape(n, BINS)
                hits = np.floor(counted / POSITIVE)
                every = counted - hits * POSITIVE
                sums[:, 0, c] += every
                sums[:, 1, c] += every + (positive - 1) * hits
                sums[:, 2, c] += np.bincount(at, value, n * BINS).reshape(n, BINS)
        rest(block, out[starts[-1] :])

    sums = summed(df, n_columns, int(starts[-1]) + n_rest, step, *read)
    return {k: sums[starts[i] : starts[i + 1]].reshape(-1, 3, n_columns, BINS) for i, k in enumerate(plans)}, sums[starts[-1] :]


def carry(df: DataFrame, n_columns: int, trees: dict[int, list[Tree]], folds: list[int], read: list[str]) -> DataFrame:
    """The blocks with every fold's margin, so that finished trees aren't asked again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row, n_columns)
            margin = np.zeros((len(folds), block.n)) if block.margin is None else block.margin.copy()
            for i, k in enumerate(folds):
                for tree in trees[k]:
                    margin[i] += tree.predict(block.bins)
            yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("n", "label", "fold", "hash", "bins")} | {"margin": margin.tobytes()}], schema=pa.schema([("n", pa.int32()), *[(k, pa.binary()) for k in ("label", "fold", "hash", "bins", "margin")]]))

    return materialise(df.select("n", "label", "fold", "hash", *read).mapInArrow(run, "n int, label binary, fold binary, hash binary, bins binary, margin binary"), "margins", "zstd")


#: Chances of at most 0, 1, ... draws of a row that is drawn once on average.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 20)]))


def forest(df: DataFrame, n_columns: int, folds: list[int], positive: float, *, trees: int, depth: int = 6, least: int = 5, seed: int = 42) -> dict[int, list[Tree]]:
    """Trees of every fold by Gini impurity on rows drawn with replacement; a split looks at a root of the columns (one tree:
    all). Leaves have the weighted share of positive rows."""
    size = int(np.ceil(n_columns**0.5)) if trees > 1 else n_columns
    growing = {(k, t): Growing(depth, least, subset(size, n_columns, seed, k, t, 1)) for k in folds for t in range(trees)}
    wanted: dict[tuple[int, int], list[int]] = {key: [0] for key in growing}
    for level in range(depth):
        wanted = {key: nodes for key, nodes in wanted.items() if nodes}
        if not wanted:
            break
        starts = np.concatenate([[0], np.cumsum([len(nodes) * size * BINS * 2 for nodes in wanted.values()])]).astype(int)
        chosen = {key: np.stack([growing[key].columns(node) for node in nodes]) for key, nodes in wanted.items()}
        plans = {key: places(growing[key], nodes) for key, nodes in wanted.items()}

        def step(block: Block, out: np.ndarray, plans=plans, chosen=chosen, starts=starts) -> None:
            flat, n = block.bins.ravel(), block.n
            for i, ((k, t), found) in enumerate(plans.items()):
                draw = block.draw(seed, k, t, 1)
                rows, slot = placed(found, block.bins, np.flatnonzero((block.fold != k) & (draw >= POISSON[0])))
                if not len(rows):
                    continue
                both = np.searchsorted(POISSON, draw[rows], "right") * (1 + block.label[rows] * POSITIVE)
                total = out[starts[i] : starts[i + 1]].reshape(2, -1)
                for j in range(size):
                    at = (slot * size + j) * BINS + flat[(chosen[k, t][:, j] * n)[slot] + rows]
                    counted = np.bincount(at, both, total.shape[1])
                    hits = np.floor(counted / POSITIVE)
                    total += counted - hits * POSITIVE, hits

        sums = summed(df, n_columns, int(starts[-1]), step, "bins")
        below: dict[tuple[int, int], list[int]] = {}
        for i, (key, nodes) in enumerate(wanted.items()):
            n, hits = sums[starts[i] : starts[i + 1]].reshape(2, len(nodes), size, BINS)
            below[key] = []
            for slot, node in enumerate(nodes):
                every = np.zeros((3, n_columns, BINS))
                every[:, chosen[key][slot]] = n[slot], n[slot] + (positive - 1) * hits[slot], positive * hits[slot]
                below[key] += growing[key].split(node, every, True) or ()
        wanted = below
    out: dict[int, list[Tree]] = {k: [] for k in folds}
    for (k, _), tree in growing.items():
        done = Tree(depth)
        done.column, done.cut, done.value, done.gain = tree.column, tree.cut, tree.value, tree.gain
        out[k].append(done)
    return out


# --- linear models


def moments(block: Block, folds: int) -> np.ndarray:
    """By fold and label: rows, and sums of every column and of its square."""
    out = np.zeros((folds, 2, 1 + 2 * len(block.values)))
    x = block.values.astype(np.float64)
    for k in range(folds):
        for label in (0, 1):
            own = x[:, (block.fold == k) & (block.label == label)]
            out[k, label] = np.concatenate([[own.shape[1]], own.sum(axis=1), (own * own).sum(axis=1)])
    return out


def all_moments(df: DataFrame, n_columns: int, folds: int) -> np.ndarray:
    def step(block: Block, out: np.ndarray) -> None:
        out += np.frombuffer(block.row["moments"])

    return summed(df, n_columns, folds * 2 * (1 + 2 * n_columns), step, "moments").reshape(folds, 2, -1)


def logistic(df: DataFrame, n_columns: int, folds: list[int], positive: float, seen: np.ndarray, sample: tuple[np.ndarray, np.ndarray], *, penalty: float = 0.01, steps: int = 50, tolerance: float = 1e-5) -> dict[int, np.ndarray]:
    """Coefficients of every fold and, last, the intercept. All columns count by their weighted deviation in the fold's rows, for
    the penalty too. Newton's steps are first made on a sample, from there for the rows of all folds, and from there for each
    fold; so few of them read all rows, and where they end doesn't depend on the start. The error left is about the square of
    the last step, which is below ``tolerance``."""
    weight = np.array([1.0, positive])
    d = n_columns

    def scales(k: int | None) -> tuple[np.ndarray, np.ndarray, float]:
        rows = np.arange(len(seen)) != (-1 if k is None else k)
        by_label = seen[rows].sum(axis=0)
        total, squares = by_label[:, 0] @ weight, by_label[:, 0] @ weight**2
        mean = weight @ by_label[:, 1 : d + 1] / total
        spread = np.maximum(weight @ by_label[:, d + 1 :] / total - mean**2, 0) * total / max(total - squares / total, 1e-300)
        spread[spread <= 1e-13 * np.maximum(mean**2, 1e-300)] = 0  # rounding
        return mean, np.divide(1, np.sqrt(spread), out=np.zeros(d), where=spread > 0), total

    def newton(models: dict, start: dict[int | None, np.ndarray], over: Callable[[int, Callable], np.ndarray]) -> dict[int | None, np.ndarray]:
        """Models by the fold whose rows they don't see, in scaled columns."""
        at = {k: start[k].copy() for k in models}
        last: dict = {}
        open_ = list(models)
        for _ in range(steps):
            now, tried = list(open_), {k: at[k].copy() for k in open_}
            width = 1 + (d + 1) + (d + 1) ** 2

            def step(block: Block, out: np.ndarray, now=now, tried=tried, width=width) -> None:
                y = block.label.astype(np.float64)
                w = np.where(block.label == 1, positive, 1.0)
                raw = np.vstack([block.values, np.ones((1, block.n))])
                raw[:d] -= centre[:, None]
                raw[:d] *= scale[:, None]
                for i, k in enumerate(now):
                    rows = slice(None) if k is None else np.flatnonzero(block.fold != k)
                    x, t, v = raw[:, rows], y[rows], w[rows]
                    z = tried[k] @ x
                    p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                    sums = out[i * width : (i + 1) * width]
                    sums[0] += np.sum(v * (np.logaddexp(0, z) - t * z))
                    sums[1 : d + 2] += x @ (v * (p - t))
                    sums[d + 2 :] += ((x * (v * p * (1 - p))) @ x.T).ravel()

            sums = over(len(now) * width, step).reshape(len(now), width)
            for k, found in zip(now, sums, strict=True):
                keep, total = models[k]
                b = at[k]
                loss = found[0] / total + np.sum(keep * b**2) / 2
                if k in last and loss > last[k][0] + 1e-12 * abs(last[k][0]):  # too far: half the way
                    before, way = last[k][1], last[k][2] / 2
                    last[k] = last[k][0], before, way
                    at[k] = before + way
                else:
                    slope = found[1 : d + 2] / total + keep * b
                    bend = found[d + 2 :].reshape(d + 1, d + 1) / total + np.diag(keep)
                    fixed = np.append(scale == 0, False)
                    bend[fixed], bend[:, fixed], slope[fixed] = 0, 0, 0
                    bend[fixed, fixed] = 1
                    way = -np.linalg.lstsq(bend, slope, rcond=None)[0]
                    last[k] = loss, b, way
                    at[k] = b + way
                if np.abs(last[k][2]).max() < tolerance:
                    open_.remove(k)
            if not open_:
                break
        return at

    centre, scale, total = scales(None)
    # in the columns' common scale, a fold's penalty of a coefficient is by the square of the scales' ratio
    every = np.append(np.where(scale > 0, penalty, 0), 0)
    few = Block({"n": len(sample[1]), "label": sample[1].astype(np.uint8).tobytes(), "fold": b"", "hash": b"", "values": np.ascontiguousarray(sample[0]).tobytes()}, d)
    weighed = np.where(few.label == 1, positive, 1.0).sum()
    start = newton({None: (every, weighed)}, {None: np.zeros(d + 1)}, lambda size, step: once(step, few, size))[None] if few.n else np.zeros(d + 1)
    over = lambda size, step: summed(df, d, size, step, "values")
    common = newton({None: (every, total)}, {None: start}, over)[None]
    models = {}
    for k in folds:
        _, own, total = scales(k)
        ratio = np.divide(scale, own, out=np.ones(d), where=own > 0)  # constant in the fold's rows: held near 0
        models[k] = np.append(np.where(scale > 0, penalty * ratio**2, 0), 0), total
    found = newton(models, dict.fromkeys(folds, common), over)
    return {k: np.append(b[:d] * scale, b[d] - np.sum(b[:d] * scale * centre)) for k, b in found.items()}


def once(step: Callable[[Block, np.ndarray], None], block: Block, size: int) -> np.ndarray:
    out = np.zeros(size)
    step(block, out)
    return out


# --- probabilities


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def probability(family: str, model: list[Tree] | np.ndarray, values: np.ndarray, bins: np.ndarray) -> np.ndarray:
    if family == "linear":
        return sigmoid(model[:-1] @ values.astype(np.float64) + model[-1])
    total = np.sum([tree.predict(bins) for tree in model], axis=0)
    return sigmoid(2 * total) if family == "gbt" else total / len(model)


def held_out(df: DataFrame, limits: list[np.ndarray], models: dict[str, dict[int, list[Tree] | np.ndarray]]) -> DataFrame:
    """Every row's ids, label and ``prob_*`` by the models of its own fold, which haven't seen it; rows of other folds are left out."""
    known = sorted(set.intersection(*[set(m) for m in models.values()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block({k: v for k, v in row.items() if k not in (S1, CAND)}, len(limits))
            probs = {f: np.zeros(block.n) for f in models}
            for k in known:
                own = np.flatnonzero(block.fold == k)
                if len(own):
                    values = block.values[:, own]
                    bins = binned(values, limits)
                    for f, by_fold in models.items():
                        probs[f][own] = probability(f, by_fold[k], values, bins)
            out = pa.RecordBatch.from_arrays([row[S1], row[CAND], pa.array(block.label.astype(np.float64)), *[pa.array(x) for x in probs.values()]], [S1, CAND, "label", *[f"prob_{f}" for f in probs]])
            yield out.filter(pa.array(np.isin(block.fold, known)))

    return df.mapInArrow(run, f"{S1} string, {CAND} string, label double, " + ", ".join(f"prob_{f} double" for f in models))
