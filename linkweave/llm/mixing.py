"""Mixing sources to target weights by quotas of blocks and a hypergeometric splitting tree.

Only DataFrame functions touch rows. Rows are written once with a number of their own, so that repeated
ids, also across sources, are told apart. A source's documents are permuted by a hash of their id; the
permuted order is cut into about sqrt(n) equal ranges of the hash, its blocks. The target of a source is
full passes over it and a rest; the rest takes whole blocks in permuted order, and of the one block in
which it ends the rows up to the boundary. No step gathers a source or an id in one task: sums run over
blocks (sqrt(n) rows) and over one block's rows, and a block that is large because an id repeats is cut
by ids and by ranges of that id's rows first.

The taken blocks are then dealt out to output shards by a tree. A node holds exact quotas of blocks per
source; its blocks are permuted and the permutation is cut between its children at their exact sizes, so
that every child's quotas are a multivariate hypergeometric draw from its parent's. The tree is a table
that grows by one level at a time (``split``): the permutation of a node is ranked in about sqrt(n)
ranges of its hash, so the root needs no single task either, and the number of sources and shards has no
bound. A shard's blocks are disjoint, and its rows are shuffled locally by hash. ``report`` counts the
rows dealt this way, ``mix`` has each row as often as it is dealt, and ``shuffled`` has them in their order.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source, last in order;
sources of size 0 have target 0; repeated rows each count as rows of their own, and are ordered by id
hash and a hash of the row number; a null id is an id; an empty table gives an empty result; other columns,
whatever their names, are kept by ``mix`` and ``shuffled``, ignored by ``report``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.sources.storage import materialise

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"
#: Words of a shard, and the bounds of the number of shards.
SHARD_WORDS = 4_000_000
LEAST_SHARDS, MOST_SHARDS = 16, 1 << 16
#: Children of a node of the tree.
FAN = 64
#: Rows of a block up to which one window decides what its source still takes.
WINDOW_ROWS = 1 << 20
#: Ranges in which the sources are ordered.
RANGES = 32


def words(text: Column) -> Column:
    """Number of words without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(id_col: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``name``: place of each row, from 0, in ``order``, by sorted ranges instead of one window over all rows."""
    ranges = df.repartitionByRange(RANGES, *order).withColumn("__range", F.spark_partition_id())
    ranges = materialise(ranges, "ranges")
    counts = ranges.groupBy("__range").agg(F.count("*").alias("__n"))  # at most RANGES rows
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__range", before.alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1 + F.col("__before")
    return ranges.join(F.broadcast(counts), "__range").withColumn(name, place.cast("long")).drop("__range", "__before")


def _level(plan: DataFrame, cap: int) -> float:
    """Words that a unit of weight gets. Sources below it get ``cap`` times their size: whole classes of equal
    ratio (to 1/256 of a power of two, so their number is bounded) are settled at once, and a class in
    which the level may lie by exact sums over the sources, until they stay the same."""
    ratio = cap * F.col("source_size") / F.col("weight")
    sums = (F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    classes = plan.groupBy(F.floor(F.log2(ratio) * 256).alias("class")).agg(*sums, F.min(ratio).alias("low"), F.max(ratio).alias("high")).collect()
    size, weight = sum(r["size"] for r in classes), sum(r.weight for r in classes)
    unit, at_level = 0.0, False
    for r in sorted(classes, key=lambda r: r.low):
        unit = size / weight
        if r.high >= unit:
            at_level = r.low < unit
            break
        size, weight = size - cap * r["size"], weight - r.weight
    full = -1
    while at_level:
        free = ratio >= unit
        row = plan.agg(F.sum("source_size").alias("size"), F.coalesce(F.sum(F.when(~free, cap * F.col("source_size"))), F.lit(0)).alias("capped"), F.sum(F.when(free, F.col("weight"))).alias("weight"), F.count_if(~free).alias("full")).first()
        if not row.weight or row.full == full:
            break
        unit, full = (row["size"] - row.capped) / row.weight, row.full
    return unit


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, n_docs -> also weight and target. Sources that would get more than ``cap`` times
    their size get that, and the rest is shared anew by weight until none is above."""
    rank = F.pmod(F.col("__rank"), F.lit(len(weights)))
    plan = ranked(sizes, [F.col("source").isNull(), F.col("source")], "__rank")
    plan = plan.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")).cast("long")).drop("__rank")
    unit = _level(plan, cap)
    free = cap * F.col("source_size") / F.col("weight") >= unit
    target = F.when(free, F.col("weight") * F.lit(unit)).otherwise((cap * F.col("source_size")).cast("double"))
    return plan.select("source", "source_size", "n_docs", "weight", target.cast("double").alias("target"))


def _blocks(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(n))).cast("long")


def _cut(rows: DataFrame, part: Column) -> DataFrame:
    """Rows with ``node`` and ``room``, the words that their node still takes in the order of ``part``. Adds
    ``left``, what is left of the room where the row's part begins, ``part_size``, ``part_rows`` and ``at``."""
    rows = rows.withColumn("part", part).withColumn("at", F.xxhash64("node", "part"))
    # grouped by one hash of node and part, so that partial sums are shuffled whatever the rows came from
    sums = rows.groupBy("at").agg(F.sum("size").alias("part_size"), F.count("*").alias("part_rows"), *(F.first(c).alias(c) for c in ("node", "part", "room")))
    so_far = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("part_size").over(so_far), F.lit(0))
    return rows.join(sums.select("at", "part_size", "part_rows", left.alias("left")), "at")


#: The room ends within the row's part.
_ENDS = "left > 0 and left < part_size"


def _take(df: DataFrame, row: Column, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], cap: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their block and how often they are taken, plan of the sources); ``row`` numbers the rows."""
    slim = df.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    docs = materialise(slim.withColumn("key", order_key(F.col("doc_id"), seed)), "mix")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = targets(sizes, weights, cap)
    passes = F.least(F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0))), F.lit(cap))
    named = plan.select(F.col("source").alias("s"), "source_size", "target", _blocks(F.col("n_docs")).alias("n_blocks"), passes.alias("passes"))
    # as many rows as sources; a source's many documents are split by adaptive execution
    docs = docs.join(named, docs["source"].eqNullSafe(named["s"])).drop("s")
    docs = docs.withColumn("sid", F.xxhash64("source", F.col("source").isNull())).withColumn("node", F.col("sid")).withColumn("room", F.col("target") - F.col("passes") * F.col("source_size"))
    spread = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    base = materialise(_cut(docs.drop("source"), F.shiftright(spread * F.col("n_blocks"), 32)).withColumnRenamed("part", "block"), "blocks")
    edge = _last_block(base.filter(_ENDS).select("row", "key", "size", F.col("at").alias("node"), F.col("left").alias("room"), "part_rows")).withColumnRenamed("row", "r")
    some = F.coalesce("some", (F.col("left") > 0).cast("int"))
    taken = base.join(edge, F.col("row") == F.col("r"), "left").withColumn("times", (F.col("passes") + some).cast("long"))
    return taken.select("row", "doc_id", "key", "size", "source_size", "target", "sid", "block", "times"), plan


def _last_block(edges: DataFrame) -> DataFrame:
    """row, some (1 if it is taken once more) of the rows of the blocks in which the room ends: in permuted order
    of the ids, and within an id by a hash of the row."""
    edges = materialise(edges, "edges")
    by_row = F.shiftrightunsigned(F.xxhash64("row"), 32)
    settled = []
    if (edges.agg(F.max("part_rows")).first()[0] or 0) > WINDOW_ROWS:
        # an id repeats so often that its block is too large for one window: first whole ids, then, of the id in
        # which the room ends, whole ranges of its rows; the order is the same
        for part in (F.col("key"), F.shiftright(by_row * _blocks(F.col("n_rows")), 32)):
            cut = _cut(edges.withColumnRenamed("part_rows", "n_rows"), part)
            settled.append(cut.filter(f"not ({_ENDS})").select("row", (F.col("left") > 0).cast("int").alias("some")))
            edges = cut.filter(_ENDS).select("row", "key", "size", F.col("at").alias("node"), F.col("left").alias("room"), "part_rows")
    within = Window.partitionBy("node").orderBy("key", by_row, "row").rowsBetween(Window.unboundedPreceding, -1)
    seen = edges.withColumn("seen", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # the row over the boundary is taken if that comes nearer to the target
    takes = (F.col("seen") < F.col("room")) & (F.col("seen") + F.col("size") / 2 <= F.col("room"))
    return reduce(DataFrame.unionByName, settled, seen.select("row", takes.cast("int").alias("some")))


def fans(shards: int) -> list[int]:
    """Children of a node on each level of a tree with at least ``shards`` leaves."""
    out = []
    while shards > 1:
        out.append(min(FAN, shards))
        shards = -(-shards // out[-1])
    return out


def split(units: DataFrame, levels: list[int], seed: str = SEED) -> DataFrame:
    """units: ``unit``, a number of its own, and other columns -> with ``mix_shard``, a leaf of the tree. On each
    level a node's units are permuted by a hash and cut at the exact sizes of its children."""
    now = units.withColumn("mix_shard", F.lit(0).cast("long"))
    for level, fan in enumerate(levels):
        if level:
            now = materialise(now, "tree")
        now = now.withColumn("h", F.xxhash64(F.lit(seed), F.lit(level), "unit"))
        sizes = now.groupBy("mix_shard").agg(F.count("*").alias("n"))
        now = now.join(sizes, "mix_shard").withColumn("bucket", F.shiftright(F.shiftrightunsigned("h", 32) * _blocks(F.col("n")), 32))
        counts = now.groupBy("mix_shard", "bucket").agg(F.count("*").alias("c"))
        so_far = Window.partitionBy("mix_shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.select("mix_shard", "bucket", F.coalesce(F.sum("c").over(so_far), F.lit(0)).alias("before"))
        inside = Window.partitionBy("mix_shard", "bucket").orderBy(F.shiftrightunsigned("h", 32), "h", "unit")
        now = now.join(counts, ["mix_shard", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
        now = now.withColumn("mix_shard", F.col("mix_shard") * fan + F.floor(F.col("rank") * fan / F.col("n")).cast("long")).select(*units.columns, "mix_shard")
    return now


def shard_count(plan: DataFrame) -> int:
    total = plan.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    return min(MOST_SHARDS, max(LEAST_SHARDS, -(-int(total) // SHARD_WORDS)))


def _deal(taken: DataFrame, seed: str, shards: int) -> DataFrame:
    """Each taken row once per copy, with its ``mix_shard`` and ``mix_order``."""
    copies = taken.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).withColumn("unit", F.xxhash64("sid", "copy", "block"))
    units = split(materialise(copies.select("unit", "sid").distinct(), "units"), fans(shards), seed)
    placed = copies.join(units.select("unit", "mix_shard"), "unit")
    return placed.withColumn("mix_order", F.md5(F.concat_ws(":", F.lit(seed), "mix_shard", "key", "copy", "row")))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, shards: int = 0) -> DataFrame:
    """``taken`` is counted over the rows dealt to shards (at least ``shards``, or as many as the targets fill)."""
    taken, plan = _take(df, F.monotonically_increasing_id(), id_col, text_col, source_col, weights, cap, seed)
    dealt = _deal(taken, seed, shards or shard_count(plan)).groupBy("row").agg(F.count("*").alias("dealt"))
    return taken.join(dealt, "row", "left").select("doc_id", "size", "source_size", "target", (F.coalesce("dealt", F.lit(0)) * F.col("size")).alias("taken"))


def _dealt(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], cap: int, seed: str, shards: int) -> tuple[DataFrame, int]:
    """Every row as often as it is taken, with ``__shard`` and ``__order``, and the number of shards. The rows
    are written with their numbers first, as a number must mean the same row each time it is read."""
    number, shard, order = _free(df, "__row"), _free(df, "__shard"), _free(df, "__order")
    own = materialise(df.withColumn(number, F.monotonically_increasing_id()), "mixrows", "zstd")
    taken, plan = _take(own, F.col(number), id_col, text_col, source_col, weights, cap, seed)
    shards = shards or shard_count(plan)
    placed = _deal(taken, seed, shards).select(F.col("row").alias(number), F.col("mix_shard").alias(shard), F.col("mix_order").alias(order))
    return own.join(placed, number).select(*df.columns, shard, order), shards


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, shards: int = 0) -> DataFrame:
    """The mix itself: each row as often as it is taken. With ``shards`` also ``mix_shard`` and ``mix_order``:
    the output shard by the splitting tree, and the place within it."""
    dealt, _ = _dealt(df, id_col, text_col, source_col, weights, cap, seed, shards)
    shard, order = dealt.columns[-2:]
    return dealt.withColumnsRenamed({shard: "mix_shard", order: "mix_order"}) if shards else dealt.select(df.columns)


def shuffled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, shards: int = 0) -> DataFrame:
    """The columns of ``df``, each shard's rows as one partition and in its order."""
    dealt, shards = _dealt(df, id_col, text_col, source_col, weights, cap, seed, shards)
    shard, order = dealt.columns[-2:]
    leaves = math.prod(fans(shards))
    return dealt.repartitionById(leaves, F.col(shard).cast("int")).sortWithinPartitions(shard, order).select(df.columns)
