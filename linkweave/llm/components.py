"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.batches import tidy
from linkweave.sources.storage import materialise

#: Edges of a task that are thinned at once; fewer are not thinned.
EDGES = 1 << 16


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every ``EDGES`` edges those that join two components of the ones before: at most one less than ids."""
    up: dict[int, int] = {}
    seen = 0

    def root(i: int) -> int:
        while (j := up.setdefault(i, i)) != i:
            up[i] = up[j]
            i = up[i]
        return i

    for batch in batches:
        if seen > EDGES:
            up, seen = {}, 0
        seen += batch.num_rows
        keep = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b")), strict=True)):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
                keep[i] = True
        yield batch.filter(pa.array(keep))


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges of a written table with the same components. A group whose ids are all linked has edges by
    the square of its size; of ``EDGES`` at a time a spanning forest is left, as long as that halves them."""
    n = edges.count()
    while n > EDGES:
        fewer = materialise(edges.select("a", "b").coalesce(-(-n // EDGES)).mapInArrow(tidy(forest), edges.select("a", "b").schema), "forest")
        before, n = n, fewer.count()
        edges = fewer
        if 2 * n > before:
            break
    return edges


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    least = materialise(least, "least")
    return both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    least = materialise(least, "least")
    near = down.join(least, F.col("a") == F.col("k"))
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Edges (a, b) -> (id, label): label is the smallest id of the component; ids without edges are absent.

    A hub's edges are never gathered: the minimum of its neighbours is a partial aggregate, and it is
    written before it is joined back, so that adaptive execution may split the hub's edges.
    """
    now = thinned(materialise(edges.filter("a <> b").distinct(), "edges"))
    for _ in range(rounds):
        now = materialise(_small_star(_large_star(now).distinct()).distinct(), "edges")
        # settled when every id has one edge down, to an id that has none
        ends = now.select(F.col("a").alias("id"), F.lit(1).alias("down")).unionByName(now.select(F.col("b").alias("id"), F.lit(0).alias("down")))
        if ends.groupBy("id").agg(F.sum("down").alias("down"), F.min("down").alias("end")).filter("down > 1 or down = 1 and end = 0").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("label", F.col("id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(roots)
