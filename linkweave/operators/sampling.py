"""Folds that keep an entity together, and labelled samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

S1, CAND = "source1_entity_id", "candidate_entity_id"


def group_folds(df: DataFrame, folds: int = 5, key: str = S1) -> DataFrame:
    """The fold depends on the entity alone, so no entity is in two folds."""
    return df.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(folds)).cast("int"))


def negative_pool(cands: DataFrame, fraction: float, seed: int = 1) -> DataFrame:
    return cands.select("entity_id").sample(fraction=fraction, seed=seed)


def labelled_sample(s1: DataFrame, cands: DataFrame, truth: DataFrame, negatives: int = 3, seed: int = 0) -> DataFrame:
    """True pairs (label 1, score 0.9) and about ``negatives`` pairs per entity that are not true (label 0,
    score 0.2). Candidates are numbered in hash order within ``buckets``; an entity draws numbers, so
    nothing is crossed."""
    buckets = 1024
    spot = F.xxhash64("entity_id", F.lit(seed))
    ranked = cands.select("entity_id").distinct().withColumn("bucket", F.pmod(spot, F.lit(buckets)))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(spot, "entity_id")) - 1)
    sizes = ranked.groupBy("bucket").agg(F.count("*").alias("n"))
    filled = sizes.agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))  # at most 1024 numbers
    draws = s1.select(F.col("entity_id").alias(S1)).distinct().crossJoin(F.broadcast(filled)).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(negatives))))
    draws = draws.withColumn("bucket", F.get("buckets", F.pmod(F.xxhash64(S1, "draw", F.lit(seed)), F.size("buckets")).cast("int")))
    draws = draws.join(sizes, "bucket").withColumn("rank", F.pmod(F.xxhash64(S1, "draw", F.lit(seed + 1)), F.col("n")).cast("int"))
    drawn = draws.join(ranked, ["bucket", "rank"]).select(S1, F.col("entity_id").alias(CAND)).distinct()
    pairs = truth.select(S1, CAND).distinct()
    negative = drawn.join(pairs, [S1, CAND], "left_anti")
    mark = lambda df, signal, score, label: df.select(S1, CAND, F.lit(signal).alias("signal"), F.lit(score).alias("score"), F.lit(label).alias("label"))
    return mark(pairs.join(s1.select(F.col("entity_id").alias(S1)), S1, "left_semi"), "true_match", 0.9, 1).unionByName(mark(negative, "random_neg", 0.2, 0))
