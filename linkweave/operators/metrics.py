"""Entity-level quality, thresholds and their search.

Truth and predictions are pair tables. All figures come from per-entity counts of true, predicted and
hit pairs, so one aggregation by entity serves every metric.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkweave.operators.lists import group_ids, one_row_each
from linkweave.sources.storage import materialise

S1, CAND = "source1_entity_id", "candidate_entity_id"
MARGINS = ("1.0", "0.35", "0.25", "0.18", "0.12", "0.08", "0.05")


def f_half(hits: Column, n_true: Column, n_pred: Column) -> Column:
    """F0.5 of an entity: without true matches 1 for no prediction and 0 for any."""
    value = F.coalesce(F.try_divide(F.lit(1.25) * hits, F.lit(0.25) * n_true + n_pred), F.lit(0.0))
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0), 0.0).otherwise(value)


def entity_counts(all_s1: DataFrame, truth: DataFrame, pred: DataFrame) -> DataFrame:
    """n_true, n_pred, hits of every entity of ``all_s1``."""
    truth = truth.select(S1, CAND, F.lit(1).alias("t"), F.lit(0).alias("p"))
    pred = pred.select(S1, CAND, F.lit(0).alias("t"), F.lit(1).alias("p"))
    pair = truth.unionByName(pred).groupBy(S1, CAND).agg(F.max("t").alias("t"), F.max("p").alias("p"))
    per = pair.groupBy(S1).agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"), F.sum(F.col("t") * F.col("p")).alias("hits"))
    return all_s1.select(S1).distinct().join(per, S1, "left").fillna(0, ["n_true", "n_pred", "hits"])


def macro_f05(all_s1: DataFrame, truth: DataFrame, pred: DataFrame) -> DataFrame:
    """macro_f05, singleton_acc, non_singleton_f05 and counts, in one row."""
    scored = entity_counts(all_s1, truth, pred).withColumn("f", f_half(F.col("hits"), F.col("n_true"), F.col("n_pred")))
    single = F.col("n_true") == 0
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return scored.agg(mean("f").alias("macro_f05"), mean(F.when(single, F.col("f"))).alias("singleton_acc"), mean(F.when(~single, F.col("f"))).alias("non_singleton_f05"), F.count(F.lit(1)).alias("n_entities"), F.count_if(single).alias("n_singletons"))


def accepted(scored: DataFrame, threshold: float, margin: float = 1.0) -> DataFrame:
    """Pairs with prob at the threshold at least and within the margin of their entity's best.

    Differences are rounded to ten digits so that a margin met exactly is met on every machine."""
    best = F.max("prob").over(Window.partitionBy(S1))
    return scored.withColumn("__gap", F.round(best - F.col("prob"), 10)).filter((F.col("prob") >= threshold) & (F.col("__gap") <= margin)).drop("__gap")


def predictions(all_s1: DataFrame, scored: DataFrame, threshold: float, margin: float = 1.0) -> DataFrame:
    """matched_entity_ids of every entity, empty where nothing is accepted."""
    return one_row_each(all_s1, group_ids(accepted(scored, threshold, margin), S1, CAND, "matched_entity_ids"), S1, "matched_entity_ids")


def coarse_grid() -> list[tuple[Decimal, Decimal]]:
    return [(Decimal("0.30") + Decimal("0.02") * i, Decimal(1)) for i in range(32)]


def fine_grid(centre: Decimal) -> list[tuple[Decimal, Decimal]]:
    thresholds = [min(max(centre + Decimal("0.01") * i, Decimal("0.15")), Decimal("0.98")) for i in range(-6, 7)]
    return [(t, Decimal(m)) for t in thresholds for m in MARGINS]


def grid_scores(spark: SparkSession, all_s1: DataFrame, truth: DataFrame, scored: DataFrame, grid: list[tuple[Decimal, Decimal]]) -> DataFrame:
    """Macro F0.5 of every grid point. A grid has at most 91 points, so it rides along as an array; pairs
    below the lowest threshold go first (an entity's best stays if any of its pairs does), and entities
    without pairs enter as one number."""
    points = F.array(*[F.struct(F.lit(i).alias("g"), F.lit(float(t)).alias("threshold"), F.lit(float(m)).alias("margin")) for i, (t, m) in enumerate(grid)])
    best = F.max("prob").over(Window.partitionBy(S1))
    pairs = scored.select(S1, CAND, "prob").filter(F.col("prob") >= float(min(t for t, _ in grid))).withColumn("gap", F.round(best - F.col("prob"), 10))
    hits = truth.select(S1, CAND).distinct().withColumn("hit", F.lit(1))
    n_true = truth.select(S1, CAND).distinct().groupBy(S1).agg(F.count("*").alias("n_true"))
    entities = all_s1.select(S1).distinct().join(n_true, S1, "left").fillna(0, ["n_true"])
    met = pairs.join(hits, [S1, CAND], "left").withColumn("at", F.explode(F.filter(points, lambda x: (F.col("prob") >= x.threshold) & (F.col("gap") <= x.margin))))
    per = met.groupBy(S1, F.col("at.g").alias("g")).agg(F.count("*").alias("n_pred"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    won = per.join(entities, S1).withColumn("f", f_half(F.col("hits"), F.col("n_true"), F.col("n_pred")))
    # an entity without a prediction scores 1 if it is a singleton and 0 otherwise
    sums = won.groupBy("g").agg(F.sum("f").alias("f"), F.count_if(F.col("n_true") == 0).alias("met_singletons"))
    total = entities.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_true") == 0).alias("singletons"))
    table = spark.range(1).select(F.explode(points).alias("p")).select("p.*")
    joined = table.join(sums, "g", "left").crossJoin(total)  # one row of totals
    score = F.coalesce(F.try_divide(F.coalesce("f", F.lit(0.0)) + F.col("singletons") - F.coalesce("met_singletons", F.lit(0)), F.col("n")), F.lit(0.0))
    return joined.select("g", "threshold", "margin", score.alias("macro_f05"))


def best_point(scores: DataFrame) -> DataFrame:
    """The first of the best: a later point wins only if it is strictly better."""
    return scores.withColumn("macro_f05", F.round("macro_f05", 12)).orderBy(F.desc("macro_f05"), "g").limit(1)


def tune(all_s1: DataFrame, truth: DataFrame, scored: DataFrame) -> dict[str, float]:
    """Coarse search over thresholds, then a fine one over thresholds and margins around the winner."""
    spark = scored.sparkSession
    scored = scored.select(S1, CAND, "prob").cache()
    try:
        coarse = best_point(grid_scores(spark, all_s1, truth, scored, coarse_grid())).first()
        fine = best_point(grid_scores(spark, all_s1, truth, scored, fine_grid(Decimal(str(round(coarse.threshold, 3)))))).first()
    finally:
        scored.unpersist()
    won = fine if fine.macro_f05 > coarse.macro_f05 else coarse
    return {"abs_threshold": round(won.threshold, 3), "rel_margin": won.margin, "macro_f05": won.macro_f05}


def average_precision(scored: DataFrame, prob: str = "prob", label: str = "label") -> DataFrame:
    """Step-wise average precision. Counts per distinct score come first; the running sums go over them
    in two levels (within ranges of as many scores each, by sorted partitions, then over the ranges), so
    no window holds all scores, however they cluster."""
    points = scored.groupBy(F.col(prob).alias("p")).agg(F.sum(label).alias("tp"), F.count("*").alias("n"))
    points = materialise(points.repartitionByRange(64, "p").withColumn("range", F.spark_partition_id()), "scores")
    ranges = points.groupBy("range").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select("range", F.coalesce(F.sum("tp").over(above), F.lit(0)).alias("tp0"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("range").orderBy(F.desc("p"))
    steps = points.join(before, "range").select("tp", (F.col("tp0") + F.sum("tp").over(inside)).alias("ctp"), (F.col("n0") + F.sum("n").over(inside)).alias("cn"))
    return steps.agg(F.coalesce(F.try_divide(F.sum(F.col("tp") * F.col("ctp") / F.col("cn")), F.sum("tp")), F.lit(0.0)).alias("average_precision"))


def blocking_recall(s1: DataFrame, cands: DataFrame, truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Totals, pair recall, fully recalled entities, candidates per entity and reduction ratio in one row."""
    counts = entity_counts(s1.select(F.col("entity_id").alias(S1)), truth, pairs)
    universe = cands.select("entity_id").distinct().agg(F.count(F.lit(1)).alias("universe"))
    with_truth = F.col("n_true") > 0
    one = counts.agg(F.count(F.lit(1)).alias("s1_evaluated"), F.count_if(with_truth).alias("s1_with_truth"), F.sum("n_true").alias("true_pairs"), F.sum("hits").alias("found_pairs"), F.count_if(with_truth & (F.col("hits") == F.col("n_true"))).alias("fully_recalled"), F.sum("n_pred").alias("candidates"))
    one = one.crossJoin(universe)  # one row each
    avg = F.try_divide("candidates", "s1_evaluated")
    return one.select("s1_evaluated", "s1_with_truth", "true_pairs", "found_pairs", "fully_recalled", "candidates", F.try_divide("found_pairs", "true_pairs").alias("pair_recall"), F.try_divide("fully_recalled", "s1_with_truth").alias("entity_recall"), avg.alias("avg_candidates"), (1 - F.try_divide(avg, F.col("universe"))).alias("reduction_ratio"))


def missed_matches(truth: DataFrame, pairs: DataFrame, entities: DataFrame, n_s1: int = 10, per_s1: int = 3) -> DataFrame:
    """Truth that blocking misses, with both sides' text: the first entities and misses of each, a report."""
    missed = truth.select(S1, CAND).distinct().join(pairs, [S1, CAND], "left_anti")
    shown = missed.select(S1).distinct().orderBy(S1).limit(n_s1)
    order = Window.partitionBy(S1).orderBy(CAND)
    few = missed.join(shown, S1, "left_semi").withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= per_s1)
    text = lambda key, p: entities.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{p}_name"), F.col("business_address").alias(f"{p}_address"))
    return few.join(text(S1, "s1"), S1, "left").join(text(CAND, "cand"), CAND, "left").select(S1, CAND, "rn", "s1_name", "cand_name", "s1_address", "cand_address")


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    pos, neg = F.greatest(F.sum(label), F.lit(1)), F.count(F.lit(1)) - F.greatest(F.sum(label), F.lit(1))
    return df.agg(F.sum(label).alias("n_pos"), F.count(F.lit(1)).alias("n_rows"), F.least(F.greatest(F.sqrt(neg / pos), F.lit(1.0)), F.lit(10.0)).alias("scale_pos"))


def class_scale(n_pos: float, n_rows: float) -> float:
    """``scale_pos`` of known counts."""
    pos = max(n_pos, 1)
    return float(min(max(((n_rows - pos) / pos) ** 0.5, 1.0), 10.0))
