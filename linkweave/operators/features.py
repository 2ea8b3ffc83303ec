"""Pairwise features and features of a candidate within its group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.operators.paired import compare
from linkweave.sources.storage import materialise

S1, CAND = "source1_entity_id", "candidate_entity_id"
FEATURES = ["feat_name_jaccard", "feat_name_overlap", "feat_addr_jaccard", "feat_addr_overlap", "feat_name_tfidf", "feat_addr_tfidf", "feat_name_levenshtein", "feat_name_jaro_winkler", "feat_addr_levenshtein", "feat_phonetic_match", "feat_pincode_match", "feat_country_match"]
GROUPED = 12


def entity_once(entities: DataFrame) -> DataFrame:
    """One row per id: the first by its attributes, so that the choice does not depend on row order."""
    order = Window.partitionBy("entity_id").orderBy("business_name", "business_address", "country")
    return entities.withColumn("__rn", F.row_number().over(order)).filter("__rn = 1").drop("__rn")


def attach(pairs: DataFrame, s1: DataFrame, cands: DataFrame) -> DataFrame:
    """Both sides' normalised attributes as s1_* and cand_*; missing text is '' and missing tokens are []."""
    names = ["name_canonical", "name_tokens", "addr_normalized", "addr_tokens", "addr_pincode", "country"]
    for side, df, key in (("s1_", s1, S1), ("cand_", cands, CAND)):
        pairs = pairs.join(df.select(F.col("entity_id").alias(key), *[F.col(n).alias(side + n) for n in names]), key, "left")
    fill = {side + n: F.coalesce(side + n, F.array().cast("array<string>") if n.endswith("tokens") else F.lit("")) for side in ("s1_", "cand_") for n in names if n != "country"}
    return pairs.withColumns(fill)


def weights(pairs: DataFrame, s1: DataFrame, cands: DataFrame, text: str) -> DataFrame:
    """entity_id -> map of L2-normed TF-IDF weights. Documents are the rows of ``pairs``, both sides, within
    a country, so an entity counts as often as it is paired: df is a sum of multiplicities over entities
    and the pairs themselves are never exploded into tokens."""
    sides = []
    for df, key in ((s1, S1), (cands, CAND)):
        times = pairs.groupBy(F.col(key).alias("entity_id")).agg(F.count("*").alias("m"))
        sides.append(times.join(df.select("entity_id", "country", F.col(text).alias("text")), "entity_id"))
    every = sides[0].unionByName(sides[1])
    size = every.groupBy("country").agg(F.sum("m").alias("n_docs"))
    tokens = every.select("entity_id", "country", "m", F.explode(F.filter(F.split("text", " "), lambda x: x != "")).alias("token"))
    tf = tokens.groupBy("entity_id", "country", "token").agg(F.count("*").alias("tf"), F.first("m").alias("m"))
    df_ = tf.groupBy("country", "token").agg(F.sum("m").alias("df"))
    weighted = tf.join(df_, ["country", "token"]).join(size, "country")
    weighted = weighted.withColumn("w", F.col("tf") * (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")))
    return weighted.groupBy("entity_id").agg(norm.alias("norm"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("token", "w")))).alias("raw")).select("entity_id", F.transform_values("raw", lambda _, v: v / F.col("norm")).alias("weights"))


def weighted(pairs: DataFrame, s1: DataFrame, cands: DataFrame, **texts: str) -> tuple[DataFrame, DataFrame]:
    """Both sides, written once, with a column of weights for each of ``texts``."""
    sides = s1, cands
    for name, text in texts.items():
        found = materialise(weights(pairs.select(S1, CAND), s1, cands, text), "weights").withColumnRenamed("weights", name)
        sides = tuple(df.join(found, "entity_id", "left") for df in sides)
    return materialise(sides[0], "s1"), materialise(sides[1], "cands")


def tfidf_cosine(pairs: DataFrame, s1: DataFrame, cands: DataFrame, text: str, name: str) -> DataFrame:
    """``pairs`` with the cosine of the two texts' weights."""
    return tfidf(pairs, s1, cands, feat_name_tfidf=text).withColumnRenamed("feat_name_tfidf", name)


def tfidf(pairs: DataFrame, s1: DataFrame, cands: DataFrame, **features: str) -> DataFrame:
    """``pairs`` with ``feat_name_tfidf`` or ``feat_addr_tfidf`` or both, each the cosine of the weights of a text; 0 where
    a side has no token. An id has one set of weights, whatever its rows."""
    pairs = materialise(pairs, "pairs")
    texts = {f.replace("feat_", "").replace("tfidf", "weights"): text for f, text in features.items()}
    sides = weighted(pairs, s1, cands, **texts)
    return compare(pairs, *[df.select("entity_id", *texts).dropDuplicates(["entity_id"]) for df in sides], list(features))


def build_features(pairs: DataFrame, s1: DataFrame, cands: DataFrame) -> DataFrame:
    """``pairs`` with the twelve features, in a fixed column order. Pairs and entities, which are read more than once,
    are written once."""
    pairs = materialise(pairs, "pairs")
    s1, cands = materialise(entity_once(s1), "s1"), materialise(entity_once(cands), "cands")
    return compare(pairs, *weighted(pairs, s1, cands, name_weights="name_canonical", addr_weights="addr_normalized"), FEATURES)


def group_context(df: DataFrame, columns: list[str], key: str = S1, limit: int = GROUPED) -> DataFrame:
    """Candidate count and, for the first ``limit`` columns, gap to the group's best, z-score and average
    rank over count. All windows share one partitioning; each rank needs a sort of its own."""
    group = Window.partitionBy(key)
    out = {"_grp_candidate_count": F.count(CAND).over(group)}
    for name in columns[:limit]:
        c = F.col(name)
        spread = F.coalesce(F.stddev_samp(c).over(group), F.lit(0.0))
        ties = F.count(F.lit(1)).over(Window.partitionBy(key, name))
        out[f"_grp_{name}_diff_max"] = c - F.max(c).over(group)
        out[f"_grp_{name}_zscore"] = (c - F.avg(c).over(group)) / (spread + 1e-5)
        out[f"_grp_{name}_pct_rank"] = F.when(c.isNotNull(), (F.rank().over(group.orderBy(c.asc_nulls_last())) + (ties - 1) / 2) / F.count(c).over(group))
    return df.withColumns(out)


def attach_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """label 1 for pairs that are in the truth."""
    marked = truth.select(S1, CAND).distinct().withColumn("__hit", F.lit(1))
    return pairs.join(marked, [S1, CAND], "left").withColumn("label", F.coalesce("__hit", F.lit(0))).drop("__hit")


def separation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of every feature by label, one row per feature."""
    means = df.groupBy("label").agg(*[F.avg(c).alias(c) for c in columns])
    long = means.unpivot(["label"], columns, "feature", "mean")
    return long.groupBy("feature").agg(F.max(F.when(F.col("label") == 0, F.col("mean"))).alias("mean_negative"), F.max(F.when(F.col("label") == 1, F.col("mean"))).alias("mean_positive"))
