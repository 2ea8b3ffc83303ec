"""Candidate pairs from six equi-join signals, their union, score and top-K per entity.

S2 and S3 are one frame with a ``source`` column, so every signal is one join; caps and token
frequencies are taken per source and country. Keys are capped by partial counts before the join, which
bounds its output at ``cap`` squared per key; the pincode signal is uncapped by definition, and its
hot keys are left to adaptive skew splitting (both sides are plain exchanges). ``generate_candidates``
joins no pairs but scores them in their blocks (``best``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.similarity import indel_similarity, jaccard, levenshtein_similarity
from linkweave.operators.best import best_in_cells, cells
from linkweave.operators.lists import explode_tokens

CAP = 5000
NAME_TOKENS = 3
ADDRESS_TOKENS = 4
TOP_K = 100
#: In this order the first signal of a pair is kept.
SIGNALS = ("name_prefix", "name_char_prefix", "name_token", "addr_pincode", "addr_token", "name_concat")


def keys_within(df: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Rows whose key occurs at most ``cap`` times in ``df``. The few keys beyond the cap are taken out by an
    anti-join: they are at most one in ``cap`` rows, so adaptive execution can send them to the scan and
    a hot key's rows are dropped there instead of being shuffled to one task."""
    over = df.groupBy(*keys).count().filter(F.col("count") > cap).select(*keys)
    return df.join(over, keys, "left_anti")


def shared_keys(left: DataFrame, right: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Keys that occur on both sides, at most ``cap`` times on either."""
    few = [d.groupBy(*keys).count().filter(F.col("count") <= cap).select(*keys) for d in (left, right)]
    return few[0].join(few[1], keys)


def key_sides(s1: DataFrame, cands: DataFrame, key: str, cap: int | None = CAP) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides that have a key within the cap."""
    left = s1.filter(F.col(key) != "").select("entity_id", "country", key)
    right = cands.filter(F.col(key) != "").select("entity_id", "country", key, "source")
    if cap is not None:
        left = keys_within(left, ["country", key], cap)
        right = keys_within(right, ["source", "country", key], cap)
    return left, right


def key_signal(s1: DataFrame, cands: DataFrame, key: str, signal: str, cap: int | None = CAP) -> DataFrame:
    """Pairs that agree in country and a non-empty key."""
    return _pairs(*key_sides(s1, cands, key, cap), key, signal)


def _pairs(left: DataFrame, right: DataFrame, key: str, signal: str) -> DataFrame:
    left = left.select(F.col("entity_id").alias("source1_entity_id"), "country", key)
    right = right.select(F.col("entity_id").alias("candidate_entity_id"), "country", key)
    return left.join(right, ["country", key]).select("source1_entity_id", "candidate_entity_id", F.lit(signal).alias("signal"))


def token_frequency(index: DataFrame) -> DataFrame:
    """In how many entities of a source and country a token occurs."""
    return index.groupBy("source", "country", "token").agg(F.count("*").alias("freq"))


def rarest_tokens(df: DataFrame, tokens: str, k: int, cap: int = CAP) -> DataFrame:
    """The ``k`` rarest tokens of each entity among those that at most ``cap`` entities have; ties by token."""
    index = explode_tokens(df, "entity_id", tokens, "source", "country")
    keys = ["source", "country", "token"]
    rare = token_frequency(index).filter(F.col("freq") <= cap)
    order = Window.partitionBy("entity_id").orderBy("freq", "token")
    # what is left to join has at most ``cap`` rows per token
    ranked = keys_within(index, keys, cap).join(rare, keys).withColumn("rn", F.row_number().over(order))
    return ranked.filter(F.col("rn") <= k).select("entity_id", "source", "country", "token", "freq")


def token_signal(s1: DataFrame, cands: DataFrame, tokens: str, signal: str, k: int, cap: int = CAP) -> DataFrame:
    return _pairs(rarest_tokens(s1, tokens, k, cap), rarest_tokens(cands, tokens, k, cap), "token", signal)


def all_signals(s1: DataFrame, cands: DataFrame, cap: int = CAP, name_k: int = NAME_TOKENS, addr_k: int = ADDRESS_TOKENS, pincode_cap: int | None = None) -> DataFrame:
    """The bag of all signals' pairs."""
    found = [
        key_signal(s1, cands, "name_prefix_key", "name_prefix", cap),
        key_signal(s1, cands, "name_char_prefix", "name_char_prefix", cap),
        token_signal(s1, cands, "name_tokens", "name_token", name_k, cap),
        key_signal(s1, cands, "addr_pincode", "addr_pincode", pincode_cap),
        token_signal(s1, cands, "addr_tokens", "addr_token", addr_k, cap),
        key_signal(s1, cands, "name_concat_key", "name_concat", cap),
    ]
    return reduce(DataFrame.unionByName, found)


def first_signal(pairs: DataFrame) -> DataFrame:
    """Each pair once, with the first of its signals (a partial aggregate, before any scoring)."""
    order = F.create_map(*[F.lit(x) for i, s in enumerate(SIGNALS) for x in (s, i)])
    names = F.array(*map(F.lit, SIGNALS))
    least = pairs.groupBy("source1_entity_id", "candidate_entity_id").agg(F.min(F.try_element_at(order, F.col("signal"))).alias("o"))
    return least.select("source1_entity_id", "candidate_entity_id", F.element_at(names, F.col("o") + 1).alias("signal"))


def signal_counts(pairs: DataFrame) -> DataFrame:
    """Pairs per source and signal, before they are made distinct."""
    return pairs.groupBy(F.substring("candidate_entity_id", 1, 2).alias("source"), "signal").agg(F.count("*").alias("n_pairs"))


def score_pairs(pairs: DataFrame, s1: DataFrame, cands: DataFrame, native: bool = False) -> DataFrame:
    """0.7 * name similarity + 0.3 * address token Jaccard, from 0 to 100. The name similarity is the
    Indel ratio of canonical names (an Arrow UDF); ``native`` takes Levenshtein's instead."""
    a = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("name_canonical").alias("n1"), F.col("addr_tokens").alias("t1"))
    b = cands.select(F.col("entity_id").alias("candidate_entity_id"), F.col("name_canonical").alias("n2"), F.col("addr_tokens").alias("t2"))
    both = pairs.join(a, "source1_entity_id", "left").join(b, "candidate_entity_id", "left")
    none = F.array().cast("array<string>")
    n1, n2 = F.coalesce("n1", F.lit("")), F.coalesce("n2", F.lit(""))
    name: Column = F.when((n1 == "") | (n2 == ""), 0.0).otherwise(100 * levenshtein_similarity(n1, n2)) if native else indel_similarity(n1, n2)
    score = 0.7 * name + 30.0 * jaccard(F.coalesce("t1", none), F.coalesce("t2", none))
    return both.select("source1_entity_id", "candidate_entity_id", "signal", score.alias("score"))


def top_k(pairs: DataFrame, k: int = TOP_K, digits: int | None = None) -> DataFrame:
    """The best ``k`` candidates of each entity over all sources; ties by id."""
    score = F.col("score") if digits is None else F.round("score", digits)
    order = Window.partitionBy("source1_entity_id").orderBy(score.desc(), "candidate_entity_id")
    return pairs.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k).drop("rn")


def signal_keys(s1: DataFrame, cands: DataFrame, cap: int = CAP, name_k: int = NAME_TOKENS, addr_k: int = ADDRESS_TOKENS, pincode_cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """entity_id, o (the signal's place in SIGNALS), block of both sides: rows that agree in o and block are the
    pairs of ``all_signals``. A null country agrees with nothing."""
    columns = {"name_prefix": "name_prefix_key", "name_char_prefix": "name_char_prefix", "addr_pincode": "addr_pincode", "name_concat": "name_concat_key"}
    sides: tuple[list, list] = ([], [])
    for o, signal in enumerate(SIGNALS):
        if signal in columns:
            key, found = columns[signal], key_sides(s1, cands, columns[signal], pincode_cap if signal == "addr_pincode" else cap)
        else:
            key, k = "token", name_k if signal == "name_token" else addr_k
            found = tuple(rarest_tokens(df, signal.replace("token", "tokens"), k, cap) for df in (s1, cands))
        for side, df in zip(sides, found, strict=True):
            side.append(df.filter("country is not null").select("entity_id", F.lit(o).alias("o"), F.concat_ws("\x1f", "country", key).alias("block")))
    return reduce(DataFrame.unionByName, sides[0]), reduce(DataFrame.unionByName, sides[1])


def generate_candidates(s1: DataFrame, cands: DataFrame, k: int = TOP_K, native: bool = False, digits: int | None = None, **caps) -> DataFrame:
    """source1_entity_id, candidate_entity_id, signal, score of the normalised sources: the best ``k`` of each
    entity over all sources, ties by id. Pairs are scored in their blocks and only an entity's best of a block
    travel; where ids repeat, each pair of rows counts and the pairs are joined."""
    rows = s1.select("entity_id", F.lit(1).alias("side")).unionByName(cands.select("entity_id", F.lit(2).alias("side")))
    if not rows.groupBy("side", "entity_id").count().filter("count > 1").isEmpty():
        return top_k(score_pairs(first_signal(all_signals(s1, cands, **caps)), s1, cands, native), k, digits)
    blocks = cells(*signal_keys(s1, cands, **caps), s1, cands)
    found = best_in_cells(blocks, k, indel=not native, digits=digits).repartition("source1_entity_id")
    each = found.select("source1_entity_id", "o", F.inline(F.arrays_zip("candidate_entity_id", "score")))
    names = F.array(*map(F.lit, SIGNALS))
    once = each.groupBy("source1_entity_id", "candidate_entity_id").agg(F.min("o").alias("o"), F.first("score").alias("score"))
    return top_k(once.select("source1_entity_id", "candidate_entity_id", F.element_at(names, F.col("o") + 1).alias("signal"), "score"), k, digits)
