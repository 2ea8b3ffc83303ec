"""Every operator as a query over the supplied tables, with SQL that must give the same rows.

Entities are derived from ``documents``: a third of the ids for each source, the first 60 characters as
name, the next 60 and a number as address. Queries that depend on caps or K are registered twice: under
their own name with small ones that bind on the smallest tables, and as ``*_full`` with production's. The
flagship, and the queries without SQL, run with production's only.
Doubles are rounded to six digits on both sides, and every top-K has a total order.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions import normalize as N
from linkweave.operators import blocking as B
from linkweave.operators import features as X
from linkweave.operators import lists as L
from linkweave.operators import metrics as M
from linkweave.operators import sampling as P
from linkweave.operators import validate as V
from linkweave.sources import tables as T
from linkweave.sources.storage import materialise

CAP, K, THRESHOLD, MARGIN = 20, 5, 0.45, 0.12
S1, CAND = "source1_entity_id", "candidate_entity_id"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


@dataclasses.dataclass(frozen=True)
class Limits:
    cap: int
    k: int


_limits: ContextVar[Limits] = ContextVar("limits", default=Limits(CAP, K))
FULL = Limits(B.CAP, B.TOP_K)


def query(f: Query) -> Query:
    _queries[f.__name__] = f
    return f


def within(limits: Limits) -> Callable[[Query], Query]:
    """The query with other limits, which hold while its plan is built."""

    def change(f: Query) -> Query:
        @functools.wraps(f)
        def run(spark, sf_dir):
            before = _limits.set(limits)
            try:
                return f(spark, sf_dir)
            finally:
                _limits.reset(before)

        return run

    return change


def capped(f: Query) -> Query:
    """Registered with the small limits and, as ``*_full``, with production's."""
    _queries[f"{f.__name__}_full"] = within(FULL)(f)
    return query(f)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from linkweave.plans import oracle

    return oracle.all_sql()


# --- shared inputs


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = (F.col("doc_id") % 3 + 1).cast("string")
    cut = lambda a: F.regexp_replace(F.substring("text", a, 60), r"\s\S*\z", "")
    return docs.select(
        F.concat(F.lit("S"), number, F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("entity_id"),
        F.concat(F.lit("S"), number).alias("source"),
        cut(1).alias("business_name"),
        F.concat(cut(61), F.lit(" "), (10000 + F.col("n_chars") % 90000).cast("string")).alias("business_address"),
        F.upper("lang").alias("country"),
        F.md5("text").alias("h"),
    )


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Normalised S1, and S2 and S3 together."""
    every = materialise(N.normalise(entities(spark, sf_dir)), "entities")
    return every.filter("source = 'S1'"), every.filter("source <> 'S1'")


def truth_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = entities(spark, sf_dir)
    a = every.filter("source = 'S1'").select(F.col("entity_id").alias(S1), "country", "h")
    b = every.filter("source <> 'S1'").select(F.col("entity_id").alias(CAND), "country", "h")
    return a.join(b, ["country", "h"]).select(S1, CAND)


def candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s1, cands = sides(spark, sf_dir)
    limits = _limits.get()
    pairs = B.generate_candidates(s1, cands, limits.k, native=True, digits=6, cap=limits.cap, name_k=3, addr_k=4)
    return materialise(pairs, "candidates"), s1, cands


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, _, _ = candidates(spark, sf_dir)
    return pairs.withColumn("prob", F.round(F.col("score") / 100, 6))


def all_s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(spark, sf_dir).filter("source = 'S1'").select(F.col("entity_id").alias(S1))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits; adding zero turns a negative zero into the other one."""
    return df.withColumns({n: F.round(n, 6) + F.lit(0.0) for n in names})


@within(FULL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records of the other sources may be the same entity as each S1 record?"""
    return candidate_lists_all_s1(spark, sf_dir)


# --- sources and shapes


@query
def source_entities(spark, sf_dir):
    return entities(spark, sf_dir)


@query
def source_counts(spark, sf_dir):
    return entities(spark, sf_dir).groupBy("source", "country").agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("n_ids"))


@query
def head_sample(spark, sf_dir):
    return T.head_sample(entities(spark, sf_dir).filter("country = 'EN'").select("entity_id", "business_name"), 25)


@query
def truth_restricted(spark, sf_dir):
    every = entities(spark, sf_dir)
    s1 = every.filter("source = 'S1' and country <> 'FR'")
    return T.restrict_truth(truth_pairs(spark, sf_dir), s1, every.filter("source = 'S2'")).select(S1, CAND)


@query
def try_cast_score(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("score"))
    return T.with_score(events)


@query
def entity_once(spark, sf_dir):
    every = entities(spark, sf_dir)
    twice = every.unionByName(every.withColumn("business_name", F.concat(F.lit("~"), "business_name")))
    return X.entity_once(twice).select("entity_id", "business_name")


@query
def has_non_latin(spark, sf_dir):
    return entities(spark, sf_dir).select("entity_id", N.has_non_latin(F.col("business_name")).alias("non_latin"))


# --- normalisation


@query
def norm_name(spark, sf_dir):
    df = N.add_name(entities(spark, sf_dir), "business_name")
    return df.select("entity_id", "name_canonical", F.array_join("name_tokens", ",").alias("name_tokens"), "name_first_token", "name_concat_key", "name_char_prefix", "name_prefix_key", "name_was_transliterated")


@query
def norm_address(spark, sf_dir):
    df = N.add_address(entities(spark, sf_dir), "business_address")
    return df.select("entity_id", "addr_normalized", "addr_pincode", "addr_state_abbr", F.array_join("addr_tokens", ",").alias("addr_tokens"))


@query
def pincode_extract(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.regexp_extract(F.lower("url"), r"\b(\d{5,6})\b", 1).alias("pincode_url"), F.regexp_extract(F.lower("html"), r"\b(\d{5,6})\b", 1).alias("pincode_html"))


# --- token index


@query
def explode_tokens(spark, sf_dir):
    return L.explode_tokens(N.add_name(entities(spark, sf_dir), "business_name"), "entity_id", "name_tokens")


@query
def token_freq(spark, sf_dir):
    index = L.explode_tokens(N.add_name(entities(spark, sf_dir), "business_name"), "entity_id", "name_tokens", "source", "country")
    return B.token_frequency(index)


@capped
def rarest_k_index(spark, sf_dir):
    return B.rarest_tokens(N.add_name(entities(spark, sf_dir), "business_name"), "name_tokens", 3, _limits.get().cap)


# --- blocking


@capped
def key_cap_filter(spark, sf_dir):
    s1, cands = sides(spark, sf_dir)
    return B.shared_keys(s1.filter("name_char_prefix <> ''"), cands.filter("name_char_prefix <> ''"), ["country", "name_char_prefix"], _limits.get().cap)


def _block(key: str, signal: str, is_capped: bool = True) -> None:
    def run(spark, sf_dir):
        s1, cands = sides(spark, sf_dir)
        return B.key_signal(s1, cands, key, signal, _limits.get().cap if is_capped else None)

    run.__name__ = f"block_{signal}"
    (capped if is_capped else query)(run)


_block("name_prefix_key", "name_prefix")
_block("name_char_prefix", "name_char_prefix")
_block("addr_pincode", "addr_pincode", is_capped=False)
_block("name_concat_key", "name_concat")


@capped
def block_name_token(spark, sf_dir):
    s1, cands = sides(spark, sf_dir)
    return B.token_signal(s1, cands, "name_tokens", "name_token", 3, _limits.get().cap)


@capped
def block_addr_token(spark, sf_dir):
    s1, cands = sides(spark, sf_dir)
    return B.token_signal(s1, cands, "addr_tokens", "addr_token", 4, _limits.get().cap)


@capped
def block_union_dedup(spark, sf_dir):
    s1, cands = sides(spark, sf_dir)
    return B.first_signal(B.all_signals(s1, cands, cap=_limits.get().cap))


@capped
def signal_counts(spark, sf_dir):
    s1, cands = sides(spark, sf_dir)
    return B.signal_counts(B.all_signals(s1, cands, cap=_limits.get().cap))


@capped
def candidates_topk(spark, sf_dir):
    return rounded(candidates(spark, sf_dir)[0], "score")


@capped
def candidates_indel_topk(spark, sf_dir):
    """Ranked by production's score, on the Indel ratio."""
    s1, cands = sides(spark, sf_dir)
    limits = _limits.get()
    return rounded(B.generate_candidates(s1, cands, limits.k, digits=6, cap=limits.cap), "score")


@capped
def candidate_lists_all_s1(spark, sf_dir):
    pairs, s1, _ = candidates(spark, sf_dir)
    return T.grouped_output(s1, pairs, "candidate_entity_ids")


@capped
def candidate_lists_by_score(spark, sf_dir):
    pairs, s1, _ = candidates(spark, sf_dir)
    lists = L.group_ids_by_score(rounded(pairs, "score"), S1, CAND, "score", "candidate_entity_ids")
    return L.one_row_each(s1.select(F.col("entity_id").alias(S1)), lists, S1, "candidate_entity_ids")


# --- features


def _compared(spark, sf_dir, *wanted):
    pairs, s1, cands = candidates(spark, sf_dir)
    return X.compare(pairs.select(S1, CAND), s1, cands, list(wanted))


@capped
def feat_jaccard_overlap(spark, sf_dir):
    names = [f"feat_{x}_{n}" for x in ("name", "addr") for n in ("jaccard", "overlap")]
    return rounded(_compared(spark, sf_dir, *names), *names)


@capped
def feat_tfidf_cosine(spark, sf_dir):
    pairs, s1, cands = candidates(spark, sf_dir)
    texts = {"feat_name_tfidf": "name_canonical", "feat_addr_tfidf": "addr_normalized"}
    return rounded(X.tfidf(pairs, s1, cands, **texts).select(S1, CAND, *texts), *texts)


@capped
def feat_levenshtein(spark, sf_dir):
    names = ["feat_name_levenshtein", "feat_addr_levenshtein"]
    return rounded(_compared(spark, sf_dir, *names), *names)


@capped
def feat_jaro_winkler(spark, sf_dir):
    return rounded(_compared(spark, sf_dir, "feat_name_jaro_winkler"), "feat_name_jaro_winkler")


@capped
def feat_match_flags(spark, sf_dir):
    return _compared(spark, sf_dir, "feat_pincode_match", "feat_country_match")


@query
@within(FULL)
def indel_score(spark, sf_dir):
    df = _compared(spark, sf_dir, "indel", "feat_addr_jaccard")
    score = 0.7 * F.col("indel") + 30.0 * F.col("feat_addr_jaccard")
    return rounded(df.select(S1, CAND, score.alias("score")), "score")


@query
@within(FULL)
def metaphone_match(spark, sf_dir):
    return _compared(spark, sf_dir, "feat_phonetic_match")


@query
@within(FULL)
def build_features(spark, sf_dir):
    pairs, s1, cands = candidates(spark, sf_dir)
    return rounded(X.build_features(pairs, s1, cands), "score", *[c for c in X.FEATURES if not c.endswith("match")])


@query
@within(FULL)
def feature_frame(spark, sf_dir):
    """All features but the phonetic one, which SQL lacks."""
    return build_features(spark, sf_dir).drop("feat_phonetic_match")


# --- group context, over line items of an order and candidates of an entity


def _lines(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias(CAND), F.col("l_quantity").alias("quantity"))


def _context(suffix: str) -> None:
    def run(spark, sf_dir):
        df = X.group_context(_lines(spark, sf_dir), ["quantity"], key="order_key")
        return rounded(df.select("order_key", CAND, f"_grp_quantity_{suffix}"), f"_grp_quantity_{suffix}")

    _queries[f"ctx_{suffix}"] = run


for _suffix in ("diff_max", "zscore", "pct_rank"):
    _context(_suffix)


@query
def ctx_count(spark, sf_dir):
    return X.group_context(_lines(spark, sf_dir), [], key="order_key").select("order_key", CAND, "_grp_candidate_count")


@capped
def ctx_candidates(spark, sf_dir):
    df = X.group_context(rounded(candidates(spark, sf_dir)[0], "score"), ["score"])
    return rounded(df.drop("signal"), "_grp_score_diff_max", "_grp_score_zscore", "_grp_score_pct_rank")


@capped
def attach_labels(spark, sf_dir):
    return X.attach_labels(candidates(spark, sf_dir)[0].select(S1, CAND), truth_pairs(spark, sf_dir))


@capped
def separation_report(spark, sf_dir):
    df = X.attach_labels(feat_jaccard_overlap(spark, sf_dir), truth_pairs(spark, sf_dir))
    return rounded(X.separation(df, ["feat_name_jaccard", "feat_addr_jaccard"]), "mean_negative", "mean_positive")


@query
def class_weight(spark, sf_dir):
    return rounded(M.class_weight(spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic"), "scale_pos")


@query
def fill_features(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("quality").cast("double")).alias("quality"))
    return L.fill_features(df, ["quality", "absent"])


# --- decisions and quality


@capped
def predict_threshold_margin(spark, sf_dir):
    return M.predictions(all_s1(spark, sf_dir), scored(spark, sf_dir), THRESHOLD, MARGIN)


@capped
def macro_f05(spark, sf_dir):
    out = M.macro_f05(all_s1(spark, sf_dir), truth_pairs(spark, sf_dir), M.accepted(scored(spark, sf_dir), THRESHOLD, MARGIN))
    return rounded(out, "macro_f05", "singleton_acc", "non_singleton_f05")


@capped
def tune_grid(spark, sf_dir):
    return rounded(M.grid_scores(spark, all_s1(spark, sf_dir), truth_pairs(spark, sf_dir), scored(spark, sf_dir), M.coarse_grid()), "threshold", "margin", "macro_f05")


@capped
def tune_grid_fine(spark, sf_dir):
    from decimal import Decimal

    return rounded(M.grid_scores(spark, all_s1(spark, sf_dir), truth_pairs(spark, sf_dir), scored(spark, sf_dir), M.fine_grid(Decimal("0.50"))), "threshold", "margin", "macro_f05")


@query
def average_precision(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").select((F.pmod(F.col("n_chars"), F.lit(1000)) / 1000).alias("prob"), F.col("toxic").alias("label"))
    return rounded(M.average_precision(df), "average_precision")


@capped
def blocking_recall(spark, sf_dir):
    pairs, s1, cands = candidates(spark, sf_dir)
    out = M.blocking_recall(s1, cands, truth_pairs(spark, sf_dir), pairs)
    return rounded(out, "pair_recall", "entity_recall", "avg_candidates", "reduction_ratio")


@capped
def missed_matches(spark, sf_dir):
    pairs, _, _ = candidates(spark, sf_dir)
    few = pairs.filter("signal = 'addr_token'")
    return M.missed_matches(truth_pairs(spark, sf_dir), few, entities(spark, sf_dir))


# --- validation and lists


def _broken(spark, sf_dir):
    """Grouped lists over customers with every kind of mistake in them."""
    k = F.col("c_custkey")
    one = F.concat(F.lit("S1-"), k.cast("string"))
    ids = F.when(k % 7 == 0, F.concat(F.lit("S2-"), k.cast("string"), F.lit(",S2-"), k.cast("string"))).when(k % 7 == 1, F.concat(F.lit("S1-"), k.cast("string"))).when(k % 7 == 2, F.lit("X-1, S3-9")).when(k % 7 == 3, F.lit("")).otherwise(F.concat(F.lit(" S2-"), k.cast("string"), F.lit(" , ,S3-"), k.cast("string")))
    grouped = spark.read.parquet(f"{sf_dir}/customer.parquet").select(one.alias(S1), ids.alias("candidate_entity_ids"), k.alias("k"))
    return grouped.unionByName(grouped.filter("k % 50 = 0")).filter("k % 11 <> 0")


@query
def validate_grouped(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 13 <> 0")
    wanted = customers.select(F.concat(F.lit("S1-"), F.col("c_custkey").cast("string")).alias("entity_id"))
    known = customers.select(F.explode(F.array(F.concat(F.lit("S2-"), F.col("c_custkey").cast("string")), F.concat(F.lit("S3-"), F.col("c_custkey").cast("string")))).alias("entity_id"))
    return V.violations(_broken(spark, sf_dir), "candidate_entity_ids", wanted, known)


@capped
def match_subset_antijoin(spark, sf_dir):
    pairs, _, _ = candidates(spark, sf_dir)
    even = pairs.filter("cast(substr(candidate_entity_id, 4) AS long) % 2 = 0")
    return V.outside_candidates(truth_pairs(spark, sf_dir), even.select(S1, CAND))


@query
def missing_and_extra_ids(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id")).filter("id % 3 <> 0")
    b = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("id")).distinct()
    return a.join(b, "id", "left_anti").select("id", F.lit("missing").alias("side")).unionByName(b.join(a, "id", "left_anti").select("id", F.lit("extra").alias("side")))


@query
def id_universe(spark, sf_dir):
    every = entities(spark, sf_dir)
    return every.filter("source = 'S2'").select("entity_id").union(every.filter("source = 'S3'").select("entity_id")).distinct()


@query
def expand_ids(spark, sf_dir):
    return L.explode_ids(_broken(spark, sf_dir), S1, "candidate_entity_ids")


@capped
def expand_ids_roundtrip(spark, sf_dir):
    pairs, s1, _ = candidates(spark, sf_dir)
    return L.explode_ids(T.grouped_output(s1, pairs, "ids"), S1, "ids")


@query
def id_sets(spark, sf_dir):
    return _broken(spark, sf_dir).select("k", F.array_join(L.id_set(F.col("candidate_entity_ids")), "|").alias("id_set"))


@capped
def group_fold_integrity(spark, sf_dir):
    folds = P.group_folds(candidates(spark, sf_dir)[0])
    per = folds.groupBy(S1).agg(F.count_distinct("fold").alias("n"), F.min("fold").alias("low"), F.max("fold").alias("high"))
    return per.agg(F.count("*").alias("n_entities"), F.max("n").alias("most_folds"), (F.min("low") >= 0).alias("low_fits"), (F.max("high") <= 4).alias("high_fits"))


# --- sampling and learning (rows only)


@query
def neg_sample(spark, sf_dir):
    every = entities(spark, sf_dir)
    return P.labelled_sample(every.filter("source = 'S1'"), every.filter("source <> 'S1'"), truth_pairs(spark, sf_dir))


def _learned(spark, sf_dir):
    from linkweave.plans.matcher import EntityMatcher

    pairs, s1, cands = candidates(spark, sf_dir)
    matcher = EntityMatcher()  # the job: all folds, families, columns and trees
    matcher.fit(materialise(X.build_features(pairs, s1, cands), "features"), truth_pairs(spark, sf_dir), all_s1(spark, sf_dir))
    return matcher


@query
@within(FULL)
def gbt_oof(spark, sf_dir):
    return _learned(spark, sf_dir).held_out.select(S1, CAND, "label", "prob")


@query
@within(FULL)
def feature_importance(spark, sf_dir):
    return spark.createDataFrame(_learned(spark, sf_dir).feature_importance(), "feature string, importance double")
