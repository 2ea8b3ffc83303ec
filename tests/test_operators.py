"""Blocking, features, quality and validation on small frames; pandas where pandas is the definition."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkweave.functions.normalize import normalise
from linkweave.operators import blocking as B
from linkweave.operators import features as X
from linkweave.operators import lists as L
from linkweave.operators import metrics as M
from linkweave.operators import sampling as P
from linkweave.operators import validate as V

ROWS = [
    ("S1-1", "Liberty Family Office", "12 Rose Street, 60601", "US"),
    ("S1-2", "Acme Traders", "", "US"),
    ("S1-3", "Lone Wolf", "9 Far Away", "IN"),
    ("S2-1", "Office of Liberty Family", "12 Rose St 60601", "US"),
    ("S2-2", "Acme Traders Inc", "", "US"),
    ("S3-1", "Acme Traders", "", "IN"),
    ("S3-2", "Liberty Bakery", "1 Oak Ave 60601", "US"),
]
PAIRS = "source1_entity_id string, candidate_entity_id string"


@pytest.fixture(scope="module")
def sides(spark):
    df = spark.createDataFrame(ROWS, "entity_id string, business_name string, business_address string, country string").selectExpr("*", "substring(entity_id, 1, 2) AS source")
    every = normalise(df).cache()
    return every.filter("source = 'S1'"), every.filter("source <> 'S1'")


def found(df):
    return {(r[0], r[1]) for r in df.select("source1_entity_id", "candidate_entity_id").collect()}


def test_signals_stay_in_their_country(sides):
    pairs = found(B.all_signals(*sides))
    assert ("S1-1", "S2-1") in pairs and ("S1-2", "S2-2") in pairs
    assert not any(c == "S3-1" for _, c in pairs)


def test_first_signal_wins_and_pairs_are_distinct(sides):
    rows = B.first_signal(B.all_signals(*sides)).collect()
    assert len(rows) == len({(r[0], r[1]) for r in rows})
    assert {r.signal for r in rows if r[1] == "S2-2"} == {"name_prefix"}


def test_pincode_is_uncapped_and_others_are_not(sides):
    assert found(B.key_signal(*sides, "addr_pincode", "addr_pincode", None)) == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
    assert found(B.key_signal(*sides, "name_prefix_key", "name_prefix", 0)) == set()


def test_rarest_tokens_break_ties_by_token(sides):
    rows = B.rarest_tokens(sides[0], "name_tokens", 2).filter("entity_id = 'S1-1'").collect()
    assert sorted(r.token for r in rows) == ["family", "liberty"]


def test_score_and_top_k(sides):
    s1, cands = sides
    scored = B.score_pairs(B.first_signal(B.all_signals(s1, cands)), s1, cands)
    rows = {(r[0], r[1]): r.score for r in scored.collect()}
    assert rows["S1-2", "S2-2"] == pytest.approx(70.0)  # equal names, no address tokens
    assert B.top_k(scored, 1).groupBy("source1_entity_id").count().filter("count > 1").isEmpty()


def test_features_are_twelve_and_in_order(sides):
    s1, cands = sides
    df = X.build_features(B.generate_candidates(s1, cands), s1, cands)
    assert df.columns == ["source1_entity_id", "candidate_entity_id", "signal", "score", *X.FEATURES]
    row = df.filter("candidate_entity_id = 'S2-2'").first()
    assert row.feat_addr_levenshtein == 1.0 and row.feat_addr_jaccard == 0.0 and row.feat_addr_tfidf == 0.0
    assert row.feat_name_tfidf == pytest.approx(1.0) and row.feat_country_match == 1 and row.feat_phonetic_match == 1


def test_tfidf_counts_pairs_not_entities(spark, sides):
    import math

    s1, cands = sides
    pairs = spark.createDataFrame([("S1-2", "S2-2"), ("S1-1", "S2-1"), ("S1-1", "S3-2")], PAIRS)
    got = {(r[0], r[1]): r.c for r in X.tfidf_cosine(pairs, s1, cands, "name_canonical", "c").collect()}
    texts = {r.entity_id: r.name_canonical.split() for r in s1.unionByName(cands).collect()}
    docs = [texts[e] for p in [("S1-2", "S2-2"), ("S1-1", "S2-1"), ("S1-1", "S3-2")] for e in p]
    idf = lambda t: math.log((1 + len(docs)) / (1 + sum(t in d for d in docs))) + 1
    vec = lambda d: {t: d.count(t) * idf(t) for t in set(d)}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for (a, b), c in got.items():
        u, v = vec(texts[a]), vec(texts[b])
        assert c == pytest.approx(sum(u[t] * v.get(t, 0) for t in u) / (norm(u) * norm(v)))


def test_group_context_same_as_pandas(spark):
    frame = pd.DataFrame({"source1_entity_id": list("aaaabbc"), "candidate_entity_id": list("1234123"), "x": [1.0, 2.0, 2.0, 5.0, 3.0, None, 7.0]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)], PAIRS + ", x double")
    got = X.group_context(df, ["x"]).toPandas().sort_values(["source1_entity_id", "candidate_entity_id"]).reset_index(drop=True)
    group = frame.groupby("source1_entity_id").x
    assert got["_grp_x_pct_rank"].tolist()[:4] == [0.25, 0.625, 0.625, 1.0]
    pd.testing.assert_series_equal(got["_grp_x_pct_rank"], group.rank(pct=True, method="average"), check_names=False)
    expected = (frame.x - group.transform("mean")) / (group.transform("std").fillna(0) + 1e-5)
    pd.testing.assert_series_equal(got["_grp_x_zscore"], expected, check_names=False)
    assert got["_grp_candidate_count"].tolist() == [4, 4, 4, 4, 2, 2, 1]


def test_f_half_cases(spark):
    s1 = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "source1_entity_id string")
    truth = spark.createDataFrame([("c", "x"), ("c", "y"), ("d", "z")], PAIRS)
    pred = spark.createDataFrame([("b", "x"), ("c", "x"), ("c", "q"), ("zz", "x")], PAIRS)
    row = M.macro_f05(s1, truth, pred).first()
    assert row.singleton_acc == 0.5 and row.n_entities == 4
    assert row.macro_f05 == pytest.approx((1 + 0 + 1.25 * 1 / (0.25 * 2 + 2) + 0) / 4)


def _naive_tuning(s1, truth, scored):
    def score(t, m):
        total = 0.0
        for e in s1:
            own = [(c, p) for (a, c, p) in scored if a == e]
            top = max([p for _, p in own], default=0)
            pred = {c for c, p in own if p >= t and round(top - p, 10) <= m}
            true = {c for a, c in truth if a == e}
            hit = len(pred & true)
            total += 1.0 if not true and not pred else 0.0 if not true or not pred else 1.25 * hit / (0.25 * len(true) + len(pred))
        return total / len(s1)

    best = (0.0, 1.0, -1.0)
    for t, m in M.coarse_grid():
        if (v := score(float(t), float(m))) > best[2] + 1e-12:
            best = (float(t), float(m), v)
    from decimal import Decimal

    for t, m in M.fine_grid(Decimal(str(round(best[0], 3)))):
        if (v := score(float(t), float(m))) > best[2] + 1e-12:
            best = (float(t), float(m), v)
    return best


def test_tuning_same_as_a_loop(spark):
    import random

    random.seed(11)
    s1 = [f"e{i}" for i in range(25)]
    truth = [(e, f"{e}-0") for e in s1 if random.random() < 0.6]
    scored = [(e, f"{e}-{k}", round(random.random(), 3)) for e in s1 for k in range(random.randrange(4))]
    got = M.tune(spark.createDataFrame([(e,) for e in s1], "source1_entity_id string"), spark.createDataFrame(truth, PAIRS), spark.createDataFrame(scored, PAIRS + ", prob double"))
    want = _naive_tuning(s1, truth, scored)
    assert (got["abs_threshold"], got["rel_margin"]) == (pytest.approx(want[0]), want[1]) and got["macro_f05"] == pytest.approx(want[2])


def test_average_precision_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 1)], "prob double, label int")
    assert M.average_precision(df).first()[0] == pytest.approx((1 * 1 + 1 * 2 / 3 + 1 * 3 / 4) / 3)
    assert M.average_precision(df.filter("label = 0")).first()[0] == 0.0


def test_predictions_cover_every_entity(spark):
    s1 = spark.createDataFrame([("a",), ("b",)], "source1_entity_id string")
    scored = spark.createDataFrame([("a", "S2-2", 0.9), ("a", "S2-1", 0.85), ("a", "S3-1", 0.5)], PAIRS + ", prob double")
    assert {tuple(r) for r in M.predictions(s1, scored, 0.4, 0.1).collect()} == {("a", "S2-1,S2-2"), ("b", "")}


def test_violations_and_first_error(spark):
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    known = spark.createDataFrame([("S2-1",)], "entity_id string")
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-9", "S1-1,Q,S3-7")], "source1_entity_id string, matched_entity_ids string")
    rules = {r.rule for r in V.violations(bad, "matched_entity_ids", ids, known).collect()}
    assert rules == set(V.RULES)
    with pytest.raises(V.ValidationError, match="duplicate_row"):
        V.require_valid(bad, "matched_entity_ids", ids, known)
    good = spark.createDataFrame([("S1-1", " S2-1 "), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    V.require_valid(good, "matched_entity_ids", ids, known)


def test_subset(spark):
    a, b = spark.createDataFrame([("S1-1", "S2-1")], PAIRS), spark.createDataFrame([("S1-1", "S2-2")], PAIRS)
    V.require_subset(a, a)
    with pytest.raises(V.ValidationError):
        V.require_subset(a, b)


def test_aliases_and_missing_columns(spark):
    df = spark.createDataFrame([("a", "b")], "s1_id string, s2_s3_id string")
    assert L.adapt_columns(df).columns == ["source1_entity_id", "candidate_entity_id"]
    with pytest.raises(ValueError, match="missing columns"):
        L.adapt_columns(df.drop("s1_id"))


def test_lists_in_score_order(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("a", "x", 2.0)], "k string, v string, s double")
    assert L.group_ids_by_score(df, "k", "v", "s").first().ids == "y,x"


def test_folds_keep_entities_together(spark):
    df = P.group_folds(spark.range(500).selectExpr("concat('e', id % 50) AS source1_entity_id"))
    assert df.distinct().count() == 50


def test_labelled_sample(spark, sides):
    truth = spark.createDataFrame([("S1-1", "S2-1")], PAIRS)
    rows = P.labelled_sample(*sides, truth).collect()
    assert {(r[0], r[1]) for r in rows if r.label == 1} == {("S1-1", "S2-1")}
    assert not {(r[0], r[1]) for r in rows if r.label == 0} & {("S1-1", "S2-1")}
    assert 0 < sum(r.label == 0 for r in rows) <= 9


def test_empty_inputs(spark, sides):
    s1, cands = sides
    none = s1.limit(0)
    assert B.generate_candidates(none, cands).isEmpty()
    assert X.build_features(B.generate_candidates(none, cands), none, cands).isEmpty()


def test_catalogue_keeps_keys_beyond_the_small_caps(spark, tmp_path):
    from linkweave.plans import catalogue

    text = "Acme traders of the northern coast and all of its islands   12 rose street by the old harbour wall, second floor on the left"
    spark.createDataFrame([(i, text, "en", "web", 200 + i) for i in range(90)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    lists = catalogue.flagship(spark, str(tmp_path)).collect()
    assert len(lists) == 30 and all(len(r.candidate_entity_ids.split(",")) == 60 for r in lists)
    known = catalogue.queries()
    assert known["block_name_char_prefix"](spark, str(tmp_path)).count() == 0
    assert known["block_name_char_prefix_full"](spark, str(tmp_path)).count() == 30 * 60
    assert known["build_features"](spark, str(tmp_path)).count() == 30 * 60


def test_best_candidates_do_not_travel_as_pairs(spark, monkeypatch):
    """Blocks are scored in place: the same best candidates as from all pairs, long names, empty ones, null
    countries, ties and cut blocks included, and no more than ``k`` of an entity and cell handed on."""
    import random

    from linkweave.functions.similarity import lcs_length
    from linkweave.operators import best
    from linkweave.operators import blocking as B

    draw = random.Random(7)
    words = ["acme", "acne", "zürich", "трест", "works", "w" * 70, "of", "b", ""]

    def side(source, n):
        rows = []
        for i in range(n):
            name = " ".join(draw.choices(words, k=draw.randint(0, 3)))
            tokens = sorted(set(draw.choices("abcdefgh", k=draw.randint(0, 4)))) if i % 9 else None
            rows.append((f"{source}-{i:04d}", source, None if i % 17 == 0 else "IN", name, sorted(set(name.split())), name[:3], name[:4], str(i % 5), name.replace(" ", ""), tokens))
        return spark.createDataFrame(rows, "entity_id string, source string, country string, name_canonical string, name_tokens array<string>, name_char_prefix string, name_prefix_key string, addr_pincode string, name_concat_key string, addr_tokens array<string>")

    s1, cands = side("S1", 40), side("S2", 90).unionByName(side("S3", 60))
    monkeypatch.setattr(best, "LEFT_ROWS", 7)
    monkeypatch.setattr(best, "RIGHT_ROWS", 11)
    for native, k, digits in ((True, 3, 6), (False, 5, None)):
        ours = B.generate_candidates(s1, cands, k, native, digits, cap=30)
        theirs = B.top_k(B.score_pairs(B.first_signal(B.all_signals(s1, cands, cap=30)), s1, cands, native), k, digits)
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    found = best.best_in_cells(best.cells(*B.signal_keys(s1, cands, cap=30), s1, cands), 3, True, 6).collect()
    assert found and all(1 <= len(r.candidate_entity_id) <= 3 for r in found)
    for _ in range(300):
        a, b = (" ".join(draw.choices(words, k=draw.randint(0, 4))) for _ in "ab")
        names = best.Names([a, b])
        pair = np.array([0]), np.array([1])
        if not a:
            continue  # similarity takes such pairs out
        assert names._common(*pair)[0] == lcs_length(a, b)
        table = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            table, last = [i], table
            for j, d in enumerate(b, 1):
                table.append(min(last[j] + 1, table[-1] + 1, last[j - 1] + (c != d)))
        assert names._edits(*pair)[0] == best.edit_distance(a, b) == table[-1]
    # repeated ids: every pair of rows counts
    twice = s1.unionByName(s1.withColumn("name_canonical", F.lit("acme")))
    ours = B.generate_candidates(twice, cands, 4, True, 6, cap=30)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, B.top_k(B.score_pairs(B.first_signal(B.all_signals(twice, cands, cap=30)), twice, cands, True), 4, 6).collect()))
