"""The learners of all folds give MLlib's trees, probabilities and context."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from linkweave.operators import features as X
from linkweave.operators import learners as E
from linkweave.plans import catalogue
from linkweave.plans.matcher import EntityMatcher
from linkweave.plans.pipeline import Config


@pytest.fixture(scope="module")
def rows(spark):
    """Five columns of few values, two of them with a say in the label."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (3000, 5)) / 4.0
    x[:, 4] = 1.5
    label = (x[:, 0] + x[:, 1] ** 2 / 4 + rng.normal(0, 0.6, len(x)) > 3).astype(int)
    made = [(f"S1-{i // 7}", f"S2-{i}", int(label[i]), i // 7 % 3, *map(float, x[i])) for i in range(len(x))]
    return spark.createDataFrame(made, f"{E.S1} string, {E.CAND} string, label int, fold int, a double, b double, c double, d double, e double").repartition(5).cache()


COLUMNS, FOLDS, SCALE = list("abcde"), [0, 1, 2], 1.7


@pytest.fixture(scope="module")
def packed(rows):
    table = E.pack(rows, rows.filter("label = 1"), COLUMNS, [], 0, 3, 1.0)
    limits = E.bounds(E.sampled(table, 5)[0])
    return table, limits, E.write_bins(table, limits)


def probabilities(packed, family, models):
    table, limits, _ = packed
    return {r[E.CAND]: r[f"prob_{family}"] for r in E.held_out(table, limits, {family: models}).collect()}


def of_mllib(rows, learner):
    features = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(rows.withColumns({"weight": F.when(F.col("label") == 1, SCALE).otherwise(1.0), "label": F.col("label").cast("double")}))
    out = {}
    for k in FOLDS:
        model = learner.fit(features.withColumn("held", F.col("fold") == k) if isinstance(learner, GBTClassifier) else features.filter(F.col("fold") != k))
        out |= {r[0]: r[1] for r in model.transform(features.filter(F.col("fold") == k)).select(E.CAND, vector_to_array("probability")[1]).collect()}
    return out


def apart(a, b):
    assert a.keys() == b.keys()
    return max(abs(a[i] - b[i]) for i in a)


def test_boosting_is_mllibs(rows, packed):
    ours = E.boost(packed[2], 5, FOLDS, SCALE, trees=6, share=1.1, columns=1.0, depth=3)
    theirs = of_mllib(rows, GBTClassifier(labelCol="label", weightCol="weight", maxIter=6, stepSize=0.1, maxDepth=3, minInstancesPerNode=25, validationIndicatorCol="held", seed=1))
    assert apart(probabilities(packed, "gbt", ours), theirs) < 1e-6


def test_boosting_goes_on_from_written_margins(packed, monkeypatch):
    whole = E.boost(packed[2], 5, FOLDS, SCALE, trees=5, tolerance=-1.0)
    monkeypatch.setattr(E, "CARRIED", 2)
    parts = E.boost(packed[2], 5, FOLDS, SCALE, trees=5, tolerance=-1.0)
    assert [len(v) for v in whole.values()] == [len(v) for v in parts.values()]
    assert apart(probabilities(packed, "gbt", whole), probabilities(packed, "gbt", parts)) < 1e-9


def test_linear_is_mllibs(rows, packed):
    table, _, _ = packed
    sample = E.sampled(table, 5)
    ours = E.logistic(table, 5, FOLDS, SCALE, E.all_moments(table, 5, 3), sample)
    theirs = of_mllib(rows, LogisticRegression(labelCol="label", weightCol="weight", regParam=0.01, maxIter=200, tol=1e-12))
    assert apart(probabilities(packed, "linear", ours), theirs) < 1e-6
    assert all(abs(m[4]) < 1e-9 for m in ours.values())
    few = E.logistic(table, 5, FOLDS, SCALE, E.all_moments(table, 5, 3), tuple(x[..., :40] for x in sample))
    assert all(np.allclose(ours[k], few[k], atol=1e-6) for k in FOLDS)


def test_forest_learns_and_repeats(rows, packed):
    label = {r[E.CAND]: r.label for r in rows.collect()}
    ours = probabilities(packed, "forest", E.forest(packed[2], 5, FOLDS, SCALE, trees=5))
    again = probabilities(packed, "forest", E.forest(packed[2].repartition(2), 5, FOLDS, SCALE, trees=5))
    assert apart(ours, again) < 1e-9
    assert np.mean([ours[i] for i in ours if label[i]]) > 0.3 + np.mean([ours[i] for i in ours if not label[i]])


def test_one_tree_of_a_forest_sees_all_columns_and_few_rows_stay_whole(packed):
    trees = E.forest(packed[2], 5, FOLDS, SCALE, trees=1, least=5000)
    assert all((t.column == -1).all() and 0 < t.value[0] < 1 for v in trees.values() for t in v)


def test_context_is_group_context(spark):
    rng = np.random.default_rng(5)
    made = [(f"S1-{g}", f"S2-{g}-{i}" if i % 5 else None, None if (g + i) % 6 == 0 or g == 4 else float("nan") if g == 3 and i == 1 else float(rng.integers(0, 4)) / 3, float(i)) for g in range(40) for i in range(1 + g % 9)]
    df = spark.createDataFrame([*made, (None, "S2-x", 1.0, 2.0)], f"{E.S1} string, {E.CAND} string, u double, v double").repartition(3)
    names = E.context_names(["u", "v"], 12)
    wanted = X.group_context(df, ["u", "v"]).fillna(-999.0, names)
    assert [c for c in wanted.columns if c.startswith("_grp_")] == names
    table = E.pack(df.withColumn("fold", F.lit(0)), df.filter("v = 2"), names + ["u", "v"], ["u", "v"], 12, 1, 0.5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # groups that go on in the next batch
    try:
        small = E.pack(df.withColumn("fold", F.lit(0)), df.filter("v = 2"), names + ["u", "v"], ["u", "v"], 12, 1, 0.5)
        found = {}
        for which, blocks in (("whole", table), ("small", small)):
            parts = [(r[E.S1], np.frombuffer(r["values"], dtype=np.float32).reshape(len(names) + 2, -1)) for r in blocks.collect()]
            found[which] = {(s, float(x[-1])): x[: len(names)] for ids, values in parts for s, x in zip(ids, values.T, strict=True)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    theirs = {(r[E.S1], r.v): [-999.0 if r[c] is None or r[c] != r[c] else float(r[c]) for c in names] for r in wanted.collect()}
    assert len(theirs) == len(made) + 1
    for ours in found.values():
        assert ours.keys() == theirs.keys()
        assert all(np.allclose(ours[i], theirs[i], rtol=1e-6, atol=1e-6) for i in theirs)


def test_labels_are_the_truths(spark):
    pairs = spark.createDataFrame([("S1-1", "a"), ("S1-1", "b"), ("S1-1", "b"), ("S1-2", "a"), (None, "a"), ("S1-3", None)], f"{E.S1} string, {E.CAND} string").withColumns({"fold": F.lit(0), "u": F.lit(1.0)})
    truth = spark.createDataFrame([("S1-1", "b"), ("S1-1", "b"), ("S1-2", "b"), ("S1-9", "a"), (None, "a"), ("S1-3", None)], f"{E.S1} string, {E.CAND} string")
    blocks = E.pack(pairs, truth, ["u"], [], 0, 1, 1.0).collect()
    ours = sorted((str(s), str(c), x) for r in blocks for s, c, x in zip(r[E.S1], r[E.CAND], r.label, strict=True))
    theirs = sorted((str(r[0]), str(r[1]), r[2]) for r in X.attach_labels(pairs, truth).select(E.S1, E.CAND, "label").collect())
    assert ours == theirs and sum(x for _, _, x in ours) == 2


def test_jobs_do_not_grow_with_folds(rows, spark):
    """Before, every fold and family was fitted by jobs of its own: over 50 for each of 15 models."""
    truth = rows.filter("label = 1").select(E.S1, E.CAND)
    jobs = {}
    for folds in (2, 5):
        spark.sparkContext.setJobGroup(f"folds {folds}", "")
        matcher = EntityMatcher(n_splits=folds, trees=2, families=("gbt",))
        result = matcher.fit(rows.drop("label", "fold"), truth, rows.select(E.S1).distinct())
        spark.sparkContext.setJobGroup("", "")
        jobs[folds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds {folds}"))
        assert result["macro_f05"] > 0.5 and matcher.held_out.count() == 3000
    assert jobs[5] <= jobs[2] * 1.3


def test_registered_queries_learn_as_the_job_does(rows, spark, monkeypatch):
    """Before, they grew 3 trees of 60."""
    grown = {}

    def grow(name):
        def run(bins, d, folds, positive, *, trees, seed):
            grown[name] = trees
            one = E.Tree(1)
            one.value[0] = 0.5
            return {k: [one] for k in folds}

        return run

    monkeypatch.setattr(E, "boost", grow("boost"))
    monkeypatch.setattr(E, "forest", grow("forest"))
    monkeypatch.setattr(catalogue, "candidates", lambda *_: (rows, None, None))
    monkeypatch.setattr(catalogue.X, "build_features", lambda *_: rows.drop("label", "fold"))
    monkeypatch.setattr(catalogue, "truth_pairs", lambda *_: rows.filter("label = 1").select(E.S1, E.CAND))
    monkeypatch.setattr(catalogue, "all_s1", lambda *_: rows.select(E.S1).distinct())
    assert catalogue.queries()["gbt_oof"](spark, "").count() == 3000
    assert grown == dict.fromkeys(("boost", "forest"), Config().trees)
    grown.clear()
    assert catalogue.queries()["feature_importance"](spark, "").count() == 20
    assert grown == dict.fromkeys(("boost", "forest"), Config().trees)


def test_sums_agree_wherever_they_are_added_up(packed, monkeypatch):
    whole = E.boost(packed[2], 5, FOLDS, SCALE, trees=2)
    monkeypatch.setattr(E, "GATHERED", -1)
    parts = E.boost(packed[2], 5, FOLDS, SCALE, trees=2)
    assert apart(probabilities(packed, "gbt", whole), probabilities(packed, "gbt", parts)) < 1e-9


def test_a_boosted_tree_takes_a_pass_a_level(packed, spark):
    """Before, each had another pass for its loss, and small sums went through an exchange."""
    spark.sparkContext.setJobGroup("passes", "")
    found = E.boost(packed[2], 5, FOLDS, SCALE, trees=4, depth=3, tolerance=-1.0)
    spark.sparkContext.setJobGroup("", "")
    assert [len(v) for v in found.values()] == [4, 4, 4]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("passes")) <= 4 * 3 + 1


def test_rows_end_in_the_nodes_of_their_bins():
    rng = np.random.default_rng(1)
    tree, bins = E.Tree(3), rng.integers(0, E.BINS, (4, 500)).astype(np.uint8)
    tree.column[:7] = [0, 3, 1, -1, 2, 0, -1]
    tree.cut[:7], tree.value = rng.integers(5, 25, 7), rng.normal(size=15)

    def end(x):
        node = 0
        while tree.column[node] >= 0:
            node = 2 * node + 1 + (x[tree.column[node]] > tree.cut[node])
        return node

    ends = np.array([end(x) for x in bins.T])
    rows = np.flatnonzero(rng.random(500) < 0.6)
    assert np.array_equal(tree.predict(bins), tree.value[ends]) and np.array_equal(tree.predict(bins, rows), tree.value[ends[rows]])
    kept, slot = E.placed(E.places(tree, [10, 3]), bins, rows)
    assert sorted(kept) == [i for i in rows if ends[i] in (10, 3)] and np.array_equal(np.array([10, 3])[slot], ends[kept])
