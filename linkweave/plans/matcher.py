"""A grouped cross-validated ensemble of classifiers with tuned thresholds."""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from linkweave.operators import features as X
from linkweave.operators import learners as E
from linkweave.operators import metrics as M
from linkweave.operators.lists import numeric_columns
from linkweave.operators.sampling import group_folds
from linkweave.sources.storage import cleaned, discard, materialise

#: Columns that are never features.
IGNORED = {"source1_entity_id", "candidate_entity_id", "signal", "label", "prob", "fold", "weight", "validation"}


class EntityMatcher:
    """Boosted trees, a forest and a linear model per fold, blended by their squared average precision."""

    def __init__(self, n_splits: int = 5, use_group_features: bool = True, trees: int = 60, families: tuple[str, ...] = ("gbt", "forest", "linear"), seed: int = 42):
        self.n_splits, self.use_group_features, self.trees, self.families, self.seed = n_splits, use_group_features, trees, tuple(families), seed
        self.base_columns: list[str] = []
        self.feature_columns: list[str] = []
        #: Bounds of every column's bins; by family and fold, trees or coefficients.
        self.limits: list[np.ndarray] = []
        self.models: dict[str, dict[int, list[E.Tree] | np.ndarray]] = {}
        self.blend: dict[str, float] = {}
        self.threshold, self.margin = 0.70, 1.0

    def fit(self, features: DataFrame, truth: DataFrame, all_s1: DataFrame) -> dict[str, float]:
        """Out-of-fold probabilities per family, blend weights, then thresholds on the blended ones."""
        truth, all_s1 = materialise(truth.select(X.S1, X.CAND).distinct(), "truth"), materialise(all_s1.select(X.S1).distinct(), "all")
        self.base_columns = numeric_columns(features, IGNORED)
        context = E.context_names(self.base_columns, X.GROUPED) if self.use_group_features else []
        self.feature_columns = list(dict.fromkeys([*self.base_columns, *[c for c in features.columns if c.startswith("_grp_")], *context]))
        d, n_rows = len(self.feature_columns), features.count()
        rows = E.pack(group_folds(features, self.n_splits), truth, self.feature_columns, self._grouped(), X.GROUPED, self.n_splits, E.SAMPLE / max(n_rows, 1), n_rows)
        seen = E.all_moments(rows, d, self.n_splits)
        counts = seen[:, :, 0]  # by fold and label
        folds = [k for k in range(self.n_splits) if counts[k].sum() and (np.delete(counts, k, axis=0).sum(axis=0) > 0).all()]
        if not folds:
            raise ValueError("no fold has both labels")
        positive = M.class_scale(counts[:, 1].sum(), counts.sum())
        sample = E.sampled(rows, d)
        self.limits = E.bounds(sample[0])
        bins = E.write_bins(rows, self.limits) if {"gbt", "forest"} & {*self.families} else None
        learn = {
            # boosting watches the held-out fold to stop; the others never see it
            "gbt": lambda: E.boost(bins, d, folds, positive, trees=self.trees, seed=self.seed),
            "forest": lambda: E.forest(bins, d, folds, positive, trees=self.trees, seed=self.seed),
            "linear": lambda: E.logistic(rows, d, folds, positive, seen, sample),
        }
        with cleaned(features.sparkSession), ThreadPoolExecutor(len(self.families)) as pool:
            found = {f: pool.submit(learn[f]) for f in self.families}
            self.models = {f: x.result() for f, x in found.items()}
        if bins is not None:
            discard(bins)
        held = materialise(E.held_out(rows, self.limits, self.models), "held")
        discard(rows)
        quality = {f: max(M.average_precision(held, f"prob_{f}").first()[0], 1e-5) for f in self.families}
        total = sum(q * q for q in quality.values())
        self.blend = {f: q * q / total for f, q in quality.items()}
        self.held_out = held.withColumn("prob", sum(F.col(f"prob_{f}") * w for f, w in self.blend.items()))
        best = M.tune(all_s1, truth, self.held_out)
        self.threshold, self.margin = best["abs_threshold"], best["rel_margin"]
        details = M.macro_f05(all_s1, truth, M.accepted(self.held_out, self.threshold, self.margin)).first().asDict()
        return {**best, **details, "average_precision": quality}

    def _grouped(self) -> list[str]:
        return self.base_columns if self.use_group_features else []

    def score(self, features: DataFrame) -> DataFrame:
        """Blended mean probability of all fold models."""
        columns, limits, models, blend, grouped = self.feature_columns, self.limits, self.models, self.blend, self._grouped()
        read = [c for c in columns if c in features.columns]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in E.whole_groups(batches, bool(grouped)):
                numbers = table.select([S1, CAND, *[f"__{c}" for c in read]]).rename_columns([S1, CAND, *read])
                values = E.filled(numbers, columns, E.context(numbers, grouped, X.GROUPED) if grouped else {})
                bins = E.binned(values, limits)
                prob = sum(blend[f] * np.mean([E.probability(f, m, values, bins) for m in by_fold.values()], axis=0) for f, by_fold in models.items())
                yield from table.select(names).append_column("prob", pa.array(prob)).to_batches()

        names, (S1, CAND) = features.columns, (X.S1, X.CAND)
        rows = E.dealt(features.select("*", *[F.col(c).cast("double").alias(f"__{c}") for c in read]), bool(grouped))
        return rows.mapInArrow(run, StructType([*features.schema.fields, StructField("prob", DoubleType())]))

    def predict(self, features: DataFrame, all_s1: DataFrame, path: str | None = None) -> DataFrame:
        """matched_entity_ids of every entity."""
        out = M.predictions(all_s1, self.score(features), self.threshold, self.margin)
        if path:
            from linkweave.sources.tables import write_tsv

            write_tsv(out, path)
        return out

    def feature_importance(self, top_n: int = 20) -> list[tuple[str, float]]:
        """Mean over the boosted models (the forest's if there are none)."""
        models = list((self.models.get("gbt") or self.models.get("forest") or {}).values())
        sums = np.zeros(len(self.feature_columns))
        for trees in models:
            own = np.zeros(len(sums))
            for tree in trees:
                gains = np.bincount(np.maximum(tree.column, 0), np.where(tree.column >= 0, tree.gain, 0), len(sums))
                own += gains if "gbt" in self.models else gains / max(gains.sum(), 1e-300)
            sums += own / max(own.sum(), 1e-300) / len(models)
        return sorted(zip(self.feature_columns, map(float, sums)), key=lambda x: (-x[1], x[0]))[:top_n]

    def save(self, path: str) -> None:
        state = {k: getattr(self, k) for k in ("n_splits", "use_group_features", "trees", "families", "seed", "base_columns", "feature_columns", "blend", "threshold", "margin")}
        state["limits"] = [x.tolist() for x in self.limits]
        state["models"] = {f: {k: m.tolist() if f == "linear" else [tree.state() for tree in m] for k, m in by_fold.items()} for f, by_fold in self.models.items()}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, path: str) -> EntityMatcher:
        state = json.loads(SparkSession.getActiveSession().read.text(f"{path}/state").first()[0])
        models, limits = state.pop("models"), state.pop("limits")
        matcher = cls()
        for k, v in state.items():
            setattr(matcher, k, v)
        matcher.limits = [np.array(x) for x in limits]
        matcher.models = {f: {int(k): np.array(m) if f == "linear" else [E.Tree.of(tree) for tree in m] for k, m in by_fold.items()} for f, by_fold in models.items()}
        return matcher
