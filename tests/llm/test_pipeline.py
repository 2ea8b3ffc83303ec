"""The pipeline's stages, each judged on its own input, on the smallest documents."""

import numpy as np
import pytest

import corpus_pipeline
from linkweave.llm import exact_dedup, mixing, near_dedup

from ..conftest import DATA


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1][1], DATA).write.parquet(f"{folder}/{name}")
        out.append((name, spark.read.parquet(f"{folder}/{name}")))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in stages[1:]] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    for _, df in stages[1:-1]:
        assert df.columns == stages[0][1].columns


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1][1].collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert len(kept) < stages[0][1].count()


def test_copies_go(stages):
    before = {r.doc_id: r for r in exact_dedup.report(stages[1][1]).collect()}
    assert {r.doc_id for r in stages[2][1].collect()} == {i for i, r in before.items() if r.kept}


def _shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_one_of_each_near_group_stays(stages):
    rows = [(r.doc_id, _shingles(r.text)) for r in stages[2][1].collect()]
    up = near_dedup.Sets(len(rows))
    rows.sort(key=lambda r: r[0])
    for i in range(len(rows)):
        for j in range(i):
            both = len(rows[i][1] & rows[j][1])
            if both and 100 * both >= 80 * len(rows[i][1] | rows[j][1]):
                up.join(i, j)
    assert {r.doc_id for r in stages[3][1].collect()} == {rows[i][0] for i in range(len(rows)) if up.find(i) == i}


def test_mix_is_the_report(stages):
    from collections import Counter

    plan = {r.doc_id: r for r in mixing.report(stages[3][1]).collect()}
    times = Counter(r.doc_id for r in stages[4][1].collect())
    assert all(times[i] * r["size"] == r.taken for i, r in plan.items())


def test_ids_of_the_mix(stages):
    assert stages[5][1].count() == stages[4][1].count()
    assert {r.doc_id for r in stages[5][1].collect()} == {r.doc_id for r in stages[4][1].collect()}
    assert np.all([r.n_tokens > 0 for r in stages[5][1].collect()])


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(corpus_pipeline.run(spark, DATA)) == key(stages[5][1])


def test_odd_rows_pass_every_stage(spark):
    schema = stages_schema(spark)
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one", "en", "a", 3), (3, "one", "en", "a", 3), (None, "two words", None, "b", 9)], schema)
    for _, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, DATA)
            assert out.count() <= 3 * docs.count()


def stages_schema(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").schema
