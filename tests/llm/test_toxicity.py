"""Toxicity: the lattice against all its readings, time on long tokens, odd rows, held-out quality."""

import itertools
import math
import time
import zlib

import numpy as np
import pytest

from linkweave.llm import queries, toxicity

from ..conftest import DATA


@pytest.fixture(scope="module")
def restorer():
    said = "you are the stupid idiot and the moron in a house by the river said a letter of hate to all fools"
    counts = {}
    codes = [0, 0, *map(toxicity.symbol, said), 0, 0]
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        gram = (a * toxicity.ALPHABET + b) * toxicity.ALPHABET + c
        counts[gram] = counts.get(gram, 0) + 5
    return toxicity.Restorer(toxicity.CharModel.of(counts.items()))


def score_of(restorer, path):
    """The sum that Viterbi maximises, of one choice of readings."""
    x, y, s = 0, 0, 0.0
    for reading, cost in path:
        s += cost
        for c in reading:
            z = toxicity.symbol(c)
            s += float(restorer.logp[x, y, z])
            x, y = y, z
    return s + (float(restorer.logp[x, y, 0]) if y else 0.0)


@pytest.mark.parametrize("token", ["1d10t", "h4t3", "5tup1d", "iiddiott", "m0r0n5", "11a", "a11", "l3tt3r!", "(a$$)", "fo0ll5", "7h3"])
def test_viterbi_is_the_best_of_all_readings(restorer, token):
    nodes = list(restorer.readings(token, apart=True))
    best = max(itertools.product(*nodes), key=lambda path: score_of(restorer, path))
    got = restorer._restore(token)
    tied = [p for p in itertools.product(*nodes) if math.isclose(score_of(restorer, p), score_of(restorer, best), abs_tol=1e-4)]
    assert got in {"".join(r for r, _ in p) for p in tied}


def test_settled_paths_are_the_same_paths(restorer, monkeypatch):
    random = np.random.default_rng(3)
    for _ in range(60):
        token = "".join(random.choice(list("a1i5s0tt!7"), 30))
        whole = restorer._restore(token)
        with monkeypatch.context() as m:
            m.setattr(toxicity, "SETTLE", 3)
            assert restorer._restore(token) == whole


@pytest.mark.parametrize("token", ["a1b " + "1" * 10**6 + "x", "ab" * 500_000 + "cc", "a" * 10**6, "order h3llo ref " + "2" * 10**6 + "z end"])
def test_a_million_signs_or_letters_take_no_second(restorer, token):
    begin = time.process_time()
    toxicity.words_of(token, restorer)
    assert time.process_time() - begin < 2.0  # about 0.4 alone on a core


def test_time_is_linear_in_the_worst_token(restorer):
    def took(n):
        token = "".join(str((i * i * 7 + i // 3) % 10) for i in range(n)) + "z"
        begin = time.process_time()
        restorer._restore(token)
        return time.process_time() - begin

    took(1000)
    assert took(16_000) < 12 * took(4000)


def test_a_disguised_token_of_any_length_is_restored(restorer):
    assert "idiot" in toxicity.words_of("you " + "i" * 70 + "diot", restorer)
    assert restorer._restore("1d10t" * 40) == "idiot" * 40
    run = " ".join("stupididiot" * 400)  # longer than a window
    assert {"stupid", "idiot"} <= toxicity.words_of(run, restorer)


def test_scorer_scores_as_the_words_do(restorer, monkeypatch):
    model = toxicity.Model(toxicity.CharModel(restorer.logp), {"idiot": 2.0, "stup*": 1.5, "hate": 0.7}, -2.0, 1.0, 0.0)
    scorer = toxicity.Scorer(model)
    texts = ["", "You 1d10t", "$tup1d h4t3", "a house", "i d i o t", "hhaattee", "9 8 7", "st*pid idiot idiot", "x" * 200 + " idi" + "o" * 99 + "t", None]
    for text in texts:
        assert scorer(text) == model.score(toxicity.words_of(text or "", restorer)), text


SCHEMA = "doc_id long, text string, toxic int, pick long, feature string, family long, score double, label int"


def test_clashing_columns_null_ids_and_repeated_rows(spark):
    said = ["good", "idiot", "fine", "nice"]
    rows = [(i, f"word{i} {said[i % 4]} house {i * 7}", 0, 5, "f", 1, 0.5, 1) for i in range(200)]
    docs = spark.createDataFrame([*rows, rows[1], (None, "you idiot", 0, 5, "f", 1, 0.5, 1), (None, None, 0, 5, "f", 1, 0.5, 1)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 1), "t", 9) for i in range(200)] + [(None, 1, "t", 9)], "doc_id long, toxic int, text string, pick long")
    model = toxicity.learn(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 203
    assert all(r.predicted == int(r.doc_id % 4 == 1) for r in got if r.doc_id is not None)
    lost = sorted(r.predicted for r in got if r.doc_id is None)
    assert lost == [0, 1] and not any(r.held_out for r in got if r.doc_id is None)
    again = [(r.score, r.predicted) for r in got if r.doc_id == 1]
    assert len(again) == 2 and again[0] == again[1]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 150 + 1


def test_held_out_precision_and_recall(spark):
    sf = DATA.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in queries.op8_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    said = [i for i in held if got[i].predicted]
    right = sum(labels[i] for i in said)
    assert right >= 0.9 * len(said) and right >= 0.75 * sum(labels[i] for i in held) > 0
