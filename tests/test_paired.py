"""Features of pairs in cells, against the features of joined pairs."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.functions import similarity as S
from linkweave.operators import best, paired
from linkweave.operators import features as X
from linkweave.sources.storage import materialise

WORDS = ["acme", "acne", "zürich", "трест", "works", "w" * 40, "of", "b", "", "abcdefghij" * 9]


def test_lanes_same_as_one_by_one():
    draw = random.Random(3)
    texts = sorted({"", *(" ".join(draw.choices(WORDS, k=draw.randint(0, 5))) for _ in range(60)), *("".join(draw.choices("abc", k=draw.randint(0, 64))) for _ in range(60))})
    names = best.Names(texts)
    a, b = (np.array([draw.randrange(len(texts)) for _ in range(2000)]) for _ in "ab")
    edits, jaro = paired.by_lanes(paired.levenshtein, names, a, b), paired.by_lanes(paired.jaro_winkler, names, a, b)
    for i, (x, y) in enumerate((texts[k], texts[m]) for k, m in zip(a, b, strict=True)):
        longer = max(len(x), len(y))
        assert edits[i] == (1 - best.edit_distance(x, y) / longer if longer else 1.0)
        assert jaro[i] == S.jaro_winkler(x, y)


def test_cells_same_as_joined_pairs(spark, monkeypatch):
    """Absent and repeated ids, repeated pairs, null texts, sets and countries, long sets, and cut sides; and the pairs
    are joined with no text."""
    draw = random.Random(5)
    schema = "entity_id string, name_canonical string, name_tokens array<string>, addr_normalized string, addr_tokens array<string>, addr_pincode string, country string"

    def side(source, n):
        rows = []
        for i in range(n):
            name, tokens = " ".join(draw.choices(WORDS, k=draw.randint(0, 4))), sorted(set(draw.choices("abcdefgh", k=draw.randint(0, 5))))
            rows.append((f"{source}-{i}", name if i % 7 else None, name.split(), name[::-1], (tokens if i % 11 else [f"t{k}" for k in range(i, i + 90)]) if i % 5 else None, str(i % 3) if i % 4 else "", draw.choice(["IN", "US", None])))
        return spark.createDataFrame([*rows, *rows[:3]], schema)

    s1, cands = side("S1", 30), side("S2", 50)
    chosen = [(f"S1-{draw.randrange(34)}", f"S2-{draw.randrange(55)}", draw.random()) for _ in range(400)]
    pairs = materialise(spark.createDataFrame([*chosen, chosen[0], (None, "S2-1", 0.5)], "source1_entity_id string, candidate_entity_id string, score double"), "pairs")
    monkeypatch.setattr(paired, "CELL_ROWS", 9)
    wanted = [f for f in paired.FEATURES if not f.endswith("tfidf")]
    ours = paired.compare(pairs, s1, cands, wanted)
    assert "Join" not in ours._jdf.queryExecution().optimizedPlan().toString()
    c, sound = F.col, lambda x: S.metaphone_code(F.element_at(F.split(x, " "), 1))
    native = {
        **{f"feat_{x}_{n}": f(c(f"s1_{x}_tokens"), c(f"cand_{x}_tokens")) for x in ("name", "addr") for n, f in (("jaccard", S.jaccard), ("overlap", S.overlap))},
        "feat_name_levenshtein": S.levenshtein_similarity(c("s1_name_canonical"), c("cand_name_canonical")), "feat_addr_levenshtein": S.levenshtein_similarity(c("s1_addr_normalized"), c("cand_addr_normalized")),
        "feat_name_jaro_winkler": S.jaro_winkler_similarity("s1_name_canonical", "cand_name_canonical"), "indel": S.indel_similarity("s1_name_canonical", "cand_name_canonical"),
        "feat_phonetic_match": S.flag_equal_filled(sound(c("s1_name_canonical")), sound(c("cand_name_canonical"))),
        "feat_pincode_match": S.flag_equal_filled(c("s1_addr_pincode"), c("cand_addr_pincode")), "feat_country_match": S.flag_equal(c("s1_country"), c("cand_country")),
    }
    theirs = X.attach(pairs, s1, cands).select(*pairs.columns, *[native[n].alias(n) for n in wanted])
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(ours) == rows(theirs)


def test_weights_of_cells(spark):
    maps = "entity_id string, name_weights map<string, double>"
    s1 = spark.createDataFrame([("S1-1", {"a": 0.6, "b": 0.8}), ("S1-2", None)], maps)
    cands = spark.createDataFrame([("S2-1", {"b": 1.0}), ("S2-2", {"c": 0.5}), ("S2-3", {f"{i}": 1.0 for i in range(600)} | {"a": 0.5, "b": 0.5})], maps)
    pairs = spark.createDataFrame([(a, b) for a in ("S1-1", "S1-2") for b in ("S2-1", "S2-2", "S2-3")], "source1_entity_id string, candidate_entity_id string")
    got = {(r[0], r[1]): r[2] for r in paired.compare(pairs, s1, cands, ["feat_name_tfidf"]).collect()}
    assert got == {("S1-1", "S2-1"): pytest.approx(0.8), ("S1-1", "S2-2"): 0.0, ("S1-1", "S2-3"): pytest.approx(0.7), **{("S1-2", f"S2-{i}"): 0.0 for i in (1, 2, 3)}}


def test_written_tables_leave_no_shuffle_files(spark):
    held = lambda: sum("shuffle_" in str(f) for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()))
    before = held()
    written = materialise(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "groups")
    until = time.time() + 20
    while held() > before and time.time() < until:
        time.sleep(0.2)
    assert held() <= before and len(written.collect()) == 10
