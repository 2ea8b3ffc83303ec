"""Nulls, empty and long texts, ties, repeated rows, empty tables, and columns with clashing names."""

import hashlib

import numpy as np
import pytest

from linkweave.llm import audio, bpe, exact_dedup, exchange, language_id, mixing, near_dedup, substring_dedup, suffix_dedup, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, count long, chunk long, key string, class_id long, label long, score double, batch string, `__x` int"
WORDS = "alpha bravo cedar delta ember falcon grove harbor iris jade karma lotus maple nova opal pine quartz river stone tulip".split()
LONG = " ".join(WORDS[(i * i + i // 7) % 20] + str(i) for i in range(30_000))
PASSAGE = " ".join(f"{WORDS[i % 20]}{i}" for i in range(60))


def frame(spark, *texts, source="s", lang="en"):
    rows = [(i, t, lang, source, 7, 1, 2, 3, 4, "k", 5, 6, 0.5, "b", 8) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, short, long, repeated and shared texts; a row twice; a null id, source and language."""
    df = frame(spark, None, "", " \t\n", "One", "one", PASSAGE, "x " + PASSAGE + " y", PASSAGE.upper(), LONG, LONG + " end", "naïve café 中文 \U0001f600 1234")
    again = df.filter("doc_id = 5")
    lost = frame(spark, "one").selectExpr("cast(null AS long) doc_id", "text", "cast(null AS string) lang", "cast(null AS string) source", *[f"`{c}`" for c in df.columns[4:]])
    return df.unionByName(again).unionByName(lost)


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def listed(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


CASES = {
    "substring": lambda df: substring_dedup.remove_repeats(df),
    "suffix": lambda df: suffix_dedup.remove_repeats(df),
    "mixing": mixing.report,
    "near": near_dedup.near_duplicates,
    "exact": exact_dedup.report,
    "language": lambda df: language_id.predict(df, language_id.learn(df)),
    "bpe": lambda df: bpe.encode(df, *_vocabulary()),
}


def _vocabulary():
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.mark.parametrize("name", CASES)
def test_every_row_has_a_row(name, odd):
    got = CASES[name](odd)
    assert sorted(str(r.doc_id) for r in got.select("doc_id").collect()) == sorted(str(r.doc_id) for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", CASES)
def test_empty_table(name, odd):
    assert CASES[name](odd.limit(0)).isEmpty()


@pytest.mark.parametrize("name", CASES)
def test_all_null_texts(name, spark):
    assert CASES[name](frame(spark, None, None)).count() == 2


def test_substring_results(odd):
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(odd, keep_text=True, pack_bytes=2000).filter("doc_id is not null").collect()}
    assert got[0].n_words == got[1].n_words == got[2].n_words == 0 and got[0].kept_sha256 == sha(b"")
    assert got[5].n_removed == 0 and got[6].kept == "x y" and got[7].n_removed == 0
    assert (got[9].n_words, got[9].n_removed, got[9].kept) == (30001, 30000, "end")


def test_suffix_results(odd):
    got = listed(suffix_dedup.remove_repeats(odd, keep_text=True, pack_bytes=2000).filter("doc_id in (0, 5, 6, 8, 9)"), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    n, long = len(PASSAGE), len(LONG)
    assert got == [(0, 0, 0, 0, b""), (5, n, n, 1, b""), (5, n, n, 1, b""), (6, n + 4, n, 1, b"x  y"), (8, long, long, 1, b""), (9, long + 4, long, 1, b" end")]


@pytest.fixture(scope="module")
def in_pieces(spark):
    """Texts of many pieces that share passages across cuts, repeat themselves, have words longer than a piece or
    long blanks, end at a cut, or are short; one twice, one without an id."""
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    plain = [" ".join(random.choice(words, 900)) for _ in range(4)]
    shared = plain[0][1300:2900]
    texts = [*plain, "a b " + shared + "  c", shared + " " + plain[1][:700] + shared, "abcd " * 500, "abcd " * 130, "x" * 2000 + " " + shared[:400] + " " + "x" * 2000,
             " " * 1500 + shared + "\t" * 1500, "q" * 700, "", shared[:150], plain[2][:500], plain[2][:1000], None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, plain[3][:1600])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("pack_bytes", [120, 500, 1 << 20])
def test_substring_of_texts_in_pieces_against_brute_force(in_pieces, pack_bytes):
    rows, df = in_pieces
    largest = 1 << 62
    least: dict = {}
    split = [(largest if i is None else i, (t or "").split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(i, least.get(key, i))
    want = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((None if i == largest else i, len(w), sum(gone), sha(kept.encode()), kept))
    got = listed(substring_dedup.remove_repeats(df, keep_text=True, pack_bytes=pack_bytes), "doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    assert got == sorted(want, key=str) and any(0 < w[2] < w[1] for w in want)


@pytest.mark.parametrize("pack_bytes,hot", [(120, 20_000), (500, 20_000), (500, 1), (1 << 20, 20_000)])
def test_suffix_of_texts_in_pieces_against_brute_force(in_pieces, pack_bytes, hot):
    rows, df = in_pieces
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen: dict = {}
    for _, t in raw:
        for k in range(len(t) - 199):
            seen[t[k : k + 200]] = seen.get(t[k : k + 200], 0) + 1
    want = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        want.append((i, len(t), sum(gone), spans, sha(kept), kept))
    got = listed(suffix_dedup.remove_repeats(df, keep_text=True, pack_bytes=pack_bytes, hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    assert got == sorted(want, key=str) and any(0 < w[2] < w[1] for w in want)


def test_suffix_columns_against_all_pairs():
    random = np.random.default_rng(4)
    rows, before, window = 40, 6, 10
    contexts = random.integers(0, 2, (rows, before + window), dtype=np.uint8)
    left, right = random.integers(0, before + 1, rows), random.integers(4, window + 1, rows)
    got = suffix_dedup.repeated_columns(contexts, left, right, before, window)
    for i in range(rows):
        for c in range(before + 1):
            fits = lambda j: c >= before - left[j] and c + window <= before + right[j]  # noqa: E731, B023
            want = fits(i) and any(j != i and fits(j) and (contexts[i, c : c + window] == contexts[j, c : c + window]).all() for j in range(rows))
            assert got[i, c] == want


def test_exact_results(odd):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.report(odd).collect()}
    assert {(0, 1, 2, False), (1, 1, 2, True), (2, 2, 1, True), (3, 4, 3, False), (4, 4, 3, True), (8, 8, 1, True), (7, 7, 3, True), (5, 7, 3, False), (None, 4, 3, False)} <= got
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 7, 8, 9, 10]


def test_exact_without_broadcast(odd):
    usual = listed(exact_dedup.exact_dedup(odd), "id", "keep_id", "group_size")
    assert listed(exact_dedup.exact_dedup(odd, broadcast_rows=0), "id", "keep_id", "group_size") == usual


def test_near_results(odd):
    got = {r.doc_id: r for r in near_dedup.near_duplicates(odd).collect()}
    assert [got[i].n_shingles for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert [got[i].component_id for i in (0, 1, 2)] == [0, 1, 2]
    assert got[4].component_id == 3 and got[5].component_id == got[6].component_id == got[7].component_id == 5
    assert got[9].component_id == 8 and not got[9].kept
    assert got[None].component_id is None and not got[None].kept


def test_mixing_repeats_and_nulls(odd):
    got = {r.doc_id: r for r in mixing.report(odd).filter("doc_id is not null").collect()}
    assert got[0].size == 0 and got[0].taken == 0 and got[8].size == 30_000
    assert all(r.taken <= 3 * r["size"] for r in got.values())


def test_mix_repeats_rows_and_deals_shards(spark):
    df = frame(spark, *["w " * (i % 9 + 1) for i in range(300)]).selectExpr("doc_id", "text", "lang", "concat('s', doc_id % 5) AS source", "n_chars")
    plan = {r.doc_id: r for r in mixing.report(df).collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    from collections import Counter

    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[i] * r["size"] == r.taken for i, r in plan.items())
    sharded = mixing.mix(df, shards=4)
    assert Counter(r.doc_id for r in sharded.collect()) == times
    per = Counter((r.mix_shard, r.source) for r in sharded.collect())
    assert {s for s, _ in per} == {0, 1, 2, 3}
    assert listed(mixing.mix(df, shards=4), "doc_id", "mix_shard", "mix_order") == listed(sharded, "doc_id", "mix_shard", "mix_order")


@pytest.mark.parametrize("shards", [1, 5, 70])
def test_a_shard_is_a_partition(spark, shards):
    df = spark.range(400).selectExpr("id AS doc_id", "repeat('w ', int(1 + id % 9)) AS text", "string(id % 3) AS source", "id AS __shard")
    dealt = {(r.doc_id, r.mix_shard) for r in mixing.mix(df, shards=shards).select("doc_id", "mix_shard").collect()} if shards > 1 else None
    got = mixing.shuffled(df, shards=shards).selectExpr("*", "spark_partition_id() AS at")
    assert got.columns == [*df.columns, "at"]
    if dealt is not None:
        assert {(r.doc_id, r["at"]) for r in got.collect()} == dealt
    else:
        assert {r["at"] for r in got.collect()} == {0}


def test_report_and_stage_go_through_the_tree(spark, monkeypatch):
    from collections import Counter

    import corpus_pipeline

    df = frame(spark, *["w " * (i % 9 + 1) for i in range(300)]).selectExpr("doc_id", "text", "lang", "concat('s', doc_id % 5) AS source", "n_chars")
    asked, split = [], mixing.split
    monkeypatch.setattr(mixing, "split", lambda units, levels, seed: asked.append(levels) or split(units, levels, seed))
    want = {r.doc_id: r.taken for r in mixing.report(df).collect()}
    rows = corpus_pipeline.mix_sources(spark, df, "").collect()
    assert asked == [[mixing.LEAST_SHARDS]] * 2
    times = Counter(r.doc_id for r in rows)
    assert all(times[r.doc_id] * len(r.text.split()) == want[r.doc_id] for r in df.collect())
    dealt = {}
    for r in mixing.mix(df, shards=mixing.LEAST_SHARDS).collect():
        dealt.setdefault(r.mix_shard, []).append((r.mix_order, r.doc_id))
    order, at = [r.doc_id for r in rows], 0
    while at < len(order):  # whole shards follow each other, each in its order
        own = next(ids for ids in ([i for _, i in sorted(x)] for x in dealt.values()) if order[at : at + len(ids)] == ids)
        at += len(own)


def test_splitting_tree_is_exact_and_a_fair_draw(spark):
    counts = {7: 400, 8: 0, 9: 1200, 10: 3}
    units = spark.createDataFrame([(s * 10_000 + i, s) for s, n in counts.items() for i in range(n)], "unit long, sid int")
    got = mixing.split(units, [3, 5], "seed").collect()
    assert sorted(r.unit for r in got) == sorted(r.unit for r in units.collect())
    from collections import Counter

    leaves = Counter(r.mix_shard for r in got)
    assert set(leaves) == set(range(15)) and max(leaves.values()) - min(leaves.values()) <= 2
    own = Counter((r.mix_shard, r.sid) for r in got)
    # a leaf of 107 units draws about 80 of 1200 of 1603; its standard deviation is 4.4
    assert all(60 <= own[leaf, 9] <= 100 for leaf in leaves) and len({own[leaf, 9] for leaf in leaves}) > 3
    assert sorted(map(tuple, mixing.split(units, [3, 5], "seed").collect())) == sorted(map(tuple, got))
    assert mixing.split(units, [], "seed").select("mix_shard").distinct().collect()[0][0] == 0
    assert mixing.fans(1) == [] and mixing.fans(16) == [16] and mixing.fans(100) == [64, 2]


@pytest.mark.parametrize("case", ["one id a source", "ids shared by sources", "null ids", "one row"])
def test_mix_equals_report_with_repeated_rows(spark, case):
    from collections import Counter

    key = {"one id a source": lambda i: i % 3, "ids shared by sources": lambda i: i % 10, "null ids": lambda i: None if i % 2 else i, "one row": lambda i: 1}[case]
    rows = [(key(i), "w " * (i % 4 + 1), f"s{i % 3}", 1, 2) for i in range(1 if case == "one row" else 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __row int, block int")
    plan = mixing.report(df).collect()
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    taken, drawn = Counter(), Counter()
    for r in plan:
        taken[r.doc_id] += r.taken
        assert r.taken <= 3 * r["size"]
    for r in mixed.collect():
        drawn[r.doc_id] += len(r.text.split())
    assert +taken == +drawn
    if case == "one id a source":
        targets = {r.doc_id: r.target for r in plan}
        assert all(abs(taken[i] - targets[i]) <= 2.5 for i in targets)


def test_a_large_last_block_is_cut_alike(spark, monkeypatch):
    rows = [(1 if i % 3 else i, "w " * (i % 5), f"s{i % 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    usual = listed(mixing.report(df), "doc_id", "size", "target", "taken")
    monkeypatch.setattr(mixing, "WINDOW_ROWS", 1)
    assert listed(mixing.report(df), "doc_id", "size", "target", "taken") == usual


def test_targets_by_water_filling(spark):
    sizes = {"a": 1000, "b": 10, "c": 1, None: 500, "d": 0, "e": 50}
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r.source: (r.weight, r.target) for r in mixing.targets(df).collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, "e": 2, None: 3}
    low, high = 0.0, 1e6
    for _ in range(200):
        unit = (low + high) / 2
        low, high = (unit, high) if sum(min(3 * n, weight[s] * unit) for s, n in sizes.items()) < sum(sizes.values()) else (low, unit)
    assert {s: w for s, (w, _) in got.items()} == weight
    assert all(abs(got[s][1] - min(3 * n, weight[s] * low)) < 1e-6 for s, n in sizes.items())


def test_bpe_round_trip(odd):
    rows = bpe.encode(odd, *_vocabulary(), keep_payload=True, pack_bytes=500).filter("doc_id is not null").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect()}
    for r in rows:
        assert bytes(r.decoded) == texts[r.doc_id] and r.n_tokens == len(r.ids) // 4
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1)} == {0}


def test_long_texts_are_cut_as_short_ones():
    import random

    _, pattern = _vocabulary()
    random.seed(7)
    for _ in range(300):
        text = "".join(random.choice(["a", "b ", "  ", "\n", "'", "ll", "re", "9", "中", ".", "é"]) for _ in range(random.randrange(80)))
        assert [w for own in bpe.pieces(text, pattern, 9) for w in own] == bpe.splitter(pattern)(text)
    assert [w for own in bpe.pieces("x" * 5000, pattern, 9) for w in own] == ["x" * 5000]


def test_a_long_text_is_put_together_in_parts(spark, odd, monkeypatch):
    usual = listed(bpe.encode(odd, *_vocabulary()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    monkeypatch.setattr(bpe, "STEP", 7)
    path, pattern = _vocabulary()
    df = odd.filter("doc_id in (4, 5, 6, 7, 8)")
    # the constants travel with the function, as the workers import the module anew
    emit = {}
    monkeypatch.setattr(bpe.X, "send_packed", lambda df, a, b, c, f: emit.setdefault("send", f))
    monkeypatch.setattr(bpe.X, "answer", lambda sent, reply: emit.setdefault("reply", reply))
    monkeypatch.setattr(bpe.X, "collect", lambda replies, work, schema: emit.setdefault("work", work) and df)
    bpe.encode(df, path, pattern, keep_payload=True)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    texts = exchange.Texts(__import__("pyarrow").table({"id": [i for i, _ in rows], "text": [t.encode() for _, t in rows]}))
    boxes = {}
    for bucket, blob in emit["send"](0, texts):
        boxes.setdefault(bucket, []).append(blob)
    answers = [(bucket, blob) for bucket, blobs in boxes.items() for _, blob in emit["reply"]([0] * len(blobs), blobs)]
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in emit["work"](answers).to_pylist()), key=str)
    assert got == [r for r in usual if r[0] in (4, 5, 6, 7, 8)]


def test_bpe_merge_loops_agree():
    import random

    path, _ = _vocabulary()
    ranks, library = bpe.load_ranks(path), bpe.word_encoder(path)
    random.seed(5)
    for size in (1, 2, 5, 20, 70, 400):
        for _ in range(40):
            word = "".join(random.choice("etaoinshrdlu é中\n") for _ in range(size)).encode()
            assert bpe.encode_word(word, ranks) == list(library(word))


def test_bpe_decode_frame(spark):
    path, _ = _vocabulary()
    ranks = bpe.load_ranks(path)
    df = spark.createDataFrame([(1, bpe.encode_word(b"hello", ranks) + bpe.encode_word(b" world", ranks)), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, path).collect()} == {1: b"hello world", 2: b"", 3: b""}


def test_narrow_pattern_is_the_pattern():
    import random
    import re

    import regex

    _, pattern = _vocabulary()
    random.seed(6)
    for _ in range(3000):
        text = "".join(random.choice("ab  'sdtlrevm\n\t\x1c\x0b ÉÄ9_-.!ßɏ") for _ in range(random.randrange(14)))
        assert regex.findall(bpe.portable(pattern), text) == re.findall(bpe.narrow(pattern), text)


def test_language_edges(spark):
    texts = {"en": "the house and the river with this", "de": "das haus und der fluss mit dem", "fr": "la maison et le fleuve avec une"}
    rows = [(i, f"{texts[k]} {WORDS[i % 20]}", k) for i in range(240) for k in [sorted(texts)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(df)
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "123 !?"), (903, "das haus und der fluss " * 3000), (904, "中")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict(df.select("doc_id", "text").unionByName(extra), model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows) >= 235
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[902].score == 0
    assert got[903].lang_pred == "de" and got[904].lang_pred != "und"
    assert language_id.learn(df.withColumn("lang", df.lang.substr(9, 1)).filter("1 = 0")) is None


def test_disguised_words_are_restored(spark):
    clean = [f"the idiot clown house {WORDS[i % 20]} and stupid river" for i in range(40)]
    model = toxicity.CharModel.of((r.gram, r.n) for r in toxicity.count_trigrams(frame(spark, *clean)).collect())
    restore = toxicity.Restorer(model).restore
    for token, word in (("1d10t", "idiot"), ("cl0wn", "clown"), ("idiiiiot", "idiot"), ("$tupid", "stupid"), ("st*pid", "stupid")):
        assert token in toxicity.disguised(f"you {token} there") and restore(token) == word
    assert "idiot" in toxicity.disguised("an i d i o t said") and toxicity.disguised("plain words only") == []


def test_look_alikes_in_any_position_are_restored(spark):
    clean = [f"you are the asshole {w} idiot kill hate moron {WORDS[i % 20]} stupid fag ass and a letter or " for i in range(40) for w in ("idiots", "morons")]
    restorer = toxicity.Restorer(toxicity.CharModel.of((r.gram, r.n) for r in toxicity.count_trigrams(frame(spark, *clean)).collect()))
    for text, word in (("a55", "ass"), ("ki11", "kill"), ("hat3", "hate"), ("moron5", "morons"), ("1d1075", "idiots"), ("@$$hole", "asshole"), ('"$tupid"', "stupid"), ("($tupid)", "stupid"), ("f a g", "fag"), ("i  d  i  o  t", "idiot"), ("i - d - i - o - t", "idiot"), ("a $ $", "ass"), ("iiddiioott", "idiot"), ("idiot!!", "idiot"), ("_id10t_", "idiot")):
        assert word in toxicity.words_of(f"you {text} there", restorer), text
    model = toxicity.Model(None, {"idiot": 2.0, "asshole": 1.5, "kill*": 1.0, "fag": 1.0}, -2.0, 1.0, 0.0)
    fewer = toxicity.Restorer(toxicity.CharModel(restorer.logp), model.runs)
    for text in ("iiddiioott", "aasshhoollee", "kkiilllleerr", "ffaagg", "letter", "aass", "kiill"):
        assert model.score(toxicity.words_of(text, restorer)) == model.score(toxicity.words_of(text, fewer))
    assert fewer.words("letter") == ("letter",)
    assert toxicity.words_of("plain words, 1 2 3 + 4", restorer) == {"plain", "words"}


def test_long_disguises_are_restored(spark):
    clean = [f"you are the idiot clown house {WORDS[i % 20]} and a stupid river moron" for i in range(40)]
    restorer = toxicity.Restorer(toxicity.CharModel.of((r.gram, r.n) for r in toxicity.count_trigrams(frame(spark, *clean)).collect()))
    said = "you are the stupid idiot and the moron house and the river and the clown"
    run = " ".join(said.replace(" ", ""))
    assert set(said.split()) <= toxicity.words_of(run, restorer)
    assert set(said.split()) <= toxicity.words_of(" ".join([run] * 20), restorer)
    assert "idiot" in toxicity.words_of("an idi" + "o" * 500 + "t", restorer)
    assert len(restorer.restore("1d10t" * 20_000)) == 100_000


def test_toxicity_held_out(spark):
    import zlib

    rows = [(i, f"{WORDS[i % 20]} {WORDS[i * 7 % 20]} {['good', 'idiot', 'fine', 'nice'][i % 4]} {WORDS[i * 3 % 20]} {i}") for i in range(400)]
    docs = spark.createDataFrame([*rows, (990, None), (991, ""), (992, "you 1d10t"), (993, "an i d i o t here"), (994, "fine " * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 1)) for i, _ in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert all(got[i].predicted == int(i % 4 == 1) for i, _ in rows)
    assert [got[i].predicted for i in (990, 991, 992, 993, 994)] == [0, 0, 1, 1, 0]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 405 - 102
    nothing = toxicity.learn(docs, labels.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).isEmpty()


def test_warc_edges(spark):
    rows = [(1, "http://www.example.com/a?b", "x", 1), (2, "https://u@Example.com:80/", "x", 1), (3, None, None, 1), (4, "not a url\n", "", 1), (None, "http://a.b/", "x", 1), (5, "http://Ä.de/ü%20", "y" * 300_000, 1), (2, "https://u@Example.com:80/", "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, at long")
    directory = warc.write_archives(df, block_lines=2, archive_bytes=500)
    got = listed(warc.read_archives(directory), "page_id", "url", "payload_bytes", "record_type", "refers_to")
    assert got == sorted([(1, rows[0][1], 1, "revisit", 2), (2, rows[1][1], 1, "response", None), (2, rows[1][1], 1, "response", None), (3, None, 0, "revisit", 4), (4, "not a url\n", 0, "response", None), (None, "http://a.b/", 1, "response", None), (5, rows[5][1], 300_000, "response", None)], key=str)
    assert listed(warc.look_up(directory, df.filter("page_id in (1, 4, 5)").select("url")), "page_id") == [(1,), (4,), (5,)]
    assert warc.look_up(directory, spark.createDataFrame([("http://none.example/",)], "url string")).isEmpty()
    assert listed(warc.look_up(directory, df.select("url")), "page_id", "record_type", "refers_to") == [(r[0], r[3], r[4]) for r in got]
    assert warc.round_trip(df.limit(0)).isEmpty()


def test_a_key_on_many_blocks_and_clashing_columns(spark):
    rows = [(i, "http://hot.example/" if i % 3 else f"http://h{i % 7}.example/{i}", f"page {i % 50}", "k", 1, 2, "s", 3) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, key string, page long, keeper long, sha string, size long")
    directory = warc.write_archives(df, block_lines=7, archive_bytes=3000)
    assert directory.count() > 40
    assert len(listed(warc.look_up(directory, df.filter("page_id = 1").select("url")), "page_id")) == 200
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert sorted(got) == list(range(300)) and all(got[i].refers_to == (None if i >= 250 else i % 50 + 250) for i in got)


def test_reads_are_counted():
    import io

    class Counted(io.BytesIO):
        reads = 0

        def read(self, *a):
            Counted.reads += 1
            return super().read(*a)

    import zlib

    members, places, at = [], [], 0
    for i in range(500):
        gzip = zlib.compressobj(4, zlib.DEFLATED, 31)
        member = gzip.compress(warc.record(i, "http://a.b/", b"x" * i, None, "1970-01-01T00:00:00Z")) + gzip.flush()
        members.append(member)
        places.append((at, len(member)))
        at += len(member)
    source = Counted(b"".join(members))
    found = [r["page_id"] for span in warc.spans(places) for r in warc.read_span(source, span)]
    assert found == list(range(500)) and Counted.reads == 1
    apart = places[:10] + places[20:30]
    assert [len(x) for x in warc.spans(apart)] == [10, 10] and len(list(warc.spans(places, 5000))) <= 2 * at // 5000 + 1


def test_url_keys(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("http://www.Example.com/P?q=1",), ("mailto:x",), (None,)], "u string")
    assert [r[0] for r in df.select(warc.url_key(F.col("u"))).collect()] == ["com,example,www)/P?q=1", "!mailto:x", "!"]


def test_language_logits_against_every_gram():
    random = np.random.default_rng(2)
    model = language_id.Model(["a", "b", "c"], random.normal(size=(language_id.ROWS, 3)).astype(np.float32), np.zeros(3, np.float32), 1.0, 0.0)
    texts = [b"Hello World", b"", "Ünïcode ÄÖ 中文".encode(), b"x", b"12 34"]
    offsets = np.cumsum([0, *map(len, texts)])
    got = language_id.logits(model, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for i, text in enumerate(texts):
        data = np.concatenate([language_id.clean(np.frombuffer(text, np.uint8)), np.full(4, 32, np.uint8)])
        rows = []
        for size in language_id.GRAMS:
            for k in range(len(text)):
                h = size * 0x9E3779B1 & 0xFFFFFFFF
                for j in range(size):
                    h = (h ^ int(data[k + j])) * int(language_id._STEP[j]) & 0xFFFFFFFF
                h ^= h >> 15
                rows.append((h * 0x2C1B3C6D & 0xFFFFFFFF) >> 16)
        want = model.table[rows].astype(float).mean(0) if rows else np.zeros(3)
        assert np.allclose(got[i], want, atol=1e-5)
        where, counts = language_id.histogram(text)
        assert sorted(np.repeat(where, counts).tolist()) == sorted(rows)


def test_language_is_learned_with_clashing_columns(spark):
    texts = {"en": "the house and the river with this", "de": "das haus und der fluss mit dem"}
    rows = [(i, texts[k] + f" {i}", k, 1, "r", "c") for i in range(80) for k in [sorted(texts)[i % 2]]]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, lang string, pick long, rows string, id string")
    got = language_id.predict(df, language_id.learn(df)).collect()
    assert len(got) == 81 and sum(r.lang_pred == sorted(texts)[r.doc_id % 2] for r in got) >= 79


def test_audio_silence_in_many_recordings_does_not_multiply(spark):
    random = np.random.default_rng(9)
    rows, asked = [], []
    for i in range(1000):
        fp = np.concatenate([random.integers(1, 1 << 30, 30), np.zeros(200, int), random.integers(1, 1 << 30, 10)])
        rows.append((i, fp.tolist(), "k", 1))
        if i % 250 == 0:
            asked.append((i, fp[5:].tolist()))
    reps = spark.createDataFrame(rows, "class_id long, fp array<int>, key string, offset int")
    queries_ = spark.createDataFrame(asked, "query_id long, fp array<int>")
    assert audio.places(reps.select("class_id", "fp"), "class_id").count() == 1000 * 41
    # alone, silence aligns at many offsets; the true one has no error
    got = audio.align(queries_, reps.select("class_id", "fp"), votes=195, most=0.02)
    assert {(r.query_id, r.class_id, r.offset, r.n_votes) for r in got.collect() if r.bit_error == 0} == {(i, i, 5, 235) for i, _ in asked}


def test_audio_edges(spark):
    tune = audio.melody(np.linspace(-1, 1, 64))
    stereo = bytearray(audio.wav(np.repeat(tune, 2)))
    stereo[22:24], stereo[32:34] = (2).to_bytes(2, "little"), (4).to_bytes(2, "little")
    rows = [(1, audio.wav(tune)), (2, audio.wav(tune)), (3, None), (4, b""), (5, b"RIFFjunk"), (6, audio.wav(tune[:900])), (7, audio.wav(np.zeros(40_000))), (8, bytes(stereo)), (1, audio.wav(tune))]
    df = spark.createDataFrame(rows, "id long, audio binary")
    clip = spark.createDataFrame([(100, audio.wav(tune[10_240:35_000])), (101, None)], "id long, audio binary")
    got = audio.search(df, clip).collect()
    match = {(r.query_id, r.class_id, r.offset) for r in got if r.kind == "match"}
    assert (100, 1, 20) in match and {c for _, c, _ in match} <= {1, 8}
    member = sorted((r.query_id, r.class_id) for r in got if r.kind == "member")
    assert member[:6] == [(1, 1), (1, 1), (2, 1), (3, 3), (4, 4), (5, 5)] and len(member) == 9
    assert audio.search(df.limit(0), clip.limit(0)).isEmpty()


def test_trees_keep_their_recall_in_the_deepest_nodes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE", 1)
    random = np.random.default_rng(4)
    one = random.integers(0, 1 << 32, (2000, 64), dtype=np.uint32)
    two = np.where(random.random(one.shape) < 0.8, one, random.integers(0, 1 << 32, one.shape, dtype=np.uint32))
    rows = [(2 * i + j, x[i].tobytes()) for i in range(len(one)) for j, x in enumerate((one, two))]
    reps = spark.createDataFrame(rows, "class_id long, sketch binary")
    found = near_dedup._candidates(reps, near_dedup.TREES, 0.8)[0].filter("a <> b").selectExpr("least(a, b) AS a").distinct().count()
    assert len(one) - found <= 3
    for threshold in (0.8, 0.85):
        assert near_dedup.missed(threshold, near_dedup.branching(threshold, near_dedup.TREES, near_dedup.DEPTH), near_dedup.TREES, near_dedup.DEPTH) <= near_dedup.MISS


def test_near_hot_group_against_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(near_dedup, "NODE", 8)
    monkeypatch.setattr(near_dedup, "DEPTH", 2)
    random.seed(5)
    rows = []
    for i in range(200):
        words = [f"w{k}" for k in range(100)]
        for _ in range(random.choice([0, 1, 2, 3])):
            words[random.randrange(100)] = f"x{random.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(f"z{random.randrange(10**6)}" for _ in range(random.randrange(30)))) for i in range(200, 240)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=20).collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, t in rows for w in [t.split()]}
    up = near_dedup.Sets(240)
    for i in range(240):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                up.join(i, j)
    assert got == {i: up.find(i) for i in range(240)}


def test_a_long_chain_with_sparse_links_is_compared_in_linear_time(spark, monkeypatch):
    """Neighbours in the chain share 93 of 100 words' shingles, every twentieth link is broken; one component of sketches."""
    count, step = 20_000, 4
    rows = []
    for i in range(count):
        begin = i * step + 8 * (i // 20)  # after each twenty documents a wider step, under the threshold
        rows.append((i, " ".join(f"w{k}" for k in range(begin, begin + 100))))
    named, real = [], near_dedup.materialise
    monkeypatch.setattr(near_dedup, "materialise", lambda df, tag, *a: named.append((tag, real(df, tag, *a))) or named[-1][1])
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=64).collect()}
    assert got == {i: i // 20 * 20 for i in range(count)}
    sizes = {tag: df.count() for tag, df in named}
    assert 0 < sizes["pairs"] <= 20 * count and sizes["hashes"] <= count


def test_packs_hold_whole_texts(spark, odd):
    packs = exchange.pack(odd, "doc_id", "text", 100)
    chunks = [exchange.Texts(bytes(r.blob)) for r in packs.collect()]
    assert sum(map(len, chunks)) == odd.count() and packs.select("chunk").distinct().count() == packs.count()
    assert sum(len(c.data) for c in chunks) == sum(len((r.text or "").encode()) for r in odd.collect())


def test_squeezed_arrays_come_back():
    random = np.random.default_rng(1)
    for kind in (np.uint32, np.uint64):
        values = np.sort(random.integers(0, np.iinfo(kind).max, 1000, dtype=kind))
        assert (exchange.expand(exchange.squeeze(values), kind) == values).all()
        assert (exchange.unplanes(exchange.planes(values), kind) == values).all()
    assert len(exchange.expand(exchange.squeeze(np.zeros(0, np.uint64)))) == 0


def test_packs_and_buckets_grow_with_the_input(spark):
    from pyspark.sql import functions as F

    small = frame(spark, "x" * 100)
    assert exchange.plan(small, "text") == (exchange.PACK_BYTES, 4)
    assert exchange.plan(small, "text", 10) == (10, 4 + 100 // 80)
    assert exchange.plan(small.limit(0), "text") == (exchange.PACK_BYTES, 4)
    assert exchange.plan(small.select(F.lit(None).cast("string").alias("text")), "text") == (exchange.PACK_BYTES, 4)


def test_rows_from_a_shuffle_are_written_first(spark):
    shuffled = frame(spark, *WORDS).repartition(3)
    assert "Exchange" not in exchange.pack(shuffled, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_chain_a_star_and_repeats(spark):
    from linkweave.llm.components import components

    edges = [(i + 1, i) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2), (2, 3)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_components_of_a_group_whose_ids_are_all_linked(spark, monkeypatch):
    """The rounds' joins get about as many edges as ids, not the square of a group's size."""
    from pyspark.sql import functions as F

    from linkweave.llm import components as C

    monkeypatch.setattr(C, "EDGES", 2000)
    joined, star = [], C._large_star
    monkeypatch.setattr(C, "_large_star", lambda edges: joined.append(edges.count()) or star(edges))
    group = spark.range(200).select(F.col("id").alias("a")).crossJoin(spark.range(200).select(F.col("id").alias("b"))).filter("a < b")
    chain = spark.range(1000, 1100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = {r.id: r.label for r in C.components(group.unionByName(chain)).collect()}
    assert out == {i: 0 for i in range(200)} | {i: 1000 for i in range(1000, 1101)}
    assert max(joined) <= 2000 < group.count()
