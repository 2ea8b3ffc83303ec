"""The registered queries over the smallest tables: against SQL where there is some, else brute force."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from linkweave.llm import audio, queries

from ..conftest import DATA

SQL = queries.oracle_sql()


def rows_of(spark, name):
    return {r[0]: r for r in queries.queries()[name](spark, DATA).collect()}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, agree):
    assert agree(queries.queries()[name], SQL[name]) > 0


def test_ten_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_op1_brute_force(spark, texts):
    got = rows_of(spark, "op1_substring_dedup")
    words = {i: t.encode().split() for i, t in texts.items()}
    least: dict = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(i, least.get(key, i))
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())


def test_op2_brute_force(spark, texts):
    got = rows_of(spark, "op2_suffix_dedup")
    raw = {i: t.encode() for i, t in texts.items()}
    seen = Counter(t[k : k + 200] for t in raw.values() for k in range(len(t) - 199))
    for i, t in raw.items():
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_op3_comes_near_its_targets(spark):
    df = queries.op3_mixing(spark, DATA).toPandas()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").toPandas()
    df = df.merge(docs, on="doc_id")
    assert (df.taken <= 3 * df["size"]).all()
    for _, own in df.groupby("source"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= own["size"].max() / 2 + 1
    assert df.groupby("source").target.first().sum() == pytest.approx(df["size"].sum())


def test_op5_brute_force(spark):
    got = rows_of(spark, "op5_warc")
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    keeper: dict = {}
    for i, raw in pages.items():
        keeper[raw] = max(i, keeper.get(raw, i))
    assert got.keys() == pages.keys()
    for i, raw in pages.items():
        keep = keeper[raw]
        want = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if keep == i else "revisit", None if keep == i else keep)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want


def test_op6_brute_force(spark):
    rows = queries.op6_audio_fingerprints(spark, DATA).collect()
    vectors = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    fps = {i: audio.fingerprint(audio.chroma(audio.read_wav(audio.wav(audio.melody(v))))) for i, v in vectors.items()}
    assert {r.query_id for r in rows if r.kind == "member"} == set(vectors)
    want = set()
    for i, v in vectors.items():
        if i % 50:
            continue
        sound = audio.melody(v)
        clip = sound[int(0.3 * len(sound)) : int(0.9 * len(sound))]
        q = audio.fingerprint(audio.chroma(audio.read_wav(audio.wav(clip + 0.01 * np.random.default_rng(i).standard_normal(len(clip))))))
        for j, f in fps.items():
            for offset in range(-len(q) + audio.OVERLAP, len(f) - audio.OVERLAP + 1):
                a = max(0, -offset)
                n = min(len(q) - a, len(f) - a - offset)
                if n >= audio.OVERLAP and np.bitwise_count(q[a : a + n] ^ f[a + offset : a + offset + n]).sum() / 32 / n <= audio.BIT_ERROR:
                    want.add((i, j))
    found = {(r.query_id, r.class_id) for r in rows if r.kind == "match"}
    assert found <= want and len(found) >= 0.9 * len(want) > 0


def test_op7_same_as_the_library(spark, texts):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(spark, "op7_byte_bpe")
    for i, text in texts.items():
        ids = library.encode_ordinary(text)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want



def test_op8_shape(spark, texts):
    got = rows_of(spark, "op8_toxicity")
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op10_held_out(spark, texts):
    got = rows_of(spark, "op10_language_id")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    held = [i for i, r in got.items() if r.held_out]
    assert set(held) == {i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(got[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
