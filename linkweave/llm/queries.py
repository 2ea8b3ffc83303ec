"""The queries of the subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import audio, bpe, exact_dedup, language_id, mixing, near_dedup, substring_dedup, suffix_dedup, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("class_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds recordings, so every row of ``embeddings`` is rendered as one; queries are noisy
    clips of the rows whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    clips = audio.render(vectors.filter("vec_id % 50 = 0"), "vec_id", "embedding", begin=0.3, end=0.9, noise=0.01)
    return audio.search(audio.render(vectors, "vec_id", "embedding"), clips)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": SUBSTRING_SQL, "op5_warc": WARC_SQL, "op3_mixing": MIXING_SQL, "op4_minhash_near_dedup": NEAR_DEDUP_SQL, "op9_exact_dedup": EXACT_DEDUP_SQL}


EXACT_DEDUP_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""

MIXING_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight FROM s),
fill(step, total, capped_words, capped_weight) AS (
  SELECT 0, (SELECT sum(source_size) FROM w), CAST(0 AS HUGEINT), CAST(0 AS HUGEINT)
  UNION ALL
  SELECT step + 1, total,
    (SELECT coalesce(sum(3 * source_size), 0) FROM w WHERE 3 * source_size / weight < (f.total - f.capped_words) / ((SELECT sum(weight) FROM w) - f.capped_weight)),
    (SELECT coalesce(sum(weight), 0) FROM w WHERE 3 * source_size / weight < (f.total - f.capped_words) / ((SELECT sum(weight) FROM w) - f.capped_weight))
  FROM fill f WHERE step < 40 AND f.capped_weight < (SELECT sum(weight) FROM w)),
unit AS (SELECT (total - capped_words) / ((SELECT sum(weight) FROM w) - capped_weight) AS u FROM fill ORDER BY step DESC LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size / weight < u THEN CAST(3 * source_size AS DOUBLE) ELSE weight * u END AS target FROM w, unit),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, least(floor(coalesce(t.target / nullif(t.source_size, 0), 0)), 3) AS passes,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || d.doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (passes + CASE WHEN seen + size / 2 <= target - passes * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

NEAR_DEDUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id
"""

SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
low AS (SELECT s, min(doc_id) AS low FROM win GROUP BY s),
hit AS (SELECT win.doc_id, win.i FROM win JOIN low ON win.s = low.s WHERE low.low < win.doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit CROSS JOIN range(13) r(k)),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM w),
kept AS (SELECT pos.doc_id, string_agg(pos.word, ' ' ORDER BY pos.p) AS kept FROM pos LEFT JOIN gone ON gone.doc_id = pos.doc_id AND gone.p = pos.p WHERE gone.p IS NULL GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages),
g AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)) AS fives FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((fives[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper = page_id THEN NULL ELSE keeper END AS refers_to
FROM g
"""
