"""Chroma fingerprints of a media column, and alignment of recordings by them.

A recording (a WAV file in a binary column) becomes frames of energy per pitch class; rectangles of that
image, summed through its integral image, are compared by sixteen filters, each of which gives two bits
in Gray code: a packed 32-bit integer per frame. Two recordings of the same sound share many integers at
one offset, so an index from integers to places finds them: hits are counted by (recording, offset), and
the best offsets are confirmed by the share of differing bits over the whole overlap.

Recordings with equal fingerprints form a class, represented by its smallest id; only classes are
compared. The index holds every integer of every class, nothing is sampled or capped. A stretch of one
integer (silence, a held tone) is one row of the index, and meets another at the sum of their lengths of
offsets; a key that many classes share is split by adaptive execution like any skewed join.

Defined results: null, empty or unreadable audio, and audio shorter than the filters' width, has an
empty fingerprint, is a member of a class of its own and matches nothing; silence has fingerprints like
any sound; stereo is mixed down and other sample rates are interpolated; repeated rows are members of one
class; of offsets of equal error the one with more overlap wins, then the smaller; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.batches import small_batches, tidy
from linkweave.sources.storage import materialise

RATE = 5512
FRAME = 2048
HOP = 512
LOW_HZ, HIGH_HZ = 110.0, 2637.0
#: Longest filter, in frames.
SPAN = 16
#: Hits at one offset that make a candidate, frames of overlap, and the share of bits that may differ.
VOTES = 3
OVERLAP = 20
BIT_ERROR = 0.2


def wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """Mono 16-bit PCM."""
    data = (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def read_wav(raw: bytes | None) -> np.ndarray:
    """Samples at ``RATE``; nothing if the bytes are no 16-bit PCM file."""
    none = np.zeros(0)
    if not raw or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        return none
    at, channels, rate, bits = 12, 0, 0, 0
    while at + 8 <= len(raw):
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        if name == b"fmt " and size >= 16:
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", raw, at + 8)
            if kind != 1:
                return none
        if name == b"data":
            if bits != 16 or not channels or not rate:
                return none
            body = raw[at + 8 : at + 8 + size]
            samples = np.frombuffer(body[: len(body) // (2 * channels) * 2 * channels], "<i2").reshape(-1, channels).mean(1) / 32768
            if rate != RATE and len(samples):
                samples = np.interp(np.arange(0, len(samples), rate / RATE), np.arange(len(samples)), samples)
            return samples
        at += 8 + size + size % 2
    return none


def _pitch_classes() -> np.ndarray:
    """Frequency bins x 12: which pitch class a bin counts for."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    table = np.zeros((len(hz), 12))
    inside = np.flatnonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))
    table[inside, np.round(12 * np.log2(hz[inside] / 440.0)).astype(int) % 12] = 1
    return table


_CLASSES = _pitch_classes()
_HANN = np.hanning(FRAME)
_SMOOTH = np.array([0.25, 0.75, 1.0, 0.75, 0.25]) / 3.0


def chroma(samples: np.ndarray) -> np.ndarray:
    """Frames x 12, smoothed over time, each of unit length (zero where there is no energy)."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP] * _HANN
    energy = (np.abs(np.fft.rfft(frames)) ** 2) @ _CLASSES
    if len(energy) < len(_SMOOTH):
        return np.zeros((0, 12))
    smooth = sum(w * energy[i : len(energy) - len(_SMOOTH) + 1 + i] for i, w in enumerate(_SMOOTH))
    norm = np.sqrt((smooth**2).sum(1, keepdims=True))
    return np.where(norm > 1e-6, smooth / np.maximum(norm, 1e-12), 0.0)


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, pitch classes, frames) by rule: four kinds of split over four places,
    from wide and short to narrow and long."""
    return [(kind, (3 * step + kind) % 9, 3 + (step + kind) % 2, 4 * (step + 1)) for step in range(4) for kind in range(4)]


FILTERS = _filters()


def fingerprint(image: np.ndarray) -> np.ndarray:
    """A packed integer for every frame from which the longest filter fits."""
    count = len(image) - SPAN + 1
    if count <= 0:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(0).cumsum(1)
    at = np.arange(count)

    def area(t0, t1, c0, c1):
        return total[at + t1, c1] - total[at + t0, c1] - total[at + t1, c0] + total[at + t0, c0]

    out = np.zeros(count, np.uint32)
    for kind, low, height, width in FILTERS:
        high, middle, half = low + height, low + (height + 1) // 2, width // 2
        if kind == 0:  # later against earlier
            a, b = area(half, width, low, high), area(0, half, low, high)
        elif kind == 1:  # higher against lower
            a, b = area(0, width, middle, high), area(0, width, low, middle)
        elif kind == 2:  # diagonal
            a = area(0, half, low, middle) + area(half, width, middle, high)
            b = area(0, half, middle, high) + area(half, width, low, middle)
        else:  # against all other pitch classes
            a = area(0, width, low, high)
            b = area(0, width, 0, 12) * height / 12
        value = np.log((1 + a) / (1 + b))
        level = np.digitize(value, (-0.25, 0.0, 0.25)).astype(np.uint32)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))
    return out


def fingerprints(df: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """id, fp: the packed integers of every recording (as signed 32-bit)."""

    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                fps = [fingerprint(chroma(read_wav(raw.as_py()))).view(np.int32) for raw in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.list_(pa.int32()))], names=["id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("audio")).mapInArrow(tidy(run), "id long, fp array<int>")


def classes(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: id, class_id; classes: class_id, fp). Equal fingerprints are aggregated, never gathered."""
    keyed = fps.withColumn("key", F.when(F.size("fp") > 0, F.sha2(F.array_join("fp", ",").cast("binary"), 256)))
    groups = materialise(keyed.filter("key is not null").groupBy("key").agg(F.min("id").alias("class_id")), "classes")
    members = keyed.select("id", "key").join(groups, "key", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
    reps = keyed.join(groups.select("class_id"), F.col("id") == F.col("class_id"), "left_semi").filter("key is not null")
    return members, reps.select(F.col("id").alias("class_id"), "fp").dropDuplicates(["class_id"])


def bit_error(a: Column, b: Column, offset: Column) -> Column:
    """Share of differing bits where frame i of ``a`` meets frame i + offset of ``b``."""
    start = F.greatest(F.lit(0), -offset)
    length = F.least(F.size(a) - start, F.size(b) - start - offset)
    differ = F.zip_with(F.slice(a, start + 1, length), F.slice(b, start + offset + 1, length), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda s, x: s + x) / (32 * length)


def places(fps: DataFrame, id_col: str) -> DataFrame:
    """id, key, begin, length: the stretches of equal integers of a fingerprint."""
    n = F.size("fp")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("fp", i) != F.get("fp", i - 1)))
    edged = fps.filter(n > 0).select(id_col, "fp", F.concat(starts, F.array(n)).alias("edges"))
    runs = edged.select(id_col, "fp", "edges", F.posexplode(F.slice("edges", F.lit(1), F.size("edges") - 1)).alias("i", "begin"))
    return runs.select(id_col, F.get("fp", F.col("begin")).alias("key"), "begin", (F.get("edges", F.col("i") + 1) - F.col("begin")).alias("length"))


def align(queries: DataFrame, reps: DataFrame, votes: int = VOTES, overlap: int = OVERLAP, most: float = BIT_ERROR) -> DataFrame:
    """queries: query_id, fp; reps: class_id, fp -> query_id, class_id, offset (frames by which the query
    begins after the recording does), n_votes, n_overlap, bit_error; the best offset of each pair."""
    probes = places(queries, "query_id").withColumnsRenamed({"begin": "q", "length": "m"})
    index = places(reps, "class_id").withColumnsRenamed({"begin": "p", "length": "l"})
    low, high = F.col("p") - F.col("q") - F.col("m") + 1, F.col("p") + F.col("l") - 1 - F.col("q")
    met = index.join(probes, "key").select("query_id", "class_id", "l", "m", low.alias("low"), high.alias("high"))
    # two stretches of one integer meet at l + m - 1 offsets, not at l * m pairs of frames
    met = met.withColumn("offset", F.explode(F.sequence("low", "high")))
    votes_here = F.least("l", "m", F.col("offset") - F.col("low") + 1, F.col("high") - F.col("offset") + 1)
    hits = met.groupBy("query_id", "class_id", "offset").agg(F.sum(votes_here).alias("n_votes")).filter(F.col("n_votes") >= votes)
    both = hits.join(queries.withColumnRenamed("fp", "a"), "query_id").join(reps.withColumnRenamed("fp", "b"), "class_id")
    start = F.greatest(F.lit(0), -F.col("offset"))
    both = both.withColumn("n_overlap", F.least(F.size("a") - start, F.size("b") - start - F.col("offset"))).filter(F.col("n_overlap") >= overlap)
    both = both.withColumn("bit_error", bit_error(F.col("a"), F.col("b"), F.col("offset"))).filter(F.col("bit_error") <= most)
    best = Window.partitionBy("query_id", "class_id").orderBy("bit_error", F.desc("n_overlap"), "offset")
    return both.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select("query_id", "class_id", "offset", "n_votes", "n_overlap", "bit_error")


def melody(vector: np.ndarray, note: int = 660) -> np.ndarray:
    """A recording for a row of numbers, as the tables have none: a tone and its octave per number."""
    pitch = np.floor((np.argsort(np.argsort(vector)) * 7919 + np.abs(np.round(vector * 1000)).astype(int)) % 36)
    hz = np.repeat(220.0 * 2 ** (pitch / 12), note)
    phase = 2 * np.pi * np.cumsum(hz) / RATE
    return 0.4 * np.sin(phase) + 0.2 * np.sin(2 * phase)


def render(df: DataFrame, id_col: str, vector_col: str, begin: float = 0.0, end: float = 1.0, noise: float = 0.0) -> DataFrame:
    """id, audio: WAV files from vectors; a stretch of each, with noise, for queries."""

    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                files = []
                for key, values in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not values:
                        files.append(None)
                        continue
                    sound = melody(np.nan_to_num(np.array([0.0 if v is None else v for v in values])))
                    sound = sound[int(begin * len(sound)) : int(end * len(sound))]
                    random = np.random.default_rng(abs(key or 0))
                    files.append(wav(sound + noise * random.standard_normal(len(sound)) if noise else sound))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(files, pa.binary())], names=["id", "audio"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(tidy(run), "id long, audio binary")


def search(recordings: DataFrame, clips: DataFrame, id_col: str = "id", audio_col: str = "audio") -> DataFrame:
    """All clips against all recordings. Rows of kind 'match' hold a clip and a class of recordings, rows
    of kind 'member' a recording and its class."""
    fps = materialise(fingerprints(recordings, id_col, audio_col), "fingerprints")
    members, reps = classes(fps)
    asked = materialise(fingerprints(clips, id_col, audio_col), "clips").select(F.col("id").alias("query_id"), "fp")
    found = align(asked, materialise(reps, "reps"))
    none = F.lit(None)
    match = found.select(F.lit("match").alias("kind"), "query_id", "class_id", "offset", "n_votes", "n_overlap", "bit_error")
    member = members.select(F.lit("member").alias("kind"), F.col("id").alias("query_id"), "class_id", none.cast("int").alias("offset"), none.cast("long").alias("n_votes"), none.cast("int").alias("n_overlap"), none.cast("double").alias("bit_error"))
    return match.unionByName(member)
