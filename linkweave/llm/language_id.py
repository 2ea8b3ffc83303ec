"""Language ID: averaged hashed subword embeddings with a linear softmax.

Byte n-grams of the lower-cased text (all but letters become one blank) are hashed to rows of an
embedding; a text is the mean of its rows, and a linear softmax reads the language from the mean. The
model is trained by stochastic gradient descent in numpy, on the driver, from a bounded sample (``SAMPLE``
documents, whole texts, each as a histogram over the rows); a tenth of the sample is held back, on which
the temperature of the scores and the rejection threshold are calibrated. As the mean and the last layer
are linear, both are folded into one table of a row of logits per n-gram hash, so that scoring is three
look-ups per byte.

Defined results: ``und`` with score 0 if the text is null or has no letter; a text of any length is
read whole; repeated rows get equal rows; rows without a language or id are never learned from; if
nothing can be learned every text is ``und``; of languages that score equally the first by name is
predicted; other columns, whatever their names, are ignored. ``rejected`` marks texts whose
score is below the calibrated threshold.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm import rolling as R
from linkweave.llm.batches import slices, small_batches, text_bytes, tidy

SAMPLE = 3000
PIECE_BYTES = 1 << 20
ROWS = 1 << 16
DIMENSION = 16
GRAMS = (2, 3, 4)
EPOCHS = 4
#: A small sample is gone through more often, for so many steps.
STEPS = 300
BATCH = 128
#: The share of accepted texts of the held-back part that may be wrong.
ERROR = 0.005
_STEP = (np.uint32(0x01000193), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F))


@dataclasses.dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def clean(data: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case and all bytes of other letters stay; the rest is blank."""
    table = np.full(256, 32, np.uint8)
    table[128:] = np.arange(128, 256)
    for a in (65, 97):
        table[a : a + 26] = np.arange(97, 123)
    out = table[data]
    # capitals of the Latin-1 letters: the second byte after 0xC3
    capital = np.zeros(len(out), bool)
    capital[1:] = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E)
    out[capital] += 32
    return out


def gram_rows(data: np.ndarray, size: int) -> np.ndarray:
    """The embedding row of every n-gram of ``size`` bytes (as many as bytes, the last ones cut short)."""
    h = np.full(len(data), size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(size):
        h[: len(data) - k] = (h[: len(data) - k] ^ data[k:]) * _STEP[k]
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int64)


def histogram(text: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, counts) of all n-grams of a whole text."""
    data = clean(np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text)
    data = np.concatenate([data, np.full(max(GRAMS), 32, np.uint8)])
    count = np.zeros(ROWS, np.int64)
    for begin in range(0, len(data) - max(GRAMS), PIECE_BYTES):
        part = data[begin : begin + PIECE_BYTES + max(GRAMS)]
        for size in GRAMS:
            count += np.bincount(gram_rows(part, size)[: min(PIECE_BYTES, len(part) - max(GRAMS))], minlength=ROWS)
    rows = np.flatnonzero(count)
    return rows, count[rows]


def train(sample: list[tuple[np.ndarray, np.ndarray]], languages: list[str], seed: int = 1) -> Model:
    """Fit on the histograms of some texts and their languages; every tenth is only used to calibrate."""
    names = sorted(set(languages))
    random = np.random.default_rng(seed)
    label_of = np.array([names.index(x) for x in languages])
    held_of = np.arange(len(sample)) % 10 == 9
    share = [(counts / counts.sum()).astype(np.float32) for _, counts in sample]
    embedding = random.normal(0, 0.1, (ROWS, DIMENSION)).astype(np.float32)
    weight = random.normal(0, 0.1, (DIMENSION, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    learn = np.flatnonzero(~held_of)
    turn = len(learn) // BATCH + 1
    epochs = max(EPOCHS, -(-STEPS // turn)) if len(names) > 1 else 0
    steps, step = max(1, epochs * turn), 0
    for _ in range(epochs):
        random.shuffle(learn)
        for begin in range(0, len(learn), BATCH):
            chosen = learn[begin : begin + BATCH]
            flat = np.concatenate([sample[i][0] for i in chosen])
            part = np.concatenate([share[i] for i in chosen])
            count = np.array([len(sample[i][0]) for i in chosen])
            edge = np.concatenate([[0], np.cumsum(count)[:-1]])
            mean = np.add.reduceat(embedding[flat] * part[:, None], edge)
            wrong = softmax(mean @ weight + bias)
            wrong[np.arange(len(chosen)), label_of[chosen]] -= 1
            rate = np.float32(0.8 * (1 - step / steps) + 0.01)
            back = (wrong @ weight.T).astype(np.float32)
            weight -= rate / len(chosen) * (mean.T @ wrong).astype(np.float32)
            bias -= rate / len(chosen) * wrong.sum(0).astype(np.float32)
            # every occurrence of a row moves it; scaled up, as each n-gram has a small share of the mean
            owner = np.repeat(np.arange(len(chosen)), count)
            for j in range(DIMENSION):
                embedding[:, j] -= rate * 20 * np.bincount(flat, back[owner, j] * part, ROWS).astype(np.float32)
            step += 1
    table = (embedding @ weight).astype(np.float32)
    temperature, threshold = 1.0, 0.0
    test = np.flatnonzero(held_of)
    if len(test) and len(names) > 1:
        scores = np.stack([share[i] @ table[sample[i][0]] for i in test]) + bias
        choices = np.geomspace(0.25, 8, 41)
        loss = [-np.log(softmax(scores / t)[np.arange(len(test)), label_of[test]] + 1e-12).mean() for t in choices]
        temperature = float(choices[int(np.argmin(loss))])
        score = softmax(scores / temperature)
        best = score.max(1)
        right = score.argmax(1) == label_of[test]
        order = np.argsort(-best)
        accepted = np.arange(1, len(test) + 1)
        fine = np.flatnonzero(np.cumsum(~right[order]) <= ERROR * accepted)
        threshold = float(best[order][fine[-1]]) if len(fine) else 1.0
    return Model(names, table, bias, temperature, threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; texts without ASCII letters are looked at by character."""
    lower = data | 32
    letter = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])
    found = letter[offsets[1:]] > letter[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean logits of each text; n-grams that reach into the next text count for the one they begin in."""
    total = np.zeros((len(offsets) - 1, len(model.languages)), np.float64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        # a blank after each text keeps n-grams of one from depending on the next
        lengths = np.diff(offsets)[full]
        padded = np.full(len(data) + max(GRAMS) * len(full), 32, np.uint8)
        shift = np.repeat(np.arange(len(full)) * max(GRAMS), lengths)
        padded[np.arange(len(data)) + shift] = clean(data)
        starts = offsets[:-1][full] + np.arange(len(full)) * max(GRAMS)
        bounds = np.stack([starts, starts + lengths], 1).ravel()
        for size in GRAMS:
            rows = gram_rows(padded, size)
            for j in range(len(model.languages)):
                total[full, j] += np.add.reduceat(np.ascontiguousarray(model.table[:, j])[rows], bounds, dtype=np.float64)[::2]
        total[full] /= len(GRAMS) * lengths[:, None]
    return total + model.bias


def learn(df: DataFrame, held: int = 2, folds: int = 4, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on at most ``sample`` documents, whole texts, outside the held-out fold, chosen by a hash of the id."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    able = df.filter((fold != held) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    able = able.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    chosen = able.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)

    def count(batches):
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = text_bytes(part.column(1))
                letters = has_letter(data, offsets)
                found = [histogram(data[a:b]) for a, b in zip(offsets, offsets[1:])]
                out = [part.column(0), part.column(2), pa.array([r.astype(np.uint16).tobytes() for r, _ in found], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=["id", "lang", "rows", "counts"]).filter(pa.array(letters))

    # an n-gram histogram of a whole text goes to the driver, of at most 6 * ROWS bytes
    small_batches(df.sparkSession)
    texts = able.join(F.broadcast(chosen), "id").select("id", "text", "lang")
    rows = sorted(texts.mapInArrow(tidy(count), "id long, lang string, rows binary, counts binary").collect(), key=lambda r: (r.id, r.lang, bytes(r.rows), bytes(r.counts)))
    sample_of = [(np.frombuffer(bytes(r.rows), np.uint16).astype(np.int64), np.frombuffer(bytes(r.counts), np.uint32)) for r in rows]
    return train(sample_of, [r.lang for r in rows]) if rows else None


def predict(df: DataFrame, model: Model | None, held: int = 2, folds: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # of fixed size: a row of logits per hash

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = text_bytes(part.column(1))
                letters = has_letter(data, offsets)
                if model is None:
                    name, best = ["und"] * len(part), np.zeros(len(part))
                    rejected = np.ones(len(part), bool)
                else:
                    score = softmax(logits(model, data, offsets) / model.temperature)
                    best = np.where(letters, score.max(1), 0.0)
                    name = [model.languages[i] if ok else "und" for i, ok in zip(score.argmax(1), letters)]
                    rejected = (best < model.threshold) | ~letters
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(name, pa.string()), pa.array(best, pa.float64()), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    out = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double, rejected boolean")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    return out.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
