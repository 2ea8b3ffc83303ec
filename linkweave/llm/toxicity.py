"""Toxicity with noisy-channel deobfuscation.

1. A character trigram model is counted over all texts.
2. Tokens that may be disguised (letters together with look-alike digits or signs in any position, a
   letter twice or more, single letters with any separators between them) become lattices: every
   position may stand for itself or for the letters it looks like, signs at a token's ends also for
   nothing, every run may be kept, doubled or single. Viterbi finds the path
   with the best sum of the language model's and the channel's log probabilities, in time and memory
   linear in the token, which may have any length. In a run of single letters words may also end
   anywhere; every word that is on a path close to the best one is read.
3. The words of a text, restored ones among them, and their prefixes are looked up in a lexicon. The
   lexicon is learned from a bounded sample of labelled texts. Near copies (texts that share their
   least shingle) count once, so that chance words of a copied toxic text get little weight. A logistic
   curve over the summed odds of a text's strongest words gives the score.

Defined results: a null or empty text is scored like a text without any lexicon word; texts of any
length are read whole; repeated rows get equal rows; rows of ``labels`` with nulls are not learned
from; without any toxic label every score is the base rate; other columns are ignored by ``score`` and
kept by ``drop_toxic``; labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm import rolling as R
from linkweave.llm.batches import slices, small_batches, text_bytes, tidy
from linkweave.llm.near_dedup import shingles

SAMPLE = 12_000
THRESHOLD = 0.7
PREFIXES = (4, 5, 6, 7, 8)
#: Toxic texts that a feature must be in (near copies count once), and the share of its texts that must be toxic.
SUPPORT = 3
PRECISION = 0.6
FEATURES = 20_000
#: Words of a text whose odds are added.
STRONGEST = 3
#: What signs look like.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "&": "aeiou"}
ALPHABET = 64
WORD = re.compile(r"[^\W\d_]+")
_SIGNS = r"@$!|+€(*#%&"
#: What is between white space and punctuation that looks like no letter; split at underscores.
TOKEN = re.compile(rf"[\w{_SIGNS}]+")
DOUBLED = re.compile(r"([^\W\d_])\1")
#: Runs of an equal letter, and signs and digits.
RUNS = re.compile(r"([^\W\d_])\1+|([\W\d_])\2*")
_UNIT, _BETWEEN = rf"(?:[^\W_]|[@$!|+€(#%&])", r"[\s.\-_*,/]+"
SPACED = re.compile(rf"(?<![^\W_])(?:{_UNIT}{_BETWEEN}){{2,}}{_UNIT}(?![^\W_])")
KEEP, SUBSTITUTE, SHORTEN = math.log(0.6), math.log(0.2), math.log(0.2)
#: Look-alikes at a token's end that are punctuation or a number and stand for no letter.
DROP = math.log(0.01)
#: Words of a spaced run are read if a path through them is so close to the best one; those on the best path always.
CLOSE, CLOSE_LETTERS = 8.0, 32
#: Letters of a run of single letters that are read together.
RUN_WINDOW = 2048
#: Restored tokens up to this length are remembered.
REMEMBERED = 64
#: Steps of Viterbi after which the common part of all paths is settled.
SETTLE = 512


def symbol(char: str) -> int:
    """a to z are 1 to 26, anything else that is a letter shares the rest; 0 is the edge of a word."""
    if char == " ":
        return 0
    code = ord(char)
    return code - 96 if 97 <= code <= 122 else 27 + code % (ALPHABET - 27)


def count_trigrams(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over the words of all texts; a task sends each trigram it met once."""

    def run(batches):
        total = np.zeros(ALPHABET**3, np.int64)
        table = np.zeros(256, np.int64)
        table[97:123] = np.arange(1, 27)
        table[128:] = 27 + np.arange(128) % (ALPHABET - 27)
        for batch in batches:
            for part in slices(batch, 0):
                data, _ = text_bytes(part.column(0))
                # of a two-byte letter the second byte tells which it is
                codes = table[R.lower_ascii(data)[data != 0xC3]]
                codes = np.concatenate([[0, 0], codes, [0, 0]])
                grams = (codes[:-2] * ALPHABET + codes[1:-1]) * ALPHABET + codes[2:]
                total += np.bincount(grams, minlength=ALPHABET**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["gram", "n"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclasses.dataclass
class CharModel:
    """log P(c | a, b), trigrams mixed with bigrams; of fixed size."""

    logp: np.ndarray

    @classmethod
    def of(cls, rows) -> CharModel:
        count = np.zeros(ALPHABET**3)
        for gram, n in rows:
            count[gram] = n
        count = count.reshape(ALPHABET, ALPHABET, ALPHABET)
        pair = count.sum(0)
        low = (pair + 0.5) / (pair.sum(1, keepdims=True) + 0.5 * ALPHABET)
        seen = count.sum(2, keepdims=True)
        return cls(np.log((count + 4 * low[None]) / (seen + 4)).astype(np.float32))


class Restorer:
    """Viterbi over the lattice of one disguised token; results for tokens of ordinary length are remembered."""

    def __init__(self, chars: CharModel, runs: frozenset[str] | None = None):
        """With ``runs``, the beginnings of all words that count, runs of letters single (``Model.runs``),
        tokens of which no reading begins so are not searched."""
        self.logp, self.runs = chars.logp, runs
        #: From any state the same letters lead on, and two of them to one state: a path that is so far behind
        #: another can't win any more.
        self.behind = 3 * float(self.logp.max() - self.logp.min())
        self.stems = frozenset(r[:size] for r in runs or () for size in range(len(r) + 1))
        self.remembered = functools.lru_cache(1 << 16)(self._restore)
        self.known = functools.lru_cache(1 << 17)(self._words)

    def words(self, token: str) -> tuple[str, ...]:
        """The words that stand in a token as it is, and the restored one."""
        return self.known(token) if len(token) <= REMEMBERED else self._words(token)

    def _words(self, token: str) -> tuple[str, ...]:
        if not may_hide(token) or (self.runs is not None and not self.may_begin(token)):
            return tuple(WORD.findall(token))
        return (*WORD.findall(token), self._restore(token))

    def may_begin(self, token: str) -> bool:
        """Does any reading of the token begin like a word that counts?"""
        alive, before = {""}, ""
        for char in token:
            if char == before:
                continue
            before = char
            letter = char.isalpha()
            new = set() if letter else set(alive)  # a sign may stand for nothing
            for c in char if letter else LOOKALIKES.get(char, ""):
                for start in alive:
                    longer = start if start.endswith(c) and start else start + c
                    if longer in self.runs:
                        return True
                    if longer in self.stems:
                        new.add(longer)
            if not new:
                return False
            alive = new
        return False

    def restore(self, token: str) -> str:
        return self.remembered(token) if len(token) <= REMEMBERED else self._restore(token)

    def readings(self, token: str, apart: bool = False) -> Iterator[list[tuple[str, float]]]:
        """What each part may stand for: letters that stand once are one part with one reading (each its own
        part with ``apart``), every run of equal letters or signs is a part with several."""
        found = WORD.search(token)
        first = found.start() if found else 0
        last = len(token) - WORD.search(token[::-1]).start() if found else len(token)
        at = 0
        for run in chain(RUNS.finditer(token), (None,)):
            begin = run.start() if run else len(token)
            if begin > at:
                yield from [[(c, KEEP)] for c in token[at:begin]] if apart else [[(token[at:begin], 0.0)]]
            if run is None:
                return
            at, char, length = run.end(), token[begin], run.end() - begin
            letters = LOOKALIKES.get(char, "")
            own = [(char, KEEP if not letters else SUBSTITUTE + math.log(0.05))] if char.isalpha() else []
            own += [(c, SUBSTITUTE - math.log(max(1, len(letters)))) for c in letters]
            node = []
            for c, cost in own:
                node.append((c, cost + (SHORTEN if length > 1 else 0)))
                if length > 1:
                    node.append((c * 2, cost + (KEEP if length == 2 else SHORTEN)))
            if node and (at <= first or begin >= last):
                node.append(("", DROP))
            if node:
                yield node

    def _restore(self, token: str, breaks: bool = False) -> str:
        """The best path; with ``breaks`` a word may end after any reading, shown by a blank. What all paths
        have in common is settled now and then, so that memory is bounded."""
        out: list[str] = []
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for step, node in enumerate(self.readings(token, breaks), 1):
            if breaks:
                node = node + [(reading + " ", cost) for reading, cost in node]
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in best.items():
                for reading, cost in node:
                    x, y, s = a, b, score + cost
                    # behind two letters of its own a reading costs the same on every path
                    for c in reading[:2] if len(node) == 1 else reading:
                        z = symbol(c)
                        s += float(self.logp[x, y, z])
                        x, y = y, z
                    if len(node) == 1 and len(reading) > 2:
                        x, y = symbol(reading[-2]), symbol(reading[-1])
                    if (x, y) not in new or s > new[x, y][0]:
                        new[x, y] = (s, (path, reading) if reading else path)
            best = new
            if step % SETTLE == 0:
                least = max(s for s, _ in best.values()) - self.behind
                best = self._settle({state: x for state, x in best.items() if x[0] >= least}, out)
        # a path that ends with a break has paid for the edge
        _, path = max(((s + (float(self.logp[a, b, 0]) if b else 0.0), path) for (a, b), (s, path) in best.items()), key=lambda x: x[0])
        settled, parts = _unwound(path)
        return "".join(out + parts if settled else parts)

    @staticmethod
    def _settle(best: dict, out: list[str]) -> dict:
        """Move what the paths that were settled before, or all if none was, have in common to ``out``. Paths
        that have left out every sign so far are empty and wait for their first letter."""
        unwound = {state: _unwound(path) for state, (_, path) in best.items()}
        several = [parts for settled, parts in unwound.values() if settled or (not out and parts)]
        same = 0
        for column in zip(*several):
            if len(set(column)) > 1:
                break
            same += 1
        if not same:
            return best
        begun = bool(out)
        out += several[0][:same]
        new = {}
        for state, (settled, parts) in unwound.items():
            path = best[state][1]
            if settled or (not begun and parts):
                path = functools.reduce(lambda before, x: (before, x), parts[same:], _SETTLED)
            new[state] = (best[state][0], path)
        return new

    def words_in(self, run: str) -> set[str]:
        """The words of a run of single letters, whose boundaries are unknown; a long run is read in windows
        that overlap by two words of ``CLOSE_LETTERS``."""
        step = RUN_WINDOW - 2 * CLOSE_LETTERS
        return set().union(*(self._words_in(run[i : i + RUN_WINDOW]) for i in range(0, max(1, len(run) - 2 * CLOSE_LETTERS), step)))

    def _words_in(self, run: str) -> set[str]:
        """The words of the best path through the run's lattice, and those on any segmentation of the restored
        letters that is nearly as good."""
        best = self._restore(run, breaks=True)
        letters = best.replace(" ", "")
        codes, count = [symbol(c) for c in letters], len(letters)
        logp = self.logp
        # ahead[i]: the best segmentation of the first i letters; spans[j]: (start, score) of the words that end at j
        ahead, spans = [0.0] + [-math.inf] * count, [[] for _ in range(count + 1)]
        for i in range(count):
            x, y, s = codes[i - 1] if i else 0, 0, 0.0
            for j in range(i + 1, min(count, i + CLOSE_LETTERS) + 1):
                z = codes[j - 1]
                s += float(logp[x, y, z])
                x, y = y, z
                whole = s + float(logp[x, y, 0])
                spans[j].append((i, whole))
                ahead[j] = max(ahead[j], ahead[i] + whole)
        behind = [-math.inf] * count + [0.0]
        out = set(best.split())
        for j in range(count, 0, -1):
            for i, whole in spans[j]:
                behind[i] = max(behind[i], whole + behind[j])
                if ahead[i] + whole + behind[j] >= ahead[count] - CLOSE:
                    out.add(letters[i:j])
        return out


_SETTLED = ()


def _unwound(path: tuple | None) -> tuple[bool, list[str]]:
    """Whether a path goes on from what is settled, and its own parts."""
    out = []
    while path:
        path, reading = path
        out.append(reading)
    return path is _SETTLED, out[::-1]


def single_runs(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


def may_hide(token: str) -> bool:
    """Does a token mix letters with look-alikes, or repeat a letter?"""
    if WORD.fullmatch(token):
        return DOUBLED.search(token) is not None
    return WORD.search(token) is not None


def tokens_of(text: str) -> set[str]:
    found = set(TOKEN.findall(text))
    return {part for token in found for part in token.split("_") if part} if "_" in text else found


def disguised(text: str) -> list[str]:
    """The tokens of a lower-cased text that may be disguised, separators removed."""
    return [t for t in tokens_of(text) if may_hide(t)] + spaced(text)


def spaced(text: str) -> list[str]:
    """The runs of single letters, separators removed."""
    found = [re.sub(_BETWEEN, "", m.group()) for m in SPACED.finditer(text)]
    return [run for run in found if WORD.search(run)]


def words_of(text: str, restorer: Restorer) -> set[str]:
    """The distinct words of a text and of its restored tokens; learning reads all, ``Scorer`` those that count."""
    text = text.lower()
    words = set()
    for token in tokens_of(text):
        words.update(restorer.words(token))
    for run in spaced(text):
        words.add(restorer.restore(run))
        words |= restorer.words_in(run)
    words.discard("")
    return words


def spelled_features(words: set[str]) -> set[str]:
    """Words and their prefixes, which are marked by a star."""
    return words.union(*({w[:size] + "*" for w in words if len(w) > size} for size in PREFIXES))


@dataclasses.dataclass
class Model:
    chars: CharModel
    odds: dict[str, float]  #: of each feature, log odds of toxic
    base: float
    slope: float
    shift: float

    def __post_init__(self):
        self.heads = {f.rstrip("*")[: PREFIXES[0]] for f in self.odds}
        self.runs = frozenset(map(single_runs, self.heads))

    def weight(self, word: str) -> float:
        """Odds of the strongest feature of a word, 0 if none speaks for toxic."""
        if word[: PREFIXES[0]] not in self.heads:
            return 0.0
        return max([0.0, self.odds.get(word, 0.0), *(self.odds.get(word[:size] + "*", 0.0) for size in PREFIXES if len(word) > size)])

    def score(self, words: Iterable[str]) -> float:
        """Of distinct words."""
        return self.curve([w for w in map(self.weight, words) if w])

    def curve(self, weights: Iterable[float]) -> float:
        strongest = sorted(weights)[-STRONGEST:]
        odds = sum(strongest) if strongest else self.base
        return 1 / (1 + math.exp(-(self.slope * odds + self.shift)))


class Scorer:
    """Scores texts; of each distinct token only the words that count are remembered."""

    def __init__(self, model: Model, chars: CharModel | None = None):
        self.model, self.restorer = model, Restorer(chars or model.chars, model.runs)
        self.remembered = functools.lru_cache(1 << 18)(self._hits)

    def _hits(self, token: str) -> tuple[tuple[str, float], ...]:
        return tuple((word, weight) for word in set(self.restorer._words(token)) if (weight := self.model.weight(word)))

    def __call__(self, text: str | None) -> float:
        text = (text or "").lower()
        found: dict[str, float] = {}
        for token in tokens_of(text):
            hits = self.remembered(token) if len(token) <= REMEMBERED else self._hits(token)
            if hits:
                found.update(hits)
        for run in spaced(text):
            found.update((word, weight) for word in (self.restorer.restore(run), *self.restorer.words_in(run)) if (weight := self.model.weight(word)))
        return self.model.curve(found.values())


def learn(docs: DataFrame, labels: DataFrame, held: int = 1, folds: int = 3, sample: int = SAMPLE, features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """From at most ``sample`` labelled texts outside the held-out fold, chosen by a hash of the id; equal texts
    count once. The lexicon keeps the ``features`` strongest. Other columns of both frames, whatever their
    names, are not looked at."""
    spark = docs.sparkSession
    small_batches(spark)
    chars = CharModel.of((r.gram, r.n) for r in count_trigrams(docs, text_col).collect())
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
    able = labels.filter((fold != held) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("pick"), F.col(label_col).alias("toxic"))
    chosen = able.groupBy("pick").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("pick"), "pick").limit(sample)
    slim = docs.select(F.col(id_col).alias("pick"), F.col(text_col).alias("text"))
    picked = slim.join(F.broadcast(chosen), "pick").select("pick", "toxic", "text")
    shared = spark.sparkContext.broadcast(chars)

    def spell(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            for part in slices(batch, 2):
                data, offsets = text_bytes(part.column(2))
                owner, values = shingles(data, offsets, 5)
                family = R.mix(np.arange(len(part), dtype=np.uint64))
                present, first = np.unique(owner, return_index=True)
                if len(first):
                    family[present] = values[first]
                for i, text in enumerate(part.column(2).to_pylist()):
                    own = sorted(spelled_features(words_of(text or "", restorer)))
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([part.column(1)[i].as_py()] * len(own), pa.int32()), pa.array([int(family[i].view(np.int64))] * len(own), pa.int64())], names=["feature", "toxic", "family"])

    spelled = picked.mapInArrow(tidy(spell), "feature string, toxic int, family long").distinct()
    counts = spelled.groupBy("feature").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).filter((F.col("bad") >= SUPPORT) & (F.col("bad") >= PRECISION * F.col("n")))
    odds = F.log(F.col("bad") / (F.col("n") - F.col("bad") + 1))
    lexicon = {r.feature: r.odds for r in counts.select("feature", odds.alias("odds")).orderBy(F.desc("odds"), "feature").limit(features).collect()}
    size = picked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = math.log((size[1] + 1e-3) / (size[0] - size[1] + 1))
    if not lexicon:
        return Model(chars, {}, rate, 1.0, 0.0)
    return calibrate(Model(chars, lexicon, rate, 1.0, 0.0), picked, shared)


def calibrate(model: Model, picked: DataFrame, shared) -> Model:
    """Fit the logistic curve over the odds to the sample (Newton's method, smoothed targets)."""
    plain = dataclasses.replace(model, chars=None)

    def run(batches):
        scorer = Scorer(plain, shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(map(scorer, batch.column(2).to_pylist())), pa.float64())], names=["toxic", "score"])

    rows = picked.mapInArrow(tidy(run), "toxic int, score double").collect()
    y = np.array([r.toxic for r in rows], float)
    p = np.clip([r.score for r in rows], 1e-9, 1 - 1e-9)
    x = np.log(p / (1 - p))
    good, bad = (y == 0).sum(), (y == 1).sum()
    target = np.where(y == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    slope, shift = 1.0, 0.0
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        w, g = q * (1 - q) + 1e-9, q - target
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        move = np.clip(np.linalg.solve(h, [(g * x).sum() + 1e-3 * (slope - 1), g.sum()]), -1, 1)
        slope, shift = slope - move[0], shift - move[1]
    return dataclasses.replace(model, slope=float(max(slope, 0.1)), shift=float(shift))


def score(docs: DataFrame, model: Model, held: int = 1, folds: int = 3, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed table of characters and at most FEATURES features

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                scores = list(map(scorer, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "doc_id long, score double")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    return out.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns; scored where they are scanned."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch, at):
                fine = [scorer(t) < threshold for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
