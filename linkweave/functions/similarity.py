"""Pairwise similarities. Native Columns where Spark has the means; Arrow UDFs for the rest."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 when both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty strings are equal."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.try_divide(F.levenshtein(a, b), longer))


def flag_equal(a: Column, b: Column) -> Column:
    """1 if equal; null equals nothing."""
    return F.coalesce((a == b).cast("int"), F.lit(0))


def flag_equal_filled(a: Column, b: Column) -> Column:
    """1 if equal and not empty."""
    return F.coalesce(((a == b) & (a != "")).cast("int"), F.lit(0))


def soundex_equal(a: Column, b: Column) -> Column:
    """A native phonetic alternative; not the Metaphone feature."""
    return flag_equal_filled(F.soundex(a), F.soundex(b))


def map_dot(a: Column, b: Column) -> Column:
    """Dot product of two weight maps; 0 where either is missing."""
    shared = F.array_intersect(F.map_keys(a), F.map_keys(b))
    total = F.aggregate(shared, F.lit(0.0), lambda s, k: s + F.try_element_at(a, k) * F.try_element_at(b, k))
    return F.coalesce(total, F.lit(0.0))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit-parallel addition (Hyyro 2004)."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    ones = (1 << len(a)) - 1
    state = ones
    for c in b:
        both = state & places.get(c, 0)
        state = ((state + both) | (state - both)) & ones
    return len(a) - state.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a and b else 0.0


def jaro_winkler(a: str, b: str) -> float:
    """Prefix weight 0.1, at most 4 letters, and only above a Jaro similarity of 0.7."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    matched = len(left)
    if not matched:
        return 0.0
    right = [c for c, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (matched / len(a) + matched / len(b) + (matched - swapped) / matched) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


def _pairwise(function):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna(""), strict=True):
            if pair not in seen:
                seen[pair] = function(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return run


indel_similarity = _pairwise(indel_ratio)
jaro_winkler_similarity = _pairwise(jaro_winkler)


def metaphone(word: str) -> str:
    """The Metaphone code (Philips 1990) of one English word."""
    w = "".join(c for c in word.lower() if "a" <= c <= "z")
    if not w:
        return ""
    if w[:2] in ("ae", "gn", "kn", "pn", "wr"):
        w = w[1:]
    elif w[0] == "x":
        w = "s" + w[1:]
    elif w[:2] == "wh":
        w = "w" + w[2:]
    out = []
    front, vowels = "eiy", "aeiou"
    i = 0
    while i < len(w):
        c, after, before = w[i], w[i + 1 : i + 2], w[i - 1 : i] if i else ""
        if c == before and c != "c":
            i += 1
            continue
        if c in vowels:
            if i == 0:
                out.append(c.upper())
        elif c == "b":
            if not (before == "m" and i == len(w) - 1):
                out.append("B")
        elif c == "c":
            if after and after in front:
                if w[i : i + 3] == "cia":
                    out.append("X")
                elif before != "s":
                    out.append("S")
            elif after == "h":
                out.append("K" if before == "s" else "X")
                i += 1
            else:
                out.append("K")
        elif c == "d":
            if after == "g" and w[i + 2 : i + 3] and w[i + 2] in front:
                out.append("J")
                i += 2
            else:
                out.append("T")
        elif c == "g":
            if after == "h":
                if i + 2 < len(w) and w[i + 2] in vowels:
                    out.append("K")
                    i += 1
            elif after == "n":
                if not (i + 2 == len(w) or w[i + 2 :] == "ed"):
                    out.append("K")
            elif after and after in front and before != "g":
                out.append("J")
            else:
                out.append("K")
        elif c == "h":
            if after and after in vowels and before not in ("c", "g", "p", "s", "t"):
                out.append("H")
        elif c in "fjlmnr":
            out.append(c.upper())
        elif c == "k":
            if before != "c":
                out.append("K")
        elif c == "p":
            if after == "h":
                out.append("F")
                i += 1
            else:
                out.append("P")
        elif c == "q":
            out.append("K")
        elif c == "s":
            if after == "h":
                out.append("X")
                i += 1
            elif w[i : i + 3] in ("sio", "sia"):
                out.append("X")
            else:
                out.append("S")
        elif c == "t":
            if w[i : i + 3] in ("tio", "tia"):
                out.append("X")
            elif after == "h":
                out.append("0")
                i += 1
            elif w[i : i + 3] != "tch":
                out.append("T")
        elif c == "v":
            out.append("F")
        elif c in "wy":
            if after and after in vowels:
                out.append(c.upper())
        elif c == "x":
            out += ["K", "S"]
        elif c == "z":
            out.append("S")
        i += 1
    return "".join(out)


@F.pandas_udf(StringType())
def metaphone_code(words: pd.Series) -> pd.Series:
    codes = {w: metaphone(w) for w in words.dropna().unique()}
    return words.map(codes).fillna("")
