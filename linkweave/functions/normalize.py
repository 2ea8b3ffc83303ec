"""Normalisation of business names and addresses as native Columns.

The steps are staged in ``select``s that name earlier results, because a Column used twice is planned
twice. Only text in scripts other than Latin leaves the JVM (``romanise``).
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the data contract: words, abbreviations and codes.
LEGAL_WORDS = ["inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "llp", "lp", "pvt", "private", "plc", "gmbh", "sarl", "sa", "ag", "bv", "pty", "enterprise", "enterprises", "group", "holdings", "solutions", "services", "consultants", "consulting", "associates", "international", "global", "the"]
ABBREVIATIONS = {"rd": "road", "st": "street", "ave": "avenue", "dr": "drive", "ln": "lane", "blvd": "boulevard", "apt": "apartment", "ste": "suite", "hwy": "highway", "pl": "place", "ct": "court", "cir": "circle", "pkwy": "parkway", "ter": "terrace"}
ADDRESS_STOP_WORDS = [*ABBREVIATIONS.values(), "floor", "near", "behind", "off", "house", "flat", "plot", "block", "wing", "village", "taluka", "dist", "district", "ward", "sector", "phase", "stage", "no", "number", "survey", "gali", "city", "town"]
STATES = ["al", "ak", "az", "ar", "ca", "co", "ct", "de", "fl", "ga", "hi", "id", "il", "in", "ia", "ks", "ky", "la", "me", "md", "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj", "nm", "ny", "nc", "nd", "oh", "ok", "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut", "vt", "va", "wa", "wv", "wi", "wy"]
#: Letters that no decomposition reduces to ASCII, with what they are written as.
SPELLED = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}


@functools.cache
def latin_table() -> tuple[str, str]:
    """Accented Latin letters and what their decomposition begins with, one to one."""
    left, right = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
        if len(base) == 1 and base.isalnum() and char not in SPELLED:
            left.append(char)
            right.append(base)
    return "".join(left), "".join(right)


def has_non_latin(text: Column) -> Column:
    """Any character beyond ASCII (so an accent counts as well)."""
    return text.rlike(r"[^\x00-\x7F]")


@F.pandas_udf(StringType())
def romanise(texts: pd.Series) -> pd.Series:
    """Letters of other scripts by the last words of their Unicode names; not identical with other tables."""

    def letter(char: str) -> str:
        if ord(char) < 128:
            return char
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
        if plain:
            return plain
        name = unicodedata.name(char, "")
        if "LETTER" in name or "VOWEL SIGN" in name or "SYLLABLE" in name:
            return name.rsplit(" ", 1)[-1].lower()
        return str(unicodedata.digit(char)) if char.isdigit() else "" if unicodedata.combining(char) else " "

    return texts.map(lambda t: t if t is None or t.isascii() else "".join(map(letter, t)))


def transliterate(text: Column, scripts: str = "latin") -> Column:
    """ASCII spelling. Latin letters by ``translate`` and ``replace``; with ``scripts="all"`` what is
    left goes through ``romanise``, otherwise it stays and is treated as punctuation."""
    left, right = latin_table()
    out = F.translate(text, left, right)
    for char, spelled in SPELLED.items():
        out = F.replace(out, F.lit(char), F.lit(spelled))
    return romanise(out) if scripts == "all" else F.when(has_non_latin(text), out).otherwise(text)


def _strip(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+\z", "")


def _plain(text: Column) -> Column:
    """Punctuation to spaces, spaces collapsed and stripped."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\w\s]", " "), r"\s+", " "))


def _in(words: list[str]):
    return lambda x: x.isin(words)


def _token_set(tokens: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens))


def add_name(df: DataFrame, column: str, prefix: str = "name_", scripts: str = "latin") -> DataFrame:
    """canonical (sorted, repeats kept), tokens (sorted set), first_token, concat_key (original order),
    char_prefix, prefix_key (two smallest tokens) and was_transliterated. Without a significant token
    all tokens count."""
    raw, text, every, sig = (f"__{prefix}{x}" for x in ("raw", "text", "every", "sig"))
    df = df.withColumn(raw, _strip(F.col(column)))
    df = df.withColumn(text, _plain(F.replace(F.lower(transliterate(F.col(raw), scripts)), F.lit("&"), F.lit(" and "))))
    df = df.withColumn(every, F.filter(F.split(text, " "), lambda x: x != ""))
    df = df.withColumn(sig, F.filter(every, lambda x: ~_in(LEGAL_WORDS)(x) & (F.length(x) > 1)))
    df = df.withColumn(sig, F.when(F.size(sig) > 0, F.col(sig)).otherwise(F.col(every)))
    first = F.coalesce(F.get(sig, F.lit(0)), F.lit(""))
    df = df.withColumns({
        f"{prefix}canonical": F.array_join(F.array_sort(sig), " "),
        f"{prefix}tokens": _token_set(F.col(sig)),
        f"{prefix}first_token": first,
        f"{prefix}concat_key": F.array_join(sig, ""),
        f"{prefix}char_prefix": F.when(F.length(first) >= 3, F.substring(first, 1, 3)).otherwise(""),
        f"{prefix}was_transliterated": has_non_latin(F.col(raw)),
    })
    df = df.withColumn(f"{prefix}prefix_key", F.array_join(F.slice(f"{prefix}tokens", 1, 2), " "))
    return df.drop(raw, text, every, sig)


def add_address(df: DataFrame, column: str, prefix: str = "addr_", scripts: str = "latin") -> DataFrame:
    """normalized (abbreviations expanded), pincode (first run of 5 or 6 digits, before punctuation
    goes), state_abbr (first token that is a code) and tokens (longer than 2, no digits, no stop word)."""
    lowered, every = f"__{prefix}lower", f"__{prefix}every"
    df = df.withColumn(lowered, F.lower(transliterate(_strip(F.col(column)), scripts)))
    names = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    df = df.withColumn(every, F.transform(F.split(_plain(F.col(lowered)), " "), lambda x: F.coalesce(F.try_element_at(names, x), x)))
    digits = lambda x: x.rlike(r"^[0-9]+\z")
    return df.withColumns({
        f"{prefix}normalized": F.array_join(every, " "),
        f"{prefix}pincode": F.regexp_extract(lowered, r"\b(\d{5,6})\b", 1),
        f"{prefix}state_abbr": F.coalesce(F.get(F.filter(every, _in(STATES)), F.lit(0)), F.lit("")),
        f"{prefix}tokens": _token_set(F.filter(every, lambda x: (F.length(x) > 2) & ~digits(x) & ~_in(ADDRESS_STOP_WORDS)(x))),
    }).drop(lowered, every)


def normalise(df: DataFrame, name: str = "business_name", address: str = "business_address", scripts: str = "latin") -> DataFrame:
    """A source with all normalised columns; once per entity, before any pair is made."""
    return add_address(add_name(df, name, scripts=scripts), address, scripts=scripts)
