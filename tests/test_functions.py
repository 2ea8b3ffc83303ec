"""Normalisation and similarity on hand-made rows and by properties."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkweave.functions import normalize as N
from linkweave.functions import similarity as S


@pytest.fixture(scope="module")
def names(spark):
    def run(*raw, scripts="latin"):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, n string")
        return [r.asDict() for r in N.add_name(df, "n", scripts=scripts).orderBy("i").collect()]

    return run


@pytest.fixture(scope="module")
def addresses(spark):
    def run(*raw):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, a string")
        return [r.asDict() for r in N.add_address(df, "a").orderBy("i").collect()]

    return run


def test_generic_names_fall_back(names):
    assert names("Global Solutions")[0]["name_canonical"] == "global solutions"


def test_domain_names_keep_their_ending(names):
    domain, words = names("libertyfamilyoffice.com", "Liberty Family Office")
    assert domain["name_concat_key"] == "libertyfamilyofficecom"
    assert words["name_concat_key"] == "libertyfamilyoffice"


def test_single_letters(names):
    (row,) = names("b a b")
    assert (row["name_canonical"], row["name_tokens"], row["name_prefix_key"], row["name_concat_key"], row["name_char_prefix"]) == ("a b b", ["a", "b"], "a b", "bab", "")


def test_ampersand_and_empty(names):
    a, b, c = names("A & B Traders", None, "  ...  ")
    assert a["name_canonical"] == "and traders"
    assert b["name_canonical"] == c["name_canonical"] == "" and b["name_tokens"] == []


def test_accents_and_sharp_s(names):
    (row,) = names("Größe Café Æsir")
    assert row["name_canonical"] == "aesir cafe grosse" and row["name_was_transliterated"]


def test_other_scripts_are_romanised(names):
    (row,) = names("Привет Ltd", scripts="all")
    assert row["name_canonical"].isascii() and len(row["name_canonical"]) > 3
    (plain,) = names("Привет Ltd")
    assert plain["name_canonical"] == "ltd"


def test_pincodes(addresses):
    rows = addresses("12345 Main St, 60601", "12345-6789", "1234567", "Sector 5, 560001")
    assert [r["addr_pincode"] for r in rows] == ["12345", "12345", "", "560001"]


def test_abbreviations_and_states(addresses):
    a, b, c = addresses("5 Elm Ct, Hartford CT", "Shop in Mall", "St. Louis MO")
    assert a["addr_normalized"] == "5 elm court hartford court" and a["addr_state_abbr"] == ""
    assert b["addr_state_abbr"] == "in"
    assert c["addr_normalized"].startswith("street louis") and c["addr_state_abbr"] == "mo"


def test_address_tokens(addresses):
    (row,) = addresses("Plot 12, Rose Villa, Near City Road 400001")
    assert row["addr_tokens"] == ["rose", "villa"]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@given(st.text("abcde ", max_size=30), st.text("abcde ", max_size=30))
@settings(max_examples=300, deadline=None)
def test_lcs_is_the_table(a, b):
    assert S.lcs_length(a, b) == _lcs(a, b)


@given(st.text("abcdef", max_size=12), st.text("abcdef", max_size=12))
@settings(max_examples=200, deadline=None)
def test_jaro_winkler_properties(a, b):
    value = S.jaro_winkler(a, b)
    assert 0 <= value <= 1
    assert value == pytest.approx(S.jaro_winkler(b, a))
    assert S.jaro_winkler(a, a) == 1.0


def test_jaro_winkler_same_as_duckdb(duck):
    random.seed(3)
    for _ in range(300):
        a, b = ("".join(random.choice("abcde") for _ in range(random.randrange(1, 10))) for _ in range(2))
        (theirs,) = duck.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()
        assert S.jaro_winkler(a, b) == pytest.approx(theirs, abs=1e-9)


@pytest.mark.parametrize("word, code", [("metaphone", "MTFN"), ("knight", "NT"), ("thumb", "0M"), ("science", "SNS"), ("school", "SKL"), ("wright", "RT"), ("judge", "JJ"), ("xerox", "SRKS"), ("phone", "FN"), ("", ""), ("123", "")])
def test_metaphone(word, code):
    assert S.metaphone(word) == code


def test_empty_pairs(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("", "", [], [])], "a string, b string, x array<string>, y array<string>").select(
        S.levenshtein_similarity(F.col("a"), F.col("b")).alias("lev"), S.jaro_winkler_similarity("a", "b").alias("jw"), S.indel_similarity("a", "b").alias("indel"), S.jaccard(F.col("x"), F.col("y")).alias("jac"), S.flag_equal_filled(F.col("a"), F.col("b")).alias("pin"),
    ).first()
    assert tuple(row) == (1.0, 1.0, 0.0, 0.0, 0)
