import pytest
from pyspark.sql import functions as F

from kinspan.functions import normalize as N


def values(spark, f, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


def test_suffix_variants_become_one(spark):
    a, b = values(spark, N.name_tokens, "Acme Pvt Ltd", "Acme Private Limited")
    assert a == b == ["acme", "private_limited", "limited"]


def test_ampersand_is_a_word(spark):
    assert values(spark, N.name_tokens, "Smith & Sons") == [["smith", "and", "and_sons"]]


def test_street_forms(spark):
    a, b = values(spark, N.address_string, "105 Elm St", "105 Elm Street")
    assert a == b == "105 elm street"


@pytest.mark.parametrize("text", ["-- Holloway Peak Inc Seafood", "<< Team Ecole"])
def test_leading_junk_goes(spark, text):
    assert values(spark, N.strip_leading_junk, text) == [text.lstrip("-<. ")]


def test_nothing_in_nothing_out(spark):
    assert values(spark, N.name_tokens, "", "   ", None) == [[], [], []]


def test_vowel_signs_split_words(spark):
    assert values(spark, N.name_tokens, "राम मार्केटिंग") == [["र", "म", "म", "र", "क", "ट", "ग"]]


def test_digit_runs(spark):
    assert values(spark, N.digit_tokens, "KH NO. -570/13, NEW DELHI", "none", "٣٤") == [["570", "13"], [], ["٣٤"]]


def test_country_is_open(spark):
    assert values(spark, N.country, "France", "  Unknown \t Country  ") == ["france", "unknown country"]


def test_long_address(spark):
    assert len(values(spark, N.address_string, "12 Long Road, " * 50)[0]) > 500


def test_ngrams(spark):
    assert values(spark, lambda c: N.char_ngrams(c, 4), "ab", "", "a bcd ef") == [["ab"], [], ["abcd", "bcde", "cdef"]]


def test_fingerprint_and_tokens(spark):
    assert values(spark, N.alphanumeric_only, "Ab-1 é Z") == ["ab1z"]
    assert values(spark, N.tokenize, " a b  c ", "") == [["a", "b", "c"], []]
