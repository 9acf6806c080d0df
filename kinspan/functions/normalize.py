"""Normalizations of names, addresses and countries as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens and what they become. Lookups go token by token, so forms of several words never apply.
SUFFIXES = {
    "pvt": "private_limited",
    "private": "private_limited",
    "limited": "limited",
    "ltd": "limited",
    "corporation": "corporation",
    "corp": "corporation",
    "incorporated": "incorporated",
    "incorporation": "incorporated",
    "inc": "incorporated",
    "llc": "limited_liability_company",
    "llp": "limited_liability_partnership",
    "company": "company",
    "co": "company",
    "enterprises": "enterprises",
    "enterprise": "enterprises",
    "ent": "enterprises",
    "industries": "industries",
    "industry": "industries",
    "ind": "industries",
    "associates": "associates",
    "assoc": "associates",
    "assocs": "associates",
    "sons": "and_sons",
}
STREETS = {
    "rd": "road",
    "st": "street",
    "str": "street",
    "ave": "avenue",
    "av": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "ct": "court",
    "pl": "place",
    "sq": "square",
    "hwy": "highway",
    "pkwy": "parkway",
    "apt": "apartment",
    "bldg": "building",
    "fl": "floor",
    "ste": "suite",
    "n": "north",
    "s": "south",
    "e": "east",
    "w": "west",
    "no": "number",
    "po": "postoffice",
}

#: Whitespace of all scripts, spelled out since regex engines differ in what \s holds.
SPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]"
JUNK = r"^[\-_*<>.\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]+"
#: Combining marks are no word characters: a word of an Indic script splits at its vowel signs.
NOT_WORD = r"[^\p{L}\p{N}_]+"
DIGITS = r"(\p{Nd}+)"


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def strip_leading_junk(c: Column) -> Column:
    return F.regexp_replace(c, JUNK, "")


def lowercase(c: Column) -> Column:
    return F.lower(c)


def strip_punctuation(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), NOT_WORD, " "))


def alphanumeric_only(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def tokenize(c: Column) -> Column:
    return F.array_remove(F.split(c, f"{SPACE}+"), "")


def replace_tokens(tokens: Column, lookup: dict[str, str]) -> Column:
    """Each token's replacement, or the token; a null list is an empty one."""
    pairs = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
    return F.coalesce(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(pairs, t), t)), F.array().cast("array<string>"))


def name_tokens(c: Column) -> Column:
    return replace_tokens(tokenize(strip_punctuation(lowercase(strip_leading_junk(F.coalesce(c, F.lit("")))))), SUFFIXES)


def address_tokens(c: Column) -> Column:
    return replace_tokens(tokenize(strip_punctuation(lowercase(F.coalesce(c, F.lit(""))))), STREETS)


def name_string(c: Column) -> Column:
    return F.array_join(name_tokens(c), " ")


def address_string(c: Column) -> Column:
    return F.array_join(address_tokens(c), " ")


def digit_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(DIGITS), 1)


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams of a string without its spaces; a shorter one is its own only gram, an empty one has none."""
    text = F.replace(c, F.lit(" "), F.lit(""))
    size = F.length(text)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(size - F.lit(n - 1), F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))
    return F.when(size == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def country(c: Column) -> Column:
    return normalize_whitespace(F.lower(F.coalesce(c, F.lit(""))))
