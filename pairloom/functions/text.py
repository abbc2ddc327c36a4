"""Normalisation of names and addresses as Catalyst column expressions: regular expressions and higher-order functions only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import tokens as K

NON_LATIN = "[" + "".join(rf"\p{{Is{s}}}" for s in K.SCRIPTS) + "]"
# Fixed value.
WEBSITE = r"(?i)(www\.|\.(com|net|org|co\.in|in|fr)\b)"


def _latin_folding() -> tuple[str, str]:
    """Letters of Latin-1 and Latin Extended-A/B whose decomposition begins with an ASCII letter, and that letter."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


FOLD_FROM, FOLD_TO = _latin_folding()
# Letters that fold to two.
FOLD_PAIRS = {"ß": "ss", "œ": "oe", "æ": "ae", "Œ": "OE", "Æ": "AE", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D"}


def fold(text: Column) -> Column:
    """Latin letters without their accents; stays in generated code."""
    for a, b in FOLD_PAIRS.items():
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.translate(text, FOLD_FROM, FOLD_TO)


def _table(entries: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))


def _in(token: Column, words) -> Column:
    return token.isin(list(words))


def _lookup(token: Column, entries: dict[str, str]) -> Column:
    """The entry of a token, or the token. Map literals are searched in order, so only tokens that a hash set has go there."""
    return F.when(_in(token, entries), F.try_element_at(_table(entries), token)).otherwise(token)


def _begins_with_digit(token: Column) -> Column:
    """Of tokens over [a-z0-9]: a comparison, where a pattern would run for each token."""
    return (token >= "0") & (token < "a")


def nonlatin(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike(NON_LATIN)


def website(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike(WEBSITE)


#: All characters but a-z, 0-9 and the comma, as ranges: Java's [^a-z0-9,] takes some 20 times as long.
_OTHERS = r"\x00-\x2b\x2d-\x2f\x3a-\x60\x7b-\x{10ffff}"
#: The steps over a folded, lower-case name, in this order: (pattern, replacement). Fixed values.
NAME_STEPS = [
    (r"www\.", " "),
    (r"\.(com|net|org|co\.in|in|fr|biz|info|us)\b", " "),
    (r"d/b/a|\bdba\b", " "),
    (r"\(?\bid\s*[:#]?\s*\d+\)?", " "),
    (r"\b([a-z])\.([a-z])\.([a-z])\.?", "$1$2$3"),
    (r"\b([a-z])\.([a-z])\.?(\s|$)", "$1$2$3"),
    (r"\s\+\s|&", " and "),
    (rf"[{_OTHERS}\x2c]+", " "),
    (r"\b\d{7,}\b", " "),
]


def chain(text: Column, steps) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def name_base(name: Column) -> Column:
    """The name after all text steps, before words are looked at."""
    return F.trim(chain(F.lower(fold(F.lower(F.coalesce(name, F.lit(""))))), NAME_STEPS))


def deleet(token: Column) -> Column:
    """A word of three or more letters and exactly one look-alike digit gets its letter back."""
    one = token.rlike(rf"^[a-z]*[{K.LEET_FROM}][a-z]*$") & (F.length(token) >= 4)
    return F.when(one, F.translate(token, K.LEET_FROM, K.LEET_TO)).otherwise(token)


def skeleton(token: Column) -> Column:
    """Consonants of a word, sounds alike folded and runs collapsed; i counts as l."""
    x = F.replace(F.replace(F.replace(token, F.lit("ph"), F.lit("f")), F.lit("ck"), F.lit("k")), F.lit("x"), F.lit("ks"))
    x = F.translate(x, "cqzwi", "kksvl")
    x = F.concat(F.substring(x, 1, 1), F.regexp_replace(F.substring(x, 2, 1 << 30), "[aeiouyh]", ""))
    return F.regexp_replace(x, r"(.)\1+", "$1")


def words_of_name(base: Column) -> Column:
    return F.transform(F.split(base, " "), deleet)


def legal_form(words: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(words, lambda t: _in(t, K.LEGAL_FORMS)), lambda t: _lookup(t, K.LEGAL_FORMS)))), " ")


def name_tokens(words: Column) -> Column:
    return F.array_distinct(F.filter(words, lambda t: ~_in(t, [*K.LEGAL_FORMS, *K.FILLER, ""])))


def address_base(address: Column) -> Column:
    """Folded lower-case address without its placeholders for null."""
    return F.regexp_replace(F.lower(fold(F.coalesce(address, F.lit("")))), r"<\s*null\s*>|\bnull\b", " ")


#: Fixed values.
ADDRESS_STEPS = [(rf"[{_OTHERS}]+", " "), (r"\s*,\s*", ", "), (r"\s+", " ")]


def address_norm(base: Column) -> Column:
    return F.btrim(chain(base, ADDRESS_STEPS), F.lit(" ,"))


def _plain_number(token: Column) -> Column:
    """Ordinals without their ending, numbers without leading zeros."""
    return F.when(_begins_with_digit(token), F.regexp_replace(F.regexp_replace(token, r"^(\d+)(st|nd|rd|th)$", "$1"), r"^0+(\d)", "$1")).otherwise(token)


def address_tokens(norm: Column) -> Column:
    words = F.split(F.replace(norm, F.lit(","), F.lit(" ")), " ")
    return F.filter(F.transform(words, lambda t: _lookup(_plain_number(t), K.ADDRESS_CANON)), lambda t: ~_in(t, ["", *K.ADDRESS_DROP]))


def address_numbers(found: Column) -> Column:
    return F.array_distinct(F.filter(found, lambda t: _begins_with_digit(t) & t.rlike(r"^\d+$")))


def address_ids(base: Column) -> Column:
    """Identifiers such as b-11/2: words with a digit and a letter or one of / - . , without their punctuation."""
    words = F.filter(F.split(base, r"[\s,;]+"), lambda t: t.rlike(r"\d") & t.rlike(r"[a-z/\-.]"))
    plain = F.transform(words, lambda t: F.regexp_replace(F.regexp_replace(t, "[^a-z0-9]", ""), r"^0+(\d)", "$1"))
    return F.array_distinct(F.filter(plain, lambda t: F.length(t) >= 2))


def street_component(norm: Column) -> Column:
    return F.coalesce(F.get(F.filter(F.split(norm, ", "), lambda c: c.rlike(r"\d")), F.lit(0)), F.lit(""))


def house_no(component: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(component, r"(\d+)", 1), r"^0+(\d)", "$1")


def street_word(component: Column) -> Column:
    return F.regexp_extract(component, r"\d+\w*\s+([a-z]{2,})", 1)
