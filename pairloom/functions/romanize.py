"""Letters of other scripts to ASCII, by the names that Unicode gives them. An Arrow function; rows that are ASCII pass."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.text import FOLD_PAIRS

_INDIC = ("DEVANAGARI", "TAMIL", "TELUGU", "GURMUKHI", "BENGALI", "GUJARATI", "KANNADA", "MALAYALAM", "ORIYA")


@functools.lru_cache(1 << 16)
def _letter(char: str) -> tuple[str, str]:
    """(kind, sound) of a character: consonant, vowel sign, virama, or plain."""
    if char.isascii():
        return "plain", char
    if char in FOLD_PAIRS:
        return "plain", FOLD_PAIRS[char]
    base = unicodedata.normalize("NFKD", char)[0]
    if base.isascii():
        return "plain", base
    name = unicodedata.name(char, "")
    last = name.split(" WITH ")[0].split(" ")[-1].lower()
    if unicodedata.category(char) == "Nd":
        return "plain", str(unicodedata.digit(char))
    if name.startswith(_INDIC):
        if "VOWEL SIGN" in name:
            return "sign", last
        if "VIRAMA" in name or "PULLI" in name:
            return "virama", ""
        if " LETTER " in name:
            return ("consonant", last) if last[-1:] == "a" and len(last) > 1 and last not in ("aa",) else ("plain", last)
        return "plain", {"anusvara": "n", "candrabindu": "n", "visarga": "h"}.get(last, "")
    if " LETTER " in name:
        return "plain", last
    return "plain", " " if char.isspace() else ""


def romanize_text(text: str | None) -> str | None:
    """ASCII form of a text; an inherent vowel goes before a vowel sign or virama. Unknown characters go."""
    if text is None or text.isascii():
        return text
    out: list[str] = []
    for char in text:
        kind, sound = _letter(char)
        if kind in ("sign", "virama") and out and out[-1][-1:] == "a":
            out[-1] = out[-1][:-1]
        out.append(sound)
    return "".join(out)


@F.pandas_udf(T.StringType())
def romanize(texts: pd.Series) -> pd.Series:
    return texts.map(romanize_text, na_action="ignore")
