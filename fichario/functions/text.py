"""Text cleaning (P1), name normalisation (P12) and small string helpers."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from fichario.constants import LEGAL_SUFFIX_PATTERN

# All Unicode white space, derived from the character database.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Compatibility characters common on web pages that expand to several letters.
_EXPANDING = "¼½¾Ĳĳ№™ﬀﬁﬂﬃﬄ"


def _base_letters(char: str) -> str:
    decomposed = unicodedata.normalize("NFKD", char)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def _single_letter_folds() -> tuple[str, str]:
    """Every BMP character whose compatibility decomposition is one other base character."""
    source, target = [], []
    for code in range(0xA0, 0x10000):
        if 0xAC00 <= code <= 0xDFFF:  # Hangul syllables expand; surrogates are not characters
            continue
        base = _base_letters(chr(code))
        if len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


_FOLD_FROM, _FOLD_TO = _single_letter_folds()


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space (NBSP included, unlike ``trim``)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of white space only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def held(*choices: tuple[Column, Column], kind: str = "string") -> Column:
    """Values whose condition holds, in order. Compiled, unlike ``array_compact`` of as many cases."""
    none = F.array().cast(f"array<{kind}>")
    return F.concat(*[F.when(condition, F.array(value)).otherwise(none) for condition, value in choices])


def tail(c: Column, n: int) -> Column:
    """The last ``n`` characters, all of a shorter text."""
    return F.when(F.length(c) > n, F.right(c, F.lit(n))).otherwise(c)


def zero_pad(c: Column, n: int) -> Column:
    """Left-pad with zeros without ever cutting longer text (``lpad`` would)."""
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def contains_any(c: Column, words) -> Column:
    """True when any of the literal words occurs; plain byte search, no regex engine."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(c, F.lit(word))
    return found


def normalize_word(word: str) -> str:
    """P12 for a fixed word without legal suffixes: folded, lower-case, letters and digits only."""
    folded = _base_letters(word).lower()
    return " ".join("".join(c if c.isalnum() or c == "_" else " " for c in folded).split())


def normalize_text(c: Column) -> Column:
    """Fold accents, lower-case, drop legal suffixes, keep letters and digits only.

    Folding covers every BMP character that decomposes to one base character plus the expanding
    ones listed above; other multi-letter compatibility characters keep their own form.
    """
    plain = text = F.coalesce(c, F.lit(""))
    for char in _EXPANDING:
        text = F.replace(text, F.lit(char), F.lit(_base_letters(char)))
    text = F.translate(text, _FOLD_FROM, _FOLD_TO)
    text = F.regexp_replace(text, r"\p{M}+", "")
    # Nothing folds in a text of one byte a character.
    text = F.when(F.length(plain) == F.octet_length(plain), plain).otherwise(text)
    text = F.regexp_replace(F.lower(text), "(?U)" + LEGAL_SUFFIX_PATTERN, " ")
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " "))
