"""Normalisation, surface forms, stems and head words of labels."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the matching method.
STOP_WORDS = tuple(
    "a an the and or but of for in on to under with without by at from as is are was were be been being that this these those it its which who whom between two more any into through".split()
)
SUFFIXES = (("ies", "y"), ("es", ""), ("s", ""), ("ing", ""), ("ed", ""), ("ly", ""), ("ment", ""))
MIN_STEM = 3
HEAD_PREPOSITIONS = ("of", "for", "in", "on", "to", "under")
ENGLISH = ("", "en", "en-us", "en-gb")
_BLANKS = "".join(f"\\u{c:04x}" for c in range(0x10000) if chr(c).isspace() and c != 0x20)
_SPACES = "[" + "".join(f"\\u{c:04x}" for c in range(0x10000) if chr(c).isspace()) + "]"


@F.pandas_udf(T.StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else x.lower() if x.isascii() else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def fold(c: Column) -> Column:
    """NFKC, then case folding: what Spark has no function for. ASCII values are only lowered, in the same pass."""
    return _fold(c)


def nfc(c: Column) -> Column:
    return _nfc(c)


@F.pandas_udf(T.StringType())
def three_decimals(s: pd.Series) -> pd.Series:
    """The decimal text of round(x, 3), ties by the binary value as it is."""
    return s.map(lambda x: None if pd.isna(x) else f"{round(x, 3):.3f}")


def squeeze(c: Column) -> Column:
    """White space to single spaces, trimmed. Single spaces, which are most, are not rewritten."""
    return F.trim(F.regexp_replace(c, f"{_SPACES}{{2,}}|[{_BLANKS}]", " "))


def normalize(c: Column, folded: Column | None = None) -> Column:
    """Folded text without one trailing "(...)", hyphens, slashes and underscores as spaces. folded: fold(c) where it is at hand, or lower(c) for ASCII."""
    c = fold(c) if folded is None else folded
    return squeeze(F.translate(F.regexp_replace(c, rf"\([^()]*\){_SPACES}*\z", ""), "-/_", "   "))


def trim_marks(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\W+|\W+$", "")


def label_parts(label: Column) -> Column:
    """A label and the parts that slashes separate in it."""
    return F.array_distinct(F.concat(F.array(label), F.split(label, r"\s*/\s*")))


def words(c: Column) -> Column:
    """Words of Unicode letters and digits, in order."""
    return F.regexp_extract_all(c, F.lit(r"(?U)([^\W_]+)"), F.lit(1))


def stem(w: Column) -> Column:
    """The first suffix that leaves three characters or more is cut or replaced."""
    out = F.lit(None).cast("string")
    for suffix, to in reversed(SUFFIXES):
        cut = F.concat(w.substr(F.lit(1), F.length(w) - len(suffix)), F.lit(to))
        out = F.when(w.endswith(suffix) & (F.length(w) - len(suffix) + len(to) >= MIN_STEM), cut).otherwise(F.coalesce(out, w))
    return out


def content_stems(folded: Column) -> Column:
    """The set of stems of a folded text's words; stop words go before stemming."""
    return F.array_distinct(F.transform(F.array_except(words(folded), F.array(*map(F.lit, STOP_WORDS))), stem))


def head_word(ws: Column) -> Column:
    """The word before the first preposition, unless that comes first; else the last word."""
    at = F.array_min(F.transform(F.array(*map(F.lit, HEAD_PREPOSITIONS)), lambda p: F.nullif(F.array_position(ws, p), F.lit(0))))
    return F.when(at > 1, F.try_element_at(ws, (at - 1).cast("int"))).otherwise(F.try_element_at(ws, F.lit(-1)))


def clean(c: Column) -> Column:
    """Tabs and line ends as spaces, for tab-separated files."""
    return F.translate(c, "\t\r\n", "   ")


def normalize_text(text: str) -> str:
    """normalize() for one string, on the driver."""
    text = re.sub(r"\s*\([^()]*\)\s*$", "", unicodedata.normalize("NFKC", text).casefold().strip())
    return " ".join(re.sub(r"[-/_]", " ", text).split())
