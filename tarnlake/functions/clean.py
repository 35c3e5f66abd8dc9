"""Cleaning of texts as column expressions. Null stays null everywhere; only NFKC needs Python."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarnlake.functions.fixed import OTHER_SPECIAL, PUNCTUATION_TABLE, VARIOUS_SPACES

#: What counts as white space in cleaning: more than Java's own class.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_]"
HAN = r"[\x{4e00}-\x{9fff}]"


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode normal form KC; Spark has no built-in for it."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def _tidy(c: Column, blank_lines: str) -> Column:
    c = F.regexp_replace(c, "[「」｢｣『』]", '"')
    c = F.regexp_replace(c, "\r", "\n")
    c = F.regexp_replace(c, "\n\n", blank_lines)
    c = F.regexp_replace(c, rf"\n{SPACE}*\n", "\n")
    c = F.regexp_replace(c, "\n+", "\n")
    c = F.regexp_replace(c, rf"{SPACE}+\z", "")
    c = F.regexp_replace(c, rf"{SPACE}+", " ")
    c = F.regexp_replace(c, rf"({NOT_WORD})\1+", "$1")
    return F.regexp_replace(c, rf"(?<={HAN}){SPACE}+", "")


def clean_common(c: Column, normalize: bool = True) -> Column:
    """Documents: NFKC, one kind of quotation mark, single spaces, no repeated signs, no space after Han characters."""
    return _tidy(nfkc(c) if normalize else c, "\n")


def clean_chat(c: Column, normalize: bool = True) -> Column:
    """Chat messages: as ``clean_common``, but a blank line joins the words on both its sides."""
    return _tidy(nfkc(c) if normalize else c, "")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, rf"https?://[^{SPACE[1:-1]}]+", "")


def strip_garbled(c: Column) -> Column:
    """Only printable ASCII and Han characters U+4E00-9FA5 remain."""
    return F.regexp_replace(c, r"[^\x20-\x7e\x{4e00}-\x{9fa5}]+", "")


def control_ratio(c: Column) -> Column:
    """Share of control characters, line ends included; null for an empty text."""
    return F.try_divide(F.length(F.regexp_replace(c, r"[^\p{Cc}]", "")).cast("double"), F.nullif(F.length(c), F.lit(0)))


def keep_line(c: Column, least: int = 50, most_control: float = 0.03) -> Column:
    """Whether a text is long enough and has few control characters; null for null, false for an empty text."""
    return F.when(c.isNotNull(), F.coalesce((control_ratio(c) <= most_control) & (F.length(c) >= least), F.lit(False)))


@lru_cache(maxsize=1)
def _special_set() -> str:
    ascii_ = "".join(chr(i) for i in range(128) if not chr(i).isalpha() and (chr(i).isprintable() or chr(i).isspace()) and chr(i) not in "\x1c\x1d\x1e\x1f")
    # emoji of one code point: those with the Emoji property but ASCII signs and the letters that only make flags in pairs
    every = "".join(chr(i) for i in range(128, 0x20000) if not 0xD800 <= i < 0xE000 and not 0x1F1E6 <= i <= 0x1F1FF)
    emoji = "".join(regex.findall(r"\p{Emoji}", every))
    return "".join(dict.fromkeys(ascii_ + OTHER_SPECIAL + emoji))


def special_ratio(c: Column) -> Column:
    """Share of punctuation, digits, white space, listed signs and single-character emoji; 0 for an empty text."""
    kept = F.regexp_replace(c, special_class(), "")
    return F.when(F.length(c) == 0, F.lit(0.0)).otherwise((F.length(c) - F.length(kept)) / F.length(c))


def special_class() -> str:
    """The set as a regular expression of code-point ranges."""
    points = sorted(map(ord, _special_set()))
    ranges: list[list[int]] = []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "[" + "".join(rf"\x{{{a:x}}}" + (rf"-\x{{{b:x}}}" if b > a else "") for a, b in ranges) + "]"


def keep_special(c: Column, least: float = 0.0, most: float = 0.25) -> Column:
    return special_ratio(c).between(least, most)


def normalize_spaces(c: Column) -> Column:
    """Outer white space cut, then every listed kind of space or invisible character becomes a plain space."""
    cut = F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")
    return F.translate(cut, VARIOUS_SPACES, " " * len(VARIOUS_SPACES))


def strip_copyright(c: Column) -> Column:
    """The first block comment is cut if it speaks of copyright; then the leading lines that are comments or empty."""
    block = r"/\*[^*]*\*+(?:[^*/][^*]*\*+)*/"
    first = F.regexp_extract(c, block, 0)
    told = first.rlike("(?i)copyright | 版权")
    at = F.locate("/*", c)  # the first match starts at the first opening whose block is closed
    cut = F.when(told, F.concat(F.substring(c, F.lit(1), F.position(first, c) - 1), F.substring(c, F.position(first, c) + F.length(first), F.length(c)))).otherwise(c)
    body = F.regexp_replace(cut, r"\A(?:(?://|#|--)[^\n]*(?:\n|\z)|\n)+", "")
    return F.when(at > 0, body).otherwise(F.regexp_replace(c, r"\A(?:(?://|#|--)[^\n]*(?:\n|\z)|\n)+", ""))


def normalize_for_model(c: Column, lower: bool = False, accents: bool = False, numbers: bool = True, punctuation: int = 1) -> Column:
    """Text as a language model reads it: trimmed, digits as 0, plain punctuation (1) or none (2), no control characters."""
    c = F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")
    if lower:
        c = F.lower(c)
    if accents:
        c = strip_accents(c)
    if numbers:
        c = F.regexp_replace(c, r"\p{Nd}", "0")
    for k, v in PUNCTUATION_TABLE.items() if punctuation else ():
        if punctuation == 2 or len(v) != 1:
            c = F.replace(c, F.lit(k), F.lit("" if punctuation == 2 else v))
    if punctuation == 1:
        single = {k: v for k, v in PUNCTUATION_TABLE.items() if len(v) == 1}
        c = F.translate(c, "".join(single), "".join(single.values()))
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x9f]", "")


@F.pandas_udf(StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    """Without combining marks after decomposition."""
    return texts.map(lambda t: t if t is None or t.isascii() else "".join(x for x in unicodedata.normalize("NFD", t) if unicodedata.category(x) != "Mn"))
