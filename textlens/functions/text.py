"""Column expressions for the four tokenisers and text normalisation.

All of these are built-in Spark SQL expressions (JVM side, whole-stage
codegen); only accent stripping needs a vectorised pandas UDF because Spark
SQL has no Unicode normalisation function.

The tokenisers are deliberately different from each other:

* ``tfidf_tokens``      runs of >= 2 word characters, lower-cased
* ``position_words``    whitespace words (position = word number) cleaned to
                        letters and digits, kept when longer than 2
* ``semantic_tokens``   accent-free alphabetic runs of length 2..15
* ``query_words``       whitespace words with ASCII punctuation trimmed
"""

from __future__ import annotations

import unicodedata

import functools
import re
import sys

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlens.functions.words import PUNCTUATION

# The characters Python's str.split()/str.strip() treat as
# whitespace, as a Java regex class.
WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
# Word runs of at least two characters (letters, digits, underscore).
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Runs of what is no word character.
NON_TERM = r"[^\p{L}\p{N}_]+"
# Anything that is not a letter or digit.
NON_ALNUM = r"[^\p{L}\p{N}]"
# Runs of what is neither a letter, a digit nor white space.
NON_WORD = NON_ALNUM[:-1] + WHITESPACE[1:] + "+"
# Alphabetic runs: word characters without decimal digits (underscore kept).
ALPHA_RUN = r"[\p{L}\p{Nl}\p{No}_]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same whitespace characters as a plain string.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c) -> Column:
    """Remove leading and trailing whitespace like ``str.strip()`` (JVM
    ``btrim`` over the whitespace set, no regex)."""
    return F.btrim(_col(c), F.lit(WHITESPACE_CHARS))


def collapse_ws(c) -> Column:
    """Collapse every whitespace run to one space and strip the ends."""
    return strip(F.regexp_replace(_col(c), f"{WHITESPACE}+", " "))


def split_ws(c) -> Column:
    """Split on whitespace runs like ``str.split()``: no empty words."""
    s = strip(_col(c))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, f"{WHITESPACE}+"))


def tfidf_tokens(c) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TERM_PATTERN), 0)


def blank_non_terms(c) -> Column:
    """Lower-cased text with a space for every run of other characters than
    ``tfidf_tokens`` keeps: its tokens are what stands between spaces, but for
    single characters."""
    return F.regexp_replace(F.lower(_col(c)), NON_TERM, " ")


def clean_word(c) -> Column:
    """Keep only letters and digits of a word."""
    return F.regexp_replace(_col(c), NON_ALNUM, "")


def query_word(c) -> Column:
    """Trim ASCII punctuation from both ends of a word."""
    return F.btrim(_col(c), F.lit(PUNCTUATION))


def ascii_only(c) -> Column:
    """Drop every non-ASCII character."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


@functools.cache
def _mark_class() -> re.Pattern:
    """Regex of every code point whose category is Mn in this Python's
    Unicode database (built from the database, as ranges)."""
    ranges, start, prev = [], None, None
    for cp in range(sys.maxunicode + 1):
        if unicodedata.category(chr(cp)) == "Mn":
            if start is None:
                start = cp
            elif cp != prev + 1:
                ranges.append((start, prev))
                start = cp
            prev = cp
    if start is not None:
        ranges.append((start, prev))
    body = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    return re.compile(f"[{body}]+")




# Marks go with the non-ASCII run they stand in: no ASCII character composes
# with anything but a non-spacing mark, and those are dropped.
_NON_ASCII = re.compile(r"[^\x00-\x7F]+")
# Longest run that is remembered, and how many are in a Python process.
RUN_CHARS, RUNS = 32, 1 << 16


def _deaccent_run(s: str) -> str:
    """NFD, drop non-spacing marks (category Mn), NFC."""
    return unicodedata.normalize("NFC", _mark_class().sub("", unicodedata.normalize("NFD", s)))


_known_run = functools.lru_cache(RUNS)(_deaccent_run)


def _deaccent_one(s: str) -> str:
    """``_deaccent_run`` of every non-ASCII run; the rest stays as it is."""
    if s.isascii():
        return s
    return _NON_ASCII.sub(lambda m: (_known_run if m.end() - m.start() <= RUN_CHARS else _deaccent_run)(m[0]), s)


@F.pandas_udf(T.StringType())
def deaccent(s: pd.Series) -> pd.Series:
    """NFD-decompose, drop non-spacing marks, recompose (Arrow batched)."""
    return s.map(lambda v: None if v is None else _deaccent_one(v))


def semantic_tokens(c, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-case, strip accents, alphabetic runs of min_len..max_len chars
    that do not start with an underscore."""
    from pyspark.sql import SparkSession

    from textlens.session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    toks = F.regexp_extract_all(deaccent(F.lower(_col(c))), F.lit(ALPHA_RUN), 0)
    return F.filter(
        toks,
        lambda t: (F.length(t) >= min_len) & (F.length(t) <= max_len) & ~t.startswith("_"),
    )
