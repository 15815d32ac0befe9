"""Tokenizers (T1): ``Column<string> -> Column<array<string>>``, JVM-side regex.

``basic``     maximal runs of letters/digits of the lower-cased text.
``smart``     ordered alternation: e-mail | IPv4 | host name | Han run |
              other letter/digit run.  Keeps ``xx@ob.com``, ``192.168.1.1``
              and ``www.xxx.com`` whole and splits Han from Latin.
``max_word``  ``smart`` plus the finer parts: the letter/digit pieces of
              e-mails and hosts, and character bigrams of every Han run
              (a single Han character stays a unigram).

The reference's analyzer is a lexicon-based Chinese segmenter; without a
lexicon the Han handling here is a bigram approximation (see README).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns (Java regex; the only RE2 difference is the
# Han script name, ``\\p{IsHan}`` here and ``\\p{Han}`` in RE2).
BASIC_TOKEN = "[\\p{L}\\p{N}]+"
_WORD = "[a-z][^\\P{L}\\p{IsHan}]"  # inside a class: a letter that is not Han, the cheap tests first
# runs are one class each and possessive where what must follow is not in the class: nothing is tried
# twice, and a long run needs no stack
_LABEL = "[[0-9]" + _WORD + "\\p{N}-]++"
EMAIL = "[[0-9]" + _WORD + "\\p{N}._%+-]++@" + _LABEL + "(?:\\." + _LABEL + ")+"
IPV4 = "(?:\\d{1,3}\\.){3}\\d{1,3}"
HOST = "(?:" + _LABEL + "\\.)+[" + _WORD + "]{2,}"
HAN_RUN = "\\p{IsHan}+"
NON_HAN_RUN = "[[0-9]" + _WORD + "\\p{N}]++"
SMART_TOKEN = "|".join([EMAIL, IPV4, HOST, NON_HAN_RUN, HAN_RUN])

MODES = ("basic", "smart", "max_word")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basic_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(BASIC_TOKEN), 0)


def smart_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(SMART_TOKEN), 0)


def _han_bigrams(token: Column) -> Column:
    n = F.length(token)
    return F.when(
        n <= 1, F.array(token)
    ).otherwise(
        F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(token, i, 2))
    )


def max_word_tokens(c: Column | str) -> Column:
    """``smart`` tokens, each followed by its finer parts (if any)."""
    smart = smart_tokens(c)

    def parts(tok: Column) -> Column:
        is_han = (F.ascii(tok) > 127) & tok.rlike("^" + HAN_RUN + "$")
        # only e-mail / IPv4 / host tokens, all of which hold a dot, carry separators and can split further
        pieces = F.when(F.contains(tok, F.lit(".")), F.regexp_extract_all(tok, F.lit(NON_HAN_RUN), 0))
        finer = F.when(F.size(pieces) > 1, pieces).otherwise(F.array().cast("array<string>"))
        return F.when(is_han, _han_bigrams(tok)).otherwise(F.concat(F.array(tok), finer))

    return F.flatten(F.transform(smart, parts))


def tokenize(c: Column | str, mode: str = "basic") -> Column:
    if mode == "basic":
        return basic_tokens(c)
    if mode == "smart":
        return smart_tokens(c)
    if mode == "max_word":
        return max_word_tokens(c)
    raise ValueError(f"unknown tokenizer mode {mode!r}; expected one of {MODES}")
