"""Question kinds and answer parsing as native column expressions.

Patterns spell out Unicode classes instead of ``\\b``, ``\\w`` and ``\\s`` so
that the result does not depend on the regex engine's or Java's own notion of
a word.  "Last match" is a greedy prefix, not a list of all matches: one pass,
no array, whole text.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "count"
OUTPUT = "output"

# The prefixes that name a question's kind.
OUTPUT_PREFIX = "What is the output"
COUNT_PREFIX = "How many"

# Number words and their digits.
NUMBER_WORDS = {
    "zero": "0",
    "one": "1",
    "two": "2",
    "three": "3",
    "four": "4",
    "five": "5",
    "six": "6",
    "seven": "7",
    "eight": "8",
    "nine": "9",
    "ten": "10",
}

# Words that stand for a truth value.  The pattern ignores case,
# and with it takes a long s; only the plain spelling of yes is affirmative.
TRUTH_WORDS = {"true": "True", "false": "False", "fal\u017fe": "False"}
YES_WORDS = {"yes": "True", "no": "False", "ye\u017f": "False"}

WORD = r"\p{L}\p{N}_"
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
LINE_END = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
# Java looks one UTF-16 unit back unless the class names a character beyond U+FFFF; this one is a digit anyway.
NOT_AFTER_WORD = f"(?<![{WORD}\U0001d7d8])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"

ASSIGNMENT = (
    rf"(?iu){NOT_AFTER_WORD}x\p{{Nd}}+{SPACE}*={SPACE}*(?:true|false){NOT_BEFORE_WORD}"
)
AFTER_LAST_MARKER = rf"(?isu)^.*final{SPACE}*answer{SPACE}*[:\-–]?(.*)$"
FIRST_LINE = rf"^[^{LINE_END}]*"


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and the ASCII digit of its value."""
    chars = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(chars), "".join(str(unicodedata.decimal(c)) for c in chars)


def strip(text: Column) -> Column:
    """Remove every kind of white space at both ends, not only blanks."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def question_kind(question: Column, strict: bool = True) -> Column:
    """``output`` or ``count`` by the stripped prefix; others raise, or are NULL."""
    q = strip(question)
    unknown = (
        F.raise_error(F.concat(F.lit("unknown question format: "), F.coalesce(question, F.lit("NULL"))))
        if strict
        else F.lit(None)
    )
    return (
        F.when(q.startswith(OUTPUT_PREFIX), F.lit(OUTPUT))
        .when(q.startswith(COUNT_PREFIX), F.lit(COUNT))
        .otherwise(unknown.cast("string"))
    )


def asked_gate(question: Column) -> Column:
    """Gate type named by a count question, lower case; NULL when absent."""
    hit = F.regexp_extract(question, rf"(?iu)How many ([{WORD}]+) gates", 1)
    return F.when(hit != "", F.lower(hit))


def strip_artifacts(text: Column, question: Column | None = None) -> Column:
    """Drop everything through the first echo of the question, then x<i>=<bool>."""
    out = F.coalesce(text, F.lit(""))
    if question is not None:
        q = F.coalesce(strip(question), F.lit(""))
        at = F.instr(out, q)
        out = F.when(
            (q != "") & (at > 0), F.substring(out, at + F.length(q), F.length(out))
        ).otherwise(out)
    return F.regexp_replace(out, ASSIGNMENT, " ")


def _last_token(text: Column, alternatives: str) -> Column:
    return F.regexp_extract(
        text, rf"(?isu)^.*{NOT_AFTER_WORD}({alternatives}){NOT_BEFORE_WORD}", 1
    )


def _last_word(text: Column, values: dict[str, str], upper: Column | None) -> Column:
    """Value of the last of some words; NULL when there is none.

    ``upper`` is the text in capitals, if at hand: a plain search in it spares
    most long texts the pattern.  The lookup evaluates the pattern once.
    """
    lookup = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    words = [w for w in values if w.isascii()]
    found = F.try_element_at(lookup, F.lower(_last_token(text, "|".join(words))))
    if upper is None:
        return found
    present = reduce(lambda a, b: a | b, [F.contains(upper, F.lit(w.upper())) for w in words])
    return F.when(present, found)


def _last_number(text: Column, alternatives: str) -> Column:
    hit = F.nullif(_last_token(text, alternatives), F.lit(""))
    return F.when(text.rlike(r"\p{Nd}"), hit)


def extract_bool(text: Column, upper: Column | None = None) -> Column:
    """Last true/false, else last lone 0/1, else last yes/no, as True/False."""
    digits = F.create_map(F.lit("1"), F.lit("True"), F.lit("0"), F.lit("False"))
    return F.coalesce(
        _last_word(text, TRUTH_WORDS, upper),
        F.try_element_at(digits, _last_number(text, "[01]")),
        _last_word(text, YES_WORDS, upper),
    )


def extract_count(text: Column, upper: Column | None = None) -> Column:
    """Last lone run of digits without leading zeros, else last number word."""
    foreign, ascii_digits = _decimal_digits()
    digits = F.translate(_last_number(text, r"\p{Nd}+"), foreign, ascii_digits)
    return F.coalesce(
        F.regexp_replace(digits, r"^0+([0-9])", "$1"), _last_word(text, NUMBER_WORDS, upper)
    )


def extract(text: Column, kind: Column, upper: Column | None = None) -> Column:
    """By kind; a NULL or unknown kind tries booleans first, then counts."""
    as_bool, as_count = extract_bool(text, upper), extract_count(text, upper)
    return (
        F.when(kind == COUNT, as_count)
        .when(kind == OUTPUT, as_bool)
        .otherwise(F.coalesce(as_bool, as_count))
    )


def with_clean_answer(
    df: DataFrame,
    text: str,
    kind: Column | None = None,
    question: Column | None = None,
    default: Column | None = None,
    out: str = "answer",
) -> DataFrame:
    """Add the canonical answer of a free-form generation.

    Looks, in order, at the first line after the last "final answer" marker,
    the whole tail after it, and the whole text.  Staged as columns so that
    the cleaned text and its tail are computed once per row.
    """
    if kind is None:
        kind = question_kind(question) if question is not None else F.lit(None).cast("string")
    marked = F.contains(F.col("_upper"), F.lit("FINAL"))
    staged = (
        df.withColumns({"_cleaned": strip_artifacts(F.col(text), question), "_kind": kind})
        .withColumn("_upper", F.upper("_cleaned"))
        .withColumn("_tail", F.when(marked, F.regexp_extract("_cleaned", AFTER_LAST_MARKER, 1)))
    )
    answer = F.coalesce(
        extract(F.regexp_extract("_tail", FIRST_LINE, 0), F.col("_kind")),
        extract(F.col("_tail"), F.col("_kind")),
        extract(F.col("_cleaned"), F.col("_kind"), F.col("_upper")),
        default if default is not None else F.lit(None).cast("string"),
    )
    return staged.withColumn(out, answer).drop("_cleaned", "_kind", "_upper", "_tail")
