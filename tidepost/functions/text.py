"""Text, token, topic and number-format expressions (all JVM-side)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.binding import bind

# Cleaning patterns in the order they apply. (?U) makes \s and \w cover Unicode.
CLEAN_STEPS = (
    (r"(?U)http\S+|www\.\S+", ""),
    (r"(?U)@\w+", ""),
    (r"#", ""),
    (r"(?U)[^A-Za-z0-9\s!?.,']", ""),
    (r"(?U)\s+", " "),
)
KEYWORD_PATTERN = "[a-z]{3,}"
MIN_TOKEN_LENGTH = 2

# a phrase ends at a line end and at whatever is no plain letter or space
PHRASE_MARK = r"[^a-z\s]+|\n"
MIN_PHRASE_LENGTH = 4


def clean_text(text: Column) -> Column:
    """URLs, mentions, ``#`` and symbols removed, spaces collapsed, lower case; null -> ''."""
    out = F.coalesce(text, F.lit(""))
    for pattern, replacement in CLEAN_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.lower(F.trim(out))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def tokens(clean: Column) -> Column:
    """Whitespace tokens of at least two characters."""
    return F.filter(F.split(clean, r"\s+"), lambda t: F.length(t) >= MIN_TOKEN_LENGTH)


def topic_of(clean: Column, topic_rules=rules.TOPIC_RULES, whole_word: bool = False) -> Column:
    """First rule found in the text; substrings count unless ``whole_word``.

    A rule that only lists words is a chain of substring searches, which is about three times
    as fast as the same alternation as a regular expression.
    """

    def found(c: Column, pattern: str) -> Column:
        if whole_word:
            return c.rlike(rf"(?i)\b({pattern})\b")
        words = pattern.lower().split("|")
        if all(w.isalnum() for w in words):
            return reduce(or_, [F.contains(c, F.lit(w)) for w in words])
        return c.rlike(f"(?i){pattern}")

    def decide(c: Column) -> Column:
        out = F
        for name, pattern in topic_rules:
            out = out.when(found(c, pattern), F.lit(name))
        return out.otherwise(F.lit(rules.DEFAULT_TOPIC))

    return bind(F.lower(clean), decide)


def letter_words(text: Column) -> Column:
    """Runs of three or more letters, lower case, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(KEYWORD_PATTERN), F.lit(0))


def phrases(text: Column) -> Column:
    """Candidate phrases: what stands between stop words and punctuation."""
    marked = F.split(F.regexp_replace(F.lower(text), PHRASE_MARK, " | "), r"\s+")
    cut = F.transform(marked, lambda w: F.when(w.isin(*rules.STOP_WORDS), F.lit("|")).otherwise(w))
    parts = F.split(F.array_join(cut, " "), r"[ |]*\|[ |]*")
    return F.filter(F.transform(parts, F.trim), lambda p: F.length(p) >= MIN_PHRASE_LENGTH)


def excerpt(text: Column, length: int, mark: str = "…") -> Column:
    """The first characters for display, with a mark where something was left out."""
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit(mark))
    ).otherwise(text)


def joined_text(title: Column, body: Column) -> Column:
    """Title and body, without white space of any kind at either end."""
    return F.regexp_replace(F.concat_ws(" ", title, body), r"(?U)^\s+|\s+$", "")


def proper_label(label: Column) -> Column:
    """One spelling for labels: ``positive`` and ``POSITIVE`` become ``Positive``."""
    return F.initcap(label)


def short_number(number: Column) -> Column:
    """999, 1.5K, 2.5M; one digit, rounded on the exact binary value as C does."""
    size = F.abs(number)

    def scaled(unit: float, suffix: str) -> Column:
        digits = F.call_function("format_number", number.cast("double") / unit, F.lit("0.0"))
        return F.concat(digits, F.lit(suffix))

    return (
        F.when(size >= 1_000_000, scaled(1e6, "M"))
        .when(size >= 1_000, scaled(1e3, "K"))
        .otherwise(number.cast("bigint").cast("string"))
    )
