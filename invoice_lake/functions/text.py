"""Free-text normalising and keyword tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from re import escape, fullmatch, match

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java gives accented letters word status at \b; the reports need ASCII word boundaries. Next to an
# ASCII word character a boundary is a single look-around.
_WORD = "[0-9A-Za-z_]"
_BOUNDARY = f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"
_BEFORE_WORD = f"(?<!{_WORD})"
_AFTER_WORD = f"(?!{_WORD})"


def normalize_text(text: Column, collapse_all: bool = False) -> Column:
    """Lower case, hyphen to space, first run of white space to one space.

    Only the first run is collapsed, to agree with published results; ``collapse_all`` takes all.
    """
    spaced = F.replace(F.lower(text), F.lit("-"), F.lit(" "))
    if collapse_all:
        return F.regexp_replace(spaced, r"[\t\n\f\r ]+", " ")
    return F.regexp_replace(spaced, r"(?s)^(.*?)[\t\n\f\r ]+", "$1 ")


def normalize_keyword(text: Column, collapse_all: bool = False) -> Column:
    return normalize_text(F.trim(text), collapse_all)


def has_word(text: Column, pattern: str) -> Column:
    """Whether ``pattern`` (a regular expression) occurs between word boundaries.

    A plain substring test of the pattern's literal beginning goes first: it is far cheaper, and
    most texts fail it.
    """
    start = _BEFORE_WORD if match(_WORD, pattern) and "|" not in pattern else _BOUNDARY
    end = _AFTER_WORD if fullmatch(f".*{_WORD}{_WORD}[?]?", pattern) and "|" not in pattern else _BOUNDARY
    matched = text.rlike(f"{start}(?:{pattern}){end}")
    literal = _literal_start(pattern)
    return text.contains(literal) & matched if literal else matched


def _literal_start(pattern: str) -> str:
    """The plain characters every match begins with; '' if the pattern has alternatives."""
    if "|" in pattern:
        return ""
    literal = match(r"[\w ]*", pattern).group()
    follows = pattern[len(literal):][:1]
    return literal[:-1] if follows in ("?", "*", "{") and follows else literal


def word_flags(text: Column, patterns: dict[str, str]) -> list[Column]:
    """One boolean column per entry of ``{column name: pattern}``.

    Give a normalised text as a column of its own, so that it is computed once for all flags.
    """
    return [has_word(text, pattern).alias(name) for name, pattern in patterns.items()]


def first_category(text: Column, words: Sequence[str], default: str) -> Column:
    """The first of ``words`` that occurs as a whole word, in the given order."""
    lowered = F.lower(text)
    branch = F.when(has_word(lowered, escape(words[0])), F.lit(words[0]))
    for word in words[1:]:
        branch = branch.when(has_word(lowered, escape(word)), F.lit(word))
    return branch.otherwise(F.lit(default))


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """LIKE '%a%' OR LIKE '%b%' on lower-cased text."""
    lowered = F.lower(text)
    return reduce(or_, [lowered.contains(part) for part in parts])


def matches_any(text: Column, parts: Sequence[str]) -> Column:
    """One alternation test on lower-cased text."""
    return F.lower(text).rlike("|".join(escape(part) for part in parts))


def found_keywords(text: Column, keywords: Sequence[str], needles: Sequence[str]) -> Column:
    """Array of the ``keywords`` whose needle (its normalised form) the text contains."""
    tests = [F.when(text.contains(needle), F.lit(keyword)) for keyword, needle in zip(keywords, needles)]
    return F.array_compact(F.array(*tests))


def label_override(value: Column, labels: dict[int, str]) -> Column:
    """The value as text, with some values written out, e.g. {2025: '2025 (até 30/09)'}."""
    texts = [F.when(value == key, F.lit(label)) for key, label in labels.items()]
    return F.coalesce(*texts, value.cast("string"))
