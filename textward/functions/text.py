"""Text predicates and features as built-in column expressions (no Python in the row path)."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Cyrillic block, the script the curation rules were written for.
CYRILLIC = "Ѐ-ӿ"

# The characters Python's str.split() treats as whitespace, as a Java regex class body.
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"

WORD = r"[\p{L}\p{N}_]{2,}"

POSITIVE, NEGATIVE = "jailbreak", "benign"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    An expression named inside a ``transform`` lambda is evaluated again for every element, which
    turns per-row work quadratic; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize(text: Column | str) -> Column:
    """Lowercase, collapse every run of Unicode whitespace to one space, trim."""
    return F.trim(F.regexp_replace(F.lower(_col(text)), f"[{SPACE}]+", " "))


def strip(text: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_col(text), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def count_chars(text: Column | str, char_class: str) -> Column:
    """Number of characters inside a regex class body; removes whole runs, so few regex matches."""
    t = _col(text)
    return F.length(t) - F.length(F.regexp_replace(t, f"[{char_class}]+", ""))


def letter_script_ratio(text: Column | str, script: str = CYRILLIC) -> Column:
    """Letters of ``script`` as a share of all letters; 0.0 without letters."""
    letters = F.regexp_replace(_col(text), r"\P{L}+", "")
    return F.coalesce(F.try_divide(count_chars(letters, script), F.length(letters)), F.lit(0.0))


def char_script_ratio(text: Column | str, script: str = CYRILLIC) -> Column:
    """Characters of ``script`` as a share of all characters; 0.0 for empty text."""
    t = _col(text)
    return F.coalesce(F.try_divide(count_chars(t, script), F.length(t)), F.lit(0.0))


def is_script(text: Column | str, min_ratio: float = 0.5, script: str = CYRILLIC) -> Column:
    return letter_script_ratio(text, script) >= F.lit(float(min_ratio))


def length_ok(text: Column | str, min_chars: int = 10, max_chars: int = 4000) -> Column:
    return F.length(_col(text)).between(min_chars, max_chars)


@functools.cache
def other_digits() -> str:
    """Class body of the characters ``str.isdigit`` accepts beside decimal digits, as ranges.

    All of them, such as superscripts, belong to the category No.
    """
    points = [
        c
        for c in range(sys.maxunicode + 1)
        if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"
    ]
    runs: list[list[int]] = []
    for c in points:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in runs)


def count_digits(text: Column | str) -> Column:
    """Characters for which ``str.isdigit`` holds.

    The long class of rare digits only sees what is left of the text in its category.
    """
    rare = F.regexp_replace(_col(text), r"\P{No}+", "")
    return count_chars(text, r"\p{Nd}") + count_chars(rare, other_digits())


def char_features(text: Column | str, script: str = CYRILLIC) -> Column:
    """``[length, letters, script characters, digits]`` as doubles."""
    t = _col(text)
    parts = [
        F.length(t),
        count_chars(t, r"\p{L}"),
        count_chars(t, script),
        count_digits(t),
    ]
    return F.array(*[p.cast("double") for p in parts])


def char_shingles(text: Column | str, k: int = 4) -> Column:
    """Distinct character k-grams of the normalized text; a shorter text is its own only shingle.

    One pass of a pattern that looks ahead k characters and moves on by one.
    """
    ahead = F.lit(f"(?s)(?=(.{{{k}}})).")

    def windows(norm: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(norm, ahead, F.lit(1)))
        return F.when(F.length(norm) < k, F.array(norm)).otherwise(found)

    return bind(normalize(text), windows)


def tokens(text: Column | str) -> Column:
    """Lowercased runs of at least two word characters, in order."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD), F.lit(0))


def word_ngrams(toks: Column, min_n: int = 1, max_n: int = 2) -> Column:
    """Word n-grams of every size in ``min_n..max_n``, words joined by one space."""

    def of_size(t: Column, n: int) -> Column:
        # The words beside their followers; a text of fewer words has no n-gram.
        held = F.greatest(F.size(t) - (n - 1), F.lit(0))
        runs = F.slice(t, 1, held) if n > 1 else t
        for j in range(2, n + 1):
            runs = F.zip_with(runs, F.slice(t, j, held), lambda a, b: F.concat(a, F.lit(" "), b))
        return runs

    return bind(toks, lambda t: F.concat(*[of_size(t, n) for n in range(min_n, max_n + 1)]))


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>``: each distinct element with its number of occurrences.

    Counts inside the row (sort, then run lengths), so repeats never reach a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i >= 0)
            & (i < F.size(ordered))
            & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )
        return bind(
            starts,
            lambda s: F.transform(
                s,
                lambda at, j: F.struct(
                    F.get(ordered, at).alias("term"),
                    (F.coalesce(F.get(s, j + 1), F.size(ordered)) - at).cast("bigint").alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(terms), runs)


def group_hash(text: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the normalized text."""
    return F.substring(F.sha2(normalize(text), 256), 1, 16)


def hash_bucket(group: Column | str, buckets: int = 10_000) -> Column:
    """Group hash modulo ``buckets``; decimal because the hash is an unsigned 64-bit number."""
    return (F.conv(_col(group), 16, 10).cast("decimal(20,0)") % F.lit(buckets)).cast("int")


def token_estimate(text: Column | str) -> Column:
    return F.length(_col(text)) / F.lit(4.0)


def first_paragraph(text: Column | str, separator: str = "\n\n") -> Column:
    return F.substring_index(_col(text), separator, 1)


def preview(text: Column | str, n: int = 80) -> Column:
    t = _col(text)
    return F.concat(F.left(t, F.lit(n)), F.when(F.length(t) > n, "...").otherwise(""))


def valid_input(text: Column | str, max_chars: int = 10_000) -> Column:
    """A request is valid with 1..``max_chars`` characters; null counts as invalid."""
    return F.coalesce(F.length(_col(text)).between(1, max_chars), F.lit(False))


def decode_label(p: Column | str) -> Column:
    return F.when(_col(p) >= 0.5, POSITIVE).otherwise(NEGATIVE)


def decode_confidence(p: Column | str) -> Column:
    p = _col(p)
    return F.when(p >= 0.5, p).otherwise(F.lit(1.0) - p)
