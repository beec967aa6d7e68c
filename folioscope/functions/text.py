"""Text expressions on whole page texts.

Patterns run with Unicode classes (``U``), so no-break spaces, accented letters
and non-Latin digits count as the space, word and digit they are, and with the
line feed as the only line break (``d``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv

FLAGS = "(?dU)"
FLAGS_ANY_CASE = "(?diuU)"

# the characters that str.strip() removes
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Catalyst shares repeated sub-expressions in generated code but not inside
    higher-order functions; a one-element ``transform`` is a variable there.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _literal_head(pattern: str) -> tuple[str, bool]:
    """The plain text every match starts with, and whether it is the whole pattern."""
    head, i = "", 0
    while i < len(pattern):
        char, step = pattern[i], 1
        if char == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            char, step = pattern[i + 1], 2
        elif char in "\\^$.*+?{}[]()|":
            break
        if pattern[i + step : i + step + 1] in ("?", "*", "{"):
            break
        head, i = head + char, i + step
    return head, i == len(pattern)


def found(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True if the pattern occurs.

    A pattern that starts with plain text is looked for only where that text is: the
    byte search costs a fraction of decoding the string for the pattern matcher.
    """
    search = text.rlike((FLAGS_ANY_CASE if ignore_case else FLAGS) + pattern)
    if ignore_case or "|" in pattern:
        return search
    if pattern.startswith("^"):
        head, whole = _literal_head(pattern[1:])
        guard = text.startswith(head)
    else:
        head, whole = _literal_head(pattern)
        guard = text.contains(head)
    if not head:
        return search
    return guard if whole else guard & search


def any_found(text: Column, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    """True if one of the patterns occurs; the cheap ones are tried first."""
    parts = [
        part
        for pattern in patterns
        for part in ([pattern] if "(" in pattern or ignore_case else pattern.split("|"))
    ]
    parts.sort(key=lambda part: not _literal_head(part.removeprefix("^"))[0])
    return reduce(lambda a, b: a | b, [found(text, p, ignore_case) for p in parts])


def any_contained(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def contained(text: Column, words: Sequence[str]) -> Column:
    """The words whose lower-case form occurs in ``text``, in the order given."""
    return F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, F.lower(w)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one space; ends are stripped."""
    # single spaces are left alone instead of being replaced by themselves
    return strip(F.regexp_replace(text, r"(?U)\s{2,}|[^\S ]", " "))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def squeezed_word_count(text: Column) -> Column:
    """Words of a non-empty text in which single spaces are the only white space."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def token_estimate(text: Column, words: Callable[[Column], Column] = word_count) -> Column:
    return F.floor(words(text) * F.lit(fv.TOKENS_PER_WORD)).cast("int")


def text_lines(text: Column) -> Column:
    """Stripped, non-blank lines of a page as ``array<string>``."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")


def without_headers(lines: Column, patterns: Sequence[str] = fv.HEADER_PATTERNS) -> Column:
    """Drop running headers and footers from an array of lines."""
    return F.filter(lines, lambda line: ~any_found(line, patterns))


def weighted_matches(text: Column, weights: Sequence[tuple[str, float]]) -> Column:
    """Sum of the weights of the patterns that occur, added in the order given."""
    score = F.lit(0.0)
    for pattern, weight in weights:
        score = score + F.when(found(text, pattern), F.lit(weight)).otherwise(F.lit(0.0))
    return score


def first_of_each(items: Column, key: str) -> Column:
    """From an array of structs, the smallest struct per value of its first field.

    ``key`` must be the first field, so that the natural order brings equal keys
    together: n log n within the row, no shuffle.
    """
    return bind(
        F.array_sort(items),
        lambda s: F.filter(
            s,
            lambda x, i: (i == 0) | ~x[key].eqNullSafe(F.get(s, i - 1)[key]),
        ),
    )
