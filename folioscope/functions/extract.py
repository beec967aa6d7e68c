"""Extraction of footnotes and paragraphs inside one page.

A page is one row, so everything that never crosses a page is computed in the
row, as an array column: no explode-and-regroup, hence no shuffle of page text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.text import (
    FLAGS_ANY_CASE,
    any_contained,
    any_found,
    bind,
    first_of_each,
    found,
    squeeze,
    squeezed_word_count,
    strip,
    text_lines,
    token_estimate,
    weighted_matches,
    without_headers,
    word_count,
)

FOOTNOTE_START, PARAGRAPH_START = fv.FOOTNOTE_START, fv.PARAGRAPH_START


def is_footnote(text: Column, date_patterns: Sequence[str] = fv.DATE_PATTERNS) -> Column:
    """Long enough, carries a citation, and no date."""
    return (
        (F.length(text) >= 10)
        & any_found(text, fv.CITATION_PATTERNS)
        & ~any_found(text, date_patterns, ignore_case=True)
    )


def hybrid_confidence(text: Column) -> Column:
    score = weighted_matches(text, fv.HYBRID_CONFIDENCE_WEIGHTS)
    score = score + F.when(F.length(text) > 50, F.lit(0.1)).otherwise(F.lit(0.0))
    return F.least(score, F.lit(1.0))


def page_footnotes(
    text: Column,
    header_patterns: Sequence[str] = fv.HEADER_PATTERNS,
    date_patterns: Sequence[str] = fv.DATE_PATTERNS,
) -> Column:
    """Multi-line footnotes: ``array<struct<number, content, confidence>>``.

    The page is cut in front of every numbered line.  A block counts if its first
    line is a valid footnote; longer continuation lines are appended.
    """
    cleaned = F.array_join(without_headers(text_lines(text), header_patterns), "\n")
    blocks = F.filter(
        F.split(cleaned, rf"(?U)\n(?={FOOTNOTE_START})"),
        lambda b: found(b, "^" + FOOTNOTE_START),
    )
    parts = F.transform(
        blocks,
        lambda b: F.struct(
            F.regexp_extract(b, r"(?U)^(\d+)", 1).alias("number"),
            F.regexp_extract(b, r"(?U)^\d+[^\S\n]+([^\n]*)", 1).alias("head"),
            F.filter(
                F.split(b, "\n"), lambda line, i: (i > 0) & (F.length(line) > 10)
            ).alias("tail"),
        ),
    )
    return F.transform(
        F.filter(parts, lambda p: is_footnote(p["head"], date_patterns)),
        lambda p: F.struct(
            p["number"].alias("number"),
            F.array_join(F.concat(F.array(p["head"]), p["tail"]), " ").alias("content"),
            hybrid_confidence(p["head"]).alias("confidence"),
        ),
    )


def is_paragraph(text: Column) -> Column:
    return (F.length(text) >= 50) & (
        any_contained(F.lower(text), fv.PARAGRAPH_WORDS) | (word_count(text) >= 10)
    )


def footnote_references(text: Column) -> Column:
    """Every run of one to three digits, in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\d{1,3})"), F.lit(1))


def page_paragraphs(
    text: Column, header_patterns: Sequence[str] = fv.HEADER_PATTERNS
) -> Column:
    """Dotted paragraphs, the first valid one per number, in page order:
    ``array<struct<number, content, start_line, end_line, token_count,
    footnote_references>>``."""

    def blocks(lines: Column) -> Column:
        starts = F.filter(
            F.transform(lines, lambda line, i: F.when(found(line, PARAGRAPH_START), i)),
            lambda i: i.isNotNull(),
        )
        return bind(
            starts,
            lambda at: F.transform(
                at,
                lambda start, j: F.struct(
                    F.regexp_extract(F.get(lines, start), r"(?U)^(\d+)", 1).alias("number"),
                    start.alias("start_line"),
                    F.coalesce(F.get(at, j + 1), F.size(lines)).alias("end_line"),
                ),
            ),
        )

    def with_content(lines: Column) -> Column:
        return F.transform(
            blocks(lines),
            lambda b: b.withField(
                "content",
                strip(
                    F.regexp_replace(
                        F.array_join(
                            F.slice(
                                lines,
                                b["start_line"] + 1,
                                b["end_line"] - b["start_line"],
                            ),
                            " ",
                        ),
                        r"(?U)^\d+\.\s*",
                        "",
                    )
                ),
            ),
        )

    valid = F.filter(
        bind(without_headers(text_lines(text), header_patterns), with_content),
        lambda b: is_paragraph(b["content"]),
    )
    in_page_order = F.array_sort(
        F.transform(
            first_of_each(valid, "number"),
            lambda b: F.struct(b["start_line"], b["end_line"], b["number"], b["content"]),
        )
    )
    return F.transform(
        in_page_order,
        lambda b: F.struct(
            b["number"].alias("number"),
            b["content"].alias("content"),
            b["start_line"].alias("start_line"),
            b["end_line"].alias("end_line"),
            token_estimate(b["content"]).alias("token_count"),
            footnote_references(b["content"]).alias("footnote_references"),
        ),
    )


def conservative_confidence(text: Column) -> Column:
    lowered = F.lower(text)
    keywords = F.lit(0)
    for word in fv.CONSERVATIVE_KEYWORDS:
        keywords = keywords + lowered.contains(word).cast("int")

    def add(score: Column, condition: Column, value: float) -> Column:
        return score + F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    before, after = fv.CONSERVATIVE_CONFIDENCE_WEIGHTS[:4], fv.CONSERVATIVE_CONFIDENCE_WEIGHTS[4:]
    score = F.lit(0.0)
    for pattern, ignore_case, value in before:
        score = add(score, found(text, pattern, ignore_case=ignore_case), value)
    score = score + F.least(keywords * F.lit(fv.KEYWORD_WEIGHT), F.lit(fv.MAX_KEYWORD_WEIGHT))
    score = add(score, F.length(text) < fv.SHORT_FOOTNOTE_LENGTH, fv.SHORT_FOOTNOTE_WEIGHT)
    for pattern, ignore_case, value in after:
        score = add(score, found(text, pattern, ignore_case=ignore_case), value)
    return F.least(score, F.lit(1.0))


def conservative_lines(lines: Column) -> Column:
    """Lines long enough and free of the exclusion patterns."""
    return F.filter(
        lines, lambda x: (F.length(x) >= 15) & ~any_found(x, fv.EXCLUSION_PATTERNS)
    )


def conservative_page_footnotes(
    text: Column, min_confidence: float = fv.CONSERVATIVE_MIN_CONFIDENCE
) -> Column:
    """Single-line footnotes, the most confident one per number (the earlier one on
    ties), in line order: ``array<struct<number, content, confidence>>``."""
    # The alternatives are tried in order at the head of the line, so the first
    # pattern that matches decides what is cut off.
    opening = "^(?:" + "|".join(fv.CONSERVATIVE_FOOTNOTE_PATTERNS) + ")"
    candidates = F.transform(
        F.filter(
            conservative_lines(text_lines(text)),
            lambda x: found(x, opening, ignore_case=True),
        ),
        lambda x, i: F.struct(
            F.regexp_extract(x, r"(?U)^(\d+)", 1).alias("number"),
            i.alias("line"),
            strip(F.regexp_replace(x, FLAGS_ANY_CASE + opening, "")).alias("content"),
        ),
    )
    cited = F.filter(
        candidates,
        lambda c: (F.length(c["content"]) > 10)
        & any_contained(F.lower(c["content"]), [w.lower() for w in fv.LEGAL_INDICATORS]),
    )
    scored = F.transform(
        cited,
        lambda c: F.struct(
            c["number"].alias("number"),
            (-conservative_confidence(c["content"])).alias("minus_confidence"),
            c["line"].alias("line"),
            c["content"].alias("content"),
        ),
    )
    best = first_of_each(
        F.filter(scored, lambda c: c["minus_confidence"] <= -min_confidence), "number"
    )
    in_line_order = F.array_sort(
        F.transform(
            best,
            lambda c: F.struct(c["line"], c["number"], c["minus_confidence"], c["content"]),
        )
    )
    return F.transform(
        in_line_order,
        lambda c: F.struct(
            c["number"].alias("number"),
            c["content"].alias("content"),
            (-c["minus_confidence"]).alias("confidence"),
        ),
    )


def _bracketed(text: Column) -> Column:
    """``[n] text`` up to the next bracket of any kind, longer than 50 characters."""
    pieces = F.filter(
        F.split(F.concat(F.lit(" "), text), r"\["), lambda x: found(x, r"^\d+\]")
    )
    return F.filter(
        F.transform(
            pieces,
            lambda x: F.struct(
                F.regexp_extract(x, r"(?U)^(\d+)", 1).alias("number"),
                strip(F.regexp_replace(x, r"(?U)^\d+\]", "")).alias("raw"),
            ),
        ),
        lambda p: F.length(p["raw"]) > 50,
    )


def bracket_texts(text: Column) -> Column:
    """Bracketed paragraphs: ``array<struct<number, content>>``."""
    return F.transform(
        _bracketed(text),
        lambda p: F.struct(p["number"].alias("number"), squeeze(p["raw"]).alias("content")),
    )


def bracket_paragraphs(text: Column) -> Column:
    """The same with their token counts: ``array<struct<number, content, token_count>>``."""
    return F.transform(
        bracket_texts(text),
        lambda p: p.withField("token_count", token_estimate(p["content"], squeezed_word_count)),
    )


def bracket_tokens(text: Column) -> Column:
    """Token counts of the bracketed paragraphs alone, without cleaning their text."""
    return F.transform(_bracketed(text), lambda p: token_estimate(p["raw"]))


def section_marker(text: Column) -> Column:
    """Label of the first section pattern, in list order, found on the page."""
    first = F.coalesce(
        *[
            F.when(found(text, pattern, ignore_case=True), F.lit(label))
            for label, pattern in fv.SECTION_PATTERNS
        ]
    )
    # All headings are a numeral ending in I or V, a dot and a title; one search for
    # any of them rules out the many pages without one.
    titles = [pattern.split(r"\.\s+", 1)[1] for _, pattern in fv.SECTION_PATTERNS]
    any_heading = r"[IV]\.\s+(?:" + "|".join(titles) + ")"
    return F.when(found(text, any_heading, ignore_case=True), first)
