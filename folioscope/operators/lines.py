"""Lines of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.extract import conservative_lines
from folioscope.functions.text import text_lines, without_headers


def _exploded(pages: DataFrame, lines: Column) -> DataFrame:
    return pages.select(
        "doc_id",
        "page_no",
        F.posexplode(lines).alias("line_no", "line"),
    )


def page_lines(pages: DataFrame, text: str = "native_text") -> DataFrame:
    """Stripped, non-blank lines, numbered from 0."""
    return _exploded(pages, text_lines(F.col(text)))


def header_free_lines(pages: DataFrame, text: str = "native_text") -> DataFrame:
    """Lines without running headers and footers, numbered after the removal."""
    return _exploded(pages, without_headers(text_lines(F.col(text))))


def footnote_candidate_lines(pages: DataFrame, text: str = "native_text") -> DataFrame:
    """Lines that pass the exclusion patterns and the length test of the
    conservative path, numbered after the removal."""
    return _exploded(pages, conservative_lines(text_lines(F.col(text))))
