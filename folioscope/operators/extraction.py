"""Hybrid extraction: footnotes from the native text, paragraphs from the
recognised text, page by page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.extract import page_footnotes, page_paragraphs
from folioscope.sources.pages import page_slice

# fixed values written into the result tables
PARAGRAPH_METHOD = "hybrid_ocr"
FOOTNOTE_METHOD = "pymupdf"
PARAGRAPH_SECTION = "main_text"
PARAGRAPH_CONFIDENCE = 0.8


def extract_pages(
    pages: DataFrame,
    skip: int = fv.SKIP_FIRST_PAGES,
    max_pages: int | None = None,
    header_patterns: Sequence[str] = fv.HEADER_PATTERNS,
    date_patterns: Sequence[str] = fv.DATE_PATTERNS,
) -> DataFrame:
    """One row per page with its paragraphs and footnotes as arrays.

    A map over the scan: no shuffle.  Store this table once when several of the
    results below are wanted; the counts beside the arrays let reports read
    two integers per page.
    """
    paragraphs = page_paragraphs(F.col("ocr_text"), header_patterns)
    footnotes = page_footnotes(F.col("native_text"), header_patterns, date_patterns)
    # a page that fails contributes nothing, whatever was recognised on it
    readable = F.col("native_text").isNotNull()
    arrays = page_slice(pages, skip, max_pages).select(
        "doc_id",
        "page_no",
        readable.alias("success"),
        F.coalesce(F.when(readable, paragraphs), F.array()).alias("paragraphs"),
        F.coalesce(footnotes, F.array()).alias("footnotes"),
    )
    return arrays.select(
        "*",
        F.size("paragraphs").alias("n_paragraphs"),
        F.size("footnotes").alias("n_footnotes"),
    )


def hybrid_paragraphs(extracted: DataFrame) -> DataFrame:
    p = F.col("p")
    return extracted.select(
        "doc_id", F.col("page_no").alias("page"), F.explode("paragraphs").alias("p")
    ).select(
        "doc_id",
        p["number"].alias("paragraph_number"),
        p["content"].alias("content"),
        "page",
        F.lit(PARAGRAPH_SECTION).alias("section_type"),
        p["token_count"].alias("token_count"),
        p["footnote_references"].alias("footnote_references"),
        p["start_line"].alias("start_line"),
        p["end_line"].alias("end_line"),
        F.lit(PARAGRAPH_METHOD).alias("extraction_method"),
        F.lit(PARAGRAPH_CONFIDENCE).alias("confidence"),
    )


def hybrid_footnotes(extracted: DataFrame) -> DataFrame:
    n = F.col("n")
    return extracted.select(
        "doc_id", F.col("page_no").alias("page"), F.explode("footnotes").alias("n")
    ).select(
        "doc_id",
        n["number"].alias("footnote_number"),
        n["content"].alias("content"),
        "page",
        n["confidence"].alias("confidence"),
        F.lit(FOOTNOTE_METHOD).alias("detection_method"),
        F.lit([]).cast("array<string>").alias("referenced_paragraphs"),
    )


def page_status(extracted: DataFrame) -> DataFrame:
    """Success and counts per page; pages without text are reported as failed."""
    return extracted.select(
        "doc_id",
        F.col("page_no").alias("page"),
        "success",
        F.when(~F.col("success"), F.lit("page has no text")).alias("error"),
        F.col("n_paragraphs").alias("paragraph_count"),
        F.col("n_footnotes").alias("footnote_count"),
    )


def run_statistics(status: DataFrame) -> DataFrame:
    """Totals over a page status table.  Only pages that succeeded contribute."""
    ok = F.col("success")
    return status.agg(
        F.count("*").alias("total_pages_processed"),
        F.count_if(ok).alias("successful_pages"),
        F.count_if(~ok).alias("failed_pages"),
        F.coalesce(F.sum(F.when(ok, F.col("paragraph_count"))), F.lit(0)).alias(
            "total_paragraphs"
        ),
        F.coalesce(F.sum(F.when(ok, F.col("footnote_count"))), F.lit(0)).alias(
            "total_footnotes"
        ),
    )
