"""Conservative extraction: section labels, single-line footnotes and bracketed
paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.extract import (
    bracket_paragraphs,
    conservative_page_footnotes,
    section_marker,
)
from folioscope.operators.blocks import PAGES_PER_BLOCK, carry_last

# fixed value written into the result table
FOOTNOTE_METHOD = "conservative_single_line"


def page_sections(pages: DataFrame, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Section label of every page, carried forward from the last heading.

    Only keys and labels take part in the windows; page text stays in the scan.
    """
    marks = pages.select("doc_id", "page_no", section_marker(F.col("native_text")).alias("marker"))
    return carry_last(marks, "marker", pages_per_block).select(
        "doc_id",
        F.col("page_no").alias("page"),
        F.coalesce("marker", F.lit(fv.INITIAL_SECTION)).alias("section_type"),
    )


def conservative_footnotes(
    pages: DataFrame, min_confidence: float = fv.CONSERVATIVE_MIN_CONFIDENCE
) -> DataFrame:
    n = F.col("n")
    return pages.select(
        "doc_id",
        F.col("page_no").alias("page"),
        F.explode(conservative_page_footnotes(F.col("native_text"), min_confidence)).alias("n"),
    ).select(
        "doc_id",
        F.concat(F.lit("fn_conservative_"), F.col("page"), F.lit("_"), n["number"]).alias("id"),
        n["number"].alias("footnote_number"),
        n["content"].alias("content"),
        "page",
        n["confidence"].alias("confidence"),
        F.lit(FOOTNOTE_METHOD).alias("extraction_method"),
    )


def up_to_page(paragraphs: Column, max_pages: int | None) -> Column:
    """The page limit holds for paragraphs only; later pages still count for sections."""
    if max_pages is None:
        return paragraphs
    return F.when(F.col("page_no") <= max_pages, paragraphs)


def clean_paragraphs(
    pages: DataFrame, max_pages: int | None = None, pages_per_block: int = PAGES_PER_BLOCK
) -> DataFrame:
    """Bracketed paragraphs with the section of their page."""
    p = F.col("p")
    native = F.col("native_text")
    bracketed = pages.select(
        "doc_id",
        "page_no",
        section_marker(native).alias("marker"),
        up_to_page(bracket_paragraphs(native), max_pages).alias("paragraphs"),
    )
    sectioned = carry_last(bracketed, "marker", pages_per_block)
    return sectioned.select(
        "doc_id",
        F.col("page_no").alias("page"),
        F.coalesce("marker", F.lit(fv.INITIAL_SECTION)).alias("section_type"),
        F.posexplode("paragraphs").alias("ordinal", "p"),
    ).select(
        "doc_id",
        F.concat_ws("_", F.lit("para"), "section_type", "page", p["number"]).alias("id"),
        p["number"].alias("paragraph_number"),
        p["content"].alias("content"),
        "page",
        "ordinal",
        "section_type",
        p["token_count"].alias("token_count"),
        F.lit([]).cast("array<string>").alias("footnote_markers_removed"),
    )
