"""Chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.extract import bracket_texts, bracket_tokens, section_marker
from folioscope.functions.text import token_estimate
from folioscope.operators.blocks import PAGES_PER_BLOCK, carry_last, keyed, numbered_items
from folioscope.operators.conservative import up_to_page
from folioscope.operators.extraction import (
    FOOTNOTE_METHOD,
    PARAGRAPH_CONFIDENCE,
    PARAGRAPH_METHOD,
    PARAGRAPH_SECTION,
)
from folioscope.operators.packing import assign_chunks

# --- semantic chunks: one per paragraph or footnote --------------------------


def semantic_chunks(extracted: DataFrame, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """One chunk per paragraph and, on pages with paragraphs, per footnote.

    One number runs through a document: by page, paragraphs before footnotes.
    ``extracted`` is the result of ``extract_pages``, best read from a table.
    """
    # No filter on the counts: it would be pushed below the extraction and run it again.
    has_paragraphs = F.col("n_paragraphs") > 0
    method = F.lit(None).cast("string")
    paragraphs = F.transform(
        "paragraphs",
        lambda p: F.struct(
            F.lit("paragraph").alias("chunk_type"),
            p["content"].alias("content"),
            F.array(p["number"]).alias("paragraph_numbers"),
            p["footnote_references"].alias("footnote_numbers"),
            p["token_count"].alias("token_count"),
            F.struct(
                F.lit(PARAGRAPH_METHOD).alias("extraction_method"),
                method.alias("detection_method"),
                F.lit(PARAGRAPH_CONFIDENCE).alias("confidence"),
                F.lit(PARAGRAPH_SECTION).alias("section_type"),
            ).alias("metadata"),
        ),
    )
    footnotes = F.transform(
        "footnotes",
        lambda n: F.struct(
            F.lit("footnote").alias("chunk_type"),
            n["content"].alias("content"),
            F.lit([]).cast("array<string>").alias("paragraph_numbers"),
            F.array(n["number"]).alias("footnote_numbers"),
            token_estimate(n["content"]).alias("token_count"),
            F.struct(
                method.alias("extraction_method"),
                F.lit(FOOTNOTE_METHOD).alias("detection_method"),
                n["confidence"].alias("confidence"),
                method.alias("section_type"),
            ).alias("metadata"),
        ),
    )
    c = F.col("c")
    prefix = F.when(c["chunk_type"] == "paragraph", "para_").otherwise("footnote_")
    none = F.array().cast(extracted.select(F.concat(paragraphs, footnotes).alias("x")).schema["x"].dataType)
    found = extracted.select(
        "doc_id", "page_no", F.when(has_paragraphs, F.concat(paragraphs, footnotes)).otherwise(none).alias("chunks")
    )
    numbered = numbered_items(found, "chunks", "chunks_before", pages_per_block)
    return numbered.select(
        "doc_id", "page_no", "chunks_before", F.posexplode("chunks").alias("position", "c")
    ).select(
        "doc_id",
        F.concat(prefix, F.col("chunks_before") + F.col("position") + 1).alias("chunk_id"),
        c["content"].alias("content"),
        c["chunk_type"].alias("chunk_type"),
        F.struct(F.col("page_no").alias("start"), F.col("page_no").alias("end")).alias(
            "page_range"
        ),
        c["paragraph_numbers"].alias("paragraph_numbers"),
        c["footnote_numbers"].alias("footnote_numbers"),
        c["token_count"].alias("token_count"),
        c["metadata"].alias("metadata"),
    )


# --- main text chunks: paragraphs packed to a token budget -------------------


def _numbered(
    pages: DataFrame, budget: int, max_pages: int | None, pages_per_block: int
) -> DataFrame:
    """Section of every page, and chunk numbers and tokens of its paragraphs."""
    native = F.col("native_text")
    counts = keyed(pages).select(
        "doc_id",
        "page_no",
        section_marker(native).alias("marker"),
        up_to_page(bracket_tokens(native), max_pages).alias("tokens"),
    )
    sectioned = carry_last(counts, "marker", pages_per_block).select(
        "doc_id",
        "page_no",
        "page_block",
        F.coalesce("marker", F.lit(fv.INITIAL_SECTION)).alias("section_type"),
        "tokens",
    )
    return assign_chunks(sectioned, pages, budget, pages_per_block)


def chunk_index(
    pages: DataFrame,
    budget: int = fv.MAX_TOKENS_PER_CHUNK,
    max_pages: int | None = None,
    pages_per_block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """The main text chunks without their text: ``doc_id, section_type, chunk_number,
    token_count, paragraph_count, first_page, last_page``.

    Reports need no more; page texts stay in the scan.
    """
    z = F.col("z")
    members = _numbered(pages, budget, max_pages, pages_per_block).select(
        "doc_id", "page_no", "section_type", F.explode(F.arrays_zip("tokens", "chunk_numbers")).alias("z")
    )
    return members.groupBy("doc_id", "section_type", z["chunk_numbers"].alias("chunk_number")).agg(
        F.sum(z["tokens"]).alias("token_count"),
        F.count("*").alias("paragraph_count"),
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
    )


def main_text_chunks(
    pages: DataFrame,
    budget: int = fv.MAX_TOKENS_PER_CHUNK,
    max_pages: int | None = None,
    pages_per_block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """Bracketed paragraphs packed per section: ``doc_id, chunk_id, content,
    paragraphs, metadata, token_count``.

    Section labels and chunk numbers are worked out on page numbers and token
    counts, which come along with the numbers; the text is then joined by page and
    grouped by chunk, so it is shuffled twice whatever the shape of the documents.
    """
    full = keyed(pages)
    native = F.col("native_text")
    numbers = _numbered(pages, budget, max_pages, pages_per_block)
    text = full.select(
        "doc_id", "page_no", up_to_page(bracket_texts(native), max_pages).alias("paragraphs")
    )
    z = F.col("z")
    members = (
        text.join(numbers, ["doc_id", "page_no"])
        .select(
            "doc_id",
            "page_no",
            "section_type",
            F.posexplode(F.arrays_zip("paragraphs", "chunk_numbers", "tokens")).alias("ordinal", "z"),
        )
        .select(
            "doc_id",
            "section_type",
            z["chunk_numbers"].alias("chunk_number"),
            F.struct(
                F.col("page_no").alias("page"),
                "ordinal",
                F.concat_ws(
                    "_", F.lit("para"), "section_type", "page_no", z["paragraphs"]["number"]
                ).alias("id"),
                z["paragraphs"]["number"].alias("number"),
                z["paragraphs"]["content"].alias("content"),
                z["tokens"].alias("token_count"),
            ).alias("paragraph"),
        )
    )
    # a chunk holds at most `budget` tokens, or one paragraph
    grouped = members.groupBy("doc_id", "section_type", "chunk_number").agg(
        F.array_sort(F.collect_list("paragraph")).alias("paragraphs"),
        F.sum("paragraph.token_count").alias("token_count"),
        F.count("*").alias("paragraph_count"),
        F.min("paragraph.page").alias("first_page"),
        F.max("paragraph.page").alias("last_page"),
    )
    numbers_of = F.col("paragraphs")["number"]
    return grouped.select(
        "doc_id",
        F.format_string("main_chunk_%04d", "chunk_number").alias("chunk_id"),
        F.array_join(
            F.transform("paragraphs", lambda p: F.concat(F.lit("["), p["number"], F.lit("] "), p["content"])),
            "\n\n",
        ).alias("content"),
        "paragraphs",
        F.struct(
            *[F.lit(value).alias(name) for name, value in fv.CHUNK_DOCUMENT.items()],
            F.lit(fv.CHUNK_TYPE).alias("chunk_type"),
            F.col("section_type"),
            F.initcap(F.replace("section_type", F.lit("_"), F.lit(" "))).alias("section_title"),
            F.col("paragraph_count"),
            F.size(numbers_of).alias("numbered_paragraphs"),
            numbers_of.alias("paragraph_numbers"),
            F.concat(
                F.get(numbers_of, F.lit(0)), F.lit("-"), F.element_at(numbers_of, -1)
            ).alias("paragraph_range"),
            F.array_distinct(F.col("paragraphs")["page"]).alias("pages"),
            F.concat_ws("-", "first_page", "last_page").alias("page_range"),
            F.col("token_count").alias("estimated_tokens"),
            F.lit(fv.CHUNK_QUALITY).alias("extraction_quality"),
        ).alias("metadata"),
        "token_count",
    )


CHUNK_METADATA_COLUMNS = [
    "case_name",
    "case_number",
    "chamber",
    "date",
    "section_type",
    "section_title",
    "paragraph_count",
    "page_range",
    "extraction_quality",
]


def flatten_chunks(chunks: DataFrame) -> DataFrame:
    """The flat chunk table written by the pipeline."""
    return chunks.select(
        "doc_id",
        "chunk_id",
        "content",
        "token_count",
        *[F.col("metadata")[name].alias(name) for name in CHUNK_METADATA_COLUMNS],
    )


def with_document_info(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Replace the case columns of flat chunks by those of a document table
    (``doc_id, case_name, case_number, chamber, date``) where it has the document."""
    names = list(fv.CHUNK_DOCUMENT)
    renamed = documents.select("doc_id", *[F.col(n).alias(f"_{n}") for n in names])
    joined = chunks.join(renamed, "doc_id", "left")
    return joined.select(
        *[
            F.coalesce(f"_{c}", c).alias(c) if c in names else F.col(c)
            for c in chunks.columns
        ]
    )


def rag_projection(chunks: DataFrame) -> DataFrame:
    """``id, text`` and a metadata struct, the input of a vector index."""
    return chunks.select(
        "doc_id",
        F.col("chunk_id").alias("id"),
        F.col("content").alias("text"),
        F.struct("case_name", "case_number", "section_type", "page_range", "token_count").alias(
            "metadata"
        ),
    )


def chunks_containing(chunks: DataFrame, needle: str) -> DataFrame:
    return chunks.where(F.col("content").contains(needle))
