"""From pages to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from folioscope import fixed_values as fv
from folioscope.operators.analytics import conservative_statistics
from folioscope.operators.chunks import (
    chunk_index,
    flatten_chunks,
    main_text_chunks,
    semantic_chunks,
    with_document_info,
)
from folioscope.operators.conservative import clean_paragraphs, conservative_footnotes
from folioscope.operators.extraction import (
    extract_pages,
    hybrid_footnotes,
    hybrid_paragraphs,
    page_status,
    run_statistics,
)
from folioscope.sources.tables import save_extraction, save_table


def process_conservative(
    pages: DataFrame,
    budget: int = fv.MAX_TOKENS_PER_CHUNK,
    max_pages: int | None = None,
    table_name: str | None = None,
    documents: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Chunks, footnotes, paragraphs and statistics of the conservative path.

    With ``table_name`` the flat chunk table is written first. ``documents`` (``doc_id,
    case_name, case_number, chamber, date``) describes the cases in it; documents that it
    doesn't have keep the fixed one.
    """
    chunks = main_text_chunks(pages, budget, max_pages)
    if table_name is None:
        counted = chunk_index(pages, budget, max_pages)
    else:
        flat = flatten_chunks(chunks)
        if documents is not None:
            flat = with_document_info(flat, documents)
        save_table(flat, table_name)
        counted = pages.sparkSession.table(table_name)
    footnotes = conservative_footnotes(pages)
    return {
        "chunks": chunks,
        "footnotes": footnotes,
        "paragraphs": clean_paragraphs(pages, max_pages),
        "statistics": conservative_statistics(counted, footnotes),
    }


def process_hybrid(
    pages: DataFrame,
    skip: int = fv.SKIP_FIRST_PAGES,
    max_pages: int | None = None,
    table_prefix: str | None = None,
) -> dict[str, DataFrame]:
    """Paragraphs, footnotes, chunks, page status and statistics of the hybrid path.

    With ``table_prefix`` the extracted pages are written once, as
    ``<prefix>_pages``, and the tables and reports are read from there.
    """
    extracted = extract_pages(pages, skip, max_pages)
    if table_prefix is not None:
        save_table(extracted, f"{table_prefix}_pages")
        extracted = pages.sparkSession.table(f"{table_prefix}_pages")
    paragraphs, footnotes = hybrid_paragraphs(extracted), hybrid_footnotes(extracted)
    if table_prefix is not None:
        save_extraction(paragraphs, footnotes, table_prefix)
    status = page_status(extracted)
    return {
        "paragraphs": paragraphs,
        "footnotes": footnotes,
        "chunks": semantic_chunks(extracted),
        "status": status,
        "statistics": run_statistics(status),
    }
