"""Search and retrieval for a table of queries: one job for the whole table.

``queries``: ``query_id, query, num_results`` and, for prompts, ``conversation_id``.
``encode`` adds the column ``embedding`` to a table with ``query_id, variant,
query_text``: a join with stored vectors, or a fitted text vectoriser.
``chunks``: ``chunk_id, embedding, content, summary, section_type, page_range``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.queries import enhance_query, expand_query
from folioscope.operators.prompt import prompt_rows
from folioscope.operators.search import (
    attach_chunks,
    best_hits,
    boost_by_query,
    boost_by_text,
    improvement_factor,
    merge_variants,
    result_count,
    similarity_topk,
    with_query_insights,
)

NO_HITS = "no chunk has a vector that can be compared"

Encoder = Callable[[DataFrame], DataFrame]


def query_variants(queries: DataFrame, limit: int = fv.MAX_QUERY_VARIANTS) -> DataFrame:
    """One row per query variant; variant 0 is the query itself."""
    return queries.select(
        "*", F.posexplode(expand_query(F.col("query"), limit)).alias("variant", "query_text")
    )


def _with_count(queries: DataFrame, default: int) -> DataFrame:
    given = F.col("num_results") if "num_results" in queries.columns else F.lit(None)
    return queries.withColumn("n", result_count(given, default))


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", "query", "n")


def enhanced_search(
    queries: DataFrame,
    chunks: DataFrame,
    encode: Encoder,
    default_results: int = fv.SEARCH_DEFAULT_RESULTS,
) -> DataFrame:
    """Search with the first query variants, keep the best similarity per chunk, boost
    by what query and chunk share, and cut to the number asked for.

    Each variant fetches twice the number of results; the cut comes before boosting
    and is part of the result.
    """
    counted = _with_count(queries, default_results)
    variants = query_variants(_asked(counted), fv.SEARCHED_VARIANTS)
    encoded = encode(variants).withColumn("k", F.col("n") * fv.OVERFETCH)
    merged = merge_variants(similarity_topk(encoded, chunks))
    asked = with_query_insights(_asked(counted))
    boosted = boost_by_query(attach_chunks(merged, chunks).join(asked, "query_id"))
    return best_hits(boosted).select(
        "query_id",
        "rank",
        "chunk_id",
        "content",
        "summary",
        "section_type",
        "page_range",
        "similarity_score",
        "section_weight",
        "relevance_score",
        improvement_factor().alias("improvement_factor"),
        F.lit("applied").alias("data_driven_boost"),
    )


def retrieve_contexts(
    queries: DataFrame,
    chunks: DataFrame,
    encode: Encoder,
    default_results: int = fv.RAG_DEFAULT_RESULTS,
) -> DataFrame:
    """One enhanced query each, twice the results fetched, boosted by the chunk text."""
    counted = _with_count(queries, default_results)
    enhanced = _asked(counted).select(
        "query_id",
        F.lit(0).alias("variant"),
        enhance_query(F.col("query")).alias("query_text"),
        "n",
    )
    encoded = encode(enhanced).withColumn("k", F.col("n") * fv.OVERFETCH)
    hits = similarity_topk(encoded, chunks)
    found = attach_chunks(hits.drop("variant", "rank"), chunks)
    boosted = boost_by_text(found.join(counted.select("query_id", "n"), "query_id"))
    return best_hits(boosted).select(
        "query_id",
        "rank",
        "chunk_id",
        "content",
        "summary",
        "section_type",
        "page_range",
        "similarity_score",
        "relevance_score",
    )


def rag_rows(
    queries: DataFrame,
    chunks: DataFrame,
    encode: Encoder,
    conversations: DataFrame | None = None,
    default_results: int = fv.RAG_DEFAULT_RESULTS,
    k: int = fv.MEMORY_EXCHANGES,
) -> DataFrame:
    """Prompt, number of contexts and sources for every query.

    A query that can't be answered, for want of a usable vector or of chunks, has an ``error``
    and leaves the others alone.

    ``num_results`` and ``conversation_id`` may be missing, as columns or as values.
    """
    if "conversation_id" not in queries.columns:
        queries = queries.withColumn("conversation_id", F.lit(None).cast("string"))
    hits = retrieve_contexts(queries, chunks, encode, default_results)
    nothing = F.when(F.col("num_contexts") == 0, F.lit(NO_HITS))
    return prompt_rows(queries, hits, conversations, k).withColumn("error", nothing)
