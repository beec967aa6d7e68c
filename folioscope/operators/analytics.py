"""Reports over paragraph, footnote and chunk tables.

All are aggregates with map-side partial results, so a dominant section, page or
document costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.text import any_contained


def distinct_numbers(table: DataFrame, column: str, limit: int = 20) -> DataFrame:
    """The first ``limit`` distinct numbers in text order."""
    return table.select(column).distinct().orderBy(column).limit(limit)


def paragraphs_per_page(paragraphs: DataFrame) -> DataFrame:
    return (
        paragraphs.groupBy("page").agg(F.count("*").alias("paragraph_count")).orderBy("page")
    )


def number_range(table: DataFrame, column: str) -> DataFrame:
    """Smallest and largest number; values that are not numbers are left out."""
    number = F.expr(f"try_cast({column} AS BIGINT)")
    return table.where(F.col(column).rlike(r"^\d+$")).agg(
        F.min(number).alias("min_number"), F.max(number).alias("max_number")
    )


def section_distribution(chunks: DataFrame) -> DataFrame:
    return (
        chunks.groupBy("section_type")
        .agg(F.count("*").alias("chunk_count"))
        .orderBy(F.desc("chunk_count"), "section_type")
    )


def section_coverage(chunks: DataFrame) -> DataFrame:
    return (
        chunks.groupBy("section_type")
        .agg(
            F.count("*").alias("chunk_count"),
            F.avg("token_count").alias("avg_tokens"),
            F.sum("token_count").alias("total_tokens"),
        )
        .orderBy(F.desc("chunk_count"), "section_type")
    )


def token_stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(
        F.avg("token_count").alias("avg_tokens"),
        F.min("token_count").alias("min_tokens"),
        F.max("token_count").alias("max_tokens"),
    )


def token_histogram(chunks: DataFrame) -> DataFrame:
    tokens = F.col("token_count")

    def band(low, high):
        if low is None:
            return tokens <= high
        return tokens >= low if high is None else tokens.between(low, high)

    return chunks.agg(*[F.count_if(band(lo, hi)).alias(name) for name, lo, hi in fv.TOKEN_BANDS])


def conservative_statistics(chunks: DataFrame, footnotes: DataFrame) -> DataFrame:
    """Number of chunks, paragraphs and footnotes, and mean footnote confidence
    (0 without footnotes), in one row.

    ``chunks`` is the chunk index or the flat chunk table; each paragraph is in one chunk, so its counts
    give the number of paragraphs without extracting them again.
    """
    one = F.lit(1).alias("_row")
    chunk_row = chunks.agg(
        F.count("*").alias("main_text_chunks"),
        F.coalesce(F.sum("paragraph_count"), F.lit(0)).alias("clean_paragraphs"),
    )
    footnote_row = footnotes.agg(
        F.count("*").alias("conservative_footnotes"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"),
    )
    # one row each, tagged with the same constant
    return chunk_row.select(one, "*").join(footnote_row.select(one, "*"), "_row").drop("_row")


def sample_rows(table: DataFrame, columns: list[str], order: list[str], limit: int = 10) -> DataFrame:
    return table.select(*columns).orderBy(*order).limit(limit)


def corpus_profile(chunks: DataFrame) -> DataFrame:
    """Per section: chunks, share of all chunks, share of chunks naming a legal
    concept, chunks naming each person, and mean length over mean summary length.

    ``chunks`` has ``section_type, content, summary``.
    """
    content = F.col("content")
    lowered = F.lower(content)
    legal = any_contained(lowered, [c.lower() for c in fv.CONCEPTS])
    per_section = chunks.groupBy("section_type").agg(
        F.count("*").alias("chunk_count"),
        F.avg(legal.cast("int")).alias("legal_concept_density"),
        *[
            F.count_if(content.contains(person)).alias(f"person_{i}_chunks")
            for i, person in enumerate(fv.PERSONS)
        ],
        F.try_divide(F.avg(F.length("content")), F.avg(F.length("summary"))).alias("length_ratio"),
    )
    # at most a row per section is left here
    total = per_section.agg(F.sum("chunk_count").alias("_total")).select(F.lit(1).alias("_row"), "*")
    return (
        per_section.withColumn("_row", F.lit(1))
        .join(F.broadcast(total), "_row")
        .withColumn("chunk_share", F.col("chunk_count") / F.col("_total"))
        .drop("_row", "_total")
    )


def quality_report(
    chunks: DataFrame,
    paragraphs: DataFrame,
    min_length: int = fv.MIN_CHUNK_LENGTH,
    max_empty_ratio: float = fv.MAX_EMPTY_CHUNKS_RATIO,
) -> DataFrame:
    """Chunk and numbering checks per document.

    Corrupt characters are U+FFFD and control characters other than tab and line
    ends.  A gap is a paragraph number missing between the smallest and the largest
    one of the document.
    """
    content = F.col("content")
    empty = F.length(F.btrim(content)) == 0
    corrupt = F.regexp_count(content, F.lit("[�\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"))
    per_chunk = chunks.groupBy("doc_id").agg(
        F.count("*").alias("chunk_count"),
        F.count_if(F.length(content) < min_length).alias("short_chunks"),
        F.count_if(empty).alias("empty_chunks"),
        F.sum(corrupt).alias("corrupt_chars"),
    )
    number = F.expr("try_cast(paragraph_number AS BIGINT)")
    # distinct first: a document's numbers are reduced before they meet in one task
    numbers = paragraphs.select("doc_id", number.alias("n")).where("n IS NOT NULL").distinct()
    gaps = numbers.groupBy("doc_id").agg(
        (F.max("n") - F.min("n") + 1 - F.count("*")).alias("missing_numbers")
    )
    return per_chunk.join(gaps, "doc_id", "left").select(
        "doc_id",
        "chunk_count",
        "short_chunks",
        "empty_chunks",
        "corrupt_chars",
        (F.col("corrupt_chars") > 0).alias("corrupted"),
        F.coalesce("missing_numbers", F.lit(0)).alias("missing_numbers"),
        (F.col("empty_chunks") / F.col("chunk_count") <= max_empty_ratio).alias("empty_ratio_ok"),
    )


def search_metrics(results: DataFrame) -> DataFrame:
    """Per query: hits, mean similarity and relevance, improvement in percent."""
    similarity, relevance = F.avg("similarity_score"), F.avg("relevance_score")
    return results.groupBy("query_id").agg(
        F.count("*").alias("result_count"),
        similarity.alias("avg_similarity"),
        relevance.alias("avg_relevance"),
        # null if nothing is similar at all
        ((F.try_divide(relevance, similarity) - 1) * 100).alias("improvement_pct"),
    )
