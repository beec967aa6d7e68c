"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Nested results are flattened or written as text, and doubles rounded to six digits,
so that a second engine can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions import queries as q
from folioscope.operators import analytics, chunks, conservative, extraction, lines, prompt, search
from folioscope.operators.summary import with_summary
from folioscope.operators.vectorize import fit_vectorizer, text_encoder, vectorize
from folioscope.plans import documents, retrieval
from folioscope.sources import pages as page_source
from folioscope.sources import tables
from folioscope.sources.tables import table_counts
from folioscope.streaming.changes import changed_since, save_snapshot, snapshot_diff
from workload.fixtures import (
    chunk_search,
    chunk_texts,
    legal_pages,
    scanned_pages,
    search_queries,
    snapshots,
    stored_encoder,
    table,
)

SKIP = 1
BUDGET = 200

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(array: str | Column) -> Column:
    return F.array_join(array, ",")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- pages and lines ----------------------------------------------------------


@query
def page_counts(spark, sf):
    return page_source.page_counts(legal_pages(spark, sf))


@query
def page_partitions(spark, sf):
    parts = page_source.with_page_partition(legal_pages(spark, sf), skip=SKIP, size=3)
    return parts.groupBy("page_partition").agg(
        F.count("*").alias("page_count"), F.min("page_no").alias("first_page")
    )


@query
def page_lines(spark, sf):
    return lines.page_lines(legal_pages(spark, sf))


@query
def header_footer_filter(spark, sf):
    return lines.header_free_lines(legal_pages(spark, sf))


@query
def exclusion_filter(spark, sf):
    return lines.footnote_candidate_lines(legal_pages(spark, sf))


# --- hybrid extraction --------------------------------------------------------


def extracted(spark, sf):
    return extraction.extract_pages(scanned_pages(spark, sf), skip=0)


@query
def hybrid_footnotes(spark, sf):
    return rounded(extraction.hybrid_footnotes(extracted(spark, sf)), "confidence").withColumn(
        "referenced_paragraphs", joined("referenced_paragraphs")
    )


@query
def hybrid_paragraphs(spark, sf):
    return extraction.hybrid_paragraphs(extracted(spark, sf)).withColumn(
        "footnote_references", joined("footnote_references")
    )


@query
def page_status(spark, sf):
    return extraction.page_status(extracted(spark, sf))


@query
def run_statistics(spark, sf):
    return extraction.run_statistics(extraction.page_status(extracted(spark, sf)))


def flat_chunks(numbered):
    meta = F.col("metadata")
    return rounded(
        numbered.select(
            "doc_id",
            "chunk_id",
            "content",
            "chunk_type",
            F.col("page_range")["start"].alias("page_start"),
            F.col("page_range")["end"].alias("page_end"),
            joined("paragraph_numbers").alias("paragraph_numbers"),
            joined("footnote_numbers").alias("footnote_numbers"),
            "token_count",
            meta["extraction_method"].alias("extraction_method"),
            meta["detection_method"].alias("detection_method"),
            meta["confidence"].alias("confidence"),
            meta["section_type"].alias("section_type"),
        ),
        "confidence",
    )


@query
def semantic_chunks(spark, sf):
    return flat_chunks(chunks.semantic_chunks(extracted(spark, sf)))


# --- saved tables and exports -------------------------------------------------


def export_folder(spark):
    """A new folder beside the managed tables, which all executors see."""
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/exports/{uuid.uuid4()}"


@query
def saved_pages(spark, sf):
    """Pages saved over an earlier table of the name, and read as pages again."""
    pages = legal_pages(spark, sf)
    tables.save_table(pages.select("doc_id"), "workload_pages")
    tables.save_table(pages, "workload_pages", bucket_by=["doc_id", "page_no"], buckets=8)
    return page_source.pages_table(spark, "workload_pages").select("doc_id", "page_no", "native_text")


@query
def saved_extraction(spark, sf):
    """Both tables of an extraction, read back."""
    found = extracted(spark, sf)
    tables.save_extraction(extraction.hybrid_paragraphs(found), extraction.hybrid_footnotes(found), "workload")
    paragraphs = spark.table("workload_paragraphs").select(
        "doc_id", "page", F.lit("paragraph").alias("kind"), F.col("paragraph_number").alias("number"), "content"
    )
    return paragraphs.unionByName(
        spark.table("workload_footnotes").select(
            "doc_id", "page", F.lit("footnote").alias("kind"), F.col("footnote_number").alias("number"), "content"
        )
    )


@query
def replaced_table(spark, sf):
    """A chunk table replaced by what is read from it: with a new column, without another and
    without some rows."""
    tables.save_table(packed(spark, sf), "workload_chunks")
    tables.add_column(spark, "workload_chunks", "content_chars", F.char_length("content"))
    kept = spark.table("workload_chunks").where("section_type <> 'HEADER'").drop("content")
    tables.replace_table(kept, "workload_chunks")
    return spark.table("workload_chunks").select("doc_id", "chunk_id", "section_type", "token_count", "content_chars")


def exported(spark, sf, fmt):
    """Chunks with nested columns, written and read back; no row may be broken."""
    numbered = chunks.semantic_chunks(extracted(spark, sf))
    folder = export_folder(spark)
    tables.export(numbered, folder, fmt)
    good, broken = tables.read_export(spark, folder, fmt, numbered.schema)
    return flat_chunks(good.unionByName(broken.drop("_corrupt_record")))


@query
def exported_json(spark, sf):
    return exported(spark, sf, "json")


@query
def exported_csv(spark, sf):
    return exported(spark, sf, "csv")


@query
def exported_parquet(spark, sf):
    return exported(spark, sf, "parquet")


@query
def exported_extraction(spark, sf):
    """Paragraphs and footnotes of the JSON export of an extraction, read back."""
    found, folder = extracted(spark, sf), export_folder(spark)
    paragraphs, footnotes = extraction.hybrid_paragraphs(found), extraction.hybrid_footnotes(found)
    tables.export_json(paragraphs, footnotes, chunks.semantic_chunks(found), folder)
    p, _ = tables.read_export(spark, f"{folder}/hybrid_paragraphs", "json", paragraphs.schema)
    n, _ = tables.read_export(spark, f"{folder}/hybrid_footnotes", "json", footnotes.schema)
    return p.select(
        "doc_id", "page", F.lit("paragraph").alias("kind"), F.col("paragraph_number").alias("number"),
        joined("footnote_references").alias("mentioned"),
    ).unionByName(
        n.select(
            "doc_id", "page", F.lit("footnote").alias("kind"), F.col("footnote_number").alias("number"),
            joined("referenced_paragraphs").alias("mentioned"),
        )
    )


# --- conservative extraction and chunks ---------------------------------------


@query
def sections(spark, sf):
    return conservative.page_sections(legal_pages(spark, sf))


@query
def conservative_footnotes(spark, sf):
    return rounded(conservative.conservative_footnotes(legal_pages(spark, sf)), "confidence")


@query
def bracket_paragraphs(spark, sf):
    return conservative.clean_paragraphs(legal_pages(spark, sf)).withColumn(
        "footnote_markers_removed", joined("footnote_markers_removed")
    )


def packed(spark, sf, budget=BUDGET):
    return chunks.flatten_chunks(chunks.main_text_chunks(legal_pages(spark, sf), budget))


@query
def packed_chunks(spark, sf):
    return packed(spark, sf)


@query
def packed_chunks_default_budget(spark, sf):
    return packed(spark, sf, fv.MAX_TOKENS_PER_CHUNK)


def case_table(spark, sf):
    """Cases of the documents whose language isn't English, named by source and language."""
    return table(spark, sf, "documents").where("lang <> 'en'").select(
        "doc_id",
        F.concat(F.lit("Case of "), "source").alias("case_name"),
        F.concat_ws("/", "source", "lang").alias("case_number"),
        F.concat(F.lit("Chamber "), "lang").alias("chamber"),
        F.lit("1 January 2020").alias("date"),
    )


@query
def packed_chunks_of_cases(spark, sf):
    return chunks.with_document_info(packed(spark, sf), case_table(spark, sf))


@query
def chunk_metadata(spark, sf):
    meta = F.col("metadata")
    return chunks.main_text_chunks(legal_pages(spark, sf), BUDGET).select(
        "doc_id",
        "chunk_id",
        meta["numbered_paragraphs"].alias("numbered_paragraphs"),
        joined(meta["paragraph_numbers"]).alias("paragraph_numbers"),
        meta["paragraph_range"].alias("paragraph_range"),
        joined(F.transform(meta["pages"], lambda p: p.cast("string"))).alias("pages"),
        meta["estimated_tokens"].alias("estimated_tokens"),
        joined(F.col("paragraphs")["id"]).alias("paragraph_ids"),
    )


@query
def conservative_statistics(spark, sf):
    result = documents.process_conservative(legal_pages(spark, sf), BUDGET)
    return rounded(result["statistics"], "avg_confidence")


@query
def rag_projection(spark, sf):
    meta = F.col("metadata")
    return chunks.rag_projection(packed(spark, sf)).select(
        "doc_id", "id", "text",
        meta["case_name"].alias("case_name"),
        meta["case_number"].alias("case_number"),
        meta["section_type"].alias("section_type"),
        meta["page_range"].alias("page_range"),
        meta["token_count"].alias("token_count"),
    )


@query
def chunk_contains(spark, sf):
    return chunks.chunks_containing(chunks.semantic_chunks(extracted(spark, sf)), "Chamber").select(
        "doc_id", "chunk_id", "chunk_type"
    )


@query
def extractive_summary(spark, sf):
    return with_summary(packed(spark, sf), 60).select("doc_id", "chunk_id", "summary")


@query
def extractive_summary_long(spark, sf):
    """With the word limit of the model call that it stands in for."""
    return with_summary(packed(spark, sf)).select("doc_id", "chunk_id", "summary")


# --- reports ------------------------------------------------------------------


def indexed(spark, sf):
    return chunks.chunk_index(legal_pages(spark, sf), BUDGET)


@query
def section_coverage(spark, sf):
    return rounded(analytics.section_coverage(indexed(spark, sf)), "avg_tokens")


@query
def section_distribution(spark, sf):
    return analytics.section_distribution(indexed(spark, sf))


@query
def token_stats(spark, sf):
    return rounded(analytics.token_stats(indexed(spark, sf)), "avg_tokens")


@query
def token_histogram(spark, sf):
    return analytics.token_histogram(indexed(spark, sf))


@query
def distinct_paragraph_numbers(spark, sf):
    return analytics.distinct_numbers(
        extraction.hybrid_paragraphs(extracted(spark, sf)), "paragraph_number"
    )


@query
def distinct_footnote_numbers(spark, sf):
    return analytics.distinct_numbers(
        extraction.hybrid_footnotes(extracted(spark, sf)), "footnote_number"
    )


@query
def paragraphs_per_page(spark, sf):
    return analytics.paragraphs_per_page(extraction.hybrid_paragraphs(extracted(spark, sf)))


@query
def number_range(spark, sf):
    return analytics.number_range(
        extraction.hybrid_paragraphs(extracted(spark, sf)), "paragraph_number"
    )


@query
def footnote_number_range(spark, sf):
    return analytics.number_range(
        extraction.hybrid_footnotes(extracted(spark, sf)), "footnote_number"
    )


@query
def output_table_counts(spark, sf):
    pages = extracted(spark, sf)
    return table_counts(
        {
            "paragraphs": extraction.hybrid_paragraphs(pages),
            "footnotes": extraction.hybrid_footnotes(pages),
        }
    )


@query
def sample_rows(spark, sf):
    return analytics.sample_rows(
        extraction.hybrid_paragraphs(extracted(spark, sf)),
        ["doc_id", "paragraph_number", "page", "content"],
        ["doc_id", "page", "start_line"],
        5,
    )


@query
def corpus_profile(spark, sf):
    return rounded(
        analytics.corpus_profile(chunk_texts(spark, sf)),
        "legal_concept_density",
        "length_ratio",
        "chunk_share",
    )


@query
def quality_report(spark, sf):
    pages = legal_pages(spark, sf)
    return analytics.quality_report(
        chunks.flatten_chunks(chunks.main_text_chunks(pages, BUDGET)),
        conservative.clean_paragraphs(pages),
    )


# --- query side ---------------------------------------------------------------


@query
def query_expansion(spark, sf):
    return retrieval.query_variants(search_queries(spark, sf)).select(
        "query_id", "variant", "query_text"
    )


@query
def legal_expansion_lookup(spark, sf):
    """Every word of the queries with the expansions it has as a term."""
    words = search_queries(spark, sf).select(
        "query_id", F.explode(F.array_distinct(F.split("query", r"\s+"))).alias("term")
    )
    return words.select("query_id", "term", joined(q.legal_expansions(F.col("term"))).alias("expansions"))


@query
def section_weights(spark, sf):
    return chunk_texts(spark, sf).select(
        "chunk_id", "section_type", q.section_weight(F.col("section_type")).alias("section_weight")
    )


@query
def query_focus(spark, sf):
    return rounded(
        search_queries(spark, sf)
        .withColumn("f", q.query_focus(F.col("query")))
        .select("query_id", "f.*"),
        "person", "legal_concept", "evidence", "sentence",
    )


@query
def query_entities(spark, sf):
    found = search_queries(spark, sf).withColumn("e", q.query_entities(F.col("query")))
    names = ["persons", "legal_concepts", "locations", "actions"]
    return found.select("query_id", *[joined(F.col("e")[n]).alias(n) for n in names])


@query
def query_enhance(spark, sf):
    return search_queries(spark, sf).select(
        "query_id", q.enhance_query(F.col("query")).alias("enhanced")
    )


# --- search -------------------------------------------------------------------


def variant_hits(spark, sf):
    variants = retrieval.query_variants(search_queries(spark, sf).select("query_id", "query"), 3)
    encoded = stored_encoder(spark, sf)(variants).withColumn("k", F.lit(10))
    return search.similarity_topk(encoded, chunk_search(spark, sf))


@query
def similarity_topk(spark, sf):
    return rounded(variant_hits(spark, sf), "similarity_score")


@query
def variant_merge(spark, sf):
    return rounded(search.merge_variants(variant_hits(spark, sf)), "similarity_score")


@query
def boosted_search(spark, sf):
    results = retrieval.enhanced_search(
        search_queries(spark, sf), chunk_search(spark, sf), stored_encoder(spark, sf)
    )
    return rounded(results, "similarity_score", "relevance_score", "improvement_factor")


@query
def search_metrics(spark, sf):
    results = retrieval.enhanced_search(
        search_queries(spark, sf), chunk_search(spark, sf), stored_encoder(spark, sf)
    )
    return rounded(
        analytics.search_metrics(results), "avg_similarity", "avg_relevance", "improvement_pct"
    )


@query
def text_similarity(spark, sf):
    base = chunk_texts(spark, sf)
    model = fit_vectorizer(base)
    queries = (
        table(spark, sf, "benchmark")
        .select(F.col("item_id").alias("query_id"), F.lit(0).alias("variant"), "text")
        .withColumn("k", F.lit(5))
    )
    hits = search.similarity_topk(vectorize(queries, model, "text"), vectorize(base, model, "content"))
    return rounded(hits, "similarity_score")


def by_text(spark, sf):
    """All chunks with vectors of their texts, and the encoder of query texts."""
    base = chunk_texts(spark, sf)
    model = fit_vectorizer(base)
    return vectorize(base, model, "content"), text_encoder(model)


@query
def text_search(spark, sf):
    """The rewritten query texts decide what is found."""
    results = retrieval.enhanced_search(search_queries(spark, sf), *by_text(spark, sf))
    return rounded(results, "similarity_score", "relevance_score", "improvement_factor").drop("content")


@query
def text_rag(spark, sf):
    found = retrieval.retrieve_contexts(search_queries(spark, sf), *by_text(spark, sf))
    return rounded(found, "similarity_score", "relevance_score").drop("content")


def contexts(spark, sf):
    return retrieval.retrieve_contexts(
        search_queries(spark, sf), chunk_search(spark, sf), stored_encoder(spark, sf)
    )


@query
def rag_retrieval(spark, sf):
    return rounded(contexts(spark, sf), "similarity_score", "relevance_score")


# --- prompts ------------------------------------------------------------------


def source_text(sources: Column) -> Column:
    return F.array_join(
        F.transform(
            sources,
            lambda s: F.concat_ws(
                "|", s["chunk_id"], s["section"], s["pages"], F.format_string("%.3f", s["relevance"])
            ),
        ),
        ";",
    )


def history_text(history: Column) -> Column:
    return F.array_join(
        F.transform(history, lambda m: F.concat(m["role"], F.lit(": "), m["text"])), "\n"
    )


@query
def context_blocks(spark, sf):
    blocks = prompt.context_blocks(contexts(spark, sf))
    return blocks.withColumn("sources", source_text(F.col("sources")))


@query
def history_window(spark, sf):
    windows = prompt.history_window(table(spark, sf, "conversations"), k=2)
    return windows.select("conv_id", "turn", "question", history_text(F.col("history")).alias("history"))


@query
def full_history(spark, sf):
    """Every message with its place in the whole history of its conversation."""
    return prompt.message_rows(table(spark, sf, "conversations")).drop("turn_block")


@query
def history_extents(spark, sf):
    return prompt.history_extents(table(spark, sf, "conversations"))


@query
def prompt_messages(spark, sf):
    """The prompts with the whole history, one chat message a row."""
    return prompt.prompt_messages(search_queries(spark, sf), contexts(spark, sf), table(spark, sf, "conversations"))


def rag_result(spark, sf):
    return retrieval.rag_rows(
        search_queries(spark, sf),
        chunk_search(spark, sf),
        stored_encoder(spark, sf),
        table(spark, sf, "conversations"),
    )


@query
def prompt_rows(spark, sf):
    p = F.col("prompt")
    return rag_result(spark, sf).select(
        "query_id",
        p["system"].alias("system"),
        history_text(p["history"]).alias("history"),
        p["human"].alias("human"),
    )


@query
def rag_results(spark, sf):
    return rag_result(spark, sf).select(
        "query_id",
        "conversation_id",
        "num_contexts",
        source_text(F.col("sources")).alias("sources"),
    )


def flawed_encoder(spark, sf):
    """The stored vectors, but for query 3 cut short and for query 4 all zero."""
    encode = stored_encoder(spark, sf)

    def flawed(variants):
        vector, query = F.col("embedding"), F.col("query_id")
        zero = F.transform(vector, lambda x: x * 0)
        return encode(variants).withColumn(
            "embedding", F.when(query == 3, F.slice(vector, 1, 5)).when(query == 4, zero).otherwise(vector)
        )

    return flawed


@query
def rag_results_with_errors(spark, sf):
    rows = retrieval.rag_rows(search_queries(spark, sf), chunk_search(spark, sf), flawed_encoder(spark, sf))
    return rows.select("query_id", "num_contexts", source_text(F.col("sources")).alias("sources"), "error")


@query
def search_metrics_with_errors(spark, sf):
    results = retrieval.enhanced_search(search_queries(spark, sf), chunk_search(spark, sf), flawed_encoder(spark, sf))
    return rounded(
        analytics.search_metrics(results), "avg_similarity", "avg_relevance", "improvement_pct"
    )


# --- changes ------------------------------------------------------------------


@query
def change_feed(spark, sf):
    return snapshot_diff(*snapshots(spark, sf))


@query
def change_feed_new_column(spark, sf):
    """The same after the newer version got a column."""
    old, new = snapshots(spark, sf)
    return snapshot_diff(old, new.withColumn("summary", F.concat(F.lit("Section "), "section_type")))


@query
def change_feed_of_snapshots(spark, sf):
    """The changes between two saved snapshots, by their digests."""
    folder = export_folder(spark)
    for name, version in zip(("old", "new"), snapshots(spark, sf)):
        save_snapshot(version, f"{folder}/{name}", buckets=16)
    return changed_since(spark, f"{folder}/old", f"{folder}/new")
