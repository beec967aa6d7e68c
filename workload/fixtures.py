"""Inputs derived from the given tables.

The raw documents carry no headings, footnotes or numbered paragraphs, so every line
gets a marker from its position and document number; ten lines make a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import bind
from folioscope.sources.pages import as_pages

LINES_PER_PAGE = 10

HEADINGS = [
    "I. OVERVIEW",
    "II. FINDINGS OF FACT",
    "III. EVIDENTIARY CONSIDERATIONS",
    "IV. APPLICABLE LAW",
    "V. LEGAL CHARACTERISATION",
    "VI. SENTENCE",
    "VII. VERDICT",
]

SAMPLE_QUERIES = [
    "which orders did Yekatom give before the attack near Bangui",
    "evidence for persecution as one of the war crimes and its sentence",
    "what Ngaïssona knew of the Anti-Balaka and the civilians who were killed",
    "how a witness describes the part of Yekatom in the persecution of Muslim families",
    "verdict on Ngaïssona: guilty of which crimes",
]

SEARCH_SECTIONS = [
    "EVIDENTIARY_CONSIDERATIONS",
    "SENTENCE",
    "VERDICT",
    "FINDINGS_OF_FACT",
    "OVERVIEW",
    "HEADER",
    "APPLICABLE_LAW",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def _marked(doc_id: Column, i: Column, line: Column) -> Column:
    tens, fives = F.floor(i / 10), F.floor(i / 5)
    heading = F.when(
        i % 24 == F.when(doc_id % 4 == 0, 12).otherwise(0),
        F.concat(pick(HEADINGS, doc_id + F.floor(i / 24)), F.lit("\n")),
    ).otherwise("")
    citation = (
        F.when(fives % 4 == 0, F.concat(F.lit(" See ICC-01/14-01/18, Trial Chamber judgment, para. "), i, F.lit(". ")))
        .when(fives % 4 == 1, F.concat(F.lit(" See Katanga v. Ngudjolo, ICC-01/04, decision, para. "), i, F.lit(". ")))
        .when(fives % 4 == 2, F.concat(F.lit(" Cf. Article "), i, F.lit(" of the statute, para. "), i, F.lit(". ")))
        .otherwise(F.concat(F.lit(" P-0"), i, F.lit(": T-0"), i, F.lit(", 12 March 2014, CAR-OTP, p. "), i, F.lit(". ")))
    )
    kind = (doc_id * 7 + i * 3) % 5
    body = (
        F.when(kind == 0, F.concat(F.lit("["), i + 1, F.lit("] "), line))
        .when(kind == 1, F.concat(1 + F.when(doc_id % 2 == 0, tens).otherwise(fives), citation, line))
        .when(
            kind == 2,
            F.concat(
                F.when(doc_id % 3 == 0, tens).otherwise(i) + 1,
                F.lit(". "),
                F.when(i % 2 == 0, "The Chamber notes ").otherwise(""),
                line,
            ),
        )
        .when(kind == 3, line)
        .otherwise(F.concat(F.lit("ICC-01/14-01/18-2784-Red 24-07-2025 "), tens + 1, F.lit("/1616 T")))
    )
    return F.concat(heading, body)


def legal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as marked pages.  A page is a slice of its document's lines, so
    the pages come out of the scan without a shuffle."""

    def pages(lines: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / LINES_PER_PAGE).cast("int")),
            lambda page: F.array_join(
                F.transform(
                    F.slice(lines, page * LINES_PER_PAGE + 1, F.lit(LINES_PER_PAGE)),
                    lambda line, j: _marked(
                        F.col("doc_id"), (page * LINES_PER_PAGE + j).cast("bigint"), line
                    ),
                ),
                "\n",
            ),
        )

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = documents.select(
        "doc_id",
        F.posexplode(bind(F.split("text", "\n"), pages)).alias("page_index", "native_text"),
    )
    return as_pages(cut.withColumn("page_no", F.col("page_index") + 1))


def scanned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``legal_pages`` of which some lack a native text and only have a recognised one."""
    missing = (F.col("doc_id") * 3 + F.col("page_no")) % 40 == 0
    return legal_pages(spark, sf_dir).withColumn("native_text", F.when(~missing, F.col("native_text")))


def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as chunks."""
    i = F.col("doc_id")

    def every(n: int, words: str) -> Column:
        return F.when(i % n == 0, words).otherwise("")

    return table(spark, sf_dir, "documents").select(
        i.alias("chunk_id"),
        F.concat(
            every(3, "Yekatom "),
            every(4, "Ngaïssona "),
            every(5, "war crime "),
            every(7, "persecution Muslim "),
            F.col("text"),
        ).alias("content"),
        F.when(
            i % 10 != 0,
            F.concat(F.lit("Text in "), "lang", F.lit(" from "), "source", every(6, " about Alkanto, a Christian")),
        ).alias("summary"),
        pick(SEARCH_SECTIONS, i).alias("section_type"),
        F.concat(i, F.lit("-"), i + 1).alias("page_range"),
    )


def chunk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that have a stored vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    return chunk_texts(spark, sf_dir).join(vectors, "chunk_id")


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample queries extended by the benchmark texts."""
    i = F.col("item_id")
    return table(spark, sf_dir, "benchmark").select(
        i.alias("query_id"),
        F.concat(pick(SAMPLE_QUERIES, i), F.lit(" "), "text").alias("query"),
        F.when(i % 5 != 0, 5 + i % 4).alias("num_results"),
        F.when(i % 3 != 0, i).alias("conversation_id"),
    )


def stored_encoder(spark: SparkSession, sf_dir: str):
    """Gives variant v of query q the stored vector (7 q + 11 v) mod the number of vectors."""

    def encode(variants: DataFrame) -> DataFrame:
        vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
        total = vectors.agg(F.count("*").alias("_total"))  # one row
        wanted = (F.col("query_id") * 7 + F.col("variant") * 11) % F.col("_total")
        counted = variants.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
        return counted.withColumn("vec_id", wanted).join(vectors, "vec_id").drop("vec_id", "_total", "_one")

    return encode


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a chunk table: the labelled documents, then the documents with a
    vector, each with the section its label gives."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))

    def version(labels: DataFrame, accepted: Column) -> DataFrame:
        return labels.join(documents, "doc_id").select(
            F.col("doc_id").alias("chunk_id"),
            "content",
            F.when(accepted, "VERDICT").otherwise("HEADER").alias("section_type"),
        )

    old = version(table(spark, sf_dir, "labels"), F.col("quality") == 1)
    new = version(
        table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id"),
        F.col("label") >= 5,
    )
    return old, new
