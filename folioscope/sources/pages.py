"""Page tables: one row per page, decoded by the caller.

``doc_id, page_no (from 1), native_text, ocr_text``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import fixed_values as fv

PAGE_COLUMNS = ["doc_id", "page_no", "native_text", "ocr_text"]


def as_pages(df: DataFrame, native: str = "native_text", ocr: str | None = None) -> DataFrame:
    """Bring a table with a text column into the page layout.

    Without a recognised-text column the native text stands for both.
    """
    return df.select(
        "doc_id",
        F.col("page_no").cast("int").alias("page_no"),
        F.col(native).alias("native_text"),
        F.col(ocr or native).alias("ocr_text"),
    )


def read_pages(spark: SparkSession, path: str, **columns) -> DataFrame:
    return as_pages(spark.read.parquet(path), **columns)


def pages_table(spark: SparkSession, name: str, **columns) -> DataFrame:
    return as_pages(spark.table(name), **columns)


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.count("*").alias("page_count"))


def page_slice(
    pages: DataFrame, skip: int = fv.SKIP_FIRST_PAGES, max_pages: int | None = None
) -> DataFrame:
    """Pages after the first ``skip`` ones, up to page ``max_pages``.

    Plain comparisons on ``page_no``: they reach the Parquet scan.
    """
    kept = pages.where(F.col("page_no") > skip)
    return kept if max_pages is None else kept.where(F.col("page_no") <= max_pages)


def with_page_partition(
    pages: DataFrame,
    skip: int = fv.SKIP_FIRST_PAGES,
    size: int = fv.PAGES_PER_PARTITION,
) -> DataFrame:
    """Adds ``page_partition``: the number of the run of ``size`` pages."""
    number = F.floor((F.col("page_no") - 1 - skip) / F.lit(size)).cast("int")
    return page_slice(pages, skip).withColumn("page_partition", number)


def distribute_pages(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread pages by document and page range, so that one long document is
    cut into many tasks.  Only for inputs whose files are few and large; a Parquet
    scan already splits."""
    keys = ["doc_id", "page_no"]
    if partitions is None:
        return pages.repartitionByRange(*keys)
    return pages.repartitionByRange(partitions, *keys)
