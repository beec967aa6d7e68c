"""Running values along the pages of a document, without one task per document.

A document may hold a large part of all pages, so no window is partitioned by
``doc_id`` alone over page rows.  Pages are grouped into blocks of consecutive
page numbers; running values are computed inside ``(doc_id, page_block)`` and
what earlier blocks contribute is added from one summary row per block.  Page
numbers are 32-bit, so a document has at most 2^31 / PAGES_PER_BLOCK = 32,768
summary rows, and a block at most PAGES_PER_BLOCK pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGES_PER_BLOCK = 65_536

BLOCK_KEYS = ["doc_id", "page_block"]


def page_block(pages_per_block: int = PAGES_PER_BLOCK) -> Column:
    block = F.floor(F.col("page_no") / F.lit(pages_per_block)).cast("int")
    return F.coalesce(block, F.lit(0))


def keyed(pages: DataFrame) -> DataFrame:
    """Pages with a full key.

    Joins would add these filters to one branch of a plan and not to another; with
    them everywhere, and ``page_block`` never null, equal branches stay equal and
    Spark runs their common shuffle once.
    """
    return pages.where(F.col("doc_id").isNotNull() & F.col("page_no").isNotNull())


def within_block():
    """Rows of a block up to the current page."""
    return (
        Window.partitionBy(*BLOCK_KEYS)
        .orderBy("page_no")
        .rowsBetween(Window.unboundedPreceding, 0)
    )


def earlier_blocks():
    """Summary rows of a document before the current block."""
    return Window.partitionBy("doc_id").orderBy("page_block").rowsBetween(
        Window.unboundedPreceding, -1
    )


def carry_last(pages: DataFrame, column: str, pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Fill ``column`` with its last non-null value at or before each page.

    The shuffle by block is written out: it sits directly on the scan, so that a plan
    that uses the result twice runs it once.
    """
    blocked = pages.withColumn("page_block", page_block(pages_per_block))
    summaries = blocked.groupBy(*BLOCK_KEYS).agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col("page_no"))).alias("_tail")
    )
    carried = summaries.select(
        *BLOCK_KEYS, F.last("_tail", ignorenulls=True).over(earlier_blocks()).alias("_carried")
    ).where(F.col("_carried").isNotNull())
    filled = F.coalesce(
        F.last(column, ignorenulls=True).over(within_block()), F.col("_carried")
    )
    return (
        blocked.repartition(*BLOCK_KEYS)
        .join(carried, BLOCK_KEYS, "left")
        .withColumn(column, filled)
        .drop("_carried")
    )


def numbered_items(
    pages: DataFrame, items: str, alias: str, pages_per_block: int = PAGES_PER_BLOCK
) -> DataFrame:
    """``doc_id, page_no, items`` and ``alias``: the number of items on all earlier pages.

    ``items`` is an array, never null.  Pages are dealt out by block once, with their items;
    the totals of blocks are read from that same exchange, so whatever makes the items is
    planned once.  To keep the two reads alike the totals use every column of it: blocks are
    ordered by their last page.
    """
    blocked = (
        keyed(pages)
        .select("doc_id", "page_no", items, page_block(pages_per_block).alias("page_block"))
        .repartition(*BLOCK_KEYS)
    )
    totals = blocked.groupBy(*BLOCK_KEYS).agg(
        F.sum(F.size(items)).alias("_total"), F.max("page_no").alias("_last")
    )
    earlier = Window.partitionBy("doc_id").orderBy("_last").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*BLOCK_KEYS, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    own = F.size(items)
    running = F.sum(own).over(within_block()) - own + F.col("_before")
    return blocked.join(before, BLOCK_KEYS).select("doc_id", "page_no", items, running.alias(alias))


def prefix_sums(
    rows: DataFrame, keys: list[str], order: str, sums: dict[str, Column], block_size: int, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Adds ``turn_block`` and, for each name in ``sums``, the sum of its column over the rows of
    ``keys`` before the current one, by ``order`` (null first) and ``ties``.

    Rows meet within blocks of ``block_size`` values of ``order`` only; earlier blocks add one
    summary row each.
    """
    block = F.coalesce(F.floor(F.col(order) / F.lit(block_size)), F.lit(-(1 << 62)))
    blocked = rows.withColumn("turn_block", block)
    totals = blocked.groupBy(*keys, "turn_block").agg(*[F.sum(v).alias(f"_{n}") for n, v in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("turn_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *keys, "turn_block", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    inside = (
        Window.partitionBy(*keys, "turn_block")
        .orderBy(F.col(order).asc_nulls_first(), *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return blocked.join(before, [*keys, "turn_block"]).select(
        *rows.columns,
        "turn_block",
        *[(F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_{n}")).alias(n) for n, v in sums.items()],
    )
