"""Greedy packing of paragraphs into chunks of bounded token count.

Paragraphs of a section are taken in order; a paragraph that would exceed the
budget opens a new chunk.  Each decision depends on the one before it, so one
section is a chain, and a section of one long document may hold a large part of
all paragraphs.  The chain is cut into blocks of pages:

* a block maps the fill level it starts with to the fill level it ends with and
  the number of chunks it closes.  As a function of the starting level this is a
  short list of steps, because the level only matters until the first close;
* the functions of the blocks of one section are scanned like prefix sums: those of
  up to 128 neighbouring blocks are composed into one, up to 256 of these give every
  group its start, and within its group every block gets its own;
* with these, every block is packed on its own.

Only documents longer than one block take part in the scan.  The chunks that a block
closes from an empty start, all that other sections of a short document ask for, are
counted within the row.  Only page numbers and token counts are handled here; the text
joins afterwards.  Token counts are at least 1.
"""

from __future__ import annotations

from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import fixed_values as fv
from folioscope.operators.blocks import BLOCK_KEYS, PAGES_PER_BLOCK, page_block

BLOCKS_PER_GROUP = 128
RUN_KEYS = ["doc_id", "section_type"]
RUN_BLOCK_KEYS = [*RUN_KEYS, "page_block"]


def _kernels(budget: int) -> SimpleNamespace:
    """Arrow functions of the packing.  Nested, so that executors get them by value and
    need no copy of this package.

    A block's function is ``[total, then (from level, chunks closed, final level) ...]`` by
    rising level.  A final level of -1 stands for "starting level + total": nothing closed.
    """

    import numpy as np

    def cuts(tokens):
        """Running totals, and for each paragraph the first one after a chunk that starts with it."""
        ends = np.cumsum(tokens)
        after = np.searchsorted(ends, ends - tokens + budget, "right")
        return ends, np.maximum(after, np.arange(1, len(ends) + 1))

    def first_cut(ends, fill):
        cut = int(np.searchsorted(ends, budget - fill, "right"))
        return max(cut, 1) if fill == 0 else cut

    def block_steps(tokens):
        ends, after = cuts(tokens)
        after, n = after.tolist(), len(ends)
        result = {}  # cut -> (chunks closed from there on, final level)

        def follow(cut):
            path = []
            while cut < n and cut not in result:
                path.append(cut)
                cut = after[cut]
            for at in reversed(path):
                if cut >= n:
                    result[at] = (1, int(ends[-1] - ends[at] + tokens[at]))
                else:
                    closed, level = result[cut]
                    result[at] = (closed + 1, level)
                cut = at
            return result[cut]

        empty, total = first_cut(ends, 0), int(ends[-1])
        steps = [total, 0, *(follow(empty) if empty < n else (0, total))]
        if budget - total >= 1:
            steps += [1, 0, -1]
        for cut in range(int(np.searchsorted(ends, budget - 1, "right")), -1, -1):
            if cut < n:
                steps += [max(budget - int(ends[cut]) + 1, 1), *follow(cut)]
        return steps

    def pieces(steps):
        return int(steps[0]), np.asarray(steps[1:], np.int64).reshape(-1, 3)

    def apply(function, level):
        """Chunks closed and final level from each of the starting levels."""
        total, rows = function
        hit = rows[np.searchsorted(rows[:, 0], level, "right") - 1]
        return hit[:, 1], np.where(hit[:, 2] < 0, level + total, hit[:, 2])

    def compose(one, two):
        """First the block of ``one``, then that of ``two``."""
        (total, rows), (more, others) = one, two
        kept = rows[:, 2] >= 0
        closed, last = apply(two, rows[kept, 2])
        out = [np.stack([rows[kept, 0], rows[kept, 1] + closed, last], axis=1)]
        for at in np.flatnonzero(~kept):
            # levels that are passed on raised by the total: cut where the second function is
            low = rows[at, 0]
            high = rows[at + 1, 0] if at + 1 < len(rows) else np.iinfo(np.int64).max // 2
            first = np.searchsorted(others[:, 0], low + total, "right") - 1
            until = np.searchsorted(others[:, 0], high + total - 1, "right")
            part = others[first:until].copy()
            part[:, 0] = np.maximum(part[:, 0] - total, low)
            part[:, 1] += rows[at, 1]
            out.append(part)
        merged = np.concatenate(out)
        merged = merged[np.argsort(merged[:, 0], kind="stable")]
        fresh = np.ones(len(merged), bool)
        # the first row is the empty start; it stays by itself
        fresh[2:] = (merged[2:, 1:] != merged[1:-1, 1:]).any(axis=1)
        return total + more, merged[fresh]

    def ordered(table, by):
        table = table.sort_by(by)
        return table, [pieces(x) for x in table.column("steps").to_pylist()]

    def composed(table):
        """One function of the blocks of a group."""
        import pyarrow as pa

        table, functions = ordered(table, "page_block")
        whole = functions[0]
        for function in functions[1:]:
            whole = compose(whole, function)
        steps = [whole[0], *whole[1].ravel().tolist()]
        keys = table.slice(0, 1).select(["doc_id", "section_type", "block_group"])
        return keys.append_column("steps", pa.array([steps], pa.list_(pa.int64())))

    def walk(table, functions, chunk, level):
        """Chunk number and level at the start of each function, and chunk number at its end."""
        import pyarrow as pa

        rows = []
        for function in functions:
            closed, last = apply(function, np.array([level]))
            rows.append((chunk, level, chunk + int(closed[0])))
            chunk, level = rows[-1][2], int(last[0])
        for name, values in zip(("entry_chunk", "entry_level", "last_chunk"), zip(*rows)):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table.drop_columns(["steps"])

    def group_entries(table):
        table, functions = ordered(table, "block_group")
        return walk(table, functions, 0, 0).drop_columns(["last_chunk"])

    def block_entries(table, entry):
        table, functions = ordered(table, "page_block")
        start = entry.column("entry_chunk")[0].as_py(), entry.column("entry_level")[0].as_py()
        return walk(table, functions, *start).drop_columns(["block_group"])

    def numbers(tokens, chunk, fill):
        """Chunk number of each paragraph."""
        ends, after = cuts(tokens)
        opens, at, after = [], first_cut(ends, fill), after.tolist()
        while at < len(after):
            opens.append(at)
            at = after[at]
        steps = np.zeros(len(after), np.int64)
        steps[opens] = 1
        return chunk + np.cumsum(steps)

    def chunks(batches):
        """One row per page, with the chunk numbers of its paragraphs."""
        import pyarrow as pa

        def flat(column):
            return column.flatten().to_numpy(zero_copy_only=False)

        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = flat(batch.column("tokens")).astype(np.int64)
            bounds = np.cumsum(batch.column("tokens").value_lengths().to_numpy())[:-1]
            starts = (batch.column(c).to_numpy() for c in ("first_chunk", "entry_level"))
            found = np.concatenate([numbers(*run) for run in zip(np.split(tokens, bounds), *starts)])
            sizes = flat(batch.column("sizes"))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), batch.column("sizes").value_lengths().to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("page_nos").flatten(),
                    batch.column("section_type").take(rows),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64())),
                    pa.ListArray.from_arrays(offsets, batch.column("tokens").flatten()),
                ],
                names=["doc_id", "page_no", "section_type", "chunk_numbers", "tokens"],
            )

    @F.pandas_udf("array<bigint>")
    def steps(tokens: pd.Series) -> pd.Series:
        return tokens.map(block_steps)

    return SimpleNamespace(
        steps=steps, composed=composed, group_entries=group_entries, block_entries=block_entries, chunks=chunks
    )


def block_runs(sectioned: DataFrame) -> DataFrame:
    """Per section and block: page numbers, paragraphs per page and token counts."""
    pages = F.col("pages")
    return (
        sectioned.where(F.size("tokens") > 0)
        .groupBy(*RUN_BLOCK_KEYS)
        .agg(F.array_sort(F.collect_list(F.struct("page_no", "tokens"))).alias("pages"))
        .select(
            *RUN_BLOCK_KEYS,
            pages["page_no"].alias("page_nos"),
            F.transform(pages["tokens"], F.size).alias("sizes"),
            F.flatten(pages["tokens"]).alias("tokens"),
        )
    )


def _closed_from_empty(tokens: Column, budget: int) -> Column:
    """Chunks that a run closes, its last one not counted, when it starts a section."""
    zero = F.lit(0).cast("bigint")

    def pack(state: Column, t: Column) -> Column:
        full = (state["level"] > 0) & (state["level"] + t > budget)
        return F.struct(
            F.when(full, t).otherwise(state["level"] + t).cast("bigint").alias("level"),
            (state["closed"] + F.when(full, 1).otherwise(0)).cast("bigint").alias("closed"),
        )

    start = F.struct(zero.alias("level"), zero.alias("closed"))
    return F.aggregate(tokens, start, pack)["closed"]


def _entries(runs: DataFrame, pages: DataFrame, kernel: SimpleNamespace, pages_per_block: int, per_group: int) -> DataFrame:
    """``entry_chunk, entry_level, last_chunk`` of every block of documents longer than one."""
    # The keys are those by which the runs already lie, so only this side moves.
    long_documents = (
        pages.where(F.col("page_no") >= pages_per_block)
        .groupBy("doc_id")
        .agg(F.max(page_block(pages_per_block)).alias("last_block"))
        .select("doc_id", F.explode(F.sequence(F.lit(0), "last_block")).alias("page_block"))
    )
    group = [*RUN_KEYS, "block_group"]
    # written out: composing groups and walking through them read the same exchange
    stepped = (
        runs.join(long_documents, BLOCK_KEYS, "left_semi")
        .select(
            *RUN_BLOCK_KEYS,
            F.floor(F.col("page_block") / per_group).cast("int").alias("block_group"),
            kernel.steps("tokens").alias("steps"),
        )
        .repartition(*group)
    )
    keys = [runs.schema[c] for c in RUN_KEYS]
    group_no, block_no = (T.StructField(c, T.IntegerType()) for c in ("block_group", "page_block"))
    entry = [T.StructField(c, T.LongType()) for c in ("entry_chunk", "entry_level")]
    steps = T.StructField("steps", T.ArrayType(T.LongType()))
    composed = stepped.groupBy(*group).applyInArrow(kernel.composed, T.StructType([*keys, group_no, steps]))
    starts = composed.groupBy(*RUN_KEYS).applyInArrow(kernel.group_entries, T.StructType([*keys, group_no, *entry]))
    ends = T.StructField("last_chunk", T.LongType())
    return (
        stepped.groupBy(*group)
        .cogroup(starts.groupBy(*group))
        .applyInArrow(kernel.block_entries, T.StructType([*keys, block_no, *entry, ends]))
    )


def assign_chunks(
    sectioned: DataFrame,
    pages: DataFrame,
    budget: int = fv.MAX_TOKENS_PER_CHUNK,
    pages_per_block: int = PAGES_PER_BLOCK,
    blocks_per_group: int = BLOCKS_PER_GROUP,
) -> DataFrame:
    """Chunk numbers, from 1 per document, of the paragraphs of every page.

    ``sectioned``: ``doc_id, page_no, page_block, section_type, tokens``, with the
    token counts of the paragraphs of the page in order.
    ``pages``: any table with ``doc_id, page_no`` of the same pages; it is only asked
    which documents are longer than a block.

    Sections are numbered in the order of their first paragraph.  Result:
    ``doc_id, page_no, section_type, chunk_numbers, tokens``.
    """
    kernel = _kernels(budget)
    runs = block_runs(sectioned)
    entries = _entries(runs, pages, kernel, pages_per_block, blocks_per_group)
    states = runs.select(
        *RUN_BLOCK_KEYS,
        F.get("page_nos", F.lit(0)).alias("first_page"),
        _closed_from_empty(F.col("tokens"), budget).alias("closed"),
    ).join(entries, RUN_BLOCK_KEYS, "left")
    states = states.select(
        *RUN_BLOCK_KEYS,
        "first_page",
        F.coalesce("entry_chunk", F.lit(0)).alias("entry_chunk"),
        F.coalesce("entry_level", F.lit(0)).alias("entry_level"),
        F.coalesce("last_chunk", "closed").alias("last_chunk"),
    )
    placed = runs.join(_section_offsets(states), RUN_BLOCK_KEYS).select(
        *RUN_KEYS, "page_nos", "sizes", "tokens", "first_chunk", "entry_level"
    )
    schema = T.StructType(
        [
            runs.schema["doc_id"],
            T.StructField("page_no", runs.schema["page_nos"].dataType.elementType),
            runs.schema["section_type"],
            T.StructField("chunk_numbers", T.ArrayType(T.LongType())),
            T.StructField("tokens", runs.schema["tokens"].dataType),
        ]
    )
    return placed.mapInArrow(kernel.chunks, schema)


def _section_offsets(states: DataFrame) -> DataFrame:
    """Number of the chunk that is open at the start of each block, from 1 per document, and its
    level."""
    section = Window.partitionBy(*RUN_KEYS)
    earlier = (
        Window.partitionBy("doc_id")
        .orderBy("section_page")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return (
        states.repartition("doc_id")
        .select(
            *RUN_BLOCK_KEYS,
            "entry_chunk",
            "entry_level",
            F.min("first_page").over(section).alias("section_page"),
            F.when(
                F.col("page_block") == F.min("page_block").over(section),
                F.max("last_chunk").over(section) + 1,
            )
            .otherwise(0)
            .alias("section_chunks"),
        )
        .select(
            *RUN_BLOCK_KEYS,
            (F.col("entry_chunk") + F.coalesce(F.sum("section_chunks").over(earlier), F.lit(0)) + 1).alias("first_chunk"),
            "entry_level",
        )
    )
