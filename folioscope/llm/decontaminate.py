"""Benchmark decontamination by spaced-seed hashing.

A token is a lower-cased run of letters and digits. A seed is the hash of the tokens under the
ones of a fixed mask, so it survives any change under the zeros; the masks leave no placement of
the changes that the overlap rule allows without a seed. Seeds of the documents are
joined with those of the benchmark; every hit sets a document against an item at one offset,
and the tokens around it are compared place by place. They overlap if a window of ``WINDOW``
tokens (the whole item or document, if shorter) agrees in at least ``SHARE`` of its places.

Only hits leave the scan: two bitmaps of seed hashes, of fixed size whatever the benchmark's,
pass all seeds that the benchmark has and few others; the join is exact.

Defined cases: null and empty texts have no seeds. Items or documents with fewer than ``LEAST``
tokens overlap with nothing. Null ids are passed on. Repeated rows count once. An empty
table on either side gives no rows. Very long texts are scanned one at a time, in memory
proportional to the text. Other columns, of any name, are not read, and pass through
``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.llm import words as w
from folioscope.llm.storage import cut

#: Of weight 5. Wherever a quarter of the places of a window of 8 to 16 tokens has changed, one
#: of them fits between the changes: found by greedy search, and tested for every such placement.
MASKS = (
    "101111", "110111", "1111001", "10011011", "11000111", "11001011", "11100101", "1101000011",
)
WINDOW, SHARE, LEAST = 16, 0.75, 8
FILTER_BITS = 24


def _seeds(found: w.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every mask: positions of the words at which it fits into the row, and their seeds."""
    out = []
    for number, mask in enumerate(MASKS):
        n = len(found.hashes) - len(mask) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(found.row[:n] == found.row[len(mask) - 1 :])
        total = np.full(n, number + 1, np.uint64)
        for k, one in enumerate(mask):
            if one == "1":
                total = total * w._BASE + found.hashes[k : k + n]
        out.append((at, w.mix(total[at])))
    return out


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in w.text_blocks(batch, "text"):
            found = w.words_of(data, offsets, alphabet=w.ALNUM)
            seeds = _seeds(found)
            at = np.concatenate([s[0] for s in seeds]) if seeds else np.zeros(0, np.int64)
            hashes = np.concatenate([s[1] for s in seeds]) if seeds else np.zeros(0, np.uint64)
            order = np.argsort(found.row[at], kind="stable")
            counts = np.bincount(found.row[at], minlength=last - first)
            places = (at - found.first[found.row[at]])[order]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").slice(first, last - first),
                    w.list_array(found.hashes, found.counts, pa.int64()),
                    w.list_array(places, counts, pa.int64()),
                    w.list_array(hashes[order], counts, pa.int64()),
                ],
                names=["item", "tokens", "places", "seeds"],
            )


def _slots(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of seeds in the two bitmaps, from bits of their own."""
    return seeds >> np.uint64(64 - FILTER_BITS), (seeds >> np.uint64(64 - 2 * FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)


def _regions(bitmaps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = bitmaps.value
        for batch in batches:
            for first, last, data, offsets in w.text_blocks(batch, "text"):
                found = w.words_of(data, offsets, alphabet=w.ALNUM)
                hits, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for at, hashes in _seeds(found):
                    kept = np.flatnonzero(one[_slots(hashes)[0]])
                    kept = kept[two[_slots(hashes[kept])[1]]]
                    hits.append(at[kept])
                    seeds.append(hashes[kept])
                hit, seed = np.concatenate(hits), np.concatenate(seeds)
                if not len(hit):
                    continue
                order = np.argsort(hit, kind="stable")
                hit, seed = hit[order], seed[order]
                row = found.row[hit]
                start = np.maximum(hit - WINDOW, found.first[row])
                end = np.minimum(hit + max(map(len, MASKS)) + WINDOW, found.first[row + 1])
                fresh = np.ones(len(hit), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
                begin = np.flatnonzero(fresh)
                until = np.append(begin[1:], len(hit)) - 1
                low, high, owner = start[begin], end[until], row[begin]
                lengths = high - low
                flat = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
                sizes = np.diff(np.append(begin, len(hit)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, last - first).take(pa.array(owner)),
                        pa.array(low - found.first[owner]),
                        pa.array(found.counts[owner]),
                        w.list_array(found.hashes[flat], lengths, pa.int64()),
                        w.list_array(hit - found.first[row], sizes, pa.int64()),
                        w.list_array(seed, sizes, pa.int64()),
                    ],
                    names=["doc", "region", "doc_words", "tokens", "places", "seeds"],
                )

    return run


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compare the tokens of a region with those of an item that is moved by ``shift``."""
    for batch in batches:
        spans = []
        for region, doc_words, ours, theirs, shift in zip(
            batch["region"], batch["doc_words"], batch["tokens"], batch["item_tokens"], batch["shift"]
        ):
            ours, theirs = np.asarray(ours), np.asarray(theirs)
            low, high = max(region, shift), min(region + len(ours), shift + len(theirs))
            size = min(WINDOW, len(theirs), doc_words)
            span = (0, 0, 0)
            if size >= LEAST and high - low >= size:
                same = ours[low - region : high - region] == theirs[low - shift : high - shift]
                sums = np.concatenate([[0], np.cumsum(same)])
                good = np.flatnonzero(sums[size:] - sums[:-size] >= np.ceil(SHARE * size))
                if len(good):
                    begin, end = good[0], good[-1] + size
                    span = (low + begin, low + end, sums[end] - sums[begin])
            spans.append(span)
        start, end, equal = zip(*spans) if spans else ((), (), ())
        found = batch[["doc", "item"]].assign(start_word=start, end_word=end, n_equal=equal)
        yield found[found["n_equal"] > 0]


def _bitmap(places: DataFrame) -> np.ndarray:
    """Flags of ``1 << FILTER_BITS`` places, made in the tasks; the driver takes pieces of 4 KB."""
    flags = np.zeros(1 << FILTER_BITS, bool)
    parts = places.groupBy(F.shiftright("at", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND((1 << 15) - 1)).alias("bits")
    )
    for row in parts.collect():
        first = row["part"] << 15
        flags[first : first + (1 << 15)] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
    return flags


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document and item that overlap: their ids and the widest overlap, as
    ``start_word``, ``end_word`` (exclusive) in the document's tokens and ``n_equal`` places."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    items = cut(
        items.mapInArrow(_items, f"item {item_kind}, tokens array<bigint>, places array<bigint>, seeds array<bigint>")
        .withColumn("item_no", F.monotonically_increasing_id())
    )
    seeds = items.select("item_no", F.explode(F.arrays_zip("places", "seeds")).alias("s")).select(
        "item_no", F.col("s.places").alias("item_place"), F.col("s.seeds").alias("seed")
    )
    top = F.shiftrightunsigned("seed", 64 - 2 * FILTER_BITS)
    pairs = seeds.select(F.shiftright(top, FILTER_BITS).alias("one"), top.bitwiseAND((1 << FILTER_BITS) - 1).alias("two"))
    bitmaps = np.stack([_bitmap(pairs.select(F.col(half).alias("at"))) for half in ("one", "two")])

    narrow = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    regions = cut(
        narrow.mapInArrow(
            _regions(spark.sparkContext.broadcast(bitmaps)),
            f"doc {kind}, region bigint, doc_words bigint, tokens array<bigint>, places array<bigint>, seeds array<bigint>",
        ).withColumn("region_no", F.monotonically_increasing_id())
    )
    hits = regions.select("region_no", F.explode(F.arrays_zip("places", "seeds")).alias("s")).select(
        "region_no", F.col("s.places").alias("place"), F.col("s.seeds").alias("seed")
    )
    met = hits.join(seeds, "seed").select("region_no", "item_no", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    around = met.join(regions.select("region_no", "doc", "region", "doc_words", "tokens"), "region_no")
    around = around.join(items.select("item_no", "item", F.col("tokens").alias("item_tokens")), "item_no")
    found = around.select("doc", "item", "region", "doc_words", "tokens", "item_tokens", "shift").mapInPandas(
        _aligned, f"doc {kind}, item {item_kind}, start_word bigint, end_word bigint, n_equal bigint"
    )
    best = F.max(F.struct("n_equal", "start_word", "end_word")).alias("best")
    return (
        found.groupBy("doc", "item")
        .agg(best)
        .select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "best.start_word", "best.end_word", "best.n_equal")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without an overlap, with all their columns."""
    id_hit = fresh("_hit", docs)
    found = overlaps(docs, benchmark, doc_id, **options).select(F.col(doc_id).alias(id_hit)).distinct()
    return docs.join(found, F.col(doc_id).eqNullSafe(F.col(id_hit)), "left_anti")
