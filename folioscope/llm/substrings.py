"""Substring dedup by compaction of a de Bruijn graph of word windows.

Every run of ``window`` words of a text is an edge of the graph, between its first and its last
``window - 1`` words. An edge that starts in more than one place, of the same text or of others,
is repeated, and all words that it covers are removed wherever it stands.

1. Windows are dealt into buckets by the least hash among the ``seed``-word runs inside them.
   Neighbours that share it form a row, a piece of path of at most ``window - seed + 1`` edges
   that comes out alike wherever the same words stand. Buckets are counted, by rows of hash and
   number that are added up in the tasks first; those with one row hold no repeated edge. The
   others are marked in a bitmap of fixed size. It only saves work: a bucket that shares the
   place of another one is carried along and found to be empty of repeats.
2. Equal rows become one with a count and its smallest source coordinate (text, place). A bucket
   with a single distinct row needs no closer look: its edges all occur together. The edges of
   other buckets are counted by themselves, with the least and greatest edge before and behind
   them: where these differ the path branches.
3. Rows are cut at branches. What is left are pieces of nonbranching paths. All pieces of such a
   path have the same occurrences, only shifted, so their smallest coordinates lie in one text,
   one behind the other: joined by that text and ordered by place they compact into whole paths,
   in one round whatever the length of the path.
4. Heads of paths are looked up among the rows of all texts, which gives spans of source
   coordinates. Each text meets its spans once. A span is verified there: its first edge and the
   exclusive or of all its edges have to be those of the path.

An edge is identified by two hashes of 64 bits, its own and that of its bucket. Texts travel
compressed. Hot passages are counted before they are shuffled; joins on them are split by
adaptive execution.

Defined cases: a null text has no words and stays null, an empty one empty. Texts shorter than
the window lose nothing. Repeated rows are rows like any other, so a text of ``window`` words or
more that stands twice is removed from both. Ties don't arise: all occurrences go. An empty
table gives no rows. Very long texts are handled one at a time, in memory proportional to the
text. Other columns, of any name, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm import words as w
from folioscope.llm.storage import store

WINDOW = 35
#: Places of the bitmap of buckets: 16 MB whatever the corpus.
SIEVE_BITS = 27
_PART = 1 << 15
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _least_places(hashes: np.ndarray, size: int) -> np.ndarray:
    """For every place the leftmost place of the least of the next ``size`` hashes."""
    n = len(hashes) - size + 1
    best, span = np.arange(len(hashes)), 1
    while span < size:
        step = min(span, size - span)
        one, two = best[:-step], best[step:]
        best = np.where(hashes[two] < hashes[one], two, one)
        span += step
    return best[:n]


def _run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    start = np.arange(max(len(hashes) - size + 1, 0))
    return w.run_hashes(hashes, start, start + size)


class _Rows:
    """The edges of a block of texts, and the rows they form."""

    def __init__(self, found: w.Words, window: int):
        seed = (window + 1) // 2
        n = len(found.hashes) - window + 1
        self.edge = _run_hashes(found.hashes, window)
        # zero stands for no edge
        self.edge[self.edge == 0] = 1
        if n <= 0:
            self.valid = np.zeros(0, bool)
            self.start = self.end = np.zeros(0, np.int64)
            self.bucket = np.zeros(0, np.uint64)
            return
        seeds = _run_hashes(found.hashes, seed)
        place = _least_places(seeds, window - seed + 1)[:n]
        self.valid = found.row[:n] == found.row[window - 1 :]
        fresh = self.valid.copy()
        fresh[1:] &= ~self.valid[:-1] | (place[1:] != place[:-1])
        stops = self.valid.copy()
        stops[:-1] &= ~self.valid[1:] | fresh[1:]
        self.start, self.end = np.flatnonzero(fresh), np.flatnonzero(stops) + 1
        self.bucket = w.mix(seeds[place[self.start]] ^ _SALT)
        self.place = place
        self.seeds = seeds

    def neighbour(self, at: np.ndarray) -> np.ndarray:
        """The edges at these places, zero where there is none."""
        inside = (at >= 0) & (at < len(self.edge))
        at = np.where(inside, at, 0)
        return np.where(inside & self.valid[at], self.edge[at], np.uint64(0))

    def listed(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges of the picked rows with the one before and the one behind, their numbers, and
        a hash of each list."""
        start, end = self.start[pick], self.end[pick]
        sizes = end - start + 2
        first = np.cumsum(sizes) - sizes
        offset = np.arange(sizes.sum()) - np.repeat(first, sizes)
        flat = self.neighbour(np.repeat(start - 1, sizes) + offset)
        if not len(flat):
            return flat, sizes, np.zeros(0, np.uint64)
        digest = np.add.reduceat(w.mix(flat ^ _SALT) * w.powers(int(sizes.max()))[offset], first)
        return flat, sizes, w.mix(digest + sizes.astype(np.uint64))


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    for batch in batches:
        for first, last, data, offsets in w.text_blocks(batch, "text"):
            found = w.words_of(data, offsets, lower=False)
            yield batch.slice(first, last - first), found, data, _Rows(found, window)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _buckets(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, rows in _blocks(batches, window):
            bucket, count = np.unique(rows.bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(bucket), pa.array(count, pa.int64())], names=["bucket", "n"])

    return run


def _marked(sieve: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    at = bucket & np.uint64((1 << SIEVE_BITS) - 1)
    return ((sieve[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _sieve(docs: DataFrame, window: int) -> Broadcast:
    """A bit for every bucket that more than one row falls into."""
    counts = docs.mapInArrow(_buckets(window), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    at = F.col("bucket").bitwiseAND((1 << SIEVE_BITS) - 1)
    parts = counts.where("n > 1").select(F.shiftright(at, 15).alias("part"), at.bitwiseAND(_PART - 1).alias("bit"))
    bits = np.zeros((1 << SIEVE_BITS) // 8, np.uint8)
    # at most 4,096 parts of 4 KB, whatever the corpus
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        at = row["part"] * _PART // 8
        bits[at : at + _PART // 8] = np.frombuffer(row["bits"], np.uint8)
    return docs.sparkSession.sparkContext.broadcast(bits)


def _distinct_rows(sieve: Broadcast, window: int):
    """Rows of marked buckets; equal ones of a block are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, _, rows in _blocks(batches, window):
            pick = np.flatnonzero(_marked(sieve.value, rows.bucket))
            _, _, digest = rows.listed(pick)
            owner = found.row[rows.start[pick]]
            source = batch.column("h1").to_numpy()[owner] if len(owner) else np.zeros(0, np.int64)
            place = rows.start[pick] - found.first[owner]
            order = np.lexsort((place, source, digest, rows.bucket[pick]))
            key = np.stack([rows.bucket[pick][order], digest[order]])
            fresh = np.ones(len(order), bool)
            fresh[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            begin = np.flatnonzero(fresh)
            count = np.diff(np.append(begin, len(order)))
            chosen = order[begin]
            flat, sizes, _ = rows.listed(pick[chosen])
            # the bucket of the edge behind, where the path goes on
            behind = rows.end[pick[chosen]]
            goes_on = rows.neighbour(behind) != 0
            at = np.where(goes_on, behind, 0)
            onward = w.mix(rows.seeds[rows.place[at]] ^ _SALT) if len(chosen) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(rows.bucket[pick][chosen]),
                    _signed(digest[chosen]),
                    _signed(np.where(goes_on, onward, np.uint64(0))),
                    w.list_array(flat, sizes, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(source[chosen], pa.int64()),
                    pa.array(place[chosen], pa.int64()),
                ],
                names=["bucket", "digest", "onward", "edges", "n", "source", "place"],
            )

    return run


def _occurrences(sieve: Broadcast, window: int):
    """Where the rows of marked buckets stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, _, rows in _blocks(batches, window):
            pick = np.flatnonzero(_marked(sieve.value, rows.bucket))
            _, _, digest = rows.listed(pick)
            owner = found.row[rows.start[pick]]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(rows.bucket[pick]),
                    _signed(digest),
                    batch.column("h1").take(pa.array(owner)),
                    batch.column("h2").take(pa.array(owner)),
                    pa.array(rows.start[pick] - found.first[owner], pa.int64()),
                ],
                names=["bucket", "digest", "h1", "h2", "place"],
            )

    return run


ROW = ["bucket", "digest"]
EDGE = ["bucket", "edge"]


def _closed_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of the rows that have their bucket to themselves: the whole rows."""
    inner = F.slice("edges", 2, F.size("edges") - 2)
    behind = F.element_at("edges", -1)
    return rows.where("n > 1").select(
        *ROW,
        F.lit(0).alias("shift"),
        (F.size("edges") - 2).cast("long").alias("length"),
        F.aggregate(inner, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y)).alias("check"),
        F.element_at("edges", 2).alias("edge"),
        (F.element_at("edges", 1) != 0).alias("led_to"),
        F.when(behind != 0, F.struct(F.col("onward").alias("bucket"), behind.alias("edge"))).alias("next"),
    )


def _branching_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of the rows that share their bucket with others, cut at branches."""
    at = F.col("shift") + 1
    single = rows.select(
        *ROW, "n", "onward", "edges", F.posexplode(F.slice("edges", 2, F.size("edges") - 2)).alias("shift", "edge")
    ).select(
        *ROW, "n", "shift", "edge", F.get("edges", at - 1).alias("before"), F.get("edges", at + 1).alias("behind"),
        (at == F.size("edges") - 2).alias("last"), "onward",
    )
    one_way = [
        ((F.min(c) == F.max(c)) & (F.max(c) != 0)).alias(alias) for c, alias in (("before", "led_to"), ("behind", "leads_on"))
    ]
    repeated = single.groupBy(*EDGE).agg(F.sum("n").alias("n"), *one_way).where("n > 1").drop("n")
    # what only the last edge of a row needs is null in the others
    onward = F.when(F.col("last"), F.struct(F.col("onward").alias("bucket"), F.col("behind").alias("edge")))
    edges = single.select(*ROW, "shift", "edge", onward.alias("next")).join(repeated, EDGE)
    along = Window.partitionBy(*ROW).orderBy("shift")
    follows = (F.lag("shift").over(along) == F.col("shift") - 1) & F.lag("leads_on").over(along) & F.col("led_to")
    cut_up = edges.withColumn("fresh", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    cut_up = cut_up.withColumn("piece", F.sum("fresh").over(along))
    return cut_up.groupBy(*ROW, "piece").agg(
        F.min("shift").alias("shift"),
        F.count("*").alias("length"),
        F.bit_xor("edge").alias("check"),
        F.min_by("edge", "shift").alias("edge"),
        F.min_by("led_to", "shift").alias("led_to"),
        F.max_by(F.when(F.col("leads_on"), F.col("next")), "shift").alias("next"),
    ).drop("piece")


def _compacted(pieces: DataFrame) -> DataFrame:
    """``bucket, edge`` of the head, ``length`` and ``check`` of every nonbranching path."""
    source = F.struct("source", (F.col("place") + F.col("shift")).alias("place"))
    once = pieces.groupBy(*EDGE).agg(
        F.min(source).alias("at"),
        *[F.first(c).alias(c) for c in ("length", "check", "led_to")],
        # max passes over nulls, which a struct in first() wouldn't
        F.max("next").alias("next"),
    ).select(*EDGE, "length", "check", "led_to", "next", "at.source", "at.place")
    along = Window.partitionBy("source").orderBy("place")
    behind = F.lag(F.struct("place", "length", "next")).over(along)
    here = F.struct("bucket", "edge")
    follows = F.col("led_to") & (behind["next"] == here) & (behind["place"] + behind["length"] == F.col("place"))
    marked = once.withColumn("fresh", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    marked = marked.withColumn("path", F.sum("fresh").over(along))
    return marked.groupBy("source", "path").agg(
        F.min_by(here, "place").alias("head"), F.sum("length").alias("length"), F.bit_xor("check").alias("check")
    ).select("head.bucket", "head.edge", "length", "check")


def repeated_paths(docs: DataFrame, sieve: Broadcast, window: int) -> tuple[DataFrame, DataFrame]:
    """The nonbranching repeated paths, and the pieces of rows that lie on them.

    ``docs``: ``text, h1, h2``. Paths: ``bucket, edge`` (their first edge), ``length`` in edges
    and ``check``; pieces: ``bucket, digest`` of the row, ``shift`` in it, ``edge``."""
    found = docs.mapInArrow(
        _distinct_rows(sieve, window),
        "bucket bigint, digest bigint, onward bigint, edges array<bigint>, n bigint, source bigint, place bigint",
    )
    rows = store(
        found.groupBy(*ROW).agg(
            F.sum("n").alias("n"),
            F.min(F.struct("source", "place")).alias("at"),
            F.first("onward").alias("onward"),
            F.first("edges").alias("edges"),
        )
    )
    shared = rows.groupBy("bucket").agg((F.count("*") > 1).alias("shared"))
    dealt = rows.join(shared, "bucket")
    open_ones = dealt.where("shared").select(*ROW, "n", "onward", "edges")
    pieces = _branching_pieces(open_ones).unionByName(_closed_pieces(dealt.where("NOT shared")))
    pieces = store(pieces.join(rows.select(*ROW, "at.source", "at.place"), ROW))
    return store(_compacted(pieces)), pieces.select(*ROW, "shift", "edge")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one; null stays null."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes = [None if x is None else len(x) for x in texts.to_pylist()]
        packed = [None if x is None else codec.compress(x, asbytes=True) for x in texts.to_pylist()]
        columns = [batch.column(c) for c in ("rest", "h1", "h2")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())], names=["rest", "h1", "h2", "packed", "size"]
        )


def _covered(rows: _Rows, first: np.ndarray, spans: pa.Array, window: int) -> np.ndarray:
    """For each word whether a verified span covers it."""
    total = int(first[-1])
    steps = np.zeros(total + 1, np.int64)
    flat = spans.flatten()
    if len(flat):
        owner = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        place, length, edge, check = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        start = first[owner] + place
        end = start + length
        inside = (place >= 0) & (end + window - 1 <= first[owner + 1])
        owner, start, end, edge, check = (x[inside] for x in (owner, start, end, edge, check))
        running = np.zeros(len(rows.edge) + 1, np.uint64)
        np.bitwise_xor.accumulate(rows.edge, out=running[1:])
        same = (rows.edge[start] == edge.view(np.uint64)) & ((running[start] ^ running[end]) == check.view(np.uint64))
        np.add.at(steps, start[same], 1)
        np.add.at(steps, end[same] + window - 1, -1)
    return np.cumsum(steps)[:total] > 0


def _kept_texts(found: w.Words, data: np.ndarray, gone: np.ndarray) -> pa.Array:
    """The words that stay, joined by one blank, per row."""
    pick = np.flatnonzero(~gone)
    sizes = found.ends[pick] - found.starts[pick] + 1
    until = np.cumsum(sizes)
    flat = np.arange(int(until[-1]) if len(until) else 0) + np.repeat(found.starts[pick] - (until - sizes), sizes)
    out = np.append(data, np.uint8(0x20))[np.minimum(flat, len(data))]
    out[until - 1] = 0x20
    first = np.searchsorted(pick, found.first)
    bounds = np.append(0, until)[first]
    whole = out.tobytes()
    return pa.array([whole[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.string())


def _removed(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            values = zip(batch.column("packed").to_pylist(), batch.column("size").to_pylist())
            texts = pa.array(
                [None if x is None else codec.decompress(x, size, asbytes=True).decode() for x, size in values], pa.string()
            )
            plain = pa.RecordBatch.from_arrays([texts], names=["text"])
            for first, last, data, offsets in w.text_blocks(plain, "text"):
                found = w.words_of(data, offsets, lower=False)
                spans = batch.column("spans").slice(first, last - first)
                gone = _covered(_Rows(found, window), found.first, spans, window)
                lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[found.first])
                kept = _kept_texts(found, data, gone)
                missing = texts.slice(first, last - first).is_null()
                kept = pc.if_else(missing, pa.scalar(None, pa.string()), kept)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rest").slice(first, last - first), kept, pa.array(found.counts, pa.int64()), pa.array(lost, pa.int64())],
                    names=["rest", "text", "n_words", "n_removed"],
                )

    return run


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per distinct text that has any, known by two hashes ``h1, h2``: its repeated spans as
    ``place`` (of the first word), ``length`` (number of edges), ``edge`` and ``check``."""
    narrow = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), *_hashes(F.col(text)))
    sieve = _sieve(narrow, window)
    paths, pieces = repeated_paths(narrow, sieve, window)
    heads = pieces.join(paths, EDGE).select(*ROW, "shift", F.struct("length", "edge", "check").alias("path"))
    places = narrow.mapInArrow(_occurrences(sieve, window), "bucket bigint, digest bigint, h1 bigint, h2 bigint, place bigint")
    path = F.col("path")
    span = F.struct((F.col("place") + F.col("shift")).alias("place"), path["length"], path["edge"], path["check"])
    # equal texts have equal spans: a set is as long as one text needs
    return places.join(heads, ROW).groupBy("h1", "h2").agg(F.collect_set(span).alias("spans"))


def drop_repeated_passages(
    docs: DataFrame, text: str = "text", window: int = WINDOW, counted: tuple[str, str] = ("n_words", "n_removed")
) -> DataFrame:
    """``docs`` with ``text`` reduced to the words outside repeated windows, joined by one blank;
    ``counted`` names added counts of words and of removed words."""
    spans = store(repeated_spans(docs, text, window))
    others = [c for c in docs.columns if c != text]
    rest = F.struct(*[F.col(c) for c in others]) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(rest.alias("rest"), *_hashes(F.col(text)), F.col(text).alias("text"))
    kind = T.StructField("rest", rows.schema["rest"].dataType)
    longs = [T.StructField(c, T.LongType()) for c in ("h1", "h2")]
    packed = T.StructType([kind, *longs, T.StructField("packed", T.BinaryType()), T.StructField("size", T.LongType())])
    met = rows.mapInArrow(_packed, packed).join(spans, ["h1", "h2"], "left").select("rest", "packed", "size", "spans")
    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    result = met.mapInArrow(_removed(window), T.StructType([kind, T.StructField("text", T.StringType()), *counts]))
    own = {c: F.col("rest")[c].alias(c) for c in others} | {text: F.col("text").alias(text)}
    return result.select(*[own[c] for c in docs.columns], *[F.col(c).alias(n) for c, n in zip(("n_words", "n_removed"), counted)])
