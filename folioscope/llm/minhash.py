"""Near duplicates by MinHash: multi-index Hamming join of b-bit signatures.

1. A document's set are its distinct word shingles. Equal sets form a class.
2. A class has a signature of ``CHUNKS * SYMBOLS`` b-bit minima (b = 8), one chunk to a long.
3. Pigeonhole: signatures that differ in at most ``2 * CHUNKS - 1`` minima have a chunk with at
   most one difference. All single errors are enumerated by blanking each minimum of a chunk in
   turn; classes with an equal key meet. A similarity of 0.8 differs in a fifth of the minima,
   so all ten chunks fail for fewer than 3 in 100,000 such pairs, and fewer above.
4. A class is compared first with the nearest of its buckets' earliest members, then only across
   the components found so far, where bitmaps of the shingles leave room for the similarity. So
   most of a group of near copies costs links, not pairs, and no link is left out. Signatures farther apart than ``MAX_DISTANCE`` are passed over; the rest is confirmed on
   full sets.

Defined cases: a document without words, or null, has no set and no link. A null id takes no
part in links, stays, and has no component. Repeated rows each return a row. One id with
several texts is one vertex with the links of all its texts. An empty table gives no rows. A very
long text is one row of shingles, in memory proportional to the text. Other columns, of any name,
are not read, and pass through ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.llm import words as w
from folioscope.llm.components import components
from folioscope.llm.storage import cut

CHUNKS, SYMBOLS, BITS = 10, 6, 8
#: Bits of the bitmap that a class has beside its signature once it has met another one.
BITMAP = 2048
#: So many centers of its buckets a class is compared with at first.
NEAREST = 3
#: Of 60 minima; at a similarity of 0.8, 12 differ on average, and over 27 in 5 of a million pairs.
MAX_DISTANCE = 27

_rng = np.random.Generator(np.random.PCG64(7))
_FACTORS = _rng.integers(1, 1 << 62, CHUNKS * SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, in ascending order by row, and their number in each row.

    A row of fewer than ``size`` words has its whole sequence as the only shingle."""
    found = w.words_of(data, offsets)
    n = len(offsets) - 1
    windows = w.window_hashes(found.hashes, size)
    begins = np.flatnonzero(found.row[: len(windows)] == found.row[size - 1 :]) if len(windows) else np.zeros(0, np.int64)
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    whole = w.run_hashes(found.hashes, found.first[short], found.first[short + 1])
    keys = np.concatenate([windows[begins], whole])
    rows = np.concatenate([found.row[begins], short])
    order = np.argsort(keys)
    order = order[np.argsort(rows[order], kind="stable")]
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[fresh], np.bincount(rows[fresh], minlength=n)


def signatures(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of ``CHUNKS`` longs for every row that has shingles."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
    sig = np.zeros((len(first), CHUNKS), np.uint64)
    if not len(first):
        return sig
    buffer = np.empty_like(keys)
    for k, factor in enumerate(_FACTORS):
        np.multiply(keys, factor, out=buffer)
        # the high half decides; its minimum is spread again before 8 bits are kept
        least = w.mix(np.minimum.reduceat(buffer, first) >> np.uint64(8))
        sig[:, k // SYMBOLS] |= (least & np.uint64(0xFF)) << np.uint64(BITS * (k % SYMBOLS))
    return sig


def _class_ids(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each row's set; 0 without shingles."""
    found = np.zeros(len(counts), np.uint64)
    if len(keys):
        held = counts > 0
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[held]
        parts = np.add.reduceat(w.mix(keys), starts), np.bitwise_xor.reduceat(w.mix(keys * np.uint64(3)), starts)
        found[held] = w.mix(parts[0] * np.uint64(5) + w.mix(parts[1] + counts[held].astype(np.uint64)))
    return found


def _bitmaps(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row the bits that its shingles fall on, as longs."""
    flags = np.zeros((len(counts), BITMAP), bool)
    flags[np.repeat(np.arange(len(counts)), counts), w.mix(keys * np.uint64(7)) % np.uint64(BITMAP)] = True
    return np.packbits(flags, axis=1).view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in w.text_blocks(batch, "text"):
                keys, counts = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, last - first),
                        pa.array(counts, pa.int64()),
                        pa.array(_class_ids(keys, counts).view(np.int64)),
                        w.list_array(signatures(keys, counts).ravel(), np.where(counts > 0, CHUNKS, 0), pa.int64()),
                    ],
                    names=["doc", "n_shingles", "class", "sig"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in w.text_blocks(batch, "text"):
                keys, counts = shingle_sets(data, offsets, size)
                bits = _bitmaps(keys, counts)
                found = pa.RecordBatch.from_arrays(
                    [
                        pa.array(_class_ids(keys, counts).view(np.int64)),
                        w.list_array(keys, counts, pa.int64()),
                        w.list_array(bits.ravel(), np.full(len(bits), bits.shape[1]), pa.int64()),
                    ],
                    names=["class", "members", "bits"],
                )
                # the id of a class may also stand on rows with another text
                yield found.filter(pc.equal(found.column("class"), batch.column("class").slice(first, last - first)))

    return run


def _differences(x: Column, y: Column, chunk: int) -> Column:
    """The top bit of every byte in which two chunks differ."""
    low = F.lit(0x00007F7F7F7F7F7F)
    d = x[chunk].bitwiseXOR(y[chunk])
    return (d.bitwiseAND(low) + low).bitwiseOR(d).bitwiseAND(F.lit(0x0000808080808080))


def _distance(x: Column, y: Column) -> Column:
    """Number of differing minima of two signatures."""
    total = F.lit(0)
    for k in range(CHUNKS):
        total = total + F.bit_count(_differences(x, y, k))
    return total


def _first_meeting(x: Column, y: Column) -> Column:
    """Number of the first key that two signatures share; they have up to one for every blank."""
    found = F.lit(-1)
    for k in reversed(range(CHUNKS)):
        full = _differences(x, y, k)
        blank = F.when(full == 0, 0).otherwise(F.floor(F.bit_count(full - 1) / BITS).cast("int"))
        found = F.when(F.bit_count(full) <= 1, blank + k * SYMBOLS).otherwise(found)
    return found


def _bucket_keys() -> Column:
    """All keys of a signature: each chunk with each of its minima blanked in turn."""
    return F.array(
        *[
            F.xxhash64(F.lit(c * SYMBOLS + s), F.col("sig")[c].bitwiseAND(F.lit(~(0xFF << (BITS * s)))))
            for c in range(CHUNKS)
            for s in range(SYMBOLS)
        ]
    )


def _close(x: str, y: str, percent: int) -> Column:
    """Sizes and signatures leave room for the wanted similarity."""
    n, m = F.col(x)["n"], F.col(y)["n"]
    near = _distance(F.col(x)["sig"], F.col(y)["sig"]) <= MAX_DISTANCE
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & near


def _may_share(n: Column, x: Column, m: Column, y: Column, percent: int) -> Column:
    """Whether sets of sizes ``n``, ``m`` with bitmaps ``x``, ``y`` can be similar enough.

    Every bit that only one set falls on is a shingle that the other one lacks, so this never
    rules out a pair that is."""
    longs = BITMAP // 64
    lacks = sum((F.bit_count(x[k].bitwiseAND(F.bitwise_not(y[k]))) for k in range(longs)), F.lit(0))
    lacked = sum((F.bit_count(y[k].bitwiseAND(F.bitwise_not(x[k]))) for k in range(longs)), F.lit(0))
    common = F.least(n - lacks, m - lacked)
    return 100 * common >= percent * (n + m - common)


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in ("x", "y"):
        part = classes.select(F.col("class").alias(side), F.struct("n", "sig").alias(f"{side}_sketch"))
        pairs = pairs.join(part, side)
    return pairs


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose full sets are similar enough."""
    for side in ("x", "y"):
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("members").alias(f"{side}_set")), side)
    common = F.size(F.array_intersect("x_set", "y_set"))
    union = F.size("x_set") + F.size("y_set") - common
    return pairs.where(100 * common >= percent * union)


def _center_pairs(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """For each class the nearest, by signature, of its buckets' centers."""
    pairs = met.where("class <> center").select(F.col("class").alias("x"), F.col("center").alias("y")).distinct()
    near = _with_sketches(pairs, classes).where(_close("x_sketch", "y_sketch", percent))
    found = F.struct(_distance(F.col("x_sketch.sig"), F.col("y_sketch.sig")).alias("distance"), "y")
    # no more than one for every key
    ranked = near.groupBy("x").agg(F.slice(F.sort_array(F.collect_list(found)), 1, NEAREST).alias("nearest"))
    return ranked.select("x", F.explode("nearest.y").alias("y"))


def _across(met: DataFrame, known: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a bucket in different components that are close, each once.

    Members of a bucket's main component only meet the others. Per pair: ``x``, ``y`` and their
    components ``cx``, ``cy``."""
    labelled = met.select("bucket", "key", "class").join(known, "class", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class"))
    parts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("members"))
    mixed = parts.groupBy("bucket").agg(F.max_by("component", "members").alias("main"), F.count("*").alias("parts"))
    rows = labelled.join(mixed.where("parts > 1").select("bucket", "main"), "bucket")
    rows = rows.join(classes.select("class", "n", "sig"), "class").join(sets.select("class", "bits"), "class")
    rows = cut(rows.withColumn("sketch", F.struct("n", "sig", "bits")).drop("n", "sig", "bits"))
    x = rows.where("component <> main").select(
        "bucket", "main", "key", F.col("class").alias("x"), F.col("component").alias("cx"), F.col("sketch").alias("x_sketch")
    )
    y = rows.select("bucket", F.col("class").alias("y"), F.col("component").alias("cy"), F.col("sketch").alias("y_sketch"))
    apart = (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("main")) | (F.col("x") < F.col("y")))
    once = F.col("key") == _first_meeting(F.col("x_sketch.sig"), F.col("y_sketch.sig"))
    n, m = F.col("x_sketch.n"), F.col("y_sketch.n")
    may_share = _may_share(n, F.col("x_sketch.bits"), m, F.col("y_sketch.bits"), percent)
    return x.join(y, "bucket").where(apart & _close("x_sketch", "y_sketch", percent) & may_share & once).select("x", "y", "cx", "cy")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    sketches = cut(narrow.mapInArrow(_sketches(shingle), f"doc {kind}, n_shingles bigint, class bigint, sig array<bigint>"))
    held = sketches.where("n_shingles > 0 and doc is not null")
    classes = cut(
        held.groupBy("class").agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    )

    keyed = classes.select(F.posexplode(_bucket_keys()).alias("key", "bucket"), "class", "doc")
    shared = keyed.groupBy("bucket").agg(F.min_by("class", "doc").alias("center"), F.count("*").alias("met")).where("met > 1")
    met = cut(keyed.drop("doc").join(shared.select("bucket", "center"), "bucket"))

    wanted = met.select("class").distinct().join(classes.select("class", "doc"), "class")
    texts = narrow.join(wanted, "doc")
    sets = texts.mapInArrow(_sets(shingle), "class bigint, members array<bigint>, bits array<bigint>")
    sets = cut(sets.groupBy("class").agg(F.first("members").alias("members"), F.first("bits").alias("bits")))

    stars = cut(_confirmed(_center_pairs(met, classes, percent), sets, percent).select("x", "y"))
    known = components(stars, "x", "y").select(F.col("id").alias("class"), "component")
    rest = _confirmed(_across(met, known, classes, sets, percent), sets, percent).select(F.col("cx").alias("x"), F.col("cy").alias("y"))
    # an id on rows with different texts joins their classes
    several = held.groupBy("doc").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y").select("doc", "x")
    bridges = held.select("doc", "class").join(several, "doc").select("x", F.col("class").alias("y"))
    for side in ("x", "y"):
        ends = known.select(F.col("class").alias(side), F.col("component").alias("c"))
        bridges = bridges.join(ends, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    merged = components(rest.union(bridges.select("x", "y")), "x", "y").select(F.col("id").alias("component"), F.col("component").alias("whole"))
    labelled = classes.select("class", "doc").join(known, "class", "left").withColumn("component", F.coalesce("component", "class"))
    labelled = labelled.join(merged, "component", "left").select("class", "doc", F.coalesce("whole", "component").alias("component"))
    labelled = cut(labelled)
    smallest = labelled.groupBy("component").agg(F.min("doc").alias("component_id"))
    found = labelled.join(smallest, "component").select("class", "component_id")

    linked = sketches.where("n_shingles > 0").drop("sig").join(found, "class", "left")
    alone = sketches.where("n_shingles = 0").select("class", "doc", "n_shingles", F.col("doc").alias("component_id"))
    return linked.select("class", "doc", "n_shingles", "component_id").union(alone).select(
        F.col("doc").alias(doc_id),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns.

    Of rows that share an id all stay: they can't be told apart by it."""
    id_kept = fresh("_kept", docs)
    kept = near_duplicates(docs, doc_id, **options).where("kept").select(F.col(doc_id).alias(id_kept)).distinct()
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col(id_kept)), "left_semi")
