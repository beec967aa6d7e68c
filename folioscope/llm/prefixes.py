"""Prefix trie of conversations by range minima over sorted common prefix lengths.

1. Turns become hashes of 128 bits. Conversations are sorted as sequences of these: sixteen
   turns at a time are replaced by their rank among all such runs, until one rank is left, so no
   conversation is ever one row of turns. Equal conversations become one sequence with a count.
2. Of each sequence and the one before it the length of the common prefix is taken by joining
   their turns. A sequence opens the nodes that are deeper than this.
3. Each candidate prefix, of a node or of the place where a sequence branches off, searches its
   extents in the sorted order by itself: the nearest places to the left and to the right where
   the common prefix is shorter. That is a binary search over a sparse table of range minima.
   Tables are made for blocks of places; a search that leaves its block goes on in the table of
   the minima of blocks, by the same method, and ends in the block found there.
4. The interval of a node gives all its figures: members and leaves as differences of running
   sums, the smallest member as a range minimum of another sparse table, savings of the subtree
   as differences of running sums over the nodes that each sequence opens.

Running sums and searches go by blocks, so neither a long conversation nor a frequent one lies
in one task. Only the ids of equal conversations, whose digest is one sequential hash, pass
through one task, as joined texts of thousands of ids each and without being kept.

Defined cases: null roles and texts are empty. A null turn comes first; rows of the same turn are
ordered by role and text, and repeated rows are turns like any other. Rows without a conversation
id are left out. An empty table has no conversation, so no node, not even the root. Texts of any
length are hashed whole. Other columns, of any name, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.storage import store

WORD = "[^\\x20\\x09-\\x0D]+"
#: Turns, or ranks of runs, that are ranked together.
RUN = 16
#: Places whose sparse table one task makes, and depths that it searches for.
BLOCK = 1024
SLICE = 4096


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``name``: the number of each row in this order, from 0.

    Rows are numbered within the partitions of one sort; there are few partitions to add up."""
    at, part = "_at", F.shiftright("_at", 33)
    sorted_rows = store(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()))
    parts = sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    met = sorted_rows.withColumn("_part", part).join(F.broadcast(parts), "_part")
    return met.withColumn(name, F.col(at).bitwiseAND((1 << 33) - 1) + F.col("_before")).drop(at, "_part", "_before")


def running(df: DataFrame, keys: list[str], place: str, values: list[str], block: int = SLICE) -> DataFrame:
    """``df`` with ``<value>_to`` for each value: its sum up to ``place``, inclusive, within ``keys``."""
    blocked = df.withColumn("_block", F.floor(F.col(place) / block))
    sums = blocked.groupBy(*keys, "_block").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, "_block", *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}") for v in values])
    inside = Window.partitionBy(*keys, "_block").orderBy(place)
    met = blocked.join(before, [*keys, "_block"])
    return met.select(*df.columns, *[(F.sum(v).over(inside) + F.col(f"_{v}")).alias(f"{v}_to") for v in values])


# --- conversations as sequences -----------------------------------------------


def ordered_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``conv, depth`` (from 1)``, a, b`` (hashes of role and text)``, words`` of every turn, and
    ``conv, size`` of every conversation."""
    said, spoken = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    narrow = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said.alias("role"), spoken.alias("text")
    )
    hashed = narrow.select(
        "conv", "turn", "role", "text", F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("second"), "text", "role").alias("b"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    placed = store(numbered(hashed, order, "at").select("conv", "at", "a", "b", "words"))
    sizes = store(placed.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("size")))
    turns = placed.join(sizes, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("depth"), "a", "b", "words")
    return turns, sizes.select("conv", "size")


def branched_off(turns: DataFrame, sizes: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first conversation of their family.

    Of conversation ``c`` these are the first ``crc32(c) % most`` turns of ``c - c % family``, as
    far as there are any; its own go on behind as many."""
    own = F.crc32(F.col("conv").cast("string")) % most
    plans = sizes.select("conv", "size", (F.col("conv") - F.col("conv") % family).alias("head"), own.alias("taken"))
    heads = sizes.select(F.col("conv").alias("head"), F.col("size").alias("head_size"))
    given = F.least("taken", F.coalesce("head_size", F.lit(0)))
    plans = store(plans.join(heads, "head", "left").select("conv", "size", "head", "taken", given.alias("given")))
    opening = turns.where((F.col("depth") < most) & (F.col("conv") % family == 0))
    opening = opening.withColumnRenamed("conv", "head").join(plans.select("conv", "head", "given"), "head")
    opening = opening.where("depth <= given").select(*turns.columns)
    rest = turns.join(plans.select("conv", "taken", "given"), "conv").where("depth > taken")
    rest = rest.withColumn("depth", F.col("depth") - F.col("taken") + F.col("given")).select(*turns.columns)
    left = F.greatest(F.col("size") - F.col("taken"), F.lit(0))
    return opening.unionByName(rest), plans.select("conv", (F.col("given") + left).alias("size"))


def _sort_keys(turns: DataFrame, sizes: DataFrame, run: int) -> DataFrame:
    """``conv, size, key``: arrays that sort as the conversations do, equal for equal ones."""
    listed = F.array_sort(F.collect_list(F.struct("depth", "a", "b")))
    at = F.floor((F.col("depth") - 1) / run).alias("at")
    keys = turns.groupBy("conv", at).agg(F.flatten(F.transform(listed, lambda t: F.array(t["a"], t["b"]))).alias("key"))
    longest = sizes.agg(F.max("size")).first()[0] or 0
    while longest > run:
        keys = store(keys)
        ranks = numbered(keys.select("key").distinct(), ["key"], "rank")
        listed = F.array_sort(F.collect_list(F.struct("at", "rank")))
        up = F.floor(F.col("at") / run).alias("up")
        keys = keys.join(ranks, "key").groupBy("conv", up).agg(listed["rank"].alias("key")).withColumnRenamed("up", "at")
        longest = -(-longest // run)
    none = F.array().cast("array<bigint>")
    return sizes.join(keys.select("conv", "key"), "conv", "left").select("conv", "size", F.coalesce("key", none).alias("key"))


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of a sequence as one text."""
    for batch in batches:
        pos, conv = (batch.column(c).to_numpy() for c in ("pos", "conv"))
        if not len(pos):
            continue
        begin = np.flatnonzero(np.append(True, pos[1:] != pos[:-1]))
        texts = [",".join(map(str, part.tolist())) for part in np.split(conv, begin[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(pos[begin]), pa.array(conv[begin]), pa.array(texts)], names=["pos", "conv", "ids"])


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per sequence from its texts in order, which are passed on to the hash one by one."""
    now, digest = None, None

    def row(pos, digest):
        return pa.RecordBatch.from_arrays([pa.array([pos], pa.int64()), pa.array([digest.hexdigest()])], names=["pos", "ends"])

    for batch in batches:
        for pos, ids in zip(batch.column("pos").to_pylist(), batch.column("ids").to_pylist()):
            if pos == now:
                digest.update(b",")
            else:
                if digest:
                    yield row(now, digest)
                now, digest = pos, hashlib.sha256()
            digest.update(ids.encode())
    if digest:
        yield row(now, digest)


def _member_digests(members: DataFrame) -> DataFrame:
    """``pos, ends``: SHA-256 of the ascending ids of the conversations that are a sequence."""
    spread = members.select("pos", "conv").repartitionByRange("pos", "conv").sortWithinPartitions("pos", "conv")
    texts = spread.mapInArrow(_id_texts, "pos bigint, conv bigint, ids string")
    dealt = texts.repartition("pos").sortWithinPartitions("pos", "conv")
    return dealt.select("pos", "ids").mapInArrow(_id_digests, "pos bigint, ends string")


# --- sparse tables ------------------------------------------------------------


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Least of the next 1, 2, 4, ... values, for every place where there are as many."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def first_below(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place from ``at`` on with a value below ``depth``, or the number of values."""
    at, n = at.copy(), len(levels[0])
    for j in range(len(levels) - 1, -1, -1):
        room = at + (1 << j) <= n
        jump = room & (levels[j][np.where(room, at, 0)] >= depth)
        at[jump] += 1 << j
    return at


def _values(table: pa.Table) -> tuple[int, np.ndarray]:
    """The first place of a block and its values in order."""
    pos, value = (table.column(c).to_numpy() for c in ("pos", "value"))
    return int(pos.min()), value[np.argsort(pos)]


def _search_block(table: pa.Table, queries: pa.Table) -> pa.Table:
    names = ["pos", "depth", "ahead", "at"]
    queries = queries.select(names)
    found = np.full(queries.num_rows, -1)
    if table.num_rows and queries.num_rows:
        start, values = _values(table)
        at, depth = queries.column("at").to_numpy() - start, queries.column("depth").to_numpy()
        ahead = queries.column("ahead").to_numpy()
        n = len(values)
        inside = (at >= 0) & (at < n)
        for pick, seen, back in ((inside & ahead, values, False), (inside & ~ahead, values[::-1], True)):
            hit = first_below(_sparse(seen), n - 1 - at[pick] if back else at[pick], depth[pick])
            found[pick] = np.where(hit < n, start + (n - 1 - hit if back else hit), -1)
    return queries.append_column("found", pa.array(found, pa.int64(), mask=found < 0))


def _least_of_block(table: pa.Table, queries: pa.Table) -> pa.Table:
    queries = queries.select(["pos", "depth", "low", "high"])
    least = np.zeros(queries.num_rows, np.int64)
    if queries.num_rows:
        start, values = _values(table)
        levels = _sparse(values)
        low, high = (queries.column(c).to_numpy() - start for c in ("low", "high"))
        level = np.frexp(high - low + 1)[1] - 1
        for j in np.unique(level):
            one = level == j
            least[one] = np.minimum(levels[j][low[one]], levels[j][high[one] + 1 - (1 << j)])
    return queries.select(["pos", "depth"]).append_column("least", pa.array(least))


def _meet(table: DataFrame, queries: DataFrame, place: str, fn, schema: str, block: int) -> DataFrame:
    """Queries with the block of the table that ``place`` lies in; many depths are dealt out."""
    asked = queries.withColumn("block", F.floor(F.col(place) / block)).withColumn("slice", F.floor(F.col("depth") / SLICE))
    wanted = asked.select(F.col("block").alias("at_block"), F.col("slice").alias("at_slice")).distinct()
    dealt = table.select("pos", "value", F.floor(F.col("pos") / block).alias("at_block")).join(wanted, "at_block")
    dealt = dealt.select("pos", "value", F.col("at_block").alias("block"), F.col("at_slice").alias("slice"))
    return dealt.groupBy("block", "slice").cogroup(asked.groupBy("block", "slice")).applyInArrow(fn, schema)


def _minima(table: DataFrame, block: int) -> DataFrame:
    return store(table.groupBy(F.floor(F.col("pos") / block).alias("at")).agg(F.min("value").alias("value"))).withColumnRenamed(
        "at", "pos"
    )


def nearest_below(table: DataFrame, queries: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``pos, depth, ahead, found``: the nearest place from ``at`` on, ``ahead`` or back, whose
    value is below ``depth``; null if there is none.

    ``table``: ``pos`` (0 to n - 1)``, value``; ``queries``: ``pos, depth, ahead, at``."""
    schema = "pos bigint, depth bigint, ahead boolean, at bigint, found bigint"
    probed = store(_meet(table, queries, "at", _search_block, schema, block))
    if n <= block:
        return probed.drop("at")
    at = F.floor(F.col("at") / block) + F.when(F.col("ahead"), 1).otherwise(-1)
    missed = probed.where("found IS NULL").select("pos", "depth", "ahead", at.alias("at"))
    blocks = nearest_below(_minima(table, block), missed, -(-n // block), block)
    inside = F.col("found") * block + F.when(F.col("ahead"), 0).otherwise(block - 1)
    again = blocks.where("found IS NOT NULL").select("pos", "depth", "ahead", inside.alias("at"))
    parts = [probed.where("found IS NOT NULL"), _meet(table, again, "at", _search_block, schema, block)]
    return parts[0].union(parts[1]).drop("at").unionByName(blocks.where("found IS NULL"))


def range_minima(table: DataFrame, queries: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``pos, depth, least``: the least value from ``low`` to ``high``, inclusive.

    ``table``: ``pos, value``; ``queries``: ``pos, depth`` (which name them)``, low, high``."""
    first, last = F.floor(F.col("low") / block), F.floor(F.col("high") / block)

    def part(low: Column, high: Column) -> Column:
        return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    whole = F.array(part(F.col("low"), F.col("high")))
    ends = F.array(part(F.col("low"), first * block + block - 1), part(last * block, F.col("high")))
    parts = queries.select("pos", "depth", F.explode(F.when(first == last, whole).otherwise(ends)).alias("p"))
    parts = parts.select("pos", "depth", "p.low", "p.high")
    found = _meet(table, parts, "low", _least_of_block, "pos bigint, depth bigint, least bigint", block)
    if n > block:
        wide = queries.where(last - first > 1).select("pos", "depth", (first + 1).alias("low"), (last - 1).alias("high"))
        found = found.unionByName(range_minima(_minima(table, block), wide, -(-n // block), block))
    return found.groupBy("pos", "depth").agg(F.min("least").alias("least"))


# --- the trie -----------------------------------------------------------------


def _sequences(turns: DataFrame, sizes: DataFrame, run: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sequences (``pos, conv, n, size, common, leaf``), their turns and the digests of their ids."""
    keyed = store(_sort_keys(turns, sizes, run))
    same = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("size").alias("size"))
    placed = store(numbered(same, ["key"], "pos"))
    digests = _member_digests(keyed.join(placed.select("key", "pos"), "key"))
    said = store(turns.join(placed.select("conv", "pos"), "conv").select("pos", "depth", "a", "b", "words"))

    one, two = F.struct("a", "b").alias("now"), F.struct("a", "b").alias("then")
    before = said.select((F.col("pos") + 1).alias("pos"), "depth", two)
    differ = said.select("pos", "depth", one).join(before, ["pos", "depth"], "left").where(~F.col("now").eqNullSafe(F.col("then")))
    shared = differ.groupBy("pos").agg((F.min("depth") - 1).alias("shared"))
    # the first sequence has none before it, and opens the root
    common = F.when(F.col("pos") == 0, -1).otherwise(F.col("shared")).cast("long")
    known = store(placed.drop("key").join(shared, "pos", "left").withColumn("common", common).drop("shared"))
    behind = known.select((F.col("pos") - 1).alias("pos"), F.col("common").alias("next_common"))
    goes_on = F.coalesce(F.col("next_common") >= F.col("size"), F.lit(False))
    known = known.join(behind, "pos", "left").withColumn("leaf", F.when(goes_on, 0).otherwise(1).cast("long"))
    return known.drop("next_common"), said, digests


def prefix_trie(turns: DataFrame, sizes: DataFrame, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """Per distinct prefix: ``conv_id`` (its smallest member)``, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns``: ``conv, depth`` (from 1)``, a, b, words``; ``sizes``: ``conv, size`` of all
    conversations, those without turns too. ``saved_tokens`` are the words that members share
    with others, summed over the subtree."""
    turns = store(turns)
    sequences, said, digests = _sequences(turns, store(sizes), run)
    sequences = store(running(sequences, [], "pos", ["n", "leaf"]))
    total = sequences.count()

    # candidates: the nodes a sequence opens, and the prefix where it branches off
    deep = said.select("pos", "depth", "words").join(sequences.select("pos", "common"), "pos").where("depth >= common")
    root = sequences.where("common < 1").select("pos", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "common")
    candidates = store(deep.select("pos", "depth", "words", "common").unionByName(root))

    table = store(sequences.select("pos", F.col("common").alias("value")))
    asked = candidates.select("pos", "depth", F.explode(F.array(F.lit(True), F.lit(False))).alias("ahead"))
    asked = asked.withColumn("at", F.when(F.col("ahead"), F.col("pos") + 1).otherwise(F.col("pos")))
    near = nearest_below(table, asked, total, block).groupBy("pos", "depth").agg(
        F.max(F.when(~F.col("ahead"), F.col("found"))).alias("low"),
        (F.coalesce(F.max(F.when(F.col("ahead"), F.col("found"))), F.lit(total)) - 1).alias("high"),
    )
    extents = store(candidates.join(near, ["pos", "depth"]))
    least = range_minima(sequences.select("pos", F.col("conv").alias("value")), extents.select("pos", "depth", "low", "high"), total, block)

    until = sequences.select(F.col("pos").alias("high"), F.col("n_to").alias("n_high"), F.col("leaf_to").alias("leaf_high"))
    since = sequences.select(
        F.col("pos").alias("low"), (F.col("n_to") - F.col("n")).alias("n_low"), (F.col("leaf_to") - F.col("leaf")).alias("leaf_low")
    )
    counted = extents.join(least, ["pos", "depth"]).join(until, "high").join(since, "low")
    counted = store(
        counted.select(
            "pos", "depth", "words", "common", "low", "high", F.col("least").alias("conv_id"),
            (F.col("n_high") - F.col("n_low")).alias("n_convs"), (F.col("leaf_high") - F.col("leaf_low")).alias("n_leaves"),
        )
    )

    # a node's interval starts where it is opened
    nodes = counted.where("low = pos AND depth > common")
    saved = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    saved = store(running(saved.select("pos", "depth", "saved"), ["pos"], "depth", ["saved"]))
    by_sequence = saved.groupBy("pos").agg(F.sum("saved").alias("saved"))
    # running sums over the nodes in the order of sequences, then of depth
    upto = store(running(sequences.select("pos").join(by_sequence, "pos", "left").fillna(0, ["saved"]), [], "pos", ["saved"]))
    here = saved.select("pos", "depth", "saved", F.col("saved_to").alias("saved_here"))
    start = upto.select("pos", (F.col("saved_to") - F.col("saved")).alias("saved_low"))
    end = upto.select(F.col("pos").alias("high"), F.col("saved_to").alias("saved_high"))
    inner = nodes.join(here, ["pos", "depth"]).join(start, "pos").join(end, "high")
    inner = inner.withColumn("saved_tokens", F.col("saved_high") - F.col("saved_low") - F.col("saved_here") + F.col("saved"))

    above = counted.select("pos", (F.col("depth") + 1).alias("depth"), F.col("low").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = inner.join(above, ["pos", "depth"], "left")
    children = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("pos"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    ended = sequences.select("pos", F.col("size").alias("depth")).join(digests, "pos")
    out = linked.join(children, ["pos", "depth"], "left").join(ended, ["pos", "depth"], "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends", F.lit(nobody)).alias("ends_sha256"),
    )


def conversation_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of conversations as they stand."""
    return prefix_trie(*ordered_turns(rows, conv, turn, role, text))
