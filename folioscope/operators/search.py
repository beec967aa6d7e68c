"""Exact similarity search and re-ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.queries import (
    data_driven_relevance,
    query_entities,
    query_focus,
    rag_relevance,
    search_text,
    section_weight,
)

# Queries are cut into slices, chunks into parts of so many bytes of vectors, whatever their length.
SLICE_BYTES = 64 << 20
PART_BYTES = 128 << 20
# A task turns so many bytes of chunk vectors into a matrix at a time.
BATCH_BYTES = 8 << 20

QUERY_KEYS = ["query_id", "variant"]


def _scorer(hit_schema: T.StructType, tile: int = 256, batch_bytes: int = BATCH_BYTES):
    """Best chunks of each query among a stream of chunk batches.

    Nested functions only: executors get them by value.
    """

    from types import SimpleNamespace

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(hit_schema)

    def best(query_rows):
        """``query_rows``: (query_id, variant, vector, k).  ``add`` takes ids and a matrix."""
        import heapq

        import numpy as np

        vectors = np.asarray([r[2] for r in query_rows], dtype=np.float64)
        limits = [r[3] for r in query_rows]
        kept = [[] for _ in query_rows]  # heaps of at most k (score, reversed id) entries
        floor = np.full(len(query_rows), -np.inf)

        class Last:
            """Orders ids downwards, so that of equal scores the smaller id stays."""

            __slots__ = ("id",)

            def __init__(self, id):
                self.id = id

            def __lt__(self, other):
                return self.id > other.id

        def add(ids, matrix):
            for at in range(0, len(query_rows), tile):
                scores = vectors[at : at + tile] @ matrix.T
                # The fast product only preselects, with a margin for its rounding;
                # what is compared and returned is summed in a fixed order, so that
                # results do not depend on how rows fall into batches.
                near = scores >= floor[at : at + tile, None] - 1e-9
                for row in np.flatnonzero(near.any(axis=1)):
                    q = at + int(row)
                    k, heap = limits[q], kept[q]
                    candidates = np.flatnonzero(near[row])
                    if len(candidates) > k:
                        least = np.partition(scores[row, candidates], -k)[-k]
                        candidates = candidates[scores[row, candidates] >= least - 1e-9]
                    products = matrix[candidates] * vectors[q]
                    exact = np.add.accumulate(products, axis=1)[:, -1]
                    for i, score in zip(candidates.tolist(), exact.tolist()):
                        entry = (score, Last(ids[i]))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif heap[0] < entry:
                            heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        floor[q] = heap[0][0]

        def rows():
            for (query_id, variant, _, k), heap in zip(query_rows, kept):
                for score, last in heap:
                    yield query_id, variant, last.id, score, k

        return SimpleNamespace(add=add, rows=rows)

    def stretches(lengths):
        """Places at which to cut rows of so many values, into stretches of about ``batch_bytes``."""
        import numpy as np

        ends = np.cumsum(lengths)
        places, at = [0], 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            at = max(at + 1, int(np.searchsorted(ends, before + batch_bytes // 8, side="right")))
            places.append(at)
        return places

    def usable(vectors):
        """Row numbers and vectors, by their length, of those without a hole, so many bytes at
        a time: a batch may hold any number of values."""
        import numpy as np
        import pyarrow.compute as pc

        lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        places = stretches(lengths)
        for first, last in zip(places, places[1:]):
            sizes = lengths[first:last]
            ends = np.cumsum(sizes)
            flat = vectors.slice(first, last - first).flatten().to_numpy(zero_copy_only=False)
            holes = np.concatenate([[0], np.cumsum(~np.isfinite(flat), dtype=np.int32)])
            sound = (sizes > 0) & (holes[ends] == holes[ends - sizes])
            for n in np.unique(sizes[sound]).tolist():
                rows = np.flatnonzero(sound & (sizes == n))
                yield n, rows + first, flat[(ends[rows] - n)[:, None] + np.arange(n)].astype(np.float64)

    def asked(queries):
        """Query rows by the length of their vector."""
        keys = list(zip(*[queries.column(c).to_pylist() for c in ("query_id", "variant", "k")]))
        found = {}
        for length, rows, vectors in usable(queries.column("embedding").combine_chunks()):
            found.setdefault(length, []).extend((*keys[r][:2], v, keys[r][2]) for r, v in zip(rows.tolist(), vectors))
        return {length: best(rows) for length, rows in found.items()}

    def score(searches, ids, vectors):
        """Vectors meet queries of their length."""
        for length, rows, matrix in usable(vectors):
            if length in searches:
                searches[length].add([ids[i] for i in rows.tolist()], matrix)

    def hits(searches):
        import pyarrow as pa

        columns = list(zip(*(row for search in searches.values() for row in search.rows())))
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)] if columns else [pa.nulls(0, f.type) for f in schema]
        return pa.Table.from_arrays(arrays, schema=schema)

    def score_pair(chunks, queries):
        """One slice of queries and one part of the chunks."""
        if not (queries.num_rows and chunks.num_rows):
            return schema.empty_table()
        searches = asked(queries)
        for batch in chunks.select(["chunk_id", "embedding"]).to_batches():
            score(searches, batch.column("chunk_id").to_pylist(), batch.column("embedding"))
        return hits(searches)

    def score_scan(batches):
        """The rows of a scan, the first of which brings the queries; hands on the best of them."""
        import pyarrow as pa

        searches = None
        for batch in batches:
            if searches is None and batch.num_rows:
                brought = batch.column("_asked").slice(0, 1).flatten()
                searches = asked(pa.Table.from_arrays(brought.flatten(), names=[f.name for f in brought.type]))
            if searches:
                score(searches, batch.column("chunk_id").to_pylist(), batch.column("embedding"))
        yield from hits(searches or {}).to_batches()

    return SimpleNamespace(score_pair=score_pair, score_scan=score_scan)


def similarity_topk(
    queries: DataFrame,
    chunks: DataFrame,
    slice_bytes: int = SLICE_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The ``k`` most similar chunks of each query row by dot product.

    ``queries``: ``query_id, variant, embedding, k``; ``chunks``: ``chunk_id,
    embedding``, with unit vectors.  Equal scores are ordered by ``chunk_id``.
    Result: ``query_id, variant, chunk_id, similarity_score, rank``.

    Every query has to meet every chunk, but no pair becomes a row: a task scores chunk vectors
    against queries with matrix products, some megabytes at a time, and hands on the best ``k`` of
    each query.  Queries are cut by hash into slices of at most about ``slice_bytes`` of vectors; how
    many there are is computed in the plan, so no job runs before the caller's.

    * The first slice, all queries unless there are very many, is broadcast as one row.  It meets the
      first row of every partition, so chunk vectors are scored where they are scanned.
    * Further slices go to parts of the chunks, of ``part_bytes`` each; a chunk vector is shuffled
      once for every such slice.  Without any, adaptive execution drops this branch unread.

    Vectors meet vectors of their length.  One that is null, empty or holds a null or a value
    that isn't finite meets none.
    """
    vectors = chunks.select("chunk_id", "embedding").where(F.col("embedding").isNotNull())
    wanted = queries.select(*QUERY_KEYS, "embedding", F.col("k").cast("int").alias("k")).where(
        F.col("embedding").isNotNull() & (F.col("k") > 0)
    )
    hit_schema = T.StructType(
        [
            wanted.schema["query_id"],
            wanted.schema["variant"],
            vectors.schema["chunk_id"],
            T.StructField("similarity_score", T.DoubleType()),
            T.StructField("k", T.IntegerType()),
        ]
    )

    scorer = _scorer(hit_schema)

    def at_least_one(n: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(n, F.lit(0))).cast("int"), F.lit(1))

    one = F.lit(1).alias("_one")
    vector_bytes = F.sum(F.size("embedding").cast("long")) * 8
    slices = wanted.agg(at_least_one(vector_bytes / slice_bytes).alias("slices")).select(one, "*")  # one row
    dealt = wanted.select(one, "*").join(F.broadcast(slices), "_one")
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64(*QUERY_KEYS), "slices").cast("int"))

    first = F.collect_list(F.when(F.col("slice") == 0, F.struct(*QUERY_KEYS, "embedding", "k")))
    asked = dealt.agg(first.alias("_asked")).select(F.lit(True).alias("_leads"), "_asked")
    leading = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    led = vectors.withColumn("_first", leading).join(F.broadcast(asked), F.col("_first") == F.col("_leads"), "left")
    scanned = led.select("chunk_id", "embedding", "_asked").mapInArrow(scorer.score_scan, hit_schema)

    # one row if there are further slices, none otherwise
    more = slices.where("slices > 1")
    parts = vectors.select(one, "embedding").join(F.broadcast(more), "_one")
    parts = parts.agg(at_least_one(vector_bytes / part_bytes).alias("parts")).select(one, "*")
    counts = F.broadcast(more.join(F.broadcast(parts), "_one"))

    def every(from_: int, n: str) -> Column:
        return F.explode(F.sequence(F.lit(from_), F.col(n) - 1))

    left = vectors.select(one, "*").join(counts, "_one").select(
        "chunk_id", "embedding", F.pmod(F.xxhash64("chunk_id"), "parts").cast("int").alias("part"), every(1, "slices").alias("slice")
    )
    right = dealt.drop("slices").where("slice > 0").join(counts, "_one").select(
        *QUERY_KEYS, "embedding", "k", "slice", every(0, "parts").alias("part")
    )
    met = left.groupBy("slice", "part").cogroup(right.groupBy("slice", "part")).applyInArrow(scorer.score_pair, hit_schema)
    order = Window.partitionBy(*QUERY_KEYS).orderBy(F.desc("similarity_score"), "chunk_id")
    ranked = scanned.unionByName(met).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= F.col("k")).drop("k")


def merge_variants(hits: DataFrame) -> DataFrame:
    """Best similarity per query and chunk over all variants."""
    return hits.groupBy("query_id", "chunk_id").agg(
        F.max("similarity_score").alias("similarity_score")
    )


def attach_chunks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Add the chunk columns and the section weight to hits.

    Adaptive execution knows how many bytes of hits there are and broadcasts few of them, so
    that the chunk table is read in place.
    """
    columns = chunks.select("chunk_id", "content", "summary", "section_type", "page_range")
    return columns.join(hits, "chunk_id").withColumn("section_weight", section_weight(F.col("section_type")))


def with_query_insights(queries: DataFrame) -> DataFrame:
    """Adds the entities and the focus of ``query``, once per query rather than per hit."""
    return queries.select(
        "*",
        query_entities(F.col("query")).alias("entities"),
        query_focus(F.col("query")).alias("focus"),
    )


def _with_search_text(hits: DataFrame) -> DataFrame:
    return hits.withColumn("_text", search_text(F.col("content"), F.col("summary")))


def boost_by_query(hits: DataFrame) -> DataFrame:
    """Adds ``relevance_score`` from section, person, concept and focus boosts.
    Needs ``entities`` and ``focus`` beside the chunk columns."""
    score = data_driven_relevance(F.col("entities"), F.col("focus"), F.col("_text"))
    return _with_search_text(hits).withColumn("relevance_score", score).drop("_text")


def boost_by_text(hits: DataFrame) -> DataFrame:
    """Adds ``relevance_score`` from section weight, persons and terms in the text."""
    score = rag_relevance(F.col("_text"))
    return _with_search_text(hits).withColumn("relevance_score", score).drop("_text")


def best_hits(hits: DataFrame, n: str = "n") -> DataFrame:
    """Hits of each query by relevance, similarity and chunk id, cut to its ``n``."""
    order = Window.partitionBy("query_id").orderBy(
        F.desc("relevance_score"), F.desc("similarity_score"), "chunk_id"
    )
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col(n))


def improvement_factor() -> Column:
    relevance, similarity = F.col("relevance_score"), F.col("similarity_score")
    return F.when((relevance != 0) & (similarity > 0), relevance / similarity).otherwise(
        F.lit(1.0)
    )


def result_count(n: Column, default: int) -> Column:
    return F.coalesce(n.cast("int"), F.lit(default))


