"""Query rewriting, exact search, boosting and retrieval."""

import random

import pytest
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions import queries as q
from folioscope.operators import analytics, search
from folioscope.operators.vectorize import fit_vectorizer, text_encoder, vectorize
from folioscope.plans import retrieval

TEXTS = [
    "In Bangui Yekatom gave the order to attack Muslim homes",
    "war crimes, evidence of persecution and the sentence",
    "Anti-Balaka fighters whom Yekatom led killed civilians",
    "ngaissona and Ngaïssona in the Central African Republic",
    "guilty verdict, years of punishment, murder, war crime",
    "nothing to see",
    "YEKATOM EVIDENTIARY ELEMENTS",
]


def apply(spark, fn, texts=TEXTS):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t")).alias("r")).collect()]


def test_expansion_order_and_limit(spark):
    got = apply(spark, q.expand_query)
    assert got[0] == [TEXTS[0], TEXTS[0] + " Alfred Yekatom", TEXTS[0].replace("Yekatom", "accused")]
    assert got[1][:3] == [
        TEXTS[1],
        TEXTS[1].replace("war crimes", "war crime"),
        TEXTS[1].replace("war crimes", "violations of the laws of war"),
    ]
    assert len(got[1]) == 5
    # without the diaeresis the name still triggers, but only the exact name is replaced
    assert got[3][1] == TEXTS[3] + " Patrice-Edouard Ngaïssona"
    assert got[3][2] == "ngaissona and co-accused in the Central African Republic"
    assert got[5] == [TEXTS[5]]
    # a replacement that changes nothing is the query itself again
    assert apply(spark, q.expand_query, ["yekatom"]) == [["yekatom", "yekatom Alfred Yekatom"]]


def test_enhancement_grows_term_by_term(spark):
    got = apply(spark, q.enhance_query)
    assert got[0] == TEXTS[0].lower() + " defendant Yekatom"
    # "persecution" adds "persecute"; "sentence" adds "sentencing"
    assert got[1] == TEXTS[1] + " war crime persecute sentencing"
    # the text added for one term can contain a later one
    assert apply(spark, q.enhance_query, ["anti-balaka command"]) == [
        "anti-balaka command anti balaka instruct"
    ]
    assert got[3].endswith(" defendant Ngaïssona")


def test_focus_and_entities(spark):
    focus = apply(spark, q.query_focus)
    assert focus[0]["person"] == pytest.approx(0.3) and focus[0]["evidence"] == 0
    assert focus[4]["sentence"] == 1.0 and focus[4]["legal_concept"] == pytest.approx(0.5)
    entities = apply(spark, q.query_entities)
    assert entities[0].asDict() == {
        "persons": ["Yekatom"], "legal_concepts": ["Muslim"],
        "locations": ["Bangui"], "actions": ["order", "attack"],
    }
    # "Central African Republic" is found; "CAR" is not a part of it
    assert entities[3]["locations"] == ["Central African Republic"]


def test_lookups(spark):
    assert apply(spark, q.section_weight, ["VERDICT", "APPLICABLE_LAW", "HEADER"]) == [1.5, 1.0, 0.5]
    assert apply(spark, q.legal_expansions, ["TORTURE", "x"]) == [fv.LEGAL_EXPANSIONS["torture"], []]


def vectors(spark, n, dims, seed, duplicate=False):
    rng = random.Random(seed)
    rows = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(n)]
    if duplicate:
        rows = [rows[i // 3] for i in range(n)]
    return rows, spark.createDataFrame(
        [(i, r) for i, r in enumerate(rows)], "chunk_id bigint, embedding array<float>"
    )


def brute_force(spark, queries, chunks):
    """Sums in order of the dimensions, like the search."""
    qs, cs = queries.collect(), chunks.collect()
    want = set()
    for row in qs:
        scored = []
        for c in cs:
            total = 0.0
            for a, b in zip(row["embedding"], c["embedding"]):
                total += a * b
            scored.append((-total, c["chunk_id"]))
        for rank, (score, chunk) in enumerate(sorted(scored)[: row["k"]], 1):
            want.add((row["query_id"], row["variant"], chunk, rank, -score))
    return want


@pytest.mark.parametrize("limit, part", [(1 << 20, 100_000), (100, 40), (1, 7)])
def test_topk_agrees_with_brute_force(spark, limit, part):
    """One slice and part, a few and many of both.  Every vector occurs three times, so ties
    at the cut are frequent."""
    _, chunks = vectors(spark, 200, 8, 1, duplicate=True)
    rows, _ = vectors(spark, 10, 8, 2)
    queries = spark.createDataFrame(
        [(i % 5, i // 5, r, 1 + 3 * i) for i, r in enumerate(rows)],
        "query_id bigint, variant int, embedding array<float>, k int",
    )
    hits = search.similarity_topk(queries, chunks.repartition(5), limit, part)
    got = {
        (r["query_id"], r["variant"], r["chunk_id"], r["rank"], r["similarity_score"])
        for r in hits.collect()
    }
    assert got == brute_force(spark, queries, chunks)


def test_topk_with_string_ids_few_chunks_and_no_queries(spark):
    chunks = spark.createDataFrame(
        [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None), ("d", [0.0, 1.0])],
        "chunk_id string, embedding array<float>",
    )
    schema = "query_id string, variant int, embedding array<float>, k int"
    queries = spark.createDataFrame([("q", 0, [1.0, 0.5], 9), ("none", 0, None, 5), ("zero", 0, [1.0, 1.0], 0)], schema)
    got = search.similarity_topk(queries, chunks).orderBy("rank").collect()
    assert [(r["query_id"], r["chunk_id"], r["similarity_score"]) for r in got] == [
        ("q", "a", 1.0), ("q", "b", 1.0), ("q", "d", 0.5),
    ]
    assert search.similarity_topk(spark.createDataFrame([], schema), chunks).count() == 0


def test_a_batch_is_scored_some_megabytes_at_a_time():
    """A batch of 10,000 vectors of 1,024 values is 41 MB; beside it, not more than that is held at once."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    n, length = 10_000, 1024
    vectors = np.random.default_rng(1).random((n, length), dtype=np.float32)
    ends = pa.array(np.arange(0, n * length + 1, length, dtype=np.int32))
    query = {"query_id": 1, "variant": 0, "embedding": vectors[77].tolist(), "k": 5}
    asked = pa.array([[query], *[None] * (n - 1)], pa.list_(pa.struct([("query_id", pa.int64()), ("variant", pa.int32()), ("embedding", pa.list_(pa.float32())), ("k", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.ListArray.from_arrays(ends, pa.array(vectors.reshape(-1))), asked], names=["chunk_id", "embedding", "_asked"])
    names = {"query_id": T.LongType(), "variant": T.IntegerType(), "chunk_id": T.LongType(), "similarity_score": T.DoubleType(), "k": T.IntegerType()}
    scorer = search._scorer(T.StructType([T.StructField(c, t) for c, t in names.items()]))
    tracemalloc.start()
    try:
        found = pa.Table.from_batches(scorer.score_scan(iter([batch]))).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 << 20
    best = np.argsort(-(vectors.astype(float) @ vectors[77].astype(float)))[:5]
    assert {r["chunk_id"] for r in found} == set(best.tolist())


def test_unusable_vectors_leave_the_others_alone(spark):
    nan = float("nan")
    chunks = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, nan]), (3, [1.0, 0.0, 0.0]), (4, []), (5, None), (6, [0.5, None])],
        "chunk_id bigint, embedding array<float>",
    )
    vectors = [[1.0, 1.0], [nan, 1.0], [2.0, 0.0, 0.0], [1.0], [], None, [None, 1.0]]
    queries = spark.createDataFrame(
        [(i, 0, v, 3) for i, v in enumerate(vectors)], "query_id bigint, variant int, embedding array<float>, k int"
    )
    got = search.similarity_topk(queries, chunks).collect()
    assert {(r["query_id"], r["chunk_id"], r["similarity_score"]) for r in got} == {(0, 1, 1.0), (2, 3, 2.0)}


def test_chunk_vectors_are_scored_where_they_lie(spark, tmp_path):
    """Queries of one slice are broadcast: nothing with an embedding is exchanged or read twice."""
    spark.range(500).select(
        F.col("id").alias("chunk_id"), F.array(*[F.rand(i).cast("float") for i in range(16)]).alias("embedding")
    ).repartition(6).write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    queries = spark.createDataFrame([(i, 0, [float(i)] * 16, 3) for i in range(4)], "query_id bigint, variant int, embedding array<float>, k int")
    hits = search.similarity_topk(queries, chunks)
    assert {(r["query_id"], r["variant"], r["chunk_id"], r["rank"], r["similarity_score"]) for r in hits.collect()} == brute_force(spark, queries, chunks)
    plan = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the branch of further slices has shrunk to empty relations
    assert plan.count("FileScan") == 1 and "EmptyRelation" in plan


def test_planning_a_search_runs_no_job(spark):
    _, chunks = vectors(spark, 20, 4, 1)
    queries = spark.createDataFrame([(1, 0, [1.0, 0.0, 0.0, 0.0], 3)], "query_id bigint, variant int, embedding array<float>, k int")
    spark.sparkContext.setJobGroup("planning", "")
    hits = search.similarity_topk(queries, chunks)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == 0
    spark.sparkContext.setJobGroup("running", "")
    assert hits.count() == 3


CHUNKS = [
    (0, "Yekatom and a war crime", None, "VERDICT"),
    (1, "ngaïssona", "about Muslim victims", "SENTENCE"),
    (2, "yekatom persecution", "Yekatom", "EVIDENTIARY_CONSIDERATIONS"),
    (3, "plain text", "plain", "HEADER"),
    (4, "command and murder", "", "FINDINGS_OF_FACT"),
    (5, "other", None, "APPLICABLE_LAW"),
]


def corpus(spark):
    rng = random.Random(3)
    rows = [
        (i, [rng.random() for _ in range(4)], content, summary, section, f"{i}-{i}")
        for i, content, summary, section in CHUNKS
    ]
    return spark.createDataFrame(
        rows,
        "chunk_id bigint, embedding array<float>, content string, summary string, "
        "section_type string, page_range string",
    )


def encode(df):
    """A vector from the length of the text, enough to rank by."""
    n = F.length("query_text")
    return df.withColumn(
        "embedding",
        F.transform(F.array(n % 3, n % 5, n % 7, F.lit(1)), lambda x: x.cast("float")),
    )


def test_boosts_follow_the_rules(spark):
    chunks = corpus(spark)
    query = "sentence of Yekatom for persecution of Muslim witness"
    hits = spark.createDataFrame(
        [(1, query, i, 0.5) for i in range(6)],
        "query_id bigint, query string, chunk_id bigint, similarity_score double",
    )
    got = {
        r["chunk_id"]: r["relevance_score"]
        for r in search.boost_by_query(
            search.attach_chunks(search.with_query_insights(hits), chunks)
        ).collect()
    }
    assert got[0] == pytest.approx(0.5 * 1.5 * 1.25)
    assert got[1] == pytest.approx(0.5 * 1.4 * 1.15 * (1 + 0.4 * 0.3))
    assert got[2] == pytest.approx(0.5 * 1.25 * 1.15 * (1 + 0.3 * 0.2) * (1 + 0.2 * 0.2))
    assert got[3] == pytest.approx(0.25)
    assert got[4] == pytest.approx(0.5 * 1.3 * (1 + 0.3 * 0.2))
    assert got[5] == pytest.approx(0.5)
    rag = {
        r["chunk_id"]: r["relevance_score"]
        for r in search.boost_by_text(search.attach_chunks(hits, chunks)).collect()
    }
    assert rag[0] == pytest.approx(0.5 * 1.5 * 1.25)
    assert rag[2] == pytest.approx(0.5 * 1.25)
    assert rag[4] == pytest.approx(0.5 * 1.3 * 1.2)


def test_enhanced_search_cuts_to_each_query(spark):
    queries = spark.createDataFrame(
        [(1, TEXTS[0], 2), (2, TEXTS[1], None), (3, TEXTS[5], 1)],
        "query_id bigint, query string, num_results int",
    )
    got = retrieval.enhanced_search(queries, corpus(spark), encode)
    ranks = {}
    for r in got.collect():
        ranks.setdefault(r["query_id"], []).append(r)
    assert {k: len(v) for k, v in ranks.items()} == {1: 2, 2: 6, 3: 1}
    for rows in ranks.values():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        scores = [r["relevance_score"] for r in rows]
        assert scores == sorted(scores, reverse=True)
        for r in rows:
            assert r["improvement_factor"] == pytest.approx(r["relevance_score"] / r["similarity_score"])
    metrics = {r["query_id"]: r["result_count"] for r in analytics.search_metrics(got).collect()}
    assert metrics == {1: 2, 2: 6, 3: 1}


def test_default_counts_without_the_column(spark):
    queries = spark.createDataFrame([(1, TEXTS[0])], "query_id bigint, query string")
    assert retrieval.retrieve_contexts(queries, corpus(spark), encode, default_results=3).count() == 3
    assert retrieval.enhanced_search(queries, corpus(spark), encode).count() == 6


def test_text_vectors_find_the_same_text(spark):
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    base = spark.createDataFrame(texts, "chunk_id bigint, content string")
    model = fit_vectorizer(base, dimensions=256)
    queries = base.select(F.col("chunk_id").alias("query_id"), F.lit(0).alias("variant"), "content", F.lit(1).alias("k"))
    hits = search.similarity_topk(vectorize(queries, model, "content"), vectorize(base, model, "content"))
    got = hits.collect()
    assert all(r["query_id"] == r["chunk_id"] for r in got) and len(got) == len(TEXTS)
    assert all(r["similarity_score"] == pytest.approx(1, abs=1e-5) for r in got)


def test_the_rewritten_text_decides_what_is_found(spark, monkeypatch):
    texts = ["tribunal of the northern province", "quiet village by the river", "tribunal", "something else"]
    base = spark.createDataFrame(
        [(i, t, None, "HEADER", "1-1") for i, t in enumerate(texts)],
        "chunk_id bigint, content string, summary string, section_type string, page_range string",
    )
    model = fit_vectorizer(base, dimensions=256)
    queries = spark.createDataFrame([(1, "village", 1)], "query_id bigint, query string, num_results int")
    corpus_vectors, encoder = vectorize(base, model, "content"), text_encoder(model)
    assert [r["chunk_id"] for r in retrieval.retrieve_contexts(queries, corpus_vectors, encoder).collect()] == [1]
    monkeypatch.setattr(retrieval, "enhance_query", lambda query: F.concat(F.replace(query, F.lit("village"), F.lit("")), F.lit("tribunal")))
    assert [r["chunk_id"] for r in retrieval.retrieve_contexts(queries, corpus_vectors, encoder).collect()] == [2]


def test_a_failing_query_leaves_a_row_with_an_error(spark):
    queries = spark.createDataFrame([(1, TEXTS[0], 2), (2, None, 2), (3, "x", 2)], "query_id bigint, query string, num_results int")

    def cut_short(df):
        return encode(df).withColumn("embedding", F.when(F.col("query_id") == 3, F.slice("embedding", 1, 2)).otherwise(F.col("embedding")))

    rows = {r["query_id"]: r for r in retrieval.rag_rows(queries, corpus(spark), cut_short).collect()}
    assert rows[1]["error"] is None and rows[1]["num_contexts"] == 2
    assert all(rows[i]["error"] == retrieval.NO_HITS and rows[i]["prompt"]["human"] for i in (2, 3))


def test_metrics_of_hits_without_similarity(spark):
    results = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.5, 0.75)], "query_id int, similarity_score double, relevance_score double")
    assert {r["query_id"]: r["improvement_pct"] for r in analytics.search_metrics(results).collect()} == {1: None, 2: pytest.approx(50)}
