"""Chunk numbering and packing, with documents cut into very small blocks."""

import random

import pytest

from folioscope.operators import analytics, chunks, extraction, packing
from folioscope.operators.blocks import page_block


def greedy(tokens, budget):
    """Chunk number of each paragraph."""
    out, level, chunk = [], 0, 0
    for t in tokens:
        if level and level + t > budget:
            chunk, level = chunk + 1, 0
        level += t
        out.append(chunk)
    return out


def expected_numbers(rows, budget):
    """``rows``: (doc, page, section, tokens), one per page."""
    runs, firsts = {}, {}
    for doc, page, section, tokens in sorted(rows):
        for t in tokens:
            runs.setdefault((doc, section), []).append((page, t))
    want, used = {}, {}
    for (doc, section), items in sorted(runs.items(), key=lambda kv: (kv[0][0], kv[1][0][0])):
        numbers = greedy([t for _, t in items], budget)
        start = used.get(doc, 0)
        for (page, _), n in zip(items, numbers):
            want.setdefault((doc, page), []).append(start + n + 1)
        used[doc] = start + numbers[-1] + 1
    return want


def assigned(spark, rows, budget, size, group=packing.BLOCKS_PER_GROUP):
    df = spark.createDataFrame(
        rows, "doc_id bigint, page_no int, section_type string, tokens array<int>"
    )
    sectioned = df.withColumn("page_block", page_block(size))
    got = packing.assign_chunks(sectioned, df, budget, size, group).collect()
    return {(r["doc_id"], r["page_no"]): list(r["chunk_numbers"]) for r in got}


def test_pinned_example(spark):
    rows = [(1, i + 1, "S", [t]) for i, t in enumerate([400, 500, 200, 1200, 100, 900, 1])]
    got = assigned(spark, rows, 1000, 65536)
    assert [got[1, i][0] - 1 for i in range(1, 8)] == [0, 0, 1, 2, 3, 3, 4]


@pytest.mark.parametrize("size, budget", [(1, 37), (5, 100), (17, 100), (65536, 37)])
def test_packing_agrees_with_a_loop(spark, size, budget):
    rng = random.Random(size)
    rows = []
    for doc in range(12):
        page = 0
        for _ in range(rng.randint(1, 60)):
            page += rng.choice([1, 1, 1, 4])
            top = rng.choice([3, 60, 150])
            tokens = [rng.randint(1, top) for _ in range(rng.randint(0, 4))]
            rows.append((doc, page, rng.choice("ABC"), tokens))
    # all equal, and all larger than the budget
    rows += [(100, p, "A", [50]) for p in range(1, 40)] + [(101, p, "A", [300]) for p in range(1, 9)]
    assert assigned(spark, rows, budget, size) == expected_numbers(rows, budget)
    if size < 10:
        # functions of few blocks are composed, then many groups are walked through
        assert assigned(spark, rows, budget, size, group=3) == expected_numbers(rows, budget)


def test_packing_is_planned_once(spark):
    df = spark.createDataFrame([(1, 1, "S", [5])], "doc_id bigint, page_no int, section_type string, tokens array<int>")
    sectioned = df.withColumn("page_block", page_block(4))
    packed = packing.assign_chunks(sectioned, df, 100, 4)
    packed.collect()
    plan = packed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("MapInArrow chunks(") == 1
    assert "collect_list(steps" not in plan


def body(n, words):
    return f"[{n}] " + " ".join(["paragraph"] * words)


def test_main_text_chunks(make_pages):
    pages = make_pages(
        [
            (1, 1, body(1, 20) + "\n" + body(2, 20)),
            (1, 2, "VII. VERDICT\n" + body(3, 30)),
            (1, 3, "I. OVERVIEW\n" + body(4, 10)),
            (1, 4, "VII. VERDICT\n" + body(5, 10)),
        ]
    )
    for size in (1, 65536):
        got = chunks.main_text_chunks(pages, budget=52, pages_per_block=size).orderBy("chunk_id").collect()
        seen = [
            (r["chunk_id"], r["metadata"]["section_type"], r["token_count"],
             r["metadata"]["paragraph_range"], r["metadata"]["page_range"], r["metadata"]["pages"])
            for r in got
        ]
        assert seen == [
            ("main_chunk_0001", "HEADER", 52, "1-2", "1-1", [1]),
            ("main_chunk_0002", "VERDICT", 52, "3-5", "2-4", [2, 4]),
            ("main_chunk_0003", "OVERVIEW", 13, "4-4", "3-3", [3]),
        ]
        assert got[0]["content"] == body(1, 20) + "\n\n" + body(2, 20)
        assert [p["id"] for p in got[1]["paragraphs"]] == ["para_VERDICT_2_3", "para_VERDICT_4_5"]
        assert got[1]["metadata"]["section_title"] == "Verdict"
    limited = chunks.main_text_chunks(pages, budget=52, max_pages=2).collect()
    assert sorted(r["chunk_id"][-1] + r["metadata"]["page_range"] for r in limited) == ["11-1", "22-2"]
    flat = chunks.flatten_chunks(chunks.main_text_chunks(pages))
    assert flat.columns == [
        "doc_id", "chunk_id", "content", "token_count", "case_name", "case_number", "chamber", "date",
        "section_type", "section_title", "paragraph_count", "page_range", "extraction_quality",
    ]


def test_reports_shuffle_no_text(make_pages):
    pages = make_pages([(1, i, f"I. OVERVIEW\n[{i}] The text of paragraph {i} is long enough to be one.") for i in range(1, 30)])
    index = chunks.chunk_index(pages, 30)
    whole = chunks.flatten_chunks(chunks.main_text_chunks(pages, 30))
    assert index.agg({"token_count": "sum", "paragraph_count": "sum", "*": "count"}).first() == whole.agg(
        {"token_count": "sum", "paragraph_count": "sum", "*": "count"}
    ).first()
    for report in (analytics.section_coverage, analytics.token_stats, analytics.token_histogram, analytics.section_distribution):
        plan = report(index)._jdf.queryExecution().executedPlan().toString()
        assert "content" not in plan and "paragraphs" not in plan


def test_document_info_replaces_the_case_columns(spark, make_pages):
    flat = chunks.flatten_chunks(chunks.main_text_chunks(make_pages([(1, 1, body(1, 20)), (2, 1, body(1, 20))])))
    info = spark.createDataFrame(
        [(2, "A v. B", "N-1", "Chamber I", "1 May 2020")],
        "doc_id bigint, case_name string, case_number string, chamber string, date string",
    )
    got = {r["doc_id"]: r for r in chunks.with_document_info(flat, info).collect()}
    assert got[2]["case_name"] == "A v. B" and got[2]["date"] == "1 May 2020"
    assert got[1]["chamber"] == "Trial Chamber V"


NOTE = "1 ICC-01/04, para. 5"
PARA = "{}. The Chamber notes that this paragraph is long enough to stay"


def test_semantic_chunks_number_through_the_document(make_pages):
    pages = make_pages(
        [
            (1, 1, NOTE, ""),
            (1, 2, NOTE, PARA.format(1) + "\n" + PARA.format(2)),
            (1, 3, NOTE, ""),
            (1, 5, NOTE, PARA.format(3)),
            (2, 1, "", PARA.format(9)),
        ]
    )
    extracted = extraction.extract_pages(pages, skip=0)
    for size in (1, 2, 65536):
        got = chunks.semantic_chunks(extracted, pages_per_block=size)
        ids = {(r["doc_id"], r["chunk_id"], r["page_range"]["start"]) for r in got.collect()}
        assert ids == {
            (1, "para_1", 2), (1, "para_2", 2), (1, "footnote_3", 2),
            (1, "para_4", 5), (1, "footnote_5", 5), (2, "para_1", 1),
        }


def test_chunk_text_bounds(make_pages):
    """Packs cover each paragraph once and exceed the budget only alone."""
    rng = random.Random(1)
    pages = make_pages(
        [(d, p, "\n".join(body(rng.randint(1, 99), rng.randint(6, 60)) for _ in range(3)))
         for d in range(4) for p in range(1, 9)]
    )
    got = chunks.main_text_chunks(pages, budget=90, pages_per_block=3).collect()
    ids = [(r["doc_id"], p["page"], p["ordinal"]) for r in got for p in r["paragraphs"]]
    assert len(ids) == len(set(ids)) == 4 * 8 * 3
    assert all(r["token_count"] <= 90 or len(r["paragraphs"]) == 1 for r in got)
    for d in range(4):
        numbers = sorted(int(r["chunk_id"][-4:]) for r in got if r["doc_id"] == d)
        assert numbers == list(range(1, len(numbers) + 1))


def test_semantic_chunks_extract_once(spark, make_pages, tmp_path):
    make_pages([(1, i, f"{i}. " + "The Chamber notes that this paragraph stays " * 3) for i in range(1, 9)]).write.parquet(str(tmp_path / "p"))
    numbered = chunks.semantic_chunks(extraction.extract_pages(spark.read.parquet(str(tmp_path / "p")), skip=0), pages_per_block=3)
    assert sorted(r["chunk_id"] for r in numbered.collect()) == [f"para_{i}" for i in range(1, 9)]
    plan = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
