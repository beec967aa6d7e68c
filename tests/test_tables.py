"""Sources, sinks, reports and change feeds."""

import json
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from folioscope.operators import analytics, chunks, extraction
from folioscope.operators.summary import document_frequencies, with_summary
from folioscope.plans import documents
from folioscope.sources import pages as page_source
from folioscope.sources import tables
from folioscope.streaming.changes import changed_since, differing_buckets, save_snapshot, snapshot_diff

NOTE = "1 ICC-01/04, para. 5"
PARA = "2. The Chamber notes that this paragraph is long enough to stay"
BRACKET = "[3] " + "paragraph " * 20


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def pages(make_pages):
    return make_pages([(1, i, f"{NOTE}\n{PARA}\n{BRACKET}") for i in range(1, 11)])


def test_read_pages_and_slices(spark, pages, scratch):
    pages.withColumnRenamed("native_text", "t").write.parquet(f"{scratch}/p")
    back = page_source.read_pages(spark, f"{scratch}/p", native="t")
    assert back.columns == page_source.PAGE_COLUMNS
    assert page_source.page_counts(back).collect()[0]["page_count"] == 10
    parts = page_source.with_page_partition(back, skip=2, size=3)
    assert [r[0] for r in parts.orderBy("page_no").select("page_partition").collect()] == [0, 0, 0, 1, 1, 1, 2, 2]
    assert page_source.distribute_pages(back, 4).rdd.getNumPartitions() <= 4
    plan = page_source.page_slice(back, 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(page_no,2)" in plan and "LessThanOrEqual(page_no,5)" in plan


def test_load_table(spark, pages, scratch):
    chunks.flatten_chunks(chunks.main_text_chunks(pages, 60)).write.parquet(f"{scratch}/c")
    loaded = tables.load_table(spark, f"{scratch}/c", "loaded_chunks")
    sample = analytics.sample_rows(loaded, ["chunk_id"], ["chunk_id"], 2).collect()
    assert [r[0] for r in sample] == ["main_chunk_0001", "main_chunk_0002"]


def test_other_patterns(make_pages):
    page = make_pages([(1, 1, "page 9 of 10\n5 Rule 7 of the year 1999\npage 10 of 10")])
    none = extraction.hybrid_footnotes(extraction.extract_pages(page, 0))
    assert none.count() == 0
    some = extraction.extract_pages(page, 0, header_patterns=[r"^page \d+"], date_patterns=[r"\bnever\b"])
    (got,) = extraction.hybrid_footnotes(some).collect()
    assert (got["footnote_number"], got["content"]) == ("5", "Rule 7 of the year 1999")


def test_process_hybrid_saves_tables(spark, pages):
    result = documents.process_hybrid(pages, table_prefix="hyb")
    assert spark.table("hyb_paragraphs").count() == spark.table("hyb_footnotes").count() == 4
    assert result["chunks"].count() == 8
    assert tuple(result["statistics"].collect()[0]) == (4, 4, 0, 4, 4)
    assert result["status"].where("success").count() == 4
    assert set(result) == {"paragraphs", "footnotes", "chunks", "status", "statistics"}


def test_pages_from_a_table(spark, pages):
    tables.save_table(pages, "stored_pages")
    stored = page_source.pages_table(spark, "stored_pages", ocr="ocr_text")
    assert stored.columns == page_source.PAGE_COLUMNS and stored.count() == 10


def test_process_conservative_saves_the_chunk_table(spark, pages):
    result = documents.process_conservative(pages, table_name="main_chunks")
    assert spark.table("main_chunks").count() == result["chunks"].count() == 1
    stats = result["statistics"].collect()[0].asDict()
    assert stats == {
        "main_text_chunks": 1, "clean_paragraphs": 10, "conservative_footnotes": 0, "avg_confidence": 0.0,
    }


def test_replace_table_with_a_new_column(spark, pages):
    tables.save_table(chunks.flatten_chunks(chunks.main_text_chunks(pages, 60)), "grow")
    before = spark.table("grow").count()
    tables.replace_table(with_summary(spark.table("grow"), 5), "grow")
    grown = spark.table("grow")
    assert grown.columns[-1] == "summary" and grown.count() == before
    assert all(len(r["summary"].split()) <= 5 for r in grown.select("summary").collect())
    versions = {t.name for t in spark.catalog.listTables(pattern="grow__v*")}
    assert len(versions) == 2 and tables.current_version(spark, "grow") in versions


def test_bucketed_tables_join_without_shuffle(spark, pages):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            tables.save_table(pages, name, bucket_by=["doc_id", "page_no"], buckets=4)
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), ["doc_id", "page_no"])
        assert joined.count() == 10
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_json_export_keeps_nulls(spark, pages, scratch):
    extracted = extraction.extract_pages(pages)
    tables.export_json(
        extraction.hybrid_paragraphs(extracted),
        extraction.hybrid_footnotes(extracted),
        chunks.semantic_chunks(extracted),
        scratch,
    )
    rows = [json.loads(r[0]) for r in spark.read.text(f"{scratch}/hybrid_chunks").collect()]
    assert len(rows) == 8
    note = next(r for r in rows if r["chunk_type"] == "footnote")
    assert note["metadata"]["section_type"] is None and note["page_range"] == {"start": 7, "end": 7}
    assert spark.read.json(f"{scratch}/hybrid_footnotes").count() == 4


@pytest.mark.parametrize("fmt", ["json", "jsonl", "csv", "parquet"])
def test_exports_round_trip(spark, pages, scratch, fmt):
    nested = chunks.main_text_chunks(pages, 60)
    tables.export(nested, f"{scratch}/{fmt}", fmt)
    if fmt == "csv":
        back = spark.read.option("escape", '"').csv(f"{scratch}/csv", header=True, multiLine=True)
    else:
        back = spark.read.format("json" if fmt == "jsonl" else fmt).load(f"{scratch}/{fmt}")
    key = ["doc_id", "chunk_id", "content"]
    assert sorted(map(tuple, back.select(F.col("doc_id").cast("bigint"), *key[1:]).collect())) == sorted(
        map(tuple, nested.select(*key).collect())
    )
    with pytest.raises(ValueError):
        tables.export(nested, f"{scratch}/x", "xml")


def test_change_types(spark):
    schema = "chunk_id bigint, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "x", 1), (4, None, None)], schema)
    new = spark.createDataFrame([(2, "x", None), (3, "y", 1), (4, None, None), (5, "z", 2), (6, None, None)], schema)
    got = {tuple(r) for r in snapshot_diff(old, new).collect()}
    assert got == {
        (1, "x", 1, "delete"), (3, "x", 1, "update_preimage"), (3, "y", 1, "update_postimage"),
        (5, "z", 2, "insert"), (6, None, None, "insert"),
    }


def test_saved_snapshots_read_only_what_differs(spark, scratch):
    old = spark.range(400).select(F.col("id").alias("chunk_id"), F.concat(F.lit("text "), "id").alias("a"), F.lit(None).cast("int").alias("b"))
    new = old.where("chunk_id <> 7").withColumn("a", F.when(F.col("chunk_id") == 11, "other").otherwise(F.col("a")))
    new = new.select("chunk_id", "b", "a").unionByName(spark.createDataFrame([(1000, None, None)], "chunk_id bigint, b int, a string"))
    save_snapshot(old, f"{scratch}/old", buckets=32)
    save_snapshot(new, f"{scratch}/new", buckets=32)
    differing = differing_buckets(spark, f"{scratch}/old", f"{scratch}/new")
    assert 1 <= len(differing) <= 3
    diff = changed_since(spark, f"{scratch}/old", f"{scratch}/new")
    assert sorted(map(tuple, diff.collect()), key=str) == sorted(map(tuple, snapshot_diff(old, new).collect()), key=str)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    listed = ", ".join(map(str, differing)) if len(differing) > 1 else str(differing[0])
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and all(f"PartitionFilters: [_bucket#" in line and listed.replace(", ", ",") in line.replace(", ", ",") for line in scans)
    assert changed_since(spark, f"{scratch}/old", f"{scratch}/old").count() == 0
    with pytest.raises(ValueError):
        save_snapshot(new, f"{scratch}/other", buckets=16)
        changed_since(spark, f"{scratch}/old", f"{scratch}/other")


def test_saved_snapshots_over_a_change_of_columns(spark, scratch):
    old = spark.createDataFrame([(1, "a", 7), (2, "b", None), (3, None, 9)], "chunk_id int, content string, gone int")
    new = spark.createDataFrame([(1, "a", "s"), (2, "b", None), (3, None, None)], "chunk_id int, content string, _bucket string")
    empty = old.limit(0)
    for name, df in (("old", old), ("new", new), ("empty", empty)):
        save_snapshot(df, f"{scratch}/{name}", buckets=4)
    for one, two, was, now in (("old", "new", old, new), ("empty", "new", empty, new), ("old", "empty", old, empty)):
        got = changed_since(spark, f"{scratch}/{one}", f"{scratch}/{two}")
        want = snapshot_diff(was, now)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_changes_over_a_change_of_columns(spark):
    old = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (3, None, 9)], "chunk_id int, content string, gone int")
    new = spark.createDataFrame([(1, "a", "s"), (3, None, None), (4, "d", "t")], "chunk_id int, content string, summary string")
    diff = snapshot_diff(old, new)
    assert diff.columns == ["chunk_id", "content", "summary", "gone", "_change_type"]
    assert {tuple(r) for r in diff.collect()} == {
        (1, "a", None, 7, "update_preimage"), (1, "a", "s", None, "update_postimage"),
        (2, "b", None, 8, "delete"), (4, "d", "t", None, "insert"),
        (3, None, None, 9, "update_preimage"), (3, None, None, None, "update_postimage"),
    }


@pytest.mark.parametrize("step", ["_write_version", "_point_to", "_drop_versions", "rows"])
def test_a_failed_replacement_leaves_a_whole_version(spark, pages, monkeypatch, step):
    """Whichever step fails, before or after its work, a reader finds one version or the other."""
    before = sorted(map(tuple, pages.collect()))
    grown = sorted((*r, 1) for r in before)
    for late in (False, True):
        name = f"renewed_{step.strip('_')}_{late}"
        tables.save_table(pages, name)
        new = spark.table(name).withColumn("extra", F.lit(1))
        with monkeypatch.context() as patch:
            if step == "rows":
                new = new.where(F.when(F.col("page_no") == 10, F.raise_error(F.lit("lost"))).otherwise(True))
            else:
                real = getattr(tables, step)

                def fail(*args, real=real, late=late):
                    if late:
                        real(*args)
                    raise RuntimeError("lost")

                patch.setattr(tables, step, fail)
            with pytest.raises(Exception, match="lost"):
                tables.replace_table(new, name)
        spark.catalog.clearCache()
        found = sorted(map(tuple, spark.table(name).collect()))
        assert found == (grown if step == "_drop_versions" or (step == "_point_to" and late) else before)
        tables.replace_table(spark.table(name).drop("extra").withColumn("more", F.lit("x")), name)
        assert spark.table(name).columns == [*pages.columns, "more"] and spark.table(name).count() == 10
        tables.drop_table(spark, name)
        assert not spark.catalog.listTables(pattern=f"{name}*".lower())


def test_a_reader_keeps_the_version_it_began_with(spark, pages):
    tables.save_table(pages, "read_on")
    reader = spark.table("read_on")
    tables.replace_table(reader.where("page_no < 4"), "read_on")
    assert reader.count() == 10 and spark.table("read_on").count() == 3


def test_a_plain_table_is_taken_over(spark, pages, monkeypatch):
    pages.write.saveAsTable("plain")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_point_to", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.replace_table(spark.table("plain").limit(1), "plain")
    assert spark.table("plain").count() == 10
    tables.replace_table(spark.table("plain").limit(1), "plain")
    assert spark.table("plain").count() == 1 and tables.current_version(spark, "plain")


NESTED_SCHEMA = "id bigint, text string, score double, ok boolean, tags array<string>, at struct<page:int,part:string>, more map<string,int>"


def nested_rows(spark):
    rows = [
        (1, 'says "so", twice\n\nand more ', 0.5, True, ["a", 'b"c'], (1, None), {"x": 1}),
        (2, " \t", None, None, [], (None, "é,\n"), {}),
        (3, None, -1.5, False, None, None, None),
        (4, "", 1e300, True, [None], (2, ""), {"y": None}),
    ]
    return spark.createDataFrame(rows, NESTED_SCHEMA)


@pytest.mark.parametrize("fmt", ["json", "jsonl", "csv", "parquet"])
def test_exports_are_read_back(spark, scratch, fmt):
    rows = nested_rows(spark)
    tables.export(rows, f"{scratch}/{fmt}", fmt)
    good, broken = tables.read_export(spark, f"{scratch}/{fmt}", fmt, rows.schema)
    assert good.schema.simpleString() == rows.schema.simpleString()
    assert sorted(good.collect(), key=str) == sorted(rows.collect(), key=str)
    assert broken.count() == 0


def test_broken_rows_are_set_apart(spark, scratch):
    rows = nested_rows(spark)
    for fmt in ("json", "csv"):
        tables.export(rows, f"{scratch}/{fmt}", fmt)
    lines = ['{"id": 5, "text": "cut', '{"id": "six", "text": "t"}', '{"id": 7, "tags": "none"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(f"{scratch}/json")
    good, broken = tables.read_export(spark, f"{scratch}/json", "json", rows.schema)
    assert good.count() == 4 and sorted(r["_corrupt_record"] for r in broken.collect()) == sorted(lines)
    records = ["id,text,score,ok,tags,at,more", '8,t,1.0,true,"[""a""","{}",{}', "nine,t,1.0,true,[],{},{}", '10,t,1.0,true,[],"[1]",{}']
    spark.createDataFrame([("\n".join(records),)], "value string").write.mode("append").text(f"{scratch}/csv")
    good, broken = tables.read_export(spark, f"{scratch}/csv", "csv", rows.schema)
    assert good.count() == 4
    assert sorted(r["_corrupt_record"] for r in broken.collect()) == ['at: [1]', "nine,t,1.0,true,[],{},{}", 'tags: ["a"']


def test_sections_without_summaries_have_no_ratio(spark):
    rows = spark.createDataFrame([("A", "text", ""), ("B", "text", "te")], "section_type string, content string, summary string")
    assert {r["section_type"]: r["length_ratio"] for r in analytics.corpus_profile(rows).collect()} == {"A": None, "B": 2.0}


def test_number_reports(spark):
    df = spark.createDataFrame([(n,) for n in ["9", "10", "x", "10", None, "99999999999999999999"]], "n string")
    first = analytics.distinct_numbers(df.where("n IS NOT NULL"), "n", 2).collect()
    assert [r[0] for r in first] == ["10", "9"]
    (got,) = analytics.number_range(df, "n").collect()
    assert tuple(got) == (9, 10)


def test_quality_report(spark):
    rows = [(1, "short"), (1, "   "), (1, "a long enough chunk\x00 of text �"), (2, "a fine chunk of plain text")]
    texts = spark.createDataFrame(rows, "doc_id bigint, content string")
    numbers = spark.createDataFrame([(1, "2"), (1, "5"), (1, "5"), (2, "x")], "doc_id bigint, paragraph_number string")
    got = {r["doc_id"]: r for r in analytics.quality_report(texts, numbers).collect()}
    assert (got[1]["short_chunks"], got[1]["empty_chunks"], got[1]["corrupt_chars"]) == (2, 1, 2)
    assert got[1]["missing_numbers"] == 2 and got[2]["missing_numbers"] == 0
    assert not got[1]["empty_ratio_ok"] and got[2]["empty_ratio_ok"] and got[1]["corrupted"]


def test_summary_keeps_order_and_limit(spark):
    """Words of few chunks weigh more: the sentences on gamma, which the other chunk lacks, win."""
    text = "Alpha beta common words. Gamma delta first. Common words again. Gamma delta here!"
    rows = [(1, text), (2, "Common words, again. Alpha beta here and first."), (3, None), (4, ""), (5, " . "), (None, "One two.")]
    df = spark.createDataFrame([(i, t, "kept", 0) for i, t in rows], "chunk_id int, content string, summary string, _places int")
    out = with_summary(df, 6, keys=["chunk_id"])
    assert out.columns == ["chunk_id", "content", "_places", "summary"]
    got = {r["chunk_id"]: r["summary"] for r in out.collect()}
    assert got == {
        1: "Gamma delta first. Gamma delta here!", 2: "Common words, again.", 3: None, 4: "", 5: ".", None: "One two.",
    }
    (cut,) = with_summary(spark.createDataFrame([(1, "w " * 50)], "chunk_id int, content string"), 7, ["chunk_id"]).collect()
    assert len(cut["summary"].split()) == 7


def test_summary_is_planned_without_python(spark):
    df = spark.createDataFrame([(1, "a b")], "chunk_id int, content string")
    plan = with_summary(df, 5, ["chunk_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_document_frequencies(spark):
    df = spark.createDataFrame([("Rare word WORD",), ("word é éééé",), (None,)], "content string")
    got = {r["word"]: r["weight"] for r in document_frequencies(df).collect()}
    assert got == {"rare": 693147, "word": 287682, "éééé": 693147}


def test_summary_shuffles_no_word_twice(spark):
    """Rows of words meet the table of frequencies and go back to their chunk; no other exchange has any."""
    df = spark.createDataFrame([(1, "One two three. Four five.")], "chunk_id int, content string")
    plan = with_summary(df, 5, ["chunk_id"])._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert exchanges and all(re.fullmatch(r"_key_*#\d+|word#\d+", e) for e in exchanges)


def test_summary_of_keys_that_repeat_or_are_null(spark):
    """Chunks of one key share their scores; without a key there are none, so the first sentences win."""
    text = "Common words here. Gamma delta first. Common words again. Gamma delta."
    rows = [(1, text), (1, text), (None, text), (2, "Common words again here.")]
    df = spark.createDataFrame(rows, "chunk_id int, content string")
    got = sorted((r.chunk_id or 0, r.summary) for r in with_summary(df, 3, ["chunk_id"]).collect())
    assert got == [(0, "Common words here."), (1, "Gamma delta."), (1, "Gamma delta."), (2, "Common words again")]
