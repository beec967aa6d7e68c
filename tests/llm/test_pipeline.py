from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from folioscope.llm import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR).cache()
        seen.append(docs)
    return seen


def test_stages_keep_the_columns_and_shrink(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        ids = Counter(r.doc_id for r in after.select("doc_id").collect())
        assert ids <= Counter(r.doc_id for r in before.select("doc_id").collect())
    counts = [s.count() for s in stages[:-1]]
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > counts[4] > 0.5 * counts[0]


def test_every_document_left_is_packed(stages):
    left = {r.doc_id for r in stages[-2].collect()}
    packed = Counter()
    for r in stages[-1].collect():
        packed[r.doc_id, r.doc_tokens] += r.length
    assert {i for i, _ in packed} == left and all(n == size for (_, size), n in packed.items())


def test_run_gives_the_rows_of_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, DIR)
    assert rows.columns == stages[-1].columns
    columns = ["doc_id", "doc_tokens"]
    assert Counter(rows.groupBy(columns).sum("length").collect()) == Counter(stages[-1].groupBy(columns).sum("length").collect())


def test_stages_take_odd_rows_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 50, None, "s", 250)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DIR)
            assert out.count() <= max(len(data), 1) * 2
            if name != "packing":
                assert out.columns == docs.columns


def test_columns_of_any_name_pass(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, text, "en", "s", 9, "a", "b", 1, 2, "c", "d")],
        "doc_id bigint, text string, lang string, source string, n_chars int, __removed string, _removed string, "
        "__lines int, _lines int, __kept string, __hit string",
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns and list(map(tuple, out.collect())) == list(map(tuple, docs.collect())), name


def test_all_operators_are_registered():
    names = contract.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and set(registry.ORACLE) <= set(names)
