import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioscope.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string, lines string, kept string"
CLASHES = "doc_id bigint, text string, source string, _gone string, __gone string, _own string, _of int"


def base(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(8)}
    repeats = sum(n - 1 for n in Counter(lines).values())
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, words)), symbols, repeats, len(covered), failed


@pytest.fixture(scope="module")
def rows():
    prose = [" ".join(f"w{(i * 31 + j * 7) % 97}x{j}" for j in range(40)) for i in range(12)]
    menu = "home about contact and some more words that every page of the host repeats at its top"
    out = [(i, f"{menu}\n{prose[i]}", "a", "clash", None) for i in range(12)]
    out += [(20 + i, f"{menu}\n{menu.upper()}  \nonly a few own words {i} here and there", "a", None, None) for i in range(3)]
    out += [(30 + i, prose[0], "b", None, None) for i in range(9)]  # copies
    out += [(40, None, "a", None, None), (41, "", None, None, None), (42, " \n\t\n", "a", None, None)]
    out += [(43, "one two three four five six seven eight nine ten " * 9, None, None, None), (None, prose[3], None, None, None)]
    out += [(44, "é<|>#& " * 3 + "long " + "x" * 5000, "a", None, None), (1, out[1][1], "a", None, None)]
    return out


def test_base_counts_equal_plain_python(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality.quality_verdicts(docs).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *base(r[1])) for r in rows)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[c] for c in columns) for r in got) == want


def test_boilerplate_counts_against_a_document(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    verdict = {r.doc_id: r for r in quality.quality_verdicts(docs, min_documents=5, max_share=0.5).collect()}
    assert all(verdict[i].kept and verdict[i].n_words_left == 40 for i in range(12))
    assert not any(verdict[20 + i].kept for i in range(3))  # depleted: little but the menu
    assert all(verdict[30 + i].kept for i in range(9))  # copies don't make their text boilerplate
    assert not any(verdict[i].kept for i in (40, 41, 42, 43))
    assert verdict[None].kept


def test_filter_keeps_columns_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 30, None}
    none = spark.createDataFrame([], SCHEMA)
    assert quality.quality_verdicts(none).count() == 0 and quality.keep_good(none).count() == 0


def test_a_line_of_many_documents_is_boilerplate_in_a_large_host(spark):
    menu = "all rights to this page and to what it shows are reserved by its owner"
    own = [" ".join(f"v{(i * 13 + j * 5) % 89}y{j}z{i}" for j in range(25)) for i in range(1500)]
    texts = [f"{menu}\n{x}" if i < 30 else f"{menu} {i % 100}\n{x}" for i, x in enumerate(own)]
    docs = spark.createDataFrame([(i, t, "large", None, None) for i, t in enumerate(texts)], SCHEMA)
    lost = {r.doc_id: r.n_words - r.n_words_left for r in quality.quality_verdicts(docs).collect()}
    # 30 of 1,500 documents hold the line, its numbered forms stand in 15 at most
    assert {i for i, n in lost.items() if n} == set(range(30)) and lost[0] == 15


def test_boilerplate_leaves_the_text(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.doc_id, r.text) for r in quality.clean_documents(docs, min_documents=5).collect())
    menu = rows[0][1].split("\n")[0]

    def left(text, host):
        gone = host == "a" and text is not None
        return "\n".join(x for x in text.split("\n") if x.lower().split() != menu.split()) if gone else text

    assert got == Counter((r[0], left(r[1], r[2])) for r in rows)
    kept = quality.keep_good(docs, min_documents=5).collect()
    assert {r.doc_id for r in kept} >= {*range(12), None} and not any(menu in r.text for r in kept)
    assert sum(r.doc_id == 1 for r in kept) == 2  # a repeated row


def test_stage_removes_boilerplate_and_counts_anew(spark):
    menu = "all rights to this page are reserved"
    own = [" ".join(f"v{i}x{j}" for j in range(25)) for i in range(25)]
    data = [(i, f"{menu}\n{x}\n", "s", 0) for i, x in enumerate(own)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string, n_chars bigint")
    got = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert got == {(i, f"{x}\n", len(x) + 1) for i, x in enumerate(own)}


def test_columns_of_any_name_pass(spark):
    rows = [(1, "a few words " * 9, "s", "x", "y", "z", 7), (2, "", None, None, None, None, None), (3, None, "s", "x", None, None, 1)]
    docs = spark.createDataFrame(rows, CLASHES)
    got = quality.keep_good(docs, removed="n_gone")
    assert got.columns == [*docs.columns, "n_gone"]
    # the first repeats itself, the others have no words
    assert got.collect() == []
    kept = quality.keep_good(docs.withColumn("text", F.lit(" ".join(f"w{i}" for i in range(30)))))
    assert sorted(r["__gone"] or "" for r in kept.collect()) == ["", "", "y"]
