import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscope.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, rest string, edges string, h1 string"


def expected(texts, window):
    """Per text the words outside windows that start in more than one place."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(x[i : i + window]) for x in words for i in range(len(x) - window + 1))
    out = []
    for text, x in zip(texts, words):
        gone = {i + k for i in range(len(x) - window + 1) if seen[tuple(x[i : i + window])] > 1 for k in range(window)}
        kept = " ".join(word for i, word in enumerate(x) if i not in gone)
        out.append((None if text is None else kept, len(x), len(gone)))
    return out


def check(spark, texts, window, parts=3):
    rows = [(i, t, "clash", None, str(i)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = substrings.drop_repeated_passages(docs, window=window)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(texts)
    for i, want in enumerate(expected(texts, window)):
        r = found[i]
        assert (r.text, r.n_words, r.n_removed) == want, (i, texts[i])
        assert (r.rest, r.edges, r.h1) == ("clash", None, str(i))


@pytest.mark.parametrize("seed,window,vocabulary", [(1, 5, 4), (2, 6, 30), (3, 8, 400)])
def test_equals_brute_force(spark, seed, window, vocabulary):
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(vocabulary)}é" for _ in range(rng.randrange(window, 40))] for _ in range(12)]
    texts = []
    for _ in range(150):
        out = []
        for _ in range(rng.randrange(4)):
            out += [f"w{rng.randrange(vocabulary)}é" for _ in range(rng.randrange(25))]
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage))
            out += passage[cut:] if rng.random() < 0.3 else passage
        blank = rng.choice([" ", "\n", "\t ", "\r\n"])
        texts.append(blank.join(out))
    texts += [None, "", " \n", texts[0], texts[1], " " + texts[2]]
    check(spark, texts, window)


def test_periodic_texts_and_copies(spark):
    texts = ["a " * 50, "a b " * 40, "a b c " * 9 + "d", " ".join(f"x{i}" for i in range(60)), "b " + "a " * 49]
    texts += [" ".join(f"y{i}" for i in range(40))] * 7 + [" ".join(f"z{i}" for i in range(9))] * 3
    check(spark, texts, 10)
    check(spark, texts, 35)


def test_hot_passage_with_different_borders(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"own{i} " * 3 + passage + f" tail{i}" * (i % 5) for i in range(400)]
    texts += [" ".join(passage.split()[k : k + 40]) for k in range(0, 20, 3)]
    check(spark, texts, 35, parts=8)


def test_long_texts(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(5000)}" for _ in range(200_000)]
    texts = [" ".join(long), " ".join(long[1000:1100] + ["end"]), "x " + " ".join(long[150_000:150_035]), " ".join(long[7:41])]
    check(spark, texts, 35)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string")
    got = substrings.drop_repeated_passages(docs)
    assert got.collect() == [] and got.columns == ["text", "n_words", "n_removed"]
    one = spark.createDataFrame([("a b",), (None,)], "text string")
    assert sorted(map(tuple, substrings.drop_repeated_passages(one).collect()), key=str) == [("a b", 2, 0), (None, 0, 0)]


def test_false_span_is_refused(spark, monkeypatch):
    """A span whose edges aren't those of its path removes nothing."""
    docs = spark.createDataFrame([("a b c d e f",), ("a b c d e f",)], "text string")
    spans = substrings.repeated_spans(docs, window=3)
    assert [(s.place, s.length) for r in spans.collect() for s in r.spans] == [(0, 4)]
    forged = spans.withColumn("spans", F.transform("spans", lambda s: s.withField("check", s["check"].bitwiseXOR(1))))
    monkeypatch.setattr(substrings, "repeated_spans", lambda *_: forged)
    assert {(r.text, r.n_removed) for r in substrings.drop_repeated_passages(docs, window=3).collect()} == {("a b c d e f", 0)}
