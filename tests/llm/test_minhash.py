import random
import re

import pytest

from folioscope.llm import minhash
from folioscope.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, class string, n string"


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def classes(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for group in range(6):
        origin = [draw.choice(vocabulary) for _ in range(120)]
        for _ in range(15):
            copy = list(origin)
            for _ in range(draw.randint(0, 14)):
                copy[draw.randrange(120)] = draw.choice(vocabulary)
            out.append((len(out) + 1, draw.choice([" ", "\n"]).join(copy)))
    out += [(500 + i, " ".join(draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 5, 60])))) for i in range(25)]
    out += [(600, None), (601, ""), (602, " \t"), (603, "One"), (604, "one"), (605, "x " * 20000), (606, "X " * 20000)]
    out += [(None, out[0][1]), (1, out[0][1]), (700, out[0][1]), (700, out[40][1])]  # 700 joins two groups
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_classes_equal_all_pairs(spark, rows, size):
    docs = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    got = minhash.near_duplicates(docs, shingle=size).collect()
    want = classes(rows, size, 80)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert {(r.doc_id, r.n_shingles) for r in got} == {(i, len(shingles(t, size))) for i, t in rows}


def test_signatures_within_the_distance_share_a_key(spark):
    """Pigeonhole: any 19 of 60 minima may differ."""
    draw = random.Random(2)
    chunks = []
    for _ in range(20):
        sig = [[draw.randrange(256) for _ in range(6)] for _ in range(10)]
        other = [list(c) for c in sig]
        for at in draw.sample(range(60), 19):
            other[at // 6][at % 6] ^= draw.randrange(1, 256)
        chunks.append(tuple([sum(b << (8 * k) for k, b in enumerate(c)) for c in s] for s in (sig, other)))
    from pyspark.sql import functions as F

    table = spark.createDataFrame(chunks, "sig array<bigint>, other array<bigint>")
    keys = table.select(minhash._bucket_keys().alias("a"), minhash._distance(F.col("sig"), F.col("other")).alias("d"), "other")
    keys = keys.withColumnRenamed("other", "sig").select("a", "d", minhash._bucket_keys().alias("b"))
    for r in keys.collect():
        assert r.d == 19 and set(r.a) & set(r.b)


def test_filter_and_empty_table(spark, rows):
    docs = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    kept = minhash.drop_near_duplicates(docs, shingle=2)
    assert kept.columns == docs.columns
    want = classes(rows, 2, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} | {None}
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bitmaps_never_rule_out_a_similar_pair(spark):
    import numpy as np
    from pyspark.sql import functions as F

    draw = random.Random(8)
    pairs = []
    for _ in range(60):
        size = draw.choice([1, 5, 40, 400, 4000])
        one = {draw.randrange(1 << 60) for _ in range(size)}
        other = set(draw.sample(sorted(one), len(one) - draw.randint(0, len(one) // 8))) | {draw.randrange(1 << 60) for _ in range(draw.randint(0, size // 8))}
        bits = [minhash._bitmaps(np.array(sorted(s), np.uint64), np.array([len(s)]))[0].tolist() for s in (one, other)]
        pairs.append((len(one), bits[0], len(other), bits[1], 100 * len(one & other) >= 80 * len(one | other)))
    table = spark.createDataFrame(pairs, "n int, x array<bigint>, m int, y array<bigint>, similar boolean")
    kept = table.select("similar", minhash._may_share(F.col("n"), F.col("x"), F.col("m"), F.col("y"), 80).alias("may")).collect()
    assert all(r.may for r in kept if r.similar) and any(r.similar for r in kept) and any(not r.may for r in kept)


def test_columns_of_any_name_pass(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "x", 1), (2, text, "y", 2)], "doc_id bigint, text string, _kept string, __kept int")
    assert [tuple(r) for r in minhash.drop_near_duplicates(docs).collect()] == [(1, text, "x", 1)]
