import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from folioscope.llm import prefixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, depth string"


def conversations(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            out[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [x[1:] for x in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        # the remainder has the sign of the id, as in SQL
        out[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def trie(convs):
    """Nodes by plain dictionaries of prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    parents = {p[:-1] for p in members if p}
    for p, who in members.items():
        words = len(WORD.findall(p[-1][1])) if p else 0
        if p:
            children[p[:-1]] += 1
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(who) - 1) * words
            leaves[p[:d]] += p not in parents
    return sorted(
        (
            min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, who in members.items()
    )


def key(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[1], r[0], str(r)))


def random_rows(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            text = rng.choice([None, "", "one", " two  words\n", "é ü ö"] + ["w"] * words)
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", None]), text, "clash", None))
    rows += [r for r in rows if r[0] < 3]  # repeated rows
    rows += [(None, 1, "user", "lost", None, None), (-7, 0, "user", "w", None, None), (-20, 0, None, "w", None, None)]
    return rows


@pytest.mark.parametrize("seed,n,longest,words,run,block", [(1, 90, 4, 3, 2, 4), (2, 40, 12, 9, 2, 2), (3, 60, 3, 1, 16, 1024)])
def test_equals_dictionaries(spark, seed, n, longest, words, run, block):
    rows = random_rows(seed, n, longest, words)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    turns, sizes = prefixes.ordered_turns(docs)
    got = prefixes.prefix_trie(turns, sizes, run, block).collect()
    assert key(got) == key(trie(conversations(rows)))
    got = prefixes.prefix_trie(*prefixes.branched_off(turns, sizes), run, block).collect()
    assert key(got) == key(trie(rebuilt(conversations(rows))))


def test_hot_and_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t}", None, None) for c in range(300) for t in range(2)]
    rows += [(1000, t, "user", f"turn {t}", None, None) for t in range(3000)]
    rows += [(1001, t, "user", f"turn {t}", None, None) for t in range(2999)] + [(1001, 2999, "user", "another", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.conv_id, r.depth): r for r in prefixes.prefix_trie(*prefixes.ordered_turns(docs), block=64).collect()}
    assert len(got) == 3002
    assert got[0, 2].n_convs == 302 and got[0, 2].n_leaves == 2
    assert got[0, 2].ends_sha256 == hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()
    assert (got[1000, 2999].n_convs, got[1000, 2999].n_children) == (2, 2)
    assert got[0, 0].saved_tokens == 2 * 2 * 301 + 2 * 2997


def test_empty_table(spark):
    got = prefixes.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[0] == "conv_id"


def test_binary_search_over_range_minima():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 6, n)
        levels = prefixes._sparse(values)
        at, depth = rng.integers(0, n, 50), rng.integers(0, 8, 50)
        want = [next((i for i in range(a, n) if values[i] < d), n) for a, d in zip(at, depth)]
        assert prefixes.first_below(levels, at, depth).tolist() == want
