import random
import re
import time
from collections import Counter, defaultdict

from folioscope.llm import lines
import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, place int, key string, n_lines int"


def one_edit(a, b):
    i = j = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def plain(rows, least=8):
    placed = []
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            if words := tuple(WORD.findall(line.lower())):
                placed.append((doc, text, i, words))
    first, by_size, near = {}, defaultdict(list), set()
    for doc, text, i, words in placed:
        first.setdefault(words, (doc, text, i))
    for words in first:
        if len(words) >= least:
            if any(one_edit(words, other) for n in (-1, 0, 1) for other in by_size[len(words) + n]):
                near.add(words)
            by_size[len(words)].append(words)
    gone = {(d, t, i) for d, t, i, words in placed if words in near or first[words] != (d, t, i)}

    def left(doc, text):
        return None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, text, i) not in gone)

    return Counter((doc, left(doc, text)) for doc, text in rows)


def sample():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    base = [[draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 3, 7, 8, 9, 12, 20]))] for _ in range(60)]

    def edit(line):
        line, kind = list(line), draw.randint(0, 3)
        if kind == 1 and line:
            line[draw.randrange(len(line))] = draw.choice(vocabulary)
        elif kind == 2:
            line.insert(draw.randint(0, len(line)), draw.choice(vocabulary))
        elif kind == 3 and line:
            del line[draw.randrange(len(line))]
        return line

    rows = []
    for i in range(120):
        chosen = [draw.choice(base) for _ in range(draw.randint(0, 8))]
        rows.append((i, "\n".join(draw.choice([" ", "  ", "\t"]).join(edit(edit(x)) if draw.random() < 0.3 else x) for x in chosen)))
    rows += [(None, "a b c d e f g h i"), (3, None), (5, ""), (None, "w1"), (200, "word " * 3000), (201, "word " * 3001)]
    return rows + [(7, "x y z q a b c d\n\nX y z q a b c d ")] * 2


def test_equal_to_plain_comparison(spark):
    rows = sample()
    docs = spark.createDataFrame([(*r, 1, "k", None) for r in rows], SCHEMA)
    kept = lines.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == plain(rows)


def test_edits_chain_to_the_earliest(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (2, text + " i"), (3, text + " i j"), (4, "a b c d e f g X"), (5, text.upper()), (6, "a b c d")]
    docs = spark.createDataFrame([(*r, 1, "k", None) for r in rows], SCHEMA)
    left = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    assert left == {1: text, 2: "", 3: "", 4: "", 5: "", 6: "a b c d"}


def test_stage_drops_emptied_documents_only(spark):
    rows = [(1, "same line", 9), (2, "same line\n", 10), (3, "", 0), (4, None, None), (5, "own\nsame line", 13)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {1: ("same line", 9), 3: ("", 0), 4: (None, None), 5: ("own", 3)}


def test_empty_table(spark):
    assert lines.drop_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_very_long_line(spark):
    """Work on a line grows with its words, not with their square."""
    long = [f"w{i % 9973}" for i in range(100_000)]
    other = [*long[:70_000], "changed", *long[70_001:]]
    rows = [(1, " ".join(long)), (2, " ".join(other) + "\nown"), (3, " ".join(long[:50_000] + ["x", "y"] + long[50_000:]))]
    docs = spark.createDataFrame([(*r, 1, "k", None) for r in rows], SCHEMA)
    started = time.time()
    left = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    assert left[1] == rows[0][1] and left[2] == "own" and left[3] == rows[2][1]
    assert time.time() - started < 90


def test_columns_of_any_name_pass(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 1), (2, "a b c\nd", "y", 2)], "doc_id bigint, text string, __places string, _own int")
    got = lines.drop_repeated_lines(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a b c", "x", 1), (2, "d", "y", 2)]
