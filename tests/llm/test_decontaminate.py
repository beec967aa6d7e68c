import itertools
import math
import random
import re

from folioscope.llm import decontaminate

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def aligned(doc, item):
    """Whether some shift gives a window that agrees in three quarters of its places."""
    size = min(16, len(item), len(doc))
    if size < 8:
        return False
    for shift in range(1 - len(item), len(doc)):
        low, high = max(0, shift), min(len(doc), shift + len(item))
        same = [doc[i] == item[i - shift] for i in range(low, high)]
        if any(sum(same[i : i + size]) >= math.ceil(0.75 * size) for i in range(len(same) - size + 1)):
            return True
    return False


def test_substitutions_are_tolerated_and_clean_texts_pass(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]

    def text(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    items = [(i, text(n)) for i, n in enumerate([7, 9, 15, 16, 30, 60, 200])]
    docs = []
    for _, item in items:
        for every in (0, 3, 4, 5, 7):
            changed = [draw.choice(vocabulary) if every and k % every == every - 1 else x for k, x in enumerate(item)]
            docs.append(text(draw.randint(0, 80)) + changed + text(draw.randint(0, 80)))
        docs.append([*item[: len(item) // 2]])
    docs += [text(n) for n in (0, 1, 7, 8, 40, 3000)]
    rows = [(i, " ".join(x).upper().replace(" ", ", ", 3), i) for i, x in enumerate(docs)]
    rows += [(900, None, 0), (901, "", 0), (None, rows[25][1], 0), rows[25]]
    benchmark = [(i, " ".join(x)) for i, x in items] + [(50, None), (51, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame(benchmark, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table, bench).collect()}
    want = {(d, i) for d, t, _ in rows for i, x in benchmark if aligned(tokens(t), tokens(x))}
    # changed items shorter than a window may hold no mask; whole ones and longer ones are all found
    assert got <= want
    assert {(d, i) for d, i in want if d is None or d % 6 == 0 or i >= 2} <= got
    kept = decontaminate.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in rows} - {d for d, _ in got}


def test_spans_point_at_the_passage(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    bench = spark.createDataFrame([(3, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"before it, {item.replace('six', 'SEVEN', 1)}; after")], "doc_id bigint, text string")
    [r] = decontaminate.overlaps(docs, bench).collect()
    assert (r.start_word, r.end_word, r.n_equal) == (2, 18, 15)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id bigint, text string")
    assert decontaminate.overlaps(docs, bench).count() == 1
    assert decontaminate.overlaps(docs.where("false"), bench).count() == 0
    assert decontaminate.overlaps(docs, bench.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.where("false")).count() == 1


def test_masks_reach_every_placement_of_changes():
    for size in range(decontaminate.LEAST, decontaminate.WINDOW + 1):
        for changed in itertools.combinations(range(size), size - math.ceil(0.75 * size)):
            equal = [i not in changed for i in range(size)]
            assert any(
                all(equal[at + k] for k, one in enumerate(mask) if one == "1")
                for mask in decontaminate.MASKS
                for at in range(size - len(mask) + 1)
            ), (size, changed)


def test_changes_at_random_places_are_found(spark):
    draw = random.Random(8)
    items, docs = [], []
    for i in range(120):
        n = draw.choice([8, 9, 11, 12, 15, 16, 17, 20])
        item = [f"w{draw.randrange(500)}" for _ in range(n)]
        size = min(n, 16)
        changed = set(draw.sample(range(size), size - math.ceil(0.75 * size)))
        passage = [f"x{i}k{k}" if k in changed else word for k, word in enumerate(item)]
        docs.append((i, " ".join([f"a{i}"] * 9 + passage + [f"b{i}"] * 9)))
        items.append((i, " ".join(item)))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, bench).collect()}
    assert {(i, i) for i in range(120)} <= got


def test_columns_of_any_name_pass(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "x", 1), (2, "other words", "y", 2)], "doc_id bigint, text string, _hit string, __hit int")
    benchmark = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    assert [tuple(r) for r in decontaminate.drop_contaminated(docs, benchmark).collect()] == [(2, "other words", "y", 2)]
