import hashlib
import re

import pytest
from pyspark.sql import functions as F

from folioscope.llm import pii

#: The contract's patterns, for plain Python.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "nothing here", "a@b.c_d@e.f x@y..z q@w.e.r. 1.2.3.4.5 256.1.1.1 0255.00.1.9 +49 (30) 1234-567. +1-2",
    "é😀 4111 1111 1111 1111 4111-1111-1111-1112 +1234567890 me@host.com,you@x-y.org", "1" * 3000 + " " + "1 " * 4000, "a" * 3000 + "@",
    "x@" * 500 + "1.1.1.1.1.1.1.1.1.1.1.1", "4111111111111111\n4111111111111111", "+1 (202) 555-0143, +44 20 7946 0958", "日本4111111111111111語 a@b.co",
    "0" * 16, "..@-.-", "a@b", "++1234567890", "1.2.3.99999999999999999999", "me (at) host.org 2001:db8::1:2:3",
]


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def base(text):
    found = [
        (m.start(), number, m.end())
        for number, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return sorted(found)


def written(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], None)], "doc_id bigint, text string, base string")
    got = pii.with_digests(pii.find_personal_data(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        want = base(TEXTS[4 if r.doc_id is None else r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == n for s in want) for n in range(4)]
        assert set(filter(None, written(want).split(","))) <= set(r.spans.split(","))
    assert pii.find_personal_data(docs.where("false")).count() == 0


def luhn(stem):
    """The stem with its check digit."""
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(stem))))
    return stem + str(-total % 10)


def planted(i, kind):
    """A value in the rule's format, one without its mark, and a look-alike."""
    digits = f"{i * 7919 % 10**7:07}"
    if kind == "phone":
        return f"phone +1 202 {digits[:3]} {digits[3:]}", f"phone 1 202 {digits[:3]} {digits[3:]}", f"order 1 202 {digits[:3]} {digits[3:]}"
    if kind == "email":
        return f"mail jo{i}@host{i % 9}.org", f"mail jo{i} (at) host{i % 9} [dot] org", f"we met jo{i} (at) noon, then"
    if kind == "ip":
        return f"host 10.{i % 256}.{i % 200}.7", f"host 2001:db8:0:0:0:{i % 9999:x}:2:1", f"host 12:{i % 60:02}:45:10"
    card = luhn(f"41111111{digits}")
    groups = [card[k : k + 4] for k in range(0, 16, 4)]
    wrong = [*groups[:3], groups[3][:3] + str((int(groups[3][3]) + 5) % 10)]
    return f"card {' '.join(groups)}", f"card {'.'.join(groups)}", f"card {'.'.join(wrong)}"


@pytest.fixture(scope="module")
def learned(spark):
    rows = []
    for i in range(3200):
        kind = pii.KINDS[i % 4]
        good, unmarked, alike = planted(i, kind)
        text = {0: f"some words, {good}; and more", 1: f"see {unmarked}; and more", 2: f"see {alike}; and more"}
        rows.append((i, text[(0, 0, 0, 1, 2, 2)[i // 4 % 6]]))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_spans_without_the_mark_are_added(spark, learned):
    """What only lacks the mark of its rule is found; look-alikes are not; base spans stay."""
    texts = {r.doc_id: r.text for r in learned.collect()}
    wanted, added, right = set(), set(), 0
    for i, text in texts.items():
        _, unmarked, _ = planted(i, pii.KINDS[i % 4])
        if i // 4 % 6 == 3:
            start = text.index(unmarked)
            wanted.add((i, pii.KINDS[i % 4], start + unmarked.index(" ") + 1, start + len(unmarked)))
    for r in pii.find_personal_data(learned).collect():
        spans, own = [tuple(s) for s in r.spans], {tuple(s) for s in r.base}
        assert own <= set(spans) and sorted(own) == base(texts[r.doc_id])
        assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))
        added |= {(r.doc_id, pii.KINDS[k], a, b) for a, k, b in spans if (a, k, b) not in own}
    right = len(added & wanted)
    assert right >= 0.95 * len(added) and right >= 0.9 * len(wanted)
    for kind in pii.KINDS:
        assert sum(x[1] == kind for x in added & wanted) >= 0.8 * sum(x[1] == kind for x in wanted)


def test_nothing_is_added_where_look_alikes_abound(spark):
    """Numbers without plus that are mostly no phones: their share of marked ones is low."""
    rows = [(i, f"number +1 202 555 {1000 + i}") for i in range(400)] + [(1000 + i, f"number 1 202 {i:03} {1000 + i}") for i in range(4000)]
    rows += [(9000 + i, f"phone +1 202 556 {1000 + i}") for i in range(400)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(len(r.spans) for r in found if 1000 <= r.doc_id < 9000) == 0


def test_threshold():
    pure = [(2.0, 1, 100), (1.0, 0, 500), (0.5, -1, 50)]
    assert 0 < pii.threshold(pure) < 2.0
    assert pii.threshold([(2.0, 1, 10)]) is None
    # clear negatives among the best
    assert pii.threshold([(2.0, 1, 50), (2.0, -1, 50)]) is None


def test_every_candidate_counts(spark):
    """Positives are rare among 60,000 candidates; all held-out ones count, not those of a sample."""
    n = F.when(F.col("id") % 300 == 0, 1.0).otherwise(0.0)
    width = pii.FORMATS + 1 + len(pii.KINDS) + 8
    candidate = F.struct(
        F.lit(5).alias("start"), F.lit(0).alias("kind"), F.lit(9).alias("end"),
        F.array(n, *[F.lit(0.0)] * (width - 1)).alias("features"), F.when(n == 1, 1).otherwise(-1).alias("label"),
    )
    scanned = spark.range(60_000).select(F.col("id").alias("doc"), F.array(candidate).alias("candidates"))
    held = scanned.where((F.col("doc") % 300 == 0) & (F.pmod(F.xxhash64("doc", F.lit(5), F.lit(0)), F.lit(5)) == 0)).count()
    selector = pii.fit_selector(scanned, support=held)
    assert list(selector.thresholds) == [0]
    assert not pii.fit_selector(scanned, support=held + 1).thresholds


def test_trees_as_expressions_equal_the_model(spark, learned):
    text = F.col("text")
    scanned = learned.select(F.col("doc_id").alias("doc"), "text", F.array_sort(F.concat(*pii.base_spans(text).values())).alias("base"))
    scanned = scanned.select("doc", pii._candidates(text, F.col("base")).alias("candidates"))
    selector = pii.fit_selector(scanned, support=5)
    assert selector.model is not None and selector.thresholds
    rows = scanned.select(F.explode("candidates").alias("c")).select("c.features", selector.score(F.col("c.features")).alias("score"))
    from pyspark.ml.functions import array_to_vector, vector_to_array

    both = selector.model.transform(rows.withColumn("vector", array_to_vector("features")))
    for r in both.select("score", vector_to_array("rawPrediction").alias("raw")).limit(200).collect():
        assert r.score == pytest.approx(r.raw[1])


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail me@host.com or +1 202 555 0143!", 7), (2, "none", 8), (3, None, 9)], "doc_id bigint, text string, n int")
    clean = {r.doc_id: (r.text, r.n) for r in pii.redact(docs, pii.find_personal_data(docs)).collect()}
    assert clean == {1: ("mail [email] or [phone]!", 7), 2: ("none", 8), 3: (None, 9)}
