import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from folioscope.llm import attention as A
from folioscope.llm import scoring

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or "")) + ["\0end"]


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + draw.standard_normal(v.shape) * 0.1 for k, v in A.start(draw.integers(1, 99, A.CLASSES)).items()}
    inputs, targets = draw.integers(0, A.CLASSES, (3, A.SPAN)), draw.integers(0, A.CLASSES, (3, A.STRIDE))
    inputs[0, :5] = A.NONE
    mask = np.ones((3, A.STRIDE))
    mask[1, 9:] = 0
    _, grads = A.gradients(p, inputs, targets, mask)
    for name, weight in p.items():
        for _ in range(4):
            at = tuple(int(draw.integers(0, n)) for n in weight.shape)
            at = (int(inputs[0, 20]), at[1]) if name == "embed" else (int(targets[0, 0]) // A.MEMBERS, *at[1:]) if name == "member" else at
            kept, step = weight[at], 1e-5
            weight[at] = kept + step
            above = A.gradients(p, inputs, targets, mask)[0]
            weight[at] = kept - step
            below = A.gradients(p, inputs, targets, mask)[0]
            weight[at] = kept
            assert (above - below) / (2 * step) == pytest.approx(grads[name][at], abs=1e-5)


def plain_gradients(p, inputs, targets, mask):
    """The formulas as they are, with rows of every place of a window."""

    def heads(x, places):
        return x.reshape(-1, places, A.HEADS, A.PER_HEAD).transpose(0, 2, 1, 3)

    def softmax(s):
        s = np.exp(s - s.max(axis=-1, keepdims=True))
        return s / s.sum(axis=-1, keepdims=True)

    def flat(x):
        return x.transpose(0, 2, 1, 3).reshape(-1, A.WIDTH)

    n, kind = len(inputs), p["embed"].dtype
    distance = A.STRIDE + np.arange(A.STRIDE)[:, None] - np.arange(A.SPAN)
    far, scale = np.maximum(distance, 0), kind.type(A.PER_HEAD**-0.5)
    e = p["embed"][inputs]
    el = e[:, A.STRIDE :].reshape(-1, A.WIDTH)
    q, k, v = heads(el @ p["query"], A.STRIDE) * scale, heads(e @ p["key"], A.SPAN), heads(e @ p["value"], A.SPAN)
    s = q @ k.transpose(0, 1, 3, 2) + np.where(distance >= 0, p["near"][:, far], kind.type(-1e9))
    a = softmax(s + np.where(inputs == A.NONE, kind.type(-1e9), kind.type(0))[:, None, None, :])
    mixed = flat(a @ v)
    h1 = el + mixed @ p["mix"]
    inner = np.maximum(h1 @ p["wide"] + p["wide_b"], 0)
    h2 = h1 + inner @ p["narrow"]
    target, weight = targets.ravel(), (mask / max(1, mask.sum())).ravel().astype(kind)
    cluster, member, rows = target // A.MEMBERS, target % A.MEMBERS, np.arange(len(target))
    g = softmax(h2 @ p["group"] + p["group_b"])
    g[rows, cluster] -= 1
    g *= weight[:, None]
    d = {"group": h2.T @ g, "group_b": g.sum(axis=0), "member": np.zeros_like(p["member"]), "member_b": np.zeros_like(p["member_b"])}
    d_h = g @ p["group"].T
    for c in np.unique(cluster):
        at = np.flatnonzero(cluster == c)
        m = softmax(h2[at] @ p["member"][c] + p["member_b"][c])
        m[np.arange(len(at)), member[at]] -= 1
        m *= weight[at, None]
        d["member"][c], d["member_b"][c] = h2[at].T @ m, m.sum(axis=0)
        d_h[at] += m @ p["member"][c].T
    d["narrow"] = inner.T @ d_h
    d_inner = (d_h @ p["narrow"].T) * (inner > 0)
    d["wide"], d["wide_b"] = h1.T @ d_inner, d_inner.sum(axis=0)
    d_h = d_h + d_inner @ p["wide"].T
    d["mix"] = mixed.T @ d_h
    d_mixed = heads(d_h @ p["mix"].T, A.STRIDE)
    d_a, d_v = d_mixed @ v.transpose(0, 1, 3, 2), a.transpose(0, 1, 3, 2) @ d_mixed
    d_s = a * (d_a - (d_a * a).sum(axis=-1, keepdims=True))
    d["near"] = np.stack([np.bincount(far.ravel(), x.ravel(), A.SPAN) for x in np.where(distance >= 0, d_s, 0).sum(axis=0)]).astype(kind)
    d_q, d_k, d_v = flat(d_s @ k) * scale, flat(d_s.transpose(0, 1, 3, 2) @ q), flat(d_v)
    d["query"], d["key"], d["value"] = el.T @ d_q, e.reshape(-1, A.WIDTH).T @ d_k, e.reshape(-1, A.WIDTH).T @ d_v
    d_e = (d_k @ p["key"].T + d_v @ p["value"].T).reshape(n, A.SPAN, A.WIDTH)
    d_e[:, A.STRIDE :] += (d_h + d_q @ p["query"].T).reshape(n, A.STRIDE, A.WIDTH)
    d["embed"] = np.zeros_like(p["embed"])
    np.add.at(d["embed"], inputs.ravel(), d_e.reshape(-1, A.WIDTH))
    return d


def drawn_windows(draw, n):
    """Windows with skewed classes; some are led by absent tokens, some are filled up with them."""
    skewed = np.minimum(draw.zipf(1.2, (n, A.SPAN + A.STRIDE)), A.CLASSES - 1)
    inputs, targets = skewed[:, : A.SPAN], skewed[:, A.SPAN :]
    mask = np.ones(targets.shape, bool)
    inputs[: n // 8, : A.STRIDE] = A.NONE
    inputs[n // 8 : n // 4, A.STRIDE + 9 :], mask[n // 8 : n // 4, 9:] = A.NONE, False
    return inputs, targets, mask


@pytest.mark.parametrize("kind, size, near", [(np.float64, 1, 1e-9), (np.float64, 9, 1e-9), (np.float32, 1, 1e-4), (np.float32, 9, 1e-3)])
def test_gradients_equal_the_plain_formulas(kind, size, near):
    """Also of weights whose scores are too large for exponentials."""
    draw = np.random.default_rng(8)
    p = {k: (v * size).astype(kind) for k, v in A.start(draw.integers(1, 99, A.CLASSES)).items()}
    windows = drawn_windows(draw, 40)
    _, grads = A.gradients(p, *windows)
    for name, plain in plain_gradients(p, *windows).items():
        assert grads[name].dtype == kind and np.abs(grads[name] - plain).max() <= near * max(1e-9, np.abs(plain).max()), name


def test_a_step_takes_less_time_than_the_plain_formulas():
    draw = np.random.default_rng(9)
    p = A.start(draw.integers(1, 99, A.CLASSES))
    windows = drawn_windows(draw, scoring.BATCH)
    took = {A.gradients: [], plain_gradients: []}
    for _ in range(15):
        for step, seconds in took.items():
            began = time.thread_time()
            step(p, *windows)
            seconds.append(time.thread_time() - began)
    assert min(took[A.gradients]) < 0.8 * min(took[plain_gradients])


def test_ordinary_weights_are_scored_without_cutting_scores_off():
    draw = np.random.default_rng(10)
    scorer = A.Scorer(A.start(draw.integers(1, 99, A.CLASSES)))
    stream = np.concatenate([np.full(A.STRIDE, A.NONE), draw.integers(0, A.CLASSES, 20 * A.STRIDE)])
    target = draw.integers(0, A.CLASSES, 20 * A.STRIDE)
    assert scorer.bounded
    found = scorer.log_probabilities(stream, target)
    scorer.bounded = False
    assert scorer.log_probabilities(stream, target) == pytest.approx(found, rel=1e-6)


def test_streams_score_each_token_once_as_in_training():
    draw = np.random.default_rng(1)
    p = {k: (v + draw.standard_normal(v.shape) * 0.1).astype(np.float32) for k, v in A.start(draw.integers(1, 99, A.CLASSES)).items()}
    own = np.append(np.arange(199) % A.CLASSES, A.END).astype(np.int16)
    ids = [draw.integers(0, 198, n) for n in (0, 1, 15, 16, 17, 40, 100)]
    inputs, targets, owner = scoring._streams(ids, own, 199)
    logp = A.Scorer(p).log_probabilities(inputs, targets[A.STRIDE :])
    assert np.bincount(owner[owner >= 0]).tolist() == [len(i) + 1 for i in ids]
    for number, text in enumerate(ids):
        z = np.concatenate([np.full(A.STRIDE, A.NONE), [A.END], own[text], np.full(A.STRIDE, A.NONE)])
        y = np.concatenate([own[text], [A.END], np.zeros(A.STRIDE, int)])
        at = np.arange(-(-(len(text) + 1) // A.STRIDE))[:, None] * A.STRIDE
        inside = at + np.arange(A.STRIDE) <= len(text)
        loss, _ = A.gradients(p, z[at + np.arange(A.SPAN)], y[at + np.arange(A.STRIDE)], inside)
        assert -logp[owner[A.STRIDE :] == number].sum() == pytest.approx(loss * inside.sum(), rel=1e-4)


def test_no_token_sees_a_later_one():
    p = A.start(np.ones(A.CLASSES))
    stream = np.concatenate([np.full(A.STRIDE, A.NONE), np.arange(4 * A.STRIDE)])
    target = np.arange(4 * A.STRIDE)
    before = A.Scorer(p).log_probabilities(stream, target)
    stream[A.STRIDE + 30 :] = 5
    assert np.array_equal(A.Scorer(p).log_probabilities(stream, target)[:30], before[:30])


def test_probabilities_of_all_ids_sum_to_one():
    counts = np.zeros(50_258, np.int64)
    counts[:3000] = np.arange(3000)[::-1]
    own, class_counts, share = scoring._classes(counts)
    p = A.start(class_counts)
    stream = np.concatenate([np.full(A.STRIDE, A.NONE), np.full(A.STRIDE, 7)])
    logp = np.array([A.Scorer(p).log_probabilities(stream, np.full(A.STRIDE, c))[3] for c in range(A.CLASSES)])
    assert np.exp(logp[own] + share)[own != A.END].sum() + np.exp(logp[A.END]) == pytest.approx(1, abs=1e-3)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("the ing on her wh ed st".split()) for _ in range(draw.randint(1, 3))) for _ in range(300)]
    out = [(i, " ".join(draw.choices(vocabulary, range(300, 0, -1), k=draw.choice([1, 30, 200])))) for i in range(150)]
    return out + [(200, None), (201, ""), (202, "Unseen WORDS é 日本"), (203, "long " * 5000), (None, out[3][1]), out[5], (204, "<|endoftext|> x")]


def test_base_scores_equal_plain_python(spark, rows, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 40)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, rare string")
    got = scoring.score_texts(docs, F.col("doc_id") % 5 != 1, PATH).collect()
    counts = Counter(x for i, t in rows if i is not None and i % 5 != 1 for x in words(t))
    total, distinct = sum(counts.values()), len(counts)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        found = words(texts[r.doc_id])
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in found)
        assert r.base_score == pytest.approx(base) and r.n_tokens == len(found) and r.train_tokens == total
        assert r.n_known == sum(counts[x] > 0 for x in found)
        assert r.score < 0
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[200] == by_id[201] and by_id[203] < by_id[200]
    assert by_id[None] == by_id[3]


def test_equal_texts_have_equal_scores(spark, rows):
    """In whatever batch, place and company."""
    texts = [t for _, t in rows if t][:40]
    rng = random.Random(9)
    docs = list(enumerate(texts * 5))
    rng.shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = scoring.score_texts(table, F.col("doc_id") % 5 != 1, PATH).collect()
    seen = {}
    for r in got:
        seen.setdefault(texts[r.doc_id % len(texts)], set()).add(r.score)
    assert all(len(scores) == 1 for scores in seen.values())


def test_nothing_to_learn_from_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows[-6:], "doc_id bigint, text string")
    got = scoring.score_texts(docs, F.lit(False), PATH).collect()
    assert len(got) == 6 and all(r.n_known == r.train_tokens == 0 and r.base_score == 0 and r.score < 0 for r in got)
    assert scoring.score_texts(docs.where("false"), F.lit(True), PATH).count() == 0


def test_every_subword_of_a_long_text_is_a_target_once():
    subwords = scoring.Subwords(PATH)
    for n in (0, 1, 15, 16, 255, 256, 257, 11_664):
        ids = np.arange(n, dtype=np.uint32) % 50_000
        windows = scoring._windows(list(scoring._pieces(ids, subwords)), subwords.kind, subwords.none)
        targets = windows[:, A.STRIDE + 1 :].ravel()
        assert targets[targets != subwords.none].tolist() == [*ids.tolist(), subwords.end]
        whole = np.concatenate([np.full(A.STRIDE, subwords.none), [subwords.end], ids, [subwords.end]])
        for k, window in enumerate(windows):
            inside = whole[k * A.STRIDE :][: len(window)]
            assert np.array_equal(window[: len(inside)], inside) and (window[len(inside) :] == subwords.none).all()


def test_what_learning_gathers_grows_with_the_text(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(text,)], "text string")
    rows = docs.mapInArrow(scoring._gather(PATH), "words array<bigint>, n array<bigint>, ids array<int>, id_n array<bigint>, piece binary").collect()
    subwords = scoring.Subwords(PATH)
    windows = scoring._windows([bytes(r.piece) for r in rows if r.piece is not None], subwords.kind, subwords.none)
    n = len(subwords.of([x.encode() for x in text.split()])) // 4
    assert (windows[:, A.STRIDE + 1 :] != subwords.none).sum() == n + 1
