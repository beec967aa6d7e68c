import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import language


def test_gradients_equal_differences():
    net, draw = language._start(["a", "b", "c"]), np.random.default_rng(0)
    for name in ("x", "h", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows, target = draw.integers(0, 256, (5, 7)).astype(np.uint8), draw.integers(0, 3, 5)
    mask = np.ones((5, 7), bool)
    mask[2, 4:] = False
    _, grads = language._gradients(net, windows, target, mask)
    for weight, grad in zip(net.weights, grads):
        for _ in range(6):
            at = tuple(int(draw.integers(0, n)) for n in weight.shape)
            if grad is grads[0]:
                at = at[0], int(windows[draw.integers(0, 2), draw.integers(0, 7)]), at[2]
            kept, step = weight[at], 1e-4
            weight[at] = kept + step
            above = language._gradients(net, windows, target, mask)[0]
            weight[at] = kept - step
            below = language._gradients(net, windows, target, mask)[0]
            weight[at] = kept
            assert (above - below) / (2 * step) == pytest.approx(grad[at], abs=5e-5)


def test_labels_equal_the_training_network():
    net, draw = language._start(["a", "b", "c", "d"]), np.random.default_rng(1)
    windows = draw.integers(0, 256, (9, language.WINDOW)).astype(np.uint8)
    prob = language.label_bytes(net, windows)
    assert np.allclose(prob.sum(axis=0), 1, atol=1e-5)
    for k in range(4):
        loss, _ = language._gradients(net, windows, np.full(9, k), np.ones(windows.shape, bool))
        assert -np.log(prob[k]).mean() == pytest.approx(loss, rel=1e-3)


def test_pooling_covers_every_byte():
    net, draw = language._start(["a", "b"]), np.random.default_rng(2)
    texts = [b"", b"x", bytes(draw.integers(97, 123, 64).astype(np.uint8)), bytes(draw.integers(97, 123, 1000).astype(np.uint8))]
    offsets = np.cumsum([0, *map(len, texts)])
    pooled = language._pooled(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, got in zip(texts[1:], pooled[1:]):
        total = np.zeros(2)
        for at in range(0, len(text), language.WINDOW):
            part = text[at : at + language.WINDOW]
            window = np.frombuffer(part.ljust(language.WINDOW, b"\0"), np.uint8)[None]
            total += language.label_bytes(net, window)[:, : len(part), 0].sum(axis=1)
        assert np.allclose(got, total / len(text), atol=1e-4)


def test_held_out_accuracy_and_defined_cases(spark):
    draw = random.Random(1)
    syllables = {"aa": "the ing on her wh th ed".split(), "bb": "ñ ció los mente qu as".split(), "cc": "öß sch ung keit ver ü".split()}

    def text(lang, n):
        return " ".join("".join(draw.choice(syllables[lang]) for _ in range(draw.randint(1, 4))) for _ in range(n))

    rows = [(i, text(lang, draw.choice([5, 40, 400])), lang) for i in range(240) for lang in [draw.choice(list(syllables))]]
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", "cc"), (903, text("bb", 9), None), (None, text("aa", 9), "aa")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + odd + [rows[0]]], "doc_id bigint, text string, lang string, score double")
    learn = F.col("doc_id") % 5 != 0
    got = {r.doc_id: r for r in language.identify(docs, learn).collect()}
    assert all(got[i].lang_pred == lang and 0.34 <= got[i].score <= 1 for i, _, lang in rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903].lang_pred == "bb" and got[None].lang_pred == "aa" and not got[None].learned
    nothing = language.identify(docs, F.lit(False)).collect()
    assert len(nothing) == len(rows) + 6 and {r.lang_pred for r in nothing} == {"und"}
    assert language.identify(docs.where("false"), learn).count() == 0
