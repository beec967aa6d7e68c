"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes, all of them; the network runs over each window
in both directions and gives every byte a distribution over the learned languages. A document's
probabilities are the mean over its bytes.

The network is trained in NumPy by backpropagation through time on a bounded sample: windows
from all parts of at most ``TEXTS`` labelled texts a language, chosen by a hash of the text. Its
inputs are bytes alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text
if there is nothing to learn from. Rows without a label aren't learned from. Repeated rows get
equal predictions; null ids count as not held out. An empty table gives no rows. Very long texts
are read whole, in memory proportional to the text. Other columns, of any name, are not read but
for what ``learn`` asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm import words as w

WINDOW = 64
HIDDEN = 12
#: Bounds of the sample: texts of a language, and windows of a text.
TEXTS, PIECES = 600, 8
#: So many times as many texts are expected among the hashes that are ranked.
DRAWN = 4
STEPS, BATCH, RATE = 500, 256, 0.01
#: Windows that run side by side.
LANES = 512
UNKNOWN = "und"


@dataclass
class Network:
    """Index 0 of the first axis reads forwards, 1 backwards. Gates: update, reset, candidate."""

    x: np.ndarray  # (2, 256, 3 * HIDDEN), input weights with their bias
    h: np.ndarray  # (2, HIDDEN, 3 * HIDDEN)
    out: np.ndarray  # (2, HIDDEN, languages)
    bias: np.ndarray  # (languages,)
    languages: list[str]

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.x, self.h, self.out, self.bias]


def _start(languages: list[str], seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)

    def near_zero(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    n = len(languages)
    return Network(
        near_zero(2, 256, 3 * HIDDEN, scale=0.3),
        near_zero(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        near_zero(2, HIDDEN, n, scale=HIDDEN**-0.5),
        np.zeros(n, np.float32),
        languages,
    )


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def label_bytes(net: Network, windows: np.ndarray) -> np.ndarray:
    """Distribution of every byte: (language, place, window)."""
    n, size = windows.shape
    # the logistic function is half a hyperbolic tangent of half its argument
    halves = (0.5, 0.5, 1.0)
    tables = [np.ascontiguousarray(part * s).reshape(512, HIDDEN) for part, s in zip(np.split(net.x, 3, axis=2), halves)]
    recur = [np.ascontiguousarray(part * s) for part, s in zip(np.split(net.h, 3, axis=2), map(np.float32, halves))]
    tables = [t.astype(np.float32) for t in tables]
    steps = windows.T.astype(np.intp)
    read = np.stack([steps, steps[::-1] + 256])  # the backward direction has the second half of the tables
    states = np.empty((2, size, n, HIDDEN), np.float32)
    h = np.zeros((2, n, HIDDEN), np.float32)
    gates = [np.empty((2, n, HIDDEN), np.float32) for _ in range(3)]
    inner = np.empty((2, n, HIDDEN), np.float32)
    update, reset, new = gates
    for t in range(size):
        for gate, table in zip(gates, tables):
            np.take(table, read[:, t], axis=0, out=gate, mode="clip")
        for gate, weight in zip((update, reset), recur):
            np.matmul(h, weight, out=inner)
            gate += inner
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
        np.matmul(h, recur[2], out=inner)
        inner *= reset
        new += inner
        np.tanh(new, out=new)
        h -= new
        h *= update
        h += new
        states[0, t], states[1, size - 1 - t] = h
    flat = states.reshape(2, -1, HIDDEN)
    total = net.out[0].T @ flat[0].T
    total += net.out[1].T @ flat[1].T
    total += net.bias[:, None]
    total -= total.max(axis=0)
    np.exp(total, out=total)
    total /= total.sum(axis=0)
    return total.reshape(-1, size, n)


def _gradients(net: Network, windows: np.ndarray, target: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes of the mask, and its gradients, through time."""
    n, size = windows.shape
    order = np.stack([windows.T, windows.T[::-1]])  # (2, size, n): the byte at each step
    kept = []
    h = np.zeros((2, n, HIDDEN), np.float32)
    states = np.empty((size, 2, n, HIDDEN), np.float32)
    for t in range(size):
        gates = np.stack([net.x[0][order[0, t]], net.x[1][order[1, t]]])
        from_h = h @ net.h
        both = 1 / (1 + np.exp(-(gates[:, :, : 2 * HIDDEN] + from_h[:, :, : 2 * HIDDEN])))
        update, reset = both[:, :, :HIDDEN], both[:, :, HIDDEN:]
        inner = from_h[:, :, 2 * HIDDEN :]
        new = np.tanh(gates[:, :, 2 * HIDDEN :] + reset * inner)
        kept.append((h, update, reset, inner, new))
        h = new + update * (h - new)
        states[t] = h
    at = np.stack([states[:, 0], states[::-1, 1]])  # (2, place, n, HIDDEN)
    prob = _softmax(at[0] @ net.out[0] + at[1] @ net.out[1] + net.bias)
    known = mask.T[:, :, None]
    loss = -(np.log(np.maximum(np.take_along_axis(prob, target[None, :, None], 2), 1e-9)) * known).sum() / known.sum()
    d = prob
    np.put_along_axis(d, np.broadcast_to(target[None, :, None], (size, n, 1)), np.take_along_axis(d, target[None, :, None], 2) - 1, 2)
    d *= known / known.sum()
    d_out = np.einsum("dtnh,tnl->dhl", at, d)
    d_bias = d.sum(axis=(0, 1))
    d_at = np.stack([d @ net.out[0].T, (d @ net.out[1].T)[::-1]])  # by step
    d_x, d_h = np.zeros_like(net.x), np.zeros_like(net.h)
    back = np.zeros((2, n, HIDDEN), np.float32)
    for t in reversed(range(size)):
        before, update, reset, inner, new = kept[t]
        back = back + d_at[:, t]
        d_new = back * (1 - update) * (1 - new * new)
        d_update = back * (before - new) * update * (1 - update)
        d_reset = d_new * inner * reset * (1 - reset)
        d_gate = np.concatenate([d_update, d_reset, d_new], axis=2)
        d_from = np.concatenate([d_update, d_reset, d_new * reset], axis=2)
        for k in range(2):
            np.add.at(d_x[k], order[k, t], d_gate[k])
        d_h += before.transpose(0, 2, 1) @ d_from
        back = back * update + d_from @ net.h.transpose(0, 2, 1)
    return float(loss), [d_x, d_h, d_out, d_bias]


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS) -> Network:
    """Adam over random batches that hold each language equally often."""
    net, rng = _start(languages), np.random.default_rng(11)
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first, second = ([np.zeros_like(p) for p in net.weights] for _ in range(2))
    place = np.arange(windows.shape[1])
    for step in range(1, steps + 1):
        chosen = np.array([rng.choice(groups[k]) for k in rng.integers(0, len(groups), BATCH)])
        _, grads = _gradients(net, windows[chosen], labels[chosen], place < lengths[chosen, None])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for weight, grad, m, v in zip(net.weights, grads, first, second):
            grad = grad * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _sample(labelled: DataFrame, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Windows of ``labelled`` (``text``, ``lang``): byte windows, their lengths and languages."""
    hashed = labelled.withColumn("draw", F.xxhash64("text"))
    # a share of the hashes that holds some times as many as wanted leaves the tasks, no more:
    # copies of a text have one hash, and a language may be that of nearly all documents
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()
    share = F.lit(None).cast("bigint")
    for row in sizes:
        until = min((1 << 63) - 1, (DRAWN * texts << 64) // max(row.n, 1) - (1 << 63))
        share = F.when(F.col("lang") == row.lang, F.lit(until)).otherwise(share)
    near = hashed.select("lang", "draw").where(F.col("draw") <= share).distinct()
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    last = {r.lang: r.draw for r in ranked.where(F.col("n") <= texts).groupBy("lang").agg(F.max("draw").alias("draw")).collect()}
    languages = sorted(last)
    if not languages:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), np.zeros(0, int), []
    limit = F.lit(None).cast("bigint")
    for lang, draw in last.items():
        limit = F.when(F.col("lang") == lang, draw).otherwise(limit)
    # copies share their hash: one of them is enough, and keeps the bound
    drawn = hashed.where(F.col("draw") <= limit).dropDuplicates(["lang", "draw"])
    start = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda i: F.substr("text", 1 + F.pmod(F.xxhash64("draw", i), F.greatest(F.char_length("text") - WINDOW + 1, F.lit(1))).cast("int"), F.lit(WINDOW)),
    )
    rows = drawn.select("lang", "draw", F.posexplode(start).alias("i", "piece")).orderBy("draw", "i", "lang").collect()
    raw = [r.piece.encode()[:WINDOW] for r in rows]
    windows = np.frombuffer(b"".join(b.ljust(WINDOW, b"\0") for b in raw), np.uint8).reshape(-1, WINDOW)
    return windows, np.array([len(b) for b in raw]), np.array([languages.index(r.lang) for r in rows]), languages


def _pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean distribution over the bytes of each row."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + number * WINDOW
    length = np.minimum(WINDOW, offsets[row + 1] - start)
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    total = np.zeros((len(sizes), len(net.languages)))
    place = np.arange(WINDOW)
    for first in range(0, len(start), LANES):
        part = slice(first, first + LANES)
        inside = place < length[part, None]
        windows = padded[start[part, None] + place] * inside
        prob = label_bytes(net, windows)
        prob *= inside.T
        np.add.at(total, row[part], prob.sum(axis=1).T)
    return total / np.maximum(sizes, 1)[:, None]


def identify(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TEXTS) -> DataFrame:
    """Per row: id, ``learned`` (value of ``learn``), ``lang_pred``, ``score``.

    ``learn`` says which rows the network may learn from."""
    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    windows, lengths, labels, languages = _sample(narrow.where(F.col("learned") & has_letter & F.col("lang").isNotNull()).select("text", "lang"), texts)
    rows = narrow.select("doc", "learned", F.when(has_letter, F.col("text")).alias("text"))
    if not languages:
        return rows.select(F.col("doc").alias(doc_id), "learned", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(train(windows, lengths, labels, languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        names = np.array(net.languages, object)
        for batch in batches:
            for first, last, data, offsets in w.text_blocks(batch, "text"):
                prob = _pooled(net, data, offsets)
                best, known = prob.argmax(axis=1), np.diff(offsets) > 0
                score = np.where(known, np.clip(prob.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, last - first),
                        batch.column("learned").slice(first, last - first),
                        pa.array(np.where(known, names[best], UNKNOWN).tolist(), pa.string()),
                        pa.array(score, pa.float64()),
                    ],
                    names=["doc", "learned", "lang_pred", "score"],
                )

    found = rows.mapInArrow(run, f"doc {kind}, learned boolean, lang_pred string, score double")
    return found.withColumnRenamed("doc", doc_id)
