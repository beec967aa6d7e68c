"""Language-model scores: word unigrams of the corpus and a causal self-attention model.

Learning reads all texts that it may: every word and subword is counted, and the windows that
train the attention model cover every text from end to end, so each of its subwords is a target
once, with the tokens before it that scoring uses. Trainers, whose number grows with the windows, run Adam over
their own windows; after each round their weights are averaged. The counts of subwords choose
the classes of the model and give the share of a rare id among those of its class.

Scoring runs over whole texts. The most frequent words, a bounded number, are known to every
task; all others leave it as counts per text and meet the corpus counts in a join. The attention
model scores each subword once, in overlapping windows.

A word is a run of anything but white space, with A-Z lower-cased; an end follows the last one.
Subwords are those of each word with a blank before it, so a text's words and its subwords
determine each other.

Defined cases: a null text is empty and consists of the end. Without a text to learn from all
counts are 0 and the model is the uniform one. Null ids are passed on and aren't held out.
Repeated rows are counted and scored each; equal texts have equal scores, wherever they stand. An
empty table gives no rows. Very long texts are scored one at a time, in memory proportional to the
text. Other columns, of any name, are not read but for what ``learn`` asks for.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm import attention
from folioscope.llm import words as w
from folioscope.llm.attention import CLASSES, END, NONE, SHARED, SPAN, STRIDE
from folioscope.llm.storage import cut
from folioscope.llm.tokens import _CACHES, Cache, Splitter, id_bytes

#: Bound of the words that every task knows.
FREQUENT = 1 << 18
#: Windows of a piece of text, which is dealt as one; windows of a trainer, rounds of averaging,
#: each over its own share of the pieces, once, however many there are; windows of a step.
PIECE, PER_TRAINER, ROUNDS, BATCH = 16, 100_000, 3, 128
RATE = 0.004
#: A window's ids with the one that follows.
WINDOW = SPAN + 1
#: Columns of what learning gathers; rows of pieces that leave a task at once.
NAMES, ROWS = ["words", "n", "ids", "id_n", "piece"], 4096
#: Stands for the end among word hashes.
END_WORD = np.uint64(0xE9D0F1A2B3C4D5E6)
SMOOTH = 0.01


class Subwords:
    """Ids of words, as bytes, from the cache of the worker. ``end`` and ``none`` (no token) are
    ids that no word has; ``kind`` holds all of them."""

    def __init__(self, path: str):
        splitter = Splitter(path)
        self.size = splitter.library.get_vocab_size()
        self.end, self.none = self.size, self.size + 1
        self.kind = "<u2" if self.none < 1 << 16 else "<u4"
        key = "word", path, id_bytes
        if key not in _CACHES:
            _CACHES[key] = Cache(lambda word: id_bytes(splitter.whole_ids(f" {word.decode()}")))
        self._get = _CACHES[key].__getitem__

    def of(self, words: list[bytes]) -> bytes:
        return b"".join(map(self._get, words))

    def each(self, words: list[bytes]) -> list[bytes]:
        return list(map(self._get, words))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for first, last, data, offsets in w.text_blocks(batch, "text"):
        raw = data.tobytes().lower()
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield raw[a:b]


def _pieces(ids: np.ndarray, subwords: Subwords) -> Iterator[bytes]:
    """A text for training: its ids, led as in scoring, in pieces of ``PIECE`` windows. A piece
    repeats what its first window needs of the one before."""
    lead = np.full(STRIDE + 1, subwords.none)
    lead[STRIDE] = subwords.end
    whole = np.concatenate([lead, ids, [subwords.end]]).astype(subwords.kind)
    for at in range(0, len(ids) + 1, PIECE * STRIDE):
        yield whole[at : at + PIECE * STRIDE + STRIDE + 1].tobytes()


def _windows(pieces: list[bytes], kind: str, none: int) -> np.ndarray:
    """The windows of pieces, each ``STRIDE`` after the one before; the last is filled up."""
    out = [np.zeros((0, WINDOW), kind)]
    for piece in pieces:
        ids = np.frombuffer(piece, kind)
        n = -(-(len(ids) - STRIDE - 1) // STRIDE)
        full = np.full(n * STRIDE + STRIDE + 1, none, kind)
        full[: len(ids)] = ids
        out.append(np.lib.stride_tricks.sliding_window_view(full, WINDOW)[::STRIDE])
    return np.concatenate(out)


def _gather(path: str):
    """Word and subword counts, a row for every batch; pieces of the texts, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(path)
        for batch in batches:
            seen: Counter = Counter()
            pieces: list[bytes] = []
            for raw in _texts(batch):
                words = raw.split()
                seen.update(words)
                pieces.extend(_pieces(np.frombuffer(subwords.of(words), "<u4"), subwords))
                if len(pieces) >= ROWS:
                    yield alone(pieces)
                    pieces = []
            if pieces:
                yield alone(pieces)
            unique, counts = list(seen), np.fromiter(seen.values(), np.int64, len(seen))
            joined = np.frombuffer(b" ".join(unique), np.uint8)
            hashes = w.words_of(joined, np.array([0, len(joined)])).hashes
            ids = subwords.each(unique)
            flat = np.frombuffer(b"".join(ids), "<u4")
            id_counts = np.bincount(flat, np.repeat(counts, [len(i) // 4 for i in ids]), subwords.size + 1).astype(np.int64)
            id_counts[subwords.end] = batch.num_rows
            used = np.flatnonzero(id_counts)
            hashes, counts = np.append(hashes, END_WORD), np.append(counts, batch.num_rows)
            one = lambda x, kind: w.list_array(x, np.array([len(x)]), kind)
            yield pa.RecordBatch.from_arrays(
                [one(hashes, pa.int64()), one(counts, pa.int64()), one(used.astype(np.int32), pa.int32()), one(id_counts[used], pa.int64()),
                 pa.nulls(1, pa.binary())],
                names=NAMES,
            )

    def alone(pieces: list[bytes]) -> pa.RecordBatch:
        longs, ints = pa.nulls(len(pieces), pa.list_(pa.int64())), pa.nulls(len(pieces), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([longs, longs, ints, longs, pa.array(pieces, pa.binary())], names=NAMES)

    return run


def _classes(id_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each id, count of each class, and the log share of each id in its class."""
    size, end = len(id_counts), len(id_counts) - 1
    order = np.argsort(-id_counts[:end], kind="stable")
    order = order[: CLASSES - SHARED - 1]
    # neighbouring ids are often alike, so classes are dealt by a mixed hash
    own = (CLASSES - SHARED + w.mix(np.arange(size, dtype=np.uint64)) % np.uint64(SHARED)).astype(np.int16)
    own[order[id_counts[order] > 0]] = np.arange(1, 1 + int((id_counts[order] > 0).sum()))
    own[end] = END
    counts = np.bincount(own, id_counts, CLASSES)
    rare = own >= CLASSES - SHARED
    members = np.bincount(own[rare], minlength=CLASSES)
    share = np.zeros(size)
    share[rare] = np.log((id_counts[rare] + SMOOTH) / (counts[own[rare]] + SMOOTH * members[own[rare]]))
    return own, counts, share


def _flatten(p: attention.Weights) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in attention.NAMES]).astype(np.float32)


def _unflatten(flat: np.ndarray, like: attention.Weights) -> attention.Weights:
    out, at = {}, 0
    for name in attention.NAMES:
        size = like[name].size
        out[name] = flat[at : at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    return out


def _trainer(shared, number: int):
    """One round over the windows of a trainer: its weights and how many windows it saw."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        flat, own, like, kind = shared.value
        table = np.append(own, NONE)  # no token is the last
        ids = _windows(part["piece"], kind, len(own))
        classes = table[ids].astype(np.int64)
        inputs, targets = classes[:, :SPAN], classes[:, STRIDE + 1 :]
        mask = (targets != NONE) & (inputs[:, STRIDE:] != NONE)
        targets = np.where(mask, targets, 0)
        p = _unflatten(flat, like)
        adam, rng = attention.Adam(p, RATE), np.random.default_rng(number)
        steps = -(-len(ids) // BATCH)
        order = rng.permutation(len(ids))
        for step in range(steps):
            at = np.take(order, np.arange(step * BATCH, (step + 1) * BATCH), mode="wrap")
            _, grads = attention.gradients(p, inputs[at], targets[at], mask[at])
            done = (number + step / steps) / ROUNDS
            adam.update(grads, min(1.0, 2 * (1 - done)) * min(1.0, (step + 1) / 20))
        return pd.DataFrame({"weights": [_flatten(p)], "n": [len(ids)]})

    return run


def _train(gathered: DataFrame, own: np.ndarray, counts: np.ndarray, kind: str) -> attention.Weights:
    spark = gathered.sparkSession
    p = attention.start(counts)
    targets = F.octet_length("piece") / np.dtype(kind).itemsize - STRIDE - 1
    total = gathered.agg(F.sum(F.ceil(targets / STRIDE))).first()[0] or 0
    if not total:
        return p
    trainers = max(1, total // PER_TRAINER)
    # dealt by row, not by content: copies spread over all trainers. The rows are a checkpoint's,
    # so each round finds them in the same places
    row = F.xxhash64(F.monotonically_increasing_id())
    dealt = gathered.select("piece", F.pmod(row, F.lit(trainers)).alias("trainer"), F.pmod(F.shiftright(row, 32), F.lit(ROUNDS)).alias("round"))
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast((_flatten(p), own, p, kind))
        part = dealt.where(F.col("piece").isNotNull() & (F.col("round") == number)).select("trainer", "piece")
        found = part.groupBy("trainer").applyInPandas(_trainer(shared, number), "weights array<float>, n bigint")
        # averaged place by place, with partial sums before the shuffle
        places = found.select("n", F.posexplode("weights").alias("place", "weight"))
        mean = places.groupBy("place").agg((F.sum(F.col("weight").cast("double") * F.col("n")) / F.sum("n")).alias("weight"))
        table = mean.toPandas()
        if len(table):
            flat = np.empty(len(table), np.float32)
            flat[table["place"].to_numpy()] = table["weight"].to_numpy()
            p = _unflatten(flat, p)
    return p


def _streams(ids: list[np.ndarray], own: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets of texts in blocks, and the text of each target (-1: none)."""
    sizes = np.array([len(i) + 1 for i in ids])
    blocks = -(-sizes // STRIDE) * STRIDE
    begin = np.cumsum(blocks + STRIDE) - blocks  # after the leading block
    n = int((blocks + STRIDE).sum())
    inputs, targets, owner = np.full(n, NONE, np.int64), np.zeros(n, np.int64), np.full(n, -1)
    row = np.repeat(np.arange(len(ids)), sizes)
    place = begin[row] + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = np.concatenate([part for i in ids for part in (i, [end])]).astype(np.int64)
    targets[place] = own[flat]
    owner[place] = row
    inputs[begin] = END
    inside = np.arange(len(flat)) != np.cumsum(sizes)[row] - 1
    inputs[place[inside] + 1] = own[flat[inside]]
    return inputs, targets, owner


def _score(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, own, share, frequent, logs = shared.value
        subwords, scorer = Subwords(path), attention.Scorer(p)
        for batch in batches:
            for first, last, data, offsets in w.text_blocks(batch, "text"):
                n = last - first
                found = w.words_of(data, offsets)
                at = np.minimum(np.searchsorted(frequent, found.hashes), max(len(frequent) - 1, 0))
                known = frequent[at] == found.hashes if len(frequent) else np.zeros(len(at), bool)
                base = np.bincount(found.row[known], logs[at[known]] if len(frequent) else None, n)
                n_known = np.bincount(found.row[known], minlength=n)
                rare, row = found.hashes[~known], found.row[~known]
                order = np.lexsort((rare, row))
                rare, row = rare[order], row[order]
                fresh = np.ones(len(rare), bool)
                fresh[1:] = (rare[1:] != rare[:-1]) | (row[1:] != row[:-1])
                heads = np.flatnonzero(fresh)
                repeats = np.diff(np.append(heads, len(rare)))
                lists = np.bincount(row[heads], minlength=n)

                raw = data.tobytes().lower()
                ids = [np.frombuffer(subwords.of(raw[a:b].split()), "<u4") for a, b in zip(offsets[:-1], offsets[1:])]
                inputs, targets, owner = _streams(ids, own, subwords.end)
                logs_of = []
                step = 16 * attention.WINDOWS * STRIDE
                for begin in range(0, len(inputs) - STRIDE, step):
                    end = min(begin + step, len(inputs) - STRIDE)
                    logp = scorer.log_probabilities(inputs[begin : end + STRIDE], targets[begin + STRIDE : end + STRIDE])
                    logs_of.append(logp)
                # added up in the order of the text, wherever it stands
                whose = owner[STRIDE:]
                inside = whose >= 0
                score = np.bincount(whose[inside], np.concatenate(logs_of)[inside].astype(np.float64), n)
                score += [share[i].sum() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, n),
                        batch.column("learned").slice(first, n),
                        pa.array(found.counts + 1, pa.int64()),
                        pa.array(n_known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(score / math.log(10), pa.float64()),
                        w.list_array(rare[heads], lists, pa.int64()),
                        w.list_array(repeats.astype(np.int32), lists, pa.int32()),
                    ],
                    names=["doc", "learned", "n_tokens", "n_known", "base", "score", "rare", "times"],
                )

    return run


def _least_frequent(words: DataFrame, bound: int = FREQUENT) -> int:
    """A count that at most ``bound`` words reach, from the sizes of bands of counts."""
    band = F.floor(F.log2(F.col("count")) * 8).cast("int")
    sizes = words.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.min("count").alias("least")).orderBy(F.desc("band"))
    least, total = 1 << 62, 0
    for row in sizes.collect():
        total += row.n
        if total > bound:
            break
        least = row.least
    return least


def score_texts(docs: DataFrame, learn: Column, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``learned`` (value of ``learn``), ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, the logarithms to base 10 of the text's probability."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text).alias("text"))
    gathered = cut(
        narrow.where("learned").select("text").mapInArrow(
            _gather(path), "words array<bigint>, n array<bigint>, ids array<int>, id_n array<bigint>, piece binary"
        )
    )
    words = gathered.select(F.explode(F.arrays_zip("words", "n")).alias("x")).groupBy(F.col("x.words").alias("word")).agg(F.sum("x.n").alias("count"))
    words = cut(words)
    total, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    divisor = total + 0.5 * (distinct + 1)
    top = words.where(F.col("count") >= _least_frequent(words)).toPandas()
    hashes, counts = top["word"].to_numpy(np.int64).view(np.uint64), top["count"].to_numpy(np.int64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]

    found = gathered.select(F.explode(F.arrays_zip("ids", "id_n")).alias("x")).groupBy(F.col("x.ids").alias("id")).agg(F.sum("x.id_n").alias("n"))
    subwords = Subwords(path)
    id_counts = np.zeros(subwords.size + 1, np.int64)
    for row in found.collect():
        id_counts[row.id] = row.n
    own, class_counts, share = _classes(id_counts)
    p = _train(gathered, own, class_counts, subwords.kind)

    shared = spark.sparkContext.broadcast((p, own, share, hashes, np.log10((counts + 0.5) / divisor)))
    schema = f"doc {kind}, learned boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>, times array<int>"
    scored = cut(narrow.mapInArrow(_score(path, shared), schema).withColumn("row_no", F.monotonically_increasing_id()))
    rare = scored.select("row_no", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row_no", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(words, "word", "left")
    seen = F.coalesce("count", F.lit(0))
    more = met.groupBy("row_no").agg(
        F.sum(F.col("times") * F.log10((seen + 0.5) / F.lit(float(divisor)))).alias("more"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("also"),
    )
    end_count = words.where(F.col("word") == F.lit(int(END_WORD.view(np.int64)))).select("count").first()
    end_count = end_count[0] if end_count else 0
    zero = F.lit(0)
    return scored.join(more, "row_no", "left").select(
        F.col("doc").alias(doc_id),
        "learned",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also", zero) + F.lit(int(end_count > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(math.log10((end_count + 0.5) / divisor))).alias("base_score"),
        "score",
    )
