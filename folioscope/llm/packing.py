"""Vector bin packing of examples into training sequences.

An example demands tokens, one segment, and loss-bearing tokens; a sequence has a capacity for
each. Full sequences are cut from long examples; what is left waits in a buffer of bounded
size. The open sequence takes the waiting piece with the largest dot product of its demand and
the capacity left, both as shares of the capacity, as long as one fits; then a piece is cut to
fill the rest. A sequence that still isn't full, for want of segments, loss or pieces, is
divided at powers of two, which need no padding.

Every task packs its own rows: nothing is shuffled, and only the last sequence of a task can
lack pieces. Sequence numbers hold the partition in their upper bits, so a task that is run
again numbers alike.

Defined cases: a null text is empty and consists of the end id; a null id is passed on;
repeated rows are packed each; an empty table gives no pieces. Very long texts are encoded one at a
time, in memory proportional to the text. Other columns, of any name, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.tokens import encoder

SEQUENCE = 2048
SEGMENTS = 256
#: Pieces that wait in a task.
WAITING = 512
#: Bits of a sequence number below the partition.
LOCAL_BITS = 40


class Packer:
    """Assigns pieces to sequences; ``place`` gets (piece, start, length, sequence, offset)."""

    def __init__(self, place, tokens: int = SEQUENCE, segments: int = SEGMENTS, loss: int | None = None):
        self.place = place
        self.limits = np.array([tokens, segments, loss or tokens], np.int64)
        self.sequence = 0
        self.waiting: list = []  # example, start, length, first loss-bearing index

    @staticmethod
    def _loss(start: int, length: int, loss_from: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def add(self, example, length: int, loss_from: int = 0) -> None:
        start, whole = 0, int(self.limits[0])
        while length - start >= whole and self._loss(start, whole, loss_from) <= self.limits[2]:
            self._close([(example, start, whole)])
            start += whole
        if start < length:
            self.waiting.append((example, start, length - start, loss_from))
            if len(self.waiting) >= 2 * WAITING:
                self._pack(WAITING)

    def finish(self) -> None:
        self._pack(0)

    def _pack(self, keep: int) -> None:
        """Fill sequences until no more than ``keep`` pieces wait."""
        tokens = np.array([p[2] for p in self.waiting], np.int64)
        loss = np.array([self._loss(p[1], p[2], p[3]) for p in self.waiting], np.int64)
        free = np.ones(len(tokens), bool)
        limit, segments, loss_limit = map(int, self.limits)
        alive = len(tokens)
        while alive > keep:
            left, left_segments, left_loss, pieces = limit, segments, loss_limit, []
            while left_segments:
                fits = free & (tokens <= left) & (loss <= left_loss)
                # every piece demands one segment, so that part of the product is equal for all
                product = tokens * (left / limit**2) + loss * (left_loss / loss_limit**2)
                best = int(np.argmax(np.where(fits, product, -1.0)))
                if not fits[best]:
                    break
                free[best] = False
                alive -= 1
                pieces.append(self.waiting[best][:3])
                left, left_segments, left_loss = left - int(tokens[best]), left_segments - 1, left_loss - int(loss[best])
            if left and left_segments and alive:
                self._fill(tokens, loss, free, left, left_loss, pieces)
            self._close(pieces)
        self.waiting = [self.waiting[i] for i in np.flatnonzero(free)]

    def _fill(self, tokens: np.ndarray, loss: np.ndarray, free: np.ndarray, left: int, left_loss: int, pieces: list) -> None:
        """Cut the longest waiting piece so that its head fills the sequence."""
        at = int(np.argmax(np.where(free, tokens, -1)))
        example, start, length, loss_from = self.waiting[at]
        head = min(left, length - 1, max(loss_from - start, 0) + left_loss)
        if head > 0:
            pieces.append((example, start, head))
            self.waiting[at] = example, start + head, length - head, loss_from
            tokens[at], loss[at] = length - head, self._loss(start + head, length - head, loss_from)

    def _close(self, pieces: list) -> None:
        fill = sum(p[2] for p in pieces)
        room = self._room(fill)
        offset = 0
        for example, start, length in pieces:
            while length:
                part = min(length, room - offset)
                self.place(example, start, part, self.sequence, offset)
                start, length, offset, fill = start + part, length - part, offset + part, fill - part
                if offset == room:
                    self.sequence, offset, room = self.sequence + 1, 0, self._room(fill)

    def _room(self, fill: int) -> int:
        """Length of the next sequence: full, or the largest power of two that can be filled."""
        if fill >= self.limits[0]:
            return int(self.limits[0])
        return 1 << (fill.bit_length() - 1) if fill else 0


def pack_examples(
    docs: DataFrame,
    path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: int = SEQUENCE,
    segments: int = SEGMENTS,
    loss: int | None = None,
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of the token ids of each text, ended by ``end_id``, in their sequences.

    ``prompt`` names a column with text before ``text`` that bears no loss. Per piece: id,
    ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``,
    ``offset``, ``loss_tokens``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    before = F.col(prompt) if prompt else F.lit(None).cast("string")
    narrow = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), before.alias("prompt"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        base = TaskContext.get().partitionId() << LOCAL_BITS
        rows: list = []

        def place(example, start, length, sequence, offset):
            doc, ids, loss_from = example
            rows.append(
                (doc, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, base + sequence, offset,
                 Packer._loss(start, length, loss_from))
            )

        packer = Packer(place, tokens, segments, loss)
        names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
        for batch in batches:
            for doc, body, head in zip(batch["doc"].astype(object), batch["text"], batch["prompt"]):
                prefix = encode(head)
                ids = prefix + encode(body) + end
                packer.add((None if pd.isna(doc) else doc, ids, len(prefix) // 4), len(ids) // 4)
                if len(rows) >= 4_096:
                    yield pd.DataFrame(rows, columns=names)
                    rows.clear()
        packer.finish()
        yield pd.DataFrame(rows, columns=names)

    found = narrow.mapInPandas(
        run,
        f"doc {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, loss_tokens bigint",
    )
    return found.withColumnRenamed("doc", doc_id)


def with_digest(pieces: DataFrame) -> DataFrame:
    """The checksum of each piece's ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids"))
