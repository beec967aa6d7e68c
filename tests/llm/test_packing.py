import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folioscope.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("segments", "loss"), [(256, None), (4, None), (256, 1000)])
def test_limits_hold_and_nothing_is_lost(segments, loss):
    draw, out = random.Random(1), []
    examples = {i: draw.choice([1, 2, 5, draw.randint(1, 3000), draw.randint(1, 20000)]) for i in range(1500)}
    bears = {i: draw.randint(0, n) for i, n in examples.items()}
    packer = packing.Packer(lambda *piece: out.append(piece), 2048, segments, loss)
    for i, n in examples.items():
        packer.add(i, n, bears[i])
    packer.finish()
    sequences, parts = defaultdict(list), defaultdict(list)
    for example, start, length, sequence, offset in out:
        sequences[sequence].append((offset, length, example, start))
        parts[example].append((start, length))
    for i, n in examples.items():
        at = 0
        for start, length in sorted(parts[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    for pieces in sequences.values():
        pieces.sort()
        at = 0
        for offset, length, _, _ in pieces:
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 2048 and len(pieces) <= segments
        assert sum(packing.Packer._loss(s, n, bears[e]) for _, n, e, s in pieces) <= (loss or 2048)


def test_pieces_hold_the_ids_of_their_texts(spark):
    rows = [(1, "short text", "q"), (2, None, None), (3, "", ""), (4, "many words here " * 3000, "a question"), (1, "short text", "q"), (None, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, prompt string")
    library = Tokenizer.from_file(PATH)
    for prompt in (None, "prompt"):
        pieces = packing.pack_examples(docs, PATH, 1, prompt=prompt)
        got = packing.with_digest(pieces).collect()
        want, whole = defaultdict(list), defaultdict(int)
        for i, text, head in rows:
            before = library.encode(head or "", add_special_tokens=False).ids if prompt else []
            want[i].append(before + library.encode(text or "", add_special_tokens=False).ids + [1])
        for r in got:
            ids = np.array(want[r.doc_id][0], "<u4")
            part = ids[r.start : r.start + r.length].tobytes()
            assert r.doc_tokens == len(ids) and part == r.ids and r.ids_crc32 == zlib.crc32(part)
            whole[r.doc_id] += r.length
        assert whole == {i: sum(map(len, texts)) for i, texts in want.items()}
        if prompt:
            assert sum(r.loss_tokens for r in got if r.doc_id == 4) == len(library.encode(rows[3][1], add_special_tokens=False).ids) + 1
        assert pieces.where("false").count() == 0
    assert packing.pack_examples(docs.where("false"), PATH, 1).count() == 0
