import re

import numpy as np
import pyarrow as pa

from folioscope.llm import words as w

TEXTS = ["Hello wor\nld  hello", "", None, "a\n\nb é\n", "\n", " x", "x\x0b\x0cy ", "no\xa0break", "日本 語"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def blocks():
    batch = pa.RecordBatch.from_pydict({"text": TEXTS})
    return list(w.text_blocks(batch, "text"))


def test_words_and_lines_equal_plain_splitting():
    [(first, last, data, offsets)] = blocks()
    assert (first, last) == (0, len(TEXTS))
    found = w.words_of(data, offsets)
    got = [(int(r), bytes(data[a:b]).decode()) for r, a, b in zip(found.row, found.starts, found.ends)]
    assert got == [(i, x) for i, t in enumerate(TEXTS) for x in WORD.findall(t or "")]
    starts, ends, rows = w.line_bounds(data, offsets)
    lines = [(int(r), bytes(data[a:b]).decode()) for a, b, r in zip(starts, ends, rows)]
    assert lines == [(i, x) for i, t in enumerate(TEXTS) for x in (t or "").split("\n")]


def test_hashes_depend_on_the_word_alone():
    [(_, _, data, offsets)] = blocks()
    found = w.words_of(data, offsets)
    words = [bytes(data[a:b]).decode().lower() for a, b in zip(found.starts, found.ends)]
    by_word = {}
    for word, value in zip(words, found.hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_small_blocks_hold_whole_rows(monkeypatch):
    monkeypatch.setattr(w, "BLOCK_BYTES", 5)
    covered = []
    for first, last, data, offsets in blocks():
        covered += range(first, last)
        assert len(offsets) == last - first + 1 and offsets[-1] == len(data)
    assert covered == list(range(len(TEXTS)))


def test_sliced_batches_and_empty_ones():
    batch = pa.RecordBatch.from_pydict({"text": TEXTS}).slice(3, 2)
    [(_, _, data, offsets)] = list(w.text_blocks(batch, "text"))
    assert bytes(data[offsets[0] : offsets[1]]).decode() == TEXTS[3]
    assert list(w.text_blocks(batch.slice(0, 0), "text")) == []
    assert len(w.window_hashes(np.zeros(3, np.uint64), 5)) == 0
