"""Token counts and token ids of whole texts, equal to those of the tokenizer file's library.

Two tiers answer a pre-token: a compact table of frequent ones that the driver broadcasts, of
bounded size, and a cache in each Python worker that the library fills on a miss. No pre-token of
the texts that are counted is shuffled. The table only saves work: it holds the pre-tokens most
frequent in a bounded sample of texts from all partitions, and any table gives the same counts.

Pre-tokens are cut by the file's own pattern. Texts with characters beyond plain Latin ones or
with the text of a special token are given whole to the library, as rules for them (Unicode
versions, composition, special tokens) are its own.

Defined cases: a null text is empty and has no tokens. Rows are independent; nulls in other
columns, repeated rows and an empty table need no rule. Very long texts are encoded one at a time,
in memory proportional to the text. Other columns, of any name, pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Bounds of the broadcast table and the texts that it is drawn from.
FREQUENT = 1 << 15
SAMPLE_TEXTS = 400
#: A worker's cache starts anew beyond so many entries.
CACHED = 3 << 18

#: The patterns by which the two kinds of files split texts.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Beyond these characters every rule is left to the library.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\u012f\u0132-\u0148\u014a-\u017e\u2010-\u2027\u20ac]*")
#: A blank beside other white space, where the byte pattern looks beyond the blank.
_LOOSE = regex.compile(r" [ \t\n\r]|[\t\n\r] ")

#: Bytes as the characters that stand for them in byte-level vocabularies: visible ones as they
#: are, the others in order from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_VISIBLE = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}

#: Caches of this Python worker, by kind and file; they outlive a task.
_CACHES: dict[tuple, "Cache"] = {}


class Cache(dict):
    """Values of pre-tokens; one that is missing is encoded by the library and kept."""

    def __init__(self, encode: Callable):
        super().__init__()
        self.table, self.encode = {}, encode

    def over(self, table: dict) -> "Cache":
        if table is not self.table:
            self.table = table
            self.update(table)
        return self

    def __missing__(self, piece: str):
        if len(self) > CACHED:
            self.clear()
            self.update(self.table)
        value = self[piece] = self.encode(piece)
        return value


class Splitter:
    """A tokenizer file with its pre-tokens.

    Where blanks stand alone, a text is cut at its blanks: no pre-token of either pattern goes
    on beyond one, and a byte-level one takes the blank before it. Else the pattern cuts it."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.words = type(self.library.normalizer).__name__ == "Sequence"
        self.pattern = regex.compile(WORD_PATTERN if self.words else BYTE_PATTERN).findall
        marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, marks))).search if marks else lambda text: None

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of a pre-token of a plain text: the library's merges alone, without its other steps."""
        return [t.id for t in self.library.model.tokenize(piece.encode().decode("latin-1").translate(_VISIBLE))]

    def unit_ids(self, unit: str) -> list[int]:
        return [i for piece in self.pattern(unit if self.words else f" {unit}") for i in self.piece_ids(piece)]

    def whole_ids(self, text: str) -> list[int]:
        """Ids of any text as ordinary text, special strings included."""
        if self.plain(text):
            return [i for piece in self.pattern(text) for i in self.piece_ids(piece)]
        self.library.encode_special_tokens = True
        try:
            return self.ids(text)
        finally:
            self.library.encode_special_tokens = False

    def plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not ("<|" in text and self.special(text))

    def units(self, text: str) -> tuple[str, list[str]] | None:
        """The start of the text, which has no blank before it, and what follows each blank."""
        if self.words:
            return "", text.lower().split()
        if _LOOSE.search(text):
            return None
        head, *rest = text.split(" ")
        return head, rest

    def caches(self, path: str, value: Callable) -> tuple[Cache, Cache]:
        """Of units and of pieces, with ``value`` of their ids."""
        for kind, ids in (("unit", self.unit_ids), ("piece", self.piece_ids)):
            _CACHES.setdefault((kind, path, value), Cache(lambda x, ids=ids: value(ids(x))))
        return _CACHES["unit", path, value], _CACHES["piece", path, value]


def id_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def frequent_lengths(docs: DataFrame, text: str, path: str, size: int = FREQUENT, texts: int = SAMPLE_TEXTS) -> dict[str, int]:
    """Token counts of the most frequent units of about ``texts`` whole texts from all partitions.

    Units are counted in the tasks; the driver takes ``size`` short ones at most."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(path)
        for batch in batches:
            seen: Counter = Counter()
            for t in batch["t"]:
                if splitter.plain(t) and (found := splitter.units(t)):
                    seen.update(unit for unit in found[1] if len(unit) < 64)
            yield pd.DataFrame({"unit": list(seen), "n": list(seen.values())})

    named = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t"))
    share = min(1.0, texts / max(named.count(), 1))
    units = named.sample(share, seed=1).mapInPandas(counted, "unit string, n bigint")
    ranked = units.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(size)
    splitter = Splitter(path)
    return {row.unit: len(splitter.unit_ids(row.unit)) for row in ranked.collect()}


def token_counts(docs: DataFrame, path: str, text: str = "text", alias: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text``."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, path))

    @F.pandas_udf("bigint")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        splitter = Splitter(path)
        units, pieces = splitter.caches(path, len)
        unit, piece = units.over(table.value).__getitem__, pieces.__getitem__

        def length(t: str | None) -> int:
            if not t:
                return 0
            if not splitter.plain(t):
                return len(splitter.ids(t))
            if found := splitter.units(t):
                return (len(splitter.ids(found[0])) if found[0] else 0) + sum(map(unit, found[1]))
            return sum(map(piece, splitter.pattern(t)))

        for texts in parts:
            yield pd.Series([length(t) for t in texts], dtype="int64")

    return docs.withColumn(alias, count(F.col(text)))


def encoder(path: str) -> Callable[[str | None], bytes]:
    """For one task: little-endian 32-bit ids of a text, of a file of either kind."""
    splitter = Splitter(path)
    units, pieces = splitter.caches(path, id_bytes)
    unit, piece = units.__getitem__, pieces.__getitem__

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if not splitter.plain(text):
            return id_bytes(splitter.ids(text))
        if found := splitter.units(text):
            return (id_bytes(splitter.ids(found[0])) if found[0] else b"") + b"".join(map(unit, found[1]))
        return b"".join(map(piece, splitter.pattern(text)))

    return encode
