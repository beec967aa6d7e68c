"""Quality rules: repeated text inside a document and line frequency across documents.

A line is normalised to its lower-cased words. For every host (``host`` column) the distinct
documents that hold a line are counted; a line in more than ``MIN_DOCUMENTS`` is boilerplate,
however large the host, and is removed from the text; a document with too few words left is depleted and rejected.

Documents with the same sequence of words count once, so that copies, which are the business
of near-duplicate removal, don't turn their own text into boilerplate.

Defined cases: a null text or one without words has no lines, zero counts and fails the base
rules; a null text stays null. A null host is a host of its own. A null id is an id like any other. Repeated rows each
return a row and count once. An empty table returns no rows. Very long texts are profiled one at a
time, in memory proportional to the text; texts travel compressed to meet their verdicts. Other
columns, of any name, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.llm import words as w
from folioscope.llm.storage import cut
from folioscope.llm.texts import packed, unpacked

WINDOW = 8
#: A line is boilerplate in more documents of its host. A share of the host's documents can be
#: asked for besides; with one, a line of a large host may stand in very many documents.
MIN_DOCUMENTS = 20
MAX_SHARE = 0.0
#: A document is depleted with fewer words, or a smaller share of its words, left.
MIN_WORDS = 20
MIN_SHARE = 0.3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def repeated_words(found: w.Words, size: int = WINDOW) -> np.ndarray:
    """For each word, whether it stands in a window of ``size`` words that the row holds twice."""
    covered = np.zeros(len(found.hashes), bool)
    windows = w.window_hashes(found.hashes, size)
    begins = np.flatnonzero(found.row[: len(windows)] == found.row[size - 1 :]) if len(windows) else windows
    if not len(begins):
        return covered
    keys = w.mix(windows[begins] ^ (found.row[begins].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(covered) + 1, np.int64)
    np.add.at(change, begins[twice], 1)
    np.add.at(change, begins[twice] + size, -1)
    return np.cumsum(change)[:-1] > 0


def _profile(batch: pa.RecordBatch, first: int, last: int, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    n = last - first
    raw = w.words_of(data, offsets, lower=False)
    lower = w.run_hashes(w._LOWER[data], raw.starts, raw.ends)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = heads[raw.ends] - heads[raw.starts]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])

    starts, ends, row = w.line_bounds(data, offsets)
    from_word, to_word = np.searchsorted(raw.starts, starts), np.searchsorted(raw.starts, ends)
    solid = np.flatnonzero(to_word > from_word)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, place, n_words = row[solid], place[solid], (to_word - from_word)[solid]
    exact = w.mix(w.run_hashes(w._RAW[data], starts[solid], ends[solid]) + row.astype(np.uint64))
    order = np.argsort(exact, kind="stable")
    again = np.zeros(len(solid), bool)
    again[order[1:]] = exact[order][1:] == exact[order][:-1]
    normal = w.run_hashes(lower, from_word[solid], to_word[solid])
    whole = w.run_hashes(lower, raw.first[:-1], raw.first[1:])
    lines = np.bincount(row, minlength=n)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc").slice(first, n),
            batch.column("host").slice(first, n),
            batch.column("hash").slice(first, n),
            pa.array(raw.counts, pa.int64()),
            pa.array(_per_row(chars, raw.row, n)),
            pa.array(np.diff(symbols[offsets])),
            pa.array(_per_row(again, row, n)),
            pa.array(_per_row(repeated_words(raw), raw.row, n)),
            pa.array(whole.view(np.int64)),
            w.list_array(normal, lines, pa.int64()),
            w.list_array(n_words.astype(np.int32), lines, pa.int32()),
            w.list_array(place.astype(np.int32), lines, pa.int32()),
        ],
        names=["doc", "host", "hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content", "lines", "sizes", "places"],
    )


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in w.text_blocks(batch, "text"):
            yield _profile(batch, *block)


def document_profile(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: the hash of its text, base counts, the hash of its words, and its lines that have
    words with their hashes, sizes and places."""
    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc"), F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return narrow.mapInArrow(
        _profiles,
        f"doc {kind}, host string, hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, content bigint, lines array<bigint>, sizes array<int>, places array<int>",
    )


def boilerplate(profile: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """``host, line, documents``: lines in more documents of the host than the limits allow."""
    filled = profile.where("n_words > 0").select(F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"), "content", "lines")
    key = ["host", "no_host"]
    once = filled.select(*key, "content", F.explode(F.array_distinct("lines")).alias("line")).distinct()
    held = once.groupBy(*key, "line").agg(F.count("*").alias("documents")).where(F.col("documents") > min_documents)
    sizes = filled.select(*key, "content").distinct().groupBy(*key).agg(F.count("*").alias("host_documents"))
    return held.join(sizes, key).where(F.col("documents") > F.col("host_documents") * max_share).select(*key, "line", "documents")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judged(
    docs: DataFrame,
    doc_id: str,
    text: str,
    host: str,
    min_documents: int,
    max_share: float,
    min_words: int,
    min_share: float,
) -> DataFrame:
    """Per row: ``doc, host, hash``, its verdict, and the places of its boilerplate (null: none)."""
    profile = cut(document_profile(docs, doc_id, text, host).withColumn("row_no", F.monotonically_increasing_id()))
    common = boilerplate(profile, min_documents, max_share)
    lines = profile.select(
        F.coalesce("host", F.lit("")).alias("host"),
        F.col("host").isNull().alias("no_host"),
        "row_no",
        F.explode(F.arrays_zip("lines", "sizes", "places")).alias("at"),
    ).select("host", "no_host", "row_no", F.col("at.lines").alias("line"), F.col("at.sizes").alias("size"), F.col("at.places").alias("place"))
    found = lines.join(common, ["host", "no_host", "line"], "left_semi")
    lost = found.groupBy("row_no").agg(F.sum("size").alias("lost"), F.collect_list("place").alias("gone"))
    judged = profile.drop("lines", "sizes", "places", "content").join(lost, "row_no", "left")
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc",
        "host",
        "hash",
        *COUNTS,
        failed.alias("base_failed"),
        left.alias("n_words_left"),
        (~failed & (left >= min_words) & (left >= F.col("n_words") * min_share)).alias("kept"),
        "gone",
    )


def quality_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``n_words_left`` without boilerplate, ``kept``."""
    judged = _judged(docs, doc_id, text, host, min_documents, max_share, min_words, min_share)
    return judged.drop("host", "hash", "gone").withColumnRenamed("doc", doc_id)


def _cleaned(docs: DataFrame, verdict: DataFrame, doc_id: str, text: str, host: str, more: tuple[str, ...], removed: str | None = None) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` has, without the boilerplate in ``text``; with its columns ``more``."""
    key = F.struct("doc", "host", "hash")
    of, whose, gone, own, own_hash = (fresh(f"_{n}", docs) for n in ("of", "whose", "gone", "own", "own_hash"))
    judged = verdict.select(F.xxhash64(key).alias(of), key.alias(whose), F.col("gone").alias(gone), *more)
    # repeated rows have the same verdict
    judged = judged.dropDuplicates([of, whose])
    name = F.struct(F.col(doc_id).alias("doc"), F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("hash"))
    named = packed(docs.withColumn(own, name).withColumn(own_hash, F.xxhash64(own)), text)
    met = named.join(judged, (F.col(own_hash) == F.col(of)) & F.col(own).eqNullSafe(F.col(whose)))
    met = unpacked(met.drop(own, own_hash, of, whose), text)
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(gone, i)), "\n")
    kept = F.when(F.col(gone).isNull(), F.col(text)).otherwise(left).alias(text)
    count = [F.coalesce(F.size(gone), F.lit(0)).alias(removed)] if removed else []
    return met.select(*[kept if c == text else F.col(c) for c in docs.columns], *count, *more)


def clean_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Per row what ``quality_verdicts`` returns, and ``text`` without its boilerplate lines."""
    judged = _judged(docs, doc_id, text, host, min_documents, max_share, min_words, min_share)
    names = *COUNTS, "base_failed", "n_words_left", "kept"
    return _cleaned(docs.select(doc_id, host, text), judged, doc_id, text, host, names).select(doc_id, *names, text)


def keep_good(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
    removed: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and without boilerplate lines in
    ``text``; ``removed`` names an added count of these."""
    judged = _judged(docs, doc_id, text, host, min_documents, max_share, min_words, min_share)
    return _cleaned(docs, judged.where("kept"), doc_id, text, host, (), removed)
