"""Extractive summaries by term and document frequencies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.names import fresh
from folioscope.functions.text import bind, strip, word_count

#: Words that count: four letters and more.
WORD = r"(\p{L}{4,})"
#: Weights are whole numbers of this unit, so sums don't depend on the order of rows.
UNIT = 1_000_000
MARK = "\x01"


def _marked(text: Column) -> Column:
    """The text with a mark in place of the white space between its sentences."""
    return F.regexp_replace(strip(text), r"(?U)([.!?])\s+", f"$1{MARK}")


def _cut(marked: Column) -> Column:
    return F.filter(F.split(marked, MARK), lambda s: s != "")


def sentences(text: Column) -> Column:
    """A text cut behind full stops, question and exclamation marks that white space follows."""
    return _cut(_marked(text))


def document_frequencies(chunks: DataFrame, text: str = "content") -> DataFrame:
    """``word, weight``: the inverse document frequency of every word of the table, in units.

    ``weight`` is ln((N + 1) / (n + 1)) of N chunks of which n have the word.
    """
    return _weights(chunks, text).where("word <> ''")


def _weights(chunks: DataFrame, text: str) -> DataFrame:
    """``document_frequencies`` and the empty word, which counts as one that every chunk has: so the
    number of chunks comes out of the same exchange."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD)))
    found = F.concat(F.coalesce(found, F.array().cast("array<string>")), F.array(F.lit("")))
    # outer, and without nulls: no filter is inferred that one reader of the exchanges had and others not
    listed = chunks.select(F.explode_outer(found).alias("word")).where(F.col("word").isNotNull())
    counted = listed.groupBy("word").agg(F.count("*").alias("n"))
    one = F.lit(1).alias("_one")
    total = counted.agg(F.max(F.when(F.col("word") == "", F.col("n"))).alias("total")).select(one, "total")  # one row
    weight = F.ln((F.col("total") + 1) / (F.col("n") + 1))
    return (
        counted.select(one, "*")
        .join(F.broadcast(total), "_one")
        .select("word", F.round(weight * UNIT).cast("long").alias("weight"))
    )


def _words_of(texts: Column) -> Column:
    """Every word of some texts once, with the numbers of the sentences that it stands in, as often as
    it does."""

    def placed(sentence: Column, i: Column) -> Column:
        return F.transform(F.regexp_extract_all(F.lower(sentence), F.lit(WORD)), lambda w: F.struct(w.alias("word"), i.alias("place")))

    def runs(found: Column) -> Column:
        first = F.transform(found, lambda w, i: F.when((i == 0) | (w["word"] != F.get(found, i - 1)["word"]), i))
        return bind(F.filter(first, lambda i: i.isNotNull()), lambda starts: F.transform(starts, lambda at, j: run(found, starts, at, j)))

    def run(found: Column, starts: Column, at: Column, j: Column) -> Column:
        end = F.coalesce(F.get(starts, j + 1), F.size(found))
        places = F.transform(F.slice(found, at + 1, end - at), lambda w: w["place"])
        return F.struct(F.get(found, at)["word"].alias("word"), places.alias("places"))

    found = F.flatten(F.transform(texts, lambda text: F.flatten(F.transform(_cut(text), placed))))
    return bind(F.sort_array(found), runs)


def _sentence_sums(dealt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_key, sums``: of every sentence that has words its place, the sum of their weights and
    their number.

    Words are brought together within the row. One row a word and chunk meets the table of
    frequencies, by a join that adaptive execution splits at frequent words, and goes back to the
    chunk as whole numbers.
    """
    whole = reduce(lambda a, b: a & b, [F.col("_key")[k].isNotNull() for k in keys])
    # a key is that of one chunk, so that is one text
    texts = dealt.groupBy("_key").agg(F.collect_list(F.when(whole, F.col("_marked"))).alias("texts"))
    in_chunk = texts.select("_key", F.explode_outer(_words_of(F.col("texts"))).alias("w")).select("_key", "w.word", "w.places")
    in_chunk = in_chunk.where(F.col("word").isNotNull())
    weighed = in_chunk.join(_weights(dealt, "_marked"), "word").select(
        "_key", (F.size("places") * F.col("weight")).alias("weight"), "places"
    )
    sums = (
        weighed.repartition("_key")
        .select("_key", "weight", F.explode("places").alias("place"))
        .groupBy("_key", "place")
        .agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    )
    entry = F.struct("place", F.lit(None).cast("int").alias("size"), "weight", "n")
    return sums.groupBy("_key").agg(F.collect_list(entry).alias("sums"))


def _chosen_sentences(dealt: DataFrame, keys: Sequence[str], max_words: int) -> DataFrame:
    """``_key, places``: the best sentences of each chunk that has any, up to ``max_words``.

    ``dealt``: chunks by ``_key``, a struct of ``keys``, lying by it, with their ``_marked`` text.

    A word weighs its frequency in the chunk times its inverse document frequency in the table; a
    sentence scores the mean weight of its words.  Sentences are taken by score, then by place, as
    long as a running count of words fits; the best one is always taken.  Chunks with a null in
    their key have no scores.
    """
    long = F.lit(None).cast("long")
    sizes = F.transform(
        _cut(F.col("_marked")),
        lambda s, i: F.struct(i.alias("place"), word_count(s).alias("size"), long.alias("weight"), long.alias("n")),
    )
    both = dealt.select("_key", sizes.alias("sizes")).join(_sentence_sums(dealt, keys), "_key", "left")
    entries = both.select("_key", F.explode_outer(F.concat("sizes", F.coalesce("sums", F.slice("sizes", 1, 0)))).alias("e"))
    # of chunks with the same key each brings the same sums, which leaves their ratio
    at_place = Window.partitionBy("_key", "e.place")
    score = F.sum("e.weight").over(at_place) / F.sum("e.n").over(at_place)
    scored = entries.select("_key", "e.place", "e.size", score.alias("score")).where(F.col("size").isNotNull())
    best = Window.partitionBy("_key").orderBy(F.coalesce("score", F.lit(0.0)).desc(), "place")
    ranked = scored.select(
        "_key", "place", F.row_number().over(best).alias("nth"),
        F.sum("size").over(best.rowsBetween(Window.unboundedPreceding, 0)).alias("used"),
    )
    kept = ranked.where((F.col("nth") == 1) | (F.col("used") <= max_words))
    return kept.groupBy("_key").agg(F.collect_set("place").alias("places"))


def with_summary(
    chunks: DataFrame,
    max_words: int = fv.SUMMARY_WORDS,
    keys: Sequence[str] = ("doc_id", "chunk_id"),
    text: str = "content",
) -> DataFrame:
    """Adds ``summary``: the chosen sentences in their order; a single one is cut at the limit.

    ``keys`` identify a chunk.  A null text has a null summary, one without sentences an empty
    one.  Marked texts are dealt out by key, and all that is worked out on them reads that
    exchange; other columns lie beside them for the result alone.
    """
    key, marked, chosen = fresh("_key", chunks), fresh("_marked", chunks), fresh("_places", chunks)
    columns = [c for c in chunks.columns if c != "summary"]
    others = [c for c in columns if c not in keys]
    dealt = chunks.select(F.struct(*keys).alias(key), _marked(F.col(text)).alias(marked), *others).repartition(key)
    narrow = dealt.select(F.col(key).alias("_key"), F.col(marked).alias("_marked"))
    places = _chosen_sentences(narrow, keys, max_words).select(F.col("_key").alias(f"{key}of"), F.col("places").alias(chosen))
    joined = dealt.join(places, F.col(key) == F.col(f"{key}of"), "left")
    taken = F.filter(_cut(F.col(marked)), lambda s, i: F.array_contains(chosen, i))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.get(taken, F.lit(0)), F.lit(r"(?U)(\S+)")), 1, max_words), " ")
    whole = F.array_join(taken, " ")
    summary = F.when((F.size(taken) == 1) & (word_count(whole) > max_words), cut).otherwise(whole)
    summary = F.when(F.col(marked).isNull(), F.lit(None)).otherwise(F.coalesce(summary, F.lit("")))
    return joined.select(*[F.col(key)[c].alias(c) if c in keys else F.col(c) for c in columns], summary.alias("summary"))
