"""Line dedup by a deletion-neighbourhood join, in DataFrame functions alone.

A line is its lower-cased words. Two lines are alike if they are equal or, with ``MIN_NEAR``
words or more each, within one edit: one word inserted, deleted or replaced. A line that is
alike to an earlier one, by document id and place, is removed.

1. Equal lines meet by hash; the earliest is a minimum, aggregated before the shuffle.
2. Lines within one edit share their first or second half. A line whose halves no other line
   has is passed over; that loses nothing.
3. The others emit their deletion neighbourhood as hashes: the line itself and every variant
   with one word left out, with its place. Equal variants with equal places differ in that
   word; a variant equal to a whole line has one word more. In either case each line meets the
   earliest one, and their edit distance is verified.

All occurrences of a line that has an earlier neighbour go, of any other line all but the first.

Defined cases: a null text stays null, an empty one empty. Lines without words stay. Documents
with a null id come last. Rows with the same id and text are one document and lose the same
lines. An empty table gives no rows. A very long line is one row of words, and its work grows with
them. Lines are told apart by 64 bits of hash. Other columns, of any name, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.llm.arrays import running
from folioscope.llm.storage import store

MIN_NEAR = 8
SPACE = "[\\x20\\x09-\\x0D]+"


def line_words(line: Column) -> Column:
    """The lower-cased words of a line."""
    # a single character is split at without a regular expression, and blanks are the rule
    blanks = F.when(line.rlike("[\\x09-\\x0D]"), F.regexp_replace(line, SPACE, " ")).otherwise(line)
    return F.array_remove(F.split(F.lower(blanks), " "), "")


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``key``: identifies and orders documents."""
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc"), F.xxhash64(text).alias("content"))
    return docs.select(key.alias("key"), F.col(text).alias("text"))


def _half_keys(words: Column, n: Column) -> Column:
    """Hashes of the halves that a neighbour of ``n`` or ``n + 1`` words would share."""
    keys = []
    for size in (n, n + 1):
        cut_at = F.floor(size / 2).cast("int")
        keys.append(F.xxhash64(size, F.lit("first"), F.slice(words, 1, cut_at)))
        # the second half of the longer line, counted from the end
        rest = size - cut_at
        keys.append(F.xxhash64(size, F.lit("second"), F.slice(words, n - rest + 1, rest)))
    return F.array(*keys)


def _running(hashes: Column) -> Column:
    """Exclusive ors of the first 0, 1, 2, ... values."""
    return running(hashes, F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))


def _neighbourhood(words: Column) -> Column:
    """The line, at place 0, and every variant with one word left out, at that word's place.

    A sequence is the exclusive or of the hashes of its words with their positions; behind a
    gap a word counts at the position before."""
    n = F.size(words)
    parts = F.struct(
        _running(F.transform(words, lambda word, i: F.xxhash64(word, i))).alias("head"),
        _running(F.reverse(F.transform(words, lambda word, i: F.xxhash64(word, i - 1)))).alias("tail"),
    )

    def variants(p: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n),
            lambda place: F.struct(
                place.alias("place"),
                F.when(place == 0, F.get(p["head"], n))
                .otherwise(F.get(p["head"], place - 1).bitwiseXOR(F.get(p["tail"], n - place)))
                .alias("variant"),
            ),
        )

    return F.flatten(F.transform(F.array(parts), variants))


def _within_one_edit(x: Column, y: Column) -> Column:
    """Common words at the start and at the end leave at most one word between them."""
    n, m = F.size(x), F.size(y)

    def common(a: Column, b: Column) -> Column:
        differ = F.array_position(F.zip_with(a, b, lambda s, t: ~s.eqNullSafe(t)), True)
        return F.when(differ == 0, F.least(n, m)).otherwise(differ - 1)

    return common(x, y) + common(F.reverse(x), F.reverse(y)) >= F.greatest(n, m) - 1


def _line_table(docs: DataFrame, min_near: int) -> DataFrame:
    """Every line that has words: document key, place, hash, size and keys of its halves."""
    lines = docs.select("key", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    lines = lines.select("key", "place", line_words(F.col("line")).alias("words")).where(F.size("words") > 0)
    size = F.size("words")
    halves = F.when(size >= min_near, _half_keys(F.col("words"), size)).otherwise(F.array().cast("array<bigint>"))
    return lines.select(
        F.struct("key", "place").alias("at"), F.xxhash64("words").alias("line"), halves.alias("halves")
    )


def _candidates(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another line, with their earliest place."""
    keyed = distinct.select("line", F.explode("halves").alias("half")).repartition("half")
    shared = keyed.groupBy("half").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low < high")
    wanted = keyed.join(shared.select("half"), "half").select("line").distinct()
    return distinct.select("line", "at").join(wanted, "line")


def _with_words(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """``line, at, words`` of the candidates, from the texts of their documents."""
    where = candidates.groupBy(F.xxhash64("at.key").alias("doc_hash"), F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct("line", "at.place")).alias("found")
    )
    texts = docs.select(F.xxhash64("key").alias("doc_hash"), F.col("key").alias("own"), "text")
    met = where.join(texts, "doc_hash").where(F.col("key").eqNullSafe(F.col("own")))
    lines = met.select("key", F.split("text", "\n", -1).alias("lines"), F.explode("found").alias("f")).select(
        "f.line", F.struct("key", F.col("f.place").alias("place")).alias("at"), line_words(F.get("lines", F.col("f.place"))).alias("words")
    )
    return lines.dropDuplicates(["line"])


def _near_repeats(candidates: DataFrame) -> DataFrame:
    """``line``: distinct lines that an earlier line lies within one edit of."""
    # ids of rows in a sorted table grow with their place, and are small to carry around
    ranked = store(candidates.orderBy("at").select("line", "words", F.monotonically_increasing_id().alias("rank")))
    variants = store(
        ranked.select("rank", F.explode(_neighbourhood(F.col("words"))).alias("v")).select("rank", "v.place", "v.variant")
    )
    short, whole = variants.where("place > 0"), variants.where("place = 0")
    first = short.groupBy("variant", "place").agg(F.min("rank").alias("other"))
    replaced = short.join(first, ["variant", "place"]).where("rank <> other").select("rank", "other")
    one_more = short.join(whole.select("variant", F.col("rank").alias("other")), "variant").where("rank <> other")
    moved = one_more.select(F.greatest("rank", "other").alias("rank"), F.least("rank", "other").alias("other"))
    pairs = replaced.union(moved).distinct()
    met = pairs.join(ranked.select("rank", "line", "words"), "rank")
    met = met.join(ranked.select(F.col("rank").alias("other"), F.col("words").alias("others")), "other")
    return met.where(_within_one_edit(F.col("words"), F.col("others"))).select("line").distinct()


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_near: int = MIN_NEAR) -> DataFrame:
    """Per document that has any: ``doc_hash``, ``key`` and the places of its repeated lines."""
    narrow = _documents(docs, doc_id, text)
    lines = store(_line_table(narrow, min_near))
    distinct = store(lines.groupBy("line").agg(F.min("at").alias("at"), F.first("halves").alias("halves")))
    candidates = store(_with_words(_candidates(distinct), narrow))
    near = _near_repeats(candidates).withColumn("near", F.lit(True))
    first = distinct.select("line", F.col("at").alias("first")).join(near, "line", "left")
    gone = lines.select("line", "at").join(first, "line").where((F.col("at") != F.col("first")) | F.col("near"))
    return gone.groupBy(F.xxhash64("at.key").alias("doc_hash"), F.col("at.key").alias("key")).agg(
        F.collect_set("at.place").alias("places")
    )


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_near: int = MIN_NEAR, counted: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` without repeated lines in ``text``; ``counted`` names added counts of lines and removed lines."""
    names = docs.columns
    hashed, whose, places, own = (fresh(f"_{n}", docs) for n in ("hash", "whose", "places", "own"))
    gone = repeated_lines(docs, doc_id, text, min_near).select(
        F.col("doc_hash").alias(hashed), F.col("key").alias(whose), F.col("places").alias(places)
    )
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc"), F.xxhash64(text).alias("content"))
    met = docs.withColumn(own, key)
    met = met.join(gone, (F.xxhash64(own) == F.col(hashed)) & F.col(own).eqNullSafe(F.col(whose)), "left")
    lines = F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(places, i)), "\n")
    more = [F.size(lines).alias(counted[0]), F.coalesce(F.size(places), F.lit(0)).alias(counted[1])] if counted else []
    kept = F.when(F.col(places).isNull(), F.col(text)).otherwise(left).alias(text)
    return met.select(*[kept if name == text else F.col(name) for name in names], *more)
