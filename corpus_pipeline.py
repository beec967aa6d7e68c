"""Corpus preparation in stages; each stage reads what the one before has written.

1. Quality rules remove boilerplate lines and drop documents of poor or depleted text.
2. Line dedup removes repeated lines; a document that loses all its words that way is a copy
   and goes.
3. Of each group of near duplicates (five words, similarity 0.8) the earliest stays.
4. Documents that overlap with a benchmark item go.
5. The rest is packed into training sequences.

Nulls, empty texts, repeated rows, empty tables and extra columns are handled as the operators
state; all stages but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.names import fresh
from folioscope.llm import decontaminate, lines, minhash, packing, quality
from folioscope.llm.storage import clear, cut, stored

TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = fresh("_removed", docs)
    left = quality.keep_good(docs, removed=removed)
    return _recounted(left, docs, removed).select(*docs.columns)


def _recounted(left: DataFrame, docs: DataFrame, removed: str) -> DataFrame:
    """``n_chars``, if there is one, of the texts that lost lines."""
    if "n_chars" not in docs.columns:
        return left
    changed = F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    total, removed = fresh("_lines", docs), fresh("_removed", docs)
    left = lines.drop_repeated_lines(docs, counted=(total, removed))
    # null texts lose nothing; a text whose words are all gone has only blank lines left
    emptied = (F.col(removed) > 0) & (F.length(F.regexp_replace("text", lines.SPACE, "")) == 0)
    left = left.where(~F.coalesce(emptied, F.lit(False)))
    return _recounted(left, docs, removed).select(*names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_examples(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return packing.with_digest(pieces).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Neither near repeats of lines and documents nor a tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before = stored()
        docs = cut(stage(spark, docs, sf_dir))
        # the stage is written; what it stored on the way is read no more
        clear(spark, [path for path in stored() if path not in before])
    return STAGES[-1][1](spark, docs, sf_dir)
