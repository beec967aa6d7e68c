"""Text vectors from term frequencies, for corpora without an embedding model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = "_buckets"


def _buckets(text: Column, dimensions: int) -> Column:
    """The bucket of every token, as text: the first 28 bits of its MD5, modulo ``dimensions``.

    A public digest, so that other engines can make the same vectors."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda token: token != "")

    def bucket(token: Column) -> Column:
        number = F.conv(F.substr(F.md5(token.cast("binary")), F.lit(1), F.lit(7)), 16, 10)
        return (number.cast("bigint") % dimensions).cast("string")

    return F.transform(tokens, bucket)


def fit_vectorizer(
    chunks: DataFrame, column: str = "content", dimensions: int = 1024
) -> PipelineModel:
    """Term frequencies by bucket, weighted by ``ln((n + 1) / (df + 1))``, of unit length.

    Fitting is one aggregate of ``dimensions`` counters, whatever the vocabulary.
    """
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dimensions)], inputCol=BUCKETS, outputCol="_counts"
    )
    texts = chunks.where(F.col(column).isNotNull()).select(_buckets(F.col(column), dimensions).alias(BUCKETS))
    idf = IDF(inputCol="_counts", outputCol="_weighted").fit(counter.transform(texts))
    unit = Normalizer(inputCol="_weighted", outputCol="_unit")
    return PipelineModel([counter, idf, unit])


def vectorize(df: DataFrame, model: PipelineModel, column: str) -> DataFrame:
    """Adds ``embedding array<float>`` computed from a text column."""
    dimensions = len(model.stages[0].vocabulary)
    out = model.transform(df.withColumn(BUCKETS, _buckets(F.col(column), dimensions)))
    return out.withColumn("embedding", vector_to_array("_unit", "float32")).select(
        *df.columns, "embedding"
    )


def text_encoder(model: PipelineModel):
    """``encode`` for searches by text: the vectors of query texts under a fitted model."""

    def encode(variants: DataFrame) -> DataFrame:
        return vectorize(variants, model, "query_text")

    return encode
