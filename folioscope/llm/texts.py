"""Texts that travel compressed: shuffles of whole documents are mostly their texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SIZE = 8


def _retyped(schema: T.StructType, text: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, kind) if f.name == text else f for f in schema])


def _mapped(rows: DataFrame, text: str, kind: T.DataType, make) -> DataFrame:
    place = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            values = pa.array([None if x is None else convert(x) for x in batch.column(place).to_pylist()], target)
            columns = [values if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    target = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()
    return rows.mapInArrow(run, _retyped(rows.schema, text, kind))


def packed(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the text as compressed bytes behind its length; null stays null."""

    def make():
        codec = pa.Codec("zstd", compression_level=1)

        def convert(value: str) -> bytes:
            data = value.encode()
            return len(data).to_bytes(_SIZE, "little") + codec.compress(data, asbytes=True)

        return convert

    return _mapped(rows, text, T.BinaryType(), make)


def unpacked(rows: DataFrame, text: str = "text") -> DataFrame:
    """What ``packed`` was given."""

    def make():
        codec = pa.Codec("zstd")

        def convert(value: bytes) -> str:
            size = int.from_bytes(value[:_SIZE], "little")
            return codec.decompress(value[_SIZE:], size, asbytes=True).decode() if size else ""

        return convert

    return _mapped(rows, text, T.StringType(), make)
