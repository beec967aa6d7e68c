"""Managed tables and file exports.

A saved table is a view on its current version.  Every save writes a version of its own and then
replaces the view: one step of the catalog, schema included, so a reader finds one version or the
other and a job that fails anywhere leaves a whole one behind.  The version before the current one
stays for readers that have already begun.  A name has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.names import fresh

#: Property of the view that names its version.
CURRENT = "folioscope.current"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _kind(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table behind a saved name; none if there is no such name or it is a plain table."""
    if _kind(spark, name) != "VIEW":
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").where(F.col("key") == CURRENT).first()
    return found["value"] if found else None


def _write_version(df: DataFrame, name: str, fmt: str, bucket_by: Sequence[str], buckets: int) -> str:
    version = f"{name}__v{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if bucket_by:
        first, *rest = bucket_by
        writer = writer.bucketBy(buckets, first, *rest).sortBy(first, *rest)
    writer.saveAsTable(version)
    return version


def _point_to(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ('{CURRENT}' = '{version}') "
        f"AS SELECT * FROM {_quoted(version)}"
    )


def _drop_versions(spark: SparkSession, name: str, kept: set[str | None]) -> None:
    *database, table = name.split(".")
    found = spark.catalog.listTables(*[".".join(database)] if database else [None], pattern=f"{table.lower()}__v*")
    kept = {k.split(".")[-1].lower() for k in kept if k}
    for version in found:
        if version.name.lower() not in kept and len(version.name) == len(table) + 35:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted('.'.join([*database, version.name]))}")


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Save or overwrite a table; ``df`` may be read from it, and its schema may change.

    Pages or chunks that are joined on ``(doc_id, page_no)`` again and again are
    worth bucketing on these columns: the joins then need no shuffle of the text.

    A plain table of this name, which something else has made, becomes the first version; only
    then the name is gone for a moment between two steps of the catalog.
    """
    spark = df.sparkSession
    version = _write_version(df, name, fmt, bucket_by, buckets)
    before = current_version(spark, name)
    if _kind(spark, name) not in (None, "VIEW"):
        before = f"{name}__v{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(before)}")
        try:
            _point_to(spark, name, version)
        except Exception:
            spark.sql(f"ALTER TABLE {_quoted(before)} RENAME TO {_quoted(name)}")
            raise
    else:
        _point_to(spark, name, version)
    _drop_versions(spark, name, {version, before})


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a saved table with all its versions."""
    spark.sql(f"DROP {'VIEW' if _kind(spark, name) == 'VIEW' else 'TABLE'} IF EXISTS {_quoted(name)}")
    _drop_versions(spark, name, set())


def load_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Turn a Parquet folder into a managed table and return the table."""
    save_table(spark.read.parquet(path), name, fmt)
    return spark.table(name)


def save_extraction(paragraphs: DataFrame, footnotes: DataFrame, prefix: str, fmt: str = "parquet"):
    """Writes ``<prefix>_paragraphs`` and ``<prefix>_footnotes``."""
    save_table(paragraphs, f"{prefix}_paragraphs", fmt)
    save_table(footnotes, f"{prefix}_footnotes", fmt)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Overwrite a table with a result that is read from it, schema changes included."""
    save_table(df, name, fmt)


def add_column(spark: SparkSession, name: str, column: str, value) -> None:
    """Add a computed column to a managed table, keeping its name."""
    replace_table(spark.table(name).withColumn(column, value), name)


def export_json(
    paragraphs: DataFrame, footnotes: DataFrame, chunks: DataFrame, directory: str
) -> None:
    """Paragraphs, footnotes and chunks as JSON Lines, null fields written out."""
    for df, part in ((paragraphs, "paragraphs"), (footnotes, "footnotes"), (chunks, "chunks")):
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(
            f"{directory}/hybrid_{part}"
        )


def export(df: DataFrame, path: str, fmt: str) -> None:
    """Write as ``json`` / ``jsonl``, ``csv`` or ``parquet``.

    CSV has no nested values; arrays, structs and maps are written as JSON text.
    """
    if fmt not in ("json", "jsonl", "csv", "parquet"):
        raise ValueError(f"unknown export format: {fmt}")
    writer_format = "json" if fmt == "jsonl" else fmt
    if fmt == "csv":
        df = df.select(
            *[
                F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f.name)
                for f in df.schema.fields
            ]
        )
    writer = df.write.mode("overwrite").format(writer_format)
    if fmt == "csv":
        # quotes are doubled, line breaks and white space at the ends kept inside quotes
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    elif writer_format == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(path)


CORRUPT = "_corrupt_record"
#: Stands for a quoted empty text while CSV is read; an unquoted one is null.
EMPTY = "\x01empty\x01"
NESTED = (T.ArrayType, T.StructType, T.MapType)


def read_export(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """An export in the schema that was written, and its broken rows.

    Rows that can't be read in the schema are set apart with the text that was found in
    ``_corrupt_record``: lines that are no JSON, records with too many fields, values of another
    type, and in CSV nested values whose JSON text can't be parsed.  A CSV file may hold line
    breaks inside quotes, so a task reads whole files.
    """
    if fmt == "parquet":
        rows = spark.read.schema(schema).parquet(path)
        return rows, rows.withColumn(CORRUPT, F.lit(None).cast("string")).limit(0)
    corrupt = T.StructField(CORRUPT, T.StringType())
    if fmt in ("json", "jsonl"):
        rows = spark.read.schema(T.StructType([*schema, corrupt])).json(path, columnNameOfCorruptRecord=CORRUPT)
        rows = _wholly_parsed(rows, schema.fieldNames())
    elif fmt == "csv":
        flat = [T.StructField(f.name, T.StringType()) if isinstance(f.dataType, NESTED) else f for f in schema]
        rows = spark.read.schema(T.StructType([*flat, corrupt])).csv(
            path, header=True, escape='"', multiLine=True, columnNameOfCorruptRecord=CORRUPT,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue=EMPTY,
        )
        texts = [f.name for f in flat if isinstance(f.dataType, T.StringType)]
        rows = rows.withColumns({c: F.when(F.col(c) == EMPTY, "").otherwise(F.col(c)) for c in texts})
        rows = _parsed(_wholly_parsed(rows, schema.fieldNames()), schema)
    else:
        raise ValueError(f"unknown export format: {fmt}")
    names = schema.fieldNames()
    return rows.where(F.col(CORRUPT).isNull()).select(*names), rows.where(F.col(CORRUPT).isNotNull()).select(*names, CORRUPT)


def _wholly_parsed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Readers look for faults in the columns that a query asks for only: here it asks for all."""
    asked = F.size(F.array(*[F.col(c).isNull() for c in names])) < 0
    return rows.withColumn(CORRUPT, F.when(asked, F.lit(None)).otherwise(F.col(CORRUPT)))


def _parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Nested columns from their JSON text; a text that isn't of the type makes the row corrupt."""
    nested = [f for f in schema if isinstance(f.dataType, NESTED)]
    found = {}
    for field in nested:
        # inside an object every type reports what it can't parse
        kind = T.StructType([T.StructField("value", field.dataType), T.StructField(CORRUPT, T.StringType())])
        text = F.concat(F.lit('{"value":'), F.col(field.name), F.lit("}"))
        found[field.name] = F.from_json(text, kind, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = {name: fresh(f"_parsed_{i}", rows) for i, name in enumerate(found)}
    rows = rows.withColumns({parsed[name]: value for name, value in found.items()})
    broken = [F.when(F.col(parsed[n])[CORRUPT].isNotNull(), F.concat(F.lit(f"{n}: "), F.col(n))) for n in found]
    return rows.select(
        *[F.col(parsed[f.name])["value"].alias(f.name) if f.name in parsed else F.col(f.name) for f in schema],
        F.coalesce(CORRUPT, *broken).alias(CORRUPT),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, row_count``."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out
