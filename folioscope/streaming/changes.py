"""Row changes between two snapshots of a table, as a change feed reports them.

``snapshot_diff`` compares two tables.  Snapshots that are saved with ``save_snapshot`` keep a tree
of digests beside their rows, of buckets and of keys, so ``changed_since`` reads the digests of
buckets, then keys of the buckets that differ, then rows of the keys that differ.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope.functions.names import fresh

BUCKETS = 1024


def _complete(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``df``; those that only ``other`` has are null, in its type."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns]
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("chunk_id",)) -> DataFrame:
    """Rows of both versions that differ, with ``_change_type``: ``insert``, ``delete``,
    ``update_preimage`` or ``update_postimage``.

    ``keys`` identify a row in each version. Columns may have come or gone in between; a row
    without a column has null in it. Versions are compared by digests of 128 bits in one full
    outer join on the keys; whole rows are fetched for changed keys only.
    """
    keys = list(keys)
    payload = [c for c in new.columns if c not in keys]
    payload += [c for c in old.columns if c not in [*keys, *payload]]
    before, after = _complete(old, new, [*keys, *payload]), _complete(new, old, [*keys, *payload])

    def digest(df: DataFrame, name: str) -> DataFrame:
        # nulls are skipped by the hash, so their places are part of it
        nulls = [F.col(c).isNull() for c in payload]
        hashes = [F.xxhash64(F.lit(seed), *nulls, *payload) for seed in (0, 1)]
        return df.select(*keys, F.struct(*hashes).alias(name))

    return _rows(_differing(digest(before, "_was"), digest(after, "_now"), keys), before, after, keys, payload)


def _differing(was: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests ``_was`` and ``_now`` differ, with the kind of change."""
    joined = was.join(now, keys, "full_outer")
    old, new = F.col("_was"), F.col("_now")
    kind = F.when(old.isNull(), "insert").when(new.isNull(), "delete").when(old != new, "update")
    return joined.select(*keys, kind.alias("_kind")).where(F.col("_kind").isNotNull())


def _rows(changed: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    def rows(side: DataFrame, alone: str, updated: str) -> DataFrame:
        label = F.when(F.col("_kind") == "update", updated).otherwise(alone).alias("_change_type")
        wanted = changed.where(F.col("_kind").isin(alone, "update"))
        return side.join(wanted, keys).select(*keys, *payload, label)

    return rows(before, "delete", "update_preimage").unionByName(rows(after, "insert", "update_postimage"))


# --- snapshots with a tree of digests -------------------------------------------


def _row_digest(df: DataFrame, keys: list[str]) -> Column:
    """128 bits of the values that aren't null, by name: a column that isn't there equals one of
    nulls, and the order of columns doesn't matter."""

    def half(seed: int) -> Column:
        parts = [
            F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(seed), F.lit(c), F.col(c))).otherwise(F.lit(0).cast("bigint"))
            for c in df.columns
            if c not in keys
        ]
        return reduce(lambda a, b: a.bitwiseXOR(b), parts, F.lit(0).cast("bigint"))

    return F.struct(half(0).alias("a"), half(1).alias("b"))


def save_snapshot(df: DataFrame, path: str, keys: Sequence[str] = ("chunk_id",), buckets: int = BUCKETS) -> None:
    """Write a snapshot to a folder that doesn't exist yet: its rows and the digests of its keys,
    both by bucket of the key, the digests of buckets, and last the settings that make it whole.

    A bucket should hold some hundred megabytes; keys spread over them by hash.
    """
    keys, bucket = list(keys), fresh("_bucket", df)
    placed = df.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).repartition(buckets, bucket)
    placed.write.partitionBy(bucket).parquet(f"{path}/rows")
    spark = df.sparkSession
    # an empty snapshot has no files to infer a schema from
    stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    digests = stored.select(*keys, _row_digest(df, keys).alias("_digest"), bucket)
    digests.repartition(buckets, bucket).write.partitionBy(bucket).parquet(f"{path}/keys")
    known = spark.read.schema(digests.schema).parquet(f"{path}/keys")
    row = [F.xxhash64(F.lit(seed), *keys, "_digest") for seed in (0, 1)]
    totals = known.groupBy(F.col(bucket).alias("bucket")).agg(
        F.count("*").alias("n"), *[F.sum(h.cast("decimal(38,0)")).alias(n) for h, n in zip(row, "ab")]
    )
    totals.coalesce(1).write.parquet(f"{path}/buckets")
    about = {"keys": keys, "buckets": buckets, "bucket": bucket, "rows": placed.schema.json(), "digests": digests.schema.json()}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/about")


def _about(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/about").first()["value"])


def _part(spark: SparkSession, path: str, part: str, about: dict, differing: list[int]) -> DataFrame:
    """Rows or digests of some buckets; the others' files are not listed for reading."""
    schema = StructType.fromJson(json.loads(about["rows" if part == "rows" else "digests"]))
    stored = spark.read.schema(schema).parquet(f"{path}/{part}")
    return stored.where(F.col(about["bucket"]).isin(differing)).drop(about["bucket"])


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ; there are at most as many as the snapshots were cut into."""
    was, now = (spark.read.parquet(f"{path}/buckets").select("bucket", F.struct("n", "a", "b").alias(name)) for path, name in ((old, "was"), (new, "now")))
    joined = was.join(now, "bucket", "full_outer").where(~F.col("was").eqNullSafe(F.col("now")))
    return sorted(r["bucket"] for r in joined.select("bucket").collect())


def changed_since(spark: SparkSession, old: str, new: str) -> DataFrame:
    """What ``snapshot_diff`` reports, of two saved snapshots, from the buckets that differ."""
    before, after = _about(spark, old), _about(spark, new)
    if (before["keys"], before["buckets"]) != (after["keys"], after["buckets"]):
        raise ValueError("snapshots with other keys or buckets can't be compared by their digests")
    keys, differing = before["keys"], differing_buckets(spark, old, new)
    was = _part(spark, old, "keys", before, differing).withColumnRenamed("_digest", "_was")
    now = _part(spark, new, "keys", after, differing).withColumnRenamed("_digest", "_now")
    one, two = _part(spark, old, "rows", before, differing), _part(spark, new, "rows", after, differing)
    payload = [c for c in two.columns if c not in keys]
    payload += [c for c in one.columns if c not in [*keys, *payload]]
    names = [*keys, *payload]
    return _rows(_differing(was, now, keys), _complete(one, two, names), _complete(two, one, names), keys, payload)
