"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a local session without one (tests) gets a
    temporary folder, as no other machine has to read it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder and read back, so that a lost executor
    costs no recomputation and no branch runs twice. Keeps the partitioning."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Folders of tables that ``store`` has written, until ``clear`` removes them.
_stored: list[str] = []


def store(df: DataFrame) -> DataFrame:
    """The same by a Parquet table in the checkpoint folder: compressed, and read by column, but
    without its partitioning. Results read it, so it stays until ``clear``."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored() -> list[str]:
    """The folders of all tables stored so far."""
    return list(_stored)


def clear(spark: SparkSession, paths: list[str]) -> None:
    """Remove stored tables that no result still to be read depends on."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _stored.remove(path)
