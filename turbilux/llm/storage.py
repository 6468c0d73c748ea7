"""Tables written between the steps of an operator, in the folder the whole cluster shares."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Only a local session without that setting (as in tests) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="turbilux-")


def staged(df: DataFrame) -> DataFrame:
    """Write once as Parquet and read again: later steps neither recompute it nor depend on executors that made it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` not in ``gone`` (doc_id, row_hash), with all their columns; a row is known by its doc_id and text."""
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("row_hash").alias("gone_hash"))
    # columns are bound to their frames, so that extra columns of docs may have any name
    same = (F.xxhash64(docs["text"]) == gone["gone_hash"]) & docs["doc_id"].eqNullSafe(gone["gone_id"])
    return docs.join(gone, same, "left_anti")
