"""Stored tables (Parquet)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_DAY = "sample_date"
# a file's day is one bucket key: a long file spreads over many buckets
SAMPLE_BUCKETS = ("file_path", SAMPLE_DAY)
SAMPLE_ORDER = ("file_path", SAMPLE_DAY, "number")


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write Parquet.  Partitioned writes are rebalanced first: small partitions end in
    one file, an oversized one is split over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in the cluster's shared checkpoint folder.

    For small tables several jobs read.  ``spark.checkpoint.dir`` must name a folder that all executors share.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def save_samples(samples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store logger samples by calendar day, so that trial windows prune the scan.

    Within a day a file's samples lie together in order, which packs them well.
    """
    dated = samples.withColumn(SAMPLE_DAY, F.to_date("date_time")).hint("rebalance", SAMPLE_DAY)
    packed = dated.sortWithinPartitions(SAMPLE_DAY, "file_path", "number")
    packed.write.mode(mode).partitionBy(SAMPLE_DAY).parquet(path)


def save_bucketed(
    df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, order: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Store as a table of the catalog, in ``buckets`` buckets by ``by`` and sorted inside.

    Joins and aggregations on these columns then start without a shuffle of this table.  Rows are dealt out as the buckets
    are, so each is one file.  Take at least as many buckets as shuffle partitions, or a join deals the rows out again.
    """
    writer = df.repartition(buckets, *by).write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *by)
    (writer.sortBy(*order) if order else writer).saveAsTable(table)


def load_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def register_bucketed(
    spark: SparkSession, table: str, path: str, by: Sequence[str], buckets: int, order: Sequence[str] = ()
) -> DataFrame:
    """Name a folder that ``save_bucketed`` wrote, in a session whose catalog does not know it."""
    names = [", ".join(f"`{c}`" for c in columns) for columns in (by, order)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    ordered = f"SORTED BY ({names[1]}) " if order else ""
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({names[0]}) {ordered}INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def save_bucketed_samples(samples: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite") -> None:
    """Store logger samples by file and day, so that windows, trials and extents find them where they lie."""
    dated = samples.withColumn(SAMPLE_DAY, F.to_date("date_time"))
    save_bucketed(dated, table, path, SAMPLE_BUCKETS, buckets, SAMPLE_ORDER, mode)
