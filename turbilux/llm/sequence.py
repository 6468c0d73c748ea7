"""Places in a total order, and groups of a sorted stream, for operators that walk over neighbours."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turbilux.llm.storage import staged

# bits below the partition number in Spark's monotonically increasing ids
_ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``df`` written in the given order, with each row's place in it (long, from 0).

    Rows are dealt by ranges of the order, so that no task holds more than its share; only the rows of each partition are
    counted on the driver.  ``order`` should tell rows apart that are many: equal ones go to one task.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = staged(placed.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", _ROW_BITS)
    counts = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r._part):
        offsets.append((row._part, total))
        total += row.n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    place = F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return table.withColumn("_part", part).join(starts, "_part").withColumn(name, place).drop("_part", "_offset", "_id")


def changes(table: pa.Table | pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Row numbers at which a new group of equal ``keys`` (no nulls) begins, the first row included."""
    if not len(table):
        return np.zeros(0, np.int64)
    new = np.zeros(len(table) - 1, bool)
    for key in keys:
        column = table.column(key)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        new |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of a sorted stream again, cut only between groups; groups must be of bounded size."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        last = int(changes(table, keys)[-1])
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None:
        yield held
