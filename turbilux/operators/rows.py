"""Row and column filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turbilux.functions.missing import present, present_number
from turbilux.operators.ranks import ranked
from turbilux.site import EVENT_MARK


def _is_floating(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] in ("double", "float")


def drop_event_rows(df: DataFrame, mark: str = EVENT_MARK) -> DataFrame:
    """Rows in which any text column contains the event mark (or ``is_event``) go."""
    if "is_event" in df.columns:
        return df.filter(~F.col("is_event"))
    marked = F.lit(False)
    for name, kind in df.dtypes:
        if kind == "string":
            marked = marked | F.coalesce(F.contains(F.col(name), F.lit(mark)), F.lit(False))
    return df.filter(~marked)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Columns without a single value go; one aggregation, one row to the driver."""
    counts = df.agg(
        *(
            F.count(F.when(~F.isnan(c), F.col(c)) if kind in ("double", "float") else F.col(c)).alias(c)
            for c, kind in df.dtypes
        )
    ).first()
    return df.select(*(c for c in df.columns if counts[c] > 0))


def drop_any_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_na(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def require_present(df: DataFrame, *columns: str) -> DataFrame:
    """NULL and NaN both count as missing."""
    for c in columns:
        df = df.filter(present_number(c) if _is_floating(df, c) else present(c))
    return df


def exclude_flagged(df: DataFrame, flag: str = "data_issue") -> DataFrame:
    return df.filter(F.col(flag).isNull()).drop(flag)


def exclude_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(~F.col(column).rlike(pattern))


def exclude_dates(df: DataFrame, patterns: Sequence[str], column: str = "date") -> DataFrame:
    """Days whose ISO text matches a pattern go; so do rows without a day."""
    for p in patterns:
        df = df.filter(~F.date_format(column, "yyyy-MM-dd").rlike(p))
    return df


def prefix_path(df: DataFrame, column: str = "lightlogger_file_path", prefix: str = "../") -> DataFrame:
    return df.withColumn(column, F.concat(F.lit(prefix), F.col(column)))


def drop_prefixed(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(prefixes)))


def equals(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns equal the given values."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def exclude_problem_poles(trials: DataFrame, problem: str = "problem") -> DataFrame:
    return trials.filter(F.col(problem).isNull())


def clip_to_site(df: DataFrame, max_x: float = 300.0, max_y: float = 200.0) -> DataFrame:
    return df.filter((F.col("coord_y") <= max_y) & (F.col("coord_x") <= max_x))


def exclude_unclassified(df: DataFrame, *columns: str, label: str = "U") -> DataFrame:
    for c in columns or ("track", "zone"):
        df = df.filter(F.col(c) != label)
    return df


def unique_dates(df: DataFrame, column: str = "date", order: Sequence[str | Column] = ()) -> DataFrame:
    """Distinct days with their rank (``date_rank``, from 1): by first appearance in ``order``, or by date without one.

    First places are a minimum per day, ranked over ranges (``ranked``), so no task holds all days.  Rows without a day are
    left out.
    """
    place = F.struct(*order) if order else F.struct(column)
    days = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(place).alias("_first"))
    firsts = [f"_first_{i}" for i in range(max(len(order), 1))]
    placed = days.withColumn("_first", F.col("_first").cast(_renamed(days, "_first", firsts))).select(column, "_first.*")
    return ranked(placed, firsts, "date_rank", missing_last=False).select(column, F.col("date_rank").cast("int").alias("date_rank"))


def _renamed(df: DataFrame, column: str, names: Sequence[str]) -> T.StructType:
    """The type of a struct column with its fields renamed."""
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema[column].dataType.fields)])


def input_order(df: DataFrame) -> DataFrame:
    """Adds ``input_file`` and ``input_row``: where each row stands in the Parquet files it was read from."""
    return df.withColumns({"input_file": F.col("_metadata.file_path"), "input_row": F.col("_metadata.row_index")})
