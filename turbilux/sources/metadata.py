"""Metadata sheets (CSV or Parquet): deployments, disturbances, problem poles, coordinates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turbilux.functions.missing import na_tokens_to_null
from turbilux.functions.times import date_plus_time, date_plus_time_text, parse_date
from turbilux.site import NA_TOKENS
from turbilux.sources.names import clean_names

# Column types of the sheets; everything else stays text.
DEPLOYMENT_TYPES = {"date": "date", "logger_number_per_pole": "int"}
DISTURBANCE_TYPES = {"date": "date", "disturbance_number": "int"}
PROBLEM_TYPES = {"date": "date", "disturbance": "int"}
COORDINATE_TYPES = {
    "date": "date",
    "disturbance_id": "int",
    "line_id": "int",
    "coord_x": "double",
    "coord_y": "double",
    "angle_degrees": "double",
    "distance_from_disturbance_ft": "double",
    "reference_coord_x": "double",
    "reference_coord_y": "double",
}


def _read_sheet(spark: SparkSession, path, source: str) -> DataFrame:
    if source == "csv":
        return spark.read.csv(path, header=True, inferSchema=False)
    return spark.read.format(source).load(path)


def clean_metadata(
    sheet: DataFrame, types: Mapping[str, str] | None = None, na_tokens: tuple[str, ...] = NA_TOKENS
) -> DataFrame:
    """Clean names, missing-value spellings to NULL, then the given types (bad values NULL)."""
    named = clean_names(sheet)
    types = types or {}
    columns = []
    for name, kind in named.dtypes:
        c = F.col(name)
        if kind == "string":
            c = na_tokens_to_null(c, na_tokens) if na_tokens else c
            if types.get(name) == "date":
                c = parse_date(c)
        if name in types:
            c = c.try_cast(types[name])
        columns.append(c.alias(name))
    return named.select(*columns)


def read_metadata(
    spark: SparkSession,
    path,
    types: Mapping[str, str] | None = None,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    source: str = "csv",
) -> DataFrame:
    return clean_metadata(_read_sheet(spark, path, source), types, na_tokens)


def read_problem_poles(spark: SparkSession, path, source: str = "csv") -> DataFrame:
    """Only names are cleaned and columns typed: this sheet has no missing-value spellings."""
    return clean_metadata(_read_sheet(spark, path, source), PROBLEM_TYPES, na_tokens=())


def place_on_day(disturbances: DataFrame) -> DataFrame:
    """``start_time`` and ``end_time`` hold a time of day; put it on the row's ``date``."""
    kinds = dict(disturbances.dtypes)
    return disturbances.withColumns(
        {
            c: (date_plus_time_text if kinds[c] == "string" else date_plus_time)("date", c)
            for c in ("start_time", "end_time")
        }
    )


def read_disturbances(spark: SparkSession, path, source: str = "csv") -> DataFrame:
    return place_on_day(read_metadata(spark, path, DISTURBANCE_TYPES, source=source))
