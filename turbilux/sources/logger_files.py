"""Logger exports: a title line, a header line, then samples and events.

All files are read as one text scan.  The serial number is part of every header, so
each file has its own column names; they are reduced to one long schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turbilux.functions.times import parse_logger_timestamp
from turbilux.operators.joins import lookup_join
from turbilux.site import EVENT_MARK
from turbilux.sources.names import clean_header_field

SAMPLE_COLUMNS = ("file_path", "logger_sn", "gmt_offset", "number", "date_time", "temp_f", "intensity_lum_ft2", "is_event")

# How the export marks its parts.
HEADER_LINE = '^"?#"?,'
SAMPLE_LINE = '^"?[0-9]+"?,'
TITLE_LINE = '^"?Plot Title'
SERIAL = r"LGR S/N: ([0-9]+)"
OFFSET = r"GMT([+-][0-9]{2}:[0-9]{2})"
FILE_SERIAL = r"^([0-9]+)_"
# a comma outside double quotes
FIELD_BREAK = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# column positions of the usual export
USUAL_PLACES = {"number": 1, "date_time": 2, "temp_f": 3, "intensity_lum_ft2": 4}


def _text_lines(lines: DataFrame) -> DataFrame:
    """``file_path`` and the line without byte-order mark and Windows line end."""
    return lines.select("file_path", F.btrim("value", F.lit("\ufeff\r")).alias("line"))


def classified(lines: DataFrame) -> DataFrame:
    """Adds what each line is, as ``kind``: title, header, event, sample, blank or unread; and ``bad_time``.

    A sample line may carry an event mark; it is an event if it does.  A time is bad if there is one and it cannot be
    parsed, at the usual place (exports with other column orders: see ``unusual_headers``).
    """
    line = F.col("line")
    kind = (
        F.when(line.rlike(SAMPLE_LINE), F.when(F.contains(line, F.lit(EVENT_MARK)), "event").otherwise("sample"))
        .when(line.rlike(HEADER_LINE), "header")
        .when(line.rlike(TITLE_LINE), "title")
        .when(F.trim(line) == "", "blank")
        .otherwise("unread")
    )
    time = F.btrim(F.split_part(line, F.lit(","), F.lit(USUAL_PLACES["date_time"])), F.lit('" '))
    bad = F.col("kind").isin("sample", "event") & (time != "") & parse_logger_timestamp(time).isNull()
    return _text_lines(lines).withColumn("kind", kind).withColumn("bad_time", F.coalesce(bad, F.lit(False)))


AUDIT_KINDS = {"titles": "title", "headers": "header", "samples": "sample", "events": "event", "blank": "blank", "unread": "unread"}


def _audit_counts() -> list[Column]:
    counts = [F.count(F.when(F.col("kind") == kind, F.lit(1))).alias(name) for name, kind in AUDIT_KINDS.items()]
    return [F.count(F.lit(1)).alias("lines"), *counts, F.count(F.when(F.col("bad_time"), F.lit(1))).alias("bad_times")]


def audit_lines(lines: DataFrame) -> DataFrame:
    """Per file: lines, titles, headers, samples, events, blank and unread ones, and sample times that cannot be parsed.

    One scan of the text and one aggregation; every line is counted in exactly one of the kinds.
    """
    return classified(lines).groupBy("file_path").agg(*_audit_counts())


def _optional(text: Column) -> Column:
    return F.when(text != "", text)


def parse_headers(lines: DataFrame) -> DataFrame:
    """One row per file: serial number, GMT offset, cleaned names and column places."""
    headers = _text_lines(lines).filter(F.col("line").rlike(HEADER_LINE))
    names = F.transform(F.split("line", FIELD_BREAK), clean_header_field)

    def place(prefix: str) -> Column:
        hits = F.array_position(F.transform("names", lambda n: n.startswith(prefix)), F.lit(True))
        return F.when(hits > 0, hits).cast("int").alias(f"{prefix}_place")

    return headers.select(
        "file_path",
        _optional(F.regexp_extract("line", SERIAL, 1)).alias("logger_sn"),
        _optional(F.regexp_extract("line", OFFSET, 1)).alias("gmt_offset"),
        names.alias("names"),
    ).select("*", *(place(p) for p in USUAL_PLACES))


def unusual_headers(lines: DataFrame) -> DataFrame:
    """Files whose columns are not at ``USUAL_PLACES``; empty means the one-pass parse is safe."""
    usual = F.lit(True)
    for name, place in USUAL_PLACES.items():
        usual = usual & F.col(f"{name}_place").eqNullSafe(F.lit(place))
    return parse_headers(lines).filter(~usual)


def _sample_fields(lines: DataFrame, audit: Observation | None = None) -> DataFrame:
    line = F.col("line")
    # the audit's totals are counted while the lines pass
    text = _text_lines(lines) if audit is None else classified(lines).observe(audit, *_audit_counts())
    # the slower pattern runs only on lines with quotes
    quoted = F.transform(F.split(line, FIELD_BREAK), lambda f: F.btrim(f, F.lit('"')))
    fields = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))
    return (
        text.filter(line.rlike(SAMPLE_LINE))
        # the ordinal also spreads a large file over the tasks of a shuffle join
        .select("file_path", F.contains(line, F.lit(EVENT_MARK)).alias("is_event"), fields.alias("fields"))
        .withColumn("ordinal", F.get("fields", F.lit(0)))
    )


def _field(place: Column) -> Column:
    # casts and time parsing trim, and take an empty field as missing
    return F.get("fields", place - 1)


def _typed(place) -> list[Column]:
    return [
        _field(place("number")).try_cast("int").alias("number"),
        parse_logger_timestamp(_field(place("date_time"))).alias("date_time"),
        _field(place("temp_f")).try_cast("double").alias("temp_f"),
        _field(place("intensity_lum_ft2")).try_cast("double").alias("intensity_lum_ft2"),
        F.col("is_event"),
    ]


def parse_samples(lines: DataFrame, places: str = "header", audit: Observation | None = None) -> DataFrame:
    """Text lines to the long sample schema (``SAMPLE_COLUMNS``).

    ``places="header"`` takes each file's column places, serial and offset from its own
    header (a second pass over the text, joined by file).  ``places="usual"`` is a single
    pass for exports in the usual column order: serial from the file name, no offset.
    ``audit`` receives the totals of ``audit_lines`` over all lines read, without another scan.
    """
    fields = _sample_fields(lines, audit)
    if places == "usual":
        return fields.select(
            "file_path",
            _optional(F.regexp_extract(F.substring_index("file_path", "/", -1), FILE_SERIAL, 1)).alias("logger_sn"),
            F.lit(None).cast("string").alias("gmt_offset"),
            *_typed(lambda name: F.lit(USUAL_PLACES[name])),
        )
    if places != "header":
        raise ValueError("places must be 'header' or 'usual'")
    headers = parse_headers(lines).drop("names")
    return lookup_join(fields, headers, ["file_path"], "left").select(
        "file_path",
        "logger_sn",
        "gmt_offset",
        *_typed(lambda name: F.col(f"{name}_place")),
    )


def read_samples(
    spark: SparkSession, paths: str | list[str], places: str = "header", audit: Observation | None = None
) -> DataFrame:
    """Samples and events of all given files or folders."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return parse_samples(lines, places, audit)
