"""First and last sample of each logger file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turbilux.functions.times import seconds_between
from turbilux.operators.joins import lookup_join


# ordinals of a file that form one mergeable state, and the bits of a place among them
CHUNK_ROWS = 64
_BITS = 6


def _whole_number(df: DataFrame, name: str) -> Column | None:
    """A column as decimal(20,0) in the same order, if it has such a form."""
    kind = dict(df.dtypes)[name]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(name).cast("decimal(20,0)")
    if kind in ("timestamp_ntz", "timestamp"):
        seconds = (F.col(name) - F.lit("1970-01-01").cast(kind)).cast("decimal(18,6)")
        return (seconds * F.lit(1_000_000)).cast("decimal(20,0)")
    return None


def _position(df: DataFrame, order: Sequence[str]) -> Column:
    """What orders a file's rows.  One plain column, or two packed into one number, keep the aggregation hash-based."""
    if len(order) == 1:
        return F.col(order[0])
    parts = [_whole_number(df, c) for c in order]
    if len(parts) > 2 or any(p is None for p in parts):
        return F.struct(*order)
    # the second is any 64-bit number
    return parts[0] * F.lit(str(2**64)).cast("decimal(20,0)") + parts[1]


def drop_last_row(df: DataFrame, file: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows but each file's last (``order`` must be unique within the file).

    A lookup of the per-file maximum instead of a window: the maximum is pre-aggregated
    and a file of any size stays split over many tasks.
    """
    file = list(file)
    position = _position(df, order)
    last = df.groupBy(*file).agg(F.max(position).alias("_last"))
    return lookup_join(df, last, file).filter(position < F.col("_last")).drop("_last")


def recorded_extent(
    samples: DataFrame,
    sensors: Sequence[str],
    file: str = "file_path",
    number: str = "number",
    ts: str = "date_time",
) -> DataFrame:
    """``file_extent`` (last row dropped) over the rows on which every sensor that a file recorded has a value.

    A sensor without a single value in a file is left out of that file.  Which ones those are is known only at the end, so
    the state of a file holds count, first and last two rows for each combination of sensors; a row has one combination, and
    the wanted one is that of all sensors the file recorded.  The states are pre-aggregated over runs of ``CHUNK_ROWS``
    ordinals (unique within the file) and merged per file: the samples are scanned once and only states are shuffled.
    """
    held = " + ".join(f"if(`{c}` is null or isnan(`{c}`), 0, {1 << i})" for i, c in enumerate(sensors))
    known = f"`{number}` is not null and `{ts}` is not null"
    rows = samples.filter(F.col(file).isNotNull()).selectExpr(
        f"`{file}` as _file",
        f"if({known}, `{number}`, null) as _number",
        f"`{ts}` as _time",
        f"{held} as _held",
        f"if({known}, floor(`{number}` / {CHUNK_ROWS}), null) as _chunk",
        f"if({known}, cast(pmod(`{number}`, {CHUNK_ROWS}) as int), null) as _place",
    )
    bits = range(_BITS)
    # last row of those whose place has the bit set or not: the last but one is the last of some such half
    halves = [
        F.expr(f"max_by(_time, if((_place >> {i}) & 1 = {v}, _number, null)) as _half_{i}_{v}") for i in bits for v in (0, 1)
    ]
    states = rows.groupBy("_file", "_held", "_chunk").agg(
        F.expr("count(_place) as _n"),
        F.expr("bit_or(shiftleft(1L, _place)) as _places"),
        F.expr("max(_place) as _top"),
        F.expr("min_by(_time, _number) as _first"),
        F.expr("max_by(_time, _number) as _last"),
        *halves,
    )
    second = "length(bin(_places ^ shiftleft(1L, _top))) - 1"
    found = " ".join(
        f"when ((({second}) ^ _top) >> {i}) & 1 = 1 then if((({second}) >> {i}) & 1 = 1, _half_{i}_1, _half_{i}_0)" for i in bits
    )
    # a chunk of one row is preceded by the last row of the chunk before
    states = states.selectExpr(
        "_file", "_held", "_chunk", "_n", "_first",
        f"case when _n > 1 then case {found} end end as _inside",
        "lag(struct(_held, _last)) over (partition by _file order by _held, _chunk) as _earlier",
    ).selectExpr(
        "_file", "_held", "_chunk", "_n", "_first",
        "coalesce(_inside, if(_earlier._held = _held, _earlier._last, null)) as _before",
    )
    combinations = range(1 << len(sensors))
    aggregates = [F.expr("bit_or(_held) as _recorded")]
    for c in combinations:
        aggregates += [
            F.expr(f"sum(if(_held = {c}, _n, null)) as _n_{c}"),
            F.expr(f"min_by(_first, if(_held = {c}, _chunk, null)) as _first_{c}"),
            F.expr(f"max_by(_before, if(_held = {c}, _chunk, null)) as _before_{c}"),
        ]

    def wanted(name: str) -> str:
        return f"case _recorded {' '.join(f'when {c} then _{name}_{c}' for c in combinations)} end as _{name}"

    chosen = states.groupBy("_file").agg(*aggregates).selectExpr("_file", wanted("n"), wanted("first"), wanted("before"))
    interval = F.try_divide(seconds_between("_first", "_before"), F.col("_n") - 2)
    return chosen.filter(F.col("_n") > 0).select(
        F.col("_file").alias(file),
        F.when(F.col("_n") > 1, F.col("_first")).alias("first_date_time"),
        F.col("_before").alias("last_date_time"),
        interval.alias("measurement_interval"),
    )


def file_extent(
    samples: DataFrame,
    file: Sequence[str] = ("file_path",),
    order: Sequence[str] = ("number",),
    ts: str = "date_time",
    drop_last: bool = True,
) -> DataFrame:
    """first_date_time, last_date_time and seconds per sample of each file.

    With ``drop_last`` the last row is left out first.  Start and count are plain
    aggregates; the end needs the two last rows, which a row limit per file finds
    before the shuffle, so no task ever holds a whole file.
    """
    file, order = list(file), list(order)
    # both branches below start from the same rows, so that a shuffle under them is reused
    samples = samples.filter(reduce(and_, (F.col(c).isNotNull() for c in file)))
    if order[0] == ts:
        first, last = F.min(ts), F.max(ts)
    else:
        first, last = F.min_by(ts, _position(samples, order)), F.max_by(ts, _position(samples, order))
    rows = F.count(F.lit(1)) - (1 if drop_last else 0)
    extent = samples.groupBy(*file).agg(
        first.alias("first_date_time"), last.alias("last_date_time"), rows.alias("_rows")
    )
    if drop_last:
        backwards = Window.partitionBy(*file).orderBy(*(F.col(c).desc() for c in order))
        second_last = (
            samples.select(*file, *order, F.col(ts).alias("_ts"))
            .withColumn("_from_end", F.row_number().over(backwards))
            .filter(F.col("_from_end") == 2)
            .select(*file, F.col("_ts").alias("last_date_time"))
        )
        extent = extent.drop("last_date_time").join(second_last, file, "left")
    known = F.when(F.col("_rows") > 0, F.col("first_date_time"))
    interval = F.try_divide(seconds_between("first_date_time", "last_date_time"), F.col("_rows") - 1)
    return extent.select(
        *file, known.alias("first_date_time"), "last_date_time", interval.alias("measurement_interval")
    )


def _known(fold, c: str, *over) -> Column:
    """An aggregate that is missing as soon as one input is."""
    parts = [f.over(*over) if over else f for f in (F.count(c), F.count(F.lit(1)), fold(c))]
    return F.when(parts[0] == parts[1], parts[2])


def common_extent() -> list[Column]:
    """The aggregates of ``harmonise_extent``, for a plan that groups by pole anyway."""
    return [
        _known(F.max, "first_date_time").alias("first_date_time"),
        _known(F.min, "last_date_time").alias("last_date_time"),
        _known(F.min, "measurement_interval").alias("measurement_interval"),
    ]


def harmonise_extent(deployments: DataFrame, by: Sequence[str] = ("point_name", "date")) -> DataFrame:
    """The loggers of a pole (a handful of rows) get their common time span and interval."""
    pole = Window.partitionBy(*by)
    return deployments.withColumns(
        {
            "first_date_time": _known(F.max, "first_date_time", pole),
            "last_date_time": _known(F.min, "last_date_time", pole),
            "measurement_interval": _known(F.min, "measurement_interval", pole),
        }
    )
