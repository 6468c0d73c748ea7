
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import fixture_views as V  # noqa: E402
from oracle_views import r6, track_level, track_of, with_views, zone_level, zone_of  # noqa: E402
from turbilux.functions.geometry import track_ordinal, trial_title, zone_ordinal  # noqa: E402
from turbilux.functions.light import rolling_width  # noqa: E402
from turbilux.functions.times import date_plus_time, parse_date, parse_logger_timestamp, wall_seconds  # noqa: E402
from turbilux.operators import cells as C  # noqa: E402
from turbilux.operators.extent import drop_last_row, file_extent, harmonise_extent  # noqa: E402
from turbilux.operators.exact_sums import order_free_stats  # noqa: E402
from turbilux.operators.joins import join_coordinates, samples_in_windows, window_bin_seconds  # noqa: E402
from turbilux.operators.pairing import (  # noqa: E402
    mean_attenuation,
    mean_attenuation_of_samples,
    mean_intensity,
    pair_loggers,
    pair_samples,
    pairing_report,
)
from turbilux.operators.ranks import ranked  # noqa: E402
from turbilux.operators.reshape import bind_rows, pivot_loggers, split_on_borders, unpivot_loggers  # noqa: E402
from turbilux.operators.rolling import blocked_rolling_mean  # noqa: E402
from turbilux.operators.rows import (  # noqa: E402
    clip_to_site,
    drop_all_null_columns,
    drop_any_null_rows,
    drop_event_rows,
    drop_na,
    drop_prefixed,
    exclude_dates,
    exclude_flagged,
    exclude_matching,
    input_order,
    require_present,
    unique_dates,
)
from turbilux.plans.legacy import legacy_pole_heatmap, paired_window_means  # noqa: E402
from turbilux.plans.pole_trials import planned_trials, pole_trials, sample_extents, usable_deployments  # noqa: E402
from turbilux.plans.site_tables import (  # noqa: E402
    HEATMAPS,
    all_heatmaps,
    cell_attenuation,
    coordinates,
    disturbance_segments,
    grid_with,
    gridded_poles,
    heatmaps,
    pole_map,
)
from turbilux.plans.trial_series import trial_series  # noqa: E402
from turbilux.site import LEGACY_BORDER_SHIFT, LEGACY_BORDER_WIDTH  # noqa: E402
from turbilux.sources.logger_files import audit_lines, parse_samples  # noqa: E402
from turbilux.sources.metadata import clean_metadata  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# trial days left out of the full pipeline on the given tables
EXCLUDED_DAYS = ("2024-01-2[0-3]",)


def query(name: str, sql: str):
    """Register a query with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = with_views(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, as the SQL side does."""
    return df.select(
        *((F.round(c, digits) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes)
    )


# --- pairing and attenuation ---------------------------------------------------------


@query(
    "mean_attenuation",
    f"select date, disturbance_number, pole_id, {r6('light_attenuation_mean')} light_attenuation_mean from v_att",
)
def _mean_attenuation(spark, sf):
    return rounded(V.attenuation(spark, sf))


@query(
    "mean_attenuation_ieee",
    f"""with r as (select user_id // 2 pole_id, user_id % 2 side, date_trunc('hour', ts) slot_ts, avg(floor(value / 20)) light
                  from events group by 1, 2, 3)
       select cast(a.pole_id as bigint) pole_id, cast(a.slot_ts as date) date,
              case when bool_or(a.light = 0 and b.light > 0) then '-infinity'::double
                   else {r6('avg(case when a.light > 0 then 100 * (a.light - b.light) / a.light end)')} end light_attenuation_mean
       from r a join r b on a.pole_id = b.pole_id and a.slot_ts = b.slot_ts and a.side = 0 and b.side = 1
       group by 1, 2""",
)
def _mean_attenuation_ieee(spark, sf):
    """Light in coarse steps, so that many samples are dark: zero light follows IEEE."""
    events = V.table(spark, sf, "events")
    light = events.groupBy(
        F.floor(F.col("user_id") / 2).alias("pole_id"),
        (F.col("user_id") % 2 + 1).alias("logger_number"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot_ts"),
    ).agg(F.avg(F.floor(F.col("value") / 20)).alias("intensity"))
    pairs = pair_samples(light, ["pole_id", "slot_ts"], ["intensity"])
    dated = pairs.withColumn("date", F.to_date("slot_ts"))
    return rounded(mean_attenuation(dated, ["pole_id", "date"], "intensity"))


@query(
    "pairing_repeated",
    """select cast(a.user_id // 2 as bigint) pole_id, date_trunc('hour', a.ts) slot_ts, a.event_id event_id_1, b.event_id event_id_2
       from events a join events b on a.user_id // 2 = b.user_id // 2 and date_trunc('hour', a.ts) = date_trunc('hour', b.ts)
       where a.user_id % 2 = 0 and b.user_id % 2 = 1""",
)
def _pairing_repeated(spark, sf):
    """Natural join by time alone, with times that repeat within a logger: many to many."""
    samples = V.table(spark, sf, "events").select(
        F.floor(F.col("user_id") / 2).alias("pole_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot_ts"),
        (F.col("user_id") % 2).alias("side"),
        "event_id",
    )
    top, bottom = (samples.filter(F.col("side") == n).drop("side") for n in (0, 1))
    return pair_loggers(top, bottom, keys=["slot_ts"], within=["pole_id"])


@query(
    "mean_attenuation_repeated",
    f"""with r as (select user_id // 2 pole_id, user_id % 2 side, date_trunc('hour', ts) slot_ts, floor(value / 20) light from events)
       select cast(a.pole_id as bigint) pole_id, cast(a.slot_ts as date) date,
              case when bool_or(a.light = 0 and b.light > 0) then '-infinity'::double
                   else {r6('avg(case when a.light > 0 then 100 * (a.light - b.light) / a.light end)')} end light_attenuation_mean
       from r a join r b on a.pole_id = b.pole_id and a.slot_ts = b.slot_ts and a.side = 0 and b.side = 1
       group by 1, 2""",
)
def _mean_attenuation_repeated(spark, sf):
    """Every event a sample: times repeat within a logger, and all combinations count without being made."""
    return rounded(mean_attenuation_of_samples(_repeated_samples(spark, sf), ["pole_id", "date"], ["slot_ts"], "intensity"))


@query(
    "mean_attenuation_repeated_skip",
    f"""with r as (select user_id // 2 pole_id, user_id % 2 side, date_trunc('hour', ts) slot_ts, floor(value / 20) light from events)
       select cast(a.pole_id as bigint) pole_id, cast(a.slot_ts as date) date,
              {r6('avg(100 * (a.light - b.light) / nullif(a.light, 0))')} light_attenuation_mean
       from r a join r b on a.pole_id = b.pole_id and a.slot_ts = b.slot_ts and a.side = 0 and b.side = 1
       group by 1, 2""",
)
def _mean_attenuation_repeated_skip(spark, sf):
    samples = _repeated_samples(spark, sf)
    return rounded(mean_attenuation_of_samples(samples, ["pole_id", "date"], ["slot_ts"], "intensity", zero_light="skip"))


def _repeated_samples(spark, sf):
    return V.table(spark, sf, "events").select(
        F.floor(F.col("user_id") / 2).alias("pole_id"),
        (F.col("user_id") % 2 + 1).alias("logger_number"),
        F.to_date("ts").alias("date"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot_ts"),
        F.floor(F.col("value") / 20).alias("intensity"),
    )


@query(
    "mean_intensity",
    f"""select d.date, d.disturbance_number, r.pole_id, r.logger_number, {r6('avg(r.intensity)')} mean_intensity
       from v_readings r join v_disturbances d on r.slot_ts >= d.start_time and r.slot_ts < d.end_time
       group by 1, 2, 3, 4""",
)
def _mean_intensity(spark, sf):
    inside = samples_in_windows(
        V.readings(spark, sf), V.disturbances(spark, sf), ts="slot_ts"
    )
    return rounded(mean_intensity(inside, ["date", "disturbance_number", "pole_id", "logger_number"], "intensity"))


@query(
    "mean_intensity_binned",
    f"""select d.date, d.disturbance_number, cast(user_id // 2 as bigint) pole_id, {r6('avg(value)')} mean_intensity
       from events join v_disturbances d on ts >= d.start_time and ts < d.end_time
       group by 1, 2, 3""",
)
def _mean_intensity_binned(spark, sf):
    """Every event in its windows without a file key, met by bins as wide as an eighth of a window."""
    samples = V.table(spark, sf, "events").select(
        F.floor(F.col("user_id") / 2).alias("pole_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value"
    )
    windows = V.disturbances(spark, sf)
    inside = samples_in_windows(samples, windows, ts="ts", bin_seconds=window_bin_seconds(windows))
    return rounded(mean_intensity(inside, ["date", "disturbance_number", "pole_id"], "value"))


@query(
    "intensity_order_free",
    f"""select event_type, count(*) n, {r6('avg(value)')} mean_intensity, {r6('stddev_samp(value)')} sd_intensity,
              cast(cast(sum(cast(round(value * 4) as hugeint) * 3) as varchar) as double) sum_exact
       from events group by 1""",
)
def _intensity_order_free(spark, sf):
    """Statistics of single events that are equal to the last bit on any cluster; the exact sum is compared unrounded."""
    events = V.table(spark, sf, "events").select(
        "event_type", F.col("value"), (F.round(F.col("value") * 4) * 3).alias("steps")
    )
    stats = order_free_stats(
        events,
        ["event_type"],
        means={"mean_intensity": "value"},
        sds={"sd_intensity": "value"},
        sums={"sum_exact": "steps"},
        wholes={"n": F.lit(1)},
    )
    return stats.select(
        "event_type", "n", *((F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("mean_intensity", "sd_intensity")), "sum_exact"
    )


@query(
    "pairing_report",
    """select pole_id,
              cast(sum(case when b = 0 then t else 0 end) as bigint) unpaired_top,
              cast(sum(case when t = 0 then b else 0 end) as bigint) unpaired_bottom,
              cast(sum(t * b) as bigint) pairs
       from (select pole_id, slot_ts, sum(case when logger_number = 1 then 1 else 0 end) t,
                    sum(case when logger_number = 2 then 1 else 0 end) b
             from v_readings group by 1, 2) s
       group by 1""",
)
def _pairing_report(spark, sf):
    return pairing_report(V.readings(spark, sf), ["pole_id"], ["slot_ts"])


@query(
    "legacy_pairing",
    f"""select pole_id, start_time, cast(start_time as date) date,
              {r6('i1')} logger_1_intensity, {r6('i2')} logger_2_intensity,
              {r6('100 * (i2 - i1) / nullif(i1, 0)')} light_attenuation
       from v_legacy_pairs""",
)
def _legacy_pairing(spark, sf):
    return rounded(
        legacy_pole_heatmap(_window_means(spark, sf), _xy(spark, sf), on=["pole_id"], zero_light="skip").drop(
            "coord_x", "coord_y", "map_x"
        )
    )


def _window_means(spark, sf):
    return paired_window_means(
        V.readings(spark, sf),
        V.disturbances(spark, sf),
        (),
        by=["pole_id", "start_time"],
        value="intensity",
        ts="slot_ts",
    )


def _xy(spark, sf):
    return V.pole_places(spark, sf)


LEGACY_HEATMAP = f"""select p.pole_id, p.start_time, cast(p.start_time as date) date,
              {r6('p.i1')} logger_1_intensity, {r6('p.i2')} logger_2_intensity,
              {r6('100 * (p.i2 - p.i1) / nullif(p.i1, 0)')} light_attenuation,
              {r6('c.coord_x')} coord_x, {r6('c.coord_y')} coord_y, {r6('-c.coord_x')} map_x
       from v_legacy_pairs p left join v_xy c on p.pole_id = c.pole_id"""


@query("legacy_heatmap_all_dates", LEGACY_HEATMAP)
def _legacy_heatmap(spark, sf):
    paired = _window_means(spark, sf)
    return rounded(legacy_pole_heatmap(paired, _xy(spark, sf), on=["pole_id"], zero_light="skip"))


@query("legacy_heatmap_one_date", LEGACY_HEATMAP + " where cast(p.start_time as date) = date '2024-01-15'")
def _legacy_heatmap_one(spark, sf):
    paired = _window_means(spark, sf)
    return rounded(
        legacy_pole_heatmap(paired, _xy(spark, sf), date="2024-01-15", on=["pole_id"], zero_light="skip")
    )


@query(
    "legacy_heatmap_per_disturbance",
    f"""select p.pole_id, p.start_time, cast(p.start_time as date) date, k.disturbance_number,
              {r6('p.i1')} logger_1_intensity, {r6('p.i2')} logger_2_intensity,
              {r6('100 * (p.i2 - p.i1) / nullif(p.i1, 0)')} light_attenuation,
              {r6('k.coord_x')} coord_x, {r6('k.coord_y')} coord_y, {r6('-k.coord_x')} map_x
       from v_legacy_pairs p
       left join (select a.date, a.disturbance_number, a.pole_id, c.coord_x, c.coord_y from v_att a join v_xy c on a.pole_id = c.pole_id) k
         on k.pole_id = p.pole_id and k.date = cast(p.start_time as date)""",
)
def _legacy_heatmap_fan_out(spark, sf):
    """A pole is listed once for each disturbance of a day: every pair meets all of them; pairs not listed stay."""
    listed = V.attenuation(spark, sf).select("date", "disturbance_number", "pole_id").join(_xy(spark, sf), "pole_id")
    paired = _window_means(spark, sf)
    return rounded(legacy_pole_heatmap(paired, listed, on=["pole_id", "date"], zero_light="skip"))


# --- files ---------------------------------------------------------------------------

EXTENT = """select user_id, min(ts) first_date_time, max(ts) last_date_time,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / nullif(count(*) - 1, 0) measurement_interval
from {rows} group by user_id"""
KEPT_ROWS = """(select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
                from events) x where rn > 1)"""


@query(
    "file_extent",
    f"""select user_id, first_date_time, last_date_time, measurement_interval,
               300 / measurement_interval + 1 as sliding_window_width
        from ({EXTENT.format(rows=KEPT_ROWS)}) e""",
)
def _file_extent(spark, sf):
    # microseconds over counts: the same doubles on both sides, so nothing is rounded
    return _extents(spark, sf).withColumn("sliding_window_width", rolling_width("measurement_interval"))


def _extents(spark, sf):
    return file_extent(V.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "ts")


@query(
    "file_extent_whole",
    EXTENT.format(rows="events"),
)
def _file_extent_whole(spark, sf):
    return file_extent(V.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "ts", drop_last=False)


@query(
    "file_extent_partial_sensors",
    """with s as (select user_id, event_id, ts, user_id % 3 <> 0 and event_id % 7 <> 0 and value is not null t,
                         user_id % 4 <> 0 and event_id % 5 <> 0 and value is not null l
                  from events where event_type <> 'error'),
       f as (select *, bool_or(t) over (partition by user_id) ft, bool_or(l) over (partition by user_id) fl from s),
       k as (select *, row_number() over (partition by user_id order by event_id desc) rn from f
             where (t or not ft) and (l or not fl))
       select 'logs/' || user_id file_path, min(case when rn > 1 then ts end) first_date_time, max(case when rn = 2 then ts end) last_date_time,
              (epoch_us(max(case when rn = 2 then ts end)) - epoch_us(min(case when rn > 1 then ts end))) / 1e6 / nullif(count(*) - 2, 0)
                measurement_interval
       from (select user_id, rn, case when event_id = min(event_id) over (partition by user_id) or rn = 2 then ts end ts from k) x
       group by user_id""",
)
def _file_extent_partial(spark, sf):
    """Files that lack a sensor, and rows that lack a value."""
    return sample_extents(V.partial_samples(spark, sf))


@query("drop_last_row", f"select event_id, user_id, ts, value from {KEPT_ROWS} k")
def _drop_last_row(spark, sf):
    events = V.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return drop_last_row(events, ["user_id"], ["ts", "event_id"])


@query(
    "harmonise_extent",
    f"""select user_id, cast(floor(user_id / 2) as bigint) pole_id,
               max(first_date_time) over p first_date_time, min(last_date_time) over p last_date_time,
               min(measurement_interval) over p measurement_interval
        from ({EXTENT.format(rows=KEPT_ROWS)}) e
        window p as (partition by floor(user_id / 2))""",
)
def _harmonise_extent(spark, sf):
    extents = _extents(spark, sf).withColumn("pole_id", F.floor(F.col("user_id") / 2).cast("bigint"))
    return harmonise_extent(extents, ["pole_id"])


@query(
    "clean_wide_log",
    """select event_id, ts, value from events where event_type not in ('error', 'purchase') and value is not null""",
)
def _clean_wide_log(spark, sf):
    """Event marks in their own columns, as in a logger file; marked rows and empty columns go."""
    logged = lambda kind: F.when(F.col("event_type") == kind, "Logged")
    wide = V.table(spark, sf, "events").select(
        "event_id", "ts", "value", logged("error").alias("button_down"), logged("purchase").alias("stopped")
    )
    return drop_any_null_rows(drop_all_null_columns(drop_event_rows(wide)))


@query(
    "logger_ingest",
    f"""select 'logs/' || user_id || '_export.csv' file_path, cast(user_id as varchar) logger_sn,
              case when user_id % 3 = 0 then '-05:00' else '-06:00' end gmt_offset,
              cast(event_id as integer) "number",
              case when user_id % 3 = 1 then date_trunc('minute', ts) else date_trunc('second', ts) end date_time,
              {r6('round(value + 60, 2)')} temp_f, {r6('value')} intensity_lum_ft2, event_type = 'error' is_event
       from events""",
)
def _logger_ingest(spark, sf):
    return rounded(parse_samples(V.log_lines(spark, sf)))


@query(
    "logger_ingest_usual_layout",
    f"""select 'logs/' || user_id || '_export.csv' file_path, cast(user_id as varchar) logger_sn,
              cast(event_id as integer) "number",
              case when user_id % 3 = 1 then date_trunc('minute', ts) else date_trunc('second', ts) end date_time,
              {r6('round(value + 60, 2)')} temp_f, {r6('value')} intensity_lum_ft2, event_type = 'error' is_event
       from events""",
)
def _logger_ingest_usual(spark, sf):
    return rounded(parse_samples(V.log_lines(spark, sf), places="usual").drop("gmt_offset"))


@query(
    "logger_audit",
    """select 'logs/' || user_id || '_export.csv' file_path, 2 + count(*) + count(*) filter (event_id % 10 < 3) as lines,
              cast(1 as bigint) titles, cast(1 as bigint) headers,
              count(*) filter (event_type <> 'error') + count(*) filter (event_id % 10 = 2) as samples,
              count(*) filter (event_type = 'error') as events, count(*) filter (event_id % 10 = 1) as blank,
              count(*) filter (event_id % 10 = 0) as unread, count(*) filter (event_id % 10 = 2) as bad_times
       from events group by user_id""",
)
def _logger_audit(spark, sf):
    """What became of every line: broken ones are counted per file."""
    return audit_lines(V.broken_log_lines(spark, sf))


# --- times ---------------------------------------------------------------------------


@query(
    "date_plus_time",
    """select event_id, (cast(ts as date) + cast(user_id % 7 as integer)) + (date_trunc('second', ts) - date_trunc('day', ts)) moved_ts
       from events""",
)
def _date_plus_time(spark, sf):
    """A day of the user's with the event's time of day."""
    events = V.table(spark, sf, "events")
    day = F.date_add(F.to_date("ts"), (F.col("user_id") % 7).cast("int"))
    return events.select("event_id", date_plus_time(day, "ts").alias("moved_ts"))


@query(
    "parse_timestamp",
    """select event_id, date_trunc('second', ts) twelve_hour, date_trunc('minute', ts) minute_only,
              cast(ts as date) iso_day, cast(ts as date) us_day
       from events""",
)
def _parse_timestamp(spark, sf):
    text = lambda fmt: F.date_format("ts", fmt)
    return V.table(spark, sf, "events").select(
        "event_id",
        parse_logger_timestamp(text("MM/dd/yy hh:mm:ss a")).alias("twelve_hour"),
        parse_logger_timestamp(text("M/d/yyyy H:mm")).alias("minute_only"),
        parse_date(text("yyyy-MM-dd")).alias("iso_day"),
        parse_date(text("M/d/yyyy")).alias("us_day"),
    )


# --- metadata ------------------------------------------------------------------------


@query(
    "metadata_clean",
    """select cast(c_custkey as bigint) customer_key, upper(c_name) point_name, '../' || n.n_name file_path,
              cast(n.n_nationkey as integer) nation_key,
              c.c_mktsegment || ', Pole ' || c.c_name || ', Disturbance ' || n.n_nationkey title
       from customer c join nation n on c.c_nationkey = n.n_nationkey
       where c.c_mktsegment <> 'MACHINERY' and c.c_acctbal >= 0 and not regexp_matches(n.n_name, 'UNITED')""",
)
def _metadata_clean(spark, sf):
    """A sheet with spelled-out missing values, flagged rows and paths to leave out."""
    customers = V.table(spark, sf, "customer")
    nations = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    sheet = customers.join(nations, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("Customer Key"),
        F.col("c_name").alias("Point Name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", " ? ").otherwise(F.col("c_mktsegment")).alias("Segment"),
        F.when(F.col("c_acctbal") < 0, "in debt").otherwise("na").alias("Data Issue"),
        F.concat(F.lit("../"), F.col("n_name")).alias("File Path"),
        F.col("c_nationkey").cast("string").alias("Nation Key"),
    )
    clean = clean_metadata(sheet, {"customer_key": "bigint", "nation_key": "int"})
    kept = exclude_matching(exclude_flagged(require_present(clean, "segment")), "file_path", "UNITED")
    return kept.select(
        "customer_key",
        F.upper("point_name").alias("point_name"),
        "file_path",
        "nation_key",
        trial_title("segment", "point_name", "nation_key").alias("title"),
    )


# --- the full trial pipeline ---------------------------------------------------------


def _study_inputs(spark, sf):
    return V.deployment_sheet(spark, sf), V.file_samples(spark, sf), V.disturbances(spark, sf)


@query(
    "pole_trials",
    f"""select date, point_name, disturbance_number, start_time, end_time, first_date_time, last_date_time,
              {r6('measurement_interval')} measurement_interval, {r6('300 / measurement_interval + 1')} sliding_window_width,
              path_1 lightlogger_file_path_1, path_2 lightlogger_file_path_2,
              name_1 lightlogger_file_name_1, name_2 lightlogger_file_name_2, notes_1, notes_2,
              {r6('light_attenuation_mean')} light_attenuation_mean, problem
       from v_pole_trials""",
)
def _pole_trials(spark, sf):
    deployments, samples, disturbances = _study_inputs(spark, sf)
    trials = pole_trials(
        usable_deployments(deployments),
        samples,
        disturbances,
        V.problem_sheet(spark, sf),
        excluded_dates=EXCLUDED_DAYS,
        zero_light="skip",
    )
    return rounded(trials.drop("lightlogger_file_path_3", "lightlogger_file_name_3", "notes_3"))


def series_sql(samples: str = "v_file_samples", order: str = '"number"', first: str = "") -> str:
    return f"""with {first} p as (
         select t.date, t.point_name, t.disturbance_number, a."number", a.date_time,
                a.temp_f t1, b.temp_f t2, a.intensity_lum_ft2 i1, b.intensity_lum_ft2 i2
         from v_pole_trials t
         join {samples} a on a.file_path = t.path_1
         join {samples} b on b.file_path = t.path_2 and a."number" = b."number" and a.date_time = b.date_time
         where a.date_time >= t.start_time - interval '20' minute and a.date_time < t.end_time + interval '20' minute),
       w as (
         select *, case when count(i1) over f = 2 then avg(i1) over f end r1,
                   case when count(i2) over f = 2 then avg(i2) over f end r2
         from p window f as (partition by date, point_name, disturbance_number order by {order}
                             rows between current row and 1 following)),
       l as (
         select *, 100 * (i1 - i2) / nullif(i1, 0) pct, 100 * (r1 - r2) / nullif(r1, 0) roll_pct from w),
       u as (
         select *, '1' logger_id, t1 temp_f, i1 intensity, r1 rollmean from l union all
         select *, '2' logger_id, t2, i2, r2 from l)
       select date, point_name, disturbance_number, "number", date_time, logger_id,
              {r6('temp_f')} temp_f, {r6('intensity')} intensity_lum_ft2, {r6('rollmean')} intensity_lum_ft2_rollmean,
              {r6('pct')} light_attenuation_pct, {r6('roll_pct')} light_attenuation_rollmean_pct,
              {r6('pct * 100')} attenuation_on_axis, {r6('roll_pct * 100')} attenuation_rollmean_on_axis,
              cast(date as varchar) || ', Pole ' || point_name || ', Disturbance ' || disturbance_number title
       from u"""


# a third of the samples comes twice, with other values
REPEATED = """rep as (select * from v_file_samples union all
       select file_path, date_time, "number", temp_f + 1, intensity_lum_ft2 * 1.5 + 1, is_event from v_file_samples where "number" % 3 = 0)"""


def _repeated_file_samples(samples):
    more = samples.filter(F.col("number") % 3 == 0).withColumns(
        {"temp_f": F.col("temp_f") + 1, "intensity_lum_ft2": F.col("intensity_lum_ft2") * 1.5 + 1}
    )
    return samples.unionByName(more)


@query(
    "pole_trials_repeated",
    f"""with {REPEATED},
       m as (select p.date, p.point_name, t.disturbance_number,
                    avg(100 * (a.intensity_lum_ft2 - b.intensity_lum_ft2) / nullif(a.intensity_lum_ft2, 0)) mean
             from v_pole_days p join v_disturbances t on t.date = p.date
             join rep a on a.file_path = p.path_1
             join rep b on b.file_path = p.path_2 and a."number" = b."number" and a.date_time = b.date_time
             where a.date_time >= t.start_time and a.date_time < t.end_time
             group by 1, 2, 3)
       select date, point_name, disturbance_number, {r6('measurement_interval')} measurement_interval, {r6('mean')} light_attenuation_mean
       from v_pole_trials left join m using (date, point_name, disturbance_number)""",
)
def _pole_trials_repeated(spark, sf):
    """Samples that repeat within a logger: every combination counts, as in a natural join."""
    deployments, samples, disturbances = _study_inputs(spark, sf)
    trials = pole_trials(
        usable_deployments(deployments),
        _repeated_file_samples(samples),
        disturbances,
        V.problem_sheet(spark, sf),
        extents=sample_extents(samples),
        excluded_dates=EXCLUDED_DAYS,
        zero_light="skip",
    )
    return rounded(trials.select("date", "point_name", "disturbance_number", "measurement_interval", "light_attenuation_mean"))


@query(
    "trial_series_repeated",
    series_sql("rep", '"number", i1, i2, t1, t2', REPEATED + ","),
)
def _trial_series_repeated(spark, sf):
    deployments, samples, disturbances = _study_inputs(spark, sf)
    usable = exclude_dates(usable_deployments(deployments), EXCLUDED_DAYS)
    trials = planned_trials(usable, sample_extents(samples), disturbances)
    return rounded(trial_series(trials, _repeated_file_samples(samples), window_width=2, zero_light="skip"))


@query("trial_series", series_sql())
def _trial_series(spark, sf):
    deployments, samples, disturbances = _study_inputs(spark, sf)
    usable = exclude_dates(usable_deployments(deployments), EXCLUDED_DAYS)
    trials = planned_trials(usable, sample_extents(samples), disturbances)
    return rounded(trial_series(trials, samples, window_width=2, zero_light="skip"))


@query(
    "trial_series_own_width",
    f"""with s as (
         select *, floor(intensity_lum_ft2 / 20) light from v_file_samples),
       p as (
         select t.date, t.point_name, t.disturbance_number d, a."number", a.date_time,
                a.temp_f t1, b.temp_f t2, a.light i1, b.light i2
         from v_pole_trials t
         join s a on a.file_path = t.path_1
         join s b on b.file_path = t.path_2 and a."number" = b."number" and a.date_time = b.date_time
         where a.date_time >= t.start_time - interval '20' minute and a.date_time < t.end_time + interval '20' minute),
       w as (
         select *,
                case when d = 1 and count(i1) over two = 2 then avg(i1) over two
                     when d = 2 and count(i1) over three = 3 then avg(i1) over three
                     when d = 3 and count(i1) over four = 4 then avg(i1) over four end r1,
                case when d = 1 and count(i2) over two = 2 then avg(i2) over two
                     when d = 2 and count(i2) over three = 3 then avg(i2) over three
                     when d = 3 and count(i2) over four = 4 then avg(i2) over four end r2
         from p
         window two as (partition by date, point_name, d order by "number" rows between current row and 1 following),
                three as (partition by date, point_name, d order by "number" rows between 1 preceding and 1 following),
                four as (partition by date, point_name, d order by "number" rows between 1 preceding and 2 following)),
       l as (
         select *,
                case when i1 > 0 then 100 * (i1 - i2) / i1 when i2 > 0 then '-infinity'::double end pct,
                case when r1 > 0 then 100 * (r1 - r2) / r1 when r2 > 0 and r1 = 0 then '-infinity'::double end roll_pct from w),
       u as (
         select *, '1' logger_id, t1 temp_f, i1 intensity, r1 rollmean from l union all
         select *, '2' logger_id, t2, i2, r2 from l)
       select date, point_name, d disturbance_number, "number", date_time, logger_id,
              {r6('temp_f')} temp_f, {r6('intensity')} intensity_lum_ft2, {r6('rollmean')} intensity_lum_ft2_rollmean,
              {r6('pct')} light_attenuation_pct, {r6('roll_pct')} light_attenuation_rollmean_pct,
              {r6('pct * 100')} attenuation_on_axis, {r6('roll_pct * 100')} attenuation_rollmean_on_axis,
              cast(date as varchar) || ', Pole ' || point_name || ', Disturbance ' || d title
       from u""",
)
def _trial_series_own_width(spark, sf):
    """Each trial's own window (two to four samples), over light in coarse steps: zero light follows IEEE."""
    deployments, samples, disturbances = _study_inputs(spark, sf)
    usable = exclude_dates(usable_deployments(deployments), EXCLUDED_DAYS)
    trials = planned_trials(usable, sample_extents(samples), disturbances).withColumn(
        "sliding_window_width", rolling_width(300 / F.col("disturbance_number"))
    )
    coarse = samples.withColumn("intensity_lum_ft2", F.floor(F.col("intensity_lum_ft2") / 20).cast("double"))
    return rounded(trial_series(trials, coarse))


@query(
    "rolling_mean",
    f"""select pole_id, slot_ts, {r6('i1')} intensity_1, {r6('i2')} intensity_2,
              {r6('case when count(i1) over f = 4 then avg(i1) over f end')} intensity_rollmean_1,
              {r6('case when count(i2) over f = 4 then avg(i2) over f end')} intensity_rollmean_2
       from (select a.pole_id, a.slot_ts, a.intensity i1, b.intensity i2
             from v_readings a join v_readings b on a.pole_id = b.pole_id and a.slot_ts = b.slot_ts
             where a.logger_number = 1 and b.logger_number = 2) p
       window f as (partition by pole_id order by slot_ts rows between 1 preceding and 2 following)""",
)
def _rolling_mean(spark, sf):
    """A pole's whole series, of any length: cut into blocks."""
    return rounded(
        blocked_rolling_mean(
            V.reading_pairs(spark, sf),
            ["intensity_1", "intensity_2"],
            4,
            by=["pole_id"],
            order=["slot_ts"],
            chunk=F.floor(wall_seconds("slot_ts") / 86400),
            block_rows=64,
            names=["intensity_rollmean_1", "intensity_rollmean_2"],
        )
    )


# nine digits of a number of any size
MANTISSA = "round({0} / power(10.0, floor(log10({0}))), 9) + 0.0"


@query(
    "rolling_mean_wide_range",
    f"""select user_id, event_id, floor(log10(rolled)) exponent, {MANTISSA.format("rolled")} mantissa
       from (select user_id, event_id, nullif(case when count(wide) over f = 4 then avg(wide) over f end, 0) / pi() rolled
             from (select user_id, event_id, abs(value) * power(10.0, (event_id % 5) * 4 - 8) wide from events) e
             window f as (partition by user_id order by event_id rows between 1 preceding and 2 following)) r""",
)
def _rolling_mean_wide_range(spark, sf):
    """Values of widely different size: a large one must leave no trace in the windows after it."""
    events = V.table(spark, sf, "events").select(
        "user_id", "event_id", (F.abs("value") * F.pow(F.lit(10.0), (F.col("event_id") % 5) * 4 - 8)).alias("wide")
    )
    rolled = blocked_rolling_mean(
        events, ["wide"], 4, by=["user_id"], order=["event_id"], chunk=F.floor(F.col("event_id") / 1000), block_rows=64
    )
    # no ties among the digits
    mean = F.nullif("wide_rollmean", F.lit(0.0)) / F.pi()
    exponent = F.floor(F.log10(mean)).cast("double")
    mantissa = F.round(mean / F.pow(F.lit(10.0), exponent), 9) + F.lit(0.0)
    return rolled.select("user_id", "event_id", exponent.alias("exponent"), mantissa.alias("mantissa"))


@query(
    "pivot_poles",
    f"""select pole_id, slot_ts,
              {r6('max(case when logger_number = 1 then intensity end)')} intensity_1,
              {r6('max(case when logger_number = 2 then intensity end)')} intensity_2,
              {r6('max(case when logger_number = 3 then intensity end)')} intensity_3
       from v_readings group by 1, 2""",
)
def _pivot_poles(spark, sf):
    wide = pivot_loggers(
        V.raw_samples(spark, sf), ["pole_id", "slot_ts"], ["intensity"], names_from="logger_number", cell="mean"
    )
    return rounded(wide.drop("n_1", "n_2", "n_3"))


@query(
    "unpivot_series",
    f"""select pole_id, slot_ts, cast(logger_number as varchar) logger_id, {r6('intensity')} intensity from v_readings""",
)
def _unpivot_series(spark, sf):
    return rounded(unpivot_loggers(_pivot_poles(spark, sf).drop("intensity_3"), ["intensity"]).filter("intensity is not null"))


# --- site ----------------------------------------------------------------------------


@query(
    "coordinates",
    f"""select date, disturbance_id, line_id, point_name, point_id, {r6('angle_degrees')} angle_degrees,
              {r6('radians(angle_degrees)')} angle_radians, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y
       from v_coordinates""",
)
def _coordinates(spark, sf):
    coords = coordinates(V.coordinate_sheet(spark, sf))
    return rounded(
        coords.drop("distance_from_disturbance_ft", "reference_coord_x", "reference_coord_y")
    )


@query("border_split", f"select pole_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y from v_split where coord_x <= 300 and coord_y <= 200")
def _border_split(spark, sf):
    return rounded(clip_to_site(split_on_borders(V.pole_places(spark, sf))))


@query(
    "legacy_border_split",
    f"select pole_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y from v_split_legacy where coord_x <= 300 and coord_y <= 200",
)
def _legacy_border_split(spark, sf):
    return rounded(clip_to_site(split_on_borders(V.pole_places(spark, sf), LEGACY_BORDER_WIDTH, LEGACY_BORDER_SHIFT)))


@query(
    "classify_cells",
    f"""select pole_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y, track, zone,
              case track when '1' then 1 when '2' then 2 when '3' then 3 when 'U' then 4 end track_ordinal,
              case zone when 'U' then 1 when 'A' then 2 when 'B' then 3 when 'C' then 4 end zone_ordinal
       from (select pole_id, coord_x, coord_y, {track_of('coord_x')} track, {zone_of('coord_y')} zone from v_split) s""",
)
def _classify_cells(spark, sf):
    placed = C.classify(split_on_borders(V.pole_places(spark, sf)))
    return rounded(
        placed.withColumns({"track_ordinal": track_ordinal(), "zone_ordinal": zone_ordinal()})
    )


@query(
    "disturbance_segments",
    f"""select {r6('coord_x')} coord_x, {r6('coord_y')} coord_y, point_name, date, disturbance_id disturbance_number,
              {track_of('coord_x')} track, {zone_of('coord_y')} zone,
              cast(case coord_x when 0 then 3.5 when 100 then 2.5 when 50 then 2.5 when 150 then 1.5 when 250 then 0.5 end as double) x,
              cast(case coord_x when 0 then 3.5 when 100 then 2.5 when 50 then 3.5 when 150 then 2.5 when 250 then 1.5 end as double) xend,
              cast(case coord_y when 0 then 1.5 when 100 then 3.5 when 25 then 1.5 when 75 then 2.5 when 150 then 3.5 end as double) y,
              cast(case coord_y when 0 then 1.5 when 100 then 3.5 when 25 then 2.5 when 75 then 3.5 when 150 then 4.5 end as double) yend
       from v_coordinates where point_name = 'X' and date >= date '2022-07-01'""",
)
def _disturbance_segments(spark, sf):
    return rounded(disturbance_segments(coordinates(V.coordinate_sheet(spark, sf))))


@query(
    "pole_map",
    f"""select date, disturbance_id, line_id, point_name, point_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y,
              {r6('-coord_x')} map_x
       from v_coordinates""",
)
def _pole_map(spark, sf):
    coords = coordinates(V.coordinate_sheet(spark, sf)).select(
        "date", "disturbance_id", "line_id", "point_name", "point_id", "coord_x", "coord_y"
    )
    return rounded(pole_map(coords))


@query(
    "pole_map_in_order",
    f"""select date, disturbance_id, line_id, point_name, point_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y, {r6('-coord_x')} map_x,
              cast(rank() over (order by date nulls last, disturbance_id nulls last, line_id nulls last) as bigint) "place"
       from v_coordinates""",
)
def _pole_map_in_order(spark, sf):
    """The map's rows with their place in line order: the order itself is compared."""
    coords = coordinates(V.coordinate_sheet(spark, sf)).select(
        "date", "disturbance_id", "line_id", "point_name", "point_id", "coord_x", "coord_y"
    )
    return rounded(ranked(pole_map(coords), ["date", "disturbance_id", "line_id"], "place"))


@query(
    "pole_map_one_date",
    f"""select date, disturbance_id, line_id, point_name, point_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y,
              {r6('-coord_x')} map_x
       from v_coordinates where date = date '2022-07-01'""",
)
def _pole_map_one(spark, sf):
    coords = coordinates(V.coordinate_sheet(spark, sf)).select(
        "date", "disturbance_id", "line_id", "point_name", "point_id", "coord_x", "coord_y"
    )
    return rounded(pole_map(coords, date="2022-07-01"))


@query(
    "pole_map_listed_dates",
    f"""select date, disturbance_id, line_id, point_name, point_id, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y,
              {r6('-coord_x')} map_x
       from v_coordinates where date in (date '2022-06-25', date '2022-07-01', date '2022-07-10')""",
)
def _pole_map_listed(spark, sf):
    coords = coordinates(V.coordinate_sheet(spark, sf)).select(
        "date", "disturbance_id", "line_id", "point_name", "point_id", "coord_x", "coord_y"
    )
    return rounded(pole_map(coords, date=["2022-06-25", "2022-07-01", "2022-07-10"]))


# --- cells and roll-ups --------------------------------------------------------------


def _cells(spark, sf, filtered=False, min_mean=0.0, order_free=False):
    return cell_attenuation(
        V.attenuation_with_problems(spark, sf), _xy(spark, sf), filtered, min_mean, order_free, on=["pole_id"]
    )


def cell_sql(cells: str) -> str:
    return f"""select date, disturbance_number, track, zone, mean_light_attenuation, sd_light_attenuation, n, sum_light_attenuation from {cells}"""


def per_day_sql(cells: str, n: str = "count(*)") -> str:
    return f"""(select date, track, zone, avg(mean_light_attenuation) mean_light_attenuation,
       stddev_samp(sd_light_attenuation) sd_light_attenuation, {n} n, sum(sum_light_attenuation) sum_light_attenuation
       from {cells} group by 1, 2, 3) d"""


def day_mean_sql(cells: str) -> str:
    return f"select date, track, zone, mean_light_attenuation, sd_light_attenuation, n from {per_day_sql(cells)}"


def day_sum_sql(cells: str) -> str:
    return f"""select date, track, zone, mean_light_attenuation, sd_light_attenuation, n, sum_light_attenuation
       from {per_day_sql(cells, 'cast(sum(n) as bigint)')}"""


def experiment_sql(cells: str) -> str:
    return f"""select track, zone, avg(mean_light_attenuation) mean_light_attenuation,
       stddev_samp(sd_light_attenuation) sd_light_attenuation from {per_day_sql(cells)} group by 1, 2"""


MEAN, SD, SUM = "mean_light_attenuation", "sd_light_attenuation", "sum_light_attenuation"


def rounded_sql(inner: str, doubles: tuple[str, ...]) -> str:
    return f"select t.* replace ({', '.join(f'{r6(c)} as {c}' for c in doubles)}) from ({inner}) t"


def heatmap_sql(inner: str, doubles: tuple[str, ...], fill: str, label: str) -> str:
    """Rounding comes last: fill and label are made from full values."""
    return f"""select t.* replace ({', '.join(f'{r6(c)} as {c}' for c in doubles)}), {r6(fill)} fill,
       round_even(cast({label} as double), 0) + 0.0 as label,
       {track_level('track')} - 0.5 xmin, {track_level('track')} + 0.5 xmax,
       {zone_level('zone')} - 0.5 ymin, {zone_level('zone')} + 0.5 ymax
       from ({inner}) t"""


# roll-up -> (Spark, SQL, its doubles, its heatmaps)
ROLLUPS = {
    "cell_stats": (lambda cells: cells, cell_sql, (MEAN, SD, SUM), ("cell_mean", "cell_sum")),
    "day_mean": (C.day_mean, day_mean_sql, (MEAN, SD), ("day_mean",)),
    "day_sum": (C.day_sum, day_sum_sql, (MEAN, SD, SUM), ("day_sum",)),
    "experiment_mean": (C.experiment_mean, experiment_sql, (MEAN, SD), ("experiment_mean",)),
}


def _register_rollups() -> list[str]:
    drawn = []
    for name, (roll, sql, doubles, drawings) in ROLLUPS.items():
        for filtered in (False, True):
            if name == "experiment_mean" and filtered:
                continue
            suffix = "_filtered" if filtered else ""
            inner = sql("v_cells" + suffix)
            query(name + suffix, rounded_sql(inner, doubles))(
                lambda spark, sf, roll=roll, filtered=filtered: rounded(roll(_cells(spark, sf, filtered)))
            )
            if not filtered:
                free = {} if name == "cell_stats" else {"order_free": True}
                query(f"{name}_order_free", rounded_sql(inner, doubles))(
                    lambda spark, sf, roll=roll, free=free: rounded(roll(_cells(spark, sf, order_free=True), **free))
                )
            for drawing in drawings:
                _, fill, label = HEATMAPS[drawing]
                tiles = heatmap_sql(inner, doubles, fill, label)
                query(f"heatmap_{drawing}{suffix}", tiles)(
                    lambda spark, sf, drawing=drawing, filtered=filtered: rounded(
                        heatmaps(_cells(spark, sf, filtered))[drawing]
                    )
                )
                keys = "date, disturbance_number" if name == "cell_stats" else "date, null" if name != "experiment_mean" else "null, null"
                drawn.append(
                    f"select '{drawing}' drawing, {str(filtered).lower()} filtered, {keys}, track, zone, fill, label, xmin, xmax, ymin, ymax from ({tiles})"
                )
    return drawn


@query(
    "heatmaps_all",
    "select * from (select '' drawing, false filtered, cast(null as date) date, cast(null as integer) disturbance_number, '' track, "
    "'' zone, 0.0::double fill, 0.0::double label, 0.0::double xmin, 0.0::double xmax, 0.0::double ymin, 0.0::double ymax where false "
    "union all " + " union all ".join(_register_rollups()) + ") t",
)
def _heatmaps_all(spark, sf):
    """All nine heatmap tables in one job."""
    return rounded(all_heatmaps(V.attenuation_with_problems(spark, sf), _xy(spark, sf), on=["pole_id"]))


@query(
    "cell_stats_all_means",
    f"""select date, disturbance_number, track, zone, {r6('avg(light_attenuation_mean)')} mean_light_attenuation,
              {r6('stddev_samp(light_attenuation_mean)')} sd_light_attenuation, count(*) n,
              {r6('sum(light_attenuation_mean)')} sum_light_attenuation
       from v_gridded group by 1, 2, 3, 4""",
)
def _cells_all_means(spark, sf):
    """Negative cells kept."""
    return rounded(_cells(spark, sf, min_mean=None))


@query(
    "gridded_poles",
    f"""select date, disturbance_number, pole_id, {r6('light_attenuation_mean')} light_attenuation_mean, problem,
              {r6('coord_x')} coord_x, {r6('coord_y')} coord_y, track, zone
       from v_gridded""",
)
def _gridded(spark, sf):
    return rounded(gridded_poles(V.attenuation_with_problems(spark, sf), _xy(spark, sf), on=["pole_id"]))


@query(
    "gridded_poles_listed_twice",
    f"""select distinct date, disturbance_number, pole_id, {r6('light_attenuation_mean')} light_attenuation_mean, problem,
              {r6('coord_x')} coord_x, {r6('coord_y')} coord_y, track, zone
       from v_gridded cross join (values (1), (2)) listed(n)""",
)
def _gridded_twice(spark, sf):
    """A sheet that names every pole twice still gives each placed pole once."""
    listed = bind_rows(_xy(spark, sf), _xy(spark, sf))
    return rounded(gridded_poles(V.attenuation_with_problems(spark, sf), listed, on=["pole_id"]))


@query(
    "bound_sheets",
    f"""select c_custkey point_id, c_name point_name, {r6('c_acctbal')} balance, c_mktsegment segment from customer where c_acctbal >= 0
       union all select s_suppkey, s_name, {r6('s_acctbal')}, null from supplier where s_acctbal >= 0""",
)
def _bound_sheets(spark, sf):
    """Two sheets of unlike columns below each other, without spill columns and rows that lack a number."""
    known = lambda c: F.when(F.col(c) >= 0, F.col(c)).alias("balance")
    customers = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("point_id"), F.col("c_name").alias("point_name"), known("c_acctbal"),
        F.col("c_mktsegment").alias("segment"), F.lit("?").alias("_c4"),
    )
    suppliers = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("point_id"), F.col("s_name").alias("point_name"), known("s_acctbal")
    )
    return rounded(drop_na(drop_prefixed(bind_rows(customers, suppliers), "_c"), "balance"))


@query(
    "arranged_sheets",
    f"""select *, cast(rank() over (order by segment nulls last, balance nulls last, point_id nulls last) as bigint) "place"
       from (select c_custkey point_id, c_name point_name, {r6('case when c_acctbal >= 0 then c_acctbal end')} balance, c_mktsegment segment from customer
             union all
             select s_suppkey, s_name, {r6('case when s_acctbal >= 0 then s_acctbal end')}, null from supplier) t""",
)
def _arranged_sheets(spark, sf):
    """Two sheets below each other with each row's place by segment, balance and point; missing values come last."""
    known = lambda c: F.when(F.col(c) >= 0, F.col(c)).alias("balance")
    customers = V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("point_id"), F.col("c_name").alias("point_name"), known("c_acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("point_id"), F.col("s_name").alias("point_name"), known("s_acctbal")
    )
    return ranked(rounded(bind_rows(customers, suppliers)), ["segment", "balance", "point_id"], "place")


@query(
    "coordinates_by_trial",
    f"""with t as (select date '2022-06-20' + cast(c_nationkey as integer) date, cast(c_nationkey % 3 + 1 as integer) disturbance_number,
                      case when c_mktsegment = 'MACHINERY' then 'X' else substr(c_mktsegment, 1, 1) end point_name,
                      avg(c_acctbal) light
               from customer group by 1, 2, 3)
       select t.date, t.disturbance_number, t.point_name, {r6('light')} light, {r6('coord_x')} coord_x, {r6('coord_y')} coord_y
       from t left join v_coordinates c
         on c.date = t.date and c.disturbance_id = t.disturbance_number and c.point_name = t.point_name""",
)
def _coordinates_by_trial(spark, sf):
    """Places by point, day and disturbance; points with several places give several rows."""
    first = F.substring("c_mktsegment", 1, 1)
    trials = (
        V.table(spark, sf, "customer")
        .groupBy(
            F.date_add(F.lit("2022-06-20").cast("date"), F.col("c_nationkey")).alias("date"),
            (F.col("c_nationkey") % 3 + 1).cast("int").alias("disturbance_number"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "X").otherwise(first).alias("point_name"),
        )
        .agg(F.avg("c_acctbal").alias("light"))
    )
    return rounded(join_coordinates(trials, coordinates(V.coordinate_sheet(spark, sf))))


@query(
    "grid_tiles",
    f"""select g.track, g.zone, xmin, xmax, ymin, ymax, e.mean_light_attenuation, e.sd_light_attenuation
        from (select track, zone, {track_level('track')} - 0.5 xmin, {track_level('track')} + 0.5 xmax,
                     {zone_level('zone')} - 0.5 ymin, {zone_level('zone')} + 0.5 ymax
              from (values ('1'), ('2'), ('3')) t(track) cross join (values ('A'), ('B'), ('C')) z(zone)) g
        left join ({rounded_sql(experiment_sql("v_cells"), (MEAN, SD))}) e on e.track = g.track and e.zone = g.zone""",
)
def _grid_tiles(spark, sf):
    return grid_with(QUERIES["experiment_mean"](spark, sf))


@query(
    "points_in_cells",
    f"""select i x, j y, count(p.pole_id) cnt
       from (values (1, 0, 100), (2, 100, 200), (3, 200, 300)) xs(i, x0, x1)
       cross join (values (1, 0, 50), (2, 50, 100), (3, 100, 200)) ys(j, y0, y1)
       left join v_xy p
         on p.coord_x between x0 and x1 and p.coord_y between y0 and y1
       group by 1, 2""",
)
def _points_in_cells(spark, sf):
    return C.points_in_cells(V.pole_places(spark, sf))


@query(
    "count_by_snapped",
    f"""select round_even(coord_x / 100, 0) * 100 + 0.0 as coord_x, round_even(coord_y / 100, 0) * 100 + 0.0 as coord_y, count(*) n
       from v_xy group by 1, 2""",
)
def _count_by_snapped(spark, sf):
    return C.count_by_snapped(V.pole_places(spark, sf))


@query(
    "replicate_mean",
    f"""select a.pole_id, a.date, {r6('a.light_attenuation_mean')} light_attenuation_mean, {r6('c.coord_x')} coord_x, {r6('c.coord_y')} coord_y
       from (select pole_id, date, avg(light_attenuation_mean) light_attenuation_mean from v_att group by 1, 2) a
       left join v_xy c on a.pole_id = c.pole_id""",
)
def _replicate_mean(spark, sf):
    means = C.replicate_mean(V.attenuation(spark, sf), ["pole_id", "date"])
    return rounded(means.join(_xy(spark, sf), "pole_id", "left"))


@query(
    "global_range",
    f"""select {r6('min(light_attenuation_mean)')} min_attenuation, {r6('max(light_attenuation_mean)')} max_attenuation from v_att""",
)
def _global_range(spark, sf):
    return rounded(C.global_range(V.attenuation(spark, sf)))


@query(
    "unique_dates",
    """select date, cast(row_number() over (order by date) as integer) date_rank
       from (select distinct date from v_att) d""",
)
def _unique_dates(spark, sf):
    return unique_dates(V.attenuation(spark, sf))


@query(
    "dates_by_appearance",
    """select date, cast(row_number() over (order by place) as integer) date_rank
       from (select l_shipdate date, min(place) place from (select l_shipdate, row_number() over () place from lineitem) l
             where l_shipdate is not null group by 1) d""",
)
def _dates_by_appearance(spark, sf):
    """The nth date as it turns up in the rows of the table, not in the calendar."""
    placed = input_order(V.table(spark, sf, "lineitem")).withColumnRenamed("l_shipdate", "date")
    return unique_dates(placed, "date", ["input_file", "input_row"])


# --- contract ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Attenuation per track and zone over the whole experiment."""
    return QUERIES["experiment_mean"](spark, "/root/testdata/sf0.001")


# the text operators and the pipeline are a separate part that may be absent
try:
    import corpus_pipeline
    from turbilux.llm.queries import ORACLES as LLM_ORACLES
    from turbilux.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("turbilux.llm", "turbilux.llm.queries", "corpus_pipeline"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Query]:
    return {**QUERIES, **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **LLM_ORACLES}
