"""The fixture views as SQL: ``with_views`` puts those a statement names into its WITH clause."""

from __future__ import annotations

import re


def r6(expr: str) -> str:
    """Six places, and no negative zero."""
    return f"(case when abs({expr}) < 0.0000005 then 0.0 else round({expr}, 6) end)"


def track_of(x: str) -> str:
    return f"case when {x} < 0 then 'U' when {x} < 100 then '3' when {x} < 200 then '2' when {x} <= 300 then '1' end"


def zone_of(y: str) -> str:
    return f"case when {y} < 0 then 'U' when {y} < 50 then 'A' when {y} < 100 then 'B' when {y} <= 200 then 'C' end"


def track_level(track: str) -> str:
    return f"cast(case {track} when '1' then 1 when '2' then 2 when '3' then 3 when 'U' then 4 end as double)"


def zone_level(zone: str) -> str:
    return f"cast(case {zone} when 'U' then 1 when 'A' then 2 when 'B' then 3 when 'C' then 4 end as double)"


def near(v: str, borders: tuple[float, ...], fudge: float) -> str:
    return "(" + " or ".join(f"({v} > {b} - {fudge} and {v} < {b} + {fudge})" for b in borders) + ")"


VIEWS: dict[str, str] = {
    "v_readings": """
select cast(floor(user_id / 2) as bigint) pole_id, cast(user_id % 2 as int) + 1 logger_number,
       date_trunc('hour', ts) slot_ts, avg(value) intensity
from events group by 1, 2, 3""",
    "v_disturbances": """
select cast(d as date) date, n disturbance_number,
       d + interval '1' hour * ((n - 1) * 8 + 1) start_time,
       d + interval '1' hour * ((n - 1) * 8 + 7) end_time
from (select distinct date_trunc('day', ts) d from events) days
cross join (select 1 n union all select 2 union all select 3) nums""",
    "v_poles": """
select c_custkey pole_id,
       case when c_custkey % 3 = 0 then null else cast((c_custkey * 7) % 340 - 20 as double) end coord_x,
       case when c_custkey % 5 = 0 then null else cast((c_custkey * 10) % 230 - 20 as double) end coord_y,
       cast((c_custkey * 15) % 360 as double) angle_degrees,
       cast(20 + (c_custkey * 5) % 150 as double) distance_from_disturbance_ft,
       cast(50 * (c_custkey % 6) as double) reference_coord_x,
       cast(25 * (c_custkey % 6) as double) reference_coord_y,
       c_nationkey, c_mktsegment
from customer""",
    "v_problem": "select s_suppkey pole_id, 'flagged' problem from supplier where s_acctbal < 1000",
    "v_xy": """
select pole_id,
       case when coord_x is null then reference_coord_x - distance_from_disturbance_ft * cos(radians(angle_degrees)) else coord_x end coord_x,
       case when coord_y is null or coord_x is null then reference_coord_y + distance_from_disturbance_ft * sin(radians(angle_degrees)) else coord_y end coord_y
from v_poles""",
    "v_att": """
select d.date, d.disturbance_number, a.pole_id,
       avg(100 * (a.intensity - b.intensity) / nullif(a.intensity, 0)) light_attenuation_mean
from v_readings a
join v_readings b on a.pole_id = b.pole_id and a.slot_ts = b.slot_ts
join v_disturbances d on a.slot_ts >= d.start_time and a.slot_ts < d.end_time
where a.logger_number = 1 and b.logger_number = 2
group by 1, 2, 3""",
    "v_legacy_pairs": """
select pole_id, start_time, max(case when logger_number = 1 then m end) i1, max(case when logger_number = 2 then m end) i2
from (select r.pole_id, d.start_time, r.logger_number, avg(r.intensity) m
      from v_readings r join v_disturbances d on r.slot_ts >= d.start_time and r.slot_ts < d.end_time
      group by 1, 2, 3) s
group by 1, 2""",
    "v_coordinates": """
select date '2022-06-20' + cast(p.c_nationkey as integer) date, cast(p.c_nationkey % 3 + 1 as integer) disturbance_id,
       cast(p.c_nationkey as integer) line_id,
       case when p.c_mktsegment = 'MACHINERY' then 'X' else substr(p.c_mktsegment, 1, 1) end point_name,
       p.pole_id point_id, p.angle_degrees, x.coord_x, x.coord_y
from v_poles p join v_xy x on p.pole_id = x.pole_id""",
    "v_split_x": f"""
select pole_id, coord_x + s coord_x, coord_y
from (select *, {near('coord_x', (0, 100, 200, 300), 3.5)} near_border from v_xy) v
join (values (-3.5, true), (3.5, true), (0.0, false)) k(s, for_border) on near_border = for_border""",
    "v_split": f"""
select pole_id, coord_x, coord_y + s coord_y
from (select *, {near('coord_y', (0, 50, 100, 200), 3.5)} near_border from v_split_x) v
join (values (-3.5, true), (3.5, true), (0.0, false)) k(s, for_border) on near_border = for_border""",
    "v_split_legacy_x": f"""
select pole_id, coord_x + s coord_x, coord_y
from (select *, {near('coord_x', (0, 100, 200, 300), 1)} near_border from v_xy) v
join (values (-2.0, true), (2.0, true), (0.0, false)) k(s, for_border) on near_border = for_border""",
    "v_split_legacy": f"""
select pole_id, coord_x, coord_y + s coord_y
from (select *, {near('coord_y', (0, 50, 100, 200), 1)} near_border from v_split_legacy_x) v
join (values (-2.0, true), (2.0, true), (0.0, false)) k(s, for_border) on near_border = for_border""",
    "v_gridded": f"""
select a.date, a.disturbance_number, a.pole_id, a.light_attenuation_mean, p.problem, s.coord_x, s.coord_y,
       {track_of('s.coord_x')} track, {zone_of('s.coord_y')} zone
from v_att a
left join v_problem p on p.pole_id = a.pole_id
join v_split s on s.pole_id = a.pole_id
where s.coord_x <= 300 and s.coord_y <= 200 and a.light_attenuation_mean is not null""",
    "v_cells": """
select date, disturbance_number, track, zone, avg(light_attenuation_mean) mean_light_attenuation,
       stddev_samp(light_attenuation_mean) sd_light_attenuation, count(*) n, sum(light_attenuation_mean) sum_light_attenuation
from v_gridded group by 1, 2, 3, 4 having avg(light_attenuation_mean) >= 0""",
    "v_cells_filtered": """
select date, disturbance_number, track, zone, avg(light_attenuation_mean) mean_light_attenuation,
       stddev_samp(light_attenuation_mean) sd_light_attenuation, count(*) n, sum(light_attenuation_mean) sum_light_attenuation
from v_gridded where problem is null group by 1, 2, 3, 4 having avg(light_attenuation_mean) >= 0""",
    "v_file_samples": """
select '../logs/' || user_id || '/' || cast(ts as date) || '.csv' file_path, date_trunc('hour', ts) date_time,
       cast(hour(date_trunc('hour', ts)) + 1 as integer) "number",
       min(value) temp_f, avg(value) intensity_lum_ft2, bool_and(event_type = 'error') is_event
from events group by 1, 2, 3""",
    "v_deployments": """
select cast(ts as date) date, cast(cast(floor(user_id / 2) as bigint) as varchar) point_name,
       cast(user_id % 2 as int) + 1 logger_number, '../logs/' || user_id || '/' || cast(ts as date) || '.csv' path,
       user_id || '.csv' as name, count(value) || ' events' as notes
from events
where not regexp_matches(cast(cast(ts as date) as varchar), '2024-01-2[0-3]')
group by 1, 2, 3, 4, 5 having max(value) <= 150""",
    "v_file_extents": """
select file_path, min(date_time) first_date_time, max(date_time) last_date_time,
       (epoch_us(max(date_time)) - epoch_us(min(date_time))) / 1e6 / nullif(count(*) - 1, 0) measurement_interval
from (select *, row_number() over (partition by file_path order by "number" desc) rn from v_file_samples
      where not is_event) s
where rn > 1 group by 1""",
    "v_pole_days": """
select d.date, d.point_name,
       case when count(*) = count(e.first_date_time) then max(e.first_date_time) end first_date_time,
       case when count(*) = count(e.last_date_time) then min(e.last_date_time) end last_date_time,
       case when count(*) = count(e.measurement_interval) then min(e.measurement_interval) end measurement_interval,
       max(case when logger_number = 1 then path end) path_1, max(case when logger_number = 2 then path end) path_2,
       max(case when logger_number = 1 then name end) name_1, max(case when logger_number = 2 then name end) name_2,
       max(case when logger_number = 1 then notes end) notes_1, max(case when logger_number = 2 then notes end) notes_2
from v_deployments d left join v_file_extents e on e.file_path = d.path
group by 1, 2""",
    "v_trial_means": """
select p.date, p.point_name, t.disturbance_number,
       avg(100 * (a.intensity_lum_ft2 - b.intensity_lum_ft2) / nullif(a.intensity_lum_ft2, 0)) light_attenuation_mean
from v_pole_days p
join v_disturbances t on t.date = p.date
join v_file_samples a on a.file_path = p.path_1
join v_file_samples b on b.file_path = p.path_2 and a."number" = b."number" and a.date_time = b.date_time
where a.date_time >= t.start_time and a.date_time < t.end_time
group by 1, 2, 3""",
    "v_problem_sheet": """
select date '2024-01-01' + cast(s_nationkey as integer) date, cast(s_suppkey as varchar) pole_id,
       cast(s_nationkey % 3 + 1 as integer) disturbance, 'flagged' problem
from supplier where s_acctbal < 1000""",
    "v_pole_trials": """
select p.*, t.disturbance_number, t.start_time, t.end_time, m.light_attenuation_mean, q.problem
from v_pole_days p
left join v_disturbances t on t.date = p.date
left join v_trial_means m on m.date = p.date and m.point_name = p.point_name and m.disturbance_number = t.disturbance_number
left join v_problem_sheet q on q.date = p.date and q.pole_id = p.point_name and q.disturbance = t.disturbance_number""",
}


def with_views(sql: str) -> str:
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(body)
                needed.append(name)

    need(sql)
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in needed)
    own = sql.strip()
    # a statement with its own WITH clause gets one longer clause
    return f"with {views},\n{own[5:]}" if own.lower().startswith("with ") else f"with {views}\n{own}"
