"""Synthetic logger exports in the three layouts in use."""

from __future__ import annotations

import datetime as dt

LAYOUTS = ("quoted", "minutes", "twelve_hour")


def clock(t: dt.datetime, layout: str) -> str:
    if layout == "minutes":
        return f"{t.month}/{t.day}/{t.year} {t.hour}:{t.minute:02d}"
    hour = t.strftime("%I") if layout == "quoted" else str(int(t.strftime("%I")))
    return t.strftime("%m/%d/%y ") + hour + t.strftime(":%M:%S %p")


def write_logger_file(path, sn: str, rows, layout: str, swap: bool = False) -> None:
    """``rows``: (number, time, temp, light, event) with event None or an event column's name."""
    events = ["Button Down", "Button Up", "Host Connected", "End Of File"] if layout == "quoted" else ["Stopped", "End Of File"]
    q = '"' if layout == "quoted" else ""
    end = "\r\n" if layout == "quoted" else "\n"
    offset = "-05:00" if layout == "quoted" else "-06:00"
    sensors = [f'"Temp, °F (LGR S/N: {sn}, SEN S/N: {sn})"', f'"Intensity, lum/ft² (LGR S/N: {sn}, SEN S/N: {sn})"']
    header = [f"{q}#{q}", f'"Date Time, GMT{offset}"', *(reversed(sensors) if swap else sensors)]
    header += [f"{q}{e} (LGR S/N: {sn}){q}" for e in events]
    title = f'﻿"Plot Title: {sn}"' if layout == "quoted" else f"Plot Title: {sn},,,,,"
    lines = [title, ",".join(header)]
    for number, time, temp, light, event in rows:
        cells = ["" if temp is None else str(temp), "" if light is None else str(light)]
        marks = ["Logged" if e == event else "" for e in events]
        lines.append(",".join([str(number), clock(time, layout), *(reversed(cells) if swap else cells), *marks]))
    # the last line has no line end, as in the exports
    path.write_bytes(end.join(lines).encode("utf-8"))
