"""Run dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SCHEDULE_PRESETS
from .text import ts_nodash


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def start_date(col: Column | str, as_of: Column | str) -> Column:
    """``YYYYMMDD`` (string or integer) → date; missing or blank → two
    days before ``as_of`` (passed in, so results repeat); anything else fails."""
    text = F.nullif(F.trim(_c(col).cast("string")), F.lit(""))
    given = F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    wrong = F.raise_error(F.concat(F.lit("not a date of the form YYYYMMDD: "), text)).cast("date")
    return F.when(text.isNull(), F.date_sub(_c(as_of).cast("date"), 2)).when(given.isNull(), wrong).otherwise(given)


def run_macros(df: DataFrame, ts_col: str, prev_col: str | None = None) -> DataFrame:
    """``ds`` (yyyy-MM-dd), ``ts_nodash`` and, given the previous run's
    time (see ``previous_run``), ``prev_ds``."""
    out = df.withColumn("ds", F.date_format(ts_col, "yyyy-MM-dd")).withColumn("ts_nodash", ts_nodash(ts_col))
    if prev_col is not None:
        out = out.withColumn("prev_ds", F.date_format(prev_col, "yyyy-MM-dd"))
    return out


def _ceil_tick(start: Column, preset: str) -> Column:
    if preset == "@hourly":
        floor = F.date_trunc("hour", start)
        step = F.expr("INTERVAL 1 HOUR")
    elif preset == "@daily":
        floor = F.date_trunc("day", start)
        step = F.expr("INTERVAL 1 DAY")
    elif preset == "@weekly":
        # Weekly runs fall on Sunday midnight; date_trunc('week') gives Monday.
        floor = F.date_trunc("week", start + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY")
        step = F.expr("INTERVAL 7 DAYS")
    elif preset == "@monthly":
        floor = F.date_trunc("month", start)
        step = F.expr("INTERVAL 1 MONTH")
    else:
        raise ValueError(f"unsupported schedule preset {preset!r}; supported: {sorted(SCHEDULE_PRESETS)}")
    return F.when(floor < start, floor + step).otherwise(floor), step


def run_calendar(df: DataFrame, start_col: str, preset: str | Column | None, as_of: Column | str, out: str = "run_ts") -> DataFrame:
    """one row per scheduled run between the start and ``as_of``.

    ``preset`` is one name for all rows or a column (null: not scheduled, no
    runs; an unknown name fails).  Runs start on the first tick at or after
    the start; a run is listed once its interval has ended (tick + step ≤
    as_of).  Rows are generated per input row with ``sequence``, no grouping.
    """
    start, end = _c(start_col).cast("timestamp"), _c(as_of).cast("timestamp")
    none = F.array().cast("array<timestamp>")

    def ticks(name: str) -> Column:
        first, step = _ceil_tick(start, name)
        last = end - step
        return F.when(first <= last, F.sequence(first, last, step)).otherwise(none)

    if preset is None:
        runs = none
    elif isinstance(preset, Column):
        runs = F.when(preset.isNull(), none)
        for name in SCHEDULE_PRESETS:
            runs = runs.when(preset == name, ticks(name))
        runs = runs.otherwise(F.raise_error(F.concat(F.lit("unsupported schedule preset "), preset)).cast("array<timestamp>"))
    else:
        runs = ticks(preset)
    return df.withColumn(out, F.explode(runs))
