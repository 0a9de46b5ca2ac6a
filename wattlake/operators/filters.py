"""Filters and predicates (D1-D9); all plain ``where`` so Catalyst pushes them down."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

SENTINEL_VALUE = -99999.0


def sensor_quality(df: DataFrame) -> DataFrame:
    """Keep rows whose date and value parsed."""
    return df.where(F.col("date").isNotNull() & F.col("value_acquired").isNotNull())


def month_guard(df: DataFrame, date_col: str = "date", folder_month: str = "folder_month") -> DataFrame:
    """A row must belong to the month folder it was read from."""
    return df.where(F.month(date_col) == F.col(folder_month).try_cast("int"))


def sentinel_drop(df: DataFrame, col: str = "value", sentinel: float = SENTINEL_VALUE) -> DataFrame:
    """D3: drop the missing-data sentinel; NULL values are kept (null-safe compare)."""
    return df.where(~F.col(col).eqNullSafe(F.lit(sentinel)))


def as_date(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def month_bounds(start, end) -> tuple[dt.date, dt.date]:
    """First day of the month of ``start`` and last day of the month of ``end``."""
    a, b = as_date(start), as_date(end)
    return a.replace(day=1), b.replace(day=calendar.monthrange(b.year, b.month)[1])


def date_range(df: DataFrame, start, end, col: str = "date") -> DataFrame:
    """Rows of a date range, inclusive."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def slicer(df: DataFrame, dates: tuple | None = None, months: list[int] | None = None, weeks: list[int] | None = None,
           times: tuple | None = None, date_col: str = "date", time_col: str = "start_time", **equals) -> DataFrame:
    """Dashboard slicers; each further keyword is ``column=value`` or ``column=[values]``.

    ``dates`` and ``times`` are inclusive (from, to) ranges (dates; ``HH:MM``), ``months`` and ``weeks`` lists of
    calendar months and ISO weeks.
    """
    if dates:
        df = date_range(df, *dates, col=date_col)
    if months:
        df = df.where(F.month(date_col).isin(*months))
    if weeks:
        df = df.where(F.weekofyear(date_col).isin(*weeks))
    if times:
        df = df.where(F.substring(tx.normalize_time(time_col, bare_hour=True), 1, 5).between(*times))
    for c, v in equals.items():
        df = df.where(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == F.lit(v))
    return df


def drop_placeholders(df: DataFrame, *cols: str) -> DataFrame:
    """Leave out ``EMPTY`` placeholders before summarising."""
    for c in cols:
        df = df.where(F.col(c) != tx.PLACEHOLDER)
    return df


# Which marts each role may open (the user guide's table, Q25).
ROLE_MARTS = {
    "director": {"energy", "rooms", "weather", "inverters"},
    "technician": {"energy", "inverters"},
}


def secure_view(df: DataFrame, mart: str, role: str, school: str | None = None,
                school_col: str = "department", role_marts: dict = ROLE_MARTS) -> DataFrame:
    """row/table security. Unknown role or mart outside the whitelist -> no rows.

    A director with a ``school`` only sees that school's rows where the mart
    has a school column.
    """
    allowed = mart in role_marts.get(role.lower(), set())
    out = df.where(F.lit(allowed))
    if role.lower() == "director" and school is not None and school_col in df.columns:
        out = out.where(F.col(school_col) == F.lit(school))
    return out
