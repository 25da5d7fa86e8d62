"""Calendar helpers: month names, month arithmetic, epoch seconds."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_lit(d: _dt.date | str | Column | None) -> Column:
    """A date Column; ``None`` is today (``current_date()``)."""
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d))


# The cube's calendar keys of a date, as SQL text over ``{d}``.
DATE_PARTS_SQL = {
    "sale_month": "date_format({d}, 'MMMM')",
    "num_month": "month({d})",
    "sale_year": "year({d})",
}


def month_name(d: Column | str) -> Column:
    """Full English month name ("January")."""
    return F.date_format(_col(d), "MMMM")


def date_parts(d: Column | str) -> dict[str, Column]:
    """The cube's calendar keys of a date column."""
    d = _col(d)
    return {"sale_month": month_name(d), "num_month": F.month(d), "sale_year": F.year(d)}


def months_back(as_of: Column, k: int) -> Column:
    """``as_of - interval k months``; the day clamps to the month's end."""
    return F.add_months(as_of, -k)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp (session time zone)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def epoch_to_date(seconds: Column | str) -> Column:
    """Epoch seconds -> timestamp -> midnight, as a date."""
    return F.to_date(F.timestamp_seconds(_col(seconds)))


def ts_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")
