"""Column helpers for the source dialect's scalar semantics.

All helpers return built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_nullable(*parts: Column | str) -> Column:
    """String concatenation where NULL acts as the empty string.

    Spark's ``concat`` and ``||`` return NULL if any input is NULL, and
    ``concat_ws`` drops the separator as well, so each part is coalesced.
    """
    return F.concat(*[F.coalesce(_col(p), F.lit("")) for p in parts])


def customer_name(first: Column | str, last: Column | str) -> Column:
    """``FIRST_NAME || ' ' || LAST_NAME`` with NULL names as empty strings."""
    return concat_nullable(first, F.lit(" "), last)


def plus_days(ts: Column | str, days: Column | int) -> Column:
    """``date + n`` of the source dialect: add whole days, keep the time of day (C4)."""
    n = F.lit(days) if isinstance(days, int) else days
    return _col(ts) + F.make_dt_interval(n.cast("int"))


def trunc_day(ts: Column | str) -> Column:
    """Cut a timestamp to midnight, keeping the ``timestamp_ntz`` type."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def add_months_keep_time(ts: Column | str, months: int) -> Column:
    """Month arithmetic of the source dialect on a column.

    A day at month end maps to the month end of the target month, a day past the
    target's month end is clamped to it, and the time of day is kept. Spark's
    ``add_months`` returns a date and does not map month end to month end, so the
    month-end case and the time are put back by hand.
    """
    c = _col(ts)
    day = F.to_date(c)
    shifted = F.add_months(day, months)
    target = F.when(day == F.last_day(day), F.last_day(shifted)).otherwise(shifted)
    time_of_day = c - day.cast("timestamp_ntz")
    return target.cast("timestamp_ntz") + time_of_day


def add_months_value(ts: dt.datetime, months: int) -> dt.datetime:
    """The same rule for one driver-side value, e.g. the 12-month cutoff of a run's ``as_of``."""
    total = ts.year * 12 + (ts.month - 1) + months
    year, month = divmod(total, 12)
    month += 1
    last_src = calendar.monthrange(ts.year, ts.month)[1]
    last_dst = calendar.monthrange(year, month)[1]
    day = last_dst if ts.day == last_src else min(ts.day, last_dst)
    return ts.replace(year=year, month=month, day=day)


def months_cutoff(as_of: dt.datetime, months: int = 12) -> dt.datetime:
    """``ADD_MONTHS(SYSDATE, -12)`` for a run: computed once per run."""
    return add_months_value(as_of, -months)


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def item_discount(adjustment: Column | str, quantity: Column | str, list_price: Column | str) -> Column:
    """Unit discount (P4): 0 when the adjustment equals the full line price, else the adjustment.

    Any NULL in the test makes it unknown, which falls to the ELSE branch.
    """
    adj = _col(adjustment)
    full = _col(quantity) * _col(list_price)
    return F.when(adj == full, F.lit(0)).otherwise(adj).cast("decimal(19,2)")
