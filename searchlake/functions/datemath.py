"""Date math: ``NOW/DAY+1MONTH-3DAYS`` style expressions.

Two forms:

* ``resolve(expr, now, tz)`` folds an expression to a Python ``datetime`` on the driver.
  Used for filter bounds and range-facet edges (scalars only).
* ``date_math(col, ops, tz)`` applies the same operations to a timestamp Column, JVM-side.

Operations run left to right; ``/UNIT`` rounds down, ``+N UNIT`` / ``-N UNIT`` add calendar
units (month/year additions clip the day to the month end, as a calendar does). Rounding and
adding happen on the wall clock of ``tz``.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names accepted by the date-math grammar (singular, plural, aliases).
UNITS = {
    "YEAR": "YEAR", "YEARS": "YEAR",
    "MONTH": "MONTH", "MONTHS": "MONTH",
    "DAY": "DAY", "DAYS": "DAY", "DATE": "DAY",
    "HOUR": "HOUR", "HOURS": "HOUR",
    "MINUTE": "MINUTE", "MINUTES": "MINUTE",
    "SECOND": "SECOND", "SECONDS": "SECOND",
    "MILLI": "MILLISECOND", "MILLIS": "MILLISECOND",
    "MILLISECOND": "MILLISECOND", "MILLISECONDS": "MILLISECOND",
}

_TOKEN = re.compile(r"\s*([/+-])\s*(\d+)?\s*([A-Za-z]+)")


def parse_ops(expr: str) -> list[tuple[str, int, str]]:
    """``"/DAY+6MONTHS+3DAYS"`` → ``[('/',0,'DAY'), ('+',6,'MONTH'), ('+',3,'DAY')]``."""
    ops = []
    pos = 0
    expr = expr.strip()
    while pos < len(expr):
        m = _TOKEN.match(expr, pos)
        if not m:
            raise ValueError(f"bad date math at {pos}: {expr!r}")
        op, num, unit = m.group(1), m.group(2), m.group(3).upper()
        if unit not in UNITS:
            raise ValueError(f"unknown date math unit {unit!r}")
        if op == "/":
            if num is not None:
                raise ValueError("rounding takes no number")
            ops.append(("/", 0, UNITS[unit]))
        else:
            if num is None:
                raise ValueError("add/subtract needs a number")
            ops.append((op, int(num), UNITS[unit]))
        pos = m.end()
    return ops


def _add_months(t: dt.datetime, n: int) -> dt.datetime:
    y, m = divmod(t.month - 1 + n, 12)
    year, month = t.year + y, m + 1
    day = min(t.day, calendar.monthrange(year, month)[1])
    return t.replace(year=year, month=month, day=day)


def _apply_py(t: dt.datetime, op: str, n: int, unit: str) -> dt.datetime:
    if op == "/":
        if unit == "YEAR":
            return t.replace(month=1, day=1, hour=0, minute=0, second=0, microsecond=0)
        if unit == "MONTH":
            return t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
        if unit == "DAY":
            return t.replace(hour=0, minute=0, second=0, microsecond=0)
        if unit == "HOUR":
            return t.replace(minute=0, second=0, microsecond=0)
        if unit == "MINUTE":
            return t.replace(second=0, microsecond=0)
        if unit == "SECOND":
            return t.replace(microsecond=0)
        return t.replace(microsecond=(t.microsecond // 1000) * 1000)
    k = n if op == "+" else -n
    if unit == "YEAR":
        return _add_months(t, 12 * k)
    if unit == "MONTH":
        return _add_months(t, k)
    delta = {"DAY": dt.timedelta(days=k), "HOUR": dt.timedelta(hours=k),
             "MINUTE": dt.timedelta(minutes=k), "SECOND": dt.timedelta(seconds=k),
             "MILLISECOND": dt.timedelta(milliseconds=k)}[unit]
    if unit == "DAY":
        return t + delta  # wall-clock day step (DST-aware when t is local wall time)
    return t + delta


def resolve(expr, now: dt.datetime | None = None, tz: str = "UTC") -> dt.datetime:
    """Fold ``"NOW/DAY-7DAYS"``, ``"1995-01-01T00:00:00Z+1MONTH"`` or a datetime to a naive UTC datetime."""
    if isinstance(expr, dt.datetime):
        return expr
    if isinstance(expr, dt.date):
        return dt.datetime(expr.year, expr.month, expr.day)
    s = str(expr).strip()
    if s.upper().startswith("NOW"):
        base = now or dt.datetime.utcnow()
        rest = s[3:]
    else:
        m = re.match(r"(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?)?)Z?", s)
        if not m:
            raise ValueError(f"not a date: {expr!r}")
        base = dt.datetime.fromisoformat(m.group(1).replace(" ", "T"))
        rest = s[m.end():]
    ops = parse_ops(rest) if rest else []
    if not ops:
        return base
    zone = ZoneInfo(tz)
    local = base.replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None)
    for op, n, unit in ops:
        if unit in ("HOUR", "MINUTE", "SECOND", "MILLISECOND") and op != "/":
            # absolute durations: step on the UTC line
            utc = local.replace(tzinfo=zone).astimezone(dt.timezone.utc)
            utc = _apply_py(utc.replace(tzinfo=None), op, n, unit)
            local = utc.replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None)
        else:
            local = _apply_py(local, op, n, unit)
    return local.replace(tzinfo=zone).astimezone(dt.timezone.utc).replace(tzinfo=None)


def add_gap(t: dt.datetime, gap: str, tz: str = "UTC") -> dt.datetime:
    """Apply a gap such as ``"+1MONTH"`` to a driver-side datetime."""
    return _apply_ops(t, parse_ops(gap), tz)


def _apply_ops(t: dt.datetime, ops, tz: str) -> dt.datetime:
    zone = ZoneInfo(tz)
    local = t.replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None)
    for op, n, unit in ops:
        local = _apply_py(local, op, n, unit)
    return local.replace(tzinfo=zone).astimezone(dt.timezone.utc).replace(tzinfo=None)


# ---------------------------------------------------------------- Column form

_TRUNC = {"YEAR": "YEAR", "MONTH": "MONTH", "DAY": "DAY", "HOUR": "HOUR",
          "MINUTE": "MINUTE", "SECOND": "SECOND", "MILLISECOND": "MILLISECOND"}


def date_math(c, ops: str, tz: str = "UTC") -> Column:
    """Apply ``/UNIT`` and ``±N UNIT`` operations to a timestamp Column.

    Works on the wall clock of ``tz`` (``from_utc_timestamp`` … ``to_utc_timestamp``),
    so day rounding honours DST. All steps are built-in expressions (codegen).
    """
    x = F.col(c) if isinstance(c, str) else c
    if tz != "UTC":
        x = F.from_utc_timestamp(x, tz)
    for op, n, unit in parse_ops(ops):
        if op == "/":
            x = F.date_trunc(_TRUNC[unit], x)
        else:
            k = n if op == "+" else -n
            unit_sql = "MILLISECOND" if unit == "MILLISECOND" else unit
            x = F.timestamp_add(unit_sql, F.lit(k), x)
    if tz != "UTC":
        x = F.to_utc_timestamp(x, tz)
    return x


def round_to(c, resolution: str) -> Column:
    """Round a timestamp down to a resolution, ``year`` … ``millisecond``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.date_trunc(_TRUNC[UNITS[resolution.upper()]], x)


def to_sortable_string(c, resolution: str = "MILLISECOND") -> Column:
    """Date → ``yyyyMMddHHmmssSSS`` string cut at ``resolution`` (sorts like the date)."""
    x = round_to(c, resolution)
    width = {"YEAR": 4, "MONTH": 6, "DAY": 8, "HOUR": 10, "MINUTE": 12, "SECOND": 14,
             "MILLISECOND": 17}[UNITS[resolution.upper()]]
    return F.substring(F.date_format(x, "yyyyMMddHHmmssSSS"), 1, width)
