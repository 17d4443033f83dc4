"""Column expressions: all built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The local clock is UTC + 5:30 (330 minutes), a fixed offset with no DST.
LOCAL_OFFSET_MINUTES = 330
MONEY = "decimal(18,2)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def minutes(n: int) -> Column:
    """A day-time interval of ``n`` minutes (``INTERVAL '330 minutes'``)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n), F.lit(0))


def local_time(ts: ColumnOrName, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    """``ts + interval '330 minutes'`` on a zone-less timestamp."""
    return _col(ts) + minutes(offset_minutes)


def local_date(ts: ColumnOrName, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    """``date(ts + interval '330 minutes')``."""
    return F.to_date(local_time(ts, offset_minutes))


def local_floor(
    ts: ColumnOrName, floor: str | dt.date | dt.datetime, offset_minutes: int = LOCAL_OFFSET_MINUTES
) -> Column:
    """Predicate ``date(ts + offset) >= floor`` rewritten as ``ts >= floor - offset``.

    Both forms select the same rows, but only the second compares the raw column with a
    constant, so Parquet receives it as a pushed filter (row groups are skipped by their
    min/max statistics instead of every row being shifted and compared).
    """
    if isinstance(floor, str):
        floor = dt.datetime.fromisoformat(floor)
    elif not isinstance(floor, dt.datetime):
        floor = dt.datetime(floor.year, floor.month, floor.day)
    cutoff = floor - dt.timedelta(minutes=offset_minutes)
    return _col(ts) >= ntz_literal(cutoff)


def ntz_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp constant. Built from text, so neither the driver's nor the
    session's time zone can shift it (a Python datetime literal is read as local time)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_floor(ts: ColumnOrName, floor: str | dt.date | dt.datetime) -> Column:
    """Predicate ``date(ts) >= floor`` (no shift), also in pushable form."""
    return local_floor(ts, floor, 0)


def money(c: ColumnOrName) -> Column:
    """Money as an exact decimal, so sums do not depend on the order of addition."""
    return _col(c).cast(MONEY)


def pattern_bucket(
    c: ColumnOrName, rules: Sequence[tuple[str, str]], default: ColumnOrName | None = None,
    *, passthrough: bool = False,
) -> Column:
    """Ordered ``CASE WHEN c LIKE p1 THEN v1 ... ELSE default END``; first match wins.

    ``passthrough=True`` makes the input itself the default (ELSE c). LIKE is case-sensitive.
    """
    col = _col(c)
    if not rules:
        return col if passthrough else _lit(default)
    expr = None
    for pattern, label in rules:
        cond = col.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if passthrough:
        return expr.otherwise(col)
    if default is None:
        return expr
    return expr.otherwise(_lit(default))


def relabel(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Equality relabel with ``ELSE c`` (unlisted values, nulls included, pass through)."""
    col = _col(c)
    expr = None
    for src, dst in mapping.items():
        cond = col == F.lit(src)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    return col if expr is None else expr.otherwise(col)


def flag_label(c: ColumnOrName, no: str = "No", yes: str = "Yes") -> Column:
    """0 -> No, 1 -> Yes, anything else (2, null) -> null: there is no ELSE arm."""
    col = _col(c)
    return F.when(col == 0, F.lit(no)).when(col == 1, F.lit(yes))


def two_flag_label(gate: ColumnOrName, flag: ColumnOrName) -> Column:
    """gate=1 and flag=1 -> Yes; gate=1 and flag=0 -> No; otherwise null."""
    g, f = _col(gate), _col(flag)
    return F.when((g == 1) & (f == 1), F.lit("Yes")).when((g == 1) & (f == 0), F.lit("No"))


def three_way_label(first: ColumnOrName, second: ColumnOrName,
                    first_label: str, second_label: str, other: str) -> Column:
    """first=1 -> first_label; else second=1 -> second_label; else other (nulls included)."""
    return (F.when(_col(first) == 1, F.lit(first_label))
            .when(_col(second) == 1, F.lit(second_label))
            .otherwise(F.lit(other)))


def null_fallback(primary: ColumnOrName, fallback: ColumnOrName) -> Column:
    """``CASE WHEN a IS NULL THEN b ELSE a END``."""
    return F.coalesce(_col(primary), _col(fallback))


def sentinel_normalise(c: ColumnOrName, sentinels: Sequence[str], value: str) -> Column:
    """Null or any sentinel -> ``value``; everything else unchanged."""
    col = _col(c)
    return F.when(col.isNull() | col.isin(*sentinels), F.lit(value)).otherwise(col)


def full_name(first: ColumnOrName, last: ColumnOrName, lower: bool = False) -> Column:
    a, b = _col(first), _col(last)
    if lower:
        a, b = F.lower(a), F.lower(b)
    return F.concat(a, F.lit(" "), b)


def with_suffix(c: ColumnOrName, suffix: str) -> Column:
    return F.concat(_col(c), F.lit(suffix))


def nullif(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Null when ``a = b``, else ``a`` (also ``a`` when ``b`` is null)."""
    return F.nullif(_col(a), _col(b))


def scaled(c: ColumnOrName, factor: str) -> Column:
    """Exact decimal scaling, e.g. ``0.82 * cost``."""
    return F.lit(Decimal(factor)) * _col(c)


def month_of(c: ColumnOrName) -> Column:
    """``EXTRACT(MONTH FROM ts)``: the year is not part of it."""
    return F.month(_col(c))
