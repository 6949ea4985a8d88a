"""Column helpers used by the models (all JVM-side, no Python UDFs).

Every helper returns a ``Column`` so Catalyst keeps it inside whole-stage
codegen.  Semantics follow the reference warehouse functions:

* ``safe_divide``      NULL on zero or NULL divisor, computed on doubles
* ``mean``             exact sum / count, so decimal money averages are exact
* ``ts_diff``          whole units between two timestamps, truncated toward zero
* ``month_diff``       month boundaries crossed (year*12+month difference)
* ``us_week``          Sunday-start week of year, 0..53
* ``month_start_ts``   timestamp truncated to month, kept as TIMESTAMP_NTZ
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, ShortType, ByteType, DoubleType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numeric(c: Column | str) -> Column:
    """Numeric coercion: a value that is no number becomes NULL (exact to four decimals)."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("decimal(30,4)")


def safe_divide(a, b) -> Column:
    """``a / b`` as double; NULL when ``b`` is 0 or either side is NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def mean(x) -> Column:
    """Average as exact sum over count, divided once in double precision."""
    x = _c(x)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def count_if(pred) -> Column:
    """``countif``: rows where the predicate is true (0 on none, NULL ignored)."""
    return F.count_if(_c(pred))


def ts_diff(unit: str, end, start) -> Column:
    """Whole ``unit``s from ``start`` to ``end`` (HOUR, DAY, SECOND...), truncated."""
    return F.timestamp_diff(unit, _c(start), _c(end))


def day_diff(end, start) -> Column:
    """Calendar days between two dates."""
    return F.datediff(_c(end), _c(start)).cast("long")


def month_index(d) -> Column:
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def month_diff(end, start) -> Column:
    """Month boundaries crossed between two dates (not ``months_between``)."""
    return (month_index(end) - month_index(start)).cast("long")


def us_week(d) -> Column:
    """Week of year with weeks starting on Sunday; days before the first Sunday are week 0."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("long")


def month_start_ts(ts) -> Column:
    """``date_trunc(ts, month)`` kept as a zone-free timestamp."""
    return F.date_trunc("month", _c(ts)).cast("timestamp_ntz")


def month_start_date(d) -> Column:
    """``date_trunc(date, month)`` as a DATE."""
    return F.trunc(_c(d), "month")


def quarter_end(d) -> Column:
    d = _c(d)
    return F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1)


def to_date(ts) -> Column:
    return F.to_date(_c(ts))


def outward(df):
    """Presentation types at the edge of a model: money decimals as double,
    small integers as bigint.  Sums stay exact inside; the cast happens once."""
    cols = []
    for field in df.schema.fields:
        t = field.dataType
        if isinstance(t, DecimalType):
            cols.append(F.col(field.name).cast(DoubleType()).alias(field.name))
        elif isinstance(t, (IntegerType, ShortType, ByteType)):
            cols.append(F.col(field.name).cast(LongType()).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
