"""Scalar functions (F1-F13) as Column builders.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Naive timestamps are ``timestamp_ntz``; conversions assume a UTC session
(``hopgraph.session.pin_utc``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds_to_ts(text: ColumnOrName) -> Column:
    """TO_TIMESTAMP(text::DOUBLE), as a naive UTC timestamp.

    Seconds are scaled to microseconds and rounded half-to-even (``rint``),
    which is how the reference engine rounds; a plain cast truncates and
    ``round`` rounds half-up, and both differ on 7-decimal load ids.
    """
    micros = F.rint(_c(text).cast("double") * F.lit(1_000_000.0)).cast("bigint")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def epoch_seconds_text(ts: ColumnOrName) -> Column:
    """Epoch seconds of a timestamp as ``<seconds>.<6-digit micros>`` text.

    Built from integers so both engines print it identically (no double
    formatting).
    """
    us = F.unix_micros(_c(ts).cast("timestamp"))
    return F.concat((us / F.lit(1_000_000)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"))


def micros_to_ts(us: ColumnOrName) -> Column:
    """MAKE_TIMESTAMP(time_us) -> naive timestamp."""
    return F.timestamp_micros(_c(us)).cast("timestamp_ntz")


def lenient_ts_parse(text: ColumnOrName) -> Column:
    """TRY_STRPTIME(s, '%Y-%m-%dT%H:%M:%S.%gZ').

    Needs a 1-3 digit fraction and a literal Z; unpadded parts and spaces
    around the text are read, anything else gives NULL.
    """
    return F.try_to_timestamp(F.trim(_c(text)), F.lit("yyyy-M-d'T'H:m:s.SSS'Z'")).cast("timestamp_ntz")


def strip_quotes(text: ColumnOrName) -> Column:
    """REPLACE(s, '"', '')."""
    return F.replace(_c(text), F.lit('"'), F.lit(""))


def split_part(text: ColumnOrName, sep: str, n: int) -> Column:
    """SPLIT_PART with positive or negative index; past the end gives ''."""
    if n == 0:
        raise ValueError("split_part index must be non-zero")
    return F.split_part(_c(text), F.lit(sep), F.lit(n))


def null_concat(*parts: ColumnOrName | str) -> Column:
    """``a || b || ...``, NULL if any part is NULL (unlike concat_ws)."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def map_get(m: ColumnOrName, key: str) -> Column:
    """record['key']; a missing key gives NULL."""
    return F.try_element_at(_c(m), F.lit(key))


def json_field(json_text: ColumnOrName, field: str, keep_quotes: bool = True) -> Column:
    """F8: JSON ``.field`` of a JSON text; NULL when the text is not an object.

    The reference returns the value as JSON: a string keeps its quotes, and
    numbers, booleans, nulls, objects and arrays keep their JSON text.
    ``keep_quotes=False`` returns the bare string.
    """
    if not keep_quotes:
        return F.get_json_object(_c(json_text), f"$.{field}")
    return F.to_json(F.try_variant_get(F.try_parse_json(_c(json_text)), f"$.{field}", "variant"))


def cast_text(x: ColumnOrName) -> Column:
    """``::TEXT``."""
    return _c(x).cast("string")


def cast_double(x: ColumnOrName) -> Column:
    """``::DOUBLE`` (errors on bad text under ANSI mode)."""
    return _c(x).cast("double")


def cast_bigint(x: ColumnOrName) -> Column:
    """``::BIGINT``."""
    return _c(x).cast("bigint")


def cast_bool(x: ColumnOrName) -> Column:
    """``::BOOLEAN``."""
    return _c(x).cast("boolean")


def cast_ts(x: ColumnOrName) -> Column:
    """zoned ``::TIMESTAMP`` -> naive, at the (UTC) session zone."""
    return _c(x).cast("timestamp_ntz")


def as_datetime(x) -> dt.datetime:
    """A bound given as datetime, date (midnight) or ISO text, as a naive datetime."""
    if isinstance(x, str):
        return dt.datetime.fromisoformat(x)
    if isinstance(x, dt.date) and not isinstance(x, dt.datetime):
        return dt.datetime.combine(x, dt.time.min)
    return x


def day_bounds(first_day: str | dt.date, last_day: str | dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Whole-day inclusive bounds: 00:00:00.000000 to 23:59:59.999999."""
    d1 = dt.date.fromisoformat(str(first_day))
    d2 = dt.date.fromisoformat(str(last_day))
    return (dt.datetime.combine(d1, dt.time.min), dt.datetime.combine(d2, dt.time.max))
