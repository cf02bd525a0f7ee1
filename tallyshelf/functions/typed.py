"""Text to number / time / boolean conversion with fixed grammars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed pattern: the decimal grammar accepted for a number cell. Narrower than a SQL cast
# (no type suffixes such as 5d), wider than plain digits (1e3, .5, 5., inf).
NUMBER = r"(?i)^\s*[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity)\s*$"
WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
LONG_WHOLE = r"^\s*[+-]?\d{19,35}\s*$"
FRACTIONAL_MARK = r"(?i)[.e]|inf"

_CLOCK = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?"
ISO_STAMP = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}{_CLOCK}$"
SLASH_YEAR_FIRST = rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}{_CLOCK}$"
SLASH_YEAR_LAST = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})({_CLOCK})$"


def number_or_null(c: Column) -> Column:
    """Coercing conversion: text outside the grammar, or too large to hold, becomes NULL."""
    d = c.try_cast("double")
    held = (F.abs(d) < F.lit(float("inf"))) | c.rlike("(?i)inf")
    return F.when(c.rlike(NUMBER) & held, d)


def number_or_fail(c: Column, if_null: float = 0.0) -> Column:
    """Strict conversion: NULL takes the default, bad text fails the job."""
    return (
        F.when(c.isNull(), F.lit(float(if_null)))
        .when(c.rlike(NUMBER), c.try_cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("not a number: "), c)).cast("double"))
    )


def whole_or_fail(c: Column, if_null: int = 0) -> Column:
    """Strict whole number; a fraction is cut off towards zero."""
    return F.when(c.rlike(WHOLE), F.trim(c).try_cast("bigint")).otherwise(
        number_or_fail(c, if_null).cast("bigint")
    )


def whole_or_null(c: Column, on_fraction: str = "error", as_double: Column | None = None) -> Column:
    """Coercing whole number. A number with a fraction fails the job or becomes NULL.

    Digits are read directly as BIGINT so long identifiers keep their precision; only other
    spellings (3.0, 1e3) go through DOUBLE, which may be passed in when it is a column already.
    """
    d = number_or_null(c) if as_double is None else as_double
    fits = (d == F.floor(d)) & (F.abs(d) < F.lit(9.2e18))
    if on_fraction == "error":
        other = F.raise_error(F.concat(F.lit("not a whole number: "), c)).cast("bigint")
    elif on_fraction == "null":
        other = F.lit(None).cast("bigint")
    else:
        raise ValueError(f"on_fraction must be 'error' or 'null', not {on_fraction!r}")
    return (
        F.when(c.rlike(WHOLE), F.trim(c).try_cast("bigint"))
        .when(d.isNull(), F.lit(None).cast("bigint"))
        .when(fits, d.cast("bigint"))
        .otherwise(other)
    )


#: Orders of day and month that a text of a slashed date fits, as bits; a text without such a date fits both.
MONTH_FIRST, DAY_FIRST = 1, 2


def order_mask(c: Column) -> Column:
    """The orders that fit ``c``; a column's order is the ``bit_and`` of its masks, NULL cells left out.

    Only texts with a slash are looked at closely, and only one of two numbers beyond 12 tells.
    """
    part = lambda n: F.substring_index(F.substring_index(c, "/", n), "/", -1).try_cast("int")
    one, two = part(1), part(2)
    tells = F.when(one > 12, F.when(two <= 12, DAY_FIRST)).when((one <= 12) & (two > 12), MONTH_FIRST)
    held = F.when(F.contains(c, F.lit("/")), F.when(tells.isNotNull() & c.rlike(SLASH_YEAR_LAST), tells))
    return F.coalesce(held, F.lit(MONTH_FIRST | DAY_FIRST))


def day_first_columns(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, bool]:
    """Whether a column of ``dd/MM/yyyy`` or ``MM/dd/yyyy`` texts puts the day first.

    One partially aggregated pass over ``df`` for all columns; one row comes to the driver. A
    column is day-first if some text fits only that order and none fits only the other.
    """
    if not columns:
        return {}
    found = df.agg(*[F.bit_and(order_mask(c)).alias(name) for name, c in columns.items()]).first()
    return {name: found[name] == DAY_FIRST for name in columns}


def stamp_or_null(c: Column, kind: Column | None = None, day_first: bool = False) -> Column:
    """Coercing timestamp over fixed shapes: ISO, ``yyyy/MM/dd``, and ``MM/dd/yyyy`` or, with
    ``day_first``, ``dd/MM/yyyy``. Fractions beyond microseconds are cut, zones are honoured.

    A slashed date's order is a matter of its column (``day_first_columns``); a text that does
    not fit it becomes NULL, never a date with day and month swapped. With ``kind`` given,
    number cells (``n``) count as nanoseconds since the epoch.
    """
    order = "$3-$2-$1$4" if day_first else "$3-$1-$2$4"
    iso = (
        F.when(c.rlike(ISO_STAMP), c)
        .when(c.rlike(SLASH_YEAR_FIRST), F.translate(c, "/", "-"))
        .when(c.rlike(SLASH_YEAR_LAST), F.regexp_replace(c, SLASH_YEAR_LAST, order))
    )
    # The shortest text with more than six places has 24 characters.
    cut = F.when(F.octet_length(iso) < 24, iso).otherwise(F.regexp_replace(iso, r"(\.\d{6})\d+", "$1"))
    stamp = cut.try_cast("timestamp")
    if kind is None:
        return stamp
    nanos = F.trim(c).try_cast("bigint")
    micros = F.when(nanos.isNotNull(), F.call_function("div", nanos - F.pmod(nanos, F.lit(1000)), F.lit(1000)))
    # Beyond BIGINT, which ends in the year 2262, digits are counted as decimals, never through DOUBLE.
    long_nanos = F.when(c.rlike(LONG_WHOLE), F.trim(c).try_cast("decimal(38,0)"))
    long_micros = F.floor(long_nanos.cast("decimal(38,3)") / F.lit(1000).cast("decimal(4,0)")).try_cast("bigint")
    other = F.when(~c.rlike(LONG_WHOLE), F.floor(number_or_null(c) / F.lit(1000)).try_cast("bigint"))
    micros = F.coalesce(micros, long_micros, other)
    return F.when(kind == "n", F.timestamp_micros(micros)).otherwise(stamp)


def date_or_null(c: Column, kind: Column | None = None, day_first: bool = False) -> Column:
    return F.to_date(stamp_or_null(c, kind, day_first))


def flag_or_null(c: Column) -> Column:
    return c.try_cast("boolean")
