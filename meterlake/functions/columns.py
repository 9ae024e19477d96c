"""Reusable column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Identifiers whose words a capital letter does not separate.
FIXED_SNAKE_NAMES = {
    "vendorid": "vendor_id",
    "ratecodeid": "ratecode_id",
    "pulocationid": "pu_location_id",
    "dolocationid": "do_location_id",
}

RESCUED_MAP = T.MapType(T.StringType(), T.StringType())


def snake_case(name: str) -> str:
    fixed = FIXED_SNAKE_NAMES.get(name.lower())
    if fixed:
        return fixed
    spaced = name[:1] + re.sub("([A-Z])", r"_\1", name[1:])
    return re.sub("_{2,}", "_", spaced.lower())


def lenient_cast(value: Column, target: T.DataType) -> Column:
    """Cast to a contract type; a value that does not fit becomes null, never an error.

    Whole numbers may be written as ``1.0`` in text, which an integral cast
    refuses; the second attempt goes through double. The direct attempt comes
    first so that ids above 2^53 keep every digit.
    """
    direct = value.try_cast(target)
    if isinstance(target, (T.LongType, T.IntegerType)):
        return F.coalesce(direct, value.try_cast(T.DoubleType()).try_cast(target))
    return direct


def rescued_values(rescued: Column) -> Column:
    return F.from_json(rescued, RESCUED_MAP)


def canonical_value(
    name: str,
    target: T.DataType,
    physical: Mapping[str, tuple[str, T.DataType]],
    rescued: Column | None,
    aliases: Sequence[str] = (),
) -> Column:
    """First non-null of: the physical column, the rescued key, the rescued aliases.

    ``physical`` maps lower-cased names to the spelling and type found in the file.
    """
    candidates = []
    if name.lower() in physical:
        spelling, kind = physical[name.lower()]
        candidates.append(physical_value(spelling, kind, target))
    if rescued is not None:
        candidates += [lenient_cast(F.element_at(rescued, F.lit(key)), target) for key in (name, *aliases)]
    if not candidates:
        return F.lit(None).cast(target).alias(name)
    return F.coalesce(*candidates).alias(name)


def physical_value(spelling: str, kind: T.DataType, target: T.DataType) -> Column:
    column = F.col(f"`{spelling}`")
    if kind == target:
        return column
    if isinstance(kind, T.TimestampNTZType) and isinstance(target, T.TimestampType):
        return column.cast(target)
    if not convertible(kind, target):
        return F.lit(None).cast(target)
    return lenient_cast(column, target)


def convertible(kind: T.DataType, target: T.DataType) -> bool:
    """Whether values of a physical type may become values of a contract type at all.

    A number never turns into a time, nor a time or a nested value into a number.
    """
    if isinstance(target, T.StringType):
        return True
    if isinstance(target, T.TimestampType):
        return isinstance(kind, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType))
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType))


def holds(spelling: str, kind: T.DataType, target: T.DataType) -> Column:
    """Whether the contract type keeps a physical value: casting back gives it again.

    Text counts as kept if it denotes the number it became, however it is written; where no
    decimal can hold the text (``NaN``, ``1e300``), having become a value is enough.
    """
    raw, fitted = F.col(f"`{spelling}`"), physical_value(spelling, kind, target)
    if not isinstance(kind, T.StringType):
        return F.coalesce(fitted.try_cast(kind) == raw, F.lit(False))
    if isinstance(target, T.NumericType):
        exact = T.DecimalType(38, 18)
        return F.coalesce(raw.try_cast(exact) == fitted.try_cast(exact), fitted.isNotNull())
    return fitted.isNotNull()


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole seconds, truncated toward zero, as minutes."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)


def bucket(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first inclusive upper limit that holds ``value``."""
    (first, label), *rest = limits
    chain = F.when(value <= F.lit(float(first)), label)
    for limit, label in rest:
        chain = chain.when(value <= F.lit(float(limit)), label)
    return chain.otherwise(otherwise)


def percent_change(value: Column, order: WindowSpec) -> Column:
    """Change against the previous row in percent; null on the first row and for a zero base."""
    before = F.lag(value).over(order)
    return F.round(F.lit(100.0) * (value - before) / F.nullif(before, F.lit(0)), 2)


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def success_percent(failed: Column, checked: Column) -> Column:
    return F.round(F.lit(100.0) * (F.lit(1.0) - failed / F.nullif(checked, F.lit(0))), 6)


def local_date(instant: Column, zone: str) -> Column:
    """Calendar date of a UTC instant in ``zone``."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def required(name: str) -> Column:
    """The column, or a run-time error where it is null: a NOT NULL check on write."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"null in required column {name}"))).alias(name)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
