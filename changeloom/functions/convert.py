"""Conversions of source text to destination types, as column expressions.

Images arrive as text; every rule here is chosen when the plan is built, from the declared
types on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import SourceColumn, TargetColumn

#: Years that a destination's time types can hold.
YEAR_RANGES = {"DateTime": (1970, 2105), "DateTime32": (1970, 2105), "Date": (1970, 2105), "DateTime64": (1925, 2261), "Date32": (1925, 2261)}


def with_year(value: Column, year: Column) -> Column:
    """The same month, day and time of day in another year. 29 February becomes 1 March
    where there is none."""
    day = F.date_add(F.make_date(year, F.month(value), F.lit(1)), F.dayofmonth(value) - 1)
    return day.cast("timestamp") + (value.cast("timestamp") - F.date_trunc("DAY", value))


def clamp_year(value: Column, base: str) -> Column:
    """Years beyond the destination's range become its first or last one."""
    if base not in YEAR_RANGES:
        return value
    low, high = YEAR_RANGES[base]
    year = F.year(value)
    return F.when(year > high, with_year(value, F.lit(high))).when(year < low, with_year(value, F.lit(low))).otherwise(value)


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """Text in UTC to a timestamp. Zero dates, empty and bad text give null, or fail if strict."""
    return F.when(text == "", None).otherwise((F.to_timestamp if strict else F.try_to_timestamp)(text))


def unscaled(text: Column) -> Column:
    """A decimal's digits without the point: 10.21 is 1021."""
    return F.replace(text, F.lit("."), F.lit("")).cast("decimal(38,0)")


def to_integer(value: Column, target: TargetColumn, wrap: bool = False) -> Column:
    """To the destination's integer type. Out of range: an error, or with `wrap` the low bits."""
    low, high = target.integer_range
    big = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    if wrap:
        # modulo of a positive decimal: the width is a power of two
        value = F.pmod(value.cast("decimal(38,0)") - big(low), big(high - low + 1)) + big(low)
        return value.cast(target.spark_type)
    if target.base[0] == "U":
        value = F.when((value < 0) | (value > big(high)), F.raise_error(F.concat(F.lit(f"{target.name}: out of range of {target.base}: "), value.cast("string")))).otherwise(value)
    return value.cast(target.spark_type)


def zero(target: TargetColumn) -> Column:
    """What stands for null in a column that can't be null."""
    kind = target.spark_type
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.lit(0))
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    return F.lit(False) if isinstance(kind, T.BooleanType) else F.lit(0).cast(kind)


def null_default(value: Column, target: TargetColumn) -> Column:
    return value if target.nullable else F.coalesce(value, zero(target))


def convert(text: Column, source: SourceColumn, target: TargetColumn, strict: bool = False, wrap: bool = False) -> Column:
    """One source value (text) to the destination's type, without redaction. Null stays null."""
    if source.kind in ("timestamp", "date"):
        moment = clamp_year(parse_timestamp(text, strict), target.base)
        if isinstance(target.spark_type, T.StringType):
            return text
        return moment.cast(target.spark_type)
    if source.kind == "decimal":
        text = F.when(text != "", text)
        if target.is_int:
            return to_integer(unscaled(text), target, wrap)
        if isinstance(target.spark_type, T.StringType):
            return text
        return text.cast(target.spark_type)
    if isinstance(target.spark_type, T.StringType):
        return text
    if isinstance(target.spark_type, T.ArrayType):
        return F.from_json(text, target.spark_type)
    if isinstance(target.spark_type, T.TimestampType) or isinstance(target.spark_type, T.DateType):
        return clamp_year(parse_timestamp(text, strict), target.base).cast(target.spark_type)
    if target.is_int:
        return to_integer(text.cast("decimal(38,0)"), target, wrap)
    return text.cast(target.spark_type)
