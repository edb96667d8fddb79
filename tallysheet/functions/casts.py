"""Cast vocabulary of the mapping specs and timestamp helpers (O-19, O-25, O-26)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type words a mapping spec may use.  Anything else is text.
SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "str": T.StringType(),
}

# Dtype tags of self-describing dumps and the Spark type each becomes.
DTYPE_TAGS: dict[str, T.DataType] = {
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "datetime64[ns]": T.TimestampNTZType(),
    "datetime64": T.TimestampNTZType(),
    "bool": T.BooleanType(),
    "object": T.StringType(),
}

# Source timestamps are ISO text ("2021-03-04T10:11:12.345+0000"): a date, and a time with up to
# milliseconds.  The wall-clock part is read by its pattern; a zone or other trailing text is ignored.
ISO_STAMP = r"^\s*(\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,3})?)?)?)"


def spark_type(kind: str) -> T.DataType:
    return SPARK_TYPES.get(kind, T.StringType())


def dtype_tag(data_type: T.DataType) -> str:
    """Dump tag for a Spark type."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int64"
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float64"
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType)):
        return "datetime64[ns]"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    return "object"


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def try_number(col: Column, target: T.DataType, source_type: T.DataType | None = None) -> Column:
    """``try_cast`` to a numeric type, with a cheap guard for text.

    Text without a digit can never parse as a number (doubles also take
    NaN / Infinity), and a failed parse costs an exception per row; the
    guard answers NULL for such text without trying, so the result is the
    same as a plain ``try_cast``.
    """
    if source_type is not None and not isinstance(source_type, T.StringType):
        return col.try_cast(target)
    pattern = "[0-9]" if isinstance(target, _INTEGRAL) else "[0-9]|(?i)nan|inf"
    return F.when(col.rlike(pattern), col.try_cast(target))


def parse_timestamp(col: Column) -> Column:
    """ISO text (date, or date-time with up to millisecond precision) -> timestamp_ntz."""
    return F.regexp_extract(col.cast("string"), ISO_STAMP, 1).try_cast("timestamp_ntz")


def cast_as(col: Column, kind: str, source_type: T.DataType | None = None) -> Column:
    """Cast ``col`` by a vocabulary word; malformed values become NULL."""
    if kind in ("timestamp", "date"):
        if isinstance(source_type, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            ts = col.cast("timestamp_ntz")
        else:
            ts = parse_timestamp(col)
        return ts.cast("date") if kind == "date" else ts
    target = spark_type(kind)
    if isinstance(target, T.StringType):
        return col.cast("string")
    if isinstance(target, (*_INTEGRAL, *_FRACTIONAL)):
        return try_number(col, target, source_type)
    return col.try_cast(target)


# Wall-clock helpers for timestamp_ntz.  date_format / date_trunc go through the
# session time zone (a cast to TIMESTAMP), which moves wall-clock times that
# fall in a daylight-saving gap; these read the fields directly instead.


def truncate_seconds(col: Column) -> Column:
    """Drop the sub-second part, keeping a timestamp without time zone."""
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.minute(col),
                                F.second(col))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def day_text(col: Column) -> Column:
    """``yyyy-MM-dd``."""
    return col.cast("date").cast("string")


def datetime_text(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.concat(day_text(col), F.lit(" "), _two(F.hour(col)), F.lit(":"), _two(F.minute(col)), F.lit(":"),
                    _two(F.second(col)))


def iso_text(col: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS`` (the API's timestamp text)."""
    millis = F.floor(F.extract(F.lit("SECOND"), col) * 1000) - F.second(col) * 1000
    return F.concat(day_text(col), F.lit("T"), _two(F.hour(col)), F.lit(":"), _two(F.minute(col)), F.lit(":"),
                    _two(F.second(col)), F.lit("."), F.lpad(millis.cast("string"), 3, "0"))


def load_timestamp(as_of: dt.datetime | str) -> Column:
    """The load time stamped on warehouse rows; a parameter so reruns are reproducible."""
    return truncate_seconds(F.lit(str(as_of)).cast("timestamp_ntz"))
