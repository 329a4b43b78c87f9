"""Timestamps from outside and date-range predicates. Everything is UTC."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted shapes of a published time. The cast below would
# also take bare years and one-digit fields, so the shape is checked first.
_ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_OTHER = (
    r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?|\d{8}T\d{6})"
    r"(Z|[+-]\d{2}:?\d{2})?$"
)


def _extended(value: Column) -> Column:
    """The less common accepted shapes in the common one; no zone means UTC."""
    steps = (
        (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})", "$1-$2-$3T$4:$5:$6"),
        (",", "."),
        (r"^(.{10}[T ]\d{2}:\d{2})(?!:)", "$1:00"),
        (r"([+-]\d{2})(\d{2})$", "$1:$2"),
        (r"^(.{10}[T ][\d:.]+)$", "$1Z"),
    )
    for pattern, replacement in steps:
        value = F.regexp_replace(value, pattern, replacement)
    return value


def parse_published(value: Column) -> Column:
    """ISO time to an instant; no zone means UTC; anything else is null."""
    shaped = (
        F.when(value.rlike(_ZONED), value)
        .when(value.rlike(_DAY), F.concat(value, F.lit("T00:00:00Z")))
        .when(value.rlike(_OTHER), _extended(value))
    )
    return shaped.try_cast("timestamp")


def moment(df: DataFrame, column: str, value: datetime) -> Column:
    """A literal instant in the timestamp flavour that ``column`` has."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    text = value.isoformat(sep=" ")
    kind = df.schema[column].dataType.simpleString()
    return F.lit(text if kind == "timestamp_ntz" else text + "Z").cast(kind)


def in_date_range(
    df: DataFrame, column: str, from_date: date | None, to_date: date | None
) -> Column:
    """Q7: the date of ``column`` lies within inclusive bounds.

    Half-open bounds on the bare column, so that the scan can skip row groups.
    A null time is out as soon as one bound is given.
    """
    inside = F.lit(True)
    if from_date is not None:
        low = moment(df, column, datetime(from_date.year, from_date.month, from_date.day))
        inside = inside & (F.col(column) >= low)
    if to_date is not None:
        after = datetime(to_date.year, to_date.month, to_date.day) + timedelta(days=1)
        inside = inside & (F.col(column) < moment(df, column, after))
    return inside


def iso_utc(ts: Column) -> Column:
    """``2024-01-02T03:04:05[.ffffff]+00:00``."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        seconds,
        F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
        F.lit("+00:00"),
    )
