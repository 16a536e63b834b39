"""Parsing of landed strings. Malformed input gives null under ANSI mode too; it never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filled(column: Column) -> Column:
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def to_flag(column: Column) -> Column:
    """Only the word true, in any case, is true; all else, null included, is false."""
    return F.coalesce(F.lower(F.trim(column.cast("string"))) == "true", F.lit(False))


def to_number(column: Column) -> Column:
    return filled(column).try_cast("double")


def to_day(column: Column) -> Column:
    return filled(column).try_cast("date")


def to_instant(column: Column) -> Column:
    return filled(column).try_cast("timestamp")


_BY_TYPE = {
    T.BooleanType(): to_flag,
    T.DoubleType(): to_number,
    T.DateType(): to_day,
    T.TimestampType(): to_instant,
}


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Turn a landed all-string frame into the typed columns of ``schema``, in its order."""
    return df.select(
        *[
            _BY_TYPE[f.dataType](F.col(f.name)).alias(f.name) if f.dataType in _BY_TYPE else F.col(f.name)
            for f in schema
        ]
    )
