"""Batch sources: landed CSV files and Parquet layer tables, always with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import UNREADABLE, MasterTable

# Identity of a stored row. It comes from where the row lies, so it is the same when a lost task runs
# again, and it tells byte-identical copies apart (no hash of the content can).
ROW_ID = ("_row_file", "_row_number")


_BROKEN = "_broken_line"
# Lines that do not fit the schema come with their text.
KEEP_BROKEN = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}


def with_broken_lines(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])


def unreadable_lines(df: DataFrame, may_be_read: Sequence[str] = ()) -> DataFrame:
    """Rows read with KEEP_BROKEN: the text of lines of which no column but those of ``may_be_read`` could be
    read becomes the column UNREADABLE."""
    columns = [c for c in df.columns if c not in (_BROKEN, *may_be_read)]
    nothing = reduce(and_, [F.col(c).isNull() for c in columns])
    return df.withColumn(UNREADABLE, F.when(nothing, F.col(_BROKEN))).drop(_BROKEN)


def read_landing_csv(spark: SparkSession, table: MasterTable, path: str) -> DataFrame:
    """Headed CSV, every column as text. Bad records keep their good columns; of a line without any but its
    key the text is kept in UNREADABLE."""
    reader = spark.read.schema(with_broken_lines(table.landing)).options(header=True, **KEEP_BROKEN)
    return unreadable_lines(reader.csv(path), table.keys)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer table. The schema names the partition columns too, so their types are never guessed, and
    files written before a column existed give null for it without merging footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def row_id_columns() -> list[Column]:
    """ROW_ID of a frame read straight from Parquet files."""
    return [
        F.xxhash64("_metadata.file_path").alias(ROW_ID[0]),
        F.col("_metadata.row_index").alias(ROW_ID[1]),
    ]


def with_row_id(df: DataFrame) -> DataFrame:
    """Add ROW_ID to a frame read straight from Parquet files."""
    return df.select("*", *row_id_columns())
