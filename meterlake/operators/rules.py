"""Row rules: one pass gives each row the reasons it breaks, in rule order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import UNREADABLE, UNREADABLE_LINE

REASON = "error_reason"
REASONS = "error_reasons"


class Rule(NamedTuple):
    reason: str
    broken: Column


def unreadable_rule(df: DataFrame) -> list[Rule]:
    """The rule of lines that could not be read, for frames that keep the text of such lines."""
    if UNREADABLE not in df.columns:
        return []
    return [Rule(UNREADABLE_LINE, F.col(UNREADABLE).isNotNull())]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add REASONS (all broken rules) and REASON (the first). An undecided condition is not broken."""
    marks = F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.reason)) for r in rules])
    return df.withColumn(REASONS, F.array_compact(marks)).withColumn(
        REASON, F.try_element_at(REASONS, F.lit(1))
    )


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON, REASONS)


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())
