"""Text conformance: one Column in, one Column out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import REGIONS, SERVICE_ALIASES, SERVICES


def clean_text(column: Column) -> Column:
    """Trimmed lower case; blank becomes null."""
    return F.nullif(F.lower(F.trim(column.cast("string"))), F.lit(""))


def clean_region(column: Column) -> Column:
    """``clean_text`` with underscores as hyphens."""
    return F.translate(clean_text(column), "_", "-")


def clean_service(column: Column) -> Column:
    """``clean_text`` with aliases resolved; names without an alias pass through."""
    aliases = F.create_map(*[F.lit(word) for pair in SERVICE_ALIASES.items() for word in pair])
    name = clean_text(column)
    return F.coalesce(F.try_element_at(aliases, name), name)


RULES = {"text": clean_text, "region": clean_region, "service": clean_service}


def conform(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Apply a named text rule to each listed column that the frame has, in one projection."""
    present = [c for c in rules if c in df.columns]
    return df.withColumns({c: RULES[rules[c]](F.col(c)) for c in present})


def outside_catalogue(column: Column, catalogue: tuple[str, ...]) -> Column:
    """True for a known value that the catalogue lacks; a null passes."""
    return column.isNotNull() & ~column.isin(*catalogue)


def unknown_service(column: Column) -> Column:
    return outside_catalogue(column, SERVICES)


def unknown_region(column: Column) -> Column:
    return outside_catalogue(column, REGIONS)
