"""Cost anomaly flags from per-group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalog as fixed
from ..session import Measured, settle_measured
from ..sources.tables import ROW_ID
from .lookup import lookup_join, with_keys

GROUP = ("org_id", "service")
COST = "cost_usd_increment"


def cost_statistics(events: DataFrame, group: Sequence[str] = GROUP, cost: str = COST) -> DataFrame:
    """Mean, population deviation and three percentiles per group.

    All are partial aggregates, the percentiles one mergeable sketch: a hot group is reduced where its
    rows lie. Groups with a null key are left out, as they can never be looked up.
    """
    cut = F.percentile_approx(cost, [fixed.LOW_PERCENTILE, 0.5, fixed.HIGH_PERCENTILE])
    return (
        with_keys(events.select(*group, cost), group)
        .groupBy(*group)
        .agg(
            F.avg(cost).alias("mean_cost"),
            F.stddev_pop(cost).alias("std_cost"),
            cut.alias("cuts"),
        )
        .select(
            *group,
            "mean_cost",
            "std_cost",
            *[F.col("cuts")[i].alias(n) for i, n in enumerate(("p01_cost", "median_cost", "p99_cost"))],
        )
    )


def median_deviation(
    events: DataFrame,
    statistics: DataFrame | Measured,
    group: Sequence[str] = GROUP,
    cost: str = COST,
    spread_by: Sequence[str] = ROW_ID,
) -> DataFrame:
    """Median absolute deviation from the group's median."""
    narrow = with_keys(events.select(*group, cost, *spread_by), group)
    joined = lookup_join(narrow, statistics, group, spread_by=spread_by)
    deviation = F.abs(F.col(cost) - F.col("median_cost"))
    return joined.groupBy(*group).agg(F.percentile_approx(deviation, 0.5).alias("mad_cost"))


def _scaled(distance: Column, scale: str, factor: float = 1.0) -> Column:
    """factor * distance / scale, zero where the group has no spread."""
    spread = F.col(scale)
    return F.when(spread != 0, F.lit(factor) * distance / spread).otherwise(F.lit(0.0))


def flag_conditions(cost: str = COST) -> dict[str, Column]:
    """The four tests over a row that carries its group's statistics, and their disjunction."""
    paid = F.col(cost)
    z = _scaled(paid - F.col("mean_cost"), "std_cost")
    modified_z = _scaled(paid - F.col("median_cost"), "mad_cost", fixed.MODIFIED_Z_FACTOR)
    tests = (
        F.abs(z) > fixed.ZSCORE_LIMIT,
        (F.col("mad_cost") >= fixed.MAD_FLOOR) & (F.abs(modified_z) > fixed.MODIFIED_Z_LIMIT),
        (paid < F.col("p01_cost")) | (paid > F.col("p99_cost")),
        paid > F.col("p99_cost") * fixed.HIGH_PERCENTILE_MULTIPLE,
    )
    decided = [F.coalesce(t, F.lit(False)) for t in tests]
    return dict(zip(fixed.ANOMALY_FLAGS, [*decided, decided[0] | decided[1] | decided[2] | decided[3]]))


STATISTICS = ("mean_cost", "std_cost", "p01_cost", "median_cost", "p99_cost", "mad_cost")


def cost_profile(
    population: DataFrame,
    group: Sequence[str] = GROUP,
    cost: str = COST,
    spread_by: Sequence[str] = ROW_ID,
) -> Measured:
    """All STATISTICS per group of the rows given, by two narrow passes over them. A frame that is dear to
    make should be stored first."""
    base = settle_measured(cost_statistics(population, group, cost), "cost-statistics")
    deviation = median_deviation(population, base, group, cost, spread_by)
    return settle_measured(base.df.join(deviation, list(group), "left"), "cost-deviations")


def with_flags(
    events: DataFrame,
    profile: Measured,
    group: Sequence[str] = GROUP,
    cost: str = COST,
    spread_by: Sequence[str] = ROW_ID,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Add the five anomaly flags, by the statistics of each row's group. A row without statistics (no
    service, no cost) gets false."""
    joined = lookup_join(events, profile, group, spread_by=spread_by, count_in=count_in)
    return joined.withColumns(flag_conditions(cost)).drop(*STATISTICS)


def flag_cost_anomalies(
    events: DataFrame,
    group: Sequence[str] = GROUP,
    cost: str = COST,
    spread_by: Sequence[str] = ROW_ID,
    population: DataFrame | None = None,
) -> DataFrame:
    """Add the five anomaly flags. Statistics cover every row given, or those of ``population``. The full
    rows are read once, and stay in place while the statistics fit a broadcast."""
    counted = events if population is None else population
    profile = cost_profile(counted, group, cost, spread_by)
    return with_flags(events, profile, group, cost, spread_by, count_in=counted)
