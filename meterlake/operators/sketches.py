"""Cost statistics that are carried on: kept per day, merged over days.

A day's summary holds what merges: the number, mean and squared deviations of the costs of each group, and a
KLL sketch of them. A new day, or one that got late events, is summarised by itself; the profile over all days
comes from the summaries, and no event is read twice.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalog as fixed
from ..session import Measured, settle_measured
from ..sources.versioned import VersionedTable
from .anomaly import COST, GROUP, STATISTICS
from .lookup import with_keys

# A sketch keeps all values of a group up to this many, so its quantiles are exact; beyond, the rank of a
# quantile is off by less than 0.07 % of the rows, at a confidence of 99 %.
SKETCH_K = 8192
# Values that stand for a group when deviations from its median are ranked: all of a group up to this many.
POINTS = 4096
DAY = "usage_date"


def daily_summary(
    events: DataFrame, group: Sequence[str] = GROUP, cost: str = COST, day: str = DAY, k: int = SKETCH_K
) -> DataFrame:
    """One row per group and day with a cost: n, mean, squares (sum of squared deviations) and sketch. All
    are partial aggregates, so a hot group is reduced where its rows lie. Groups with a null key are left
    out, as they can never be looked up; a null day is a day."""
    paid = with_keys(events.select(*group, day, cost), group).where(F.col(cost).isNotNull())
    return paid.groupBy(*group, day).agg(
        F.count(cost).alias("n"),
        F.avg(cost).alias("mean"),
        (F.var_pop(cost) * F.count(cost)).alias("squares"),
        F.kll_sketch_agg_double(F.col(cost).cast("double"), k).alias("sketch"),
    )


def _merged_moments(days: Column) -> Column:
    """Number, mean and squared deviations of rows (n, mean, squares), pair by pair, which loses no digits
    to large means. A group has one row a day at most."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["squares"] + b["squares"] + apart * apart * a["n"] * b["n"] / n).alias("squares"),
        )

    return F.aggregate(F.array_sort(days), zero, add)


def _points(sketch: Column, n: Column, most: int) -> Column:
    """The values of a group in order, or ``most`` of its quantiles at equal distances if it has more. Ranks
    must be constant in Spark's function, so the same ``most`` are asked for in every group; of n values, the
    one at place r has the rank floor(r * most / n) / most, as long as n is not above ``most``."""
    ranks = F.split(F.lit(" ".join(str(i / most) for i in range(1, most + 1))), " ").cast("array<double>")
    found = F.kll_sketch_get_quantile_double(sketch, ranks)
    held = F.least(n, F.lit(most))
    places = F.sequence(F.lit(1).cast("bigint"), held)
    return F.transform(places, lambda r: F.element_at(found, F.floor(r * F.lit(most) / held).cast("int")))


def merged_profile(
    summaries: DataFrame, group: Sequence[str] = GROUP, k: int = SKETCH_K, points: int = POINTS
) -> DataFrame:
    """All STATISTICS per group over the days given. The median deviation comes from the sketch, too, from
    at most ``points`` of its values, so its rank is off by one part in ``points`` more."""
    merged = summaries.groupBy(*group).agg(
        _merged_moments(F.collect_list(F.struct("n", "mean", "squares"))).alias("m"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )
    at = [fixed.LOW_PERCENTILE, 0.5, fixed.HIGH_PERCENTILE]
    cuts = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(q)) for q in at]))
    with_points = merged.select(
        *group, "m", cuts.alias("cuts"), _points(F.col("sketch"), F.col("m.n"), points).alias("points")
    )
    apart = F.array_sort(F.transform("points", lambda v: F.abs(v - F.col("cuts")[1])))
    found = with_points.select(
        *group,
        F.col("m.mean").alias("mean_cost"),
        F.sqrt(F.col("m.squares") / F.col("m.n")).alias("std_cost"),
        *[F.col("cuts")[i].alias(n) for i, n in enumerate(("p01_cost", "median_cost", "p99_cost"))],
        F.element_at(apart, F.ceil(F.size("points") / 2).cast("int")).alias("mad_cost"),
    )
    return found.select(*group, *STATISTICS)


def day_cell(day: object) -> str:
    """The cell of a day in a table of summaries."""
    return f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def carry_on(
    summaries: VersionedTable, events: DataFrame, cells: Collection[str], note: dict | None = None
) -> None:
    """Summarise the events of some days anew; the summaries of all other days stay where they are. ``cells``
    names those days (``day_cell``); a day without events any more goes. Events of other days are an error
    of the caller's and would count twice."""
    summaries.publish(
        daily_summary(events),
        partition_by=(DAY,),
        in_cells=True,
        keep=lambda part: part.cell not in cells,
        note=note,
    )


def carried_profile(summaries: VersionedTable) -> Measured:
    """The profile over all days, ready for ``with_flags``."""
    return settle_measured(merged_profile(summaries.read()), "carried-profile")
