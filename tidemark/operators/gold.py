"""Daily aggregates over observations.

Both aggregates read *tallies*: rows of partial sums per day, business, name, city
and category set. An observation is a tally of one; :func:`compact_tallies` merges
them. All their measures have a fixed width, so the one pass over the observations is
a hash aggregation; picking the latest name, which Spark has to sort for, happens on
the much smaller merged tallies. Both tables can be derived from them, with one scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import utc_midnight
from tidemark.operators.silver import with_day

_GRAIN = ("day", "business_id", "name", "city", "categories")


# Before any observation; the start of a window over all days.
FIRST_DAY = dt.date(1600, 1, 1)


def window_start(today: dt.date, days: int | None) -> dt.date:
    """First day of a recompute window of ``days`` days that ends today; None: of all days."""
    if days is None:
        return FIRST_DAY
    if days < 1:
        raise ValueError("the window needs at least one day")
    return today - dt.timedelta(days=days - 1)


def recompute_window(
    silver: DataFrame, today: dt.date, days: int | None = 2, cap_at_today: bool = False, also: Sequence[dt.date] = ()
) -> DataFrame:
    """Observations of the window and of the days in ``also``, with their UTC ``day``.

    The bound is one literal, fixed before anything runs. On a table partitioned by
    day it prunes partitions; elsewhere the instant bound reaches the scan. Rows
    dated after ``today`` stay in unless ``cap_at_today``.
    """
    as_of = window_start(today, days)
    if days is None:
        bounded = silver if "day" in silver.columns else with_day(silver)
    elif "day" in silver.columns:
        listed = F.col("day").isin([*also]) if also else F.lit(False)
        bounded = silver.filter((F.col("day") >= F.lit(as_of)) | listed)
    else:
        ranges = [f"observed_at >= {utc_midnight(d)} AND observed_at < {utc_midnight(d + dt.timedelta(days=1))}" for d in also]
        bounded = with_day(silver.filter(" OR ".join([f"observed_at >= {utc_midnight(as_of)}", *ranges])))
    return bounded.filter(F.col("day") <= F.lit(today)) if cap_at_today else bounded


def tallies(observations: DataFrame) -> DataFrame:
    """Each observation as a tally of one. Needs ``day``."""
    return observations.select(
        *_GRAIN,
        F.lit(1).cast("long").alias("n"),
        F.col("rating").isNotNull().cast("long").alias("rated"),
        F.col("rating").alias("rating_sum"),
        F.col("rating").alias("rating_min"),
        F.col("rating").alias("rating_max"),
        F.col("review_count").alias("review_count_max"),
        "observed_at",
    )


def compact_tallies(rows: DataFrame) -> DataFrame:
    """Merge tallies of one grain. One shuffle, after a map-side merge."""
    return rows.groupBy(*_GRAIN).agg(
        F.sum("n").alias("n"),
        F.sum("rated").alias("rated"),
        F.sum("rating_sum").alias("rating_sum"),
        F.min("rating_min").alias("rating_min"),
        F.max("rating_max").alias("rating_max"),
        F.max("review_count_max").alias("review_count_max"),
        F.max("observed_at").alias("observed_at"),
    )


def rating_drift_from(rows: DataFrame) -> DataFrame:
    """Tallies to one row per (day, business)."""
    return (
        rows.groupBy("day", "business_id")
        .agg(
            # Latest name and city, with a full order so that ties cannot flip.
            F.max(F.struct("observed_at", "name", "city")).alias("latest"),
            F.try_divide(F.sum("rating_sum"), F.sum("rated")).alias("rating_avg"),
            F.min("rating_min").alias("rating_min"),
            F.max("rating_max").alias("rating_max"),
            F.max("review_count_max").alias("review_count_max"),
            F.sum("n").cast("int").alias("observations"),
        )
        .select(
            "day", "business_id", "latest.name", "latest.city", "rating_avg",
            "rating_min", "rating_max", "review_count_max", "observations",
        )
    )


def category_trends_from(rows: DataFrame) -> DataFrame:
    """Tallies to one row per (day, category, city).

    Spark first merges per business as well, so a hot category spreads over its
    businesses before the distinct count.
    """
    return (
        rows.select("day", "city", "business_id", "n", "rated", "rating_sum",
                    F.explode("categories").alias("category"))
        .filter(F.col("category").isNotNull())
        .groupBy("day", "category", "city")
        .agg(
            F.sum("n").alias("total_observations"),
            F.count_distinct("business_id").alias("distinct_businesses"),
            F.try_divide(F.sum("rating_sum"), F.sum("rated")).alias("avg_rating"),
        )
    )


def rating_drift_daily(silver: DataFrame) -> DataFrame:
    """Rating drift straight from observations (``day`` is added if missing)."""
    return rating_drift_from(compact_tallies(tallies(_dated(silver))))


def category_trends_daily(silver: DataFrame) -> DataFrame:
    """Category trends straight from observations (``day`` is added if missing)."""
    return category_trends_from(tallies(_dated(silver)))


def _dated(silver: DataFrame) -> DataFrame:
    return silver if "day" in silver.columns else with_day(silver)
