"""Single-segment estimates: participants, recruits, churn, rates, months.

Each works on the recoded history of one permission, or of many with the identifying columns given as
``keys``.  ``segments.py`` computes all segments together in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from fieldbook.functions import apportioned, strict_mean
from fieldbook.schemas import RATE_THRESHOLD


def _with_segment(history: DataFrame, segment: str) -> DataFrame:
    if segment == "tot":
        return history.withColumn("tot", F.lit("All"))
    return history.filter(F.col(segment).isNotNull())


def est_part(
    history: DataFrame, segment: str, keys: Sequence[str] = (), outvar: str = "participants"
) -> DataFrame:
    """People per segment value and year; history rows are people, unknown segment values are left out."""
    return (
        _with_segment(history, segment).groupBy(*keys, segment, "year").agg(F.count(F.lit(1)).alias(outvar))
    )


def est_recruit(history: DataFrame, segment: str, keys: Sequence[str] = ()) -> DataFrame:
    return est_part(history.filter(F.col("R3") == "Recruit"), segment, keys, "recruits")


def est_churn(history: DataFrame, segment: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of a year's people who did not return, reported in the year they stayed away."""
    return (
        _with_segment(history, segment)
        .groupBy(*keys, segment, "year")
        .agg(strict_mean(F.col("lapse")).alias("churn"))
        .filter(F.col("churn").isNotNull())
        .withColumn("year", F.col("year") + 1)
    )


def scaleup_part(
    part: DataFrame,
    part_total: DataFrame,
    keys: Sequence[str] = (),
    outvar: str = "participants",
    exact: bool = False,
) -> DataFrame:
    """Inflate known categories to the year's total, each rounded half up.

    Rounded by themselves, categories can miss the total by a few; with ``exact`` the units are given out by
    largest remainder, so that they add up to it.
    """
    by = [*keys, "year"]
    totals = part_total.select(*by, F.col(outvar).alias("_total"))
    known = F.sum(outvar).over(Window.partitionBy(*by))
    if exact:
        (category,) = [c for c in part.columns if c not in (*by, outvar)]
        share = apportioned(outvar, F.col("_total"), by, category)
        return part.join(totals, by, "left").withColumn(outvar, share).select(*part.columns)
    return (
        part.withColumn("_known", known)
        .join(totals, by, "left")
        .withColumn(outvar, F.round(F.col(outvar) * F.col("_total") / F.col("_known")).cast("long"))
        .select(*part.columns)
    )


def est_rate(part: DataFrame, pop: DataFrame, outvar: str = "participants") -> DataFrame:
    """Participants over population, matched on the columns both tables have; NULL matches NULL."""
    on = [c for c in part.columns if c in pop.columns and c not in (outvar, "pop")]
    other = pop.select(*[F.col(c).alias(f"_{c}") for c in on], "pop")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    kept = [c for c in part.columns if c != outvar]
    return part.join(other, same, "left").select(*kept, F.try_divide(outvar, "pop").alias("rate"))


def rate_threshold(rates: DataFrame, threshold: float = RATE_THRESHOLD) -> DataFrame:
    """Rates above a plausible limit."""
    return rates.filter(F.col("rate") > threshold)


def missing_month_years(sale: DataFrame, dashboard_yrs: Sequence[int]) -> list[int]:
    """Years that monthly comparisons need but ``sale`` lacks: the dashboard years and one before.

    Runs a job; its result is one row per year.
    """
    needed = {min(dashboard_yrs) - 1, *dashboard_yrs}
    found = sale.select("year").filter(F.col("year").isin(*needed)).distinct().collect()
    return sorted(needed - {row.year for row in found})


def require_month_years(sale: DataFrame, dashboard_yrs: Sequence[int]) -> None:
    missing = missing_month_years(sale, dashboard_yrs)
    if missing:
        raise ValueError(f"sale table lacks years needed for monthly results: {missing}")


def require_dashboard_years(history: DataFrame, dashboard_yrs: Iterable[int]) -> list[int]:
    """Dashboard years present in ``history``; an error when there are none.  Runs a job."""
    wanted = sorted(dashboard_yrs)
    rows = history.select("year").filter(F.col("year").isin(*wanted)).distinct().collect()
    found = sorted(row.year for row in rows)
    if not found:
        raise ValueError(f"history has none of the dashboard years {wanted}; is the current quarter right?")
    return found


def est_month(
    sale: DataFrame, history: DataFrame | None = None, use_recruits: bool = False, keys: Sequence[str] = ()
) -> DataFrame:
    """Customers with a sale per month and year, all of them or recruits only.

    ``sale`` holds distinct customer-year-months.  Recruits are matched by customer and year, so every
    month of a recruit counts.
    """
    metric = "participants"
    if use_recruits:
        recruits = history.filter(F.col("R3") == "Recruit").select(*keys, "cust_id", "year")
        sale = sale.join(recruits, [*keys, "cust_id", "year"], "left_semi")
        metric = "recruits"
    return (
        sale.groupBy(*keys, F.col("month").cast("string").alias("month"), "year")
        .agg(F.count(F.lit(1)).alias(metric))
    )
