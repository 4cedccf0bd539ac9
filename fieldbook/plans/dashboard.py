"""Dashboard of all permissions and quarters in one plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions import label_res, month_to_quarter
from fieldbook.operators import dashboard as D
from fieldbook.operators import history as H
from fieldbook.operators import segments as G
from fieldbook.operators.permissions import PermissionRule, sale_groups
from fieldbook.schemas import SEGMENTS

KEYS = ("permission", "select_quarter")


def month_metrics(
    sale_months: DataFrame,
    history: DataFrame,
    quarter: int,
    select_quarters: Sequence[int],
    yrs: Sequence[int],
    to_quarter: Callable[[Column], Column] = month_to_quarter,
) -> DataFrame:
    """Monthly participants and recruits per permission and selected quarter.

    ``sale_months`` holds distinct permission-customer-year-months and ``history`` has one row per
    permission-customer-year.  One left join marks recruits; both metrics then come from a single
    aggregation over months, which combines before the shuffle.
    """
    return month_rows(month_counts(sale_months, history, quarter, select_quarters, yrs, to_quarter))


def month_counts(
    sale_months: DataFrame,
    history: DataFrame,
    quarter: int,
    select_quarters: Sequence[int],
    yrs: Sequence[int],
    to_quarter: Callable[[Column], Column] = month_to_quarter,
) -> DataFrame:
    """``participants`` and ``recruits`` per permission, selected quarter, year and month (``category``)."""
    recruits = history.filter(F.col("R3") == "Recruit").select(
        "permission", "cust_id", "year", to_quarter(F.col("month")).alias("recruit_quarter")
    )
    cuts = H.quarter_cuts(to_quarter(F.col("month")), quarter, select_quarters, yrs)
    cut = F.col("select_quarter")
    in_cut = (cut == 4) & F.col("recruit_quarter").isNotNull() | (F.col("recruit_quarter") <= cut)
    return (
        sale_months.join(recruits, ["permission", "cust_id", "year"], "left")
        .withColumn("select_quarter", F.explode(cuts))
        .filter(cut.isNotNull())
        .groupBy(*KEYS, "year", F.col("month").cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("participants"), F.count_if(in_cut).alias("recruits"))
    )


def month_rows(counted: DataFrame) -> DataFrame:
    """The long form of ``month_counts``; months without recruits have no row for them."""
    rows = F.array_compact(
        F.array(
            F.struct(F.lit("participants").alias("metric"), F.col("participants").cast("double").alias("value")),
            F.when(
                F.col("recruits") > 0,
                F.struct(F.lit("recruits").alias("metric"), F.col("recruits").cast("double").alias("value")),
            ),
        )
    )
    return counted.select(*KEYS, F.lit("month").alias("segment"), "category", "year", F.inline(rows))


def dashboard_metrics(
    history: DataFrame,
    counties: DataFrame,
    pop_county: DataFrame,
    rules: Sequence[PermissionRule],
    dashboard_yrs: Sequence[int],
    segs: Sequence[str] = SEGMENTS,
) -> DataFrame:
    """Participants, recruits, churn and rates from recoded history expanded by ``select_quarter``."""
    if "res" not in segs:
        raise ValueError("segment 'res' is needed to scale resident counts")
    return metrics_of_counts(G.segment_counts(history, KEYS, segs, counties=counties), pop_county, rules, dashboard_yrs)


def metrics_of_counts(
    counts: DataFrame, pop_county: DataFrame, rules: Sequence[PermissionRule], dashboard_yrs: Sequence[int]
) -> DataFrame:
    """``dashboard_metrics`` from the additive counts of ``segment_counts``.

    A permission for nonresidents has no county rows and no rate over population.
    """
    parents = {rule.name: rule.parent for rule in rules if rule.parent}
    away = [rule.name for rule in rules if rule.res_type == G.NONRESIDENT]
    measures = G.segment_measures(counts, KEYS)
    measures = measures.filter(~(F.col("permission").isin(*away) & (F.col("segment") == "county")))
    measures = G.parent_participants(measures, parents, KEYS).join(
        G.pop_segments(pop_county), ["segment", "category", "year"], "left"
    )
    privilege = F.col("permission").isin(*parents)
    rate = F.when(privilege, F.try_divide("participants", "parent").cast("double")).otherwise(
        F.try_divide("residents", "pop").cast("double")
    )
    has_rate = F.when(privilege, F.col("participants").isNotNull()).otherwise(
        F.col("residents").isNotNull() & ~F.col("permission").isin(*away)
    )
    return G.metric_rows(measures, KEYS, dashboard_yrs, rate, has_rate, ~privilege)


def recoded_history(
    history: DataFrame,
    cust: DataFrame,
    counties: DataFrame | None = None,
    to_quarter: Callable[[Column], Column] = month_to_quarter,
) -> DataFrame:
    return H.enrich_history(history, cust, counties).transform(H.recode_history, to_quarter)


def of_residency(history: DataFrame, rules: Sequence[PermissionRule], res: Column) -> DataFrame:
    """Rows that count for their permission; without a limit every row does, NULL residency included."""
    keep = F.lit(True)
    for rule in rules:
        if rule.res_type:
            keep = F.when(F.col("permission") == rule.name, F.coalesce(res == rule.res_type, F.lit(False))).otherwise(keep)
    return history.filter(keep)


def dashboard_all(
    history: DataFrame,
    cust: DataFrame,
    counties: DataFrame,
    pop_county: DataFrame,
    sale: DataFrame,
    permission: DataFrame,
    rules: Sequence[PermissionRule],
    yrs: Sequence[int],
    quarter: int,
    select_quarters: Sequence[int],
    dashboard_yrs: Sequence[int],
    to_quarter: Callable[[Column], Column] = month_to_quarter,
    segs: Sequence[str] = SEGMENTS,
) -> DataFrame:
    """The complete dashboard table.

    ``history`` should be a stored table, best with ``next_month``: it feeds the metrics and the recruit
    months.  Monthly rows cover the years that ``sale`` has, so the caller loads the years to show;
    sales without a customer count once per month.  A permission with a ``res_type`` counts history of
    that residency only, after lapse was worked out on all of it.
    """
    counts_of = counted_history(history, cust, rules, quarter, select_quarters, yrs, to_quarter)
    metrics = dashboard_metrics(counts_of, counties, pop_county, rules, dashboard_yrs, segs)
    shown = of_residency(history, rules, label_res(F.col("res")))
    months = month_metrics(sale_groups(sale, permission), shown, quarter, select_quarters, yrs, to_quarter)
    return D.format_metrics(metrics.unionByName(months), F.col("select_quarter"), F.col("permission"))


def counted_history(
    history: DataFrame,
    cust: DataFrame,
    rules: Sequence[PermissionRule],
    quarter: int,
    select_quarters: Sequence[int],
    yrs: Sequence[int],
    to_quarter: Callable[[Column], Column] = month_to_quarter,
) -> DataFrame:
    """History rows with demographics, once for each selected quarter they belong to, of the residency their permission counts."""
    expanded = recoded_history(history, cust, to_quarter=to_quarter).transform(
        H.expand_quarters, quarter, select_quarters, yrs, ("permission",), to_quarter
    )
    return of_residency(expanded, rules, F.col("res"))
