"""License history of every permission in one plan with a single shuffle of the sales.

The step-by-step operators (``rank_sale``, ``make_history``, ``add_lapse``, ``add_r3``) each cluster
rows by customer in their own way.  Here a customer's sales of a permission are aggregated straight
into one row with a slot per license year.  The slots are plain long columns, so the aggregation is a
hash aggregation that combines before the shuffle: a customer id holding a large share of all sales
shrinks to one row per map task.  Ranking, cover, lapse and R3 are then expressions over that row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from fieldbook.functions.ranking import RANK_KEY, res_of, years_of
from fieldbook.operators.permissions import PermissionRule, permission_licenses
from fieldbook.schemas import R3_BLIND_YEARS

def year_slots(sales: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """One row per permission and customer: best sale (packed) and first month of each year, NULL without one.

    Both are a maximum and a minimum, so slots of different sales merge into the slots of all of them.
    """
    yrs = sorted(yrs)
    best = [F.expr(f"max(if(year = {y}, rank_key, null))").alias(f"best_{y}") for y in yrs]
    first = [F.expr(f"min(if(year = {y}, month, null))").alias(f"month_{y}") for y in yrs]
    return (
        sales.filter(F.col("year").isin(*yrs))
        .select("permission", "cust_id", "year", "month", F.expr(RANK_KEY).alias("rank_key"))
        .groupBy("permission", "cust_id")
        .agg(*best, *first)
    )


def history_from_sales(sales: DataFrame, yrs: Iterable[int], look_ahead: bool = False) -> DataFrame:
    """History from sales that carry ``permission`` and ``duration``; ``cust_id`` must be known.

    ``look_ahead`` adds ``next_month``, the month of the following year's row.  It is at hand here, and
    saves partial-year runs from sorting history by customer to find it again.
    """
    yrs = sorted(yrs)
    return history_from_slots(year_slots(sales, yrs), yrs, look_ahead)


def history_from_slots(slots: DataFrame, yrs: Iterable[int], look_ahead: bool = False, since: int | None = None) -> DataFrame:
    """History rows of ``yrs`` from year slots, a narrow step; with ``since`` only the rows of that year and later."""
    yrs = sorted(yrs)
    shown = [y for y in yrs if since is None or y >= since]

    # last year covered by the sale of each year, and what that sale hands on
    ends = [f"{y} - 1 + {years_of(f'best_{y}')} as end_{y}" for y in yrs]
    carries = [f"struct(month_{y} as month, {res_of(f'best_{y}')} as res) as carry_{y}" for y in yrs]
    covered = slots.selectExpr("permission", "cust_id", *ends, *carries)

    # furthest year reached by any sale so far; a year is covered when that is not behind it
    reach = [
        f"greatest({', '.join(f'end_{s}' for s in yrs if s <= y)}, null, null) as reach_{y}" for y in yrs
    ]
    active = {y: f"coalesce(reach_{y} >= {y}, false)" for y in yrs}

    def carry(y: int) -> str:
        newest_first = [s for s in reversed(yrs) if s <= y]
        return "coalesce(" + ", ".join(f"if(end_{s} >= {y}, carry_{s}, null)" for s in newest_first) + ")"

    def lapse(y: int) -> str:
        if y == yrs[-1]:
            return "cast(null as int)"
        return f"if({active.get(y + 1, 'false')}, 0, 1)"

    def r3(y: int) -> str:
        if y in yrs[:R3_BLIND_YEARS]:
            return "cast(null as string)"
        away = [active[s] for s in range(y - R3_BLIND_YEARS, y - 1) if s in active]
        return (
            f"case when {active.get(y - 1, 'false')} then 'Renew' "
            f"when {' or '.join(away or ['false'])} then 'Reactivate' else 'Recruit' end"
        )

    def after(y: int) -> str:
        if not look_ahead:
            return ""
        following = f"{carry(y + 1)}.month" if y + 1 in active else "cast(null as int)"
        return f", {following} as next_month"

    rows = [
        f"if({active[y]}, struct({y} as year, reach_{y} - {y} + 1 as duration_run, {lapse(y)} as lapse, "
        f"{r3(y)} as R3, {carry(y)} as carry{after(y)}), null)"
        for y in shown
    ]
    # years without cover come out as NULL rows; dropping them afterwards keeps this in generated code
    columns = ["permission", "cust_id", "year", "duration_run", "lapse", "R3", "carry.month", "carry.res"]
    return (
        covered.selectExpr("*", *reach)
        .selectExpr("permission", "cust_id", f"inline(array({', '.join(rows)}))")
        .filter("year is not null")
        .selectExpr(*columns, *(["next_month"] if look_ahead else []))
    )


def permission_sales(sale: DataFrame, lic: DataFrame, rules: Sequence[PermissionRule], known: bool = True) -> DataFrame:
    """Sales with the duration and every permission of their license type; of known customers, unless ``known`` is off."""
    types = permission_licenses(lic, rules).select("lic_id", "duration", "permission")
    return (
        (sale.filter(F.col("cust_id").isNotNull()) if known else sale)
        .select("cust_id", "lic_id", "year", "month", "res")
        .join(types, "lic_id")
    )


def build_history(
    sale: DataFrame,
    lic: DataFrame,
    rules: Sequence[PermissionRule],
    yrs: Iterable[int],
    look_ahead: bool = False,
) -> DataFrame:
    """History of all permissions: ``permission, cust_id, year, duration_run, lapse, R3, month, res``."""
    return history_from_sales(permission_sales(sale, lic, rules), yrs, look_ahead)
