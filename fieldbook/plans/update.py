"""Update runs: new sales join what earlier runs stored, and only what they can change is computed again.

The state of a run has one row per permission and customer with three slots per license year: best sale, first month, and
the months with a sale as bits.  They are a maximum, a minimum and a bitwise or, so the state of old and new sales is the
merge of both and old sales are never read again.  Sales of year Y leave history before Y - 1 as it is (lapse looks one
year ahead, cover and R3 only back), and counts per year are additive over history.  So a run rewrites history, counts
and months of the years from Y - 1 on and leaves the stored ones of earlier years.  All tables change in one commit.

What the state cannot undo is a sale that is taken back, or a license whose type changes: start the state again then.
Stored counts keep the demographics customers had when they were computed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions import label_res, month_to_quarter
from fieldbook.operators import dashboard as D
from fieldbook.operators import segments as G
from fieldbook.operators.permissions import PermissionRule
from fieldbook.plans import dashboard as plan
from fieldbook.plans.history import history_from_slots, permission_sales, year_slots
from fieldbook.schemas import SEGMENTS
from fieldbook.sources.snapshots import Snapshots

_KEYS = ("permission", "cust_id")
#: bit of month 0; relative months from -16 to 46 have one
_MONTH_0 = 16


def season_state(sales: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """The state of sales that carry ``permission`` and ``duration``; an unknown customer is one row of months per permission."""
    yrs = sorted(yrs)
    known = sales.withColumn("duration", F.when(F.col("cust_id").isNotNull(), F.col("duration")))
    bit = F.when(F.col("month").between(-_MONTH_0, 62 - _MONTH_0), F.expr(f"shiftleft(1L, month + {_MONTH_0})")).when(
        F.col("month").isNotNull(), F.raise_error(F.concat(F.lit("no bit for month "), F.col("month"))).cast("long")
    )
    months = (
        known.filter(F.col("year").isin(*yrs))
        .select(*_KEYS, "year", bit.alias("bit"))
        .groupBy(*_KEYS)
        .agg(*[F.coalesce(F.expr(f"bit_or(if(year = {y}, bit, null))"), F.lit(0)).cast("long").alias(f"sold_{y}") for y in yrs])
    )
    slots = year_slots(known.filter(F.col("cust_id").isNotNull()), yrs)
    return _merged(slots.unionByName(months, allowMissingColumns=True), yrs)


def state_years(state: DataFrame) -> list[int]:
    return sorted(int(c[5:]) for c in state.columns if c.startswith("best_"))


def _merged(rows: DataFrame, yrs: Sequence[int]) -> DataFrame:
    kinds = (("best", "max({})", "bigint"), ("month", "min({})", "int"), ("sold", "bit_or({})", "bigint"))
    return rows.groupBy(*_KEYS).agg(
        *[F.expr(f"cast({how.format(f'{name}_{y}')} as {kind}) as {name}_{y}") for name, how, kind in kinds for y in yrs]
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """State of all sales that the given states are of; the years are those of any.

    One exchange of state rows, which combine before it; no sale is read.
    """
    yrs = sorted({y for s in states for y in state_years(s)})
    return _merged(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states), yrs)


def history_of(state: DataFrame, yrs: Iterable[int], look_ahead: bool = False, since: int | None = None) -> DataFrame:
    """History rows from a state, those of ``since`` and later if given; a narrow step."""
    yrs = sorted(yrs)
    there = set(state_years(state))
    absent = {f"{n}_{y}": F.lit(None).cast(k) for y in yrs if y not in there for n, k in (("best", "bigint"), ("month", "int"))}
    return history_from_slots(state.withColumns(absent).filter(F.col("cust_id").isNotNull()), yrs, look_ahead, since)


def sale_months_of(state: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """Distinct ``permission, cust_id, year, month`` of the sales behind a state; each has one row, unknown customers included."""
    there = set(state_years(state))
    wanted = [y for y in sorted(yrs) if y in there]
    if not wanted:
        return state.limit(0).select(*_KEYS, F.lit(0).alias("year"), F.lit(0).alias("month"))
    years = ", ".join(f"struct({y} as year, sold_{y} as sold)" for y in wanted)
    bits = "filter(sequence(0, 62), b -> (shiftright(sold, b) & 1L) = 1L)"
    return (
        state.selectExpr(*_KEYS, f"inline(array({years}))")
        .filter("sold <> 0")
        .selectExpr(*_KEYS, "year", f"explode({bits}) as bit")
        .selectExpr(*_KEYS, "year", f"bit - {_MONTH_0} as month")
    )


def advance(
    store: Snapshots,
    sale: DataFrame,
    lic: DataFrame,
    cust: DataFrame,
    counties: DataFrame,
    rules: Sequence[PermissionRule],
    yrs: Sequence[int],
    quarter: int,
    select_quarters: Sequence[int],
    to_quarter: Callable[[Column], Column] = month_to_quarter,
    segs: Sequence[str] = SEGMENTS,
) -> int:
    """Take ``sale`` (new sales only) into the stored state and bring the stored tables up to date; the new version.

    The first run starts from nothing.  ``yrs`` are all license years so far and ``quarter`` the current one.  Tables:
    ``state`` by permission, ``history`` (with ``next_month``), ``counts`` and ``months`` by year.
    """
    yrs = sorted(yrs)
    names = [rule.name for rule in rules]
    new = season_state(permission_sales(sale, lic, rules, known=False), yrs)
    change = store.begin()
    since = yrs[0]
    if "state" in change.tables:
        old = change.table("state")
        first = sale.filter(F.col("year").isin(*yrs)).agg(F.min("year")).first()[0]
        # the year that was the last one so far had no lapse, and may not have counted for every quarter
        since = max(yrs[0], min(y for y in (first, max(state_years(old))) if y is not None) - 1)
        new = merge_states(old, new)
    change.replace_all("state", new, "permission", names)
    state, changed = change.table("state"), [y for y in yrs if y >= since]
    change.replace("history", history_of(state, yrs, look_ahead=True, since=since), "year", changed)
    history = change.table("history").filter(F.col("year") >= since)
    counted = plan.counted_history(history, cust, rules, quarter, select_quarters, yrs, to_quarter)
    change.replace("counts", G.segment_counts(counted, plan.KEYS, segs, counties=counties), "year", changed)
    shown = plan.of_residency(history, rules, label_res(F.col("res")))
    months = plan.month_counts(sale_months_of(state, changed), shown, quarter, select_quarters, yrs, to_quarter)
    change.replace("months", months, "year", changed)
    return change.commit()


def dashboard_of_store(
    store: Snapshots,
    pop_county: DataFrame,
    rules: Sequence[PermissionRule],
    dashboard_yrs: Sequence[int],
    month_yrs: Sequence[int],
    version: int | None = None,
) -> DataFrame:
    """The complete dashboard from stored counts and months, of the current version or an earlier one; no history is read."""
    metrics = plan.metrics_of_counts(store.table("counts", version), pop_county, rules, dashboard_yrs)
    months = plan.month_rows(store.table("months", version).filter(F.col("year").isin(*month_yrs)))
    return D.format_metrics(metrics.unionByName(months), F.col("select_quarter"), F.col("permission"))
