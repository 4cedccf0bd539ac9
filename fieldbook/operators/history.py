"""Customer-year history: ranking, multi-year cover, lapse and R3, and the partial-year flow."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.functions import age_category, label_res, label_sex, month_to_quarter
from fieldbook.functions.ranking import RANK_KEY, RANK_MONTH, duration_of, res_of
from fieldbook.schemas import AGE_BREAKS, R3_BLIND_YEARS


def rank_sale(
    sale: DataFrame,
    rank_var: Sequence[str] = ("duration", "res"),
    first_month: bool = True,
    keys: Sequence[str] = (),
    with_lic_id: bool = True,
) -> DataFrame:
    """One sale per customer-year: the highest ``rank_var``, then earliest month, then lowest license id.

    NULL ranks last and is kept.  ``first_month`` replaces the month by the earliest of that
    customer-year.  An aggregation, so it combines before the shuffle.  The license id only settles
    which id is reported; without it and with the first month, the default ranking fits one long and
    needs no sort.  With either of them the lowest id of each rank and month is found first, so that rank
    and month, one number, tell which sale is best: two hash aggregations, where the maximum of a struct
    would sort all sales of a task.
    """
    ids = [*keys, "cust_id", "year"]
    types = dict(sale.dtypes)
    packs = tuple(rank_var) == ("duration", "res") and {types[c] for c in ("duration", "res", "month")} == {"int"}
    if packs and not (with_lic_id is False and first_month):
        lowest = sale.groupBy(*ids, F.expr(RANK_KEY).alias("rank"), "month").agg(F.min("lic_id").alias("lic_id"))
        best = lowest.groupBy(*ids).agg(
            F.max("rank").alias("best"),
            F.min("month").alias("first"),
            *[F.expr(f"max_by({v}, {RANK_MONTH})").alias(v) for v in ("month", "lic_id")],
        )
        month = "first as month" if first_month else "month"
        out = best.selectExpr(*ids, f"{duration_of('best')} as duration", f"{res_of('best')} as res", month, "lic_id")
        return out if with_lic_id else out.drop("lic_id")
    if packs:
        best = sale.groupBy(*ids).agg(F.max(F.expr(RANK_KEY)).alias("best"), F.min("month").alias("first"))
        return best.selectExpr(
            *ids,
            f"{duration_of('best')} as duration",
            f"{res_of('best')} as res",
            "first as month",
        )
    order = F.struct(*rank_var, (-F.col("month")).alias("m"), (-F.col("lic_id")).alias("l"))
    best = sale.groupBy(*ids).agg(F.max(order).alias("best"), F.min("month").alias("first"))
    month = F.col("first") if first_month else -F.col("best.m")
    out = best.select(
        *ids, *[F.col(f"best.{v}") for v in rank_var], month.alias("month"), (-F.col("best.l")).alias("lic_id")
    )
    return out if with_lic_id else out.drop("lic_id")


def make_history(
    ranked: DataFrame, yrs: Iterable[int], carry_vars: Sequence[str] = ("month", "res"), keys: Sequence[str] = ()
) -> DataFrame:
    """Carry each ranked sale forward over the years it covers.

    ``duration_run`` is the longest remaining duration; ``carry_vars`` come from the latest sale
    covering the year.  Sales outside ``yrs`` do not count.  A missing duration, or one below 1, covers
    one year.  One ``max_by`` per variable keeps this a hash aggregation; ranking left one sale per
    year, so the latest is unique.
    """
    yrs = list(yrs)
    last = max(yrs)
    duration = F.greatest(F.coalesce("duration", F.lit(1)), F.lit(1))
    ids = [*keys, "cust_id"]
    cover = (
        ranked.filter(F.col("year").isin(*yrs))
        .select(
            *ids,
            F.col("year").alias("src"),
            duration.alias("d"),
            *carry_vars,
            F.explode(F.sequence("year", F.least(F.col("year") + duration - 1, F.lit(last)))).alias("year"),
        )
        .groupBy(*ids, "year")
        .agg(
            F.max(F.col("src") + F.col("d") - F.col("year")).alias("duration_run"),
            *[F.max_by(v, "src").alias(v) for v in carry_vars],
        )
    )
    return cover.select(*ids, "year", "duration_run", *carry_vars)


def _by_customer(keys: Sequence[str]):
    # history has one row per customer-year, so a window partition holds at most one row per year
    return Window.partitionBy(*keys, "cust_id").orderBy("year")


def add_lapse(history: DataFrame, yrs: Iterable[int], keys: Sequence[str] = ()) -> DataFrame:
    """1 when the customer is absent the year after, 0 when present, NULL in the last year."""
    after = F.lead("year").over(_by_customer(keys))
    lapse = F.when(F.col("year") >= max(yrs), None).when(after == F.col("year") + 1, 0).otherwise(1)
    return history.withColumn("lapse", lapse)


def add_r3(history: DataFrame, yrs: Iterable[int], keys: Sequence[str] = ()) -> DataFrame:
    """Renew, Reactivate (2 to 5 years away) or Recruit; NULL in the first five years."""
    gap = F.col("year") - F.lag("year").over(_by_customer(keys))
    blind = sorted(yrs)[:R3_BLIND_YEARS][-1]
    r3 = (
        F.when(F.col("year") <= blind, None)
        .when(gap == 1, "Renew")
        .when(gap <= R3_BLIND_YEARS, "Reactivate")
        .otherwise("Recruit")
    )
    return history.withColumn("R3", r3)


def enrich_history(history: DataFrame, cust: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """Attach demographics and, with ``counties``, the county name.

    Customers meet history on ``cust_id``; a customer has a bounded number of history rows, so no key
    of that join can be hot.
    """
    if counties is not None:
        cust = cust.join(counties, "county_fips", "left")
    return history.join(cust, "cust_id", "left")


def recode_history(
    history: DataFrame,
    to_quarter: Callable[[Column], Column] = month_to_quarter,
    age_breaks: Sequence[int] = AGE_BREAKS,
) -> DataFrame:
    """Label codes, replace birth year by an age category, add the quarter of the sale month."""
    return history.withColumns(
        {
            "sex": label_sex(F.col("sex")),
            "res": label_res(F.col("res")),
            "agecat": age_category(F.col("year") - F.col("birth_year"), age_breaks),
            "quarter": to_quarter(F.col("month")),
        }
    ).drop("birth_year")


def years_at_hand(yrs: Iterable[int], quarter: int, select_quarter: int) -> list[int]:
    """Years left after ``quarterly_filter``: the current year is incomplete for a later quarter."""
    kept = sorted(yrs)
    return kept[:-1] if select_quarter > quarter else kept


def quarterly_filter(df: DataFrame, quarter: int, select_quarter: int, yrs: Iterable[int]) -> DataFrame:
    """Rows up to the selected quarter; the last year goes when that quarter has not ended yet."""
    if select_quarter > quarter:
        df = df.filter(F.col("year") < max(yrs))
    if select_quarter != 4:
        df = df.filter(F.col("quarter") <= select_quarter)
    return df.drop("quarter")


def quarterly_lapse(
    history: DataFrame, select_quarter: int, yrs: Iterable[int], keys: Sequence[str] = ()
) -> DataFrame:
    """Lapse recomputed on rows already cut to a quarter; a full year keeps the stored lapse.

    ``yrs`` are the years at hand after the cut.
    """
    if select_quarter == 4:
        return history
    return add_lapse(history.drop("lapse", "duration_run"), yrs, keys)


def forget_open_year_lapse(history: DataFrame, quarter: int, select_quarter: int, yrs: Iterable[int]) -> DataFrame:
    """Optional correction for a full-year run while the year is still open.

    Such a run drops the open year but keeps lapse as stored, which counts people who have yet to buy
    as lapsed.  Here lapse of the last full year becomes unknown instead.
    """
    if not (select_quarter == 4 and quarter < 4):
        return history
    last = max(years_at_hand(yrs, quarter, select_quarter))
    return history.withColumn("lapse", F.when(F.col("year") != last, F.col("lapse")))


def quarter_cuts(
    quarter_of_row: Column, quarter: int, select_quarters: Sequence[int], yrs: Iterable[int]
) -> Column:
    """Selected quarters a row belongs to, as an array with NULL in the place of those it does not."""
    yrs = list(yrs)
    return F.array(
        *[
            F.when(
                (F.lit(q == 4) | (quarter_of_row <= q))
                & (F.col("year") <= max(years_at_hand(yrs, quarter, q))),
                q,
            )
            for q in select_quarters
        ]
    )


def expand_quarters(
    history: DataFrame,
    quarter: int,
    select_quarters: Sequence[int],
    yrs: Iterable[int],
    keys: Sequence[str] = (),
    to_quarter: Callable[[Column], Column] = month_to_quarter,
) -> DataFrame:
    """``quarterly_filter`` and ``quarterly_lapse`` for several selected quarters in one pass.

    Adds ``select_quarter`` and repeats a row for each selected quarter it belongs to.  A customer
    lapses within a cut when the row of the next year is missing or falls in a later quarter.  That
    takes the month of the next row: ``next_month`` where history carries it, otherwise one window
    before rows are repeated.  Full years keep the stored lapse.
    """
    yrs = list(yrs)
    if "next_month" not in history.columns:
        window = _by_customer(keys)
        follows = F.lead("year").over(window) == F.col("year") + 1
        history = history.withColumn("next_month", F.when(follows, F.lead("month").over(window)))
    cut = F.col("select_quarter")
    is_last = F.lit(False)
    for q in select_quarters:
        is_last = is_last | ((cut == q) & (F.col("year") == max(years_at_hand(yrs, quarter, q))))
    returns = (F.col("lapse") == 0) & (to_quarter(F.col("next_month")) <= cut)
    lapse = (
        F.when(cut == 4, F.col("lapse"))
        .when(is_last, None)
        .when(returns, 0)
        .otherwise(1)
    )
    return (
        history.withColumn("select_quarter", F.explode(quarter_cuts(F.col("quarter"), quarter, select_quarters, yrs)))
        .filter(cut.isNotNull())
        .withColumn("lapse", lapse)
        .drop("next_month", "quarter", "duration_run")
    )
