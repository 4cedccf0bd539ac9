"""Dashboard assembly: metrics of one permission, formatting, month fill, quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook import schemas as S
from fieldbook.functions import normalize_name
from fieldbook.operators import metrics as M
from fieldbook.operators import segments as G

_ONE = ("permission",)


def calc_part(
    history: DataFrame, segs: Sequence[str] = S.SEGMENTS, use_recruits: bool = False, exact: bool = False
) -> DataFrame:
    """Scaled participants and residents of one permission: ``segment, category, year, participants, residents``.

    County participants are residents.  With ``use_recruits`` only recruits are counted; with ``exact`` the
    categories of a segment add up to the total.
    """
    if "res" not in segs:
        raise ValueError("segment 'res' is needed to scale resident counts")
    if use_recruits:
        history = history.filter(F.col("R3") == "Recruit")
    history = history.withColumn("permission", F.lit("one"))
    measures = G.segment_measures(G.segment_counts(history, _ONE, segs), _ONE, exact)
    rows = measures.select("segment", "category", "year", "participants", "residents")
    # a county may have nonresidents only
    return rows.filter(F.col("participants").isNotNull())


def calc_part_rate(part: DataFrame, pop: DataFrame) -> DataFrame:
    """Resident participants over population per segment, plus Residency rows.

    Residency repeats the total for residents and shows zero for nonresidents.
    """
    by = ["segment", "category", "year"]
    rates = (
        part.filter(F.col("residents").isNotNull())
        .join(G.pop_segments(pop), by, "left")
        .select(*by, F.try_divide("residents", "pop").alias("rate"))
    )
    repeated = F.when(
        F.col("segment") == "tot",
        F.array(
            F.struct("segment", "category", "rate"),
            F.struct(F.lit("res").alias("segment"), F.lit(G.RESIDENT).alias("category"), F.col("rate")),
            F.struct(F.lit("res").alias("segment"), F.lit(G.NONRESIDENT).alias("category"), F.lit(0.0).alias("rate")),
        ),
    ).otherwise(F.array(F.struct("segment", "category", "rate")))
    return rates.select("year", F.inline(repeated)).select(*by, "rate")


def calc_priv_rate(part: DataFrame, part_ref: DataFrame) -> DataFrame:
    """Participants of a privilege over those of its parent permission, per segment."""
    by = ["segment", "category", "year"]
    return M.est_rate(part.select(*by, "participants"), part_ref.select(*by, F.col("participants").alias("pop")))


def calc_metrics(
    history: DataFrame,
    pop_county: DataFrame,
    sale: DataFrame,
    dashboard_yrs: Iterable[int],
    part_ref: DataFrame | None = None,
    res_type: str | None = None,
    segs: Sequence[str] = S.SEGMENTS,
    validate: bool = False,
) -> DataFrame:
    """All metrics of one permission and quarter: ``metric, segment, category, year, value``.

    ``part_ref`` is ``calc_part`` of the parent permission for a privilege rate; without it the rate
    is over ``pop_county``.  ``res_type`` limits history to one residency; sales are not limited.
    With ``validate`` missing years raise, which runs two small jobs; otherwise the result is lazy.
    """
    dashboard_yrs = sorted(dashboard_yrs)
    if "res" not in segs:
        raise ValueError("segment 'res' is needed to scale resident counts")
    if validate:
        dashboard_yrs = M.require_dashboard_years(history, dashboard_yrs)
        M.require_month_years(sale, dashboard_yrs)
    if res_type is not None:
        history = history.filter(F.col("res") == res_type)
    if res_type == G.NONRESIDENT:
        segs = [s for s in segs if s != "county"]

    tagged = history.withColumn("permission", F.lit("one"))
    measures = G.segment_measures(G.segment_counts(tagged, _ONE, segs), _ONE)
    by = ["segment", "category", "year"]
    has_rate, repeat, rate = F.lit(False), F.lit(False), None
    if part_ref is not None:
        ref = part_ref.select(*by, F.col("participants").alias("parent"))
        measures = measures.join(ref, by, "left")
        rate, has_rate = F.try_divide("participants", "parent"), F.col("participants").isNotNull()
    elif res_type != G.NONRESIDENT:
        measures = measures.join(G.pop_segments(pop_county), by, "left")
        rate, has_rate, repeat = F.try_divide("residents", "pop"), F.col("residents").isNotNull(), F.lit(True)
    out = G.metric_rows(measures, _ONE, dashboard_yrs, rate, has_rate, repeat).drop("permission")

    months = M.est_month(sale).transform(_month_rows, "participants")
    if "R3" in history.columns:
        recruits = M.est_month(sale, history, use_recruits=True)
        months = months.unionByName(recruits.transform(_month_rows, "recruits"))
    return out.unionByName(months)


def _month_rows(months: DataFrame, metric: str) -> DataFrame:
    return months.select(
        F.lit(metric).alias("metric"),
        F.lit("month").alias("segment"),
        F.col("month").alias("category"),
        "year",
        F.col(metric).cast("double").alias("value"),
    )


def segment_label(segment: Column) -> Column:
    out = segment
    for name, label in S.SEGMENT_LABELS.items():
        out = F.when(segment == name, label).otherwise(out)
    return out


def format_metrics(metrics: DataFrame, timeframe: int | Column, group: str | Column = "hunt") -> DataFrame:
    """The dashboard table: ``quarter, group, segment, year, category, metric, value``."""
    quarter = timeframe if isinstance(timeframe, Column) else F.lit(timeframe)
    name = group if isinstance(group, Column) else F.lit(normalize_name(group))
    return metrics.select(
        quarter.cast("int").alias("quarter"),
        name.alias("group"),
        segment_label(F.col("segment")).alias("segment"),
        F.col("year").cast("int").alias("year"),
        "category",
        "metric",
        F.col("value").cast("double").alias("value"),
    )


def fill_missing_months(
    dash: DataFrame, unreached: Mapping[int, Sequence[int]] = S.UNREACHED_MONTHS
) -> DataFrame:
    """Zero rows for months that other permissions have and this one lacks.

    The months seen anywhere come from a scalar subquery (one short array), so pairing them with each
    quarter, group, year and metric needs no cross join.  ``dash`` is used several times: pass the
    stored dashboard rather than the plan that computes it.
    """
    months = dash.filter(F.col("segment") == "month")
    by = ["quarter", "group", "segment", "year", "metric"]
    seen = months.agg(F.collect_set("category").alias("seen")).scalar()
    zeros = (
        months.select(*by).distinct()
        .withColumn("category", F.explode(seen))
        .withColumn("value", F.lit(0.0))
    )
    for quarter, skipped in unreached.items():
        zeros = zeros.filter(
            ~((F.col("quarter") == quarter) & F.col("category").isin(*[str(m) for m in skipped]))
        )
    absent = zeros.join(months.select(*by, "category"), [*by, "category"], "left_anti")
    return dash.unionByName(absent.select(*dash.columns))


def fill_missing_categories(
    dash: DataFrame,
    categories: Mapping[str, Sequence[str]] | None = None,
    metrics: Sequence[str] = ("participants", "recruits"),
) -> DataFrame:
    """Zero rows for categories of residency, sex and age that nobody is in, so that every view finds all of them.

    A quarter, group, year and metric that has a total gets all ``categories`` (segment label to labels; the
    fixed ones, if not given), also of a segment without any row.  Counts only: churn and rate of nobody are
    unknown, not zero, unless ``metrics`` names them.  Labels are exploded from one short array, so nothing is
    crossed.  ``dash`` is used twice: pass the stored dashboard.
    """
    if categories is None:
        label = S.SEGMENT_LABELS
        categories = {label["res"]: tuple(S.RES_LABELS.values()), label["sex"]: tuple(S.SEX_LABELS.values()), label["agecat"]: tuple(S.age_labels())}
    wanted = F.array(*[F.struct(F.lit(s).alias("segment"), F.lit(c).alias("category")) for s, names in categories.items() for c in names])
    by = ["quarter", "group", "year", "metric"]
    counted = dash.filter(F.col("metric").isin(*metrics))
    full = counted.filter(F.col("segment") == S.SEGMENT_LABELS["tot"]).select(*by).distinct().select(*by, F.inline(wanted))
    absent = full.join(counted.select(*by, "segment", "category"), [*by, "segment", "category"], "left_anti")
    return dash.unionByName(absent.withColumn("value", F.lit(0.0)).select(*dash.columns))


def qa_year_change(dash: DataFrame, thresholds: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """Dashboard rows that moved more than their segment's percent threshold since the year before."""
    if thresholds is None:
        thresholds = {
            "participants": S.YEAR_CHANGE_PARTICIPANTS,
            "churn": S.YEAR_CHANGE_PARTICIPANTS,
            "recruits": S.YEAR_CHANGE_RECRUITS,
        }
    limit = F.lit(None).cast("int")
    for metric, by_segment in thresholds.items():
        for segment, percent in by_segment.items():
            here = (F.col("metric") == metric) & (F.col("segment") == S.SEGMENT_LABELS[segment])
            limit = F.when(here, percent).otherwise(limit)
    series = Window.partitionBy("quarter", "group", "metric", "segment", "category").orderBy("year")
    before = F.when(F.lag("year").over(series) == F.col("year") - 1, F.lag("value").over(series))
    change = F.try_divide(100 * (F.col("value") - before), before)
    return (
        dash.withColumn("threshold", limit)
        # rounded, so that a change of exactly the threshold is not flagged for its last binary digit
        .withColumn("pct_change", F.round(change, 6))
        .filter(F.abs("pct_change") > F.col("threshold"))
    )


def qa_scaleup(counts: DataFrame, keys: Sequence[str], threshold: float = S.SCALEUP_PERCENT) -> DataFrame:
    """Segment-years where unknown categories are more than ``threshold`` percent of the total.

    ``counts`` is the output of ``segment_counts``; county is compared among residents.
    """
    year = Window.partitionBy(*keys, "year")
    county = F.col("segment") == "county"
    resident = (F.col("segment") == "res") & (F.col("category") == G.RESIDENT)
    known = F.when(county, F.col("n_res")).otherwise(F.col("n"))
    total = F.when(county, F.col("_residents")).otherwise(F.col("_people"))
    return (
        counts.withColumn("_people", F.max(F.when(F.col("segment") == "tot", F.col("n"))).over(year))
        .withColumn("_residents", F.max(F.when(resident, F.col("n"))).over(year))
        .groupBy(*keys, "segment", "year")
        .agg(F.sum(known).alias("known"), F.max(total).alias("total"))
        .withColumn("pct_unknown", F.try_divide(100 * (F.col("total") - F.col("known")), F.col("total")))
        .filter(F.col("pct_unknown") > threshold)
    )
