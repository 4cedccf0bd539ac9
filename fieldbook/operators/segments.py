"""All segments and metrics of many permissions and quarters from one pass over history.

People counts, lapse sums and recruit counts are additive, so history is first reduced to cells: one
grouping set for the demographic columns and one for county.  Cells number a few hundred per
permission, quarter and year however large history is, and the reduction combines before the shuffle.
Everything after works on that small table in a straight line, so history is read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.functions import apportioned, strict_sum
from fieldbook.schemas import SEGMENTS

RESIDENT = "Resident"
NONRESIDENT = "Nonresident"

_COUNTS = ("n", "n_res", "recruits", "recruits_res", "lapse_sum", "lapse_n")


def _segment_value(segment: str) -> Column:
    category = F.lit("All") if segment == "tot" else F.col(segment)
    return F.struct(F.lit(segment).alias("segment"), category.alias("category"))


def segment_counts(
    history: DataFrame,
    keys: Sequence[str],
    segs: Sequence[str] = SEGMENTS,
    counties: DataFrame | None = None,
) -> DataFrame:
    """Additive counts per ``keys``, segment, category and year; unknown categories are left out.

    With ``counties`` (``county_fips, county``) history is counted by code and only the cells are
    joined to county names; without, history has to carry ``county``.
    """
    by = [*keys, "year"]
    place = "county" if counties is None else "county_fips"
    demographic = [s for s in segs if s not in ("tot", "county")]
    if "R3" not in history.columns:
        history = history.withColumn("R3", F.lit(None).cast("string"))
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.sum("lapse").alias("lapse_sum"),
        F.count("lapse").alias("lapse_n"),
        F.count_if(F.col("R3") == "Recruit").alias("recruits"),
    ]
    sets = [[*by, *dict.fromkeys(["res", *demographic])]]
    columns = list(sets[0])
    if "county" in segs:
        sets.append([*by, "res", place])
        columns.append(place)
        cells = history.groupingSets(sets, *columns).agg(*counts, F.grouping(place).alias("_other"))
        if counties is not None:
            cells = cells.join(counties, place, "left")
        values = F.when(F.col("_other") == 0, F.array(_segment_value("county"))).otherwise(
            F.array(*[_segment_value(s) for s in segs if s != "county"])
        )
    else:
        cells = history.groupBy(*columns).agg(*counts)
        values = F.array(*[_segment_value(s) for s in segs])

    resident = F.col("res") == RESIDENT
    return (
        cells.withColumn("n_res", F.when(resident, F.col("n")).otherwise(0))
        .withColumn("recruits_res", F.when(resident, F.col("recruits")).otherwise(0))
        .select(*by, *_COUNTS, F.inline(values))
        .filter(F.col("category").isNotNull())
        .groupBy(*by, "segment", "category")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )


def segment_measures(counts: DataFrame, keys: Sequence[str], exact: bool = False) -> DataFrame:
    """Scaled-up ``participants``, ``residents`` and ``recruits``, and ``churn``, per segment row.

    Counts of a segment are inflated to the year's total.  Residents are inflated to the already
    inflated number of residents; county participants are residents only, while county churn covers
    everybody.  ``churn`` is NULL where lapse is not known for every person.  With ``exact`` the categories of
    a segment add up to the total they are inflated to (largest remainders), otherwise each is rounded.
    """
    year = Window.partitionBy(*keys, "year")
    segment = Window.partitionBy(*keys, "year", "segment")
    is_total = F.col("segment") == "tot"
    is_resident = (F.col("segment") == "res") & (F.col("category") == RESIDENT)

    def scaled(df: DataFrame, count: str, resident_count: str, out: str, out_res: str) -> DataFrame:
        def inflate(value: str, total: str) -> Column:
            if exact:
                return apportioned(value, F.col(total), [*keys, "year", "segment"], "category")
            return F.round(F.col(value) * F.col(total) / F.sum(value).over(segment)).cast("long")

        return (
            df.withColumn("_total", F.max(F.when(is_total, F.col(count))).over(year))
            .withColumn(out, F.when(F.col(count) > 0, inflate(count, "_total")))
            .withColumn("_total", F.max(F.when(is_resident, F.col(out))).over(year))
            .withColumn(
                out_res,
                F.when(
                    (F.col("segment") != "res") & (F.col(resident_count) > 0), inflate(resident_count, "_total")
                ),
            )
            .withColumn(out, F.when(F.col("segment") == "county", F.col(out_res)).otherwise(F.col(out)))
        )

    measures = scaled(counts, "n", "n_res", "participants", "residents")
    measures = scaled(measures, "recruits", "recruits_res", "recruits", "recruits_res")
    churn = F.when(F.col("lapse_n") == F.col("n"), F.col("lapse_sum") / F.col("n"))
    return measures.select(
        *keys, "segment", "category", "year", "participants", "residents", "recruits", churn.alias("churn")
    )


def pop_segments(pop: DataFrame) -> DataFrame:
    """Population by segment, category and year for the segments population is known for."""
    values = [_segment_value(s) for s in ("tot", "sex", "agecat", "county")]
    return (
        pop.select("year", "pop", F.inline(F.array(*values)))
        .groupBy("segment", "category", "year")
        .agg(strict_sum(F.col("pop")).alias("pop"))
    )


def parent_participants(
    measures: DataFrame, parents: Mapping[str, str], keys: Sequence[str]
) -> DataFrame:
    """Add the parent permission's participants as ``parent``, by sending each row to its children.

    A plain self join would compute the measures twice; here rows are repeated once per child and met
    again in a window of at most two rows.
    """
    if not parents:
        return measures.withColumn("parent", F.lit(None).cast("long"))
    children: dict[str, list[str]] = {}
    for child, parent in parents.items():
        children.setdefault(parent, []).append(child)
    heirs = F.array().cast("array<string>")
    for parent, names in children.items():
        heirs = F.when(F.col("permission") == parent, F.array(*map(F.lit, names))).otherwise(heirs)
    target = F.explode(F.concat(F.array("permission"), heirs))
    place = Window.partitionBy(*keys, "segment", "category", "year")
    rest = [c for c in measures.columns if c != "permission"]
    return (
        measures.select(F.col("permission").alias("_from"), target.alias("permission"), *rest)
        .withColumn("_own", F.col("_from") == F.col("permission"))
        .withColumn("parent", F.max(F.when(~F.col("_own"), F.col("participants"))).over(place))
        .filter("_own")
        .drop("_own", "_from")
    )


def metric_rows(
    measures: DataFrame,
    keys: Sequence[str],
    dashboard_yrs: Sequence[int],
    rate: Column | None,
    has_rate: Column,
    residency_rates: Column,
) -> DataFrame:
    """Long form: ``keys, metric, segment, category, year, value``.

    ``residency_rates`` marks rows whose total rate is repeated under Residency (zero for
    nonresidents).  County rows are limited to dashboard years that history has.
    """
    def row(present: Column, metric: str, value: Column, year=F.col("year"), segment=None, category=None):
        return F.when(
            present,
            F.struct(
                F.lit(metric).alias("metric"),
                (F.col("segment") if segment is None else F.lit(segment)).alias("segment"),
                (F.col("category") if category is None else F.lit(category)).alias("category"),
                year.cast("int").alias("year"),
                value.cast("double").alias("value"),
            ),
        )

    rows = [
        row(F.col("participants").isNotNull(), "participants", F.col("participants")),
        row(F.col("recruits").isNotNull(), "recruits", F.col("recruits")),
        row(F.col("churn").isNotNull(), "churn", F.col("churn"), F.col("year") + 1),
    ]
    if rate is not None:
        repeat = has_rate & residency_rates & (F.col("segment") == "tot")
        rows += [
            row(has_rate, "rate", rate),
            row(repeat, "rate", rate, segment="res", category=RESIDENT),
            row(repeat, "rate", F.lit(0), segment="res", category=NONRESIDENT),
        ]
    wanted = F.array(*map(F.lit, dashboard_yrs))
    known = F.collect_set(F.when(F.col("segment") == "tot", F.col("year"))).over(Window.partitionBy(*keys))
    in_dashboard = F.array_contains("_shown", F.col("year"))
    return (
        measures.withColumn("_shown", F.array_intersect(known, wanted))
        .select(*keys, "_shown", F.inline(F.array_compact(F.array(*rows))))
        .filter((F.col("segment") != "county") | in_dashboard)
        .drop("_shown")
    )
