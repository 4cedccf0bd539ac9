"""Census population: age groups, aggregation, extrapolation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldbook.functions import label_sex, strict_sum
from fieldbook.schemas import ACS_AGE_UPPER, AGE_BREAKS, acs_age_label, age_labels


def age_map(spark: SparkSession, breaks: Sequence[int] = AGE_BREAKS) -> DataFrame:
    """One row per year of age, 0 to 100: age category (1-based) and census age group.

    Built on a range, whose size Spark knows: joins with it are broadcast.
    """
    last = ACS_AGE_UPPER[-1]
    age = F.col("id").cast("int")
    labels = F.array(*[F.lit(acs_age_label(a)) for a in range(last + 1)])
    category = F.lit(0)
    for lower in breaks:
        category = category + (age >= lower).cast("int")
    return spark.range(0, last + 1, 1, 1).select(
        age.alias("age_year"), category.alias("age"), F.element_at(labels, age + 1).alias("age_acs")
    )


def factor_age_acs(pop: DataFrame, ages: DataFrame) -> DataFrame:
    """Census age group as an ordered category: unknown labels become NULL, ``age_acs_ord`` sorts."""
    levels = ages.groupBy("age_acs").agg(F.min("age_year").alias("age_acs_ord"))
    known = levels.withColumn("level", F.col("age_acs"))
    return pop.join(known, "age_acs", "left").withColumn("age_acs", F.col("level")).drop("level")


def age_acs_check(pop: DataFrame, ages: DataFrame) -> DataFrame:
    """Row counts by label before and after ``factor_age_acs``."""
    return (
        factor_age_acs(pop.withColumn("old", F.col("age_acs")), ages)
        .groupBy(F.col("age_acs").alias("new"), "old")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def aggregate_pop(pop: DataFrame) -> DataFrame:
    """Collapse census age groups to the age categories; one missing estimate makes the sum missing."""
    return pop.groupBy("county_fips", "year", "sex", "age").agg(strict_sum(F.col("pop")).alias("pop"))


def label_pop(pop: DataFrame, breaks: Sequence[int] = AGE_BREAKS) -> DataFrame:
    """Codes to labels; the age category column becomes ``agecat``."""
    label = F.lit(None).cast("string")
    for code, text in enumerate(age_labels(breaks), start=1):
        label = F.when(F.col("age") == code, text).otherwise(label)
    return pop.withColumn("sex", label_sex(F.col("sex"))).withColumn("agecat", label).drop("age")


def growth_rate(pop: DataFrame) -> DataFrame:
    """Mean year-over-year ratio of total population, as one row with ``last_year`` and ``growth``.

    Totals are one row per census year, so the ordered list below has a handful of entries.  Gaps
    between years are ignored, and a single year gives a NULL rate.  No population at all gives NULL in
    both columns, which ``extrapolation_check`` shows.
    """
    totals = pop.groupBy("year").agg(strict_sum(F.col("pop")).alias("total"))
    ordered = totals.agg(F.sort_array(F.collect_list(F.struct("year", "total"))).alias("t"))
    ratios = F.expr("transform(slice(t, 2, size(t)), (x, i) -> try_divide(x.total, t[i].total))")
    known = F.filter(ratios, lambda r: r.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, r: acc + r)
    return ordered.select(
        F.expr("try_element_at(t, -1).year").alias("last_year"),
        F.try_divide(total, F.size(known).cast("double")).alias("growth"),
    )


def extrapolate_pop(pop: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """Grow the last year's population at the mean rate for each later year in ``yrs``.

    Growth and last year enter as scalar subqueries, so nothing is joined or collected.
    """
    growth = growth_rate(pop)
    last, rate = growth.select("last_year").scalar(), growth.select("growth").scalar()
    columns = pop.columns
    ahead = (
        pop.withColumn("_last", last)
        .withColumn("_rate", rate)
        .filter(F.col("year") == F.col("_last"))
        .withColumn(
            "year",
            F.explode(F.filter(F.array(*map(F.lit, sorted(yrs))), lambda y: y > F.col("_last"))),
        )
        .withColumn("pop", F.col("pop") * F.pow(F.col("_rate"), F.col("year") - F.col("_last")))
        .select(*columns)
    )
    return ahead.unionByName(pop.withColumn("pop", F.col("pop").cast("double")))


def extrapolation_check(pop: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """One QA row: last census year, growth, and how many years have to be extrapolated."""
    ahead = F.filter(F.array(*map(F.lit, sorted(yrs))), lambda y: y > F.col("last_year"))
    known = F.when(F.col("last_year").isNotNull(), F.size(ahead))
    return growth_rate(pop).withColumn("n_extrapolated", F.coalesce(known, F.lit(len(set(yrs)))))


def prep_pop(pop: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """County population by year, sex and age category for all of ``yrs``."""
    yrs = list(yrs)
    return (
        pop.filter(F.col("year").isin(*yrs))
        .transform(aggregate_pop)
        .transform(label_pop)
        .transform(extrapolate_pop, yrs)
    )


def est_pop(pop: DataFrame, segment: str) -> DataFrame:
    """Population by segment value and year; ``tot`` gives yearly totals."""
    by = ["year"] if segment == "tot" else [segment, "year"]
    return pop.groupBy(*by).agg(strict_sum(F.col("pop")).alias("pop"))
