"""Slices of the dashboard table that its pages show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def month_view(dash: DataFrame) -> DataFrame:
    """Month rows with the month as a number and the year as a label."""
    return (
        dash.filter(F.col("segment") == "month")
        .withColumn("category", F.col("category").try_cast("int"))
        .withColumn("year", F.col("year").cast("string"))
    )


def dash_labels(dash: DataFrame) -> DataFrame:
    """Lower-case metric and category; participants shortens to part."""
    metric = F.lower("metric")
    return dash.withColumn("category", F.lower("category")).withColumn(
        "metric", F.when(metric == "participants", "part").otherwise(metric)
    )


def dash_slice(dash: DataFrame, group: str, quarter: int) -> DataFrame:
    return dash.filter((F.col("group") == group) & (F.col("quarter") == quarter))


def dash_segment(dash: DataFrame, segment: str) -> DataFrame:
    """Rows of one segment, named in lower case as in the result."""
    return dash.withColumn("segment", F.lower("segment")).filter(F.col("segment") == segment.lower())


def month_compare(dash: DataFrame, group: str, quarter: int, year: int) -> DataFrame:
    """Month rows of a year and the year before."""
    rows = dash_slice(dash, group, quarter)
    return rows.filter((F.col("segment") == "month") & F.col("year").isin(year, year - 1))


def county_view(dash: DataFrame, group: str, quarter: int, year: int) -> DataFrame:
    """County rows of one page, all metrics."""
    rows = dash_slice(dash, group, quarter)
    return rows.filter((F.lower("segment") == "county") & (F.col("year") == year))


def value_grid(dash: DataFrame, years: Sequence[int]) -> DataFrame:
    """Metric and category by year for a single group, quarter and segment; column ``y<year>`` per year."""
    label = F.concat(F.lit("y"), F.col("year").cast("string"))
    return (
        dash.withColumn("_year", label)
        .groupBy("metric", "category")
        .pivot("_year", [f"y{y}" for y in years])
        .agg(F.first("value"))
    )


def menu_options(dash: DataFrame) -> DataFrame:
    """Choices of the page menus as ``menu, option``; years are those with county results."""
    choice = lambda name, column: F.struct(F.lit(name).alias("menu"), column.cast("string").alias("option"))
    year = F.when(F.lower("segment") == "county", F.col("year"))
    options = F.array(choice("quarter", F.col("quarter")), choice("group", F.col("group")), choice("year", year))
    return dash.select(F.inline(options)).filter(F.col("option").isNotNull()).distinct()


def people_by_year(history: DataFrame) -> DataFrame:
    """History rows per year, which are people."""
    return history.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
