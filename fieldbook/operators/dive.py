"""Exploratory views over a sample of history: filters, trends, distributions, county shading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.functions import percent_churn, strict_mean
from fieldbook.schemas import R3_LABELS, RES_LABELS, SEX_LABELS, age_labels

DEMOGRAPHICS = {
    "res": tuple(RES_LABELS.values()),
    "sex": tuple(SEX_LABELS.values()),
    "R3": R3_LABELS,
    "age": tuple(age_labels()),
}


def filter_demo(df: DataFrame, var: str, selected: Sequence[str], choices: Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``var`` is selected.

    Selecting everything filters nothing.  Unknown values stay, except for R3, which is only unknown
    in the first years.
    """
    choices = DEMOGRAPHICS[var] if choices is None else choices
    if set(selected) == set(choices):
        return df
    picked = F.col(var).isin(*selected)
    return df.filter(picked if var == "R3" else picked | F.col(var).isNull())


def _facets(down: str | None, across: str | None) -> list[str]:
    return [f for f in dict.fromkeys((down, across)) if f not in (None, "None")]


def summarize_trend(
    df: DataFrame,
    down: str | None = None,
    across: str | None = None,
    metric: str = "participants",
    pct: float = 10,
) -> DataFrame:
    """People (scaled up from a ``pct`` percent sample) or percent churn by year and up to two facets."""
    facets = _facets(down, across)
    groups = df.dropna(subset=facets) if facets else df
    groups = groups.groupBy(*facets, "year")
    if metric == "participants":
        return groups.agg((F.count(F.lit(1)) / (pct / 100)).alias("value"))
    return (
        groups.agg(percent_churn(F.col("lapse")).alias("value"))
        .withColumn("year", F.col("year") + 1)
        .filter(F.col("value").isNotNull())
    )


def trend_grid(trend: DataFrame, across: str, levels: Sequence[str]) -> DataFrame:
    """Trend with one column per level of ``across``; the levels are given, so no extra job runs."""
    rest = [c for c in trend.columns if c not in (across, "value")]
    return trend.groupBy(*rest).pivot(across, list(levels)).agg(F.first("value"))


def distribution(df: DataFrame, var: str) -> DataFrame:
    """Count and percent per value of ``var``, unknown included."""
    counts = df.groupBy(var).agg(F.count(F.lit(1)).alias("n"))
    # one row per category, so the unpartitioned total is over a handful of rows
    return counts.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def county_values(df: DataFrame, metric: str = "participants", pct: float = 10) -> DataFrame:
    """Value per county: scaled count, or churn in percent rounded to three digits."""
    groups = df.filter(F.col("fips").isNotNull()).groupBy("fips")
    if metric == "participants":
        return groups.agg((F.count(F.lit(1)) / (pct / 100)).alias("value"))
    return groups.agg(F.round(strict_mean(F.col("lapse")) * 100, 3).alias("value"))


def county_dive(df: DataFrame, county_map: DataFrame, metric: str = "participants", pct: float = 10) -> DataFrame:
    """``county_values`` with outlines, one row per vertex; a county without outline keeps one row."""
    return county_values(df, metric, pct).join(county_map, "fips", "left")


def dive_menu(samp: DataFrame) -> DataFrame:
    """Choices of the exploratory view as ``menu, option, ord``: permissions, and years latest first."""
    choice = lambda name, column, order: F.struct(
        F.lit(name).alias("menu"), column.cast("string").alias("option"), order.alias("ord")
    )
    options = F.array(
        choice("priv", F.col("priv"), F.lit(None).cast("int")), choice("year", F.col("year"), -F.col("year"))
    )
    return samp.select(F.inline(options)).distinct()


@dataclass(frozen=True)
class DiveSpec:
    """One state of the exploratory view's controls."""

    priv: str
    metric: str = "participants"
    down: str | None = None
    across: str | None = None
    year: int | None = None
    selected: Mapping[str, Sequence[str]] = field(default_factory=dict)
    pct: float = 10


def dive_input(samp: DataFrame, spec: DiveSpec) -> DataFrame:
    """Rows of the chosen permission after the demographic filters."""
    out = samp.filter(F.col("priv") == spec.priv)
    for var, selected in spec.selected.items():
        out = filter_demo(out, var, selected)
    return out


def dive_trend(samp: DataFrame, spec: DiveSpec) -> DataFrame:
    return summarize_trend(dive_input(samp, spec), spec.down, spec.across, spec.metric, spec.pct)


def dive_distribution(samp: DataFrame, spec: DiveSpec, var: str) -> DataFrame:
    return distribution(dive_input(samp, spec).filter(F.col("year") == spec.year), var)


def dive_county(samp: DataFrame, spec: DiveSpec, county_map: DataFrame) -> DataFrame:
    """County shading for the chosen year; churn shown in a year comes from the year before."""
    year = spec.year - 1 if spec.metric == "churn" else spec.year
    return county_dive(dive_input(samp, spec).filter(F.col("year") == year), county_map, spec.metric, spec.pct)
