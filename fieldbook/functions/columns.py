"""Scalar and aggregate expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, functions as F

from fieldbook.schemas import AGE_BREAKS, RES_LABELS, SEX_LABELS, age_labels


def _labelled(code: Column, labels: dict[int, str]) -> Column:
    out = F.lit(None).cast("string")
    for value, text in labels.items():
        out = F.when(code == value, text).otherwise(out)
    return out


def label_sex(code: Column) -> Column:
    return _labelled(code, SEX_LABELS)


def label_res(code: Column) -> Column:
    return _labelled(code, RES_LABELS)


def age_category(age: Column, breaks=AGE_BREAKS) -> Column:
    """Age-category label; NULL for an unknown age or one below the first bound."""
    labels = age_labels(breaks)
    out = F.when(age < breaks[0], None)
    for upper, label in zip(breaks[1:], labels):
        out = out.when(age < upper, label)
    return out.when(age >= breaks[-1], labels[-1])


def quarter_by_breaks(first: int, second: int, third: int) -> Callable[[Column], Column]:
    """Month-to-quarter rule given the last month of quarters 1-3.

    Anything later, and an unknown month, falls in quarter 4.
    """

    def to_quarter(month: Column) -> Column:
        return F.when(month <= first, 1).when(month <= second, 2).when(month <= third, 3).otherwise(4)

    return to_quarter


month_to_quarter = quarter_by_breaks(3, 6, 9)


def relative_month(sold: Column, license_year: Column) -> Column:
    """Month counted from January of the license year: 0 is the December before, 13 the January after."""
    return (F.year(sold) - license_year) * 12 + F.month(sold)


def short_fips(fips: Column) -> Column:
    """County part of a state+county code; a code that is not 4 or 5 characters long is an error."""
    text = fips.cast("string")
    bad = F.raise_error(F.concat(F.lit("not a full county fips code: "), text)).cast("int")
    return F.when(text.isNull(), None).when(F.length(text).between(4, 5), F.substring(text, -3, 3).cast("int")).otherwise(bad)


def normalize_name(name: str) -> str:
    """Permission name as stored: spaces become underscores."""
    return name.replace(" ", "_")


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def strict_mean(value: Column) -> Column:
    """Mean that is NULL as soon as one input is NULL, from integer sums so it is order-independent."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value) / F.count(F.lit(1)))


def percent_churn(lapse: Column) -> Column:
    return strict_mean(lapse) * 100


def apportioned(value: str, total: Column, by: Sequence[str], category: str) -> Column:
    """Whole numbers in proportion to ``value`` that add up to ``total`` over the rows of each ``by``.

    Largest remainders: every row gets the whole part of its share, and the units left go to the largest
    remainders, ties to the first in order of ``category``.  In whole numbers throughout, so exact; NULL where
    nothing is known to share by.
    """
    rows = Window.partitionBy(*by)
    known = F.sum(value).over(rows)
    product = F.col(value) * total
    rest = F.when(known > 0, F.pmod(product, known))
    floor = F.round((product - rest) / known).cast("long")
    left = total - F.sum(floor).over(rows)
    place = F.row_number().over(rows.orderBy(rest.desc_nulls_last(), F.col(category)))
    return floor + F.when(place <= left, 1).otherwise(0)
