"""Column-level building blocks; everything here stays inside JVM expressions."""

from fieldbook.functions.columns import (
    age_category,
    apportioned,
    label_res,
    label_sex,
    month_to_quarter,
    normalize_name,
    percent_churn,
    quarter_by_breaks,
    relative_month,
    short_fips,
    strict_mean,
    strict_sum,
)

__all__ = [
    "age_category",
    "apportioned",
    "label_res",
    "label_sex",
    "month_to_quarter",
    "normalize_name",
    "percent_churn",
    "quarter_by_breaks",
    "relative_month",
    "short_fips",
    "strict_mean",
    "strict_sum",
]
