"""Input of the exploratory views: history of a customer sample over all permissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.functions import age_category, label_res, label_sex, short_fips
from fieldbook.operators.geography import set_nonres_county_na, set_other_county_na
from fieldbook.operators.sampling import load_cust_samp


def hist_samp(
    history: DataFrame,
    cust: DataFrame,
    county_map: DataFrame,
    pct: float = 10,
    seed: int = 42,
    group: str = "all_sports",
    exact: bool = True,
) -> DataFrame:
    """``priv, cust_id, year, lapse, R3, res, sex, fips, age`` for sampled customers of ``group``.

    ``county_map`` (column ``fips`` holding the full code) tells which counties belong to the state.
    ``history`` is read twice, for the sample and for its rows, so it should be a stored table.
    """
    chosen = load_cust_samp(history.filter(F.col("permission") == group), pct, seed, exact)
    people = set_other_county_na(chosen.join(cust, "cust_id", "left"), county_map)
    # customers narrow history here, and each has a bounded number of rows
    rows = set_nonres_county_na(history.join(people, "cust_id"))
    return rows.select(
        F.col("permission").alias("priv"),
        "cust_id",
        "year",
        "lapse",
        "R3",
        label_res(F.col("res")).alias("res"),
        label_sex(F.col("sex")).alias("sex"),
        short_fips(F.col("county_fips")).alias("fips"),
        age_category(F.col("year") - F.col("birth_year")).alias("age"),
    )
