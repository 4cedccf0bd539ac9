"""Loaders for the license, history and census tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from fieldbook import schemas as S
from fieldbook.functions import normalize_name, short_fips
from fieldbook.sources.store import load_table


class LicenseData(NamedTuple):
    cust: DataFrame
    lic: DataFrame
    sale: DataFrame


def load_cust(store) -> DataFrame:
    return load_table(store, "cust", lambda t: t.select(*S.CUST_COLUMNS))


def load_cust_standard(store) -> DataFrame:
    return load_table(store, "cust", lambda t: t.select(*S.CUST_STANDARD_COLUMNS))


def load_sale(store, yrs: Iterable[int]) -> DataFrame:
    return load_table(store, "sale", lambda t: t.filter(F.col("year").isin(*yrs)).select(*S.SALE_COLUMNS))


def load_sale_standard(store) -> DataFrame:
    return load_table(store, "sale", lambda t: t.select(*S.SALE_STANDARD_COLUMNS))


def load_counties(store, state: str) -> DataFrame:
    """County codes and names of one state."""
    return load_table(
        store,
        "county_fips",
        lambda t: t.filter(F.col("state_abbrev") == state).select(
            "county_fips", F.col("county_name").alias("county")
        ),
    )


def load_pop(store, state: str) -> DataFrame:
    """Population of one state; the long state name is dropped so only the abbreviation remains."""
    return load_table(store, "pop_acs", lambda t: t.drop("state").filter(F.col("state_abbrev") == state))


def load_lic_ids(store, group: str) -> DataFrame:
    """License ids of a permission, left as a DataFrame so the filter on sales can be a semi join."""
    return load_table(
        store, "permission", lambda t: t.filter(F.col("permission") == normalize_name(group)).select("lic_id")
    )


def load_history(store, group: str, yrs: Iterable[int]) -> DataFrame:
    """One permission's history; the permission prunes partitions of a table written by ``write_history``, the year is pushed to the scan."""
    return load_table(
        store,
        "history",
        lambda t: t.filter((F.col("permission") == normalize_name(group)) & F.col("year").isin(*yrs)).drop(
            "permission"
        ),
    )


def load_histories(store, chosen: DataFrame, yrs: Iterable[int]) -> DataFrame:
    """Histories of the permissions in ``chosen`` (column ``permission``), which may be any query.

    The names are not known when the plan is made.  The join hands them to the scan at run time, so only the
    partitions of permissions that turn up in ``chosen`` are read (dynamic partition pruning); permissions keep
    their column.  For that ``chosen`` has to be small or filtered, and history stored by permission.
    """
    wanted = chosen.select("permission").distinct()
    history = load_table(store, "history", lambda t: t.filter(F.col("year").isin(*yrs)))
    return history.join(wanted, "permission", "left_semi")


def permissions_of(store, lic_ids: DataFrame) -> DataFrame:
    """Permissions that any of the license types in ``lic_ids`` belongs to, for ``load_histories``."""
    return load_table(store, "permission").join(lic_ids.select("lic_id"), "lic_id", "left_semi").select("permission").distinct()


def load_license(
    store,
    yrs: Iterable[int],
    sale_cols: Sequence[str] = S.LICENSE_SALE_COLUMNS,
    cust_cols: Sequence[str] = S.CUST_COLUMNS,
) -> LicenseData:
    """Customer, license (all columns) and sale tables as lazy DataFrames."""
    return LicenseData(
        cust=load_table(store, "cust", lambda t: t.select(*cust_cols)),
        lic=load_table(store, "lic"),
        sale=load_table(store, "sale", lambda t: t.filter(F.col("year").isin(*yrs)).select(*sale_cols)),
    )


def get_county_map(store, state: str) -> DataFrame:
    """Polygon vertices of one state's counties, one row per vertex; ``seq`` carries the drawing order."""
    return load_table(
        store,
        "county_map",
        lambda t: t.filter(F.col("state") == state).select("long", "lat", "seq", "county", "county_fips"),
    )


def get_county_map_dive(store, state: str, drop_state_code: bool = True) -> DataFrame:
    """Vertices keyed by ``fips``, which is the county part alone unless ``drop_state_code`` is off."""
    code = F.col("county_fips")
    fips = short_fips(code) if drop_state_code else code
    return get_county_map(store, state).select(fips.alias("fips"), "county", "long", "lat", "seq")
