"""Permissions (sets of license types) and the sales that belong to them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from fieldbook.functions import normalize_name
from fieldbook.schemas import RES_LABELS


@dataclass(frozen=True)
class PermissionRule:
    """License types with ``column`` in ``values`` form the permission.

    ``parent`` names the permission a privilege rate is measured against; without one the rate is
    measured against population.  Both names are held as they are stored, with underscores for spaces.
    ``res_type`` limits its history to residents or nonresidents; monthly sales are not limited.
    """

    name: str
    column: str
    values: tuple[str, ...]
    parent: str | None = None
    res_type: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "name", normalize_name(self.name))
        if self.parent is not None:
            object.__setattr__(self, "parent", normalize_name(self.parent))
        if self.res_type not in (None, *RES_LABELS.values()):
            raise ValueError(f"res_type is none of {tuple(RES_LABELS.values())}: {self.res_type}")

    def matches(self) -> Column:
        return F.col(self.column).isin(*self.values)


def pick_licenses(lic: DataFrame, rule: PermissionRule) -> DataFrame:
    """License types of one permission."""
    return lic.filter(rule.matches())


def permission_licenses(lic: DataFrame, rules: Sequence[PermissionRule]) -> DataFrame:
    """License types tagged with each permission they belong to, in one pass over ``lic``."""
    tags = [F.when(rule.matches(), rule.name) for rule in rules]
    return lic.withColumn("permission", F.explode(F.array_compact(F.array(*tags))))


def permission_table(lic: DataFrame, rules: Sequence[PermissionRule]) -> DataFrame:
    return permission_licenses(lic, rules).select("permission", "lic_id", "description")


def sale_group(sale: DataFrame, lic_ids: DataFrame) -> DataFrame:
    """Distinct customer-year-months among the sales of one permission."""
    return sale.join(lic_ids, "lic_id", "left_semi").select("cust_id", "year", "month").distinct()


def sale_groups(sale: DataFrame, permission: DataFrame) -> DataFrame:
    """``sale_group`` for every permission at once.

    The distinct runs map-side first, so a customer with very many sales shuffles at most one row per
    permission and month.  A license type that is most of the sales is split by AQE's skew join, or
    not shuffled at all when the license table is small enough for Spark to broadcast.
    """
    return (
        sale.join(permission.select("permission", "lic_id"), "lic_id")
        .select("permission", "cust_id", "year", "month")
        .distinct()
    )


def drop_na_custid(sale: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Sales with a known customer.

    With an ``observation`` the number dropped is reported as ``missing_cust_id`` by whatever action
    runs the result, without a pass of its own.
    """
    if observation is not None:
        sale = sale.observe(observation, F.count_if(F.col("cust_id").isNull()).alias("missing_cust_id"))
    return sale.filter(F.col("cust_id").isNotNull())
