"""Where named tables come from.

Every loader takes a store and only ever sees a lazy DataFrame, so projections and filters reach the
scan whatever the storage is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class FileStore:
    """A directory of tables, one sub-directory or file per table name."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format(self.format).options(**self.options).load(f"{self.root}/{name}")


@dataclass(frozen=True)
class CatalogStore:
    """Tables of a catalog database."""

    spark: SparkSession
    database: str = "default"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")


@dataclass(frozen=True)
class JdbcStore:
    """Tables behind a JDBC url; the driver jar has to be on the classpath.

    ``options`` should carry ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    for big tables, otherwise one task reads the whole table.
    """

    spark: SparkSession
    url: str
    options: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=name, **self.options).load()


@dataclass(frozen=True)
class DerivedStore:
    """Tables computed on demand from other DataFrames."""

    makers: Mapping[str, Callable[[], DataFrame]]

    def table(self, name: str) -> DataFrame:
        return self.makers[name]()


def load_table(store, name: str, query: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Apply a caller-supplied query to a named table, lazily."""
    return query(store.table(name))
