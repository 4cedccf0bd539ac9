"""Sinks: history and permission tables, dashboard csv files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook.functions import normalize_name
from fieldbook.session import delete_file, folder_exists
from fieldbook.sources.snapshots import Snapshots


def _files_of(df: DataFrame, path: str, named: Column, format: str, options: dict) -> list[str]:
    """Files that hold rows of the named groups now; told by the rows' own file names, however values are spelled in paths."""
    spark = df.sparkSession
    if not folder_exists(spark, path):
        return []
    stored = spark.read.schema(df.schema).format(format).options(**options).load(path)
    return [r[0] for r in stored.filter(named).select("_metadata.file_path").distinct().collect()]


def _replace_groups(
    df: DataFrame, path: str, keys: dict[str, Sequence], cluster: list[str], format: str = "parquet", **options
) -> None:
    """Replace the partitions of the groups named in ``keys`` (column to values), those without rows included.

    Partitions that get rows are overwritten; files that a named group had before and that are still there
    afterwards belong to groups without rows and are deleted, so a group written with no rows ends up with
    none.  ``df`` is evaluated once.  Rows of groups that are not named are an error.  The rebalance hint lets
    AQE split a key that holds much of the data over several files and merge small ones, instead of writing
    one file per task and partition.  Readers can meet the steps in between; ``snapshots`` has none.
    """
    spark = df.sparkSession
    names = list(keys)
    named = F.lit(True)
    for column, values in keys.items():
        named = named & F.col(column).isin(*values)
    unnamed = F.raise_error(F.concat(F.lit("row of a group that is not written: "), F.to_json(F.struct(*names)))).cast("boolean")
    before = _files_of(df, path, named, format, options)
    (
        df.filter(F.when(named, True).otherwise(unnamed))
        .hint("rebalance", *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*names)
        .format(format)
        .save(path)
    )
    for file in before:
        delete_file(spark, file)


def write_history(
    history: DataFrame,
    path: str,
    group: str | None = None,
    groups: Sequence[str] | None = None,
    lic_slct: DataFrame | None = None,
    permission_path: str | None = None,
) -> None:
    """Write history partitioned by permission, and with ``lic_slct`` the permission rows along with it.

    With ``group`` the rows belong to that one permission; otherwise they carry a ``permission``
    column and ``groups`` names the permissions written (those that occur, if it is not given).  A
    permission that is written is replaced whole, also by no rows at all; other permissions stay.
    ``lic_slct`` are the license types of ``group``, stored at ``permission_path``.  Rows are clustered
    by year, so a year filter can skip files by their statistics.
    """
    if group is not None:
        groups = [group]
        history = history.withColumn("permission", F.lit(normalize_name(group)))
    else:
        history = history.withColumn("permission", F.regexp_replace("permission", " ", "_"))
        if groups is None:
            groups = [row[0] for row in history.select("permission").distinct().collect()]  # one row per permission
    _replace_groups(history, path, {"permission": [normalize_name(g) for g in groups]}, ["permission", "year"])
    if lic_slct is not None:
        if group is None or permission_path is None:
            raise ValueError("license types are written for one group, to permission_path")
        write_permission(lic_slct, group, permission_path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str | Sequence[str] = "cust_id", path: str | None = None) -> None:
    """Catalog table bucketed and sorted by ``key``, stored at ``path`` if given.

    History and customers written with the same bucket count meet without a shuffle, in every later
    dashboard run.  The repartition matches the bucketing, so each bucket is one file.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (out if path is None else out.option("path", path)).saveAsTable(table)


def publish_history(store: Snapshots, history: DataFrame, group: str, lic_slct: DataFrame) -> int:
    """``write_history`` as one transaction: a permission's history and its license types change together or not at all."""
    name = normalize_name(group)
    change = store.begin()
    change.replace("history", history.withColumn("permission", F.lit(name)), "permission", [name])
    change.replace("permission", permission_rows(lic_slct, group), "permission", [name])
    return change.commit()


def permission_rows(lic_slct: DataFrame, group: str) -> DataFrame:
    """Rows of the permission table for the license types in ``lic_slct``."""
    return lic_slct.select(F.lit(normalize_name(group)).alias("permission"), "lic_id", "description")


def upsert_permission(new: DataFrame, old: DataFrame, groups: Sequence[str] | None = None) -> DataFrame:
    """``new`` replaces the permissions in ``groups`` (those it mentions, if not given); the other rows of ``old`` stay."""
    if groups is None:
        return new.unionByName(old.join(new.select("permission").distinct(), "permission", "left_anti"))
    return new.unionByName(old.filter(~F.col("permission").isin(*map(normalize_name, groups))))


def write_permission(lic_slct: DataFrame, group: str, path: str) -> None:
    """Replace one permission's rows in the stored table, also by none."""
    _replace_groups(permission_rows(lic_slct, group), path, {"permission": [normalize_name(group)]}, ["permission"])


def write_dash(
    dash: DataFrame, outdir: str, groups: Sequence[str] | None = None, quarters: Sequence[int] | None = None
) -> None:
    """Dashboard rows as csv with a header, one folder per group and quarter.

    ``groups`` and ``quarters`` name what is written; a combination without rows ends up empty.  What
    is not given are those that occur.
    """
    present = {c: [r[0] for r in dash.select(c).distinct().collect()] for c, given in (("group", groups), ("quarter", quarters)) if given is None}
    keys = {"group": groups or present.get("group", []), "quarter": quarters or present.get("quarter", [])}
    _replace_groups(dash, outdir, keys, ["group", "quarter"], format="csv", header="true")


def remove_table(spark: SparkSession, table_name: str, database: str = "default") -> None:
    """Drop a catalog table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table_name}`")
