"""Reproducible customer samples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

_PREFIX = 4  # hex digits: 65,536 buckets


def _digest(seed: int) -> Column:
    return F.md5(F.concat(F.col("cust_id").cast("string"), F.lit(f":{seed}")))


def sample_by_hash(customers: DataFrame, pct: float = 10, seed: int = 42) -> DataFrame:
    """Each customer is kept with probability ``pct`` percent, decided from a digest of its id.

    Narrow: no shuffle, and a customer is in or out whatever else is in the table.
    """
    bucket = F.conv(F.substring(_digest(seed), 1, 8), 16, 10).cast("long")
    return customers.filter(bucket < int(pct / 100 * 2**32))


def sample_exact(customers: DataFrame, pct: float = 10, seed: int = 42) -> DataFrame:
    """Exactly ``round(n * pct / 100)`` of the distinct customers, each equally likely.

    These are the customers with the smallest digests.  Instead of sorting them all, customers are
    counted per digest prefix; whole buckets below the cut are kept and only the one bucket that the
    cut falls into is ranked.  The running count is over at most 65,536 rows.
    """
    hashed = customers.select("cust_id", _digest(seed).alias("_digest")).withColumn(
        "_bucket", F.substring("_digest", 1, _PREFIX)
    )
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    by_prefix = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_size").over(Window.partitionBy())
    cut = (
        sizes.withColumn("_upto", F.sum("_size").over(by_prefix))
        .withColumn("_wanted", F.round(total * (pct / 100)).cast("long"))
        .withColumn("_room", F.col("_wanted") - (F.col("_upto") - F.col("_size")))
        .filter(F.col("_room") > 0)
        .select("_bucket", "_room", (F.col("_room") >= F.col("_size")).alias("_whole"))
    )
    placed = hashed.join(cut, "_bucket")
    within = Window.partitionBy("_bucket").orderBy("_digest")
    whole = placed.filter("_whole").select("cust_id")
    partial = (
        placed.filter("not _whole")
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= F.col("_room"))
        .select("cust_id")
    )
    return whole.unionByName(partial)


def load_cust_samp(
    history: DataFrame, pct: float = 10, seed: int = 42, exact: bool = True, yrs: Iterable[int] | None = None
) -> DataFrame:
    """Sample of the customers in a permission's history, of the years ``yrs`` if given.

    Lazy.  The exact form reads the customers for the counts and again for the cut: ``history`` should
    be a stored table.
    """
    if yrs is not None:
        history = history.filter(F.col("year").isin(*yrs))
    customers = history.select("cust_id").distinct()
    return sample_exact(customers, pct, seed) if exact else sample_by_hash(customers, pct, seed)
