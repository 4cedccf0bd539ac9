"""Data checks.  Each returns violations as rows ``check, table, column, n_bad``; no rows means clean."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from fieldbook import schemas as S

_OUT = "check string, table string, column string, n_bad long"


def missing_columns(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Required columns that ``df`` lacks; decided from the schema alone."""
    rows = [("required_column", table, c, 1) for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, _OUT)


def _count_bad(df: DataFrame, check: str, table: str, bad: dict[str, Column]) -> DataFrame:
    """All conditions of a table in one scan, then one row per violated column."""
    if not bad:
        return df.sparkSession.createDataFrame([], _OUT)
    counts = df.agg(*[F.count_if(condition).alias(c) for c, condition in bad.items()])
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(c).alias("n_bad"))
        for c in bad
    ]
    return counts.select(F.inline(F.array(*rows))).filter(F.col("n_bad") > 0)


def _outside(column: str, low: int, high: int, null_ok: bool = False) -> Column:
    value = F.col(column)
    return value.isNotNull() & ~value.between(low, high) | (F.lit(not null_ok) & value.isNull())


def _not_in(column: str, allowed: Collection, null_ok: bool = False) -> Column:
    value = F.col(column)
    if isinstance(allowed, range) and allowed.step == 1:
        return _outside(column, allowed.start, allowed.stop - 1, null_ok)
    return value.isNotNull() & ~value.isin(*allowed) | (F.lit(not null_ok) & value.isNull())


def check_allowed_values(
    cust: DataFrame,
    lic: DataFrame,
    sale: DataFrame,
    max_year: int,
    min_year: int = S.FIRST_SALE_YEAR,
    sexes: Collection[int] = tuple(S.SEX_LABELS),
    birth_years: Collection[int] | None = None,
    types: Collection[str] = S.LIC_TYPES,
    durations: Collection[int] = range(S.DURATIONS[0], S.DURATIONS[1] + 1),
    months: Collection[int] = range(S.SALE_MONTHS[0], S.SALE_MONTHS[1] + 1),
    residencies: Collection[int] = tuple(S.RES_LABELS),
) -> DataFrame:
    """Values outside the allowed sets; NULL is allowed for sex, birth year and residency only.

    ``max_year`` bounds sale and birth years, so a rerun gives the same answer later.  A table whose
    season starts earlier passes its own ``months``, such as ``range(-6, 13)``.  Columns that a table
    lacks are left out; ``missing_columns`` reports them.
    """
    if birth_years is None:
        birth_years = range(S.FIRST_BIRTH_YEAR, max_year + 1)
    parts = [
        ("cust", cust, {"sex": _not_in("sex", sexes, True), "birth_year": _not_in("birth_year", birth_years, True)}),
        ("lic", lic, {"type": _not_in("type", types), "duration": _not_in("duration", durations)}),
        (
            "sale",
            sale,
            {
                "year": _outside("year", min_year, max_year),
                "month": _not_in("month", months),
                "res": _not_in("res", residencies, True),
            },
        ),
    ]
    found = [
        _count_bad(df, "allowed_values", table, {c: bad for c, bad in checks.items() if c in df.columns})
        for table, df, checks in parts
    ]
    return reduce(DataFrame.unionByName, found)


def check_foreign_keys(cust: DataFrame, lic: DataFrame, sale: DataFrame) -> DataFrame:
    """Sales whose key has no match.

    Keys are counted before the anti join, so a key that is most of the sales crosses the shuffle as
    one row per map task.  A NULL key is not an orphan.
    """
    parts = [sale.sparkSession.createDataFrame([], _OUT)]
    for column, other in (("cust_id", cust), ("lic_id", lic)):
        if column not in sale.columns or column not in other.columns:
            continue
        used = sale.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        orphans = used.join(other.select(column), column, "left_anti")
        parts.append(
            orphans.agg(F.sum("n").alias("n_bad"))
            .filter("n_bad > 0")
            .select(F.lit("foreign_key").alias("check"), F.lit("sale").alias("table"), F.lit(column).alias("column"), "n_bad")
        )
    return reduce(DataFrame.unionByName, parts)


def quarantine_sales(
    cust: DataFrame,
    lic: DataFrame,
    sale: DataFrame,
    max_year: int,
    min_year: int = S.FIRST_SALE_YEAR,
    months: Collection[int] = range(S.SALE_MONTHS[0], S.SALE_MONTHS[1] + 1),
    residencies: Collection[int] = tuple(S.RES_LABELS),
) -> tuple[DataFrame, DataFrame]:
    """Sales in two parts: those to work with, and those that break a rule, with ``reasons``.

    Reasons are ``year``, ``month``, ``res`` (not an allowed value, as ``check_allowed_values``), ``cust_id`` and
    ``lic_id`` (no such row, as ``check_foreign_keys``; a NULL key is none).  A sale has all reasons it gives, in
    that order.  Both keys are probed in the pass that checks values, so sales are read once for either part; each
    key table is reduced to distinct keys, so no sale is multiplied.  Both parts have the columns of ``sale``; a
    rule on a column that ``sale`` lacks does not apply.
    """
    probed = sale
    for column, other in (("cust_id", cust), ("lic_id", lic)):
        if column in sale.columns:
            keys = other.select(column).filter(F.col(column).isNotNull()).distinct().withColumn(f"_has_{column}", F.lit(True))
            probed = probed.join(keys, column, "left")
    rules = {
        "year": _outside("year", min_year, max_year),
        "month": _not_in("month", months),
        "res": _not_in("res", residencies, True),
        "cust_id": F.col("cust_id").isNotNull() & F.col("_has_cust_id").isNull(),
        "lic_id": F.col("lic_id").isNotNull() & F.col("_has_lic_id").isNull(),
    }
    broken = [F.when(bad, F.lit(column)) for column, bad in rules.items() if column in sale.columns]
    tagged = probed.select(*sale.columns, F.array_compact(F.array(*broken)).alias("reasons"))
    return tagged.filter(F.size("reasons") == 0).select(*sale.columns), tagged.filter(F.size("reasons") > 0)


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    """The report of ``data_check`` on sales from their quarantined rows: ``check, table, column, n_bad``."""
    key = F.col("column").isin("cust_id", "lic_id")
    return (
        quarantined.select(F.explode("reasons").alias("column"))
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_bad"))
        .select(F.when(key, "foreign_key").otherwise("allowed_values").alias("check"), F.lit("sale").alias("table"), "column", "n_bad")
    )


def check_primary_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """``duplicate_key`` counts surplus rows, ``null_key`` rows without a key; nothing without the column."""
    if key not in df.columns:
        return df.sparkSession.createDataFrame([], _OUT)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)).alias("duplicate_key"),
        F.sum(F.when(F.col(key).isNull(), F.col("n"))).alias("null_key"),
    )
    rows = [
        F.struct(F.lit(c).alias("check"), F.lit(table).alias("table"), F.lit(key).alias("column"), F.col(c).alias("n_bad"))
        for c in ("duplicate_key", "null_key")
    ]
    return counts.select(F.inline(F.array(*rows))).filter(F.col("n_bad") > 0)


def check_primary_keys(cust: DataFrame, lic: DataFrame) -> DataFrame:
    return check_primary_key(cust, "cust", "cust_id").unionByName(check_primary_key(lic, "lic", "lic_id"))


def check_fips_integer(cust: DataFrame) -> DataFrame:
    """County codes that are not integers.

    A column of any other type than an integer one is one ``integer_fips_type`` row, whatever it holds;
    ``integer_fips`` counts its values that are no whole number.  An integer column passes without a scan.
    """
    spark = cust.sparkSession
    if "county_fips" not in cust.columns:
        return spark.createDataFrame([], _OUT)
    kind = cust.schema["county_fips"].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return spark.createDataFrame([], _OUT)
    code = F.col("county_fips").try_cast("double")
    whole = code.isNotNull() & (code == F.floor(code)) & (F.abs(code) <= 2147483647)
    return spark.createDataFrame([("integer_fips_type", "cust", "county_fips", 1)], _OUT).unionByName(
        _count_bad(cust, "integer_fips", "cust", {"county_fips": F.col("county_fips").isNotNull() & ~F.coalesce(whole, F.lit(False))})
    )


def data_check(
    cust: DataFrame, lic: DataFrame, sale: DataFrame, max_year: int, min_year: int = S.FIRST_SALE_YEAR, **allowed
) -> DataFrame:
    """Every check over the three tables, each on the columns that exist; ``allowed`` as in ``check_allowed_values``."""
    absent = reduce(
        DataFrame.unionByName,
        [
            missing_columns(cust, "cust", S.CUST_COLUMNS),
            missing_columns(lic, "lic", ("lic_id", "type", "duration")),
            missing_columns(sale, "sale", S.LICENSE_SALE_COLUMNS),
        ],
    )
    return reduce(
        DataFrame.unionByName,
        [
            absent,
            check_allowed_values(cust, lic, sale, max_year, min_year, **allowed),
            check_foreign_keys(cust, lic, sale),
            check_primary_keys(cust, lic),
            check_fips_integer(cust),
        ],
    )
