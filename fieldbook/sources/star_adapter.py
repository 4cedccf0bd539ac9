"""License tables derived from a retail star schema (customer, orders, lineitem, part, nation).

A line item is a license sale, a part is a license type, a customer a license holder.  Only column
expressions and the joins that the star schema implies; each table scales with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldbook.operators.permissions import PermissionRule, permission_table
from fieldbook.operators.population import age_map
from fieldbook.sources.store import DerivedStore

RULES = (
    PermissionRule("all_sports", "type", ("fish", "hunt", "combo", "trap")),
    PermissionRule("hunt", "type", ("hunt", "combo", "trap")),
    PermissionRule("fish", "type", ("fish", "combo")),
    PermissionRule("deer", "priv", ("deer",), parent="hunt"),
    PermissionRule("trout", "priv", ("trout",), parent="fish"),
    PermissionRule("youth_deer", "subtype", ("youth_deer",), parent="deer"),
)

YEARS = tuple(range(1995, 2002))
CENSUS_YEARS = tuple(range(1995, 2000))
CURRENT_QUARTER = 2
DASHBOARD_YEARS = (2000, 2001)
STATE = "IA"
SAMPLE_SEED = 42

FIPS = "(case when c_nationkey < 22 then 19000 else 55000 end + 1 + 2 * c_nationkey)"
STATE_OF_NATION = "case when c_nationkey < 22 then 'IA' else 'WI' end"

# columns the adapter reads; given up front so that opening a table needs no look at its files
COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint",
}


class StarAdapter:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.root}/{name}.parquet")

    def cust(self) -> DataFrame:
        return (
            self.read("customer")
            .selectExpr(
                "*",
                "case when c_custkey % 20 = 0 then null when c_custkey % 2 = 1 then 1 else 2 end as sex",
                "case when c_custkey % 30 <> 3 then cast(1930 + (c_custkey * 7) % 75 as int) end as birth_year",
                f"case when c_custkey % 25 <> 4 then {FIPS} end as county_fips",
            )
            .selectExpr(
                "c_custkey as cust_id", "sex", "birth_year", "county_fips",
                "make_date(birth_year, 1, 1) as dob",
                "c_name as last",
                "c_mktsegment as first",
                f"{STATE_OF_NATION} as state",
                "case when c_custkey % 10 < 8 then 1 else 0 end as cust_res",
                "'2001-q2' as cust_period",
                "c_custkey as raw_cust_id",
            )
        )

    def lic(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey as lic_id",
            "p_name as description",
            """case when p_type in ('ECONOMY', 'MEDIUM') then 'fish' when p_type = 'STANDARD' then 'hunt'
               when p_type = 'PROMO' then 'combo' when p_type = 'SMALL' then 'trap' else 'other' end as type""",
            "case when p_size = 49 then 99 when p_size % 10 = 0 then 3 else 1 end as duration",
            """case when p_brand in ('Brand#1', 'Brand#2') then 'deer'
               when p_brand = 'Brand#4' then 'trout' end as priv""",
            "case when p_brand = 'Brand#1' then 'youth_deer' end as subtype",
        )

    def sale(self) -> DataFrame:
        orders = self.read("orders").selectExpr(
            "o_orderkey as raw_sale_id",
            "case when o_orderkey % 500 <> 0 then o_custkey end as cust_id",
            "cast(o_orderdate as date) as dot",
            "year(o_orderdate) + case when month(o_orderdate) = 12 then 1 else 0 end as year",
            """case when o_orderkey % 40 = 7 then null when o_custkey % 10 < 8 then 1 else 0 end as res""",
        )
        return (
            self.read("lineitem")
            .selectExpr("l_orderkey as raw_sale_id", "l_partkey as lic_id")
            .join(orders, "raw_sale_id")
            .selectExpr(
                "cust_id", "lic_id", "year",
                "(year(dot) - year) * 12 + month(dot) as month",
                "res", "dot",
                "make_date(year - 1, 12, 1) as start_date",
                "make_date(year, 11, 30) as end_date",
                "'2001-q2' as sale_period",
                "raw_sale_id",
            )
        )

    def permission(self) -> DataFrame:
        return permission_table(self.lic(), RULES)

    def county_fips(self) -> DataFrame:
        """Counties that have customers, named after the customer's nation."""
        homes = self.read("customer").select("c_nationkey").distinct()
        return homes.join(self._nations(), "c_nationkey").selectExpr(
            f"{FIPS} as county_fips", "n_name as county_name", f"{STATE_OF_NATION} as state_abbrev"
        )

    def _nations(self) -> DataFrame:
        return self.read("nation").selectExpr("n_nationkey as c_nationkey", "n_name")

    def pop_acs(self) -> DataFrame:
        """Population by county, year, sex and census age group: each customer stands for a neighbourhood."""
        people = (
            self.cust()
            .filter("county_fips is not null and sex is not null and birth_year is not null")
            .selectExpr(
                "state", "county_fips", "sex", "birth_year", "100 + cust_id % 50 as weight",
                f"explode(sequence({CENSUS_YEARS[0]}, {CENSUS_YEARS[-1]})) as year",
            )
            .withColumn("age_year", F.expr("year - birth_year"))
        )
        return (
            people.join(age_map(self.spark), "age_year")
            .groupBy("state", "county_fips", "year", "sex", "age", "age_acs")
            .agg(F.sum("weight").alias("pop"))
            .selectExpr(
                "case state when 'IA' then 'Iowa' else 'Wisconsin' end as state",
                "state as state_abbrev",
                "county_fips", "year", "sex", "age", "age_acs", "pop",
            )
        )

    def county_map(self) -> DataFrame:
        """Four-vertex outlines around the customers of each county; one county has no outline."""
        boxes = (
            self.read("customer")
            .filter("c_nationkey <> 5")
            .selectExpr("c_nationkey", "c_acctbal / 100 as x", "((c_custkey * 7) % 9000) / 100 as y")
            .groupBy("c_nationkey")
            .agg(F.min("x").alias("w"), F.max("x").alias("e"), F.min("y").alias("s"), F.max("y").alias("n"))
            .join(self._nations(), "c_nationkey")
        )
        return boxes.selectExpr(
            f"{STATE_OF_NATION} as state",
            "case when c_nationkey < 22 then 'Iowa' else 'Wisconsin' end as state_name",
            f"{FIPS} as county_fips",
            "n_name as county",
            """inline(array(struct(1 as seq, w as long, s as lat), struct(2 as seq, e as long, s as lat),
                            struct(3 as seq, e as long, n as lat), struct(4 as seq, w as long, n as lat)))""",
        )

    def store(self) -> DerivedStore:
        names = ("cust", "lic", "sale", "permission", "county_fips", "pop_acs", "county_map")
        return DerivedStore({name: getattr(self, name) for name in names})
