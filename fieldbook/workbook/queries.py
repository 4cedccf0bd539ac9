"""One registered query per operator, over the license tables derived from the star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldbook.functions import quarter_by_breaks, relative_month, short_fips
from fieldbook.operators import checks, dashboard as D, dive, geography, history as H, metrics as M
from fieldbook.operators import permissions as P, population as N, sampling, segments as G, views
from fieldbook.plans import dashboard as plan, update
from fieldbook.plans.dive import hist_samp
from fieldbook.plans.history import build_history, permission_sales
from fieldbook.schemas import SCALEUP_PERCENT, SEGMENTS
from fieldbook.session import fresh_path, stage
from fieldbook.sources import loaders as L, writers
from fieldbook.sources.snapshots import Snapshots
from fieldbook.sources.star_adapter import (
    CURRENT_QUARTER, DASHBOARD_YEARS, RULES, SAMPLE_SEED, STATE, YEARS, StarAdapter,
)
from fieldbook.sources.store import DerivedStore, FileStore, load_table

SELECT_QUARTERS = (2, 4)
MONTH_YEARS = (min(DASHBOARD_YEARS) - 1, *DASHBOARD_YEARS)
SAMPLE_PCT = 10
BUCKETS = 16
PERM = ("permission",)
RULE = {rule.name: rule for rule in RULES}


HUNTING = ("hunt", "combo", "trap")
SPACED_RULES = (
    P.PermissionRule("all hunt", "type", HUNTING),
    P.PermissionRule("any deer", "priv", ("deer",), parent="all hunt"),
)
RESIDENCY_RULES = (
    P.PermissionRule("home_hunt", "type", HUNTING, res_type="Resident"),
    P.PermissionRule("away_hunt", "type", HUNTING, res_type="Nonresident"),
)


class Desk:
    """Frames that queries share; nothing runs until a query needs it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.star = StarAdapter(spark, sf_dir)
        self.store = self.star.store()

    @cached_property
    def cust(self) -> DataFrame:
        return L.load_cust(self.store)

    @cached_property
    def lic(self) -> DataFrame:
        return self.star.lic()

    @cached_property
    def sale(self) -> DataFrame:
        return L.load_license(self.store, YEARS).sale

    @cached_property
    def permission(self) -> DataFrame:
        return self.store.table("permission")

    @cached_property
    def counties(self) -> DataFrame:
        return L.load_counties(self.store, STATE)

    @cached_property
    def county_map(self) -> DataFrame:
        return L.get_county_map(self.store, STATE)

    @cached_property
    def full_fips_map(self) -> DataFrame:
        return L.get_county_map_dive(self.store, STATE, drop_state_code=False)

    @cached_property
    def perm_sales(self) -> DataFrame:
        return permission_sales(self.sale, self.lic, RULES)

    @cached_property
    def history(self) -> DataFrame:
        """Lazy history, for queries that consume it once."""
        return build_history(self.sale, self.lic, RULES, YEARS)

    @cached_property
    def stored_history(self) -> DataFrame:
        """History written once, for plans that consume it more than once."""
        return stage(self.history, "history")

    @cached_property
    def dashboard_history(self) -> DataFrame:
        """As ``stored_history``, with the look-ahead month that partial-year runs use."""
        return stage(build_history(self.sale, self.lic, RULES, YEARS, look_ahead=True), "history")

    @cached_property
    def recoded(self) -> DataFrame:
        return plan.recoded_history(self.history, self.cust, self.counties)

    @cached_property
    def pop(self) -> DataFrame:
        return N.prep_pop(L.load_pop(self.store, STATE), YEARS).join(self.counties, "county_fips", "left")

    def cut(self, history: DataFrame, select_quarter: int) -> DataFrame:
        """Step-by-step partial-year flow."""
        rows = H.quarterly_filter(history, CURRENT_QUARTER, select_quarter, YEARS)
        at_hand = H.years_at_hand(YEARS, CURRENT_QUARTER, select_quarter)
        return H.quarterly_lapse(rows, select_quarter, at_hand, PERM)

    def one(self, group: str, select_quarter: int) -> DataFrame:
        """Recoded history of one permission cut to a quarter, stored as it is used repeatedly."""
        rows = self.recoded.filter(F.col("permission") == group)
        return stage(self.cut(rows, select_quarter).drop("permission"), f"{group}-{select_quarter}")

    def sale_months(self, group: str, select_quarter: int) -> DataFrame:
        sale = L.load_sale(self.store, MONTH_YEARS)
        months = P.sale_group(sale, L.load_lic_ids(self.store, group))
        months = months.withColumn("quarter", H.month_to_quarter(F.col("month")))
        return H.quarterly_filter(months, CURRENT_QUARTER, select_quarter, YEARS)

    def metrics(self, group: str, select_quarter: int, res_type: str | None = None) -> DataFrame:
        history = self.one(group, select_quarter)
        parent = RULE[group].parent
        ref = D.calc_part(self.one(parent, select_quarter)) if parent else None
        out = D.calc_metrics(
            history, self.pop, self.sale_months(group, select_quarter), DASHBOARD_YEARS, ref, res_type
        )
        return tidy(out)

    def dashboard_all(self) -> DataFrame:
        out = plan.dashboard_all(
            self.dashboard_history, self.cust, self.counties, self.pop,
            L.load_sale(self.store, MONTH_YEARS), self.permission,
            RULES, YEARS, CURRENT_QUARTER, SELECT_QUARTERS, DASHBOARD_YEARS,
        )
        return tidy(out)

    def dashboard_of(self, rules) -> DataFrame:
        """The dashboard of other permissions."""
        history = stage(build_history(self.sale, self.lic, rules, YEARS, look_ahead=True), "history")
        out = plan.dashboard_all(
            history, self.cust, self.counties, self.pop, L.load_sale(self.store, MONTH_YEARS),
            P.permission_table(self.lic, rules), rules, YEARS, CURRENT_QUARTER, SELECT_QUARTERS, DASHBOARD_YEARS,
        )
        return tidy(out)

    @cached_property
    def stored_dashboard(self) -> DataFrame:
        return stage(self.dashboard_all(), "dashboard")

    @cached_property
    def samp(self) -> DataFrame:
        return hist_samp(self.stored_history, self.cust, self.full_fips_map, SAMPLE_PCT, SAMPLE_SEED)

    def priv_samp(self, priv: str) -> DataFrame:
        return self.samp.filter(F.col("priv") == priv)


def tidy(df: DataFrame, column: str = "value", digits: int = 9) -> DataFrame:
    """Floating results depend on summation order in the last digits."""
    return df.withColumn(column, F.round(column, digits))


def _history_roundtrip(d: Desk) -> DataFrame:
    """Write all permissions, rewrite one, read back."""
    root = fresh_path(d.spark, "roundtrip")
    stored = d.stored_history
    writers.write_history(stored, f"{root}/history")
    deer = stored.filter("permission = 'deer'").drop("permission")
    writers.write_history(deer, f"{root}/history", "deer")
    return load_table(FileStore(d.spark, root), "history").select(*stored.columns)


def _load_history(d: Desk) -> DataFrame:
    path = fresh_path(d.spark, "load")
    writers.write_history(d.history, f"{path}/history")
    return L.load_history(FileStore(d.spark, path), "deer", DASHBOARD_YEARS)


def _history_emptied(d: Desk) -> DataFrame:
    """Write all permissions, rewrite one with no rows, read back."""
    root = fresh_path(d.spark, "emptied")
    stored = d.stored_history
    writers.write_history(stored, f"{root}/history")
    writers.write_history(stored.filter("permission = 'none'").drop("permission"), f"{root}/history", "deer")
    return load_table(FileStore(d.spark, root), "history").select(*stored.columns)


def _odd_name_emptied(d: Desk) -> DataFrame:
    """A permission whose name a path must spell otherwise, written and emptied; the others stay."""
    root = fresh_path(d.spark, "odd")
    stored = d.stored_history
    odd = stored.filter("permission = 'deer'").drop("permission")
    writers.write_history(stored, f"{root}/history")
    writers.write_history(odd, f"{root}/history", "deer: bow/50%")
    writers.write_history(odd.filter("year > 1999"), f"{root}/history", "trout")
    writers.write_history(odd.limit(0), f"{root}/history", "deer: bow/50%")
    return load_table(FileStore(d.spark, root), "history").select(*stored.columns)


def _snapshot_commit(d: Desk) -> DataFrame:
    """Rows and license types of each permission before a change, while its data is written but not committed, and after."""
    store = Snapshots(d.spark, fresh_path(d.spark, "store"))
    change = store.begin()
    change.replace("history", d.history, "permission", list(RULE))
    change.replace("permission", d.permission, "permission", list(RULE))
    change.commit()

    def seen(state: str) -> DataFrame:
        history = store.table("history").groupBy("permission").agg(F.count(F.lit(1)).alias("n"), F.sum("cust_id").alias("total"))
        types = store.table("permission").groupBy("permission").agg(F.count(F.lit(1)).alias("n"), F.sum("lic_id").alias("total"))
        rows = history.select(F.lit("history").alias("part"), "*").unionByName(types.select(F.lit("licenses").alias("part"), "*"))
        return stage(rows.select(F.lit(state).alias("state"), "*"), "seen")

    states = [seen("before")]
    late = store.table("history").filter("permission = 'deer' and year >= 2000")
    for state in ("killed", "after"):
        change = store.begin()
        change.replace("history", late, "permission", ["deer", "youth_deer"])
        change.replace("permission", d.permission.filter("permission = 'deer' and lic_id % 2 = 0"), "permission", ["deer", "youth_deer"])
        if state == "after":  # the first of both writers stops before its commit
            change.commit()
        states.append(seen(state))
    return states[0].unionByName(states[1]).unionByName(states[2])


def _history_by_season(d: Desk) -> DataFrame:
    """History after each of three seasons was added to the state of the years before."""
    state = stage(update.season_state(permission_sales(d.sale.filter("year < 1999"), d.lic, RULES, known=False), range(1995, 1999)), "state")
    out = []
    for year in (1999, 2000, 2001):
        new = update.season_state(permission_sales(d.sale.filter(F.col("year") == year), d.lic, RULES, known=False), [year])
        state = stage(update.merge_states(state, new), "state")
        out.append(update.history_of(state, range(1995, year + 1)).withColumn("through", F.lit(year)))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _dashboard_by_quarter(d: Desk) -> DataFrame:
    """A dashboard made in quarter 1 and brought up to date with what was sold since."""
    store = Snapshots(d.spark, fresh_path(d.spark, "store"))
    since = (F.col("year") == max(YEARS)) & (F.col("month") > 3)
    for quarter, sold in ((1, ~since), (CURRENT_QUARTER, since)):
        update.advance(store, d.sale.filter(sold), d.lic, d.cust, d.counties, RULES, YEARS, quarter, SELECT_QUARTERS)
    return tidy(update.dashboard_of_store(store, d.pop, RULES, DASHBOARD_YEARS, MONTH_YEARS))


def _stored_permissions(d: Desk) -> FileStore:
    """History and license types as files, by permission."""
    root = fresh_path(d.spark, "chosen")
    writers.write_history(d.history, f"{root}/history")
    d.permission.write.parquet(f"{root}/permission")
    return FileStore(d.spark, root)


def _load_histories(d: Desk) -> DataFrame:
    """Histories of all permissions that a license type for trout belongs to."""
    store = _stored_permissions(d)
    return L.load_histories(store, L.permissions_of(store, d.lic.filter("priv = 'trout' and duration > 1")), DASHBOARD_YEARS)


def _scaleup_exact(d: Desk) -> DataFrame:
    """Residency, sex and age of all permissions, each adding up to the year's total."""
    total, out = M.est_part(d.recoded, "tot", PERM), None
    for segment in ("res", "sex", "agecat"):
        part = M.scaleup_part(M.est_part(d.recoded, segment, PERM), total, PERM, exact=True)
        part = part.select("permission", F.lit(segment).alias("segment"), F.col(segment).alias("category"), "year", "participants")
        out = part if out is None else out.unionByName(part)
    return out


def _county_of_point(d: Desk) -> DataFrame:
    """Every customer's place against the outlines, moved by a little so that no corner decides."""
    places = d.star.read("customer").selectExpr("c_custkey as cust_id", "c_acctbal / 100 + 0.003 as long", "((c_custkey * 7) % 9000) / 100 + 0.003 as lat")
    return geography.county_of_point(places, d.star.county_map().filter("county_fips % 4 = 1"), cell=8.0)


def _quarantine(d: Desk) -> tuple[DataFrame, DataFrame]:
    cust, lic = d.cust.filter("county_fips is not null"), d.lic.filter("lic_id % 7 <> 0")
    return checks.quarantine_sales(cust, lic, d.sale, max_year=2001, min_year=1997, months=range(1, 12), residencies=(1,))


def _quarantine_rows(d: Desk) -> DataFrame:
    return _quarantine(d)[1].withColumn("reasons", F.array_join("reasons", ","))


def _bucketed(d: Desk) -> DataFrame:
    """History and customers stored by customer, and joined as they lie."""
    names = {}
    for name, df in (("history", d.history), ("cust", d.cust)):
        path = fresh_path(d.spark, f"bucketed_{name}")
        names[name] = path.rpartition("/")[2].replace("-", "_")
        writers.write_bucketed(df, names[name], BUCKETS, path=path)
    return H.enrich_history(d.spark.table(names["history"]), d.spark.table(names["cust"]))


def _permission_emptied(d: Desk) -> DataFrame:
    """Trout loses all its license types."""
    return writers.upsert_permission(d.permission.limit(0), d.permission, ["trout"])


def _removed(d: Desk) -> DataFrame:
    """Counties, and whether a catalog table of them is still there after its removal."""
    table = fresh_path(d.spark, "counties").rpartition("/")[2].replace("-", "_")
    d.counties.write.saveAsTable(table)
    writers.remove_table(d.spark, table)
    return d.counties.withColumn("still_there", F.lit(d.spark.catalog.tableExists(table)))


def _permission_upsert(d: Desk) -> DataFrame:
    """Trout gains every fish license, ice fishing is new."""
    fish = P.pick_licenses(d.lic, RULE["fish"])
    new = writers.permission_rows(fish, "trout").unionByName(writers.permission_rows(fish, "ice fishing"))
    return writers.upsert_permission(new, d.permission)


def _dash_roundtrip(d: Desk) -> DataFrame:
    path = fresh_path(d.spark, "dash")
    writers.write_dash(d.stored_dashboard, path)
    schema = d.stored_dashboard.schema
    return d.spark.read.schema(schema).option("header", "true").csv(path).select(*schema.names)


def _foreign_keys(d: Desk) -> DataFrame:
    """Against all customers, and against those with a county."""
    located = d.cust.filter("county_fips is not null")
    return checks.check_foreign_keys(d.cust, d.lic, d.sale).unionByName(
        checks.check_foreign_keys(located, d.lic, d.sale)
    )


def _primary_keys(d: Desk) -> DataFrame:
    """Customer and license keys, and the sale id that repeats when an order holds several licenses."""
    sales = checks.check_primary_key(d.store.table("sale"), "sale", "raw_sale_id")
    return checks.check_primary_keys(d.cust, d.lic).unionByName(sales)


def _fips_integer(d: Desk) -> DataFrame:
    text = F.coalesce(F.col("county_fips").cast("string"), F.lit("unknown"))
    return checks.check_fips_integer(d.cust.withColumn("county_fips", text))


def _data_check(d: Desk) -> DataFrame:
    """Every check on a broken copy of the tables."""
    cust = d.cust.drop("sex").withColumn("county_fips", F.coalesce(F.col("county_fips") + 0.0, F.lit(0.5)))
    lic = d.lic.filter("lic_id % 7 <> 0")
    lic = lic.unionByName(lic.filter("lic_id % 10 = 1")).withColumn("type", F.when(F.col("type") != "trap", F.col("type")))
    sale = d.sale.withColumn("month", F.col("month") - 1)
    return checks.data_check(cust, lic, sale, max_year=2001, residencies=(1,))


def _drop_na(d: Desk) -> DataFrame:
    return P.drop_na_custid(d.sale).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def _relative_month(d: Desk) -> DataFrame:
    month = relative_month(F.col("dot"), F.col("year"))
    return d.store.table("sale").groupBy("year", month.alias("month")).agg(F.count(F.lit(1)).alias("n"))


def _quarters(d: Desk, rule) -> DataFrame:
    return d.sale.groupBy("month", rule(F.col("month")).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


def _county_from_zip(d: Desk) -> DataFrame:
    zips = d.star.read("customer").selectExpr("c_custkey as cust_id", "50000 + c_nationkey * 10 + c_custkey % 7 as zip")
    cust = d.cust.join(zips, "cust_id")
    crosswalk = cust.filter("county_fips is not null").groupBy("zip").agg(F.min("county_fips").alias("county_fips"))
    return geography.county_from_zip(cust, crosswalk)


def _county_map(d: Desk) -> DataFrame:
    """Outlines told by their number of vertices and their western and northern ends."""
    joined = geography.join_county_map(d.stored_dashboard, d.county_map, d.counties)
    ends = {"n_vertices": F.size("outline"), "west": F.array_min("outline.long"), "north": F.array_max("outline.lat")}
    return joined.withColumns({k: F.when(F.col("outline").isNotNull(), v) for k, v in ends.items()}).drop("outline")


def _permission_rules(d: Desk) -> DataFrame:
    return P.permission_table(d.lic, RULES)


def _staged_history(d: Desk) -> DataFrame:
    ranked = H.rank_sale(d.perm_sales, keys=PERM, with_lic_id=False)
    return H.make_history(ranked, YEARS, keys=PERM)


def _recruit_rows(d: Desk) -> DataFrame:
    return M.est_month(d.sale_months("deer", 2), d.one("deer", 2), use_recruits=True)


def _scaleup_sex(d: Desk) -> DataFrame:
    history = d.recoded
    return M.scaleup_part(M.est_part(history, "sex", PERM), M.est_part(history, "tot", PERM), PERM)


def _rates_sex(d: Desk) -> DataFrame:
    residents = d.recoded.filter("res = 'Resident'")
    return M.est_rate(M.est_part(residents, "sex", PERM), N.est_pop(d.pop, "sex"))


def _priv_rate(d: Desk) -> DataFrame:
    deer, hunt = D.calc_part(d.one("deer", 2)), D.calc_part(d.one("hunt", 2))
    return tidy(D.calc_priv_rate(deer, hunt), "rate")


def _part_rate(d: Desk) -> DataFrame:
    return tidy(D.calc_part_rate(D.calc_part(d.one("hunt", 2)), d.pop), "rate")


def _qa_scaleup(d: Desk) -> DataFrame:
    """At the default threshold, and at a low one that lists the segments with unknowns."""
    counts = stage(G.segment_counts(d.recoded, PERM, SEGMENTS), "counts")
    at = lambda t: D.qa_scaleup(counts, PERM, t).withColumn("threshold", F.lit(t))
    return tidy(at(SCALEUP_PERCENT).unionByName(at(3)), "pct_unknown")


def _hist_all(d: Desk) -> DataFrame:
    return d.samp


DIVE = dive.DiveSpec(
    "deer",
    down="sex",
    year=2000,
    selected={"res": ("Resident",), "sex": ("Male", "Female"), "R3": ("Renew", "Reactivate"), "age": ("25-34", "35-44")},
    pct=SAMPLE_PCT,
)


def _dive_query(d: Desk) -> DataFrame:
    samp = stage(d.samp, "samp")
    trend = dive.dive_trend(samp, DIVE).select(
        F.lit("trend").alias("part"), F.col("sex").alias("item"), "year", "value"
    )
    dist = dive.dive_distribution(samp, DIVE, "age").select(
        F.lit("age").alias("part"), F.col("age").alias("item"), F.lit(DIVE.year).alias("year"), F.col("pct").alias("value")
    )
    return tidy(trend.unionByName(dist))


def _trend_pivot(d: Desk) -> DataFrame:
    trend = dive.summarize_trend(d.priv_samp("all_sports"), "age", "sex", pct=SAMPLE_PCT)
    return dive.trend_grid(trend, "sex", dive.DEMOGRAPHICS["sex"])


def _dash_page(d: Desk, segment: str) -> DataFrame:
    return views.dash_slice(d.stored_dashboard, "hunt", 2).filter(F.col("segment") == segment)


_SEGMENT_QUERIES: dict[str, Callable[[Desk], DataFrame]] = {}
for _s in SEGMENTS:
    _SEGMENT_QUERIES[f"participants_{_s}"] = lambda d, s=_s: M.est_part(d.recoded, s, PERM)
    _SEGMENT_QUERIES[f"recruits_{_s}"] = lambda d, s=_s: M.est_recruit(d.recoded, s, PERM)
    _SEGMENT_QUERIES[f"churn_{_s}"] = lambda d, s=_s: tidy(M.est_churn(d.recoded, s, PERM), "churn")

QUERIES: dict[str, Callable[[Desk], DataFrame]] = {
    # sources
    "src_generic": lambda d: load_table(d.store, "sale", lambda t: t.filter("year = 2000").select("cust_id", "lic_id", "month")),
    "load_cust": lambda d: L.load_cust(d.store),
    "load_cust_standard": lambda d: L.load_cust_standard(d.store),
    "load_sale": lambda d: L.load_sale(d.store, MONTH_YEARS),
    "load_sale_standard": lambda d: L.load_sale_standard(d.store),
    "load_counties": lambda d: L.load_counties(d.store, STATE),
    "load_pop": lambda d: L.load_pop(d.store, STATE),
    "load_lic_ids": lambda d: L.load_lic_ids(d.store, "deer"),
    "load_history": _load_history,
    "load_histories": _load_histories,
    "load_license_sale": lambda d: L.load_license(d.store, MONTH_YEARS).sale,
    "cust_sample": lambda d: sampling.load_cust_samp(d.stored_history.filter("permission = 'all_sports'"), SAMPLE_PCT, SAMPLE_SEED),
    "cust_sample_hash": lambda d: sampling.load_cust_samp(
        d.history.filter("permission = 'all_sports'"), SAMPLE_PCT, SAMPLE_SEED, exact=False
    ),
    "county_map": lambda d: d.county_map,
    "county_map_dive": lambda d: L.get_county_map_dive(d.store, STATE),
    # sinks
    "write_history_roundtrip": _history_roundtrip,
    "write_history_empty": _history_emptied,
    "write_history_odd_name": _odd_name_emptied,
    "snapshot_commit": _snapshot_commit,
    "permission_upsert": _permission_upsert,
    "permission_upsert_empty": _permission_emptied,
    "remove_table": _removed,
    "write_dash_roundtrip": _dash_roundtrip,
    # checks
    "check_allowed_values": lambda d: checks.check_allowed_values(d.cust, d.lic, d.sale, max_year=2001),
    "check_foreign_keys": _foreign_keys,
    "check_primary_keys": _primary_keys,
    "check_fips_integer": _fips_integer,
    "data_check": _data_check,
    "quarantine_sales": _quarantine_rows,
    "quarantine_passed": lambda d: _quarantine(d)[0],
    "quarantine_counts": lambda d: checks.quarantine_counts(_quarantine(d)[1]),
    # filters, projections, scalar functions
    "sale_group": lambda d: P.sale_group(L.load_sale(d.store, YEARS), L.load_lic_ids(d.store, "deer")),
    "permission_rules": _permission_rules,
    "drop_na_custid": _drop_na,
    "relative_month": _relative_month,
    "month_to_quarter": lambda d: _quarters(d, H.month_to_quarter),
    "fiscal_quarter": lambda d: _quarters(d, quarter_by_breaks(2, 5, 8)),
    "recode_history": lambda d: d.recoded.drop("county_fips"),
    "quarterly_filter_q2": lambda d: H.quarterly_filter(d.recoded, CURRENT_QUARTER, 2, YEARS).select("permission", "cust_id", "year"),
    "quarterly_filter_ahead": lambda d: H.quarterly_filter(d.recoded, CURRENT_QUARTER, 3, YEARS).select("permission", "cust_id", "year"),
    "factor_age_acs": lambda d: N.factor_age_acs(L.load_pop(d.store, STATE), N.age_map(d.spark)),
    "age_acs_check": lambda d: N.age_acs_check(L.load_pop(d.store, STATE), N.age_map(d.spark)),
    "set_other_county_na": lambda d: geography.set_other_county_na(d.cust, d.full_fips_map),
    "set_nonres_county_na": lambda d: geography.set_nonres_county_na(
        d.history.join(d.cust, "cust_id", "left")
    ).select("permission", "cust_id", "year", "res", "county_fips"),
    "filter_demo_sex": lambda d: dive.filter_demo(d.samp, "sex", ["Male"]),
    "filter_demo_r3": lambda d: dive.filter_demo(d.samp, "R3", ["Renew", "Reactivate"]),
    "metrics_resident": lambda d: d.metrics("hunt", 2, "Resident"),
    "metrics_nonresident": lambda d: d.metrics("hunt", 2, "Nonresident"),
    "drop_state_code": lambda d: d.cust.select("cust_id", "county_fips", short_fips(F.col("county_fips")).alias("fips")),
    # joins
    "history_enriched": lambda d: H.enrich_history(d.history, d.cust, d.counties),
    "history_bucketed": _bucketed,
    "county_from_zip": _county_from_zip,
    "county_of_point": _county_of_point,
    "join_county_map": _county_map,
    "county_map_missing": lambda d: geography.county_map_missing(d.stored_dashboard, d.county_map, d.counties),
    # history
    "rank_sale": lambda d: H.rank_sale(d.perm_sales, keys=PERM),
    "make_history": _staged_history,
    "lapse": lambda d: H.add_lapse(_staged_history(d), YEARS, PERM).select("permission", "cust_id", "year", "lapse"),
    "r3": lambda d: H.add_r3(_staged_history(d), YEARS, PERM).select("permission", "cust_id", "year", "R3"),
    "history_all": lambda d: d.history,
    "history_incremental": _history_by_season,
    "quarterly_lapse": lambda d: d.cut(d.recoded, 2).select("permission", "cust_id", "year", "lapse"),
    "open_year_lapse": lambda d: H.forget_open_year_lapse(d.cut(d.recoded, 4), CURRENT_QUARTER, 4, YEARS).select(
        "permission", "cust_id", "year", "lapse"
    ),
    "deer_by_year": lambda d: views.people_by_year(d.history.filter("permission = 'deer'")),
    # population
    "aggregate_pop": lambda d: N.aggregate_pop(L.load_pop(d.store, STATE)),
    "extrapolate_pop": lambda d: tidy(N.extrapolate_pop(N.aggregate_pop(L.load_pop(d.store, STATE)), YEARS), "pop", 6),
    "qa_extrapolation": lambda d: tidy(N.extrapolation_check(N.aggregate_pop(L.load_pop(d.store, STATE)), YEARS), "growth"),
    "prep_pop": lambda d: tidy(N.prep_pop(L.load_pop(d.store, STATE), YEARS), "pop", 6),
    "est_pop_tot": lambda d: tidy(N.est_pop(d.pop, "tot"), "pop", 6),
    "est_pop_sex": lambda d: tidy(N.est_pop(d.pop, "sex"), "pop", 6),
    "est_pop_county": lambda d: tidy(N.est_pop(d.pop, "county"), "pop", 6),
    # metrics
    **_SEGMENT_QUERIES,
    "est_rate": lambda d: tidy(_rates_sex(d), "rate"),
    "rate_threshold": lambda d: tidy(M.rate_threshold(_rates_sex(d), 0.005), "rate"),
    "priv_rate": _priv_rate,
    "part_rate": _part_rate,
    "scaleup_sex": _scaleup_sex,
    "scaleup_exact": _scaleup_exact,
    "calc_part_exact": lambda d: D.calc_part(d.one("deer", 2), exact=True),
    "calc_part": lambda d: D.calc_part(d.one("deer", 2)),
    "month_participants": lambda d: M.est_month(d.sale_months("deer", 2)),
    "month_recruits": _recruit_rows,
    "calc_metrics": lambda d: d.metrics("hunt", 4),
    "dashboard": lambda d: D.format_metrics(d.metrics("deer", 2), 2, "deer"),
    "dashboard_all": lambda d: d.dashboard_all(),
    "dashboard_incremental": _dashboard_by_quarter,
    "dashboard_spaced_names": lambda d: d.dashboard_of(SPACED_RULES),
    "dashboard_all_residency": lambda d: d.dashboard_of(RESIDENCY_RULES),
    "fill_missing_months": lambda d: D.fill_missing_months(d.stored_dashboard),
    "fill_missing_categories": lambda d: D.fill_missing_categories(stage(d.dashboard_of(RESIDENCY_RULES), "dashboard")),
    "qa_year_change": lambda d: D.qa_year_change(d.stored_dashboard),
    "qa_scaleup": _qa_scaleup,
    # exploratory views
    "hist_samp": _hist_all,
    "trend_none": lambda d: dive.summarize_trend(d.priv_samp("all_sports"), pct=SAMPLE_PCT),
    "trend_sex_age": lambda d: dive.summarize_trend(d.priv_samp("all_sports"), "sex", "age", pct=SAMPLE_PCT),
    "trend_churn": lambda d: tidy(dive.summarize_trend(d.priv_samp("all_sports"), "sex", metric="churn")),
    "trend_pivot": _trend_pivot,
    "dist_age": lambda d: tidy(dive.distribution(d.priv_samp("all_sports"), "age"), "pct"),
    "county_dive": lambda d: dive.county_dive(
        d.priv_samp("all_sports").filter("year = 2000"), L.get_county_map_dive(d.store, STATE), pct=SAMPLE_PCT
    ),
    "county_dive_churn": lambda d: dive.county_dive(
        d.priv_samp("all_sports").filter("year = 1999"), L.get_county_map_dive(d.store, STATE), "churn"
    ),
    "dive_query": _dive_query,
    "dive_menu": lambda d: dive.dive_menu(d.samp),
    # dashboard views
    "month_view": lambda d: views.month_view(d.stored_dashboard),
    "dash_labels": lambda d: views.dash_labels(d.stored_dashboard),
    "dash_slice": lambda d: views.dash_slice(d.stored_dashboard, "hunt", 2),
    "dash_segment": lambda d: views.dash_segment(d.stored_dashboard, "Residency"),
    "month_compare": lambda d: views.month_compare(d.stored_dashboard, "hunt", 2, 2001),
    "county_view": lambda d: views.county_view(d.stored_dashboard, "hunt", 2, 2001),
    "value_grid": lambda d: views.value_grid(_dash_page(d, "Gender"), YEARS),
    "menu_options": lambda d: views.menu_options(d.stored_dashboard),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: query(Desk(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
