"""History operators against hand-worked rows and against a plain-Python model on random sales."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import history as H
from fieldbook.operators.permissions import PermissionRule
from fieldbook.plans.history import build_history, history_from_sales, permission_sales

SALE = "cust_id long, lic_id long, year int, month int, res int, duration int"


def test_rank_sale_order(spark):
    sale = spark.createDataFrame(
        [
            (1, 10, 2010, 5, 0, 1), (1, 11, 2010, 7, 1, 1),      # resident outranks nonresident
            (2, 10, 2010, 3, 1, 1), (2, 12, 2010, 9, None, 3),   # duration outranks residency
            (3, 13, 2010, 0, None, 1), (3, 14, 2010, 13, 0, 1),  # unknown residency ranks last
            (4, 16, 2010, 2, 1, 1), (4, 15, 2010, 2, 1, 1),      # lowest license id breaks the tie
            (5, 17, 2010, 8, 1, 1), (5, 18, 2010, -1, 1, 1),     # earlier month wins
        ],
        SALE,
    )
    out = H.rank_sale(sale).select("cust_id", "lic_id", "duration", "res", "month")
    assert rows(out) == [(1, 11, 1, 1, 5), (2, 12, 3, None, 3), (3, 14, 1, 0, 0), (4, 15, 1, 1, 2), (5, 18, 1, 1, -1)]
    own_month = H.rank_sale(sale, first_month=False).select("cust_id", "month")
    assert rows(own_month) == [(1, 7), (2, 9), (3, 13), (4, 2), (5, -1)]


@pytest.mark.parametrize("first_month", [True, False])
def test_rank_in_one_long_equals_struct(spark, first_month):
    sales = random_sales(21, list(range(2000, 2004))) + [(77, 1, 2000, None, 1, 1), (78, 1, 2000, None, None, 1), (78, 2, 2000, 4, None, 1)]
    frame = spark.createDataFrame(sales, SALE)
    short = H.rank_sale(frame, first_month=first_month, with_lic_id=False)
    full = H.rank_sale(frame, first_month=first_month).drop("lic_id")
    assert rows(short) == rows(full.select(short.columns))
    if first_month:
        assert "SortAggregate" not in short._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("first_month, with_id", [(True, True), (False, True), (False, False)])
def test_rank_sale_against_sorted_sales_without_a_sort(spark, first_month, with_id):
    """Missing and extreme values, ties and repeated sales; no task sorts its sales."""
    rng = random.Random(31)
    low, high = -(2**31), 2**31 - 1
    pick = lambda *values: rng.choice(values)
    sales = [
        (rng.randrange(60), pick(None, 1, 2, 3, -4, 2**62), 2000, pick(None, low + 1, -1, 0, 5, high), pick(None, low + 1, 0, 1, high), pick(None, low + 1, 0, 1, 99, high))
        for _ in range(600)
    ]
    out = H.rank_sale(spark.createDataFrame(sales, SALE), first_month=first_month, with_lic_id=with_id)
    want = []
    up, down = (lambda v: (v is not None, v or 0)), (lambda v: (v is not None, -(v or 0)))
    for cust in {s[0] for s in sales}:
        own = [s for s in sales if s[0] == cust]
        best = max(own, key=lambda s: (up(s[5]), up(s[4]), down(s[3]), down(s[1])))
        months = [s[3] for s in own if s[3] is not None]
        month = min(months, default=None) if first_month else best[3]
        want.append((cust, 2000, best[5], best[4], month) + ((best[1],) if with_id else ()))
    columns = ["cust_id", "year", "duration", "res", "month"] + ["lic_id"] * with_id
    assert out.columns == columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_both_forms_of_history_agree_on_odd_sales(spark):
    """Residency codes beyond 0 and 1, missing and zero durations, and sales before the years asked for."""
    odd = [(1, 1, 1997, 3, 1, 3), (1, 2, 2001, 4, 2, None), (1, 3, 2001, 5, 0, 0), (2, 1, 2000, 6, 2, 0), (2, 2, 2000, 7, 1, None)]
    odd += [(3, 1, 1999, 1, None, 99), (3, 2, 2002, 2, -1, 2), (4, 1, 2001, None, 3, -2), (4, 2, 2001, 1, 1, 1)]
    odd = [(900 + c, *rest) for c, *rest in odd]
    frame = spark.createDataFrame(random_sales(8, list(range(1998, 2004))) + odd, SALE).withColumn("permission", F.lit("p"))
    yrs, keys = range(2000, 2004), ("permission",)
    columns = ["permission", "cust_id", "year", "duration_run", "month", "res"]
    fused = history_from_sales(frame, yrs).select(*columns)
    for with_id in (False, True):
        steps = H.make_history(H.rank_sale(frame, keys=keys, with_lic_id=with_id), yrs, keys=keys).select(*columns)
        assert rows(steps) == rows(fused)
    assert {r.year for r in fused.collect()} <= set(yrs)
    assert {r.res for r in fused.collect()} >= {2, -1}


def test_lapse_after_a_cut_looks_at_the_next_row_only(spark):
    """A three-year license followed by a late sale counts as lapsed at quarter 2; see the README on this definition."""
    sale = spark.createDataFrame([(1, 1, 2000, 2, 1, 3), (1, 1, 2001, 11, 1, 1)], SALE).withColumn("permission", F.lit("p"))
    history = history_from_sales(sale, range(2000, 2003)).withColumn("quarter", H.month_to_quarter(F.col("month")))
    cut = H.quarterly_lapse(H.quarterly_filter(history, 4, 2, range(2000, 2003)), 2, range(2000, 2003), ("permission",))
    assert {(r.year, r.lapse) for r in cut.collect()} == {(2000, 1), (2002, None)}


def test_make_history_cover(spark):
    ranked = spark.createDataFrame(
        [(1, 2010, 3, 1, 4), (1, 2011, 1, 0, 6), (2, 2010, 99, 1, 2), (3, 2012, 1, None, 5)],
        "cust_id long, year int, duration int, res int, month int",
    )
    out = H.make_history(ranked, range(2010, 2014)).select("cust_id", "year", "duration_run", "month", "res")
    assert rows(out) == [
        (1, 2010, 3, 4, 1), (1, 2011, 2, 6, 0), (1, 2012, 1, 4, 1),
        (2, 2010, 99, 2, 1), (2, 2011, 98, 2, 1), (2, 2012, 97, 2, 1), (2, 2013, 96, 2, 1),
        (3, 2012, 1, 5, None),
    ]


def test_lapse_and_r3(spark):
    years = {1: [2001, 2006], 2: [2000, 2006], 3: [2005, 2006, 2007], 4: [2007], 5: [2000, 2004, 2006]}
    history = spark.createDataFrame([(c, y) for c, ys in years.items() for y in ys], "cust_id long, year int")
    yrs = range(2000, 2008)
    lapse = {(r.cust_id, r.year): r.lapse for r in H.add_lapse(history, yrs).collect()}
    assert lapse == {
        (1, 2001): 1, (1, 2006): 1, (2, 2000): 1, (2, 2006): 1, (3, 2005): 0, (3, 2006): 0, (3, 2007): None,
        (4, 2007): None, (5, 2000): 1, (5, 2004): 1, (5, 2006): 1,
    }
    r3 = {(r.cust_id, r.year): r.R3 for r in H.add_r3(history, yrs).collect()}
    assert r3 == {
        (1, 2001): None, (1, 2006): "Reactivate", (2, 2000): None, (2, 2006): "Recruit",
        (3, 2005): "Recruit", (3, 2006): "Renew", (3, 2007): "Renew", (4, 2007): "Recruit",
        (5, 2000): None, (5, 2004): None, (5, 2006): "Reactivate",
    }
    short = H.add_r3(history.filter("year < 2005"), range(2000, 2005))
    assert all(r.R3 is None for r in short.collect())


def model(sales, yrs):
    """History of (cust, lic, year, month, res, duration) rows, one customer at a time."""
    yrs, out = sorted(yrs), {}
    for cust in {s[0] for s in sales}:
        ranked = {}
        for y in yrs:
            mine = [s for s in sales if s[0] == cust and s[2] == y]
            if mine:
                best = max(mine, key=lambda s: (s[5], -1 if s[4] is None else s[4], -s[3], -s[1]))
                ranked[y] = (best[5], best[4], min(s[3] for s in mine))
        for y in yrs:
            cover = [(s, *ranked[s]) for s in ranked if s <= y <= s + ranked[s][0] - 1]
            if cover:
                newest = max(cover)
                out[cust, y] = [max(s + d - y for s, d, *_ in cover), newest[3], newest[2]]
    for (cust, y), row in out.items():
        row.append(None if y == yrs[-1] else int((cust, y + 1) not in out))
        if y in yrs[:5]:
            row.append(None)
        elif (cust, y - 1) in out:
            row.append("Renew")
        else:
            row.append("Reactivate" if any((cust, y - k) in out for k in range(2, 6)) else "Recruit")
    return {(c, y, *row) for (c, y), row in out.items()}


def random_sales(seed, yrs, n=400):
    rng = random.Random(seed)
    # customer 0 holds a third of all sales
    return [
        (
            0 if rng.random() < 1 / 3 else rng.randrange(1, 60), rng.randrange(40), rng.choice(yrs),
            rng.randrange(-2, 16), rng.choice([0, 1, None]), rng.choice([1, 1, 1, 2, 3, 5, 99]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed,span", [(1, 3), (2, 7), (3, 9), (4, 25)])
def test_history_matches_model(spark, seed, span):
    yrs = list(range(2000, 2000 + span))
    sales = random_sales(seed, yrs)
    columns = ["cust_id", "year", "duration_run", "month", "res", "lapse", "R3"]
    frame = spark.createDataFrame(sales, SALE).withColumn("permission", F.lit("p"))
    want = model(sales, yrs)

    fused = history_from_sales(frame, yrs).select(*columns)
    assert {tuple(r) for r in fused.collect()} == want
    assert fused.count() == len(want)

    keys = ("permission",)
    steps = H.make_history(H.rank_sale(frame, keys=keys, with_lic_id=seed % 2 == 0), yrs, keys=keys)
    steps = H.add_r3(H.add_lapse(steps, yrs, keys), yrs, keys).select(*columns)
    assert {tuple(r) for r in steps.collect()} == want


def test_history_of_one_year(spark):
    frame = spark.createDataFrame([(1, 1, 2000, 4, 1, 2)], SALE).withColumn("permission", F.lit("p"))
    assert rows(history_from_sales(frame, [2000])) == [("p", 1, 2000, 2, None, None, 4, 1)]


def test_look_ahead_month(spark):
    yrs = list(range(2000, 2008))
    frame = spark.createDataFrame(random_sales(8, yrs), SALE).withColumn("permission", F.lit("p"))
    ahead = history_from_sales(frame, yrs, look_ahead=True)
    month = {(r.cust_id, r.year): r.month for r in ahead.collect()}
    assert all(r.next_month == month.get((r.cust_id, r.year + 1)) for r in ahead.collect())
    assert rows(ahead.drop("next_month")) == rows(history_from_sales(frame, yrs))


@pytest.mark.parametrize("current", [1, 2, 4])
def test_expand_quarters_equals_steps(spark, current):
    yrs = list(range(2000, 2007))
    frame = spark.createDataFrame(random_sales(11, yrs), SALE).withColumn("permission", F.lit("p"))
    for look_ahead in (False, True):
        base = history_from_sales(frame, yrs, look_ahead).withColumn("quarter", H.month_to_quarter(F.col("month")))
        batch = H.expand_quarters(base, current, (1, 2, 3, 4), yrs, ("permission",))
        for q in (1, 2, 3, 4):
            one = H.quarterly_filter(base.drop("next_month"), current, q, yrs)
            one = H.quarterly_lapse(one, q, H.years_at_hand(yrs, current, q), ("permission",))
            columns = ["cust_id", "year", "lapse", "R3", "month", "res"]
            assert rows(batch.filter(F.col("select_quarter") == q).select(*columns)) == rows(one.select(*columns))


def test_full_year_flow_changes_nothing(spark):
    yrs = list(range(2000, 2007))
    frame = spark.createDataFrame(random_sales(5, yrs), SALE).withColumn("permission", F.lit("p"))
    base = history_from_sales(frame, yrs).withColumn("quarter", H.month_to_quarter(F.col("month")))
    flow = H.quarterly_lapse(H.quarterly_filter(base, 4, 4, yrs), 4, yrs, ("permission",))
    assert rows(flow) == rows(base.drop("quarter"))


def test_forget_open_year_lapse(spark):
    frame = spark.createDataFrame([(1, 2001, 1), (1, 2002, 1)], "cust_id long, year int, lapse int")
    yrs = range(2000, 2004)
    assert rows(H.forget_open_year_lapse(frame, 2, 4, yrs)) == [(1, 2001, 1), (1, 2002, None)]
    for quarter, selected in ((4, 4), (2, 2)):
        assert H.forget_open_year_lapse(frame, quarter, selected, yrs) is frame


def test_partitioning_does_not_change_history(spark):
    yrs = list(range(2000, 2007))
    frame = spark.createDataFrame(random_sales(6, yrs), SALE).withColumn("permission", F.lit("p"))
    before = rows(history_from_sales(frame, yrs))
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert rows(history_from_sales(frame.repartition(5), yrs)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)


def test_build_history_permissions(spark):
    lic = spark.createDataFrame(
        [(1, "a", "hunt", 1, "deer"), (2, "b", "fish", 1, None), (3, "c", "combo", 2, None), (4, "d", "other", 1, None)],
        "lic_id long, description string, type string, duration int, priv string",
    )
    sale = spark.createDataFrame(
        [(7, 1, 2000, 1, 1), (7, 3, 2001, 2, 1), (8, 2, 2001, 3, 0), (None, 1, 2000, 1, 1), (9, 4, 2000, 1, 1)],
        "cust_id long, lic_id long, year int, month int, res int",
    )
    rules = (
        PermissionRule("hunt", "type", ("hunt", "combo")),
        PermissionRule("fish", "type", ("fish", "combo")),
        PermissionRule("deer stalking", "priv", ("deer",), parent="hunt"),
    )
    history = build_history(sale, lic, rules, range(2000, 2003))
    assert rows(history.select("permission", "cust_id", "year")) == [
        ("deer_stalking", 7, 2000), ("fish", 7, 2001), ("fish", 7, 2002), ("fish", 8, 2001),
        ("hunt", 7, 2000), ("hunt", 7, 2001), ("hunt", 7, 2002),
    ]
    assert permission_sales(sale, lic, rules).filter("cust_id is null").count() == 0
