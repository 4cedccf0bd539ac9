"""Metrics on a small hand-made history, and the one-pass plan against the step-by-step operators."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import dashboard as D
from fieldbook.operators import metrics as M
from fieldbook.operators import segments as G
from fieldbook.schemas import AGE_BREAKS, SEGMENTS, age_labels

HISTORY = (
    "cust_id long, year int, lapse int, R3 string, month int, res string, sex string, agecat string, county string"
)
R, N = "Resident", "Nonresident"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [
            (1, 2000, 0, "Recruit", 1, R, "Male", "18-24", "Adair"),
            (2, 2000, 1, "Recruit", 2, R, "Female", "18-24", "Adair"),
            (3, 2000, 1, "Renew", 2, N, "Male", "25-34", "Adair"),
            (4, 2000, 1, "Renew", 3, None, None, None, None),
            (5, 2000, 0, "Renew", 3, R, "Male", "65+", "Boone"),
            (1, 2001, None, "Renew", 1, R, "Male", "18-24", "Adair"),
            (5, 2001, None, "Renew", 1, R, None, "65+", None),
        ],
        HISTORY,
    )


def test_est_part_and_recruit(history):
    assert rows(M.est_part(history, "tot")) == [("All", 2000, 5), ("All", 2001, 2)]
    assert rows(M.est_part(history, "sex")) == [("Female", 2000, 1), ("Male", 2000, 3), ("Male", 2001, 1)]
    assert rows(M.est_recruit(history, "agecat")) == [("18-24", 2000, 2)]


def test_est_churn_drops_unknown_lapse(history):
    assert rows(M.est_churn(history, "tot")) == [("All", 2001, 0.6)]
    assert rows(M.est_churn(history, "county")) == [("Adair", 2001, pytest.approx(2 / 3)), ("Boone", 2001, 0.0)]


def test_scaleup(history):
    part = M.est_part(history, "sex")
    out = M.scaleup_part(part, M.est_part(history, "tot"))
    # 3 and 1 of 4 known become 3.75 and 1.25 of 5; the one known in 2001 stands for 2
    assert rows(out) == [("Female", 2000, 1), ("Male", 2000, 4), ("Male", 2001, 2)]


def test_scaleup_rounds_half_up(spark):
    part = spark.createDataFrame([("a", 2000, 1), ("b", 2000, 1)], "s string, year int, participants long")
    total = spark.createDataFrame([("All", 2000, 3)], "tot string, year int, participants long")
    assert rows(M.scaleup_part(part, total)) == [("a", 2000, 2), ("b", 2000, 2)]


def test_est_rate_null_keys_and_zero(spark):
    part = spark.createDataFrame([("a", 1, 5), (None, 1, 4), ("z", 1, 3), ("q", 1, 2)], "s string, year int, participants long")
    pop = spark.createDataFrame([("a", 1, 10), (None, 1, 8), ("z", 1, 0)], "s string, year int, pop long")
    assert rows(M.est_rate(part, pop)) == [("a", 1, 0.5), ("q", 1, None), ("z", 1, None), (None, 1, 0.5)]
    assert rows(M.rate_threshold(M.est_rate(part, pop), 0.4)) == [("a", 1, 0.5), (None, 1, 0.5)]


def test_est_month(spark, history):
    sale = spark.createDataFrame(
        [(1, 2000, 1), (1, 2000, 5), (2, 2000, 1), (3, 2000, 5), (1, 2001, 5)], "cust_id long, year int, month int"
    )
    assert rows(M.est_month(sale)) == [("1", 2000, 2), ("5", 2000, 2), ("5", 2001, 1)]
    assert rows(M.est_month(sale, history, use_recruits=True)) == [("1", 2000, 2), ("5", 2000, 1)]
    M.require_month_years(sale, [2001])
    with pytest.raises(ValueError):
        M.require_month_years(sale, [2002])


def test_calc_part(history):
    out = {(r.segment, r.category, r.year): (r.participants, r.residents) for r in D.calc_part(history).collect()}
    assert out["tot", "All", 2000] == (5, 4)          # 3 of 4 known are residents, scaled to 4 of 5
    assert out["res", R, 2000] == (4, None) and out["res", N, 2000] == (1, None)
    assert out["sex", "Male", 2000] == (4, 3) and out["sex", "Female", 2000] == (1, 1)
    assert out["county", "Adair", 2000] == (3, 3) and out["county", "Boone", 2000] == (1, 1)
    assert out["county", "Adair", 2001] == (2, 2)     # the resident of unknown county counts with Adair
    recruits = D.calc_part(history, use_recruits=True)
    assert rows(recruits.filter("segment = 'tot'").select("year", "participants")) == [(2000, 2)]
    with pytest.raises(ValueError):
        D.calc_part(history, segs=("tot", "sex"))


def pop_frame(spark):
    return spark.createDataFrame(
        [(y, s, a, c, 50.0) for y in (2000, 2001) for s in ("Male", "Female") for a in ("18-24", "65+") for c in ("Adair", "Boone")],
        "year int, sex string, agecat string, county string, pop double",
    )


def sales(spark):
    return spark.createDataFrame([(1, 1999, 4), (1, 2000, 1), (2, 2000, 1), (5, 2001, 1)], "cust_id long, year int, month int")


def metric_map(df):
    found = {(r.metric, r.segment, r.category, r.year): r.value for r in df.collect()}
    assert len(found) == df.count()
    return found


def test_calc_metrics(spark, history):
    out = metric_map(D.calc_metrics(history, pop_frame(spark), sales(spark), [2001], validate=True))
    assert out["participants", "tot", "All", 2000] == 5 and out["participants", "tot", "All", 2001] == 2
    assert out["recruits", "sex", "Male", 2000] == 1
    assert out["churn", "tot", "All", 2001] == 0.6
    assert out["rate", "tot", "All", 2000] == 4 / 400 and out["rate", "sex", "Male", 2000] == 3 / 200
    assert out["rate", "res", R, 2000] == 4 / 400 and out["rate", "res", N, 2000] == 0
    assert out["participants", "month", "1", 2000] == 2 and out["participants", "month", "4", 1999] == 1
    assert out["recruits", "month", "1", 2000] == 2
    # county rows are limited to dashboard years; churn of 2000 is reported in 2001
    assert {k[3] for k in out if k[1] == "county"} == {2001}
    assert out["churn", "county", "Adair", 2001] == pytest.approx(2 / 3)


def test_calc_metrics_residency(spark, history):
    home = metric_map(D.calc_metrics(history, pop_frame(spark), sales(spark), [2001], res_type=R))
    assert home["participants", "tot", "All", 2000] == 3 and ("participants", "res", N, 2000) not in home
    assert home["rate", "tot", "All", 2000] == 3 / 400
    away = metric_map(D.calc_metrics(history, pop_frame(spark), sales(spark), [2001], res_type=N))
    assert away["participants", "tot", "All", 2000] == 1
    assert not [k for k in away if k[0] == "rate" or k[1] == "county"]
    assert away["participants", "month", "1", 2000] == 2 and ("recruits", "month", "1", 2000) not in away


def test_calc_metrics_without_r3_and_missing_years(spark, history):
    plain = metric_map(D.calc_metrics(history.drop("R3"), pop_frame(spark), sales(spark), [2001]))
    assert not [k for k in plain if k[0] == "recruits"]
    later = metric_map(D.calc_metrics(history, pop_frame(spark), sales(spark), [2001, 2002]))
    assert {k[3] for k in later if k[1] == "county"} == {2001}
    with pytest.raises(ValueError):
        D.calc_metrics(history, pop_frame(spark), sales(spark), [2009], validate=True)


def test_privilege_rate(spark, history):
    deer = history.filter("cust_id in (1, 2)")
    ref = D.calc_part(history)
    out = metric_map(D.calc_metrics(deer, pop_frame(spark), sales(spark), [2001], part_ref=ref))
    assert out["rate", "tot", "All", 2000] == 2 / 5 and out["rate", "sex", "Female", 2000] == 1.0
    assert out["rate", "res", R, 2000] == 2 / 4 and ("rate", "res", N, 2000) not in out
    listed = D.calc_priv_rate(D.calc_part(deer), ref)
    assert rows(listed.filter("segment = 'tot' and year = 2000").select("rate")) == [(0.4,)]
    rates = D.calc_part_rate(ref, pop_frame(spark))
    assert rows(rates.filter("year = 2000 and segment = 'res'")) == [("res", N, 2000, 0.0), ("res", R, 2000, 0.01)]


def random_history(spark, seed, n=3000):
    rng = random.Random(seed)
    seen = {(rng.randrange(900), rng.randrange(2000, 2004)) for _ in range(n)}
    # a third of the people live in one county
    county = lambda: "Polk" if rng.random() < 1 / 3 else rng.choice(["Adair", "Boone", "Cass", None])
    data = [
        (
            c, y, None if y == 2003 else rng.randrange(2), rng.choice(["Recruit", "Renew", None]), rng.randrange(12),
            rng.choice([R, R, R, N, None]), rng.choice(["Male", "Female", None]), rng.choice(age_labels(AGE_BREAKS) + [None]), county(),
        )
        for c, y in sorted(seen)
    ]
    return spark.createDataFrame(data, HISTORY)


def test_one_pass_equals_single_segments(spark):
    history = random_history(spark, 3).cache()
    for use_recruits in (False, True):
        out = {(r.segment, r.category, r.year): (r.participants, r.residents) for r in D.calc_part(history, use_recruits=use_recruits).collect()}
        pool = history.filter("R3 = 'Recruit'") if use_recruits else history
        total = M.est_part(pool, "tot")
        scaled_res = M.scaleup_part(M.est_part(pool, "res"), total).filter(F.col("res") == R)
        want = {}
        for s in SEGMENTS:
            people = {} if s == "county" else {(s, r[0], r[1]): r[2] for r in M.scaleup_part(M.est_part(pool, s), total).collect()}
            home = {} if s == "res" else {
                (s, r[0], r[1]): r[2] for r in M.scaleup_part(M.est_part(pool.filter(F.col("res") == R), s), scaled_res).collect()
            }
            for key in people.keys() | home.keys():
                want[key] = (home[key] if s == "county" else people[key], home.get(key))
        assert out == want


def test_scaled_segments_add_up(spark):
    part = {}
    for r in D.calc_part(random_history(spark, 4)).collect():
        if r.segment in ("res", "sex", "agecat", "tot"):
            part.setdefault((r.segment, r.year), []).append(r.participants)
    for (segment, year), values in part.items():
        assert abs(sum(values) - part["tot", year][0]) <= len(values) / 2


def test_county_names_joined_to_cells(spark):
    history = random_history(spark, 6)
    names = spark.createDataFrame([(1, "Polk"), (3, "Adair"), (5, "Boone")], "county_fips int, county string")
    coded = history.drop("county").withColumn("county_fips", (F.col("cust_id") % 9).cast("int")).withColumn("p", F.lit(1))
    named = coded.join(names, "county_fips", "left")
    a = G.segment_counts(coded, ["p"], counties=names)
    b = G.segment_counts(named, ["p"])
    assert rows(a) == rows(b.select(a.columns))


def test_parent_participants(spark):
    data = [(p, 2, "tot", "All", y, n) for p, y, n in (("hunt", 1, 10), ("deer", 1, 4), ("deer", 2, 3), ("buck", 1, 1))]
    measures = spark.createDataFrame(data, "permission string, select_quarter int, segment string, category string, year int, participants long")
    out = G.parent_participants(measures, {"deer": "hunt", "buck": "deer"}, ("permission", "select_quarter"))
    assert rows(out.select("permission", "year", "parent")) == [("buck", 1, 4), ("deer", 1, 10), ("deer", 2, None), ("hunt", 1, None)]
