from datetime import date

import pytest
from pyspark.sql import functions as F

from abacist.functions import scalars as S
from abacist.operators import aggregates as A
from abacist.operators import prep as D
from abacist.operators import relational as P
from abacist.plans import churn_steps, city_reports


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_less_than_any(frame):
    df = frame([(1,), (5,), (9,)], "x int")
    assert values(P.less_than_any(df, "x", frame([(2,), (6,)], "y int"), "y"), "x") == [(1,), (5,)]
    assert values(P.less_than_any(df, "x", frame([], "y int"), "y"), "x") == []


def test_remerge_gives_both_genders_the_name_total(frame):
    df = frame([("Ada", "F", 3), ("Ada", "M", 2), ("Bo", "M", 1), ("Ada", "F", 3)], "n string, g string, f int")
    assert values(A.remerge_sum(df, "n", ["g"], "f", "s"), "n", "g", "s") == [("Ada", "F", 8), ("Ada", "M", 8), ("Bo", "M", 1)]


def test_fanout_mean_equals_the_join(frame):
    left = frame([("a",), ("a",), ("b",), (None,)], "k string")
    right = frame([("a", "x", 1.5), ("a", "x", 2.5), ("b", "x", 9.0), ("b", "y", None), (None, "y", 4.0)], "k string, g string, v double")
    want = left.join(right, "k").groupBy("g").agg(F.avg("v").alias("m"))
    assert values(P.fanout_mean(left, right, "k", "g", "v", "m"), "g", "m") == values(want, "g", "m")


def test_buckets(frame):
    df = frame([(0.0,), (0.5,), (1.0,), (2.0,), (None,)], "r double")
    assert [r[0] for r in df.select(D.bucket("r", [0, 1, 2])).collect()] == [0, 0, 1, 2, 0]


def test_missing_counts_as_lowest(frame):
    df = frame([(None,), (99.0,), (100.0,)], "l double")
    assert [r[0] for r in df.select(D.relabel("l", 100, "loyal", "regular")).collect()] == ["regular", "regular", "loyal"]
    assert [r[0] for r in P.order(df, ("l", False)).collect()] == [None, 99.0, 100.0]


def test_text_match_takes_no_wildcards(frame):
    df = frame([("ban_1",), ("banX",)], "t string")
    assert [r[0] for r in df.select(S.text_match("t", "ban_", "prefix")).collect()] == [True, False]


def test_dates(frame):
    df = frame([(930101, "2024-03-05T10:00:00Z", date(2011, 1, 24))], "d int, i string, s date")
    row = df.select(
        S.two_digit_date("d"), S.iso_date("i"), S.compact_date("s"), S.days_before(date(2024, 1, 2), 2),
        S.age_brought_forward(F.lit(30), "s", F.lit(date(2021, 1, 23))), S.first_int(F.lit("ab12c3")), S.first_int(F.lit("x")),
        S.finite_or_zero(F.lit(float("-inf"))), S.days_between("s", F.lit(date(2011, 1, 31))),
    ).first()
    assert tuple(row) == (date(1993, 1, 1), date(2024, 3, 5), "24JAN2011", date(2023, 12, 31), 39, 12, None, 0.0, 7)


def test_exact_sums_do_not_depend_on_order(frame):
    df = frame([(0.1,), (0.2,), (0.3,), (None,)] * 100, "v double")
    sums = {df.repartition(n).agg(S.exact_sum("v"), S.exact_mean("v")).first() for n in (1, 3, 7)}
    assert sums == {(60.0, 0.2)}


def test_exact_sums_do_not_round_the_numbers(frame):
    df = frame([(0.004, 218.385), (0.0049, 201.478), (0.003, -0.001)], "v double, speed double")
    row = df.agg(S.exact_sum("v"), S.exact_mean("v"), S.exact_sum("speed")).first()
    assert tuple(row) == (0.0119, 0.0119 / 3, 419.862)
    profile = A.describe_profile(df, ["v"]).first()
    assert profile["min"] <= profile["mean"] <= profile["max"]


def test_fanout_mean_does_not_round_the_numbers(frame):
    left = frame([("a",), ("a",), ("b",)], "k string")
    right = frame([("a", "x", 0.004), ("b", "x", -0.0031), ("b", "y", None), ("a", "z", -1234567.125)], "k string, g string, v double")
    assert values(P.fanout_mean(left, right, "k", "g", "v", "m"), "g", "m") == [("x", 0.0049 / 3), ("y", None), ("z", -1234567.125)]


def test_null_and_unique_profiles(frame):
    df = frame([(1, "a"), (1, None), (None, "b")], "x int, t string")
    assert values(A.null_profile(df), "column", "missing") == [("t", 1), ("x", 1)]
    assert values(A.unique_profile(df), "column", "unique_values") == [("t", 2), ("x", 1)]
    assert values(A.shape(df), "rows", "columns") == [(3, 2)]


def test_apportion_keeps_totals_with_null_keys(frame):
    df = frame([("a", 10), ("a", 10), (None, 6), (None, 6), (None, 6)], "k string, v int")
    assert A.apportion(df, ["k"], ["v"]).agg(F.sum("v")).first()[0] == pytest.approx(16.0)


def test_gift_windows(frame):
    ref = date(2018, 9, 4)
    gifts = frame(
        [(1, 10.0, date(2018, 8, 4)), (1, 20.0, date(2017, 9, 4)), (1, 40.0, date(2017, 9, 3)), (1, 5.0, date(2018, 9, 5))],
        "id int, amount double, date date",
    )
    row = D.gift_features(gifts, "id", "amount", "date", ref).first()
    assert (row["count"], row["last_month_mean"], row["year1_mean"], row["year1_count"], row["year2_mean"]) == (3, 10.0, 15.0, 2, 40.0)
    assert row["recency_days"] == 31


def test_one_hot_missing(frame):
    df = frame([("a",), ("b",), (None,)], "c string")
    out = D.one_hot(df, "c", ["a", "b"], drop_first=True, nan=True)
    assert out.columns == ["c_b", "c_NaN"] and [tuple(r) for r in out.collect()] == [(0, 0), (1, 0), (0, 1)]


def test_year_range_checks_its_arguments(frame):
    df = frame([(date(1999, 12, 31),), (date(2000, 1, 1),), (date(2001, 1, 1),)], "d date")
    assert P.year_range(df, "d", 2000, 2000).count() == 1
    with pytest.raises(ValueError):
        P.year_range(df, "d", 2001, 2000)


def test_column_helpers(frame):
    df = frame([(1, 2, 3)], "`a b` int, c int, d int")
    assert P.clean_names(df).columns == ["a_b", "c", "d"]
    assert P.take_columns(df, 2).columns == ["a b", "c"]
    assert P.columns_like(df, "c", keep=["d"]).columns == ["d", "c"]


def test_churn_steps(frame):
    df = frame(
        [(1, 0, 100.0, 4, 30.4, 320.0, 2.5, 0, 1), (2, 1, 50.0, None, 41.0, None, 1.0, 0, 0), (3, 1, 20.0, 2, None, 90.0, None, 1, 1)],
        "cust_id int, churn int, mon_purch double, freq_purch int, age double, LOS double, rec_complaints double, d_age_missing int, d_gender int",
    )
    steps = churn_steps.run_churn_steps(df, date(2021, 1, 24))
    first = steps["derived"].orderBy("cust_id").first()
    assert first["mon_purch_dol"] == pytest.approx(115.0)
    assert (first["avg_mon_purch"], first["cust_id2"], first["age2"], first["LOS2"], first["snapshot_text"]) == (25.0, "10", 40, "loyal", "24JAN2011")
    assert values(steps["total_kept"], "cust_id", "tot_freq_purch") == [(1, 4), (2, None), (3, None)]
    assert values(steps["total_sum"], "cust_id", "tot_freq_purch") == [(1, 4), (2, 4), (3, 6)]
    assert values(steps["loyal_ids"], "cust_id") == [(1,)]
    assert values(steps["spent_by_churn"], "churn", "mon_purch") == [(0, 100.0)]
    assert steps["known_age"].count() == 2 and steps["gender_by_churn"].count() == 3
    assert values(steps["rounded"], "age")[0] == (30.0,)
    assert steps["stats_by_gender"].count() == 10 and steps["loyal_first"].count() == 1


def test_city_reports_on_ties(frame):
    people = frame([("d1", 2000), ("d2", 2000)], "District_Name string, Number int")
    deaths = frame([("d1", 150), ("d2", 250)], "District_Name string, Number int")
    out = city_reports.districts_with_immigrants_and_deaths(people, deaths)
    assert out.count() == 4  # equal totals match each other
    stations = frame([("s", "1", "2"), ("t", "1", "2")], "Station string, Longitude string, Latitude string")
    assert city_reports.stations_with_air_quality(stations, stations.where("Station = 's'")).count() == 1


def test_sums_keep_every_number(frame):
    from abacist.functions.scalars import exact_mean, exact_sum
    from abacist.operators.relational import fanout_mean

    inf, nan = float("inf"), float("nan")
    cases = {"nan": [1.0, nan], "inf": [1.0, inf, 3.0], "both": [inf, -inf], "tiny": [1e-19, 2e-19], "large": [2e20, 2e20, 1.0],
             "mixed": [1e-12, 1.0, 2e20], "none": [None], "zero": [0.0, None], "huge": [1e300, 1e300], "least": [5e-324, 5e-324]}
    rows = [(k, v) for k, values in cases.items() for v in values]
    got = {r.k: (str(r.s), str(r.m)) for r in frame(rows, "k string, v double").groupBy("k").agg(
        exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got == {"nan": ("nan", "nan"), "inf": ("inf", "inf"), "both": ("nan", "nan"), "tiny": ("3e-19", "1.5e-19"),
                   "large": ("4e+20", str(4e20 / 3)), "mixed": ("2e+20", str(2e20 / 3)), "none": ("None", "None"), "zero": ("0.0", "0.0"),
                   "huge": ("2e+300", "1e+300"), "least": ("1e-323", "5e-324")}
    left, right = frame([(1,), (1,), (2,)], "k int"), frame([(1, "a", inf), (2, "a", 1.0), (1, "b", 1e-19), (2, "c", 2.0), (1, "c", 0.5)], "k int, g string, v double")
    assert {r.g: r.m for r in fanout_mean(left, right, "k", "g", "v", "m").collect()} == {"a": inf, "b": 1e-19, "c": 1.0}
