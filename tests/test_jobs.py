"""Jobs on tiny tables with results worked out by hand."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartframes import plans
from chartframes.plans.contests import running_totals, unit_winners
from chartframes.plans.series import yoy_changes
from chartframes.plans.shares import percentile_matrix
from chartframes.plans.tidy import feet_and_inches
from tests.conftest import rows


def test_monthly_totals_and_means(spark):
    data = [(datetime(2024, 3, 1), "US", 1), (datetime(2024, 3, 9), "US", 2), (datetime(2024, 11, 1), "CA", 5)]
    out = plans.monthly_totals(spark.createDataFrame(data, "t timestamp_ntz, g string, v int"), "t", "g", "v")
    assert rows(out) == [(2024, 3, None, 3, "2024_03"), (2024, 11, 5, None, "2024_11")]
    assert rows(plans.reference_means(out, ["CA", "US"])) == [(5.0, 3.0)]


def test_league_table_settles_ties(spark):
    data = [
        (1, "A", 1, 0, 0, 3, 2), (1, "B", 1, 0, 0, 3, 5), (1, "C", 0, 1, 0, 1, 0), (1, "C", 1, 0, 0, 3, 1),
        (1, "D", 1, 0, 0, 3, 2), (2, "A", 0, 0, 1, 0, -1),
    ]
    df = spark.createDataFrame(data, "s int, team string, w int, d int, l int, p int, gd int")
    table = plans.league_table(df, "s", "team", "w", "d", "l", "p", "gd")
    assert rows(table, "s", "rank", "team", "matches", "pts_per_match") == [
        (1, 1, "B", 1, 3.0), (1, 2, "A", 1, 3.0), (1, 3, "D", 1, 3.0), (1, 4, "C", 2, 2.0), (2, 1, "A", 1, 0.0)
    ]


def test_running_matrix_starts_at_zero(spark):
    data = [(1, "A", 1, 2), (1, "A", 2, -1), (1, "B", 1, 4), (2, "B", 1, 7)]
    df = spark.createDataFrame(data, "s int, team string, day int, v int")
    out = plans.running_matrix(df, "s", "team", "v", ["day"])
    assert rows(out) == [(1, 0, 0, 0), (1, 1, 2, 4), (1, 2, 1, None), (2, 0, None, 0), (2, 1, None, 7)]
    plain = running_totals(df, "s", "team", "v", ["day"], baseline=False)
    assert plain.where("match_num = 0").count() == 0 and plain.count() == 4


def test_pareto_keeps_after_the_percentage(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("a", 1), ("c", 1)], "k string, v int")
    assert [tuple(r) for r in plans.pareto(df, "k", "v").collect()] == [("a", 6, 60.0), ("b", 3, 90.0), ("c", 1, 100.0)]
    assert rows(plans.pareto(df, "k", "v", ["b"])) == [("b", 3, 90.0)]


def test_region_rollup(spark):
    df = spark.createDataFrame([("ny", 1), ("ca", 2), ("??", 4), (None, 8)], "s string, v int")
    out = plans.region_rollup(df, "s", {"ny": "East", "ca": "Pacific"}, ["East"], "v")
    assert rows(out) == [("East", 1), ("Others", 14)]


def test_group_share(spark):
    df = spark.createDataFrame([("x", "yes"), ("x", "yes"), ("x", "no"), (None, "no")], "g string, a string")
    out = plans.group_share(df, "g", "a").select("g", "a", "n", "total", F.round("pct", 2))
    assert rows(out) == [("x", "no", 1, 3, 33.33), ("x", "yes", 2, 3, 66.67), (None, "no", 1, 1, 100.0)]


def test_interquartile_mean_leaves_small_groups_out(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, 100)] + [("b", 1)], "g string, v int")
    out = plans.interquartile_mean(df, "g", "v", 2)
    assert rows(out, "g", "n", "q1", "median", "q3", "average", "label") == [("a", 5, 2, 3.0, 4, 3.0, "a: 3.0")]


def test_iqr_flags(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, 100)] + [("a", None)], "g string, v int")
    assert rows(plans.iqr_flags(df, "v", "g"), "v", "is_outlier") == [
        (1, False), (2, False), (3, False), (4, False), (100, True), (None, False)
    ]


def test_proportion_by_quartile(spark):
    df = spark.createDataFrame([("10", "90", "40"), ("NULL", "70", "60")], "pb1Female string, pb1Male string, pb2Male string")
    columns = {"pb1Female": ("Q1", "Female"), "pb1Male": ("Q1", "Male"), "pb2Male": ("Q2", "Male")}
    assert rows(plans.proportion_by_quartile(df, columns, "NULL")) == [("Q1", 10.0, 80.0), ("Q2", None, 50.0)]


def test_pct_change_from_the_earliest_period(spark):
    data = [(2023, 3.0, 1.0, 0.0), (2022, 1.0, 1.0, 2.0), (2022, 3.0, 1.0, 2.0), (2023, 3.0, 3.0, 2.0)]
    df = spark.createDataFrame(data, "year int, pay double, f double, m double")
    out = plans.pct_change_from_base(df, "year", ["pay"], {"ratio": ("f", "m")})
    assert rows(out) == [(2022, 0.0, 0.0), (2023, 50.0, 200.0)]


def test_two_party_margin(spark):
    data = [(2020, "X", "D", 6), (2020, "X", "R", 3), (2020, "X", "L", 1), (2020, "Y", "R", 5), (2020, "Y", "D", 5)]
    df = spark.createDataFrame(data, "year int, state string, party string, votes int")
    names = plans.candidates_by_year(
        spark.createDataFrame([(2020, "D", "Dee"), (2020, "R", "Ray"), (2020, "D", "Dee"), (2020, "R", None)], "year int, party string, name string"),
        "year", "party", "name",
    )
    out = plans.two_party_margin(df, ["year", "state"], "party", "votes", "D", "R", names=names, period="year")
    assert rows(out, "state", "a_pct", "b_pct", F.round("diff_pct", 6), "winning_party", "winner", "loser", "losing_pct") == [
        ("X", 0.6, 0.3, 0.3, "D", "Dee", "Ray", 0.3), ("Y", 0.5, 0.5, 0.0, "R", "Ray", "Dee", 0.5)
    ]


def test_two_candidates_of_one_party_fail(spark):
    df = spark.createDataFrame([(1, "D", "a"), (1, "D", "b")], "y int, p string, n string")
    with pytest.raises(PySparkException):
        plans.candidates_by_year(df, "y", "p", "n").collect()


def test_win_loss_record_and_matrix(spark):
    data = [(2016, "X", 5, 6), (2020, "X", 7, 6), (2016, "Y", 9, 1), (2020, "Y", 9, 1)]
    wide = unit_winners(spark.createDataFrame(data, "year int, state string, a int, b int"), "a", "b", "Dem", "Rep")
    outcomes = spark.createDataFrame([(2016, "Rep"), (2020, "Dem")], "year int, winner string")
    record = plans.win_loss_record(wide, "state", "year", "unit_winner", outcomes, "winner")
    assert [tuple(r) for r in record.collect()] == [("X", 2, 0), ("Y", 1, 1)]
    assert rows(plans.winner_matrix(wide, "year", "state", "unit_winner")) == [("2016", "Rep", "Dem"), ("2020", "Dem", "Dem")]


def test_top_n_and_groups(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, 9), ("g", 3, 9), ("h", 4, 8)], "g string, id int, v int")
    assert rows(plans.top_n_per_group(df, "g", "v", 2, ["id"]), "g", "id", "rank") == [("g", 2, 1), ("g", 3, 2), ("h", 4, 1)]
    assert rows(plans.top_groups(df, "g", "v", 1)) == [("h", 8.0)]


def test_first_item_with_totals(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("c", 5, "q"), ("c", 4, None)], "k string, t int, n string")
    out = plans.first_item_with_totals(df, "k", ["t"], ["n"], 2)
    assert [tuple(r) for r in out.collect()] == [("c", 2, None), ("a", 2, "y")]


def test_log_size(spark):
    df = spark.createDataFrame([(10.0,), (1000.0,), (0.0,), (None,)], "x double")
    assert rows(plans.log_size(df, "x")) == [(10.0, 1.0), (1000.0, 9.0)]


def test_smoothed_matrix(spark):
    data = [("a", t, float(t)) for t in range(4)] + [("b", 3, 1.0)]
    out = plans.smoothed_matrix(spark.createDataFrame(data, "s string, t int, v double"), "t", "s", "v", 3)
    assert rows(out) == [(0, None, None), (1, None, None), (2, 1.0, None), (3, 2.0, None)]


def test_yearly_counts_with_a_missing_part(spark):
    data = [("X", "2023")] * 2 + [("X", "2024_A")] * 3 + [("Y", "2024_A"), ("Y", "2024_B")]
    df = spark.createDataFrame(data, "unit string, period string")
    periods, combine = ["2023", "2024_A", "2024_B"], {"2024": ["2024_A", "2024_B"]}
    zero = plans.yearly_counts(df, "unit", "period", periods, combine)
    assert rows(zero) == [("X", 2, 3, 5), ("Y", 0, 2, 2)]
    null = plans.yearly_counts(df, "unit", "period", periods, combine, "null")
    assert rows(null) == [("X", 2, 0, 2), ("Y", 0, 2, 2)]
    people = spark.createDataFrame([("X", 4)], "unit string, n int")
    assert rows(plans.per_million(zero, "unit", ["2023", "2024"], people, 100)) == [("X", 50.0, 75.0), ("Y", None, None)]


def test_decade_share(spark):
    df = spark.createDataFrame([(1999, "g", 1), (2001, "g", 3), (2002, "h", 2)], "y int, g string, n int")
    assert rows(plans.decade_share(df, "y", "g", "n")) == [("1990s", 0.25, None), ("2000s", 0.75, 1.0)]


def test_flow_matrices(spark):
    edges = spark.createDataFrame([(1, 2, 10, 2020), (1, 2, 5, 2021), (2, 1, 7, 2020), (1, 3, 1, 2021)], "s int, d int, w int, y int")
    names = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a")], "k int, n string")
    assert rows(plans.flow_matrix(edges, "s", "d", "w", names)) == [("a", None, 7), ("b", 16, None)]
    scaled = plans.normalised_flow_matrix(edges, "s", "d", "w", "y", names)
    assert rows(scaled) == [("a", None, 700), ("b", 800, None)]
    assert plans.flow_matrix(edges, "s", "d", "w").columns == ["from", "1", "2", "3"]


def test_calendar_matrix(spark):
    data = [(date(2023, 1, 5), 1.0), (date(2024, 1, 5), 2.0), (date(2024, 2, 29), 3.0)]
    out = plans.calendar_matrix(spark.createDataFrame(data, "d date, v double"), "d", "v", [2023, 2024])
    assert rows(out) == [(1, "Jan", 5, 1.0, 2.0, "Jan 5"), (2, "Feb", 29, None, 3.0, "Feb 29")]


def test_weekday_means_leave_outliers_out(spark):
    data = [(date(2024, 1, d), v) for d, v in ((1, 10.0), (8, 11.0), (15, 12.0), (22, 13.0), (29, 900.0), (2, 5.0))]
    out = plans.weekday_means(spark.createDataFrame(data, "d date, v double"), "d", "v", [2024])
    found = {r.day_name: r["2024"] for r in out.collect()}
    assert len(found) == 7 and found["Mon"] == 11.5 and found["Tue"] == 5.0 and found["Sun"] is None


def test_unit_conversion(spark):
    df = feet_and_inches(spark.createDataFrame([(100.0, 907.18474)], "cm double, g double"), "cm")
    out = plans.unit_conversion(df, {"pounds": ("g", 1.0, 453.59237)})
    row = out.first()
    assert (row.feet, round(row.inches, 6), round(row.pounds, 6)) == (3, 3.370079, 2.0)


def test_count_by_age_and_status(spark):
    df = spark.createDataFrame([(3, "Fixed"), (3, "Fixed"), (3, None), (5, "End")], "age int, s string")
    assert rows(plans.count_by_age_and_status(df, "age", "s")) == [(3, None, 2), (5, 1, None)]


def test_ranked_crosstab(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "x"), ("c", None)], "b string, s string")
    out = plans.ranked_crosstab(df, "b", "s", ["x", "y"])
    assert rows(out, "b", "total", "percentage", "rank", "x", "y") == [
        ("a", 2, 0.4, 1, 0.25, 0.25), ("b", 1, 0.2, 2, 0.25, 0.0), ("c", 2, 0.4, 1, 0.25, 0.0)
    ]


def test_timeline_numbers_before_it_filters(spark):
    day = lambda y: date(y, 1, 1)
    data = [
        ("BC", "one", day(1900), day(1901)), ("BC", "two", day(1905), day(1950)), ("AB", "short", day(1990), day(1991)),
        ("NS", "only", day(1800), day(1900)),
    ]
    df = spark.createDataFrame(data, "p string, m string, o date, c date").withColumn("town", F.lit(None).cast("string"))
    out = plans.timeline(df, "p", "m", "o", "c", 10, {"town": "No Name Town"}).orderBy("group_num", "item_num")
    assert [r.town for r in out.collect()] == ["", "No Name Town", "", "No Name Town"]
    assert [tuple(r) for r in out.select("label", "duration_years").collect()] == [
        ("  2.00: <b>BC</b>", 50), ("  2.02: two", 45), ("  3.00: <b>NS</b>", 100), ("  3.01: only", 100)
    ]


def test_yield_summary(spark):
    df = spark.createDataFrame([("FR", "10"), ("FR", "30"), ("IT", "na"), ("IT", "20")], "c string, y string")
    out = plans.yield_summary(df, "y", "c", {"FR": "France", "IT": "Italy"})
    assert rows(out, "c", "n", "median") == [("France", 2, 20.0), ("Italy", 1, 20.0)]


def test_yoy_growth_drops_flat_and_empty_series(spark):
    data = [(y, s, v) for s, vs in {"up": (0.0, 30.0, 31.0), "flat": (1.0, 2.0, 3.0), "none": (None, None, None), "one": (None, None, 5.0)}.items() for y, v in zip((2001, 2002, 2003), vs)]
    df = spark.createDataFrame(data, "y int, s string, v double")
    assert rows(plans.yoy_growth(df, "y", "s", "v", 25)) == [(2001, None), (2002, 30.0), (2003, 1.0)]
    assert {r.s for r in yoy_changes(df, "y", "s", "v", 25).collect()} == {"up"}


LOADS = [(datetime(2024, 11, 3, h), float(h)) for h in (0, 1, 1, 2)]


def test_load_profiles(spark):
    df = spark.createDataFrame(LOADS, "t timestamp_ntz, x double")
    rate = spark.createDataFrame([("twice", 2)], "s string, n int")
    out = plans.load_profiles(df, "t", "US/Eastern", {"twice": F.col("x") * 2, "plain": "x"}, rate, "hour", 1000.0)
    assert rows(out, "hour", "series", "load") == [
        (0, "plain", None), (0, "twice", 0.0), (1, "plain", None), (1, "twice", 1000.0), (2, "plain", None), (2, "twice", 2000.0)
    ]
    week = plans.load_profiles(df, "t", "US/Eastern", {"x": "x"}, grain="weekday", weeks=2)
    assert rows(week) == [(0, "x", 2.0, "Sun")]


def test_load_profiles_check_local_time(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30), 1.0), (datetime(2024, 3, 10, 3), 2.0)], "t timestamp_ntz, x double")
    with pytest.raises(PySparkException):
        plans.load_profiles(df, "t", "US/Eastern", {"x": "x"}, grain="date").collect()
    kept = plans.load_profiles(df, "t", "US/Eastern", {"x": "x"}, grain="date", nonexistent="null")
    assert rows(kept, "load") == [(2.0,)]


def test_derived_average_and_latest(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (3, 2.0, 2.25), (2, None, 9.0)], "t int, a double, b double")
    out = plans.derived_average(df, "a", "b", 1)
    assert rows(out, "t", "average") == [(1, 1.5), (2, None), (3, 2.1)]
    assert rows(plans.latest(out, "t", ["a", "average"])) == [(3, 2.0, 2.1)]


def test_percentile_table_keeps_complete_groups(spark):
    labels = [f"days at {p}th percentile" for p in (10, 25, 50, 75, 90)]
    data = [("full", label, str(365.9 * i)) for i, label in enumerate(labels)] + [("part", labels[0], "365"), ("full", "mode", "1")]
    df = spark.createDataFrame(data, "o string, l string, v string")
    assert rows(plans.percentile_table(df, "l", "o", "v", [10, 25, 50, 75, 90]))[1] == (25, 1.0)
    assert percentile_matrix(df, "l", "o", "v", [10, 25, 50, 75, 90]).select("o").distinct().count() == 1


def test_percentile_labels_are_whole_numbers(spark):
    data = [("g", "5th of 100", "365"), ("g", "25th of 100", "730"), ("h", "5th", "1"), ("i", "percentile 5", "365"), ("i", "percentile 25", "365")]
    df = spark.createDataFrame(data, "o string, l string, v string")
    assert rows(percentile_matrix(df, "l", "o", "v", [5, 25]), "o", "percentile", "years") == [("g", 5, 1.0), ("g", 25, 2.0), ("i", 5, 1.0), ("i", 25, 1.0)]
    twice = df.where("o = 'h'").union(df.where("o = 'h'"))
    with pytest.raises(PySparkException):
        percentile_matrix(twice, "l", "o", "v", [5, 25]).collect()


def test_a_party_without_votes_loses(spark):
    df = spark.createDataFrame([(1, "X", "A", 10), (1, "Y", "C", 3)], "year int, state string, party string, votes int")
    out = plans.two_party_margin(df, ["year", "state"], "party", "votes", "A", "B")
    assert rows(out, "state", "winning_party", "b_votes", "diff_pct") == [("X", "A", 0, 1.0), ("Y", "B", 0, 0.0)]


def test_company_tiers(spark):
    df = spark.createDataFrame([("X", "$2,500,000,000", "makes very good things"), ("Y", "$0", "b")], "Company string, `Market Cap` string, text string")
    coords = spark.createDataFrame([("X", 37.5)], "Company string, Lat double")
    tiers = [(1e4, "> $10B", 5), (1e3, "> $1B", 4)]
    out = plans.company_tiers(df, "Company", {"Market Cap": (1e6, 0)}, "Market Cap", tiers, coords, ("text", 10))
    assert rows(out, "Company", "`Market Cap`", "tier", "marker_size", "text_wrapped", "Lat") == [
        ("X", 2500.0, "> $1B", 4, "makes very<br>good things", 37.5), ("Y", 0.0, None, None, "b", None)
    ]


def test_bin_labels(spark):
    df = spark.createDataFrame([(10.0,), (95.0,)], "x double")
    assert rows(plans.bin_labels(df, "x", [(None, 10, "low")], "high")) == [(10.0, "low"), (95.0, "high")]
