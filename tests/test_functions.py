import pytest
from pyspark.sql import functions as F

from latemark.functions import day_period, departure_hour, in_any_period, route_key, season, weekend_flag
from latemark.operators import add_calendar_features, add_class_weight, add_label, clean_legs, cleaning_report
from latemark.roles import LegRoles

NAN = float("nan")


def column(df, name):
    return [row[name] for row in df.collect()]


@pytest.mark.parametrize("hhmm, hour, period", [
    (None, None, 4), (2400, 24, 4), (559, 5, 0), (600, 6, 1), (1159, 11, 1), (1200, 12, 2),
    (1659, 16, 2), (1700, 17, 3), (2059, 20, 3), (2100, 21, 4), (5, 0, 0),
])
def test_hour_and_period(spark, hhmm, hour, period):
    df = spark.createDataFrame([(hhmm,)], "hhmm int")
    found = departure_hour(F.col("hhmm"))
    assert df.select(found.alias("h"), day_period(found).alias("p")).first() == (hour, period)


def test_weekend_and_season(spark):
    df = spark.createDataFrame([(6, 12), (7, 2), (5, 3), (1, 8), (None, None), (2, 11)], "d int, m int")
    rows = df.select(weekend_flag(F.col("d")).alias("w"), season(F.col("m")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (1, 0), (0, 1), (0, 2), (0, 3), (0, 3)]


def test_route_leaves_out_missing_ends(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, 2), (None, None)], "a int, b int")
    assert column(df.select(route_key(F.col("a"), F.col("b")).alias("r")), "r") == ["1-2", "1", "2", ""]


def test_periods_include_both_ends(spark):
    months = [(2020, 2), (2020, 3), (2020, 12), (2021, 1), (2021, 12), (2022, 6), (2022, 7), (2019, None)]
    df = spark.createDataFrame(months, "y int, m int")
    inside = in_any_period(F.col("y"), F.col("m"), [((2020, 3), (2022, 6))])
    assert column(df.select(inside.alias("i")), "i") == [False, True, True, True, True, True, False, False]


DELAYS = [(None,), (NAN,), (14.0,), (15.0,), (16.0,)]


@pytest.mark.parametrize("options, expected", [
    ({}, [0, 1, 1]),
    ({"inclusive": False}, [0, 0, 1]),
    ({"inclusive": False, "keep_unknown": True}, [0, 0, 0, 0, 1]),
])
def test_label(spark, options, expected):
    df = spark.createDataFrame(DELAYS, "delay double")
    assert column(add_label(df, "delay", 15, **options), "label") == expected


def test_class_weight_column(spark):
    df = spark.createDataFrame([(0,), (1,)], "label int")
    assert column(add_class_weight(df, 4.0), "weight") == [1.0, 4.0]
    assert column(add_class_weight(df, None), "weight") == [1.0, 1.0]


ROLES = LegRoles(
    delay="delay", categorical=("carrier",), numeric=("year", "month", "x"),
    scheduled_hhmm="hhmm", day_of_week="d", carrier="carrier", origin="o", destination="t",
)
SCHEMA = "year int, month int, x double, carrier string, delay double, cancelled int, diverted int"


def test_clean_drops_every_kind_of_bad_row(spark):
    good = (2019, 5, 1.0, "A", 20.0, 0, 0)
    bad = [
        (2019, 5, 1.0, "A", 20.0, 1, 0), (2019, 5, 1.0, "A", 20.0, 0, 1), (2019, 5, 1.0, "A", None, 0, 0),
        (2019, 5, 1.0, "A", NAN, 0, 0), (2019, 5, 1.0, None, 20.0, 0, 0), (2019, 5, NAN, "A", 20.0, 0, 0),
        (2010, 5, 1.0, "A", 20.0, 0, 0), (2021, 5, 1.0, "A", 20.0, 0, 0), (2019, None, 1.0, "A", 20.0, 0, 0),
        (2019, 5, 1.0, "A", 20.0, None, 0),
    ]
    df = spark.createDataFrame([good, *bad], SCHEMA)
    kept = clean_legs(df, ROLES, start_year=2015)
    assert [tuple(r) for r in kept.collect()] == [(2019, 5, 1.0, "A", 1)]
    report = cleaning_report(df, ROLES, start_year=2015).first()
    assert report["total_rows"] == 11 and report["kept_rows"] == 1 and report["dropped_by_year"] == 1


def test_calendar_features_add_five_columns(spark):
    df = spark.createDataFrame([(7, 6, 1430, 10, 20)], "month int, d int, hhmm int, o int, t int")
    row = add_calendar_features(df, ROLES).first()
    assert (row["dep_hour"], row["dep_period"], row["is_weekend"], row["season"], row["route"]) == (14, 2, 1, 2, "10-20")
