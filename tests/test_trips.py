"""Trip models on rows in the shape of the monthly files, with the odd cases inline."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faremill.functions.codes import PAYMENT_DESCRIPTIONS
from faremill.jobs import FHV_CSV, GREEN_CSV, YELLOW_CSV, ZONE_CSV
from faremill.operators.joins import code_table
from faremill.operators.quality import enforce
from faremill.plans import matches as m
from faremill.plans import trips as t
from tests.conftest import final_plan, rows, ts


def table(spark, ddl, *records):
    names = [c.strip().split(" ")[0] for c in ddl.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)


def green(spark, *records):
    base = {
        "VendorID": 1, "lpep_pickup_datetime": ts("2019-10-01T00:00:50"),
        "lpep_dropoff_datetime": ts("2019-10-01T00:01:10"), "PULocationID": 1, "DOLocationID": 264,
        "passenger_count": 1, "trip_distance": 1.5, "fare_amount": 10.0, "total_amount": 12.345,
        "payment_type": 1,
    }
    return table(spark, GREEN_CSV, *[{**base, **r} for r in records])


def yellow(spark, *records):
    base = {
        "VendorID": 2, "tpep_pickup_datetime": ts("2020-01-01T00:00:00"),
        "tpep_dropoff_datetime": ts("2020-01-01T00:30:00"), "PULocationID": 999,
        "fare_amount": 5.0, "total_amount": 6.0,
    }
    return table(spark, YELLOW_CSV, *[{**base, **r} for r in records])


def zones(spark):
    return t.dim_zones(
        table(
            spark, ZONE_CSV,
            {"LocationID": 1, "Borough": "EWR", "Zone": "Newark", "service_zone": "EWR"},
            {"LocationID": 264, "Borough": "Unknown", "Zone": "N/A", "service_zone": "N/A"},
            {"LocationID": 56, "Borough": "Queens", "Zone": "Corona", "service_zone": "B"},
            {"LocationID": 57, "Borough": "Queens", "Zone": "Corona", "service_zone": "B"},
        )
    )


def payments(spark):
    return code_table(spark, PAYMENT_DESCRIPTIONS, "payment_type", "description")


def test_staging(spark):
    g = t.stage_green(green(spark, {}, {"VendorID": None}))
    y = t.stage_yellow(yellow(spark, {}))
    assert g.count() == 1 and g.columns == y.columns == list(t.STAGED)
    assert g.dtypes == y.dtypes
    assert (y.head().trip_type, y.head().ehail_fee) == (1, None)
    # cents are kept and rounded, not dropped
    assert str(g.head().total_amount) == "12.35"


def test_text_codes_are_read_safely(spark):
    text = green(spark, {}).withColumn("RatecodeID", F.lit("abc"))
    assert t.stage_green(text).head().rate_code_id is None


def test_development_window(spark):
    df = green(spark, {}, {"lpep_pickup_datetime": ts("2019-12-01T00:00:00")})
    assert t.stage_green(df, ("2019-10-01", "2019-11-01")).count() == 1


def test_fhv(spark):
    df = table(
        spark, FHV_CSV,
        {"dispatching_base_num": "B1", "PUlocationID": 12.0, "SR_Flag": "1"},
        {"dispatching_base_num": None},
    )
    got = t.stage_fhv(df)
    assert got.columns == [
        "dispatching_base_num", "affiliated_base_num", "pickup_location_id",
        "dropoff_location_id", "pickup_datetime", "dropoff_datetime", "sr_flag",
    ]
    assert rows(got.select("dispatching_base_num", "pickup_location_id")) == [("B1", 12)]


@pytest.fixture(scope="module")
def fact(spark):
    g = t.stage_green(
        green(
            spark,
            {},
            # the same trip again: earlier dropoff wins, then the smaller amount
            {"lpep_dropoff_datetime": ts("2019-10-01T00:01:05"), "total_amount": 3.0},
            {"lpep_dropoff_datetime": ts("2019-10-01T00:01:05"), "total_amount": 2.0},
            {"PULocationID": 56, "payment_type": None},
            {"PULocationID": 57, "payment_type": 9},
            {"lpep_pickup_datetime": ts("2021-01-01T00:00:00")},
        )
    )
    y = t.stage_yellow(yellow(spark, {}))
    trips = t.clean_trips(t.union_staged(g, y), payments(spark), [2019, 2020])
    return t.fact_trips(trips, zones(spark))


def test_fact(fact):
    got = {(r.service_type, r.pickup_location_id): r for r in fact.collect()}
    assert len(got) == fact.count() == 4
    first = got["Green", 1]
    assert (float(first.total_amount), first.trip_duration_minutes) == (2.0, 1)
    assert (first.pickup_zone, first.dropoff_zone, first.dropoff_borough) == ("Newark", "N/A", "Unknown")
    assert (first.payment_type, first.payment_type_description) == (1, "Credit card")
    assert (got["Green", 56].payment_type, got["Green", 56].payment_type_description) == (0, "Unknown")
    assert (got["Green", 57].payment_type, got["Green", 57].payment_type_description) == (9, "Unknown")
    assert got["Yellow", 999].pickup_zone is None
    assert len({r.trip_id for r in got.values()}) == 4
    assert enforce(fact, t.fact_contract()).columns == list(t.FACT_TYPES)


def test_mart(fact):
    got = {(r.pickup_zone, r.service_type): r for r in t.monthly_zone_mart(fact).collect()}
    # two ids of one zone name are one group; a missing zone has a name
    assert got["Corona", "Green"].total_monthly_trips == 2
    assert got["Unknown Zone", "Yellow"].revenue_month == dt.date(2020, 1, 1)
    assert got["Unknown Zone", "Yellow"].revenue_monthly_ehail_fee is None
    assert got["Corona", "Green"].revenue_monthly_total_amount == 24.7


def test_dims(spark):
    g = t.stage_green(green(spark, {}, {"VendorID": 3}, {"VendorID": 3}))
    assert rows(t.dim_vendors(g)) == [
        (1, "Creative Mobile Technologies, LLC"), (3, None),
    ]
    assert (264, "Unknown", "N/A", "N/A") in rows(zones(spark))


def test_green_fact_needs_positive_amounts(spark):
    g = t.green_rows(green(spark, {}, {"fare_amount": 0.0}, {"trip_distance": None}))
    got = t.green_fact(g, zones(spark))
    assert got.columns == [*t.GREEN_FACT, "pickup_day"]
    assert got.count() == 1 and got.head().pickup_day == dt.date(2019, 10, 1)


def test_green_rows_are_unique_by_first_file(spark):
    raw = green(spark, {"payment_type": None}, {"payment_type": 2}, {"payment_type": 3})
    files = spark.createDataFrame([(None, "c"), (2, "b"), (3, "a")], "p int, f string")
    named = raw.join(files, F.col("payment_type").eqNullSafe(F.col("p"))).drop("p")
    got = t.green_rows(named, order="f")
    assert rows(got.select("payment_type", "payment_type_description")) == [(3, "No charge")]
    alone = t.green_rows(named.filter("f = 'c'"), order="f")
    assert rows(alone.select("payment_type", "payment_type_description")) == [(None, "Unknown")]


def test_hourly_comparison_loses_unknown_zones(spark):
    g = green(spark, {"lpep_pickup_datetime": ts("2020-01-01T00:10:00")}, {})
    y = yellow(spark, {}, {"PULocationID": 1}, {"PULocationID": None})
    both = t.hourly_comparison(
        g, y, "lpep_pickup_datetime", "tpep_pickup_datetime", "2020-01-01 00:00:00"
    )
    assert both.count() == 3
    named = t.comparison_with_zones(both, table(spark, ZONE_CSV, {"LocationID": 1, "Zone": "Newark"}))
    assert rows(named.select("Zone", "green_amount", "yellow_amount")) == [
        ("Newark", 12.345, 6.0)
    ]
    assert "LocationID" not in named.columns


def test_interval_staging(spark):
    good = ("green", ts("2024-01-01T00:00:00"), ts("2024-01-01T00:10:00"), 1, 2.0, 3.0, 4.0)
    data = [
        good + (ts("2024-02-01T00:00:00"),),
        good[:6] + (9.0, ts("2024-02-02T00:00:00")),
        ("green", ts("2024-01-01T00:10:00"), ts("2024-01-01T00:00:00"), 1, 2.0, 3.0, 4.0, None),
        ("green", ts("2024-01-01T00:00:00"), ts("2024-01-01T00:11:00"), 1, 2.0, -3.0, 4.0, None),
        ("green", ts("2024-01-01T00:00:00"), ts("2024-01-01T00:12:00"), 1, 2.0, 3.0, None, None),
        ("green", ts("2024-01-01T00:00:00"), None, 1, 2.0, 3.0, 4.0, None),
        ("green", None, ts("2024-01-01T00:12:00"), 1, 2.0, 3.0, 4.0, None),
    ]
    df = spark.createDataFrame(
        data,
        "taxi_type string, pickup_datetime timestamp, dropoff_datetime timestamp, "
        "passenger_count int, trip_distance double, fare_amount double, total_amount double, "
        "extracted_at timestamp",
    )
    got = t.interval_staging(df, "2024-01-01", "2024-01-02")
    assert [r.total_amount for r in got.collect()] == [9.0]
    assert t.interval_staging(df, "2024-01-02", "2024-01-03").count() == 0


# --- games and matches ----------------------------------------------------------------


def side(who, result):
    return f'{{"@id":"{who}","result":"{result}"}}'


def test_player_summary(spark):
    games = spark.createDataFrame(
        [
            (side("a", "win"), side("b", "lose")),
            (side("a", "agreed"), side("b", "agreed")),
            (side("b", "lose"), side("a", "win")),
            (side("c", "win"), side("c", "lose")),
        ],
        "white string, black string",
    )
    profiles = spark.createDataFrame(
        [("A", "a"), ("B", "b"), ("C", "c"), ("D", "d"), ("E", "a"), ("E", "a"), ("N", None)],
        "username string, aid string",
    )
    got = {r.username: tuple(r)[2:] for r in m.player_summary(games, profiles).collect()}
    assert got["A"] == (3, 1, 1, 2, 1, 50.0, 100.0)
    assert got["B"] == (3, 0, 0, 1, 2, 0.0, 0.0)
    # both sides equal: one game, won from both sides
    assert got["C"] == (1, 1, 1, 1, 1, 100.0, 100.0)
    # no game: the left join's own row is counted
    assert got["D"] == got["N"] == (1, 0, 0, 0, 0, None, None)
    assert got["E"] == (6, 2, 2, 4, 2, 50.0, 100.0)


def test_player_summary_equals_the_plain_join(spark):
    who = lambda c, n: F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * c % n)
    text = lambda w, r: F.to_json(F.struct(w.cast("string").alias("@id"), r.alias("result")))
    result = lambda k: F.when(F.col("id") % 5 == k, "win").otherwise("lose")
    games = spark.range(2000).select(
        text(who(7, 40), result(0)).alias("white"), text(who(11, 45), result(1)).alias("black")
    )
    profiles = spark.range(60).select(
        F.concat(F.lit("u"), F.col("id")).alias("username"), F.col("id").cast("string").alias("aid")
    )
    m.game_results(games).createOrReplaceTempView("g")
    profiles.createOrReplaceTempView("p")
    plain = spark.sql(
        """SELECT username, aid, count(*), count_if(white_aid = aid AND winner_aid = aid),
                  count_if(black_aid = aid AND winner_aid = aid), count_if(white_aid = aid),
                  count_if(black_aid = aid)
           FROM p LEFT JOIN g ON aid = white_aid OR aid = black_aid GROUP BY username, aid"""
    )
    got = m.player_summary(games, profiles)
    assert rows(got.drop("white_win_rate", "black_win_rate")) == rows(plain)
    assert "NestedLoop" not in final_plan(got)


def test_seasons(spark):
    df = spark.createDataFrame(
        [
            (1, "FINISHED", "2023-08-01", ts("2023-08-10T00:00:00"), "HOME_TEAM", 2, 1, 66, 5),
            (2, "FINISHED", "2023-08-01", ts("2023-08-11T00:00:00"), "HOME_TEAM", 3, 0, 5, 66),
            (3, "FINISHED", "2023-08-01", ts("2023-08-12T00:00:00"), "DRAW", 1, 1, 5, 66),
            (4, "FINISHED", "2023-08-01", ts("2023-08-13T00:00:00"), "AWAY_TEAM", 0, 4, 5, 66),
            (5, "SCHEDULED", "2023-08-01", ts("2023-08-14T00:00:00"), None, None, None, 66, 5),
        ],
        "id int, status string, season__start_date string, utc_date timestamp, "
        "score__winner string, score__full_time__home int, score__full_time__away int, "
        "home_team__id int, away_team__id int",
    )
    assert rows(m.season_record(df, 66)) == [(2023, 4, 2, 1, 1)]
    points = m.running_points(df, 66).orderBy("utc_date").collect()
    assert [r.running_points for r in points] == [3, 3, 4, 7]
    assert rows(m.season_goals(df, 66)) == [(2023, 7, 5)]
    assert rows(m.season_goals_long(df, 66)) == [
        (2023, "goals_conceded", 5), (2023, "goals_scored", 7),
    ]
