from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions.codes import PAYMENT_NAMES
from faremill.operators.quality import run_checks
from faremill.plans import declared_checks as d
from faremill.plans import matches as m
from faremill.plans import trips as t
from faremill.plans.stand_ins import game_source, green_source, profile_source, zone_source


def failed(df, checks):
    return {
        (r.check_name, r.column_name): r.failed_rows
        for r in run_checks(df, "t", checks).filter("NOT passed").collect()
    }


def test_green_fact(spark, sf_dir):
    zones = t.dim_zones(zone_source(spark, sf_dir))
    known = green_source(spark, sf_dir).withColumn("DOLocationID", F.col("DOLocationID") % 25)
    fact = t.green_fact(t.green_rows(known), zones)
    # line number 7 is not a payment code; every other check holds
    bad = failed(fact, d.green_fact())
    assert set(bad) == {("accepted_values", "payment_type")}
    assert bad["accepted_values", "payment_type"] == fact.filter("payment_type = 7").count()
    unrecorded = fact.withColumn("payment_type", F.lit(None).cast("int"))
    assert failed(unrecorded, d.green_fact()) == {}
    refund = fact.withColumn("total_amount", -F.col("total_amount"))
    assert ("positive_amounts", "") in failed(refund, d.green_fact())


def test_player_summary(spark, sf_dir):
    summary = m.player_summary(game_source(spark, sf_dir), profile_source(spark, sf_dir))
    assert failed(summary, d.player_summary()) == {}


def test_payment_lookup(spark):
    lookup = spark.createDataFrame(
        list(PAYMENT_NAMES.items()), "payment_type_id int, payment_type_name string"
    )
    assert failed(lookup, d.payment_lookup()) == {}
    assert failed(lookup.unionByName(lookup.limit(1)), d.payment_lookup()) == {
        ("unique", "payment_type_id"): 1
    }


def test_number_of_interval_checks():
    assert len(d.interval_staging()) + len(d.interval_report()) == 14
    assert len(d.green_fact()) == 6
