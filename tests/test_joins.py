from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faremill.functions.codes import PAYMENT_DESCRIPTIONS
from faremill.operators import joins as j
from tests.conftest import final_plan, plan, rows

ZONES = [(1, "EWR", "Newark"), (264, "Unknown", "N/A"), (56, "Queens", "Corona"), (57, "Queens", "Corona")]


def zones(spark):
    """As a stored lookup has: a size that the planner knows."""
    quoted = ", ".join(f"({i}, '{b}', '{z}')" for i, b, z in ZONES)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(location_id, borough, zone)")


def test_lookup_casts_the_dimension_key(spark):
    dim = zones(spark).withColumn("location_id", F.col("location_id").cast("string"))
    df = spark.createDataFrame([(1, 9), (999, 8), (None, 7)], "zone_id int, v int")
    joined = j.join_lookup(df, dim, "zone_id", "location_id")
    assert rows(joined) == [(1, 9, "EWR", "Newark")]
    assert j.join_lookup(df, dim, "zone_id", "location_id", "left").count() == 3


def test_roles_keep_unmatched(spark):
    df = spark.createDataFrame([(1, 264), (999, None)], "pu int, do int")
    roles = {"pickup": ("pu", {"zone": "pu_zone"}), "dropoff": ("do", {"zone": "do_zone"})}
    got = j.enrich_roles(df, zones(spark), "location_id", roles)
    assert rows(got) == [(1, 264, "Newark", "N/A"), (999, None, None, None)]
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


def test_broadcast_only_below_the_limit(spark, tmp_path):
    spark.range(30_000).withColumn("x", F.md5(F.col("id").cast("string"))).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    assert j.is_small(zones(spark), 1_000_000) and not j.is_small(big, 1_000_000)
    assert "ResolvedHint" not in j.if_small(big, 1_000_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in j.if_small(big)._jdf.queryExecution().analyzed().toString()
    # a projection of few columns is judged by what is left
    assert j.estimated_bytes(big.select("id")) < j.estimated_bytes(big)


def test_either_side_refuses_names_that_both_sides_have(spark):
    left = spark.createDataFrame([(1, "x")], "aid int, v string")
    right = spark.createDataFrame([(1, 2, "y")], "a int, b int, v string")
    with pytest.raises(ValueError, match="v"):
        j.either_side_join(left, right, "aid", ["a", "b"])


def test_default_payment(spark):
    payments = j.code_table(spark, PAYMENT_DESCRIPTIONS, "payment_type", "description")
    df = spark.createDataFrame([(1, 2), (2, None), (3, 9)], "id int, payment_type int")
    got = j.enrich_default(df, payments, "payment_type", "payment_type", "description", "label")
    assert rows(got) == [(1, 2, "Cash"), (2, 0, "Unknown"), (3, 9, "Unknown")]


def test_outer_compare(spark):
    a = spark.createDataFrame([(1, 10, 5.0)], "hour int, zone int, amount double")
    b = spark.createDataFrame([(1, 10, 7.0), (2, 10, 9.0)], "hour int, zone int, amount double")
    got = j.outer_compare(a, b, ["hour", "zone"], ("green_", "yellow_"))
    assert got.columns == ["hour", "zone", "green_amount", "yellow_amount"]
    assert rows(got) == [(1, 10, 5.0, 7.0), (2, 10, None, 9.0)]


def test_outer_compare_reuses_the_partitioning_of_its_reports(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("hour"), (F.col("id") % 5).alias("zone"))
    report = df.groupBy("hour", "zone").agg(F.count("*").alias("n"))
    text = plan(j.outer_compare(report, report.filter("n > 0"), ["hour", "zone"], ("a_", "b_")))
    initial = text[text.find("Initial Plan") :] if "Initial Plan" in text else text
    assert initial.count("Exchange hashpartitioning") == 2


def test_either_side(spark):
    players = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "aid string")
    games = spark.createDataFrame(
        [(1, "a", "b"), (2, "a", "a"), (3, None, "b"), (4, "x", None)], "g int, w string, b string"
    )
    got = j.either_side_join(players, games, "aid", ["w", "b"])
    assert rows(got.select("aid", "g")) == [
        ("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", None), (None, None),
    ]
    assert "NestedLoop" not in final_plan(got)


def test_either_side_against_the_plain_condition(spark):
    """A hot player on a third of the games, against Spark's own OR join."""
    who = lambda c, m: F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * c % m)
    games = spark.range(3000).select("id", who(7, 50).alias("w"), who(11, 60).alias("b"))
    players = spark.range(70).withColumnRenamed("id", "aid")
    got = j.either_side_join(players, games, "aid", ["w", "b"])
    plain = players.join(games, (F.col("aid") == F.col("w")) | (F.col("aid") == F.col("b")), "left")
    assert rows(got.select("aid", "id", "w", "b")) == rows(plain.select("aid", "id", "w", "b"))


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(j.orphans(child, parent, "fk", "pk")) == [(5, 2)]


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and partition sizes at which test data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_player_is_split(spark, shuffled_joins):
    """A third of the games on one player: AQE splits that player's partition."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
    games = spark.range(0, 300_000, 1, 12).select(
        "id", hot.alias("w"), (F.col("id") * 7 % 6000).alias("b"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    players = spark.range(7000).withColumnRenamed("id", "aid")
    got = j.either_side_join(players, games, "aid", ["w", "b"])
    assert "skew=true" in final_plan(got)
    both = games.filter("w = b").count()
    assert got.count() == 2 * 300_000 - both + 1000


def test_orphan_counts_do_not_shuffle_a_hot_key_row_by_row(spark, shuffled_joins):
    child = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("fk")
    )
    parent = spark.range(100).withColumnRenamed("id", "pk")
    got = j.orphans(child, parent, "fk", "pk")
    assert rows(got) == [(-1, 33334)]
    assert "partial_count" in final_plan(got)
