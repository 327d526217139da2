from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill.operators.rows import cut_in_ranges, dedup, dedup_by_file, running, running_total
from faremill.operators.writers import append
from faremill.session import workspace
from tests.conftest import final_plan, plan, rows


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame(
        [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("k", None, "n"), ("m", None, "x")],
        "key string, t int, v string",
    )
    assert rows(dedup(df, ["key"], "t")) == [("k", 1, "a"), ("m", None, "x")]
    assert rows(dedup(df, ["key"], "t", "last")) == [("k", 2, "b"), ("m", None, "x")]


def test_dedup_treats_null_keys_as_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "key string, t int")
    assert rows(dedup(df, ["key"], "t")) == [(None, 1)]


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(100000).select((F.col("id") % 3).alias("k"), "id")
    kept = dedup(df, ["k"], "id")
    assert plan(kept).count("WindowGroupLimit") >= 2
    assert rows(kept) == [(0, 0), (1, 1), (2, 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)), max_size=30))
def test_dedup_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    best: dict[int, tuple] = {}
    for k, t, v in data:
        best[k] = min(best.get(k, (k, t, v)), (k, t, v))
    assert rows(dedup(df, ["k"], "t")) == sorted(best.values(), key=str)


def test_by_file(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").coalesce(1)
    append(df, folder)
    both = append(df.withColumn("v", F.upper("v")), folder)
    kept = dedup_by_file(both, ["id"], ["v"])
    assert kept.count() == 2
    first = min(r.f for r in both.select(F.col("_metadata.file_name").alias("f")).collect())
    assert {r.source_file for r in kept.collect()} == {first}


def brute_force(data):
    """Running totals by hand: group, then order with NULLs last, then id."""
    out, sums = [], {}
    for g, t, i, v in sorted(
        data, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2])
    ):
        sums[g] = sums.get(g, 0) + (v or 0)
        out.append((g, t, i, v, sums[g]))
    return out


def test_running_total_with_a_hot_group(spark):
    """A third of the rows share one group; ties, NULL groups, NULL times and NULL values."""
    data = [
        (
            None if i % 17 == 0 else 1 if i % 3 == 0 else i % 11,
            None if i % 23 == 0 else i * 37 % 40,
            i,
            None if i % 29 == 0 else i % 13,
        )
        for i in range(2000)
    ]
    df = spark.createDataFrame(data, "g int, t int, id int, v int").repartition(5)
    got = running_total(df, ["g"], ["t", "id"], "v", "total", pieces=7)
    want = sorted(brute_force(data), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(got) == want


def test_running_total_cuts_the_hot_group(spark):
    df = spark.range(9000).select(F.lit(1).alias("g"), "id", F.lit(1).alias("v"))
    got = running_total(df, ["g"], ["id"], "v", "total", pieces=9)
    assert got.filter(F.col("total") != F.col("id") + 1).count() == 0
    # rows are sorted per (group, piece), never per group alone
    with cut_in_ranges(df, ["g"], ["id"], 9) as cut:
        text = final_plan(running(cut, ["g"], ["id"], "v", "total"))
    assert "hashpartitioning(g" in text and "_piece" in text


def test_running_total_leaves_no_copy(spark):
    base = os.path.dirname(workspace(spark, "x").removeprefix("file:"))
    df = spark.range(10).select(F.lit(1).alias("g"), "id", F.lit(1).alias("v"))
    assert running_total(df, ["g"], ["id"], "v", "total").count() == 10
    with pytest.raises(ArithmeticError), cut_in_ranges(df, ["g"], ["id"], 2):
        raise ArithmeticError
    assert not [n for n in os.listdir(base) if n.startswith("pieces-")]


def test_running_maximum(spark):
    """Per group over several pieces; NULL values are passed over."""
    data = [(i % 3 or None, i, None if i % 5 == 0 else i * 7919 % 1000) for i in range(600)]
    df = spark.createDataFrame(data, "g int, id int, v int").repartition(4)
    with cut_in_ranges(df, ["g"], ["id"], 7) as cut:
        got = rows(running(cut, ["g"], ["id"], "v", "top", "max"))
    want, top = [], {}
    for g, i, v in data:
        if v is not None:
            top[g] = max(top.get(g, v), v)
        want.append((g, i, v, top.get(g)))
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, 0, 1]), st.sampled_from([None, 1, 2, 3]), st.integers(-5, 5)),
        max_size=25,
    )
)
def test_running_total_against_brute_force(spark, data):
    numbered = [(g, t, i, v) for i, (g, t, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "g int, t int, id int, v int")
    got = running_total(df, ["g"], ["t", "id"], "v", "total", pieces=4)
    want = sorted(brute_force(numbered), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(got) == want
