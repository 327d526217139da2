from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.sources import files, landing, months
from tests.conftest import rows, ts

RECORD = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]
)


def write_text(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


# --- files ----------------------------------------------------------------------------


def test_csv_variants(spark, tmp_path):
    write_text(tmp_path / "c" / "a.csv", "id,name,at", "1,x,2024-01-01 00:00:00", "2,,")
    path = str(tmp_path / "c")
    assert [t for _, t in files.read_csv(spark, path).dtypes] == ["string"] * 3
    inferred = files.read_csv(spark, path, infer=True)
    assert [t for _, t in inferred.dtypes] == ["int", "string", "timestamp"]
    typed = files.read_csv(spark, path, "id bigint, name string, at timestamp")
    assert rows(typed) == [(1, "x", ts("2024-01-01T00:00:00")), (2, None, None)]


def test_sample_schema_ignores_later_rows_and_repeated_headers(spark, tmp_path):
    write_text(tmp_path / "one" / "a.csv", "id,v", "1,2", "3,4", "5,late text")
    one = str(tmp_path / "one")
    assert files.infer_from_sample(spark, one, 2).simpleString() == "struct<id:int,v:int>"
    assert files.infer_from_sample(spark, one, 3).simpleString() == "struct<id:int,v:string>"
    write_text(tmp_path / "two" / "a.csv", "id,v", "1,2")
    write_text(tmp_path / "two" / "b.csv", "id,v", "3,4")
    two = files.infer_from_sample(spark, str(tmp_path / "two"), 10)
    assert two.simpleString() == "struct<id:int,v:int>"


def test_a_value_outside_the_sampled_type_is_an_error(spark, tmp_path):
    write_text(tmp_path / "s" / "a.csv", "id,v", "1,2", "3,4", "5,12.5")
    assert rows(files.read_sampled(spark, str(tmp_path / "s"), 3)) == [(1, 2.0), (3, 4.0), (5, 12.5)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        files.read_sampled(spark, str(tmp_path / "s"), 2).collect()


def test_unreadable_pages_are_not_lost(spark):
    good, cut = '{"docs": [{"id": 1, "name": "x"}]}', '{"docs": [{"id": 2, "na'
    df = spark.createDataFrame([(1, good), (2, cut), (3, None), (4, '{"docs": []}')], "page int, body string")
    assert [r.page for r in landing.unreadable_pages(df).orderBy("page").collect()] == [2, 3]
    with pytest.raises(Exception, match="MALFORMED"):
        landing.json_records(df, "docs", RECORD).collect()
    size = F.json_array_length(F.get_json_object("body", "$.docs"))
    left = landing.pages_until_empty(df, "page", size)
    assert sorted(r.page for r in left.collect()) == [1, 2, 3]


def test_external_gz(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "gz"))
    for _ in range(2):
        files.external_csv(spark, "ext", str(tmp_path / "gz/*.csv.gz"), "id int, v string")
    assert spark.sql("SELECT sum(id) FROM ext").head()[0] == 3


def test_parquet_globs_and_heads(spark, tmp_path):
    for m in (1, 2):
        spark.range(m).write.parquet(str(tmp_path / f"p/2024/{m}"))
    df = files.read_parquet(spark, str(tmp_path / "p/*/*"), ["id"])
    assert df.count() == 3
    assert rows(files.head_rows(df, 2, "id")) == [(0,), (0,)]


def test_paths_are_uris(spark, tmp_path):
    spark.range(3).write.parquet((tmp_path / "u").as_uri())
    assert files.read_parquet(spark, (tmp_path / "u").as_uri()).count() == 3


def test_seed(spark, tmp_path):
    write_text(tmp_path / "s.csv", "k,v", "1,a", ",b")
    with pytest.raises(ValueError):
        files.seed(spark, str(tmp_path / "s.csv"), "k int, v string", "k")
    assert files.seed(spark, str(tmp_path / "s.csv"), "k int, v string").count() == 2


def test_object_store_conf():
    conf = files.object_store_conf("gs", {"impl": "x", "auth.type": "y"})
    assert conf == {"spark.hadoop.fs.gs.impl": "x", "spark.hadoop.fs.gs.auth.type": "y"}


# --- months ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "start, end, want",
    [
        ("2024-01-15", "2024-02-01", ["2024-01"]),
        ("2024-01-15", "2024-02-02", ["2024-01", "2024-02"]),
        ("2023-12-01", "2024-01-02", ["2023-12", "2024-01"]),
        ("2024-01-01", "2024-01-01", []),
    ],
)
def test_months_covering(start, end, want):
    got = months.months_covering(dt.date.fromisoformat(start), dt.date.fromisoformat(end))
    assert got == want


def test_read_months(spark, folder):
    yellow = spark.createDataFrame(
        [(ts("2024-01-05T00:00:00"), ts("2024-01-05T01:00:00"), 1.5)],
        "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, fare_amount double",
    )
    green = spark.createDataFrame(
        [(ts("2024-01-06T00:00:00"), ts("2024-01-06T01:00:00"), 2.5, 9)],
        "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, fare_amount double, "
        "trip_type int",
    )
    yellow.write.parquet(f"{folder}/yellow_tripdata_2024-01.parquet")
    green.write.parquet(f"{folder}/green_tripdata_2024-01.parquet")
    got = months.read_months(
        spark, folder, ["yellow", "green"], dt.date(2024, 1, 3), dt.date(2024, 2, 1),
        dt.datetime(2024, 3, 1),
    )
    assert rows(got.select("taxi_type", "fare_amount", "trip_type", "extracted_at")) == [
        ("green", 2.5, 9, ts("2024-03-01T00:00:00")),
        ("yellow", 1.5, None, ts("2024-03-01T00:00:00")),
    ]


# --- pages ----------------------------------------------------------------------------


def pages(spark, *bodies):
    return spark.createDataFrame(
        [(i, json.dumps(b)) for i, b in enumerate(bodies, 1)], "page int, body string"
    )


def test_selectors(spark):
    a, b = {"id": 1, "name": "x"}, {"id": 2, "name": "y"}
    for selector, bodies in {
        "$": ([a], [b]), "matches": ({"n": 2, "matches": [a]}, {"matches": [b]}),
        "docs": ({"docs": [a, b]}, {"docs": []}),
    }.items():
        got = landing.json_records(pages(spark, *bodies), selector, RECORD)
        assert [r[1:] for r in rows(got)] == [(1, "x"), (2, "y")], selector


def test_whole_file_pages(spark, tmp_path):
    write_text(tmp_path / "p" / "1.json", "{", '"docs": [{"id": 1,', '"name": "x"}]', "}")
    body = landing.read_pages(spark, str(tmp_path / "p"), one_per_file=True)
    assert rows(landing.json_records(body, "docs", RECORD)) == [(1, "x")]


def test_pages_until_empty(spark):
    r = {"id": 1, "name": "x"}
    size = F.size(landing.page_records("body", "$", RECORD))
    got = landing.pages_until_empty(pages(spark, [r], [r], [], [r]), "page", size)
    assert [r.page for r in got.orderBy("page").collect()] == [1, 2]
    assert landing.pages_until_empty(pages(spark, [r], [r]), "page", size).count() == 2
    assert landing.pages_until_empty(pages(spark, []), "page", size).count() == 0
    assert landing.limit_pages(pages(spark, [r], [r], [r]), "page", 2).count() == 2


@settings(max_examples=50, deadline=None)
@given(st.dates(dt.date(2015, 1, 1), dt.date(2024, 1, 1)), st.integers(0, 3000), st.integers(1, 900))
def test_chunks_cover_the_range_once(start, length, days):
    end = start + dt.timedelta(days=length)
    chunks = landing.date_chunks(start, end, days)
    assert chunks[0][1] == end and chunks[-1][0] == start
    for (low, high), (next_low, next_high) in zip(chunks, chunks[1:]):
        assert next_high == low - dt.timedelta(days=1)
        assert (high - low).days == days
    assert all(low <= high for low, high in chunks)


@pytest.mark.parametrize("length, days", [(0, 700), (700, 700), (701, 700), (2500, 700), (9, 3)])
def test_chunk_rows_equal_the_list(spark, length, days):
    start = dt.date(2020, 1, 1)
    end = start + dt.timedelta(days=length)
    listed = landing.date_chunks(start, end, days)
    table = landing.chunk_table(spark, start, end, days).orderBy("chunk").collect()
    assert [(r.low, r.high) for r in table] == listed
    every = spark.range(-3, length + 3).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    for r in every.withColumn("c", landing.chunk_of(F.col("d"), start, end, days)).collect():
        want = [i for i, (low, high) in enumerate(listed) if low <= r.d <= high]
        assert ([] if r.c is None else [r.c]) == want


def test_union_chunks_drops_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert landing.union_chunks([a, a.filter("id = 2")], ["id"]).count() == 2
    b = spark.createDataFrame([(2, "a"), (3, "z"), (3, "b")], "id int, v string")
    assert rows(landing.union_chunks([a, b], ["id"])) == [(1, "x"), (2, "y"), (3, "b")]
    assert rows(landing.union_chunks([b, a], ["id"])) == [(1, "x"), (2, "a"), (3, "b")]


def test_cursor(spark):
    df = spark.createDataFrame(
        [(1, ts("2024-01-01T00:00:00")), (2, ts("2024-02-01T00:00:00"))], "id int, at timestamp"
    )
    initial = landing.initial_cursor(dt.datetime(2024, 2, 10))
    assert initial == dt.datetime(2024, 1, 11)
    assert rows(landing.cursor_slice(df, "at", None, initial).select("id")) == [(2,)]
    state = landing.cursor_state(df.filter("id = 1"), "at")
    # inclusive: the record at the cursor comes again
    assert landing.cursor_slice(df, "at", state, initial).count() == 2
    empty = landing.cursor_state(df.limit(0), "at")
    assert rows(landing.cursor_slice(df, "at", empty, initial).select("id")) == [(2,)]


def test_child_with_parent(spark):
    issues = spark.createDataFrame([(10, 1), (11, 2)], "id int, number int")
    comments = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 9, "c")], "cid int, n int, t string")
    got = landing.child_with_parent(issues, comments, "number", "n", ["id"], "issues")
    assert rows(got.select("cid", "_issues_id")) == [(1, 10), (2, 10)]


def test_flatten(spark):
    text = '{"id":1,"homeTeam":{"id":66,"shortName":"x"},"score":{"fullTime":{"home":2}},"@type":"m","tags":[1]}'
    df = spark.read.json(spark.sparkContext.parallelize([text]))
    flat = landing.flatten(df)
    assert sorted(flat.columns) == [
        "home_team__id", "home_team__short_name", "id", "score__full_time__home", "tags", "type",
    ]
    assert flat.head().home_team__id == 66
