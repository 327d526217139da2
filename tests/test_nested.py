from __future__ import annotations

import glob
import json
import os

from pyspark.sql import functions as F

from faremill.sources import nested as n
from tests.conftest import plan, rows

RECORDS = [
    {
        "id": 1, "homeTeam": {"name": "x", "squad": [{"no": 7, "tags": ["a", "b"]}, {"no": 9, "tags": []}]},
        "goals": [3, 44], "grid": [[1, 2], [], [3]], "_row_key": "own",
    },
    {"id": 2, "homeTeam": {"name": "y", "squad": None}, "goals": [], "grid": None, "_row_key": None},
    {"id": 3, "homeTeam": None, "goals": None, "grid": [None], "_row_key": "z"},
    {"id": 4, "homeTeam": {"name": "w", "squad": [None]}, "goals": [None, 5], "grid": [], "_row_key": "q"},
]
SCHEMA = (
    "id long, homeTeam struct<name: string, squad: array<struct<no: int, tags: array<string>>>>, "
    "goals array<int>, grid array<array<int>>, _row_key string"
)


def landed(spark, folder):
    with open(folder + "/pages.json", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in RECORDS)
    return spark.read.schema(SCHEMA).json(folder + "/pages.json")


def test_tables_of_a_record(spark, folder):
    tables = n.split_lists(landed(spark, folder), "match", ["id"])
    assert list(tables) == [
        "match", "match__home_team__squad", "match__home_team__squad__tags", "match__goals",
        "match__grid", "match__grid__list",
    ]
    root = tables["match"]
    assert root.columns == ["_row_key", "id", "home_team__name", "row_key"]
    assert rows(root.select("id", "home_team__name", "row_key")) == [
        (1, "x", "own"), (2, "y", None), (3, None, "z"), (4, "w", "q"),
    ]
    squad = n.with_parent(tables["match__home_team__squad"], root, ["id"])
    assert rows(squad.select("id", "_place", "no")) == [(1, 0, 7), (1, 1, 9), (4, 0, None)]
    tags = n.with_parent(tables["match__home_team__squad__tags"], squad, ["id", "no"])
    assert rows(tags.select("id", "no", "_place", "value")) == [(1, 7, 0, "a"), (1, 7, 1, "b")]
    goals = n.with_parent(tables["match__goals"], root, ["id"])
    assert rows(goals.select("id", "_place", "value")) == [
        (1, 0, 3), (1, 1, 44), (4, 0, None), (4, 1, 5),
    ]
    grid = n.with_parent(tables["match__grid"], root, ["id"]).withColumnRenamed("_place", "line")
    cells = n.with_parent(tables["match__grid__list"], grid, ["id", "line"])
    assert rows(cells.select("id", "line", "_place", "value")) == [
        (1, 0, 0, 1), (1, 0, 1, 2), (1, 2, 0, 3),
    ]
    assert rows(grid.select("id", "line")) == [(1, 0), (1, 1), (1, 2), (3, 0)]


def test_keys_are_stable_and_distinct(spark, folder):
    df = landed(spark, folder)
    once, again = (n.split_lists(d, "m", ["id"]) for d in (df, df.repartition(3)))
    for name in once:
        keys = rows(once[name].select("_row_key"))
        assert keys == rows(again[name].select("_row_key"))
        assert len(set(keys)) == len(keys)
    odd = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), (None, "x"), ("x", None)], "p string, q string")
    keys = rows(odd.select(n.record_key(["p", "q"])))
    assert len(set(keys)) == 4


def test_written_tables(spark, folder):
    tables = n.write_lists(landed(spark, folder), "m", folder + "/out", ["id"])
    assert spark.read.parquet(folder + "/out/m__goals").count() == tables["m__goals"].count() == 4
    empty = n.write_lists(landed(spark, folder).limit(0), "m", folder + "/none")
    assert all(t.count() == 0 for t in empty.values())


def test_names_that_clash_with_keys(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_item int, _place int, _parent_key int")
    wrapped = df.select(F.array(F.struct("*")).alias("list"))
    tables = n.split_lists(wrapped, "t")
    assert tables["t__list"].columns == [
        "_row_key", "_parent_key", "_place", "item", "place", "parent_key",
    ]
    assert rows(tables["t__list"].select("item", "place", "parent_key")) == [(1, 2, 3)]


def test_other_keys_than_hashes(spark):
    """Texts that are no hash, or look like a packed one, and NULLs keep what they are."""
    md5 = "0123456789abcdef0123456789abcdef"
    odd = [md5, md5.upper(), "g" * 32, "ab" * 8, "a", "", "é" * 16, "\x00" * 17 + "a", None]
    parent = spark.createDataFrame([(k, i) for i, k in enumerate(odd)], "_row_key string, id int")
    child = spark.createDataFrame(
        [(r, k, i) for i, k in enumerate(odd) for r in (md5, "x", None)],
        "_row_key string, _parent_key string, _place int",
    )
    got = n.with_parent(child, parent, ["id"])
    assert got.columns == ["_parent_key", "_row_key", "_place", "id"]
    assert rows(got) == sorted(
        ((k, r, i, i) for i, k in enumerate(odd) if k is not None for r in (md5, "x", None)),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    twice = n.with_parent(child, parent.union(parent), ["id", "_row_key"])
    assert twice.count() == 6 * (len(odd) - 1)
    numbers = spark.createDataFrame([(1, 5)], "_row_key int, id int")
    some = spark.createDataFrame([(2, 1, 0), (3, 9, 0)], "_row_key int, _parent_key int, _place int")
    assert rows(n.with_parent(some, numbers, ["id"])) == [(1, 2, 0, 5)]


def test_keys_are_small_where_rows_are_shuffled_and_stored(spark, folder):
    df = spark.range(20_000).select("id", F.array(F.col("id"), F.col("id") + 1).alias("list"))
    tables = n.write_lists(df, "t", folder, ["id"])
    stored = sum(os.path.getsize(f) for f in glob.glob(folder + "/t__list/*.parquet"))
    assert stored < 40_000 * 40  # 55 bytes a row by the default codec
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(n.with_parent(tables["t__list"], tables["t"], ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("unhex(_parent_key") == 1 and text.count("unhex(_row_key") == 2
    assert "isnotnull(coalesce" not in text
