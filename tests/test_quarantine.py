from __future__ import annotations

import json
import os

from faremill.sources import quarantine as q
from faremill.sources.landing import read_pages
from tests.conftest import rows

SCHEMA = "id int, price double, at timestamp, note string"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_csv_lines(spark, folder):
    write(
        folder + "/in/a.csv",
        "id,price,at,note\n1,1.5,2024-01-01 00:00:00,ok\nx,2.5,2024-01-01 00:00:00,bad id\n"
        '2,,,"a, quoted"\n3,oops,never,two\n4,1.0\n5,1.0,2024-01-01 00:00:00,long,er\n',
    )
    write(folder + "/in/b.csv", "id,price,at,note\n6,6.0,2024-02-01 00:00:00,\n,,,\n")
    good, bad = q.split_csv(spark, folder + "/in", SCHEMA)
    assert rows(good.select("id", "note")) == [(1, "ok"), (2, "a, quoted"), (6, None), (None, None)]
    assert rows(bad.select("line", "reason")) == [
        ("3,oops,never,two", "not of its type: price, at"),
        ("4,1.0", "other number of fields"),
        ("5,1.0,2024-01-01 00:00:00,long,er", "other number of fields"),
        ("x,2.5,2024-01-01 00:00:00,bad id", "not of its type: id"),
    ]
    assert {os.path.basename(r.file) for r in bad.collect()} == {"a.csv"}
    # every data line is in one of the two
    assert good.count() + bad.count() == 8


def test_types_of_a_sample(spark, folder):
    write(folder + "/s.csv", "a,b\n1,x\n2,y\n" + "".join(f"{i},z\n" for i in range(20)) + "late,z\n")
    good, bad = q.split_sampled(spark, folder + "/s.csv", rows=5)
    assert dict(good.dtypes)["a"] == "int"
    assert (good.count(), rows(bad.select("line", "reason"))) == (
        22, [("late,z", "not of its type: a")],
    )
    kept, counts = q.set_aside(good, bad, folder + "/aside")
    assert kept.count() == 22 and counts == {"not of its type: a": 1}
    assert spark.read.parquet(folder + "/aside").count() == 1


def test_pages_and_records(spark, folder):
    record = "id long, price double"
    pages = [
        {"matches": [{"id": 1, "price": 1.5}, {"id": "x", "price": 2.0}, {"id": 3}]},
        {"other": []},
        {"matches": []},
        {"matches": [{"id": 4, "price": 1.0}, 7, None]},
    ]
    text = "\n".join(map(json.dumps, pages)) + '\n{"matches": [{"id": 5, "pri\nno json\n'
    write(folder + "/p/pages.json", text)
    good, bad = q.split_pages(read_pages(spark, folder + "/p"), "matches", record)
    assert rows(good) == [(1, 1.5), (3, None), (4, 1.0)]
    found = {(r.place, r.reason) for r in bad.collect()}
    assert found == {
        (1, "record does not fit"), (2, "record does not fit"), (None, "no list at matches"),
        (None, "no JSON document"),
    }
    assert rows(bad.filter("place IS NULL").select("text", "reason"))[0][1] is not None
    # three unreadable pages, and of the six records of the others three good ones
    assert bad.filter("place IS NULL").count() == 3
    assert good.count() + bad.filter("place IS NOT NULL").count() == 6


def test_a_page_that_is_a_list(spark, folder):
    write(folder + "/p/a.json", '[{"id": 1}, {"id": 2}]\n{"id": 3}\n[1')
    pages = read_pages(spark, folder + "/p").selectExpr("body", "7 AS page")
    good, bad = q.split_pages(pages, "$", "id long")
    assert rows(good) == [(7, 1), (7, 2)]
    assert bad.columns == ["page", "place", "text", "reason"] and bad.count() == 2
