import pytest

from strata import grain_check, grain_violations, publish_append, read_appends, working_folder
from strata.plans.sizing import Bound
from strata.sources import grain as module
from strata.sources.grain import possible_keys, rows_to_compare
from strata.sources.snapshots import publish_snapshot, versions
from tests.test_digests import scanned

ODD = [(1, "a"), (2, None), (None, "c"), (None, None), (3, ""), (1, "b")]


def as_regrouped(spark, rows, path, keys):
    return rows(grain_violations(spark, path, keys)) == rows(grain_check(read_appends(spark, path), keys))


@pytest.mark.parametrize("most", [1_000, 0], ids=["ranges", "join"])
@pytest.mark.parametrize("bound", [Bound(), Bound(rows=0, bytes=0)], ids=["broadcast", "shuffled"])
def test_the_same_violations_as_by_regrouping(spark, rows, monkeypatch, most, bound):
    monkeypatch.setattr(module, "_MOST_PLACES", most)
    keys, path = ["a", "b"], working_folder(spark, "appends")
    parts = [
        spark.createDataFrame(ODD, "a int, b string"),
        spark.range(500).selectExpr("cast(id + 10 as int) as a", "'x' as b"),
        spark.createDataFrame([*ODD[:4], (11, "x"), (11, "x"), (9, "new"), (8, "twice"), (8, "twice")], "a int, b string"),
        spark.createDataFrame([], "a int, b string"),
        spark.createDataFrame([(11, "x"), (2, None), (8, "twice"), (7, "last")], "a int, b string"),
    ]
    for number, part in enumerate(parts):
        assert publish_append(part, path, keys, bound=bound) == number
        assert as_regrouped(spark, rows, path, keys)
    assert rows(grain_violations(spark, path, keys, "many").where("a = 11")) == [(11, "x", 4)]


def test_few_rows_are_read_for_an_append_without_repeated_keys(spark, rows):
    path, keys = working_folder(spark, "appends"), ["id"]
    for first in (0, 300_000, 600_000):
        publish_append(spark.range(first, first + 300_000, numPartitions=4), path, keys)
    new = spark.range(900_000, 901_000).union(spark.range(5, 8))
    number = publish_append(new, path, keys)
    possible = possible_keys(spark, path, number, [0, 1, 2], keys)
    found = {row["id"]: row["__held"] for row in possible.collect()}
    assert {5, 6, 7} <= set(found) and all(0 in found[n] for n in (5, 6, 7)) and len(found) <= 10
    read = [scanned_of(rows_to_compare(spark, path, n, possible, keys)) for n in (0, 1, 2)]
    # Pages have 4,096 rows at most; a place lies in one of them.
    assert sum(read) <= sum(map(len, found.values())) * 4_096 < 900_000 / 10
    assert rows(grain_violations(spark, path, keys)) == [(5, 2), (6, 2), (7, 2)]
    assert as_regrouped(spark, rows, path, keys)


def scanned_of(df):
    df.collect()
    return scanned(df._jdf.queryExecution().executedPlan())


def test_an_append_whose_check_did_not_end_is_checked_later(spark, rows):
    path, keys = working_folder(spark, "appends"), ["a"]
    publish_append(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), path, keys)
    late = spark.createDataFrame([(2, "z"), (3, "z")], "a int, b string").withColumn("__place", module._place(keys))
    publish_snapshot(late, path)  # rows are there, filter and violations are not
    assert as_regrouped(spark, rows, path, keys)
    publish_append(spark.createDataFrame([(3, "w")], "a int, b string"), path, keys)
    assert rows(grain_violations(spark, path, keys)) == [(2, 2), (3, 2)] and len(versions(spark, path)) == 3


def test_a_hot_key(spark, rows):
    path, keys = working_folder(spark, "appends"), ["k"]
    frame = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as k", "id as v")
    publish_append(frame, path, keys)
    publish_append(frame.where("v < 300"), path, keys)
    assert as_regrouped(spark, rows, path, keys)
    assert (-1, 10_100) in rows(grain_violations(spark, path, keys))
