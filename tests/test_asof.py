import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata import asof_join
from strata.operators.asof import slices_of

START = dt.datetime(2024, 1, 1)


def moment(chance):
    return None if chance.random() < 0.05 else START + dt.timedelta(minutes=chance.randrange(3_000))


def made(spark, seed, keys):
    chance = random.Random(seed)
    left = [(i, chance.choice(keys), chance.choice(["a", "b", None]), moment(chance)) for i in range(400)]
    right = [(chance.choice(keys), chance.choice(["a", "b", None]), moment(chance), chance.choice([None, *range(9)])) for _ in range(300)]
    one = spark.createDataFrame(left, "id int, k int, s string, at timestamp_ntz")
    return left, right, one, spark.createDataFrame(right, "key int, t string, since timestamp_ntz, price int")


def by_hand(left, right):
    out = []
    for i, k, s, at in left:
        found = [(r[2], r[3] is not None, r[3] or 0, r) for r in right if None not in (k, s, at, r[2]) and (r[0], r[1]) == (k, s) and r[2] <= at]
        row = max(found)[3] if found else (None, None, None, None)
        out.append((i, k, s, at, row[3], row[2]))
    return sorted(out)


@pytest.mark.parametrize("seconds", [60, 7_200, 10**9])
def test_newest_row_at_or_before(spark, seconds):
    left, right, one, other = made(spark, 1, [1, 1, 1, 1, 2, 3, None])
    got = asof_join(one, other, {"k": "key", "s": "t"}, {"at": "since"}, {"price": "price", "priced": "since"}, slice_seconds=seconds)
    assert got.columns == [*one.columns, "price", "priced"]
    assert sorted(map(tuple, got.collect())) == by_hand(left, right)


def test_hot_key_is_cut_into_slices_without_a_range_join(spark, plan):
    _, _, one, other = made(spark, 2, [1])
    got = asof_join(one, other, {"k": "key"}, {"at": "since"}, {"price": "price"}, slice_seconds=3_600)
    for unwanted in ("Cartesian", "NestedLoop", "Python"):
        assert unwanted not in plan(got)
    assert slices_of(one.dropna(), ["k"], "at", 3_600).agg(F.max("rows")).first()[0] < 40


def test_empty_sides_and_clashing_names(spark):
    _, _, one, other = made(spark, 3, [1, 2])
    assert asof_join(one, other.limit(0), {"k": "key"}, {"at": "since"}, {"price": "price"}).where("price is null").count() == 400
    assert asof_join(one.limit(0), other, {"k": "key"}, {"at": "since"}, {"price": "price"}).isEmpty()
    with pytest.raises(ValueError):
        asof_join(one, other, {"k": "key"}, {"at": "since"}, {"S": "price"})
    twice = one.unionByName(one)
    assert asof_join(twice, other, {"k": "key"}, {"at": "since"}, {"price": "price"}).count() == 800
