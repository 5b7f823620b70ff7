import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata import delta_chain, pit_snapshots, rebase_chain, roll_chain, snapshot_from_chain, snapshots_between
from strata.functions.dates import start_after
from strata.operators.chain import nodes_of, nodes_with, period_number

ORIGIN, LAST = dt.date(2020, 1, 15), dt.date(2021, 8, 3)
OPTIONS = {"keys": ["k"], "order": ["at", "n"], "deleted": "gone"}


@pytest.fixture
def changes(spark):
    chance = random.Random(1)
    rows = []
    for n in range(600):
        day = dt.datetime(2019, 11, 1) + dt.timedelta(days=chance.randrange(640))
        rows.append((chance.choice([None, 1, 1, 1, *range(2, 40)]), day, n, chance.choice(["x", None, "y"]), chance.random() < 0.2))
    return spark.createDataFrame(rows, "k int, at timestamp_ntz, n int, v string, gone boolean")


def whole(changes, unit, first, last):
    made = pit_snapshots(changes, upto=last, unit=unit, **OPTIONS)
    return made.where(F.col("period") >= F.lit(first))


@pytest.mark.parametrize("unit", ["month", "week", "quarter", "year"])
def test_every_period_equals_the_full_copy(changes, rows, unit):
    chain = delta_chain(changes, origin=ORIGIN, upto=LAST, unit=unit, **OPTIONS).cache()
    first = dt.date(2020, 1, 15)
    got = snapshots_between(chain, first, LAST, origin=ORIGIN, unit=unit, **OPTIONS)
    start = {"month": dt.date(2020, 1, 1), "week": dt.date(2020, 1, 13), "quarter": dt.date(2020, 1, 1), "year": dt.date(2020, 1, 1)}[unit]
    columns = ["period", "k", "at", "n", "v"]
    assert rows(got, *columns) == rows(whole(changes, unit, start, LAST), *columns)
    # A period reads as many nodes as its number has binary ones, and a change is stored in log n of them.
    last = period_number(LAST, ORIGIN, unit)
    assert chain.agg(F.max("node")).first()[0] <= last
    assert chain.count() <= changes.count() * (last.bit_length() + 1)


def test_nodes_of_periods():
    for last in (1, 7, 64, 700):
        for number in range(last + 1):
            assert len(nodes_of(number)) == bin(number).count("1") + 1
            assert len(nodes_with(number, last)) <= last.bit_length() + 1
            for other in range(number + 1):  # a period's change is read once
                assert len(set(nodes_of(number)) & set(nodes_with(other, last))) == 1


def test_late_rows_replace_few_nodes(changes, rows):
    upto, stored_upto = dt.date(2021, 11, 2), dt.date(2021, 3, 1)
    known = (F.col("n") % 50 != 0) & (F.col("at") < F.lit("2021-04-01").cast("timestamp_ntz"))
    chain = delta_chain(changes.where(known), origin=ORIGIN, upto=stored_upto, **OPTIONS).cache()
    rebuilt, touched = roll_chain(chain, changes.where(~known), origin=ORIGIN, stored_upto=stored_upto, upto=upto, **OPTIONS)
    rolled = chain.where(~F.col("node").isin(touched)).unionByName(rebuilt)
    wanted = delta_chain(changes, origin=ORIGIN, upto=upto, **OPTIONS)
    assert rows(rolled, *sorted(wanted.columns)) == rows(wanted, *sorted(wanted.columns))
    one = changes.where("year(at) = 2020 and month(at) = 5").orderBy("n").limit(1)
    _, touched = roll_chain(chain, one, origin=ORIGIN, stored_upto=stored_upto, **OPTIONS)
    assert len(touched) <= 4  # of 15 months


def test_one_period_reads_its_nodes_only(changes, spark, plan, tmp_path):
    delta_chain(changes, origin=ORIGIN, upto=LAST, **OPTIONS).write.partitionBy("node").parquet(str(tmp_path / "chain"))
    stored = spark.read.parquet(str(tmp_path / "chain"))
    got = snapshot_from_chain(stored, dt.date(2021, 4, 20), origin=ORIGIN, **OPTIONS)
    assert "node" in plan(got).split("PartitionFilters: [")[1].split("]")[0]
    wanted = changes.where(F.col("at") < F.lit("2021-05-01").cast("timestamp_ntz"))
    wanted = pit_snapshots(wanted, upto=dt.date(2021, 4, 1), **OPTIONS).where("period = date'2021-04-01'")
    assert sorted(map(str, got.select("k", "n").collect())) == sorted(map(str, wanted.select("k", "n").collect()))


def test_a_later_origin_gives_the_same_periods(changes, rows):
    chain = delta_chain(changes, origin=ORIGIN, upto=LAST, **OPTIONS)
    origin = dt.date(2020, 12, 1)
    based = rebase_chain(chain, origin, origin=ORIGIN, upto=LAST, **OPTIONS)
    wanted = delta_chain(changes, origin=origin, upto=LAST, **OPTIONS)
    assert rows(based, *sorted(wanted.columns)) == rows(wanted, *sorted(wanted.columns))


def test_lost_rows_fail_and_empty_ones_do_not(changes, spark):
    for at in (None, dt.datetime(2030, 1, 1)):
        odd = changes.limit(1).withColumn("at", F.lit(at).cast("timestamp_ntz"))
        with pytest.raises(PySparkException):
            delta_chain(odd, origin=ORIGIN, upto=LAST, **OPTIONS).collect()
    empty = delta_chain(changes.limit(0), origin=ORIGIN, upto=LAST, **OPTIONS)
    assert snapshot_from_chain(empty, LAST, origin=ORIGIN, **OPTIONS).isEmpty()
    assert start_after(dt.date(2021, 8, 1)) == dt.date(2021, 9, 1)


def steps(plan, df):
    """Operators of a plan, the last one first."""
    found = (line.lstrip("+-:* (0123456789)").split("(")[0].split() for line in plan(df).splitlines())
    return [words[0] for words in found if words]


def test_late_rows_are_sorted_before_they_are_repeated(changes, plan):
    chain = changes.limit(0).withColumn("node", F.lit(0).cast("long"))
    rebuilt, _ = roll_chain(chain, changes, origin=ORIGIN, stored_upto=LAST, **OPTIONS)
    made = steps(plan, rebuilt)
    assert made.index("BroadcastHashJoin") < made.index("Window") < made.index("Sort")


@pytest.mark.parametrize("first, last", [((2020, 6, 1), (2021, 2, 9)), ((2021, 8, 1), (2021, 8, 31)), ((2021, 2, 1), (2021, 1, 1))])
def test_some_periods_after_late_rows(changes, rows, first, last):
    known = F.col("n") % 7 != 0
    chain = delta_chain(changes.where(known), origin=ORIGIN, upto=LAST, **OPTIONS).cache()
    rebuilt, touched = roll_chain(chain, changes.where(~known), origin=ORIGIN, stored_upto=LAST, **OPTIONS)
    rolled = chain.where(~F.col("node").isin(touched)).unionByName(rebuilt)
    first, last, columns = dt.date(*first), dt.date(*last), ["period", "k", "at", "n", "v"]
    got = snapshots_between(rolled, first, last, origin=ORIGIN, **OPTIONS)
    wanted = whole(changes, "month", first, LAST).where(F.col("period") <= F.lit(last))
    assert rows(got, *columns) == rows(wanted, *columns)


def test_nodes_are_sorted_before_they_are_repeated(changes, spark, plan, tmp_path):
    chain = delta_chain(changes, origin=ORIGIN, upto=LAST, **OPTIONS)
    made = steps(plan, chain)
    assert made.index("BroadcastHashJoin") < made.index("Window") < made.index("Sort")
    chain.write.partitionBy("node").parquet(str(tmp_path / "chain"))
    made = steps(plan, snapshots_between(spark.read.parquet(str(tmp_path / "chain")), ORIGIN, LAST, origin=ORIGIN, **OPTIONS))
    assert made.index("Generate") < made.index("Window") < made.index("Sort")
    assert made.count("Exchange") == 1 and "BroadcastHashJoin" not in made
