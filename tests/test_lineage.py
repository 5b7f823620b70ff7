import datetime as dt

import pytest

import strata as st

ENDS = "source string, source_part string, target string, target_part string"


def link_rows(spark, rows):
    return spark.createDataFrame(rows, ENDS)


def steps(spark, links, changed):
    found = st.downstream(links, spark.createDataFrame(changed, "table string, part string")).collect()
    return sorted(((r["table"], r["part"], r["step"]) for r in found), key=str)


def test_a_partition_comes_after_all_it_is_made_of(spark):
    links = link_rows(spark, [("raw", "1", "a", "x"), ("a", "x", "b", "x"), ("raw", "1", "b", "x"), ("b", "x", "c", None), ("raw", "2", "a", "y")])
    assert steps(spark, links, [("raw", "1")]) == [("a", "x", 1), ("b", "x", 2), ("c", None, 3)]
    assert steps(spark, links, [("raw", "2"), ("raw", "9")]) == [("a", "y", 1)]
    assert steps(spark, links, [("a", "x"), ("raw", "1")]) == [("a", "x", 1), ("b", "x", 2), ("c", None, 3)]
    assert steps(spark, links, []) == []
    assert steps(spark, link_rows(spark, []), [("raw", "1")]) == []


def test_null_partitions_and_loops(spark):
    assert steps(spark, link_rows(spark, [("a", None, "b", "1")]), [("a", None)]) == [("b", "1", 1)]
    with pytest.raises(ValueError, match="each other"):
        steps(spark, link_rows(spark, [("a", "1", "b", "1"), ("b", "1", "a", "1")]), [("a", "1")])


def test_the_newest_run_says_what_a_partition_is_made_of(spark):
    lineage = st.PartitionLineage(spark, st.working_folder(spark, "lineage"))
    assert lineage.links().count() == 0
    lineage.record("job", link_rows(spark, [("a", "1", "b", "x"), ("a", "2", "b", "x"), ("a", "1", "b", "y")]), dt.datetime(2024, 1, 1))
    for _ in range(2):  # repeated after a failure
        lineage.record("job", link_rows(spark, [("a", "3", "b", "x"), ("a", "3", "b", "x")]), dt.datetime(2024, 1, 2))
    assert sorted((r["source_part"], r["target_part"]) for r in lineage.links().collect()) == [("1", "y"), ("3", "x")]
    with pytest.raises(ValueError):
        lineage.record("", link_rows(spark, []))


def test_two_chained_products_rebuilt_by_steps_equal_those_from_scratch(spark):
    base = st.working_folder(spark, "chained")
    rows = [(f"2023-{m:02}", m) for m in range(1, 13)] + [("2024-01", 1), ("2024-02", 2)]
    raw = spark.createDataFrame(rows, "month string, n long")
    late = raw.unionByName(spark.createDataFrame([("2024-02", 100)], raw.schema))

    def quarters(source):
        made = source.selectExpr("concat(left(month, 4), '-', ceil(right(month, 2) / 3)) as quarter", "n")
        return made.groupBy("quarter").sum("n").toDF("quarter", "n")

    def years(source):
        return source.selectExpr("concat('y', left(quarter, 4)) as year", "n").groupBy("year").sum("n").toDF("year", "n")

    def load(name, column, made, parts):
        st.commit_partitions(spark, f"{base}/{name}", column, parts, lambda version: made.where(made[column].isin(parts)))

    names = [r["quarter"] for r in quarters(raw).collect()]
    load("quarters", "quarter", quarters(raw), names)
    load("years", "year", years(st.read_version(spark, f"{base}/quarters")), ["y2023", "y2024"])
    lineage = st.PartitionLineage(spark, f"{base}/lineage")
    of_quarters = raw.selectExpr("'raw' as source", "month as source_part", "'quarters' as target", "concat(left(month, 4), '-', ceil(right(month, 2) / 3)) as target_part")
    lineage.record("quarters", of_quarters)
    lineage.record("years", quarters(raw).selectExpr("'quarters' as source", "quarter as source_part", "'years' as target", "concat('y', left(quarter, 4)) as target_part"))

    found = steps(spark, lineage.links(), [("raw", "2024-02")])
    assert found == [("quarters", "2024-1", 1), ("years", "y2024", 2)]
    load("quarters", "quarter", quarters(late), ["2024-1"])
    load("years", "year", years(st.read_version(spark, f"{base}/quarters")), ["y2024"])
    assert st.same_rows(st.read_version(spark, f"{base}/quarters"), quarters(late))
    assert st.same_rows(st.read_version(spark, f"{base}/years"), years(quarters(late)))
