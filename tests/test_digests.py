import pytest
from pyspark.sql import functions as F

from strata import dataset_diff, dataset_diff_digest, publish_digested, working_folder
from strata.sources import digests as module
from strata.sources.digests import differing_leaves, digests
from strata.sources.snapshots import purge_versions, version_path
from strata.sources.storage import Storage


def scanned(plan):
    """Rows that the scans of an executed plan gave."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return scanned(plan.executedPlan())
    if "QueryStage" in name:
        return scanned(plan.plan())
    if name.startswith("Scan"):
        return plan.metrics().apply("numOutputRows").value()
    children = plan.children()
    return sum(scanned(children.apply(i)) for i in range(children.size()))


def test_ten_of_a_million(spark, rows):
    before = spark.range(1_000_000, numPartitions=8).select("id", (F.col("id") % 97).alias("x"), F.lit("a").alias("y"))
    changed = F.col("id") % 100_000 == 7
    after = before.withColumn("x", F.when(changed, -1).otherwise(F.col("x")))
    path = working_folder(spark, "digested")
    for version in (before, after):
        publish_digested(version, path, ["id"])
    found, _ = differing_leaves(spark, path, 0, 1)
    assert found.count() <= 10
    diff = dataset_diff_digest(spark, path, ["id"])
    assert rows(diff) == rows(dataset_diff(before, after, ["id"]))
    read = scanned(diff._jdf.queryExecution().executedPlan())
    # Pages have 4,096 rows at most; a leaf lies in two or three of them.
    assert read <= 2 * 10 * 3 * 4_096 < 1_000_000 / 4


ODD = [(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "", float("nan")), (None, "n", 0.0)]


@pytest.mark.parametrize("most", [1_000, 0])
def test_equals_the_whole_comparison(spark, rows, monkeypatch, most):
    monkeypatch.setattr(module, "_MOST_RANGES", most)
    schema = "id long, s string, d double"
    editions = [
        spark.createDataFrame(ODD, schema),
        spark.createDataFrame([(1, "a", 1.0), (2, "", 2.0), (3, None, None), (5, "new", 5.0), (None, "m", -0.0)], schema),
        spark.createDataFrame([], schema),
        spark.createDataFrame([(i, str(i), float(i)) for i in range(3_000)], schema),
        spark.createDataFrame([(i, str(i), float(i)) for i in range(2, 3_000)], schema).withColumn("s", F.when(F.col("id") != 77, F.col("s"))),
    ]
    path = working_folder(spark, "digested")
    for edition in editions:
        publish_digested(edition, path, ["id"], rows_per_leaf=16)
    for a in range(len(editions)):
        for b in range(len(editions)):
            got = dataset_diff_digest(spark, path, ["id"], a, b)
            assert sorted(map(str, got.collect())) == sorted(map(str, dataset_diff(editions[a], editions[b], ["id"]).collect()))


def test_rows_that_swap_values_differ(spark):
    path = working_folder(spark, "digested")
    for values in ([(1, None, "x"), (2, "x", None)], [(1, "x", None), (2, None, "x")]):
        publish_digested(spark.createDataFrame(values, "id long, a string, b string"), path, ["id"])
    assert dataset_diff_digest(spark, path, ["id"]).count() == 2


def test_digests_are_made_again_and_go_with_their_version(spark):
    path = working_folder(spark, "digested")
    df = spark.range(100).withColumn("v", F.lit(1))
    for _ in range(2):
        publish_digested(df, path, ["id"])
    wanted = sorted(map(tuple, digests(spark, path, 1).collect()))
    Storage(spark, version_path(path, 1)).remove("_digests")
    assert sorted(map(tuple, digests(spark, path, 1).collect())) == wanted
    assert dataset_diff_digest(spark, path, ["id"]).isEmpty()
    assert purge_versions(spark, path) == [0]
    assert not Storage(spark, version_path(path, 0)).exists()
    with pytest.raises(FileNotFoundError):
        dataset_diff_digest(spark, path, ["id"])
