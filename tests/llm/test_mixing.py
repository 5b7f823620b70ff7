import pytest
from pyspark.sql import functions as F

from strata.llm.mixing import mix_documents, mix_report, source_targets


def level(sizes, weights, share, most):
    """Share out again and again what exceeds the caps."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        each = (budget - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * each > most * sizes[s] + 1e-9}
        if not full:
            return target | {s: weight[s] * each for s in free}
        target |= {s: most * sizes[s] for s in full}
        free -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 900, None: 40}, {"a": 10}, {"b": 0, "a": 7}, {"Z": 1, "a": 1000, "é": 3}])
def test_targets_match_sharing_by_hand(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(table).collect()}
    assert got == pytest.approx(level(sizes, (3, 1, 2), 1.5, 2.0))


def test_taken_words_come_near_the_targets(make_docs):
    rows = [(i, "w " * (1 + i * 7 % 40), "en", "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    report = mix_report(make_docs(rows))
    again = mix_report(make_docs(rows, partitions=5))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, again.collect()))
    for row in report.join(make_docs(rows).select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")
    ).collect():
        assert abs(row["taken"] - row["target"]) <= 20  # half the largest document
        assert row["most"] <= 2


def test_documents_are_repeated_as_reported(make_docs):
    rows = [(i, "w " * (i % 9), "en", f"s{i % 3}") for i in range(200)]
    docs = make_docs(rows).withColumn("size", F.lit("clash")).withColumn("threshold", F.lit(1))
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for row in mix_report(docs).collect():
        if row["size"]:
            assert row["taken"] == row["size"] * times.get(row["doc_id"], 0)


def test_odd_rows(odd_docs, no_docs):
    report = mix_report(odd_docs).collect()
    assert len(report) == 10
    assert all(r["taken"] <= 2 * r["size"] for r in report)
    assert {r["size"] for r in report if r["doc_id"] in (1, 2, 3)} == {0}
    assert mix_report(no_docs).collect() == [] and mix_documents(no_docs).collect() == []
