import pytest
from pyspark.sql import functions as F

from strata import read_good, read_rejected, working_folder, write_or_reject

SCHEMA = "id int not null, price decimal(6,2), tags array<int>, at date"
ROWS = [
    ("1", "12.50", ["1", "2"], "2024-01-31", "extra"),
    ("x", "12.505", ["1"], "2024-01-31", "extra"),
    (None, "1.00", None, None, None),
    ("4", None, ["1", "y"], "2024-02-31", "extra"),
    ("5", "99999.99", [], "2024-02-28", "extra"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, "id string, price string, tags array<string>, at string, more string")


def test_good_plus_rejected_is_the_input(spark, raw, rows):
    path = working_folder(spark, "judged")
    done = write_or_reject(raw, SCHEMA, path, required=["id"])
    assert [r["id"] for r in done.good.collect()] == [1]
    assert done.good.dtypes == [("id", "int"), ("price", "decimal(6,2)"), ("tags", "array<int>"), ("at", "date")]
    found = {r["raw"]["id"]: r["reasons"] for r in done.rejected.collect()}
    assert found[None] == ["id: is null"]
    assert found["x"][0] == "id: does not fit" and found["5"] == ["price: does not fit"]
    assert found["4"] == ["tags: does not fit", "at: does not fit"]
    assert done.good.count() + done.rejected.count() == raw.count()
    assert sorted(map(str, done.rejected.select("raw.*").collect() + raw.where("id = '1'").collect())) == sorted(map(str, raw.collect()))
    assert done.counts["rows"] == 5 and done.counts["rejected"] == 4 and done.counts["at: does not fit"] == 1


def test_one_scan_and_no_shuffle(spark, raw, tmp_path, plan):
    from strata.plans.quarantine import judge

    raw.write.parquet(str(tmp_path / "raw"))
    text = plan(judge(spark.read.parquet(str(tmp_path / "raw")), SCHEMA, ["id"]))
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Python" not in text


def test_a_repeated_run_changes_nothing(spark, raw):
    path = working_folder(spark, "judged")
    first = write_or_reject(raw, SCHEMA, path, ["id"], version=3)
    again = write_or_reject(raw.limit(0), SCHEMA, path, ["id"], version=3)
    assert first.counts == again.counts and again.version == 3
    assert read_good(spark, path).count() == 1 and read_rejected(spark, path).count() == 4
    # Only one of the two partitions is read.
    assert set(read_good(spark, path).select(F.input_file_name().alias("f")).distinct().toPandas()["f"].str.contains("rejected=false")) == {True}


def test_empty_input_and_wrong_names(spark, raw):
    path = working_folder(spark, "judged")
    done = write_or_reject(raw.limit(0), SCHEMA, path)
    assert done.good.isEmpty() and done.rejected.isEmpty() and done.counts == {"rows": 0, "rejected": 0}
    with pytest.raises(ValueError):
        write_or_reject(raw.drop("at"), SCHEMA, path)
    with pytest.raises(ValueError):
        write_or_reject(raw, SCHEMA, path, required=["more"])
