import inspect

import __spark_entry__ as entry
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES


def test_all_operators_and_the_pipeline_are_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLE) <= set(QUERIES)


def test_stages_work_on_what_the_ones_before_kept(spark, make_docs, tmp_path):
    text = "the house of the old man and the sea is not far from here they say every day"
    rows = [(0, None, "en", "a"), (1, "1 2 3", "en", "a"), (2, text, "en", "a"), (3, text.upper(), "en", "b")]
    rows += [(10 + i, " ".join(f"w{(i * 31 + k) % 977}q" for k in range(40)), "de", "ab"[i % 2]) for i in range(60)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        after = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r["doc_id"] for r in docs.collect()})
    assert {0, 1}.isdisjoint(kept[0]) and {2, 3} <= kept[0]
    assert kept[1] == kept[0] - {3}
    assert kept[2] <= kept[1] and kept[3] == kept[2]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_repeated_rows_and_clashing_names(spark, odd_docs, tmp_path):
    wide = odd_docs.unionByName(odd_docs).withColumn("node", F.lit("clash")).withColumn("size", F.lit(1)).withColumn("ids", F.lit(None).cast("int"))
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Without a letter, or without text, a document goes; of repeated rows one stays.
    assert {r["doc_id"] for r in whole} <= {None, 4, 5, 6, 7}
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in whole)
