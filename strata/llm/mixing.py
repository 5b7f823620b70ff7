"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash. A source that may give only a part of its words
takes the documents whose hash stays below a threshold. The threshold is found from sums
of words by source and leading bits of the hash: the bucket in which the sum passes the
budget is cut into finer buckets, and only its documents are looked at again. What the
document at the threshold would have made too much is filled with smaller ones in the same
way. Documents are never sorted, and a source of any size is summed before the shuffle.

Defined results: a null text has size 0; null is a source of its own and the last one; rows
that repeat a doc_id with its text share a hash and go the same way; a source without words
has target 0; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
_BITS, _STEP = 60, 12
_ALL = (1 << _BITS) - 1  # a threshold that every document stays below
_MANY_SOURCES = 100_000


def _size(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _place():
    return F.xxhash64("doc_id", "text").bitwiseAND(F.lit(_ALL))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: the words each source should give.

    All targets together are ``share`` times all words, split by weight (sources in code point
    order, null last, weights repeating). No target is above ``most`` times its source; what
    exceeds that is shared again by weight. With the sources ordered by cap per weight, the
    common level is the one reached when all sources before it are full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nothing = F.lit(0.0)
    return (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), nothing))
        .withColumn("level", (F.col("budget") - F.col("full")) / F.sum("weight").over(onward))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
        .withColumn("target", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap")))
        .select("source", "source_size", "target")
    )


def _near(frame: DataFrame, few: DataFrame, known_few: bool) -> DataFrame:
    """``frame`` with the row of its source; the per-source side is broadcast if it was counted to be small."""
    few = few.withColumnRenamed("source", "of_source")
    few = F.broadcast(few) if known_few else few
    return frame.join(few, frame["source"].eqNullSafe(few["of_source"])).drop("of_source")


def _cut(sized: DataFrame, state: DataFrame, step: int, few: bool) -> DataFrame:
    """The state after looking ``step`` levels deep into the open boundary buckets.

    The bucket in which the sum of words passes what is missing becomes the new boundary. Once
    it holds one hash, the threshold is below that hash; ``over`` is what would be too much with it.
    """
    bits = _BITS - _STEP * step
    open_ = state.where("threshold is null").select("source", "prefix", "missing", "most", "floor")
    inside = _near(sized, open_, few).where("size <= most and place > floor")
    if step > 1:
        inside = inside.where(F.shiftright("place", bits + _STEP) == F.col("prefix"))
    buckets = inside.groupBy("source", F.shiftright("place", bits).alias("bucket")).agg(
        F.sum("size").alias("words"),
        F.min("place").alias("low"),
        F.max("place").alias("high"),
        F.first("missing").alias("missing"),
    )
    running = Window.partitionBy("source").orderBy("bucket")
    passed = (
        buckets.withColumn("before", F.sum("words").over(running) - F.col("words"))
        .where(F.col("before") + F.col("words") > F.col("missing"))
        .groupBy("source")
        .agg(F.min_by(F.struct("bucket", "before", "words", "low", "high"), "bucket").alias("at"))
        .withColumnRenamed("source", "at_source")
    )
    joined = state.join(passed, state["source"].eqNullSafe(passed["at_source"]), "left")
    left = F.col("missing") - F.col("at.before")
    ends = (F.col("at.low") == F.col("at.high")) | F.lit(bits == 0)
    here = F.col("threshold").isNull()
    return joined.select(
        "source",
        "source_size",
        "target",
        "copies",
        "steps",
        "most",
        "floor",
        "best",
        F.when(here & ends, F.col("at.words") - left).otherwise(F.col("over")).alias("over"),
        F.when(here & ends, F.col("at.high")).otherwise(F.col("high")).alias("high"),
        F.when(here & F.col("at").isNotNull(), left).otherwise(F.col("missing")).alias("missing"),
        F.when(here, F.col("at.bucket")).otherwise(F.col("prefix")).alias("prefix"),
        F.when(~here, F.col("threshold")).when(F.col("at").isNull(), F.lit(_ALL)).when(ends, F.col("at.low") - 1).alias("threshold"),
    )


def _thresholds(sized: DataFrame, passes: int = 4, **how) -> tuple[DataFrame, bool]:
    """One row per source: how often each document goes in, and the steps that say which go in once more.

    A step (most, threshold) takes the documents of at most ``most`` words up to a hash. The
    first one is for all documents and stops before the document that would take too many words;
    the next ones fill what is then missing with smaller documents from behind. If one of these
    documents too many comes nearer to the target than all steps, it is taken instead.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    nothing = F.array().cast("array<struct<most: bigint, threshold: bigint>>")
    state = cut_lineage(
        source_targets(sizes, **how)
        .withColumn("copies", F.floor(ratio).cast("long"))
        .withColumn("missing", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("steps", nothing)
        .withColumn("most", F.lit(_ALL))
        .withColumn("floor", F.lit(-1).cast("long"))
        .withColumn("best", F.struct(F.lit(float("inf")).alias("over"), nothing.alias("steps")))
    )
    few = state.count() <= _MANY_SOURCES
    for _ in range(passes):
        # A threshold above all hashes has taken every document there was.
        done = (F.col("missing") < 1) | (F.col("floor") == _ALL)
        unknown = F.lit(None).cast("long")
        state = state.withColumn("threshold", F.when(done, F.col("floor")))
        state = state.withColumns({"prefix": unknown, "high": unknown, "over": F.lit(None).cast("double")})
        if state.where("threshold is null").isEmpty():
            break
        for step in range(1, _BITS // _STEP + 1):
            if state.where("threshold is null").isEmpty():
                break
            state = cut_lineage(_cut(sized, state, step, few))
        with_it = F.concat("steps", F.array(F.struct("most", F.col("high").alias("threshold"))))
        other = F.struct("over", with_it.alias("steps"))
        state = state.withColumn("best", F.when(F.col("over") < F.col("best.over"), other).otherwise(F.col("best")))
        taken = F.concat("steps", F.array(F.struct("most", "threshold")))
        state = state.withColumn("steps", F.when(F.col("threshold") > F.col("floor"), taken).otherwise(F.col("steps")))
        state = state.withColumn("floor", F.greatest("floor", "threshold")).withColumn("most", F.floor("missing").cast("long"))
    steps = F.when(F.col("best.over") < F.col("missing"), F.col("best.steps")).otherwise(F.col("steps"))
    return state.select("source", "source_size", "target", "copies", steps.alias("steps")), few


def _times():
    once = F.exists("steps", lambda s: (F.col("size") <= s["most"]) & (F.col("place") <= s["threshold"]))
    return F.col("copies") + F.when(once, 1).otherwise(0)


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document; ``how`` as in source_targets."""
    sized = cut_lineage(docs.select("doc_id", "source", _size().alias("size"), _place().alias("place")))
    state, few = _thresholds(sized, **how)
    taken = (F.col("size") * _times()).alias("taken")
    return _near(sized, state, few).select("doc_id", "size", "source_size", "target", taken)


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sized = cut_lineage(docs.select("source", _size().alias("size"), _place().alias("place")))
    state, few = _thresholds(sized, **how)
    rows = docs.select("source", _size().alias("size"), _place().alias("place"), F.struct(*_columns(docs)).alias("row"))
    picked = _near(rows, state, few).withColumn("times", _times()).where("times > 0")
    return picked.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def _columns(docs: DataFrame):
    return [docs[f"`{name.replace('`', '``')}`"] for name in docs.columns]
