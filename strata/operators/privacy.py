"""Sensitive values: remove, encrypt, replace by tokens, or redact inside text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from strata.functions.columns import named, quoted
from strata.functions.protection import (
    chosen_patterns,
    count_kind,
    has_digit,
    hmac_sha256,
    redact_kind,
    rewrap,
    seal,
    unseal,
)
from strata.plans.sizing import DEFAULT_BOUND, Bound, within
from strata.plans.skew import lookup_join
from strata.session import cut_lineage


def pii_remove(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop fields; a dotted name drops a field inside structs, or inside arrays of structs.

    A name that is not in the schema raises, at whatever depth: the data would stay in.
    Names that hold dots themselves are found too.
    """
    for name in fields:
        top, rest = _resolve(df.schema, name)
        if rest:
            df = df.withColumn(top, _without(named(top), df.schema[top].dataType, rest, name))
        else:
            df = df.drop(top)
    return df


def _resolve(schema: StructType, path: str) -> tuple[str, str]:
    """The field that ``path`` begins with, and what is left of it."""
    parts = path.split(".")
    for k in range(len(parts), 0, -1):
        name = ".".join(parts[:k])
        if name in schema.names:
            return name, ".".join(parts[k:])
    raise ValueError(f"no field {path!r} in {schema.simpleString()}")


def _without(column: Column, dtype: DataType, path: str, whole: str) -> Column:
    if isinstance(dtype, ArrayType):
        return F.transform(column, lambda item: _without(item, dtype.elementType, path, whole))
    if not isinstance(dtype, StructType):
        raise ValueError(f"{whole!r} leads into {dtype.simpleString()}, which has no fields")
    name, rest = _resolve(dtype, path)
    if rest:
        return column.withField(quoted(name), _without(column[name], dtype[name].dataType, rest, whole))
    if len(dtype.fields) == 1:
        raise ValueError(f"{whole!r} is the only field; remove what holds it")
    return column.dropFields(quoted(name))


_SEALED_TYPE = "sealed_type"


def pii_encrypt(
    df: DataFrame, columns: Sequence[str], master: bytes, key_id: str, data_key: bytes | None = None
) -> DataFrame:
    """Replace columns by their encrypted form, on the executors.

    The type of each is kept in the column's metadata, which Parquet files keep too.
    """
    sealed = {
        name: seal(named(name), master, key_id, data_key).alias(
            name, metadata={_SEALED_TYPE: df.schema[name].dataType.simpleString()}
        )
        for name in columns
    }
    return df.select(*[sealed.get(name, named(name)) for name in df.columns])


def pii_decrypt(
    df: DataFrame,
    columns: Sequence[str],
    masters: Mapping[str, bytes],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The reverse of :func:`pii_encrypt`; ``masters`` holds every key id still in use.

    Values get the type that the column's metadata names, or that of ``types``; else text.
    """
    opened = {}
    for name in columns:
        kind = (types or {}).get(name) or df.schema[name].metadata.get(_SEALED_TYPE, "string")
        opened[name] = unseal(named(name), masters).cast(kind).alias(name, metadata={})
    return df.select(*[opened.get(name, named(name)) for name in df.columns])


def pii_rewrap(
    df: DataFrame, columns: Sequence[str], masters: Mapping[str, bytes], master: bytes, key_id: str
) -> DataFrame:
    """Encrypted columns under another master key, without decrypting the values."""
    changed = {
        name: rewrap(named(name), masters, master, key_id).alias(name, metadata=df.schema[name].metadata)
        for name in columns
    }
    return df.select(*[changed.get(name, named(name)) for name in df.columns])


def pii_tokenize(df: DataFrame, columns: Sequence[str], key: bytes) -> DataFrame:
    """Replace values by tokens. Equal values have equal tokens in every table and run.

    A token is computed from value and key alone, so tokenizing needs neither a
    lookup nor a shuffle, and a run that is repeated gives the same tokens.
    """
    return df.withColumns({name: hmac_sha256(named(name), key) for name in columns})


def vault_additions(
    df: DataFrame,
    column: str,
    key: bytes,
    key_id: str,
    master: bytes,
    vault: DataFrame | None = None,
) -> DataFrame:
    """Rows ``(token, key_id, value)`` for values not yet in ``vault``; append them to it.

    The value is stored encrypted. Repeated values collapse on the map side before
    the lookup, so it has one row per value and no hot key.
    """
    values = df.select(named(column).cast("string").alias("value"))
    found = values.filter(F.col("value").isNotNull()).distinct()
    tokens = found.select(hmac_sha256(F.col("value"), key).alias("token"), "value")
    if vault is not None:
        known = vault.filter(F.col("key_id") == key_id)
        tokens = lookup_join(tokens, known, {"token": "token"}, "left_anti", split_hot=False)
    sealed = seal(F.col("value"), master, key_id).alias("value")
    return tokens.select("token", F.lit(key_id).alias("key_id"), sealed)


def pii_detokenize(
    df: DataFrame,
    column: str,
    vault: DataFrame,
    key_id: str,
    masters: Mapping[str, bytes],
    split_hot: bool | None = None,
) -> DataFrame:
    """Tokens turned back into values; a token that the vault lacks gives null.

    Values are decrypted once per token, before the lookup, so they pass through
    shuffles in the clear: set ``spark.io.encryption.enabled`` where that matters.
    """
    known = vault.filter(F.col("key_id") == key_id).select("token", "value")
    known = known.dropDuplicates(["token"])  # two runs may have added a token at once
    known = known.select("token", unseal(F.col("value"), masters).alias("__value"))
    columns = df.columns
    found = lookup_join(df, known, {column: "token"}, split_hot=split_hot)
    found = found.withColumn(column, F.col("__value"))
    return found.select(*[named(name) for name in columns])


def pii_redact(
    df: DataFrame,
    columns: Sequence[str],
    kinds: Sequence[str] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace sensitive spans inside whole texts by the name of their kind.

    ``patterns`` adds kinds of the caller's, as Java regular expressions.
    """
    flags = {name: f"__digit_{i}" for i, name in enumerate(columns)}
    df = df.withColumns({flag: has_digit(named(name)) for name, flag in flags.items()})
    for kind, pattern in chosen_patterns(kinds, patterns).items():
        df = df.withColumns(
            {name: redact_kind(named(name), kind, pattern, F.col(flag)) for name, flag in flags.items()}
        )
    return df.drop(*flags.values())


def pii_scan(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    kinds: Sequence[str] | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows ``(*by, kind, hits, rows_hit)``: what a redaction would find, all kinds in one pass."""
    chosen = chosen_patterns(kinds, patterns)
    text = named(column)
    counts = {f"c{i}": count_kind(text, *item) for i, item in enumerate(chosen.items())}
    groups = [named(name) for name in by]
    counted = df.select(*groups, *[cell.alias(name) for name, cell in counts.items()])
    totals = []
    for name in counts:
        totals.append(F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_hits"))
        totals.append(F.count_if(F.col(name) > 0).alias(f"{name}_rows"))
    pairs = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(f"c{i}_hits").alias("hits"),
            F.col(f"c{i}_rows").alias("rows_hit"),
        )
        for i, kind in enumerate(chosen)
    ]
    return counted.groupBy(*groups).agg(*totals).select(*groups, F.inline(F.array(*pairs)))


_WORD = r"[\p{L}\p{M}\p{N}]"


def _words(column: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(column, F.lit(f"{_WORD}+"), F.lit(0)))


def known_values(values: DataFrame, column: str) -> DataFrame:
    """Rows ``(word, found)``: for each word, the values that are looked for where a text holds it.

    A value is looked for by the one of its words that the fewest values have (ties to the
    smallest word), so that a first name or a company's form that many values share is no hot
    key. ``found`` holds the value's length with a minus sign, the value, and the pattern for
    it. Null and empty values count for nothing; a value without a letter or digit fails the
    job, as it would be left in the clear.
    """
    each = values.select(named(column).cast("string").alias("value")).where("value <> ''").distinct()
    worded = each.withColumn("words", _words(F.col("value")))
    checked = F.when(F.size("words") > 0, F.col("words")).otherwise(
        F.raise_error(F.lit("a known value has neither letter nor digit")).cast("array<string>")
    )
    pairs = worded.select("value", F.explode(checked).alias("word"))
    shared = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counted = lookup_join(pairs, shared.withColumnRenamed("word", "__word"), {"word": "__word"})
    rarest = counted.groupBy("value").agg(F.min(F.struct("n", "word")).alias("rarest"))
    value = F.col("value")
    pattern = F.concat(
        F.when(value.rlike(f"^{_WORD}"), F.lit(f"(?<!{_WORD})")).otherwise(""),
        F.regexp_replace(value, r"([^\p{L}\p{M}\p{N}])", r"\\$1"),
        F.when(value.rlike(rf"{_WORD}\z"), F.lit(f"(?!{_WORD})")).otherwise(""),
    )
    found = F.struct((-F.length(value)).alias("shorter"), value.alias("value"), pattern.alias("pattern"))
    return rarest.select(F.col("rarest.word").alias("word"), found.alias("found")).groupBy("word").agg(F.collect_list("found").alias("found"))


def pii_redact_known(
    df: DataFrame,
    column: str,
    values: DataFrame,
    value_column: str,
    kind: str = "KNOWN",
    bound: Bound = DEFAULT_BOUND,
) -> DataFrame:
    """Replace every occurrence of a known value (names, addresses, account numbers) in whole texts.

    A value occurs where its text stands as it is, with no letter, mark or digit right before
    its first or after its last one. Where occurrences overlap, the leftmost goes first, and the
    longest of those that begin together. ``values`` may have any size and repeated rows; rows
    of ``df`` stay as they are otherwise, repeated ones, null texts and other columns too.

    Each different word of a text is looked up among the words of :func:`known_values`, which
    are broadcast where they stay within ``bound`` and joined with split hot words elsewhere.
    Only words travel: the values to look for come back to their text by its hash, and a
    pattern made of them alone decides. Texts whose hashes meet share their patterns, which
    changes nothing. The values of one word, and those one text may hold, stand in one cell.
    """
    wanted = cut_lineage(known_values(values, value_column))
    small = within(wanted, bound)
    key, text = "__text_key", named(column)
    texts = df.select(F.xxhash64(text).alias(key), F.explode(_words(text)).alias("__text_word"))
    hits = lookup_join(
        texts, F.broadcast(wanted) if small else wanted, {"__text_word": "word"}, split_hot=False if small else None
    ).where(F.col("found").isNotNull())
    # Copies of a text send the same words: once is enough.
    gathered = hits.groupBy(key).agg(F.sort_array(F.flatten(F.collect_set("found"))).alias("found"))
    patterns = cut_lineage(gathered.select(key, F.array_join(F.col("found.pattern"), "|").alias("__pattern")))
    few = within(patterns, bound)
    joined = lookup_join(
        df.withColumn(key, F.xxhash64(text)),
        F.broadcast(patterns.withColumnRenamed(key, "__key")) if few else patterns.withColumnRenamed(key, "__key"),
        {key: "__key"},
        split_hot=False if few else None,
    )
    mark = F.lit("[" + kind.replace("\\", "\\\\").replace("$", "\\$") + "]")
    replaced = F.when(F.col("__pattern").isNull(), text).otherwise(F.regexp_replace(text, F.col("__pattern"), mark))
    return joined.withColumn(column, replaced).select(*[named(name) for name in df.columns])
