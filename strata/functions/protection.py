"""Encryption, tokens and redaction as column expressions.

Keys are arguments. Spark prints literals in query plans, so whoever can read
the plan of a job can read its keys: restrict access to event logs, and set
``spark.sql.redaction.string.regex`` where plans are logged.
"""

from __future__ import annotations

import secrets
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# A word boundary beside a digit. Java's own \b takes accented letters for word characters
# in some versions and not in others, and would miss a number right after one.
NO_WORD_BEFORE = "(?<![0-9A-Za-z_])"
NO_WORD_AFTER = "(?![0-9A-Za-z_])"


def _apart(pattern: str) -> str:
    return NO_WORD_BEFORE + pattern + NO_WORD_AFTER


# Pattern per kind of sensitive value, applied in this order. A match begins
# where a run of its characters begins, and a run is not given back, so that a long run of
# word characters cannot turn quadratic.
PII_PATTERNS = {
    "EMAIL": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@(?:[\p{L}\p{M}\p{N}-]++\.)+\p{L}(?:[\p{L}\p{M}\p{N}]|-++(?=[\p{L}\p{M}\p{N}]))++",
    "SECRET": r'token = "[0-9a-f]{40}"',
    "CREDIT_CARD": _apart("(?:3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|(?:[0-9]{4}[ -]?){3}[0-9]{4}(?:[ -]?[0-9]{3})?)"),
    "IP_ADDRESS": _apart(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    "SSN": _apart("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}

# What any match of a pattern contains. Most texts hold no cue and are
# spared the full pattern. A replacement never adds a cue, so cues may be looked up in
# the text as it was at first.
_LITERAL_CUES = {"EMAIL": "@", "SECRET": "token = "}
_DIGIT_CUES = {"CREDIT_CARD": "[0-9]{4}", "IP_ADDRESS": r"[0-9]\.[0-9]", "SSN": "[0-9]-[0-9]"}

_HMAC_BLOCK = 64
_DERIVED_KEYS = 65_536
_MASTER_KEY_SIZES = (16, 24, 32)


def _binary(value: bytes) -> Column:
    return F.lit(bytearray(value)).cast(BinaryType())


def hmac_sha256(column: Column, key: bytes) -> Column:
    """Keyed SHA-256 of the UTF-8 text in ``column`` as 64 hex digits; null stays null."""
    if len(key) > _HMAC_BLOCK:
        raise ValueError("use a key of at most 64 bytes")
    padded = key.ljust(_HMAC_BLOCK, b"\0")
    inner = _binary(bytes(b ^ 0x36 for b in padded))
    outer = _binary(bytes(b ^ 0x5C for b in padded))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(column.cast("string"), "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def _check_master(keys: Mapping[str, bytes]) -> None:
    for name, key in keys.items():
        if len(key) not in _MASTER_KEY_SIZES:
            raise ValueError(f"master key {name!r} must have 16, 24 or 32 bytes")


def seal(column: Column, master: bytes, key_id: str, data_key: bytes | None = None) -> Column:
    """Envelope encryption: ``struct<key_id, wrapped_key, payload>``; null stays null.

    One data key serves the whole job and travels with each value, wrapped by the
    master key, so no value needs a key service and a master key can be rotated by
    re-wrapping alone, see :func:`rewrap`. Values are spread over 65,536 keys derived from
    it, by value and task: one key must not encrypt more than 2^32 messages.
    """
    _check_master({key_id: master})
    data_key = data_key or secrets.token_bytes(32)
    text = column.cast("string")
    bucket = F.pmod(F.xxhash64(text, F.spark_partition_id()), F.lit(_DERIVED_KEYS)).cast("int")
    payload = F.aes_encrypt(F.encode(text, "UTF-8"), _derived(_binary(data_key), bucket), F.lit("GCM"))
    wrapped = F.aes_encrypt(_binary(data_key), _binary(master), F.lit("GCM"))
    sealed = F.struct(
        F.lit(key_id).alias("key_id"),
        wrapped.alias("wrapped_key"),
        bucket.alias("bucket"),
        payload.alias("payload"),
    )
    return F.when(column.isNotNull(), sealed)


def _derived(data_key: Column, bucket: Column) -> Column:
    return F.unhex(F.sha2(F.concat(data_key, F.encode(bucket.cast("string"), "UTF-8")), 256))


def _data_key(column: Column, masters: Mapping[str, bytes]) -> Column:
    """The data key of a sealed value; null if no master key has its ``key_id``."""
    _check_master(masters)
    master = F.lit(None).cast(BinaryType())
    for name, key in masters.items():
        master = F.when(column["key_id"] == name, _binary(key)).otherwise(master)
    return F.aes_decrypt(column["wrapped_key"], master, F.lit("GCM"))


def unseal(column: Column, masters: Mapping[str, bytes]) -> Column:
    """The text behind :func:`seal`; an unknown ``key_id`` gives null."""
    key = _derived(_data_key(column, masters), column["bucket"])
    return F.decode(F.aes_decrypt(column["payload"], key, F.lit("GCM")), "UTF-8")


def rewrap(column: Column, masters: Mapping[str, bytes], master: bytes, key_id: str) -> Column:
    """A sealed value with its data key wrapped by another master key; the payload stays.

    A value whose master key is not among ``masters`` fails the job: it would be lost when
    that key goes.
    """
    _check_master({key_id: master})
    data_key = _data_key(column, masters)
    unknown = F.raise_error(F.concat(F.lit("no master key "), column["key_id"])).cast(BinaryType())
    wrapped = F.aes_encrypt(F.coalesce(data_key, unknown), _binary(master), F.lit("GCM"))
    changed = column.withField("key_id", F.lit(key_id)).withField("wrapped_key", wrapped)
    return F.when(column.isNotNull(), changed)


def chosen_patterns(
    kinds: Sequence[str] | None, patterns: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Pattern by kind: the known ones and the caller's, or those of ``kinds`` among them."""
    known = {**PII_PATTERNS, **(patterns or {})}
    chosen = list(known) if kinds is None else list(kinds)
    unknown = [kind for kind in chosen if kind not in known]
    if unknown:
        raise ValueError(f"no pattern for {unknown}; known: {list(known)}")
    return {kind: known[kind] for kind in chosen}


def has_digit(column: Column) -> Column:
    return column.rlike("[0-9]")


def _has_cue(column: Column, kind: str, pattern: str, digit: Column) -> Column:
    if PII_PATTERNS.get(kind) != pattern:  # the caller's own
        return F.lit(True)
    if kind in _LITERAL_CUES:
        return F.contains(column, F.lit(_LITERAL_CUES[kind]))
    return digit & column.rlike(_DIGIT_CUES[kind])


def redact_kind(column: Column, kind: str, pattern: str, digit: Column | None = None) -> Column:
    """Every span of one kind replaced by the kind's name in square brackets.

    ``digit`` tells whether the text holds a digit, if that is known already.
    """
    digit = has_digit(column) if digit is None else digit
    name = kind.replace("\\", "\\\\").replace("$", "\\$")
    replaced = F.regexp_replace(column, pattern, f"[{name}]")
    return F.when(_has_cue(column, kind, pattern, digit), replaced).otherwise(column)


def redact(
    column: Column, kinds: Sequence[str] | None = None, patterns: Mapping[str, str] | None = None
) -> Column:
    """Every sensitive span replaced by the name of its kind, in square brackets.

    For whole frames :func:`strata.operators.privacy.pii_redact` gives a smaller plan.
    """
    for kind, pattern in chosen_patterns(kinds, patterns).items():
        column = redact_kind(column, kind, pattern)
    return column


def count_kind(column: Column, kind: str, pattern: str) -> Column:
    """Number of spans of one kind in the whole text."""
    found = F.regexp_count(column, F.lit(pattern)).cast("long")
    cue = _has_cue(column, kind, pattern, has_digit(column))
    return F.when(cue, found).otherwise(F.lit(0).cast("long"))
