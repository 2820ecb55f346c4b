"""Portable hashes.

Seeded order, sampling and feature hashing all use the leading 60 bits of an MD5
digest: the same value on every executor, after any retry, and in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: width of the hash taken from the digest
HASH_BITS = 60

#: separates the parts of a compound text before hashing
PART_SEPARATOR = "\x1f"


def text_hash(col: Column) -> Column:
    """60-bit non-negative integer of a string column (null stays null)."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("bigint")


def parts_text(*parts: Column) -> Column:
    """Join parts so that different tuples never give the same text.

    Every part carries its length, and null is marked apart from empty text.
    """
    marked = []
    for part in parts:
        text = part.cast("string")
        marked.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws(PART_SEPARATOR, *marked)


def hash_bucket(col: Column, buckets: int) -> Column:
    """Stable bucket in ``[0, buckets)`` of a value's text form."""
    if buckets < 1:
        raise ValueError("a hash needs at least one bucket")
    return F.pmod(text_hash(col.cast("string")), F.lit(buckets).cast("bigint"))


def seeded_hash(seed: int, *parts: Column | str) -> Column:
    """60-bit hash of the seed and some columns, joined by ``|``."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return text_hash(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def uniform(seed: int, *parts: Column | str) -> Column:
    """Repeatable uniform double in ``[0, 1)`` from the seed and some columns."""
    return seeded_hash(seed, *parts).cast("double") / F.lit(float(1 << HASH_BITS))
