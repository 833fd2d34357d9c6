"""Deterministic pseudo-random numbers taken from row keys.

`rand(seed)` depends on how rows are laid out over partitions. A key hash does
not, survives a lost executor, and can be repeated in plain SQL:

    md5(key || ':' || salt), first eight hex digits, read as a number in [0, 2^32)
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

HASH_SPACE = 2**32

Keys = str | Sequence[str]


def key_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def key_digits(keys: Keys, salt: str) -> Column:
    """Hash of the key columns as eight hex digits, which sort like the number they spell."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in key_list(keys)]
    return F.substring(F.md5(F.concat_ws(":", *parts, F.lit(salt))), 1, 8)


def order_digits(df: DataFrame, keys: Keys, salt: str) -> Column:
    """Sixty-four hex digits per row: of its key, then of its whole content.

    The first eight are those of `key_digits`. Rows with the same digits are equal.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in key_list(keys)]
    content = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    halves = [F.xxhash64(F.lit(n), *content) for n in (1, 2)]
    digits = [F.lpad(F.lower(F.hex(h)), 16, "0") for h in halves]
    return F.concat(F.md5(F.concat_ws(":", *parts, F.lit(salt))), *digits)


def key_hash(keys: Keys, salt: str) -> Column:
    """Hash of the key columns, a bigint in [0, 2^32)."""
    return F.conv(key_digits(keys, salt), 16, 10).cast("bigint")


def fold_of(keys: Keys, folds: int, salt: str = "fold") -> Column:
    """Fold number 0..folds-1."""
    return F.pmod(key_hash(keys, salt), F.lit(folds)).cast("int")


def in_fraction(keys: Keys, fraction: float, salt: str) -> Column:
    """True for about `fraction` of the keys: hash < fraction * 2^32."""
    bound = math.ceil(float(fraction) * HASH_SPACE)
    if bound >= HASH_SPACE:
        return F.lit(True)
    return key_digits(keys, salt) < F.lit(f"{max(bound, 0):08x}")


def uniform(keys: Keys, salt: str) -> Column:
    """A number in [0, 1) per key."""
    return key_hash(keys, salt).cast("double") / F.lit(float(HASH_SPACE))
