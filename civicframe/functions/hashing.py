"""Randomness as a hash of (seed, id): the same on every partitioning and after every retry."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 48


def _digest(seed: str, ids: tuple) -> Column:
    parts = [F.lit(str(seed))]
    parts += [(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _hex_to_long(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def hash48(seed: str, *ids: str | Column) -> Column:
    """Uniform integer in [0, 2**48)."""
    return _hex_to_long(F.substring(_digest(seed, ids), 1, 12))


def hash48_second(seed: str, *ids: str | Column) -> Column:
    """A second integer from the same digest, for use with :func:`replicate_hash`."""
    return _hex_to_long(F.substring(_digest(seed, ids), 13, 12))


def replicate_hash(first: Column, second: Column, replicate: Column) -> Column:
    """Uniform per replicate and pairwise independent across replicates; no digest per replicate."""
    return (first + replicate * second) % F.lit(HASH_SPACE)


def to_unit(hashed: Column) -> Column:
    return hashed / F.lit(float(HASH_SPACE))


def hash_unit(seed: str, *ids: str | Column) -> Column:
    """Uniform double in [0, 1)."""
    return to_unit(hash48(seed, *ids))


def hash_normal(seed: str, *ids: str | Column) -> Column:
    """Standard normal through the Box-Muller transform of the two halves of one digest."""
    u1 = F.lit(1.0) - to_unit(hash48(seed, *ids))
    u2 = to_unit(hash48_second(seed, *ids))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def sql_hash48(seed: str, *ids: str) -> str:
    """The DuckDB text of :func:`hash48`."""
    text = f"'{seed}'" + "".join(f"||':'||CAST({i} AS VARCHAR)" for i in ids)
    return f"CAST('0x'||substr(md5({text}),1,12) AS BIGINT)"


def sql_hash48_second(seed: str, *ids: str) -> str:
    text = f"'{seed}'" + "".join(f"||':'||CAST({i} AS VARCHAR)" for i in ids)
    return f"CAST('0x'||substr(md5({text}),13,12) AS BIGINT)"
