"""Similarity of names and numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro_winkler(a: str, b: str, weight: float = 0.1, prefix: int = 4) -> float:
    """Jaro similarity, raised for a common prefix when it is above 0.7."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(max(la, lb) // 2 - 1, 0)
    used = [False] * lb
    left = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [ch for ch, hit in zip(b, used) if hit]
    moved = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / la + m / lb + (m - moved) / m) / 3
    same = 0
    for x, y in zip(a[:prefix], b[:prefix]):
        if x != y:
            break
        same += 1
    return jaro + same * weight * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(T.DoubleType())
def jaro_winkler_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Similarity of two columns; null with a null. A task scores each pair of values once while it remembers it."""
    known: dict[tuple, float | None] = {}
    for a, b in batches:
        if len(known) > 500_000:
            known.clear()
        out = []
        for pair in zip(a, b):
            if pair not in known:
                known[pair] = None if pair[0] is None or pair[1] is None else jaro_winkler(*pair)
            out.append(known[pair])
        yield pd.Series(out, dtype="float64")


def with_jaro_winkler(pairs: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """Add the similarity of two text columns, where the rows are: no join, so no value can be a hot key."""
    return pairs.withColumn(out, jaro_winkler_udf(left, right))


def gaussian_similarity(a: Column, b: Column, offset: float = 0.0, scale: float = 1.0) -> Column:
    """1 within the offset, one half at one scale beyond it."""
    beyond = F.greatest(F.abs(a - b) - offset, F.lit(0.0)) / scale
    return F.pow(F.lit(2.0), -beyond * beyond)


def exact(a: Column, b: Column) -> Column:
    return F.coalesce((a == b).cast("int"), F.lit(0))
