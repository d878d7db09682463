"""Similarities of two texts between 0 and 1, null where a side is null."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import pairwise
from .scores import r


def exact(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), None).otherwise((a == b).cast("double"))


def edit_share(a: Column, b: Column) -> Column:
    """1 less the edits by the longer text's length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    close = F.greatest(F.lit(0.0), F.lit(1.0) - F.levenshtein(a, b) / F.nullif(longest, F.lit(0)))
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.when(longest == 0, 1.0).otherwise(r(close, 8)))


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, left = [True] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == x:
                free[j] = False
                left.append(x)
                break
    n = len(left)
    if not n:
        return 0.0
    turned = sum(x != y for x, y in zip(left, (y for y, f in zip(b, free) if not f))) // 2
    jaro = (n / len(a) + n / len(b) + (n - turned) / n) / 3
    if jaro <= 0.7:
        return jaro
    head = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(len(a), len(b), 4))
    return jaro + head * 0.1 * (1 - jaro)


def jaro_winklers(t: pairwise.Texts, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of many pairs of numbered texts, of four digits."""
    return pairwise.jaro_winkler(t, a, b, _jaro_winkler)


def _pairwise(score):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(score(x, y), 8) for x, y in zip(a, b)], dtype="float64")

    return run


#: Arrow batches, as no built-in function has them.
jaro_winkler = _pairwise(_jaro_winkler)
sequence_ratio = _pairwise(lambda a, b: SequenceMatcher(None, a, b).ratio())
