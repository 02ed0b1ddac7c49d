"""ROUGE-L over parts between single blanks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.functions.text import split_blanks

BETA = 1.2


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence by one bit vector over ``a``, a step per element of ``b``."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for y in b:
        met = free & at.get(y, 0)
        free = (free + met | free - met) & full
    return len(a) - free.bit_count()


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def lcs_lengths(hyp: pa.Array, refs: pa.Array) -> pa.Array:
    return pa.array([None if h is None or r is None else [lcs_length(x, h) for x in r] for h, r in zip(hyp.to_pylist(), refs.to_pylist())], pa.list_(pa.int32()))


def rouge_l(hyp: Column, refs: Column, beta: float = BETA) -> Column:
    """0 to 1, of a text and an array of references: the greatest precision and the greatest recall, each over all references.

    An empty text is one empty part. Null if either is null.
    """
    h, r = split_blanks(hyp), F.transform(refs, split_blanks)
    lcs = lcs_lengths(h, r)
    precision = F.array_max(F.transform(lcs, lambda x: x / F.size(h)))
    recall = F.array_max(F.zip_with(lcs, r, lambda x, y: x / F.size(y)))
    b = beta * beta
    return F.when((precision == 0) | (recall == 0), 0.0).otherwise((1 + b) * precision * recall / (recall + b * precision))


def mean_rouge_l(pairs: DataFrame, hyp: str, refs: str, by: list[str] | None = None) -> DataFrame:
    """The mean times 100; null without pairs."""
    scored = pairs.select(*(by or []), rouge_l(F.col(hyp), F.col(refs)).alias("r"))
    return scored.groupBy(*(by or [])).agg(F.round(F.avg("r") * 100, 6).alias("rouge_l"))
