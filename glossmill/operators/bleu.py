"""BLEU from sums of sufficient statistics.

The statistics of a pair come from the pair alone, so they are computed in the
row and no n-gram is shuffled; a corpus's, or a group's, are their sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.functions.ngrams import overlaps, word_codes

ORDER = 4
COUNTS = [f"correct{n}" for n in range(1, ORDER + 1)] + [f"total{n}" for n in range(1, ORDER + 1)] + ["sys_len", "ref_len"]
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


@F.arrow_udf(STATISTICS)
def statistics(hyp: pa.Array, refs: pa.Array) -> pa.Array:
    """Clipped matches and totals per order and the lengths, of word lists and their lists of reference word lists.

    The reference length is that of the closest reference, the shorter of two
    as close. Rows whose hypothesis or references are null must be left out
    before.
    """
    rows = len(hyp)
    inner = refs.flatten()
    row = np.repeat(np.arange(rows), refs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    h_len = hyp.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    r_len = inner.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = word_codes(hyp.flatten(), inner.flatten())
    common, total, _ = overlaps(codes, np.r_[h_len, r_len], rows, row, ORDER)
    closest = np.zeros(rows, np.int64)
    if len(row):
        by = np.lexsort((r_len, np.abs(h_len[row] - r_len), row))
        first = np.flatnonzero(np.diff(row[by], prepend=-1))
        closest[row[by][first]] = r_len[by][first]
    columns = [*common.T, *total.T, h_len, closest]
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], COUNTS)


def scores(smooth: str = "floor", value: float = 0.0) -> dict[str, Column]:
    """``bleu1..bleu4`` and ``bp`` from columns of summed statistics.

    ``smooth`` is none, floor, add-k (orders 3 and 4) or exp (halved for each
    order without a match). From the first order without n-grams on, precisions
    are 0; a score is 0 if one of its precisions is.
    """
    add = lambda n: value if smooth == "add-k" and n > 2 else 0.0
    c = [F.col(f"correct{n}") + F.lit(add(n)) for n in range(1, ORDER + 1)]
    t = [F.col(f"total{n}") + F.lit(add(n)) for n in range(1, ORDER + 1)]
    precisions, zeros, alive = [], F.lit(0), F.lit(True)
    for correct, total in zip(c, t):
        alive = alive & (total > 0)
        zeros = zeros + (correct == 0).cast("int")
        missed = {"exp": 100.0 / (F.pow(F.lit(2.0), zeros) * total), "floor": 100.0 * value / total}.get(smooth, F.lit(0.0))
        precisions.append(F.when(alive, F.when(correct == 0, missed).otherwise(100.0 * correct / total)).otherwise(0.0))
    bp = F.when(F.col("sys_len") >= F.col("ref_len"), 1.0).when(F.col("sys_len") == 0, 0.0).otherwise(F.exp(1 - F.col("ref_len") / F.nullif("sys_len", F.lit(0))))
    out = {}
    for n in range(1, ORDER + 1):
        p = precisions[:n]
        lowest = F.least(*p) if n > 1 else p[0]
        total_log = sum((F.ln(F.when(x > 0, x)) for x in p[1:]), F.ln(F.when(p[0] > 0, p[0])))
        out[f"bleu{n}"] = F.when(lowest == 0, 0.0).otherwise(bp * F.exp(total_log / n))
    return out | {"bp": bp}


def with_statistics(pairs: DataFrame, hyp: str = "hyp", refs: str = "refs") -> DataFrame:
    """``pairs`` with the statistics of each; pairs with a null side are left out, empty sides kept."""
    kept = pairs.where(F.col(hyp).isNotNull() & F.col(refs).isNotNull())
    return kept.withColumn("_s", statistics(F.col(hyp), F.col(refs))).select(*[c for c in pairs.columns if c not in COUNTS], "_s.*")


def bleu(pairs: DataFrame, by: list[str] | None = None, smooth: str = "floor", value: float = 0.0, digits: int = 6, prefix: str = "") -> DataFrame:
    """One row per group: the scores, the brevity penalty and the two lengths.

    ``pairs (hyp array<string>, refs array<array<string>>)``; without pairs and
    groups, one row of zero scores.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]
    got = with_statistics(pairs).groupBy(*(by or [])).agg(*sums)
    return got.select(*(by or []), *[F.round(c, digits).alias(f"{prefix}{name}") for name, c in scores(smooth, value).items()], "sys_len", "ref_len")
