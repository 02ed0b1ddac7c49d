"""chrF: F-score over character n-grams, from sums of statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.functions.math import f_beta
from glossmill.functions.ngrams import char_codes, overlaps
from glossmill.functions.text import delete_spaces

ORDER, BETA = 6, 2.0
COUNTS = [f"{kind}{n}" for n in range(1, ORDER + 1) for kind in ("hyp", "ref", "common")]


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def statistics(hyp: pa.Array, ref: pa.Array) -> pa.Array:
    h, r = ([t or "" for t in x.to_pylist()] for x in (hyp, ref))
    codes, sizes = char_codes(h + r)
    common, of_hyp, of_ref = overlaps(codes, sizes, len(h), np.arange(len(h)), ORDER)
    columns = [x[:, n] for n in range(ORDER) for x in (of_hyp, of_ref, common)]
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], COUNTS)


def score() -> Column:
    """From summed counts: mean precision and recall over the orders that both sides have, 0 to 1."""
    both = [(F.col(f"hyp{n}") > 0) & (F.col(f"ref{n}") > 0) for n in range(1, ORDER + 1)]
    used = sum((b.cast("int") for b in both[1:]), both[0].cast("int"))
    mean = lambda kind: F.coalesce(F.try_divide(sum((F.when(b, F.col(f"common{n}") / F.col(f"{kind}{n}")).otherwise(0.0) for n, b in enumerate(both, 1)), F.lit(0.0)), used), F.lit(0.0))
    return f_beta(mean("hyp"), mean("ref"), BETA)


def with_statistics(pairs: DataFrame, hyp: str, ref: str) -> DataFrame:
    """``pairs`` with the statistics of each; pairs with a null side are left out. White space does not count."""
    kept = pairs.where(F.col(hyp).isNotNull() & F.col(ref).isNotNull())
    return kept.withColumn("_s", statistics(delete_spaces(F.col(hyp)), delete_spaces(F.col(ref)))).select(*[c for c in pairs.columns if c not in COUNTS], "_s.*")


def chrf(pairs: DataFrame, hyp: str, ref: str, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """One row per group. White space does not count; pairs with a null side are left out."""
    sums = with_statistics(pairs, hyp, ref).groupBy(*(by or [])).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    return sums.select(*(by or []), F.round(score(), digits).alias("chrf"))
