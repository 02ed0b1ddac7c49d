"""Set and bag operations and carried-forward selections."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from glossmill.functions.ngrams import overlaps, word_codes
from glossmill.operators.sequence import _ordered, global_index


def bag_union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def bag_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, each as often as in the part that has it less often.

    Counts are combined before the shuffle and joined, instead of the rows.
    """
    cols = a.columns
    na, nb = a.groupBy(*cols).agg(F.count("*").alias("na")), b.select(*cols).groupBy(*cols).agg(F.count("*").alias("nb"))
    x, y = na.alias("x"), nb.alias("y")
    same = reduce(Column.__and__, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in cols])
    both = x.join(y, same).select(*[F.col(f"x.{c}").alias(c) for c in cols], F.least("na", "nb").alias("_n"))
    return both.select(*cols, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*cols)


def bag_overlap(a: Column, b: Column) -> Column:
    """The size of the multiset intersection of two word lists of a row; null entries are left out, null lists are empty."""
    return _common(*[F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array().cast("array<string>")) for c in (a, b)])


@F.arrow_udf(T.IntegerType())
def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in (a, b)]).astype(np.int64)
    common, _, _ = overlaps(word_codes(a.flatten(), b.flatten()), sizes, len(a), np.arange(len(a)), 1)
    return pa.array(common[:, 0].astype(np.int32))


def paired(hyp: DataFrame, ref: DataFrame, order: list[str], strict: bool = True, place: str = "idx") -> DataFrame:
    """The rows of two tables side by side by their place in the order of ``order``, which both have; ``place`` is that place, from 0.

    The columns of ``hyp`` come with ``hyp_`` and those of ``ref`` with ``ref_``
    before their names. Where one table is longer, evaluation fails if
    ``strict``, else its further rows are left out. Two empty tables give no rows.
    """
    x, y = (global_index(df, *order, name="_i").select(F.col("_i"), F.struct(*df.columns).alias(side)) for df, side in ((hyp, "_h"), (ref, "_r")))
    both = x.join(y, "_i", "full" if strict else "inner")
    here = F.col("_i")
    if strict:
        here = F.when(F.col("_h").isNull() | F.col("_r").isNull(), F.raise_error(F.lit("the tables differ in length"))).otherwise(here)
    return both.select(here.alias(place), *[F.col(f"_h.{c}").alias(f"hyp_{c}") for c in hyp.columns], *[F.col(f"_r.{c}").alias(f"ref_{c}") for c in ref.columns])


def not_yet_in(df: DataFrame, key: str, existing: DataFrame, existing_key: str) -> DataFrame:
    """Rows whose key is not in ``existing``: what an idempotent write still has to do."""
    return df.join(existing.select(F.col(existing_key).alias(key)), key, "left_anti")


def assigned(df: DataFrame, key: str, splits: DataFrame, order: Column, keep: list[str]) -> DataFrame:
    """``df`` with the split of its key, of several the one of the greatest ``order``; rows whose split is not in ``keep`` are left out."""
    last = splits.groupBy(key).agg(F.max_by("split", order).alias("split"))
    return df.drop("split").join(last, key).where(F.col("split").isin(*keep))


def carried(df: DataFrame, group: str, order: list[str], value: Column, name: str = "carried") -> DataFrame:
    """``df`` with the last non-null ``value`` at or before each row of its group.

    Rows are sorted by range over partitions. A partition's first group may
    have begun in an earlier one; what it takes over from there is decided on
    one row per partition, so a group of any size is spread over tasks.
    """
    run = _ordered(df.withColumn("_v", value), (group, *order))
    w = Window.partitionBy("_part", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    run = run.withColumn("_last", F.last("_v", ignorenulls=True).over(w))
    ends = run.groupBy("_part").agg(F.min_by(F.struct(F.col(group).alias("g")), "_at").alias("first"), F.max_by(F.struct(F.col(group).alias("g"), F.col("_last").alias("v")), "_at").alias("last")).orderBy("_part").collect()
    over, held = [], None
    for r in ends:
        over.append((r["_part"], held["v"] if held is not None and held["g"] == r["first"]["g"] else None, r["first"]["g"]))
        held = r["last"] if r["last"]["v"] is not None or held is None or held["g"] != r["last"]["g"] else held
    kinds = f"_part int, _over {run.schema['_v'].dataType.simpleString()}, _group {run.schema[group].dataType.simpleString()}"
    taken = df.sparkSession.createDataFrame(over, kinds)
    joined = run.join(F.broadcast(taken), "_part")
    return joined.withColumn(name, F.coalesce("_last", F.when(F.col(group).eqNullSafe(F.col("_group")), F.col("_over")))).drop("_part", "_at", "_v", "_last", "_over", "_group")


def carried_subset(df: DataFrame, group: str, order: list[str], marker: Column, origin: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows whose last marker at or before them fits.

    ``marker`` is a struct ``(origin, tag)``, null on rows that carry on the one
    before. ``origin`` selects one origin, ``non-`` before it all others;
    ``pattern`` is searched in the tag.
    """
    out = carried(df, group, order, marker, "_m")
    fits = F.col("_m").isNotNull()
    if origin is not None:
        fits = fits & (F.col("_m.origin") != origin[4:] if origin.startswith("non-") else F.col("_m.origin") == origin)
    if pattern is not None:
        fits = fits & F.coalesce(F.col("_m.tag"), F.lit("")).rlike(pattern)
    return out.where(fits).drop("_m")
