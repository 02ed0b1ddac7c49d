"""Ordered samples: frame selection, windows, padding, batches, global positions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.session import materialize

EMPTY = "array<int>"


def span(start: Column, end: Column, stride: int) -> Column:
    """``start, start + stride, ...`` before ``end``; empty where there is none."""
    return F.when(end > start, F.sequence(start.cast("int"), (end - 1).cast("int"), F.lit(stride))).otherwise(F.array().cast(EMPTY))


def strided(n: Column, stride: int = 2) -> Column:
    """Every ``stride``-th frame of ``n``; null of a null count."""
    return F.when(n.isNotNull(), span(F.lit(0), n, stride))


def strided_or_all(n: Column, stride: int = 2) -> Column:
    s = strided(n, stride)
    return F.when(F.size(s) == 0, span(F.lit(0), n, 1)).otherwise(s)


def draw(limit: Column, *seeds) -> Column:
    """A whole number from 0 to ``limit - 1`` by a hash of the seeds; 0 of an empty range. The same in every run and partitioning."""
    parts = F.concat_ws("|", *[s.cast("string") if isinstance(s, Column) else F.lit(str(s)) for s in seeds])
    h = F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("bigint")
    return F.when(limit > 0, F.pmod(h, F.greatest(limit.cast("bigint"), F.lit(1)))).otherwise(0).cast("int")


def jittered(key: Column, n: Column, shift: int = 4, stride: int = 2, epoch: int = 0) -> Column:
    """Frames from a start drawn from the first ``shift`` to an end drawn from the last, for training."""
    start = F.least(draw(F.lit(shift), key, epoch, "start"), n)
    end = F.greatest(n - shift + draw(F.lit(shift + 1), key, epoch, "end"), F.lit(0))
    return F.when(n.isNotNull(), span(start, end, stride))


def capped(df: DataFrame, key: str, ordinals: str, most: int, epoch: int = 0) -> DataFrame:
    """``df`` with at most ``most`` of each row's ordinals, drawn without replacement and sorted.

    The draw is the order of a hash of key, epoch and ordinal, so it is made in
    the row. This is the sampling operator; rows are never dropped.
    """
    drawn = F.transform(F.slice(F.array_sort(F.transform(F.col(ordinals), lambda i: F.struct(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(epoch)), i.cast("string"))).alias("h"), i.alias("i")))), 1, most), lambda s: s["i"])
    return df.withColumn(ordinals, F.when(F.size(ordinals) > most, F.array_sort(drawn)).otherwise(F.col(ordinals)))


def shuffled_rank(key: Column, epoch: int, seed: int = 0) -> Column:
    """A sort key that orders rows at random, anew for each epoch."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(str(epoch))))


def positions(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with ``pos``, from 0 in each key.

    The rows are numbered in their total order and each key's first number is
    taken off, so a key that holds most rows is spread over many tasks.
    """
    indexed = global_index(df, key, *order, name="_idx")
    first = indexed.groupBy(key).agg(F.min("_idx").alias("_first"))
    out = indexed.join(first, indexed[key].eqNullSafe(first[key])).drop(first[key])
    return out.withColumn("pos", F.col("_idx") - F.col("_first")).drop("_idx", "_first")


#: Positions of a key that one window task holds at most, beside the neighbours.
SLICE = 4096


def sliced(df: DataFrame, reach: int) -> DataFrame:
    """``df`` with ``_slice`` and ``_own``: each row in its slice of positions, and as a neighbour in the slices it is within ``reach`` of."""
    b, at = F.floor(F.col("pos") / SLICE), F.col("pos") % SLICE
    none = F.array().cast("array<bigint>")
    copies = F.concat(F.array(b), F.when((at < reach) & (b > 0), F.array(b - 1)).otherwise(none), F.when(at >= SLICE - reach, F.array(b + 1)).otherwise(none))
    return df.select("*", F.explode(copies).alias("_slice")).withColumn("_own", F.col("_slice") == F.floor(F.col("pos") / SLICE))


def near(key: str, reach: int):
    return Window.partitionBy(key, "_slice").orderBy("pos").rowsBetween(-reach, reach)


def downsampled(df: DataFrame, key: str, value: str, valid: str = "valid") -> DataFrame:
    """Average pooling of three neighbours, every second position, over ``(key, pos, value, valid)``.

    Missing neighbours count as zeros in a divisor of always 3. A pooled
    position is valid if one of its neighbours is, and the first always.
    """
    w = near(key, 1)
    pooled = sliced(df, 1).select(
        key, "pos", "_own",
        (F.coalesce(F.sum(value).over(w), F.lit(0.0)) / 3).alias("pooled"),
        ((F.col("pos") == 0) | F.max(F.col(valid)).over(w)).alias("valid"),
    )
    return pooled.where("_own and pos % 2 = 0").drop("_own").withColumn("pos", (F.col("pos") / 2).cast("int"))


def local_mean(df: DataFrame, key: str, value: str, reach: int = 3) -> DataFrame:
    """The mean of the values up to ``reach`` positions away; invalid ones do not count, the own one always does."""
    w = near(key, reach)
    others = F.sum(F.when(F.col("valid"), F.col(value)).otherwise(0.0)).over(w) + F.when(F.col("valid"), 0.0).otherwise(F.col(value))
    n = F.sum(F.col("valid").cast("int")).over(w) + (~F.col("valid")).cast("int")
    return sliced(df, reach).select(key, "pos", "_own", (others / n).alias("mean"), n.alias("n")).where("_own").drop("_own")


def local_attention(df: DataFrame, key: str, query: str, value: str, reach: int = 3) -> DataFrame:
    """Softmax attention of each position over its neighbours: weights from the products of ``query`` values."""
    entry = F.struct(F.col("pos").alias("p"), F.col(query).alias("q"), F.col(value).alias("x"), F.col("valid").alias("ok"))
    held = sliced(df, reach).withColumn("_n", F.collect_list(entry).over(near(key, reach))).where("_own")
    used = F.filter("_n", lambda e: e["ok"] | (e["p"] == F.col("pos")))
    logit = F.transform(used, lambda e: _pair(e["q"] * F.col(query), e["x"]))
    top = F.array_max(F.transform(logit, lambda e: e["a"]))
    weights = F.transform(logit, lambda e: _pair(F.exp(e["a"] - top), e["x"]))
    total = F.aggregate(weights, F.lit(0.0), lambda s, e: s + e["a"])
    mixed = F.aggregate(weights, F.lit(0.0), lambda s, e: s + e["a"] * e["x"])
    return held.select(key, "pos", (mixed / total).alias("mixed"))


def _pair(a: Column, x: Column) -> Column:
    return F.struct(a.cast("double").alias("a"), x.cast("double").alias("x"))


def running(df: DataFrame, key: str, value: Column) -> DataFrame:
    """``df`` with ``total``, the sum of ``value`` up to each position of its key.

    Sums run within slices; the totals of the slices, one row for each, run
    over the key.
    """
    cut = df.withColumn("_v", value).withColumn("_slice", F.floor(F.col("pos") / SLICE))
    per = cut.groupBy(key, "_slice").agg(F.sum("_v").alias("_s"))
    before = per.select(key, "_slice", F.sum("_s").over(Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    inner = cut.withColumn("_t", F.sum("_v").over(Window.partitionBy(key, "_slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    joined = inner.alias("i").join(before.alias("b"), F.col(f"i.{key}").eqNullSafe(F.col(f"b.{key}")) & (F.col("i._slice") == F.col("b._slice")))
    return joined.select(*[F.col(f"i.{c}").alias(c) for c in df.columns], (F.col("_t") + F.coalesce("_before", F.lit(0))).alias("total"))


def causal_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """The sum of all values up to each position."""
    return running(df, key, F.col(value)).select(key, "pos", "total")


def position_ids(df: DataFrame, key: str, is_pad: Column, pad_id: int = 1) -> DataFrame:
    """Running count of the rows that are no padding, after ``pad_id``; padding keeps ``pad_id``."""
    pad = df.withColumn("_pad", is_pad)
    return running(pad, key, (~F.col("_pad")).cast("int")).select(key, "pos", F.when(F.col("_pad"), pad_id).otherwise(F.col("total") + pad_id).cast("int").alias("position_id"))


def _ordered(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``df`` sorted by range over partitions, as a table with ``_part`` and ``_at``, the place in the partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return materialize(run.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ordered")


def _with_before(run: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``run`` with ``_before``, what lies before each partition: a join with one row per partition."""
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p] or 0
    return run.join(F.broadcast(run.sparkSession.createDataFrame(starts, "_part int, _before bigint")), "_part")


def global_index(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """``df`` with its position in the total order, from 0.

    Rows are sorted by range; each partition counts its own rows, and only
    those counts, one per partition, go through the driver.
    """
    run = _ordered(df, order)
    sizes = {r[0]: r[1] for r in run.groupBy("_part").count().collect()}
    return _with_before(run, sizes).withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def prefix_offsets(df: DataFrame, size: str, *order: str) -> DataFrame:
    """``df`` with ``start`` and ``end``: running totals of ``size`` in the total order; null sizes count 0."""
    run = _ordered(df.withColumn(size, F.coalesce(size, F.lit(0)).cast("bigint")), order)
    sums = {r[0]: r[1] for r in run.groupBy("_part").agg(F.sum(size)).collect()}
    inner = F.sum(size).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return _with_before(run, sums).withColumn("end", F.col("_before") + inner).withColumn("start", F.col("end") - F.col(size)).drop("_part", "_at", "_before")


def concatenated(members: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """``(idx, member, local_idx, <key>)``: the members one after the other, each in the order of its key."""
    parts = [df.select(F.lit(i).alias("_m"), F.lit(name).alias("member"), F.col(key).alias(key)) for i, (name, df) in enumerate(members)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    indexed = global_index(union, "_m", key)
    first = indexed.groupBy("_m").agg(F.min("idx").alias("_first"))
    return indexed.join(F.broadcast(first), "_m").select("idx", "member", (F.col("idx") - F.col("_first")).alias("local_idx"), key)


#: Most members that are sent to every task; of more, positions are found by sorting both together.
MAX_MEMBERS = 100_000


def locate(queries: DataFrame, sizes: DataFrame, most: int = MAX_MEMBERS) -> DataFrame:
    """``(idx, member, local_idx)`` of ordinals into members laid end to end; negative ones count from the end, others out of range have nulls.

    ``sizes (member_no, member, size)`` has a row per member, not per element. Up
    to ``most`` members are sent to every task, which searches their sorted
    starts; more are sorted together with the ordinals, and each ordinal takes
    the last member that starts at or before it. Null ordinals are out of range.
    """
    laid = prefix_offsets(sizes, "size", "member_no", "member").where("size > 0").select("start", "end", F.col("member").cast("string").alias("member"))
    number, total = laid.agg(F.count("*"), F.coalesce(F.max("end"), F.lit(0))).first()
    at = F.when(F.col("idx") < 0, F.col("idx") + total).otherwise(F.col("idx"))
    asked = queries.select(F.col("idx").cast("bigint").alias("idx"), at.cast("bigint").alias("at"))
    if number > most:
        from glossmill.operators.relations import carried

        starts = laid.select(F.lit(None).cast("bigint").alias("idx"), F.col("start").alias("at"), F.struct("member", "start", "end").alias("m"), F.lit(0).alias("is_query"))
        both = starts.unionByName(asked.select("*", F.lit(None).cast(starts.schema["m"].dataType).alias("m"), F.lit(1).alias("is_query")))
        got = carried(both.withColumn("all", F.lit(0)), "all", ["at", "is_query"], F.col("m"), "c").where("is_query = 1")
        inside = F.col("at") < F.col("c.end")
        return got.select("idx", F.when(inside, F.col("c.member")).alias("member"), F.when(inside, F.col("at") - F.col("c.start")).alias("local_idx"))
    rows = laid.orderBy("start").toArrow()
    held = queries.sparkSession.sparkContext.broadcast((rows["start"].to_numpy(), rows["member"].combine_chunks()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, members = held.value
        for batch in batches:
            place = batch.column(1).fill_null(-1).to_numpy()
            inside = (place >= 0) & (place < total)
            m = np.searchsorted(starts, place, side="right") - 1
            local = place - (starts[m] if len(starts) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), members.take(pa.array(m, mask=~inside)), pa.array(local, mask=~inside)], names=["idx", "member", "local_idx"])

    return asked.mapInArrow(run, "idx bigint, member string, local_idx bigint")


def batches(df: DataFrame, size: int, *order: str, drop_last: bool = True) -> DataFrame:
    """``df`` in its order with ``batch_id`` and ``slot``; an incomplete last batch is left out if ``drop_last``."""
    indexed = global_index(df, *order)
    out = indexed.withColumn("batch_id", F.floor(F.col("idx") / size)).withColumn("slot", (F.col("idx") % size).cast("int")).drop("idx")
    if drop_last:
        full = out.groupBy("batch_id").count().where(F.col("count") == size)
        out = out.join(full.select("batch_id"), "batch_id", "left_semi")
    return out


def collate(batched: DataFrame, *columns: str) -> DataFrame:
    """One row per batch with a list of each column, in slot order; rows where all of them are null are left out."""
    kept = batched.dropna("all", subset=list(columns))
    lists = kept.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("slot", *columns))).alias("_rows"))
    return lists.select("batch_id", *[F.col(f"_rows.{c}").alias(c) for c in columns])


def padded(values: Column, length: Column, fill=0) -> Column:
    """``values`` cut or filled up to ``length``."""
    return F.concat(F.slice(values, 1, length), F.array_repeat(F.lit(fill), F.greatest(length - F.size(values), F.lit(0))))


def mask(values: Column, length: Column) -> Column:
    """True for each position that is a value, false for padding."""
    n = F.least(F.size(values), length)
    return F.concat(F.array_repeat(F.lit(True), n), F.array_repeat(F.lit(False), length - n))


def pad_batches(batched: DataFrame, values: str, max_length: int | None = None) -> DataFrame:
    """``batched`` with each list padded to the longest of its batch (at most ``max_length``) and a mask."""
    longest = batched.groupBy("batch_id").agg(F.max(F.size(values)).alias("_longest"))
    length = F.col("_longest") if max_length is None else F.least("_longest", F.lit(max_length))
    out = batched.join(longest, "batch_id").withColumn("_length", length)
    return out.withColumn("padded", padded(F.col(values), F.col("_length"))).withColumn("mask", mask(F.col(values), F.col("_length"))).drop("_longest", "_length")


def shifted(ids: Column, prefix: int = 1) -> tuple[Column, Column]:
    """Inputs without the last id and targets without the first ``prefix``."""
    n = F.size(ids)
    return F.slice(ids, 1, F.greatest(n - 1, F.lit(0))), F.slice(ids, prefix + 1, F.greatest(n - prefix, F.lit(0)))


def until(ids: Column, end: int) -> Column:
    """The ids before the first ``end``; all without one."""
    at = F.array_position(ids, F.lit(end))
    return F.when(at > 0, F.slice(ids, 1, (at - 1).cast("int"))).otherwise(ids)


def truncated(ids: Column, most: int) -> Column:
    return F.slice(ids, 1, most)


def first_batches(batched: DataFrame, most: int | None) -> DataFrame:
    """The first ``most`` batches of an epoch, all of them with None."""
    return batched if most is None else batched.where(F.col("batch_id") < most)


def split_ragged(flat: DataFrame, lengths: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """``(<key>, <value>)``: rows laid end to end in the order of ``order`` (from 0), split again into lists of the ``length`` of each key, in the order of the keys.

    The inverse of laying ragged lists end to end for one call of a model. A
    length of 0 or null gives an empty list; rows beyond the lengths are left out.
    """
    members = prefix_offsets(lengths.select(key, F.col("length").alias("_n")), "_n", key)
    ranges = members.select(F.col("start").alias("member_no"), F.col(key).cast("string").alias("member"), F.col("_n").alias("size"))
    found = locate(flat.select(F.col(order).alias("idx")), ranges)
    rows = flat.join(found.where("member is not null"), flat[order] == found["idx"]).groupBy("member").agg(F.transform(F.array_sort(F.collect_list(F.struct("local_idx", F.col(value).alias("v")))), lambda x: x["v"]).alias(value))
    kind = flat.schema[value].dataType.simpleString()
    return lengths.select(key).join(rows, F.col(key).cast("string") == F.col("member"), "left").select(key, F.coalesce(value, F.array().cast(f"array<{kind}>")).alias(value))
