"""Filling containers of fixed capacity with items of varying size.

Best fit decreasing: items in falling size, each into the open container with
the least room that still holds it. A segment tree over the remaining
capacities finds that room in logarithmic time. An item over the capacity is
cut into full containers and a rest, and the rest is packed like any item.

Items are dealt into shards by a hash of their row number, so that a shard has
the mixture of sizes of the whole, and each shard is packed in one task. A shard
holds about ``per_shard`` items whatever the data, also where most keys are null or
the same, and wastes at most what its few last containers leave open.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.session import materialize

PER_SHARD = 100_000


class Rooms:
    """Open containers by remaining capacity, under a segment tree of their numbers."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, capacity.bit_length())
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, container: int) -> None:
        self.bins[room].append(container)
        i = room + self.size
        while i:
            self.tree[i] += 1
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that some container has."""
        tree, i = self.tree, need + self.size
        if tree[i]:
            return need
        while i > 1:
            if not i & 1 and tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None

    def take(self, room: int) -> int:
        i = room + self.size
        while i:
            self.tree[i] -= 1
            i >>= 1
        return self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item; sizes lie between 1 and ``capacity``. Ties go in the given order."""
    rooms, used = Rooms(capacity), 0
    out = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        room = rooms.tightest(s)
        if room is None:
            container, room, used = used, capacity, used + 1
        else:
            container = rooms.take(room)
        out[i] = container
        if room > s:
            rooms.add(room - s, container)
    return out


def pack(items: DataFrame, key: str, size: str, capacity: int, per_shard: int = PER_SHARD) -> DataFrame:
    """``(<key>, piece, <size>, container)``: the container of each item, or of each piece of an item over ``capacity``.

    ``container`` is unique in the result. Items of null or no size take no
    room: one row with a null container. Repeated keys are items of their own;
    a null key is kept. An empty table gives no rows. The same partitions of the
    same rows give the same containers.
    """
    n = F.col("n")
    full = F.floor(n / capacity).cast("int")
    rest = (n % capacity).cast("int")
    pieces = F.when(n > 0, F.concat(F.array_repeat(F.lit(capacity), full), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))))
    cut = items.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("n")).select("key", F.posexplode_outer(pieces).alias("piece", "n"))
    cut = materialize(cut.withColumns({"piece": F.coalesce("piece", F.lit(0)), "row": F.monotonically_increasing_id()}), "items")
    shards = max(1, math.ceil(cut.where("n is not null").count() / per_shard))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).sort_by([("key", "ascending"), ("piece", "ascending"), ("row", "ascending")]).drop_columns("row").combine_chunks()
        container = best_fit_decreasing(t["n"].to_numpy(), capacity) + (TaskContext.get().partitionId() << 32)
        yield from t.append_column("container", pa.array(container)).to_batches()

    kind = dict(cut.dtypes)["key"]
    dealt = cut.where("n is not null").repartition(shards, F.xxhash64("row"))
    packed = dealt.mapInArrow(run, f"key {kind}, piece int, n int, container bigint")
    none = cut.where("n is null").select("key", "piece", F.lit(0).alias("n"), F.lit(None).cast("bigint").alias("container"))
    return packed.unionByName(none).select(F.col("key").alias(key), "piece", F.col("n").alias(size), "container")


def fill_report(packed: DataFrame, size: str, capacity: int) -> DataFrame:
    """Containers, tokens and the share of their room that is used."""
    per = packed.where("container is not null").groupBy("container").agg(F.sum(size).alias("used"))
    return per.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.round(F.sum("used") / (F.count("*") * capacity), 6).alias("fill"), F.max("used").alias("fullest"))
