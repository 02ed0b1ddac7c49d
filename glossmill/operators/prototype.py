"""Scoring frame sequences against class prototypes.

Every frame vector is compared with every prototype by cosine; one null class
of an all-zero vector joins with similarity 0. A softmax over the classes of
each frame and one over the valid frames of each class are multiplied and
summed over the frames.

Cosines lie between -1 and 1 and temperatures are at least 0.01, so the
exponents are shifted by their known maximum and the softmax over time is a
quotient of two sums. A score is therefore ``sum(a e) / sum(e)`` over the frames
of a sample, which each task adds up for its frames before the one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.functions.math import as_doubles
from glossmill.session import materialize

#: Bytes of prototypes that are sent to every task at once; more are scored block by block.
BLOCK_BYTES = 64 << 20
#: Similarities held at once.
CELLS = 2_000_000
LOWEST, HIGHEST = 0.01, 1.0


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(<key>, vector)``: the mean vector of each key, by position."""
    long = df.select(key, F.posexplode(as_doubles(F.col(vector))).alias("i", "x"))
    means = long.groupBy(key, "i").agg(F.avg("x").alias("x"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("vector"))


def softmax_over(x: Column, *keys: str) -> Column:
    """Softmax of a column within the rows that share ``keys``."""
    w = Window.partitionBy(*keys)
    e = F.exp(x - F.max(x).over(w))
    return e / F.sum(e).over(w)


def units(flat: np.ndarray, rows: int, width: int) -> np.ndarray:
    """Vectors over their lengths; zero vectors stay zero."""
    m = np.asarray(flat, np.float64).reshape(rows, width)
    return m / np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1e-12)


def packed(prototypes: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcasts of class ids and their unit vectors, in the order of the ids, of at most about ``block_bytes`` each."""
    kept = prototypes.where("vector is not null").select(F.col("class_id").cast("int").alias("class_id"), as_doubles(F.col("vector")).alias("vector"))
    number, width = kept.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    blocks = max(1, -(-number * width * 8 // block_bytes))
    if blocks > 1:
        kept = materialize(kept, "prototypes")
    out = []
    for i in range(blocks):
        part = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("class_id"), F.lit(blocks)) == i)
        got = part.toArrow().sort_by("class_id")
        flat = got["vector"].combine_chunks().flatten().to_numpy() if got.num_rows else np.zeros(0)
        out.append(prototypes.sparkSession.sparkContext.broadcast((got["class_id"].to_numpy(), units(flat, got.num_rows, width))))
    return out


def _blocks(batch: pa.RecordBatch, vector: int, protos: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows and their similarities with all prototypes."""
    step = max(1, CELLS // max(1, len(protos)))
    for lo in range(0, batch.num_rows if len(protos) else 0, step):
        rows = batch.column(vector).slice(lo, step)
        yield slice(lo, lo + len(rows)), units(rows.flatten().to_numpy(zero_copy_only=False), len(rows), protos.shape[1]) @ protos.T


def _kept(frames: DataFrame, *columns: str) -> DataFrame:
    return frames.where(F.col("valid") & F.col("vec").isNotNull()).select(*columns, as_doubles(F.col("vec")).alias("vec"))


def similarities(frames: DataFrame, prototypes: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(sample, t, class_id, s)`` of ``frames (sample, t, vec, valid)`` and ``prototypes (class_id, vector)``; invalid frames and null vectors are left out.

    One row per frame and class: for what needs them all. ``frame_losses`` and
    ``prototype_scores`` sum them up where they are made.
    """

    def run(batches: Iterable[pa.RecordBatch], classes) -> Iterator[pa.RecordBatch]:
        ids, protos = classes.value
        for batch in batches:
            for at, s in _blocks(batch, 2, protos):
                row = pa.array(np.repeat(np.arange(at.start, at.stop), len(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(np.tile(ids, at.stop - at.start)), pa.array(s.ravel())], names=["sample", "t", "class_id", "s"])

    kinds = {c: frames.schema[c].dataType.simpleString() for c in ("sample", "t")}
    kept = _kept(frames, "sample", "t")
    parts = [kept.mapInArrow(lambda b, c=c: run(b, c), f"sample {kinds['sample']}, t {kinds['t']}, class_id int, s double") for c in packed(prototypes, block_bytes)]
    return reduce(DataFrame.unionByName, parts)


def frame_losses(frames: DataFrame, prototypes: DataFrame, scale: float = 10.0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(sample, t, target_id, lse, mean, hit, class_id)`` of ``frames (sample, t, vec, valid, target_id)``: what losses and predictions need of each frame's logits.

    Logits are similarities times ``scale``: ``lse`` is the logarithm of the sum of
    their exponentials, ``mean`` their mean, ``hit`` the target's (null if it is no
    class) and ``class_id`` the class of the greatest to six digits, the least of equal
    ones. Each task sums up the classes of its frames, so no row per frame and class
    is written; of prototypes in several blocks each block's sums are joined.
    """

    def run(batches: Iterable[pa.RecordBatch], classes) -> Iterator[pa.RecordBatch]:
        ids, protos = classes.value
        for batch in batches:
            target = batch.column(2).fill_null(np.iinfo(np.int32).min).to_numpy()
            for at, s in _blocks(batch, 3, protos):
                z = s * scale
                col = np.searchsorted(ids, target[at])
                known = (col < len(ids)) & (ids[np.minimum(col, len(ids) - 1)] == target[at])
                hit = z[np.arange(len(z)), np.minimum(col, len(ids) - 1)]
                best = np.round(z, 6).argmax(axis=1)
                columns = [np.exp(z - scale).sum(axis=1), z.sum(axis=1), np.full(len(z), len(ids), np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(at.start, at.stop - at.start) for i in range(3)], *map(pa.array, columns), pa.array(hit, mask=~known), pa.array(np.round(z, 6)[np.arange(len(z)), best]), pa.array(ids[best])],
                    names=["sample", "t", "target_id", "e", "z", "n", "hit", "top", "class_id"],
                )

    kinds = {c: frames.schema[c].dataType.simpleString() for c in ("sample", "t")}
    kept = _kept(frames.withColumn("target_id", F.col("target_id").cast("int")), "sample", "t", "target_id")
    schema = f"sample {kinds['sample']}, t {kinds['t']}, target_id int, e double, z double, n bigint, hit double, top double, class_id int"
    blocks = packed(prototypes, block_bytes)
    if len(blocks) > 1:
        kept = materialize(kept, "frames")
    parts = reduce(DataFrame.unionByName, [kept.mapInArrow(lambda b, c=c: run(b, c), schema) for c in blocks])
    if len(blocks) > 1:
        parts = parts.groupBy("sample", "t", "target_id").agg(F.sum("e").alias("e"), F.sum("z").alias("z"), F.sum("n").alias("n"), F.max("hit").alias("hit"), F.max_by("class_id", F.struct("top", -F.col("class_id"))).alias("class_id"))
    return parts.select("sample", "t", "target_id", (F.ln("e") + scale).alias("lse"), (F.col("z") / F.col("n")).alias("mean"), "hit", "class_id")


def prototype_scores(frames: DataFrame, prototypes: DataFrame, class_temperature: float = 0.1, time_temperature: float = 0.1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(sample, class_id, score)``, each score between 0 and 1; temperatures are held between 0.01 and 1.

    Prototypes in several blocks are scored in two rounds: the first sums each
    frame's exponentials over all blocks, the second divides by them.
    """
    tc, tt = (min(max(float(t), LOWEST), HIGHEST) for t in (class_temperature, time_temperature))
    kind = frames.schema["sample"].dataType.simpleString()
    kept = _kept(frames, "sample").withColumn("whole", F.lit(None).cast("double"))
    blocks = packed(prototypes, block_bytes)

    def summed(batches: Iterable[pa.RecordBatch], classes) -> Iterator[pa.RecordBatch]:
        _, protos = classes.value
        for batch in batches:
            whole = batch.column(2).fill_null(0.0).to_numpy().copy()
            for at, s in _blocks(batch, 1, protos):
                whole[at] += np.exp((s - 1) / tc).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(whole)], names=["sample", "vec", "whole"])

    for c in blocks if len(blocks) > 1 else ():
        kept = materialize(kept.mapInArrow(lambda b, c=c: summed(b, c), f"sample {kind}, vec array<double>, whole double"), "frames")

    def run(batches: Iterable[pa.RecordBatch], classes) -> Iterator[pa.RecordBatch]:
        ids, protos = classes.value
        for batch in batches:
            sample = batch.column(0).dictionary_encode()
            number = sample.indices.fill_null(len(sample.dictionary)).to_numpy(zero_copy_only=False)
            whole = batch.column(2).to_numpy(zero_copy_only=False)
            for at, s in _blocks(batch, 1, protos):
                a = np.exp((s - 1) / tc)
                own = np.where(np.isnan(whole[at]), a.sum(axis=1), whole[at])
                a /= own[:, None] + np.exp(-1 / tc)  # the null class has similarity 0
                e = np.exp((s - 1) / tt)
                order = np.argsort(number[at], kind="stable")
                first = np.flatnonzero(np.diff(number[at][order], prepend=-1))
                ae, e = np.add.reduceat((a * e)[order], first), np.add.reduceat(e[order], first)
                row = pa.array(np.repeat(order[first] + at.start, len(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(np.tile(ids, len(first))), pa.array(ae.ravel()), pa.array(e.ravel())], names=["sample", "class_id", "ae", "e"])

    sums = reduce(DataFrame.unionByName, [kept.mapInArrow(lambda b, c=c: run(b, c), f"sample {kind}, class_id int, ae double, e double") for c in blocks])
    return sums.groupBy("sample", "class_id").agg((F.sum("ae") / F.sum("e")).alias("score"))
