"""Frequency of every distinct term, from a vertical layout of compressed bitmaps.

Records are numbered in blocks of 65,536, one container key each. A block takes
its numbers from several slices of the input: the partition ``p`` fills the places
from ``(p mod 4) * 16,384`` of the blocks of its group of four. Each slice builds,
per term and key, a partial container of the places of its records that hold
the term: a sorted list of 16-bit places up to 4,096 of them, 65,536 bits beyond.
Beside each bitmap runs a counter of occurrences. The partial containers of a
key are merged by union, their counters by sum, and a term's document frequency
is the sum of the cardinalities of the merged ones.

A term that a third of all records hold is as many containers as there are
blocks, each of at most 8 KB; no group grows with the data.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.llm.identity import fingerprint
from glossmill.session import materialize

BLOCK = 65_536
#: Slices of the input that share a block, and the places of one of them.
SLICES = 4
PLACES = BLOCK // SLICES
SPARSE = 4_096
#: A slice of a block is closed early at so many entries, which bounds the memory of a task.
MAX_ENTRIES = 4_000_000


def plain_term(term: str | None) -> str | None:
    """Lower case, trimmed, composed; None for null and blank."""
    return None if term is None else unicodedata.normalize("NFC", term.strip().lower()).strip() or None


@F.arrow_udf(T.StringType())
def plain_terms(col: pa.Array) -> pa.Array:
    known: dict = {}
    return pa.array([known[t] if t in known else known.setdefault(t, plain_term(t)) for t in col.to_pylist()], pa.string())


def encode(positions: np.ndarray) -> bytes:
    """Sorted distinct positions below 65,536 as a container."""
    if len(positions) <= SPARSE:
        return b"a" + positions.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[positions] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def decode(container: bytes) -> np.ndarray:
    if container[:1] == b"a":
        return np.frombuffer(container, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8, offset=1), bitorder="little"))


def union(containers: Sequence[bytes]) -> bytes:
    return containers[0] if len(containers) == 1 else encode(reduce(np.union1d, map(decode, containers)))


def cardinality(container: bytes) -> int:
    if container[:1] == b"a":
        return (len(container) - 1) // 2
    return int(np.bitwise_count(np.frombuffer(container, np.uint8, offset=1)).sum())


@F.arrow_udf(T.StructType([T.StructField("bitmap", T.BinaryType()), T.StructField("n", T.LongType())]))
def union_bitmaps(col: pa.Array) -> pa.Array:
    merged = [union(x) for x in col.to_pylist()]
    return pa.StructArray.from_arrays([pa.array(merged, pa.binary()), pa.array(map(cardinality, merged), pa.int64())], ["bitmap", "n"])


def _containers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    group, slice_ = divmod(TaskContext.get().partitionId(), SLICES)
    key, offset = group << 32, slice_ * PLACES
    codes: dict[str, int] = {}
    parts: list[np.ndarray] = []
    filled = entries = 0

    def close() -> pa.RecordBatch:
        rows: list[tuple] = [(None, key, filled, None)]
        if parts:
            at, occ = np.unique(np.concatenate(parts), return_counts=True)
            code = at >> 16
            cuts = np.flatnonzero(np.diff(code, prepend=-1))
            names = list(codes)
            for c, n, positions in zip(code[cuts], np.add.reduceat(occ, cuts), np.split(at & 0xFFFF, cuts[1:])):
                rows.append((names[c], key, int(n), encode(positions)))
        t, k, n, b = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(b, pa.binary())], names=["term", "key", "occurrences", "bitmap"])

    for batch in batches:
        col, done = batch.column(0), 0
        while done < len(col):
            part = col.slice(done, min(len(col) - done, PLACES - filled, 1024))
            values = part.flatten().dictionary_encode()
            own = np.array([-1 if (t := plain_term(v)) is None else codes.setdefault(t, len(codes)) for v in values.dictionary.to_pylist()] + [-1], np.int64)
            index = own[values.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False)]
            sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            where = np.repeat(np.arange(offset + filled, offset + filled + len(part)), sizes)
            parts.append((index << 16 | where)[index >= 0])
            entries += len(parts[-1])
            filled += len(part)
            done += len(part)
            if filled == PLACES or entries >= MAX_ENTRIES:
                yield close()
                key, filled, entries = key + 1, 0, 0
                codes, parts = {}, []
    if filled:
        yield close()


def vertical_index(records: DataFrame, terms: str) -> DataFrame:
    """``(term, key, occurrences, bitmap)`` of a table with one row per record.

    The containers are partial: up to ``SLICES`` of one term and key, with disjoint
    places. A row with a null term has the number of records of its slice of the
    key. Null lists and null or blank entries hold no term, but their records count.
    """
    return records.select(F.col(terms).alias("terms")).mapInArrow(_containers, "term string, key bigint, occurrences bigint, bitmap binary")


def merge_indexes(*indexes: DataFrame) -> DataFrame:
    """One index of several over the same record numbers: bitmaps by union, counters by sum."""
    together = reduce(DataFrame.unionByName, indexes).where("term is not null")
    one = together.groupBy("term", "key").agg(F.sum("occurrences").alias("occurrences"), F.collect_list("bitmap").alias("bitmaps"))
    return one.withColumn("u", union_bitmaps("bitmaps")).select("term", "key", "occurrences", F.col("u.bitmap").alias("bitmap"), F.col("u.n").alias("n_records"))


def term_frequencies(df: DataFrame, record: str, terms: str, listed: Sequence[DataFrame] = (), rare_below: int = 3, common_from: float = 0.4) -> DataFrame:
    """``(lemma, n, n_records, mark)`` for every term of the records and of the one-column tables ``listed``.

    A record is a distinct value of ``record`` (null is one value), known by 128
    bits of it, so that the shuffle does not carry the values; of repeated
    rows the greatest list counts, and null lists are records without terms.
    ``mark`` is ``rare`` below ``rare_below`` records, else ``common`` if the
    occurrences divided by the number of records reach ``common_from``, else
    null. With no records at all every listed term is rare. Spellings that
    differ in letter case, outer white space or composition are one term.
    """
    distinct = df.select(*fingerprint(F.col(record), "r"), F.col(terms).alias("terms")).groupBy("r1", "r2").agg(F.max("terms").alias("terms"))
    index = materialize(vertical_index(distinct, "terms"), "terms")
    n = index.where("term is null").agg(F.sum("occurrences")).first()[0] or 0
    counted = merge_indexes(index).groupBy(F.col("term").alias("lemma")).agg(F.sum("occurrences").alias("n"), F.sum("n_records").alias("n_records"))
    for t in listed:
        extra = t.select(plain_terms(F.col(t.columns[0]).cast("string")).alias("lemma"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_records"))
        counted = counted.unionByName(extra.where("lemma is not null"))
    if listed:
        counted = counted.groupBy("lemma").agg(F.sum("n").alias("n"), F.sum("n_records").alias("n_records"))
    mark = F.when(F.col("n_records") < rare_below, "rare").when(F.col("n") / F.lit(float(max(n, 1))) >= common_from, "common")
    return counted.withColumn("mark", mark)
