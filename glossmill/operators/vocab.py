"""Vocabularies, frequency rules and dictionary lookups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossmill.operators.sequence import global_index
from glossmill.session import materialize

#: Parts of speech whose words are pseudo-glosses.
CONTENT_POS = ("NOUN", "NUM", "ADV", "PRON", "PROPN", "ADJ", "VERB")
COMMON_RATIO = 0.4


def occurrences(df: DataFrame, lists: str) -> DataFrame:
    """``(lemma, n)`` over the lists of all rows, repeated rows included; null entries are left out."""
    return df.select(F.explode(lists).alias("lemma")).where("lemma is not null").groupBy("lemma").agg(F.count("*").alias("n"))


def dense_ids(df: DataFrame, value: str) -> DataFrame:
    """``(<value>, id)``: ids from 0 in byte order of the distinct values; null has none."""
    distinct = df.where(F.col(value).isNotNull()).select(value).distinct()
    return global_index(distinct, value, name="id").withColumn("id", F.col("id").cast("int"))


def keep_last(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, that of the greatest ``order``; as an aggregation, so copies are combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def frequency_ratio(counts: DataFrame, n_sentences: int, below: float = COMMON_RATIO) -> DataFrame:
    """Lemmas whose occurrences divided by the number of distinct sentences stay strictly below ``below``.

    Occurrences are those of all rows, sentences the distinct ones, so a ratio
    may exceed 1.
    """
    return counts.withColumn("ratio", F.col("n") / F.lit(float(n_sentences))).where(F.col("ratio") < below)


def lookup_ids(df: DataFrame, key: str, terms: str, ids: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """``(<key>, ids)``: the ids of each row's terms, in order; terms not in ``kept`` are left out, rows without terms get an empty list.

    ``ids (lemma, id)`` and ``kept (lemma)`` are vocabularies. Only the pairs
    travel, one row per term; a term without an id is left out and counted by
    ``lookup_misses``. Keys must be unique.
    """
    each = df.select(key, F.posexplode(terms).alias("i", "lemma"))
    if kept is not None:
        each = each.join(kept.select("lemma"), "lemma", "left_semi")
    found = each.join(ids, "lemma").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda x: x["id"]).alias("ids"))
    return df.select(key).join(found, key, "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))


def lookup_misses(df: DataFrame, terms: str, ids: DataFrame) -> DataFrame:
    """``(lemma, n)``: terms without an id, which a strict lookup must treat as an error."""
    return occurrences(df, terms).join(ids.select("lemma"), "lemma", "left_anti")


def checked(df: DataFrame, column: str, what: str) -> DataFrame:
    """``df``, whose evaluation fails on a null in ``column``: a lookup that must not miss."""
    return df.withColumn(column, F.when(F.col(column).isNull(), F.raise_error(F.lit(f"no {what}"))).otherwise(F.col(column)))


def tagged(words: Column, tags: Column) -> Column:
    """``array<struct<text, pos>>`` of two lists; ends with the shorter."""
    return F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.size(tags))), lambda i: F.struct(F.get(words, i - 1).alias("text"), F.get(tags, i - 1).alias("pos")))


def content_words(tokens: Column, pos: Sequence[str] = CONTENT_POS, field: str = "text") -> Column:
    """The words, or lower-cased lemmas (``field="lemma"``), of the kept parts of speech, in order."""
    kept = F.filter(tokens, lambda t: t["pos"].isin(*pos))
    return F.transform(kept, lambda t: F.lower(t[field]) if field == "lemma" else t[field])


def lexicon_tags(df: DataFrame, key: str, words: str, lexicon: DataFrame) -> DataFrame:
    """``(<key>, tokens array<struct<text, lemma, pos>>)`` by lookup in ``lexicon (word, lemma, pos)``; unknown words have the pos ``X``."""
    each = df.select(key, F.posexplode(words).alias("i", "word"))
    known = each.join(lexicon, "word", "left")
    token = F.struct("i", F.col("word").alias("text"), F.coalesce("lemma", "word").alias("lemma"), F.coalesce("pos", F.lit("X")).alias("pos"))
    return known.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(token)), lambda t: F.struct(t["text"].alias("text"), t["lemma"].alias("lemma"), t["pos"].alias("pos"))).alias("tokens"))


#: Most bytes of a vocabulary that is sent to every task; ids are joined with a larger one.
VOCABULARY_BYTES = 16 << 20


def decoded(df: DataFrame, key: str, ids: str, pieces: DataFrame, special: Sequence[int] = (), between: str = "", most: int = VOCABULARY_BYTES) -> DataFrame:
    """``(<key>, text)``: the pieces of each row's ids in order, joined by ``between``; ``special`` ids and ids without a piece are left out.

    ``pieces (id, piece)`` is a vocabulary, written to the shared folder. One of up to
    ``most`` bytes is sent to every task and looked up in the row's own batch, so no
    row per id is made; with a larger one the ids are joined one row each, sorted on
    both sides, since the engine takes exploded rows for as small as their source.
    Null lists give a null text, lists with nothing to show an empty one. Keys must be unique.
    """
    known = pieces.select("id", "piece").where("id is not null and piece is not null")
    if special:
        known = known.where(~F.col("id").isin(*special))
    known = materialize(known.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("piece")), between).alias("piece")), "pieces")
    if known.agg(F.coalesce(F.sum(F.octet_length("piece") + 12), F.lit(0))).first()[0] <= most:
        return df.select(key, _shown(known, between)(ids).alias("text"))
    each = df.select(key, F.posexplode(ids).alias("i", "id"))
    found = each.join(known.hint("merge"), "id").groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "piece"))), lambda x: x["piece"]), between).alias("text"))
    return df.select(key, F.col(ids).isNull().alias("_null")).join(found.hint("merge"), key, "left").select(key, F.when(~F.col("_null"), F.coalesce("text", F.lit(""))).alias("text"))


def _shown(known: DataFrame, between: str) -> Callable[[str], Column]:
    rows = known.orderBy("id").toArrow()
    held = known.sparkSession.sparkContext.broadcast((rows["id"].to_numpy().astype(np.int64), rows["piece"].combine_chunks()))

    @F.arrow_udf(T.StringType())
    def run(ids: pa.Array) -> pa.Array:
        of, pieces = held.value
        flat, sizes = ids.flatten(), pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False)
        if not len(of):
            return pc.if_else(ids.is_null(), None, pa.array([""] * len(ids), pa.string()))
        asked = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(of, asked), len(of) - 1)
        hit = (of[at] == asked) & flat.is_valid().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(sizes)])]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces.take(pa.array(at[hit])))
        return pc.if_else(ids.is_null(), None, pc.binary_join(lists, between))

    return run


def pseudo_glosses(df: DataFrame, sentence: str, tokens: Column, path: str | None = None, below: float = COMMON_RATIO, field: str = "lemma", pos: Sequence[str] = CONTENT_POS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sentence, lemmas)``, ``(lemma, n)`` and ``(lemma, id)`` of tagged sentences in one call, written below ``path`` if it is given.

    ``tokens`` are a tagger's, ``array<struct<text, lemma, pos>>``; words of other parts of
    speech are left out. Counts are those of all rows, ids those of the lemmas
    whose ratio stays below ``below``.
    """
    lists = df.select(F.col(sentence).alias("sentence"), content_words(tokens, pos, field).alias("lemmas"))
    counts = occurrences(lists, "lemmas")
    n = max(1, lists.select("sentence").distinct().count())
    out = keep_last(lists, "sentence", F.array_join("lemmas", "|")), counts, dense_ids(frequency_ratio(counts, n, below), "lemma")
    if path is None:
        return out
    for part, name in zip(out, ("dict_sentence", "dict_lem_counter", "dict_lem_to_id")):
        part.write.parquet(f"{path}/{name}")
    return tuple(df.sparkSession.read.schema(part.schema).parquet(f"{path}/{name}") for part, name in zip(out, ("dict_sentence", "dict_lem_counter", "dict_lem_to_id")))


def rows_at(df: DataFrame, index: str, rows: DataFrame, key: str, what: str = "row") -> DataFrame:
    """``df`` with the columns of the row of ``rows`` whose ``key`` is ``index``: a lookup in a table of embeddings or positions.

    An index without a row makes evaluation fail; a null index has null columns.
    ``key`` must be unique; the engine sends ``rows`` to the tasks if it is small.
    """
    found = rows.withColumnRenamed(key, "_key").withColumn("_found", F.lit(True))
    out = df.join(found, F.col(index) == F.col("_key"), "left")
    missing = F.col("_found").isNull() & F.col(index).isNotNull()
    return out.withColumn(index, F.when(missing, F.raise_error(F.lit(f"no such {what}"))).otherwise(F.col(index))).drop("_key", "_found")


def vocabulary_vectors(ids: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(id, lemma, vec)``: the vector of each entry of ``ids (lemma, id)``; entries that ``vectors (word, vec)`` lacks have a vector of zeros."""
    width = F.lit(vectors.agg(F.coalesce(F.max(F.size("vec")), F.lit(0))).first()[0])
    joined = ids.join(vectors.withColumnRenamed("word", "lemma"), "lemma", "left")
    return joined.select("id", "lemma", F.coalesce("vec", F.array_repeat(F.lit(0.0), width)).alias("vec"))
