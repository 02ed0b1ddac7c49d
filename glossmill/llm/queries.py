"""Queries of this package by name, and their SQL where SQL can express them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm import chunking, identity, lookalike, mixing, overlap, packing, terms, tokens
from glossmill.llm.oracles import ORACLES  # noqa: F401
from glossmill.session import materialize, spread, table


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [table(spark, sf_dir, t).select("lemma") for t in ("dict_lem_counter", "dict_lem_to_id")]
    return terms.term_frequencies(table(spark, sf_dir, "dict_sentence"), "sentence", "lemmas", listed)


def p1_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _terms(spark, sf_dir)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _terms(spark, sf_dir).where("mark is not null").select("lemma", "mark")


def forms(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``(corpus, rec_id, raw, form, more...)`` of the sentences of both corpora."""
    a, b = table(spark, sf_dir, "corpus_a"), table(spark, sf_dir, "corpus_b")
    a, b = spread(a.where("label_char is not null").select("rec_id", *more, "label_char")), spread(b.where("translation is not null").select("rec_id", *more, "translation"))
    a = a.select(F.lit("a").alias("corpus"), "rec_id", *more, lookalike.joined_column(F.col("label_char")).alias("raw"), lookalike.plain_column(spark, F.col("label_char"), literal=True).alias("form"))
    b = b.select(F.lit("b").alias("corpus"), "rec_id", *more, F.col("translation").alias("raw"), lookalike.plain_column(spark, F.col("translation")).alias("form"))
    return a.unionByName(b)


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forms(spark, sf_dir).select("corpus", "rec_id", "form")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.lookalike_pairs(forms(spark, sf_dir))


UNITS = {"a": "char", "b": "word"}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.cross_split_pairs(forms(spark, sf_dir, "split", "source"), UNITS).select("corpus", "rec_a", "rec_b")


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_report(forms(spark, sf_dir, "split", "source"), UNITS)


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_records(forms(spark, sf_dir, "split", "source"), UNITS)


def p4_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.contained_records(forms(spark, sf_dir, "split", "source"), UNITS)


def limits(spark: SparkSession, sf_dir: str, kind: str) -> list:
    """The rows of token_limits of one kind; the table is fixed at four rows."""
    return sorted(r for r in table(spark, sf_dir, "token_limits").collect() if r.limit_name.startswith(kind))


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(*columns))


def p5_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _documents(spark, sf_dir, "doc_id", "text").select("doc_id", tokens.count_column(F.col("text"), tokens.vocabulary(spark)).alias("n_tokens"))
    counted = materialize(counted, "tokens")
    parts = [packing.pack(counted, "doc_id", "n_tokens", r.max_tokens).select(F.lit(r.limit_name).alias("limit_name"), "*") for r in limits(spark, sf_dir, "container")]
    return reduce(DataFrame.unionByName, parts)


def p5_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = materialize(p5_containers(spark, sf_dir), "packed")
    parts = [packing.fill_report(packed.where(F.col("limit_name") == r.limit_name), "n_tokens", r.max_tokens).select(F.lit(r.limit_name).alias("limit_name"), "*") for r in limits(spark, sf_dir, "container")]
    return reduce(DataFrame.unionByName, parts)


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = mixing.Targets.of(table(spark, sf_dir, "mix_targets").select("source", "target_share", "max_repeats").collect())
    return mixing.mix_sources(_documents(spark, sf_dir, "doc_id", "source", "text"), "doc_id", "source", "text", targets, tokens.vocabulary(spark))


def p6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir).drop("posterior")


def p6_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.share_report(materialize(_mix(spark, sf_dir), "mix"), "source", table(spark, sf_dir, "mix_targets"))


def _pieces(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    parts = [
        chunking.split_oversized(docs, "doc_id", "text", r.max_tokens, r.overlap_tokens, tokens.vocabulary(spark)).select(F.lit(r.limit_name).alias("limit_name"), "*")
        for r in limits(spark, sf_dir, "piece")
        if r.limit_name == kind or not kind
    ]
    return reduce(DataFrame.unionByName, parts)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, "piece").where("piece = 1").select("doc_id")


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir, "")


def p5_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: the documents placed, containers over it, texts cut that fit, and whether nine tenths of the room are used."""
    packed = materialize(p5_containers(spark, sf_dir), "packed")
    capacity = table(spark, sf_dir, "token_limits").select("limit_name", F.col("max_tokens").cast("bigint").alias("room"))
    boxes = packed.where("container is not null").groupBy("limit_name", "container").agg(F.sum("n_tokens").alias("used")).join(capacity, "limit_name")
    boxes = boxes.groupBy("limit_name").agg(F.sum((F.col("used") > F.col("room")).cast("bigint")).alias("overfull"), (F.sum("used") >= 0.9 * F.sum("room")).alias("full"))
    texts = packed.groupBy("limit_name", "doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens")).join(capacity, "limit_name")
    texts = texts.groupBy("limit_name").agg(F.count("*").alias("documents"), F.sum(((F.col("pieces") > 1) & (F.col("tokens") <= F.col("room"))).cast("bigint")).alias("cut"))
    return texts.join(boxes, "limit_name").select("limit_name", "documents", "overfull", "cut", "full")


def p6_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per listed source: documents used that are not its own, used too often, and whether more tokens came out than wanted."""
    mixed = materialize(_mix(spark, sf_dir), "mix")
    targets = table(spark, sf_dir, "mix_targets").select("source", "max_repeats")
    own = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(1).alias("own"))
    joined = mixed.join(own, ["doc_id", "source"], "left").join(F.broadcast(targets), "source")
    n = lambda c: F.sum(c.cast("bigint"))
    per = joined.groupBy("source").agg(n(F.col("own").isNull()).alias("foreign"), n(F.col("copies") > F.col("max_repeats")).alias("repeated"), (F.sum(F.col("n_tokens") * F.col("copies")) > F.max("wanted")).alias("over"))
    zero = {"foreign": F.coalesce("foreign", F.lit(0)), "repeated": F.coalesce("repeated", F.lit(0)), "over": F.coalesce("over", F.lit(False))}
    return targets.select("source").join(per, "source", "left").withColumns(zero)


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per size and document: a digest of the text put together again from its pieces, whether all are within the size, and whether each shares text with the one before."""
    pieces = materialize(p7_pieces(spark, sf_dir), "pieces")
    sizes = F.explode(F.array(*[F.struct(F.lit(r.limit_name).alias("limit_name"), F.lit(r.max_tokens).alias("max_tokens")) for r in limits(spark, sf_dir, "piece")]))
    rows = F.array_sort(F.collect_list(F.struct("piece", "first_char", "n_chars", "n_tokens", "text")))
    per = pieces.groupBy("limit_name", "doc_id").agg(rows.alias("p"))
    end = lambda x: x["first_char"] + x["n_chars"]
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("end"), F.lit(True).alias("shared"))
    whole = F.aggregate("p", start, lambda s, x: F.struct(F.concat(s["text"], x["text"].substr(s["end"] - x["first_char"] + 1, x["n_chars"])).alias("text"), end(x).alias("end"), (s["shared"] & ((x["piece"] == 0) | (x["first_char"] < s["end"]))).alias("shared")))
    cut = per.select("limit_name", "doc_id", whole.alias("w"), F.array_max(F.transform("p", lambda x: x["n_tokens"])).alias("largest"))
    every = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", sizes.alias("size")).select("doc_id", "text", "size.*")
    joined = every.join(cut, ["limit_name", "doc_id"], "left")
    return joined.select("limit_name", "doc_id", F.md5(F.coalesce("w.text", "text")).alias("digest"), (F.coalesce("largest", F.lit(0)) <= F.col("max_tokens")).alias("within"), F.coalesce("w.shared", F.lit(True)).alias("shared"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_terms, p2_found, p2_forms, p4_found, p4_records, p4_report, p4_contained, p5_containers, p5_fill, p5_checked, p6_mix, p6_shares, p6_checked, p7_found, p7_pieces, p7_checked,
    )
}
