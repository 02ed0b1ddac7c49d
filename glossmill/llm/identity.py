"""Pairs of records whose texts look the same but are different strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.session import materialize


def fingerprint(col: str | Column, name: str) -> list[Column]:
    """128 bits of a string as two columns; two strings that share them are taken as equal."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.xxhash64(c).alias(f"{name}1"), F.xxhash64(F.lit(0x5EED), c).alias(f"{name}2")]


def lookalike_pairs(forms: DataFrame) -> DataFrame:
    """``(corpus, rec_a, rec_b)``, ``rec_a < rec_b``, of ``forms (corpus, rec_id, raw, form)``.

    Rows with a null id, text or form or a blank form are no case; exact copies
    make no pair with each other, and repeated rows make a pair once. Only keys with two spellings at least leave the first
    aggregation, which combines copies before the shuffle; spellings are paired
    first and then joined to their records, so a group of many copies and few
    other spellings costs what its result has, never its square.
    """
    kept = forms.where("rec_id is not null and raw is not null and form is not null and form <> ''")
    rows = materialize(kept.select("corpus", "rec_id", *fingerprint("form", "k"), *fingerprint("raw", "v")), "forms")
    key = ["corpus", "k1", "k2"]
    several = rows.groupBy(*key).agg(F.min(F.struct("v1", "v2")).alias("lo"), F.max(F.struct("v1", "v2")).alias("hi")).where("lo <> hi").select(*key)
    members = rows.join(several, key, "left_semi").distinct()
    spellings = members.select(*key, "v1", "v2").distinct()
    x, y = spellings.alias("x"), spellings.alias("y")
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in key]
    less = F.struct("x.v1", "x.v2") < F.struct("y.v1", "y.v2")
    pairs = x.join(y, [*same, less]).select(*[F.col(f"x.{k}").alias(k) for k in key], F.struct("x.v1", "x.v2").alias("vx"), F.struct("y.v1", "y.v2").alias("vy"))
    m = members.select(*key, F.struct("v1", "v2").alias("v"), "rec_id")
    first = pairs.join(m.withColumnsRenamed({"v": "vx", "rec_id": "rec_x"}), [*key, "vx"]).drop("vx")
    both = first.join(m.withColumnsRenamed({"v": "vy", "rec_id": "rec_y"}), [*key, "vy"])
    return both.where("rec_x <> rec_y").select("corpus", F.least("rec_x", "rec_y").alias("rec_a"), F.greatest("rec_x", "rec_y").alias("rec_b")).distinct()
