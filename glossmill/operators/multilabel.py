"""Multi-label evaluation and losses, as sums over (sample, class) cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5


def cells(scores: DataFrame, targets: DataFrame) -> DataFrame:
    """``(sample, class_id, score, y)`` for all scores; ``y`` is 1 where ``targets (sample, ids array<int>)`` holds the class.

    Repeated ids count once. A target without a score is no cell; a sample
    without targets has only zeros.
    """
    hits = targets.select("sample", F.explode(F.array_distinct("ids")).alias("class_id"), F.lit(1).alias("y"))
    return scores.join(hits.distinct(), ["sample", "class_id"], "left").withColumn("y", F.coalesce("y", F.lit(0)))


def _sums(threshold: float) -> list[Column]:
    hit, y = F.col("score") > threshold, F.col("y") == 1
    n = lambda c: F.sum(c.cast("int"))
    return [n(hit & y).alias("tp"), n(hit & ~y).alias("fp"), n(~hit & y).alias("fn")]


def counts(cell: DataFrame, by: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """True and false positives and false negatives per group; a score equal to the threshold is no hit."""
    return cell.groupBy(*(by or [])).agg(*_sums(threshold))


def f1() -> Column:
    """Null where there is nothing to find and nothing found."""
    return F.try_divide(F.col("tp"), F.col("tp") + 0.5 * (F.col("fp") + F.col("fn")))


def micro(cell: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(recall_micro, f1_micro)``; null without positives."""
    return counts(cell, threshold=threshold).select(F.round(F.try_divide("tp", F.col("tp") + F.col("fn")), 6).alias("recall_micro"), F.round(f1(), 6).alias("f1_micro"))


def macro(cell: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(recall_macro, f1_macro)``: means over the classes that have positives."""
    per = counts(cell, ["class_id"], threshold).where("tp + fn > 0")
    return per.agg(F.round(F.avg(F.col("tp") / (F.col("tp") + F.col("fn") + 1e-8)), 6).alias("recall_macro"), F.round(F.avg(f1()), 6).alias("f1_macro"))


def per_class(cell: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return counts(cell, ["class_id"], threshold).withColumn("f1", F.round(f1(), 6))


def bce_loss(cell: DataFrame, eps: float = 1e-8) -> DataFrame:
    """Mean binary cross-entropy, the scores held between ``eps`` and ``1 - eps``."""
    p = F.least(F.greatest("score", F.lit(eps)), F.lit(1 - eps))
    loss = F.when(F.col("y") == 1, -F.ln(p)).otherwise(-F.ln(1 - p))
    return cell.agg(F.round(F.avg(loss), 6).alias("bce"))


def ce_loss(logits: DataFrame, keys: list[str], smoothing: float = 0.1) -> DataFrame:
    """Mean cross-entropy with label smoothing over the valid positions of ``logits (keys, class_id, logit, target_id, valid)``.

    Of each position: ``(1 - e)`` times the target's negative log softmax plus
    ``e`` times the mean over all classes. The sums of a position are taken in
    one aggregation, shifted by its greatest logit.
    """
    at = logits.where("valid").groupBy(*keys)
    top = at.agg(F.max("logit").alias("top"))
    per = logits.where("valid").join(top, keys).groupBy(*keys).agg(
        F.ln(F.sum(F.exp(F.col("logit") - F.col("top")))).alias("lse"),
        F.avg(F.col("logit") - F.col("top")).alias("mean"),
        F.max(F.when(F.col("class_id") == F.col("target_id"), F.col("logit") - F.col("top"))).alias("hit"),
    )
    loss = F.col("lse") - (1 - smoothing) * F.col("hit") - smoothing * F.col("mean")
    return per.where("hit is not null").agg(F.round(F.avg(loss), 6).alias("ce"))


def mean_ce(positions: DataFrame, smoothing: float = 0.1) -> DataFrame:
    """The same loss from the sums of each position, ``(lse, mean, hit)``; positions without a target class are left out."""
    loss = F.col("lse") - (1 - smoothing) * F.col("hit") - smoothing * F.col("mean")
    return positions.where("hit is not null").agg(F.round(F.avg(loss), 6).alias("ce"))


def weighted_loss(losses: dict[str, Column], weights: dict[str, float]) -> Column:
    """Sum of the named losses by their weights; a name without weight counts once."""
    total = F.lit(0.0)
    for name, loss in losses.items():
        total = total + loss * weights.get(name, 1.0)
    return total


def arg_max(df: DataFrame, keys: list[str], value: str, score: str) -> DataFrame:
    """The value of the greatest score per key; of equal scores the least value."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(F.col(score), -F.col(value))).alias(value))
