"""Experiment control: checkpoint selection, learning rates, metric logs."""

from __future__ import annotations

import math

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Fixed values of checkpoint names.
BEST_NAME, LATEST_NAME, SCORE_FLOOR = "_result_checkpoint_", "latest", -100.0


def parsed_checkpoints(df: DataFrame, path: str, extension: str = "pt") -> DataFrame:
    """``(path, epoch, score)`` from names like ``..._result_checkpoint_<epoch>_..._<score>.pt``; others are left out."""
    tail = F.regexp_extract(path, rf"{BEST_NAME}(.*)\.{extension}$", 1)
    return df.where(tail != "").select(F.col(path).alias("path"), F.regexp_extract(tail, r"^([^_]*)", 1).alias("epoch"), F.regexp_extract(tail, r"([^_]*)$", 1).try_cast("double").alias("score")).where("score is not null")


def best_checkpoint(df: DataFrame, path: str, extension: str = "pt") -> DataFrame:
    """The one row of the greatest score above the floor, the first path of equal ones; ``("", "0", 0)`` if there is none."""
    best = parsed_checkpoints(df, path, extension).where(F.col("score") > SCORE_FLOOR)
    top = best.groupBy().agg(F.min_by(F.struct("path", "epoch", "score"), F.struct(-F.col("score"), F.col("path"))).alias("b"))
    return top.select(F.coalesce("b.path", F.lit("")).alias("path"), F.coalesce("b.epoch", F.lit("0")).alias("epoch"), F.coalesce("b.score", F.lit(0.0)).alias("score"))


def latest_checkpoint(df: DataFrame, path: str, extension: str = "pt") -> DataFrame:
    """The one row of the greatest trailing number among the latest checkpoints, the last path of equal ones; null if there is none."""
    n = F.regexp_extract(path, rf"{LATEST_NAME}_checkpoint.*?(\d+)\.{extension}$", 1).try_cast("bigint")
    return df.select(F.col(path).alias("path"), n.alias("n")).where("n is not null").agg(F.max_by("path", F.struct("n", "path")).alias("path"), F.max("n").alias("n"))


def checkpoints_of_epoch(df: DataFrame, path: str, epoch: int) -> DataFrame:
    return df.where(F.regexp_extract(path, r"checkpoint_(\d+)", 1).try_cast("int") == epoch)


def cosine_lr(it: Column, start: float, end: float, cycle: int, start_mult: float = 1.0, end_mult: float = 1.0) -> Column:
    """Cosine from ``start`` to ``end`` in each cycle, the ends multiplied after each."""
    k, t = F.floor(it / cycle), (it % cycle) / cycle
    a, b = F.lit(start) * F.pow(F.lit(start_mult), k), F.lit(end) * F.pow(F.lit(end_mult), k)
    return a + (b - a) / 2 * (1 - F.cos(t * math.pi))


def warmup_cosine_lr(it: Column, lr: float, epoch_length: int, epochs: int, warmup_epochs: int = 5, scale: float = 0.01, cycles: int = 1, start_mult: float = 1.0, end_mult: float = 1.0) -> Column:
    """Linear from ``scale * lr`` to ``lr`` over the warm-up, then cosine cycles back."""
    warm = epoch_length * warmup_epochs
    cycle = math.ceil((epochs - warmup_epochs) * epoch_length / cycles)
    rise = F.lit(lr * scale) + F.lit(lr - lr * scale) * it / warm
    return F.when(it < warm, rise).otherwise(cosine_lr(it - warm, lr, lr * scale, cycle, start_mult, end_mult))


def multistep_lr(epoch: Column, lr: float, milestones: list[int], gamma: float = 0.1) -> Column:
    passed = sum(((epoch >= m).cast("int") for m in milestones[1:]), (epoch >= milestones[0]).cast("int"))
    return F.lit(lr) * F.pow(F.lit(gamma), passed)


def plateau_lr(metrics: Column, lr: float, mode: str = "min", factor: float = 0.1, patience: int = 10, threshold: float = 1e-4, relative: bool = True, cooldown: int = 0, min_lr: float = 0.0) -> Column:
    """The rate after each entry of an ordered array of metric values.

    A value is better if it passes the best one by the threshold. After more
    than ``patience`` epochs without, the rate is multiplied by ``factor`` and
    bad epochs do not count for ``cooldown`` ones.
    """
    sign = 1.0 if mode == "max" else -1.0
    start = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("bad"), F.lit(0).alias("cool"), F.lit(float(lr)).alias("lr"), F.array().cast("array<double>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        x = x.cast("double")
        bound = s["best"] * (1 + sign * threshold) if relative else s["best"] + sign * threshold
        better = s["best"].isNull() | (x > bound if mode == "max" else x < bound)
        cooling = s["cool"] > 0
        bad = F.when(better | cooling, 0).otherwise(s["bad"] + 1)
        cut = bad > patience
        rate = F.when(cut, F.greatest(s["lr"] * factor, F.lit(float(min_lr)))).otherwise(s["lr"])
        cool = F.when(cut, cooldown).when(cooling, s["cool"] - 1).otherwise(0)
        return F.struct(F.when(better, x).otherwise(s["best"]).alias("best"), F.when(cut, 0).otherwise(bad).alias("bad"), cool.alias("cool"), rate.alias("lr"), F.concat(s["out"], F.array(rate)).alias("out"))

    return F.aggregate(metrics, start, step, lambda s: s["out"])


def flattened_metrics(df: DataFrame, keys: list[str], metrics: str = "metrics") -> DataFrame:
    """``(keys, metric, value)`` of a map from name to a map from inner name to value; an empty inner name is a plain metric. Names with ``summary`` are left out."""
    outer = df.select(*keys, F.explode(metrics).alias("k", "inner")).where(~F.contains("k", F.lit("summary")))
    return outer.select(*keys, "k", F.explode("inner").alias("k2", "value")).select(*keys, F.when(F.col("k2") == "", F.col("k")).otherwise(F.concat_ws("_", "k", "k2")).alias("metric"), "value")


def mean_of_max(df: DataFrame, group: str, value: str) -> DataFrame:
    """The mean over the groups of their greatest value."""
    return df.groupBy(group).agg(F.max(value).alias("m")).agg(F.round(F.avg("m"), 6).alias("mean_of_max"))


def epoch_means(losses: DataFrame, epoch: str, named: list[str], prefix: str = "avg_") -> DataFrame:
    """``(<epoch>, name, mean, n)``: the mean of each named loss over the iterations of each epoch, and their number.

    Nulls do not count; a name without a value in an epoch has no row. The sums of
    an epoch are combined before the shuffle.
    """
    each = losses.select(epoch, F.explode(F.array(*[F.struct(F.lit(f"{prefix}{c}").alias("name"), F.col(c).cast("double").alias("value")) for c in named])).alias("l")).select(epoch, "l.*")
    return each.where("value is not null").groupBy(epoch, "name").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))


def learning_rate(name: str, it: Column, **params) -> Column | None:
    """A schedule by its name, as a column over the iteration (``step``: over the epoch; the plateau ones: over an array of metric values); None for ``none``."""
    known = {"cosine": cosine_lr, "warmupwithcosine": warmup_cosine_lr, "step": multistep_lr, "reduceonplateau": plateau_lr, "customreduceonplateau": plateau_lr}
    if name == "none":
        return None
    if name not in known:
        raise KeyError(f"{name} is no schedule; known: {', '.join(sorted([*known, 'none']))}")
    return known[name](it, **params)


def prune_checkpoints(spark: SparkSession, folder: str, extension: str = "pt") -> DataFrame:
    """``(path, kept)`` of the checkpoint files of a folder, of which all but the best and the latest are removed; other files stay."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files = spark.createDataFrame([(str(f.getPath()),) for f in fs.listStatus(p)], "path string")
    keep = {best_checkpoint(files, "path", extension).first()["path"], latest_checkpoint(files, "path", extension).first()["path"]}
    found = [r["path"] for r in parsed_checkpoints(files, "path", extension).select("path").union(files.where(F.col("path").rlike(rf"{LATEST_NAME}_checkpoint.*\d+\.{extension}$"))).distinct().collect()]
    for path in found:
        if path not in keep:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)
    return spark.createDataFrame([(x, x in keep) for x in sorted(found)], "path string, kept boolean")


class Events(StreamingQueryListener):
    """Functions to call when something happens; as a listener it also fires ``started``, ``progress`` and ``terminated`` of streams."""

    def __init__(self):
        self.handlers: dict[str, list[Callable]] = defaultdict(list)

    def add(self, event: str, handler: Callable, every: int = 1) -> None:
        """Call ``handler(state)`` at each ``every``-th ``event``."""
        self.handlers[event].append([handler, every, 0])

    def fire(self, event: str, state=None) -> None:
        for entry in self.handlers[event]:
            entry[2] += 1
            if entry[2] % entry[1] == 0:
                entry[0](state)

    def onQueryStarted(self, event) -> None:
        self.fire("started", event)

    def onQueryProgress(self, event) -> None:
        self.fire("progress", event)

    def onQueryTerminated(self, event) -> None:
        self.fire("terminated", event)


def bleu_line(scores: list[Column], precisions: list[Column], bp: Column, sys_len: Column, ref_len: Column) -> Column:
    """The scores, precisions, brevity penalty, length ratio and lengths of BLEU in one line."""
    joined = lambda cs, form: F.concat_ws("/", *[F.format_string(form, c) for c in cs])
    return F.format_string("BLEU = %s %s (BP = %.3f ratio = %.3f hyp_len = %d ref_len = %d)", joined(scores, "%.2f"), joined(precisions, "%.1f"), bp, sys_len / ref_len, sys_len, ref_len)


def score_line(name: str, score: Column, digits: int = 2) -> Column:
    return F.format_string(f"{name} = %.{digits}f", score)
