"""Queries of experiment control, over literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import math, text
from glossmill.operators import control
from glossmill.session import table

PATHS = [
    "run/m_result_checkpoint_3_bleu4_0.25.pt", "run/m_result_checkpoint_7_bleu4_0.31.pt", "run/n_result_checkpoint_9_bleu4_0.31.pt", "run/m_result_checkpoint_1_bleu4_-5.pt",
    "run/latest_checkpoint_120.pt", "run/latest_checkpoint_95.pt", "run/notes.pt", "run/m_result_checkpoint_8_bleu4_0.9.txt",
]
METRICS = [(1, {"loss": {"": 2.5}, "bleu": {"bleu1": 10.0, "bleu4": 1.5}, "summary_x": {"": 1.0}}), (2, {"loss": {"": 2.0}, "bleu": {"bleu1": 12.0, "bleu4": 2.5}})]


def _paths(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in PATHS], "path string")


def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.best_checkpoint(_paths(spark), "path")


def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.latest_checkpoint(_paths(spark), "path")


def epoch_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.checkpoints_of_epoch(_paths(spark), "path", 7)


def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    it = F.col("id")
    return spark.range(0, 2000).select(
        it.alias("it"),
        F.round(control.warmup_cosine_lr(it, 3e-4, 20, 100, 5, 0.01, 2, 0.7, 0.7) * 1e6, 5).alias("warm"),
        F.round(control.learning_rate("cosine", it, start=1e-3, end=1e-5, cycle=2000) * 1e6, 5).alias("cosine"),
        F.round(control.multistep_lr(F.floor(it / 20), 1e-3, [30, 60, 90]) * 1e6, 5).alias("steps"),
    )


def plateau_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate after each month of mean sentence lengths, which it treats as a loss."""
    b = table(spark, sf_dir, "corpus_b").where("translation is not null and recorded_at is not null")
    monthly = b.groupBy(F.date_format("recorded_at", "yyyy-MM").alias("m")).agg(F.round(F.avg(F.size(text.words(F.col("translation")))), 3).alias("v"))
    folded = monthly.agg(F.array_sort(F.collect_list(F.struct("m", "v"))).alias("rows")).withColumn("lr", control.plateau_lr(F.transform("rows", lambda r: r["v"]), 1.0, factor=0.5, patience=1))
    return folded.select(F.posexplode("rows").alias("i", "r"), "lr").select("r.m", "r.v", F.get("lr", F.col("i")).alias("lr"))


def metric_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.flattened_metrics(spark.createDataFrame(METRICS, "epoch int, metrics map<string, map<string, double>>"), ["epoch"])


def mean_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.mean_of_max(table(spark, sf_dir, "events"), "user_id", "value")


def signature_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "corpus_b").agg(F.count("*").alias("n"))
    return n.select(text.signature({"tok": "13a", "smooth": "exp", "case": "mixed", "numrefs": "1"}).alias("signature"), control.score_line("rows", F.col("n").cast("double")).alias("line"), math.floored_log(F.lit(0.0)).alias("log0"))


def epoch_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of two named losses over the iterations of each epoch; events stand in for iterations and days for epochs."""
    e = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("epoch"), F.col("value").alias("loss"), F.when(F.col("event_type") != "error", F.col("value") / 2).alias("loss_ce"))
    return control.epoch_means(e, "epoch", ["loss", "loss_ce"]).withColumn("mean", F.round("mean", 6))


QUERIES = {f.__name__: f for f in (best_checkpoint, latest_checkpoint, epoch_checkpoint, lr_schedule, plateau_schedule, metric_flatten, mean_of_max, epoch_means, signature_line)}

_VALUES = ", ".join(f"('{p}')" for p in PATHS)
_COS = "{a} + ({b} - {a}) / 2 * (1 - cos({t} * pi()))"

ORACLES = {
    "best_checkpoint": f"""WITH p AS (SELECT path, regexp_extract(path, '_result_checkpoint_(.*)\\.pt$', 1) AS tail FROM (VALUES {_VALUES}) t(path))
        SELECT path, split_part(tail, '_', 1) AS epoch, split_part(tail, '_', -1)::DOUBLE AS score FROM p WHERE tail <> '' ORDER BY score DESC, path LIMIT 1""",
    "latest_checkpoint": f"""SELECT path, regexp_extract(path, '(\\d+)\\.pt$', 1)::BIGINT AS n FROM (VALUES {_VALUES}) t(path) WHERE path LIKE '%latest_checkpoint%' ORDER BY n DESC, path DESC LIMIT 1""",
    "epoch_checkpoint": f"SELECT path FROM (VALUES {_VALUES}) t(path) WHERE regexp_extract(path, 'checkpoint_(\\d+)', 1) = '7'",
    "lr_schedule": f"""WITH i AS (SELECT range AS it, range - 100 AS w, (range - 100) // 950 AS k FROM range(2000))
        SELECT it, round(1e6 * CASE WHEN it < 100 THEN 3e-6 + 2.97e-4 * it / 100 ELSE {_COS.format(a="(3e-4 * pow(0.7::DOUBLE, k))", b="(3e-6 * pow(0.7::DOUBLE, k))", t="((w % 950) / 950::DOUBLE)")} END, 5) AS warm,
        round(1e6 * ({_COS.format(a="1e-3", b="1e-5", t="(it / 2000::DOUBLE)")}), 5) AS cosine,
        round(1e6 * 1e-3 * pow(0.1::DOUBLE, (it // 20 >= 30)::INT + (it // 20 >= 60)::INT + (it // 20 >= 90)::INT), 5) AS steps FROM i""",
    "plateau_schedule": """WITH RECURSIVE g AS (SELECT strftime(recorded_at, '%Y-%m') AS m, round(avg(len(list_filter(regexp_split_to_array(translation, '[\\s\\p{Z}]+'), lambda x: x <> ''))), 3) AS v
          FROM corpus_b WHERE translation IS NOT NULL AND recorded_at IS NOT NULL GROUP BY 1),
        r AS (SELECT row_number() OVER (ORDER BY m) AS i, m, v FROM g),
        s AS (SELECT i, m, v, v AS best, 0 AS bad, 1.0::DOUBLE AS lr FROM r WHERE i = 1
          UNION ALL SELECT r.i, r.m, r.v, CASE WHEN r.v < best * 0.9999::DOUBLE THEN r.v ELSE best END, CASE WHEN r.v < best * 0.9999::DOUBLE OR bad >= 1 THEN 0 ELSE bad + 1 END,
            CASE WHEN r.v >= best * 0.9999::DOUBLE AND bad >= 1 THEN lr * 0.5 ELSE lr END FROM s JOIN r ON r.i = s.i + 1)
        SELECT m, v, lr FROM s""",
    "metric_flatten": "SELECT * FROM (VALUES (1, 'loss', 2.5::DOUBLE), (1, 'bleu_bleu1', 10.0), (1, 'bleu_bleu4', 1.5), (2, 'loss', 2.0), (2, 'bleu_bleu1', 12.0), (2, 'bleu_bleu4', 2.5)) t(epoch, metric, value)",
    "epoch_means": """SELECT epoch, name, round(avg(v), 6) AS mean, count(*) AS n FROM (SELECT strftime(ts, '%Y-%m-%d') AS epoch, unnest(['avg_loss', 'avg_loss_ce']) AS name, unnest([value, CASE WHEN event_type <> 'error' THEN value / 2 END]) AS v FROM events)
        WHERE v IS NOT NULL GROUP BY ALL""",
    "mean_of_max": "SELECT round(avg(m), 6) AS mean_of_max FROM (SELECT max(value) AS m FROM events GROUP BY user_id)",
    "signature_line": "SELECT 'case.mixed+numrefs.1+smooth.exp+tok.13a' AS signature, 'rows = ' || count(*) || '.00' AS line, -9999999999.0::DOUBLE AS log0 FROM corpus_b",
}
