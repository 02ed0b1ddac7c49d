"""Evaluation metrics over streams: the same sums as over tables, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators import bleu
from glossmill.session import scratch


def bleu_stream(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A streaming aggregation of BLEU over a stream of ``(hyp, refs)``, for complete or update mode."""
    return bleu.bleu(pairs, by)


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts and sums of ``value`` per window and key; rows later than ``late`` behind the newest are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def run_to_end(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Process all that the source holds now and return the result as a table; state is kept in the shared folder."""
    spark = stream.sparkSession
    at = scratch(spark, name)
    out, schema = f"{at}/out", stream.schema

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def read_table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream over the files of a table, a folder or a single file."""
    schema = spark.read.parquet(path).schema
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    return spark.readStream.schema(schema).parquet(path if folder else f"{path}*")
