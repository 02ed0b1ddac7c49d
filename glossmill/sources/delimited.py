"""Delimited files and dictionaries, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas of the files of a corpus.
CORPUS_A = "name string, split string, label_gloss string, label_char string, label_word string, label_postag string"
CORPUS_B = "name string, translation string, orth string"
SPLITS = "name string, split string"


#: What stands for null in files written here; a string of these two characters is read back as null.
NULL = "\\N"
_EXACT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}


def read_delimited(spark: SparkSession, path: str | list[str], schema: str, sep: str, null: str = NULL) -> DataFrame:
    """One or several delimited files with a header. Fields may hold the separator, quotes and line ends if quoted; white space is kept."""
    return spark.read.schema(schema).options(**_EXACT, sep=sep, multiLine=True, nullValue=null).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str, mode: str = "error") -> None:
    """Delimited files with a header; every string is quoted, and null and empty differ."""
    df.write.mode(mode).options(**_EXACT, sep=sep, quoteAll=True, nullValue=NULL).csv(path)


def read_dictionary(spark: SparkSession, path: str, key: str, value: str, value_type: str = "int") -> DataFrame:
    """``(<key>, <value>)`` of JSON files with a map each, over any number of lines, or with one map per line."""
    text = spark.read.text(path, wholetext=True).select(F.explode(F.split(F.trim("value"), r"(?<=\})\s*\n\s*(?=\{)")).alias("value"))
    return text.select(F.explode(F.from_json("value", f"map<string,{value_type}>")).alias(key, value))


#: Entries of one map, about.
ENTRIES = 100_000


def write_dictionary(df: DataFrame, key: str, value: str, path: str, entries: int = ENTRIES) -> None:
    """Text files whose lines are JSON maps of about ``entries`` entries each; of a repeated key the greatest value counts, null keys are left out."""
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
    maps = max(1, -(-one.count() // entries))
    per = one.groupBy(F.pmod(F.xxhash64(key), F.lit(maps)).alias("_map")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(key, value)))).alias("value"))
    per.select("value").write.text(path)


def read_vectors(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """``(word, vec array<double>)`` of text files with a word and its numbers on each line; a first line of two whole numbers, and lines without numbers, are left out."""
    parts = F.split(F.rtrim("value"), sep, -1)
    lines = spark.read.text(path).where(F.size(parts) > 2)
    return lines.select(parts[0].alias("word"), F.slice(parts, 2, F.size(parts)).cast("array<double>").alias("vec"))


def write_vectors(df: DataFrame, word: str, vec: str, path: str, sep: str = " ") -> None:
    df.select(F.concat_ws(sep, word, F.array_join(F.col(vec).cast("array<string>"), sep))).write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the lines of plain or compressed text files."""
    return spark.read.text(path)


def list_images(spark: SparkSession, path: str, pattern: str = "*.{jpg,png}") -> DataFrame:
    """``(path, length)`` of the image files of a folder in the order of their names; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length").orderBy("path")


def write_once(df: DataFrame, path: str) -> None:
    """Write a table unless it is there already."""
    df.write.mode("ignore").parquet(path)
