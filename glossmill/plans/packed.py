"""Queries over fields that hold several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators.packed import learn_dictionary, split_packed, values_column
from glossmill.session import spread, table

FIELDS_A = ("label_gloss", "label_word", "label_postag")
#: Separators that the joined fields get in turn.
BETWEEN = (" | ", " ； ", "\t/ ", " \u00a6 ")


def _dictionary(spark: SparkSession, sf_dir: str, unquoted: bool) -> list:
    return learn_dictionary([(table(spark, sf_dir, "corpus_a"), FIELDS_A), (table(spark, sf_dir, "corpus_b"), ["orth"])], unquoted)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "corpus_a"), table(spark, sf_dir, "corpus_b")
    known = _dictionary(spark, sf_dir, unquoted=False)
    return split_packed(spread(a.select("rec_id", *FIELDS_A)), "rec_id", FIELDS_A, known).unionByName(split_packed(spread(b.select("rec_id", "orth")), "rec_id", ["orth"], known))


def p3_guided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of each field joined again without any quotes, between separators that change with the record, and cut by the dictionary alone.

    Only the known values tell which separators and quotes belong to a value.
    """
    a, b = spread(table(spark, sf_dir, "corpus_a").select("rec_id", *FIELDS_A)), spread(table(spark, sf_dir, "corpus_b").select("rec_id", "orth"))
    known = _dictionary(spark, sf_dir, unquoted=True)
    between = F.element_at(F.array(*map(F.lit, BETWEEN)), (F.col("rec_id") % len(BETWEEN)).cast("int") + 1)
    bare = lambda df, fields: df.select("rec_id", *[F.call_function("array_join", values_column(F.col(f)), between).alias(f) for f in fields])
    return split_packed(bare(a, FIELDS_A), "rec_id", FIELDS_A, known).unionByName(split_packed(bare(b, ["orth"]), "rec_id", ["orth"], known))


QUERIES = {"p3_found": p3_found, "p3_guided": p3_guided}

_VALUE = r"""[\p{L}\p{M}\p{Nd}⁰¹²³⁴⁵⁶⁷⁸⁹\-+:.()。？！]+"""
_TOKENS = rf"""{_VALUE}|"(?:[^"\\]|\\.|"")*"|''(?:[^''\\]|\\.|'''')*''"""



def items_sql(fields: list[tuple[str, str]]) -> str:
    """CTEs up to ``kept (field, rec_id, items)`` for pairs of table and column."""
    raw = " UNION ALL ".join(f"SELECT '{c}' AS field, rec_id, {c} AS v FROM {t}" for t, c in fields)
    return f"""
WITH raw AS ({raw}), bare AS (
  SELECT field, rec_id, CASE WHEN regexp_matches(trim(v), '^\\[.*\\]$', 's') OR regexp_matches(trim(v), '^\\(["''].*["'']\\)$', 's')
    THEN substr(trim(v), 2, length(trim(v)) - 2) ELSE v END AS v
  FROM raw WHERE v IS NOT NULL
), tokens AS (
  SELECT field, rec_id, list_transform(regexp_extract_all(v, '{_TOKENS}', 0, 's'), lambda x:
    CASE WHEN x[1] = '"' THEN regexp_replace(replace(substr(x, 2, length(x) - 2), '""', '"'), '\\\\(.)', '\\1', 'gs')
         WHEN x[1] = '''' THEN regexp_replace(replace(substr(x, 2, length(x) - 2), '''''', ''''), '\\\\(.)', '\\1', 'gs')
         ELSE x END) AS items
  FROM bare
), kept AS (SELECT field, rec_id, list_filter(items, lambda x: trim(x) <> '') AS items FROM tokens)"""


_FIELDS = [*(("corpus_a", f) for f in FIELDS_A), ("corpus_b", "orth")]
_ROWS = " SELECT field, rec_id, CAST(unnest(range(len(items))) AS INTEGER) AS pos, unnest(items) AS item FROM "

ORACLES = {
    "p3_found": items_sql(_FIELDS) + _ROWS + "kept",
    # values of nothing but separators cannot be told from these once the quotes are gone
    "p3_guided": items_sql(_FIELDS) + _ROWS + f"(SELECT field, rec_id, list_filter(items, lambda x: regexp_matches(x, '{_VALUE}')) AS items FROM kept)",
}
