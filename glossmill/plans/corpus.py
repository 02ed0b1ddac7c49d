"""Queries over the corpora's tables: literals, splits, vocabularies, lookups, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.operators import relations, vocab
from glossmill.operators.packed import values_column
from glossmill.plans.packed import items_sql
from glossmill.session import scratch, spread, table
from glossmill.sources import delimited, frames

#: Tags of content words in label_postag.
CONTENT_TAGS = ("n", "ns", "nx", "m", "d", "r", "a", "v", "t")


def literal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "corpus_a")
    entries = text.list_literal(F.col("label_char"))
    return a.select("rec_id", F.array_join(entries, "").alias("sentence"), F.size(entries).alias("n_signs"))


def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "corpus_b").where(F.col("split") == "dev").select("rec_id", "name", "split")


def split_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "corpus_b").where(F.col("split").isin("train", "test")).groupBy("split", "source").agg(F.count("*").alias("n"))


def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, s = table(spark, sf_dir, "corpus_a"), table(spark, sf_dir, "splits")
    return relations.assigned(a.select("rec_id", "name", "split"), "name", s, F.col("line_no"), ["train", "dev", "test"]).select("rec_id", "name", "split")


def split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "corpus_b")
    parts = [b.where(F.col("split") == s).select("rec_id", "split") for s in ("train", "dev", "test")]
    return relations.bag_union(*parts).groupBy("split").agg(F.count("*").alias("n"), F.sum("rec_id").alias("ids"))


def sample_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all splits, and of none, as JSON records, the glosses with them."""
    b = table(spark, sf_dir, "corpus_b")
    return b.select("rec_id", F.to_json(F.struct("rec_id", F.col("translation").alias("sentence"), F.col("name").alias("file_name"))).alias("sample"), F.size(text.split_blanks(F.col("orth"))).alias("n_glosses"))


def last_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per clip, the last delivered."""
    a = table(spark, sf_dir, "corpus_a").select("name", "rec_id", "source")
    return vocab.keep_last(a, "name", F.col("rec_id"))


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "dict_sentence").where("lemmas is not null").withColumn("lemmas", F.filter("lemmas", lambda x: x.isNotNull() & (F.trim(x) != "")))
    return vocab.keep_last(d.select("sentence", "lemmas"), "sentence", F.array_join("lemmas", "|"))


def vocab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.occurrences(table(spark, sf_dir, "dict_sentence"), "lemmas")


def vocab_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.dense_ids(table(spark, sf_dir, "dict_sentence").select(F.explode("lemmas").alias("lemma")), "lemma")


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "dict_sentence")
    return vocab.frequency_ratio(vocab.occurrences(d, "lemmas"), max(1, d.select("sentence").distinct().count()))


def freq_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select("lemma", "n", F.round("ratio", 6).alias("ratio"))


def sentence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "corpus_b").select("rec_id", F.col("translation").alias("sentence"))
    with_lemmas = b.join(_dictionary(spark, sf_dir), "sentence", "left").withColumn("lemmas", F.coalesce("lemmas", F.array().cast("array<string>")))
    ids = table(spark, sf_dir, "dict_lem_to_id").select("lemma", "id")
    return vocab.lookup_ids(with_lemmas, "rec_id", "lemmas", ids, _kept(spark, sf_dir)).select("rec_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.lookup_misses(table(spark, sf_dir, "dict_sentence"), "lemmas", table(spark, sf_dir, "dict_lem_to_id"))


def pos_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = spread(table(spark, sf_dir, "corpus_a").where("label_word is not null and label_postag is not null").select("rec_id", "label_word", "label_postag"))
    both = a.select("rec_id", values_column(F.col("label_word")).alias("w"), values_column(F.col("label_postag")).alias("t"))
    kept = vocab.content_words(F.when((F.size("w") > 0) & (F.size("t") > 0), vocab.tagged(F.col("w"), F.col("t"))).otherwise(F.array().cast("array<struct<text:string,pos:string>>")), CONTENT_TAGS)
    return both.select("rec_id", F.array_join(kept, " ").alias("words"))


def decoded_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacement tokens turned back by the inverted map, in its order."""
    pairs = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")]
    b = table(spark, sf_dir, "corpus_b")
    encoded = text.replace_in_order(F.col("translation"), pairs)
    return b.select("rec_id", encoded.alias("encoded"), text.replace_in_order(encoded, [(new, old) for old, new in pairs]).alias("decoded"))


def inverted_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal values in each row's map of split to source, the last key wins."""
    b = table(spark, sf_dir, "corpus_b").where("source is not null and split is not null")
    m = F.create_map(F.lit("a"), F.col("source"), F.lit("b"), F.col("split"), F.lit("c"), F.col("source"))
    return b.select("rec_id", F.element_at(text.inverted(m), F.col("source")).alias("key_of_source"))


def to_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips whose frames are not in the store yet."""
    a, f = table(spark, sf_dir, "corpus_a"), table(spark, sf_dir, "frame_meta")
    return relations.not_yet_in(a.select("name").distinct(), "name", f, "video_id")


def frame_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the number of their frames; of repeated rows the greatest, null where unknown."""
    f = table(spark, sf_dir, "frame_meta").groupBy(F.col("video_id").alias("name")).agg(F.max("num_frames").alias("num_frames"))
    return table(spark, sf_dir, "corpus_a").select("rec_id", "name").join(f, "name", "left")


def frame_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected frames per video, from a store of stand-in frames written for it."""
    f = table(spark, sf_dir, "frame_meta").where("num_frames > 0").groupBy("video_id").agg(F.max("num_frames").alias("n"))
    stand_in = f.select("video_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("frame_no"))
    stand_in = stand_in.withColumn("jpeg", F.to_binary(F.concat_ws("#", "video_id", F.col("frame_no").cast("string")), F.lit("utf-8")))
    at = scratch(spark, "store")
    frames.write_store(stand_in, at)
    wanted = f.select("video_id", F.sequence(F.lit(0), F.col("n") + 3, F.lit(7)).alias("ordinals"))
    got = frames.select_frames(spark.read.parquet(f"{at}/frames"), wanted)
    return got.groupBy("video_id").agg(F.count("*").alias("n"), F.sum("frame_no").cast("bigint").alias("ordinals"), F.max(F.decode("jpeg", "utf-8")).alias("last"))


def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus_b written as pipe-separated files and read back."""
    at = scratch(spark, "delimited")
    delimited.write_delimited(table(spark, sf_dir, "corpus_b").select("name", "translation", "orth"), at, "|")
    back = delimited.read_delimited(spark, at, delimited.CORPUS_B, "|")
    return back.groupBy("name").agg(F.count("*").alias("n"), F.max("translation").alias("translation"), F.max("orth").alias("orth"))


def dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dict_lem_to_id written as JSON maps, one for about 100,000 entries, and read back."""
    at = scratch(spark, "dictionary")
    d = table(spark, sf_dir, "dict_lem_to_id").where("lemma is not null")
    delimited.write_dictionary(d, "lemma", "id", at)
    return delimited.read_dictionary(spark, at, "gloss", "gloss_id")


def origin_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the language carried on from the last document of their source that names one."""
    d = table(spark, sf_dir, "documents").where("source is not null")
    marker = F.when(F.col("lang").isNotNull(), F.struct(F.col("lang").alias("origin"), F.col("kind").alias("tag")))
    return relations.carried_subset(d.select("doc_id", "source", "lang", "kind"), "source", ["doc_id"], marker, "non-de", "^(note|run|annotation|dialogue)").select("doc_id", "source")


def segment_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts wrapped in segment markup and taken out again, with an attribute of it."""
    b = table(spark, sf_dir, "corpus_b").where("translation is not null")
    line = F.concat(F.lit('<seg id="'), F.col("rec_id").cast("string"), F.lit('">  '), F.col("translation"), F.lit(" </seg>"))
    return b.select("rec_id", text.segment_text(line).alias("plain"), text.attribute(line, "id").alias("seg"))


def separated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of every line of each text, numbered from 0; a last line break starts no line, and null and empty texts have none."""
    d = spread(table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", "text"))
    lines = F.split(F.regexp_replace("text", r"\n\z", ""), "\n", -1)
    each = d.select("doc_id", F.posexplode(lines).alias("line_no", "line"))
    return each.select("doc_id", "line_no", text.separated_field(F.col("line"), 0).alias("f0"), text.separated_field(F.col("line"), 1).alias("f1"))


def tab_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus_a written as one folder of tab-separated files per split and read back from all of them at once."""
    a = table(spark, sf_dir, "corpus_a").select("name", "split", "label_gloss", "label_char", "label_word", "label_postag")
    at = scratch(spark, "tab")
    parts = {"train": F.col("split") == "train", "held": F.col("split").isin("dev", "test"), "none": F.coalesce(~F.col("split").isin("train", "dev", "test"), F.lit(True))}
    for name, of in parts.items():
        delimited.write_delimited(a.where(of), f"{at}/{name}", "\t")
    back = delimited.read_delimited(spark, [f"{at}/{name}" for name in parts], delimited.CORPUS_A, "\t")
    return back.groupBy("name", "split").agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in a.columns[2:]])


def gloss_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each record's glosses by a lookup that must not miss."""
    b = spread(table(spark, sf_dir, "corpus_b").where("orth is not null").select("rec_id", "orth")).select("rec_id", values_column(F.col("orth")).alias("glosses"))
    each = b.select("rec_id", F.posexplode("glosses").alias("i", "gloss"))
    ids = vocab.checked(each.join(vocab.dense_ids(each, "gloss"), "gloss", "left"), "id", "id of a gloss")
    return ids.groupBy("rec_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda x: x["id"]).cast("array<string>"), " ").alias("ids"))


#: Ids of padding and of the end of a sentence in the vocabulary of characters.
SPECIAL = (1, 2)


def decoded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences from the ids of their characters, as a model gives them: with an end mark and padding, which are left out."""
    b = table(spark, sf_dir, "corpus_b").select("rec_id", "translation")
    chars = b.select("rec_id", F.transform(text.characters(F.col("translation")), lambda c: F.ascii(c)).alias("ids"))
    pieces = b.select(F.explode(F.array_distinct(text.characters(F.col("translation")))).alias("piece")).distinct().select(F.ascii("piece").alias("id"), "piece")
    pieces = pieces.unionByName(spark.createDataFrame([(SPECIAL[0], "<pad>"), (SPECIAL[1], "</s>")], "id int, piece string"))
    given = chars.withColumn("ids", F.concat("ids", F.array(F.lit(SPECIAL[1])), F.array_repeat(F.lit(SPECIAL[0]), (F.col("rec_id") % 4).cast("int"))))
    return vocab.decoded(given, "rec_id", "ids", pieces, SPECIAL)


def pseudo_gloss_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas that a lexicon gives the words of each sentence, in lower case: their counts, and ids of those that are not too common.

    The lexicon stands in for a tagger: the lemmas of dict_lem_to_id, every third of which is no content word.
    """
    d = table(spark, sf_dir, "dict_lem_to_id").where("lemma is not null").select(F.lower(F.trim("lemma")).alias("word"), "id")
    lexicon = d.groupBy("word").agg(F.max("id").alias("id")).select("word", F.initcap("word").alias("lemma"), F.when(F.col("id") % 3 == 0, "ADP").otherwise("NOUN").alias("pos"))
    b = table(spark, sf_dir, "corpus_b").where("translation is not null").select("rec_id", "translation", text.words(F.lower("translation")).alias("w"))
    tagged = b.select("rec_id", "translation").join(vocab.lexicon_tags(b, "rec_id", "w", lexicon), "rec_id")
    _, counts, ids = vocab.pseudo_glosses(tagged, "translation", F.col("tokens"), scratch(spark, "pseudo"))
    return counts.join(ids, "lemma", "left")


QUERIES = {
    f.__name__: f
    for f in (
        literal_join, split_filter, split_membership, split_join, split_union, sample_projection, last_delivery, vocab_counts, vocab_ids, freq_filter, sentence_ids, lookup_misses, pos_filter,
        decoded_replacements, inverted_map, to_extract, frame_details, frame_select, delimited_round_trip, dictionary_file, origin_subset, segment_markup, separated_fields, tab_files, gloss_ids, decoded_ids, pseudo_gloss_tables,
    )
}

_LITERAL = r"regexp_extract_all(label_char, '''((?:[^''\\]|\\.)*)''', 1)"
_IS_LIST = "label_char IS NOT NULL AND trim(label_char) <> ''"
_ITEMS = items_sql([("corpus_a", "label_word"), ("corpus_a", "label_postag")])
_KEPT = """counts AS (SELECT lemma, count(*) AS n FROM (SELECT unnest(lemmas) AS lemma FROM dict_sentence) WHERE lemma IS NOT NULL GROUP BY lemma),
kept AS (SELECT lemma, n, n::DOUBLE / (SELECT count(DISTINCT sentence) FROM dict_sentence) AS ratio FROM counts)"""
_TAGS = ", ".join(f"'{t}'" for t in CONTENT_TAGS)

ORACLES = {
    "sample_projection": """SELECT rec_id, CASE WHEN translation IS NULL THEN to_json({'rec_id': rec_id, 'file_name': name}) ELSE to_json({'rec_id': rec_id, 'sentence': translation, 'file_name': name}) END::VARCHAR AS sample,
        len(string_split(orth, ' '))::INT AS n_glosses FROM corpus_b""",
    "literal_join": f"SELECT rec_id, CASE WHEN {_IS_LIST} THEN array_to_string({_LITERAL}, '') END AS sentence, CASE WHEN {_IS_LIST} THEN len({_LITERAL})::INT END AS n_signs FROM corpus_a",
    "split_filter": "SELECT rec_id, name, split FROM corpus_b WHERE split = 'dev'",
    "split_membership": "SELECT split, source, count(*) AS n FROM corpus_b WHERE split IN ('train', 'test') GROUP BY ALL",
    "split_join": """SELECT a.rec_id, a.name, s.split FROM corpus_a a JOIN (SELECT name, split FROM splits QUALIFY row_number() OVER (PARTITION BY name ORDER BY line_no DESC) = 1) s ON a.name = s.name
        WHERE s.split IN ('train', 'dev', 'test')""",
    "split_union": "SELECT split, count(*) AS n, sum(rec_id)::BIGINT AS ids FROM corpus_b WHERE split IN ('train', 'dev', 'test') GROUP BY split",
    "last_delivery": "SELECT name, rec_id, source FROM corpus_a QUALIFY row_number() OVER (PARTITION BY name ORDER BY rec_id DESC) = 1",
    "vocab_counts": "SELECT lemma, count(*) AS n FROM (SELECT unnest(lemmas) AS lemma FROM dict_sentence) WHERE lemma IS NOT NULL GROUP BY lemma",
    "vocab_ids": "SELECT lemma, (row_number() OVER (ORDER BY lemma) - 1)::INT AS id FROM (SELECT DISTINCT unnest(lemmas) AS lemma FROM dict_sentence) WHERE lemma IS NOT NULL",
    "freq_filter": f"WITH {_KEPT} SELECT lemma, n, round(ratio, 6) AS ratio FROM kept WHERE ratio < 0.4::DOUBLE",
    "sentence_ids": f"""WITH {_KEPT},
dict AS (SELECT sentence, list_filter(lemmas, lambda x: x IS NOT NULL AND trim(x) <> '') AS lemmas FROM dict_sentence WHERE lemmas IS NOT NULL),
one AS (SELECT sentence, arg_max(lemmas, array_to_string(lemmas, '|')) AS lemmas FROM dict GROUP BY sentence),
each AS (SELECT rec_id, unnest(range(len(lemmas))) AS i, unnest(lemmas) AS lemma FROM corpus_b b JOIN one ON b.translation = one.sentence),
found AS (SELECT rec_id, string_agg(d.id::VARCHAR, ' ' ORDER BY i) AS ids FROM each JOIN kept USING (lemma) JOIN dict_lem_to_id d USING (lemma) WHERE ratio < 0.4::DOUBLE GROUP BY rec_id)
SELECT b.rec_id, coalesce(ids, '') AS ids FROM corpus_b b LEFT JOIN found USING (rec_id)""",
    "lookup_misses": "SELECT lemma, count(*) AS n FROM (SELECT unnest(lemmas) AS lemma FROM dict_sentence) WHERE lemma IS NOT NULL AND lemma NOT IN (SELECT lemma FROM dict_lem_to_id WHERE lemma IS NOT NULL) GROUP BY lemma",
    "pos_filter": f"""{_ITEMS}, words AS (SELECT rec_id, items AS w FROM kept WHERE field = 'label_word'), tags AS (SELECT rec_id, items AS t FROM kept WHERE field = 'label_postag'),
both_ AS (SELECT rec_id, w, t, unnest(range(1, least(len(w), len(t)) + 1)) AS i FROM words JOIN tags USING (rec_id)),
picked AS (SELECT rec_id, string_agg(w[i], ' ' ORDER BY i) AS words FROM both_ WHERE t[i] IN ({_TAGS}) GROUP BY rec_id)
SELECT words.rec_id, coalesce(picked.words, '') AS words FROM words JOIN tags USING (rec_id) LEFT JOIN picked USING (rec_id)""",
    "decoded_replacements": """SELECT rec_id, e AS encoded, replace(replace(replace(replace(e, 'ae', 'ä'), 'oe', 'ö'), 'ue', 'ü'), 'ss', 'ß') AS decoded
        FROM (SELECT rec_id, replace(replace(replace(replace(translation, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss') AS e FROM corpus_b)""",
    "inverted_map": "SELECT rec_id, 'c' AS key_of_source FROM corpus_b WHERE source IS NOT NULL AND split IS NOT NULL",
    "to_extract": "SELECT DISTINCT name FROM corpus_a WHERE name NOT IN (SELECT video_id FROM frame_meta WHERE video_id IS NOT NULL)",
    "frame_details": "SELECT a.name, a.rec_id, f.n AS num_frames FROM corpus_a a LEFT JOIN (SELECT video_id, max(num_frames) AS n FROM frame_meta GROUP BY video_id) f ON a.name = f.video_id",
    "frame_select": """WITH f AS (SELECT video_id, max(num_frames) AS n FROM frame_meta WHERE num_frames > 0 GROUP BY video_id),
        s AS (SELECT video_id, unnest(range(0, n, 7)) AS i FROM f)
        SELECT video_id, count(*) AS n, sum(i)::BIGINT AS ordinals, max(video_id || '#' || i) AS "last" FROM s GROUP BY video_id""",
    "delimited_round_trip": "SELECT name, count(*) AS n, max(translation) AS translation, max(orth) AS orth FROM corpus_b GROUP BY name",
    "dictionary_file": "SELECT lemma AS gloss, id AS gloss_id FROM dict_lem_to_id WHERE lemma IS NOT NULL",
    "origin_subset": """WITH c AS (SELECT doc_id, source, last_value(CASE WHEN lang IS NOT NULL THEN {'origin': lang, 'tag': kind} END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS m FROM documents WHERE source IS NOT NULL)
        SELECT doc_id, source FROM c WHERE m IS NOT NULL AND m.origin <> 'de' AND regexp_matches(coalesce(m.tag, ''), '^(note|run|annotation|dialogue)')""",
    "segment_markup": "SELECT rec_id, trim(regexp_replace(translation, '[\\s\\p{Z}]+', ' ', 'g')) AS plain, rec_id::VARCHAR AS seg FROM corpus_b WHERE translation IS NOT NULL",
    "separated_fields": """WITH l AS (SELECT doc_id, string_split(CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS a FROM documents WHERE text <> ''),
        n AS (SELECT doc_id, unnest(range(len(a)))::INT AS line_no, unnest(a) AS line FROM l)
        SELECT doc_id, line_no, string_split(line, chr(9))[1] AS f0, string_split(line, chr(9))[2] AS f1 FROM n""",
    "tab_files": "SELECT name, split, count(*) AS n, max(label_gloss) AS label_gloss, max(label_char) AS label_char, max(label_word) AS label_word, max(label_postag) AS label_postag FROM corpus_a GROUP BY name, split",
    "gloss_ids": f"""{items_sql([("corpus_b", "orth")])}, each AS (SELECT rec_id, unnest(range(len(items))) AS i, unnest(items) AS gloss FROM kept),
        ids AS (SELECT gloss, row_number() OVER (ORDER BY gloss) - 1 AS id FROM (SELECT DISTINCT gloss FROM each))
        SELECT rec_id, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids FROM each JOIN ids USING (gloss) GROUP BY rec_id""",
    "decoded_ids": "SELECT rec_id, translation AS text FROM corpus_b",
    "pseudo_gloss_tables": """WITH lex AS (SELECT lower(trim(lemma)) AS word, max(id) AS id FROM dict_lem_to_id WHERE lemma IS NOT NULL GROUP BY 1),
        w AS (SELECT translation AS s, unnest(list_filter(regexp_split_to_array(lower(translation), '[\\s\\p{Z}]+'), lambda x: x <> '')) AS word FROM corpus_b WHERE translation IS NOT NULL),
        c AS (SELECT w.word AS lemma, count(*) AS n FROM w JOIN lex USING (word) WHERE lex.id % 3 <> 0 GROUP BY 1),
        sentences AS (SELECT count(DISTINCT translation) AS n FROM corpus_b WHERE regexp_matches(translation, '[^\\s\\p{Z}]'))
        SELECT c.lemma, c.n, i.id FROM c LEFT JOIN (SELECT lemma, (row_number() OVER (ORDER BY lemma) - 1)::INT AS id FROM c WHERE n::DOUBLE / (SELECT n FROM sentences) < 0.4::DOUBLE) i USING (lemma)""",
}
