"""Queries over hypothesis and reference pairs of the corpora.

Pairs are records of corpus_b: the glosses in lower case as the hypothesis, the
translation as the reference. The character-level pairs are records of
corpus_a: the words joined, against the signs joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.operators import bleu, chrf, control, relations, rouge
from glossmill.operators.packed import values_column
from glossmill.plans.packed import items_sql
from glossmill.session import spread, table
from glossmill.streaming import metrics

_NO_GLOSS = r"[^\p{L}\p{Nd}+:.\-]+"


def _glosses(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, _NO_GLOSS, " "))


def _corpus_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "corpus_b").select("rec_id", "split", "orth", "translation"))


def _both(df: DataFrame) -> DataFrame:
    return df.where("orth is not null and translation is not null")


def word_pairs(df: DataFrame, swapped: bool = False) -> DataFrame:
    hyp, ref = text.words(_glosses(F.col("orth"))), text.words(F.col("translation"))
    if swapped:
        hyp, ref = ref, hyp
    return _both(df).select("rec_id", "split", hyp.alias("hyp"), F.array(ref).alias("refs"))


def _pairs(spark: SparkSession, sf_dir: str, swapped: bool = False) -> DataFrame:
    return word_pairs(_corpus_b(spark, sf_dir), swapped)


def bleu_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bleu.bleu(_pairs(spark, sf_dir))


def bleu_corpus_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bleu.bleu(_pairs(spark, sf_dir, swapped=True))


def bleu_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bleu.bleu(_pairs(spark, sf_dir), ["split"])


def bleu_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = bleu.with_statistics(_pairs(spark, sf_dir))
    return p.select("rec_id", *[F.round(c, 6).alias(n) for n, c in bleu.scores().items()])


def bleu_multiref(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _both(_corpus_b(spark, sf_dir))
    bare = text.words(F.regexp_replace("translation", "[,.!]", " "))
    pairs = df.select("split", text.words(_glosses(F.col("orth"))).alias("hyp"), F.array(text.words(F.col("translation")), bare).alias("refs"))
    return bleu.bleu(pairs, ["split"])


def bleu_smooth_exp(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = bleu.with_statistics(_pairs(spark, sf_dir))
    return p.select("rec_id", *[F.round(c, 6).alias(n) for n, c in bleu.scores("exp").items()])


def bleu_smooth_addk(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = bleu.with_statistics(_pairs(spark, sf_dir))
    return p.select("rec_id", *[F.round(c, 6).alias(n) for n, c in bleu.scores("add-k", 1.0).items()])


def bleu_smooth_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bleu.bleu(_pairs(spark, sf_dir), ["split"], "floor", 0.1)


def bleu_tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus BLEU with the tokenizer and smoothing that are the usual defaults."""
    df = _both(_corpus_b(spark, sf_dir))
    pairs = df.select(text.words(text.tokenize_13a(_glosses(F.col("orth")))).alias("hyp"), F.array(text.words(text.tokenize_13a(F.col("translation")))).alias("refs"))
    return bleu.bleu(pairs, smooth="exp")


def bleu_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = spread(table(spark, sf_dir, "corpus_a").select("split", "label_word", "label_char").where("label_word is not null and label_char is not null"))
    joined = lambda c: text.characters(text.delete_spaces(F.array_join(values_column(F.col(c)), "")))
    return bleu.bleu(a.select("split", joined("label_word").alias("hyp"), F.array(joined("label_char")).alias("refs")), ["split"])


def bleu_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = metrics.read_table_stream(spark, f"{sf_dir}/corpus_b.parquet")
    return metrics.run_to_end(metrics.bleu_stream(word_pairs(stream), ["split"]), "bleu")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = metrics.read_table_stream(spark, f"{sf_dir}/events.parquet")
    counts = stream.groupBy(F.window("ts", "1 day").start.alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return metrics.run_to_end(counts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n", "total"), "events")


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _corpus_b(spark, sf_dir).select(text.words(F.col("translation")).alias("w"))
    n_of = lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(F.lit(n).alias("n"), F.array_join(F.slice("w", i, n), " ").alias("gram")))).otherwise(F.array())
    each = w.select(F.explode(F.concat(*[n_of(n) for n in (1, 2, 3, 4)])).alias("g"))
    return each.groupBy("g.n", "g.gram").agg(F.count("*").alias("cnt"))


def chrf_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _corpus_b(spark, sf_dir).withColumn("hyp", _glosses(F.col("orth")))
    return chrf.chrf(df, "hyp", "translation")


def chrf_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _corpus_b(spark, sf_dir).withColumn("hyp", _glosses(F.col("orth")))
    return chrf.with_statistics(df.select("rec_id", "hyp", "translation"), "hyp", "translation").select("rec_id", F.round(chrf.score(), 6).alias("chrf"))


def _rouge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _both(_corpus_b(spark, sf_dir))
    return df.select("rec_id", "split", _glosses(F.col("orth")).alias("hyp"), F.array("translation").alias("refs"))


def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rouge_pairs(spark, sf_dir).select("rec_id", F.round(rouge.rouge_l(F.col("hyp"), F.col("refs")), 6).alias("rouge"))


def rouge_multiref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the translation and against it without punctuation: the greatest precision and the greatest recall may come from different ones."""
    df = _both(_corpus_b(spark, sf_dir)).select("rec_id", _glosses(F.col("orth")).alias("hyp"), F.array("translation", F.regexp_replace("translation", "[,.!]", "")).alias("refs"))
    return df.select("rec_id", F.round(rouge.rouge_l(F.col("hyp"), F.col("refs")), 6).alias("rouge"))


def _predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hypotheses and references as two tables of the same order."""
    df = _both(_corpus_b(spark, sf_dir))
    return df.select("rec_id", text.words(_glosses(F.col("orth"))).alias("words")), df.select("rec_id", text.words(F.col("translation")).alias("words"))


def paired_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BLEU of a table of hypotheses against one of references, paired by their places; tables of different length are an error."""
    hyp, ref = _predictions(spark, sf_dir)
    return bleu.bleu(relations.paired(hyp, ref, ["rec_id"]).select(F.col("hyp_words").alias("hyp"), F.array("ref_words").alias("refs")))


def paired_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the two corpora paired by their places, as far as the shorter one goes."""
    a, b = table(spark, sf_dir, "corpus_a").select("rec_id"), table(spark, sf_dir, "corpus_b").select("rec_id")
    return relations.paired(a, b, ["rec_id"], strict=False)


def bleu_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score line of corpus BLEU."""
    sums = bleu.with_statistics(_pairs(spark, sf_dir)).agg(*[F.sum(c).alias(c) for c in bleu.COUNTS])
    s = bleu.scores()
    precisions = [100 * F.col(f"correct{n}") / F.col(f"total{n}") for n in range(1, bleu.ORDER + 1)]
    return sums.select(control.bleu_line([s[f"bleu{n}"] for n in range(1, bleu.ORDER + 1)], precisions, s["bp"], F.col("sys_len"), F.col("ref_len")).alias("line"))


def windowed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums of the events of each kind per hour, as a stream with a watermark."""
    stream = metrics.read_table_stream(spark, f"{sf_dir}/events.parquet")
    counts = metrics.windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    return metrics.run_to_end(counts.select(F.date_format("window.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 2).alias("total")), "windows")


def rouge_l_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rouge.mean_rouge_l(_rouge_pairs(spark, sf_dir), "hyp", "refs", ["split"])


def bag_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _both(_corpus_b(spark, sf_dir))
    return df.select("rec_id", relations.bag_overlap(text.words(_glosses(F.col("orth"))), text.words(F.col("translation"))).alias("common"))


def bag_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the dev sentences that the train sentences hold as often."""
    b = _corpus_b(spark, sf_dir)
    w = lambda split: b.where(F.col("split") == split).select(F.explode(text.words(F.col("translation"))).alias("word"))
    return relations.bag_intersection(w("dev"), w("train")).groupBy("word").agg(F.count("*").alias("n"))


def tokenize_13a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", text.tokenize_13a(F.col("text")).alias("tokens"))


def tokenize_intl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus_b(spark, sf_dir).select("rec_id", text.tokenize_intl(F.col("translation")).alias("tokens"))


def tokenize_zh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", text.tokenize_zh(F.col("text")).alias("tokens"))


def split_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = text.with_suffix(text.spaced_characters(text.joined_literal(F.col("label_char"))), " .")
    return table(spark, sf_dir, "corpus_a").select("rec_id", c.alias("spaced"))


QUERIES = {
    f.__name__: f
    for f in (
        bleu_corpus, bleu_corpus_swapped, bleu_by_split, bleu_sentence, bleu_multiref, bleu_smooth_exp, bleu_smooth_addk, bleu_smooth_floor, bleu_tokenized, bleu_chars,
        bleu_stream, events_stream, ngram_counts, chrf_corpus, chrf_sentence, rouge_l, rouge_multiref, rouge_l_mean, paired_bleu, paired_places, bleu_line, windowed_stream, bag_overlap, bag_intersection, tokenize_13a, tokenize_intl, tokenize_zh, split_characters,
    )
}

WORDS = "list_filter(regexp_split_to_array({}, '[\\s\\p{{Z}}]+'), lambda x: x <> '')"
GLOSSES = f"lower(regexp_replace(orth, '{_NO_GLOSS}', ' ', 'g'))"
_H, _R = WORDS.format(GLOSSES), WORDS.format("translation")
_WHERE = "FROM corpus_b WHERE orth IS NOT NULL AND translation IS NOT NULL"
_CHARS = "string_split(regexp_replace({}, '[\\s\\p{{Z}}]+', '', 'g'), '')"


def _each(c: str, *rules: tuple[str, str]) -> str:
    for pattern, to in rules:
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    return c


def _squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def _apart(c: str) -> str:
    """ASCII marks apart but for , - . and ', a period or comma apart unless between digits, a dash apart behind a digit."""
    return _each(c, (r"([!-&(-+:-@/\[-`{-~ ])", r" \1 "), (r"(\D)([.,])", r"\1 \2 "), (r"([.,])(\D)", r" \1 \2"), (r"(\d)-", r"\1 - "))


def _13a(c: str) -> str:
    c = f"replace(replace(replace({c}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    c = f"replace(replace(replace(replace({c}, '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
    return _squeeze(_apart(f"(' ' || {c} || ' ')"))


def _intl(c: str) -> str:
    return f"trim({_each(c, (r'(\P{Nd})(\p{P})', r'\1 \2 '), (r'(\p{P})(\P{Nd})', r' \1 \2'), (r'(\p{S})', r' \1 '))})"


def _zh(c: str) -> str:
    blocks = "⺀-⿟⿰-⿿\u3000-〿\u3100-ㄯㆠ-ㆿ㇀-\u31ef㈀-㏿㐀-䶵一-龻豈-鶴侮-頻並-龎\ufe10-\ufe1f︰-﹏\uff00-\uffef"
    odd = "\u2001-\u2a6d\u2f81-\u2fa1"  # also holds the signs of 2600-27BF
    return _squeeze(_apart(f"regexp_replace(trim({c}), '([{blocks}{odd}])', ' \\1 ', 'g')"))


def bleu_sql(pairs: str, by: str = "", smooth: str = "floor", value: float = 0.0, lengths: bool = True) -> str:
    """SQL of BLEU over ``pairs``: a query of ``seg, g, h VARCHAR[], refs VARCHAR[][]``."""
    add = {n: value if smooth == "add-k" and n > 2 else 0.0 for n in (1, 2, 3, 4)}
    sums = ", ".join(f"coalesce(sum(correct) FILTER (n = {n}), 0)::DOUBLE + {add[n]}::DOUBLE AS c{n}, coalesce(sum(total) FILTER (n = {n}), 0)::DOUBLE + {add[n]}::DOUBLE AS t{n}" for n in (1, 2, 3, 4))
    precisions = []
    for n in (1, 2, 3, 4):
        alive = " AND ".join(f"t{m} > 0" for m in range(1, n + 1))
        zeros = " + ".join(f"(c{m} = 0)::INT" for m in range(1, n + 1))
        missed = {"exp": f"100.0::DOUBLE / (pow(2.0::DOUBLE, {zeros}) * t{n})", "floor": f"100.0::DOUBLE * {value}::DOUBLE / t{n}"}.get(smooth, "0.0::DOUBLE")
        precisions.append(f"CASE WHEN {alive} THEN CASE WHEN c{n} = 0 THEN {missed} ELSE 100.0::DOUBLE * c{n} / t{n} END ELSE 0.0::DOUBLE END AS p{n}")
    out = []
    for n in (1, 2, 3, 4):
        ps = [f"p{m}" for m in range(1, n + 1)]
        logs = " + ".join(f"ln(CASE WHEN {p} > 0 THEN {p} ELSE 1 END)" for p in ps)
        out.append(f"round(CASE WHEN least({', '.join([*ps, ps[0]])}) = 0 THEN 0.0::DOUBLE ELSE bp * exp(({logs}) / {n}) END, 6) AS bleu{n}")
    grams = "unnest(list_transform(range(1, len({0}) - k.n + 2), lambda i: array_to_string({0}[i:i + k.n - 1], ' ')))"
    return f"""
WITH pairs AS ({pairs}),
hg AS (SELECT seg, n, gram, count(*) AS c FROM (SELECT seg, k.n AS n, {grams.format("h")} AS gram FROM pairs, (VALUES (1), (2), (3), (4)) k(n)) GROUP BY ALL),
rg AS (SELECT seg, n, gram, max(c) AS m FROM (SELECT seg, j, n, gram, count(*) AS c FROM
  (SELECT seg, j, k.n AS n, {grams.format("r")} AS gram FROM (SELECT seg, unnest(range(len(refs))) AS j, unnest(refs) AS r FROM pairs), (VALUES (1), (2), (3), (4)) k(n)) GROUP BY ALL) GROUP BY seg, n, gram),
st AS (SELECT seg, n, sum(least(c, coalesce(m, 0))) AS correct, sum(c) AS total FROM hg LEFT JOIN rg USING (seg, n, gram) GROUP BY seg, n),
sized AS (SELECT seg, g, len(h) AS sys_len, list_min(list_transform(refs, lambda r: abs(len(h) - len(r)) * 1000000 + len(r))) % 1000000 AS ref_len FROM pairs),
lens AS (SELECT g, sum(sys_len)::BIGINT AS sys_len, sum(ref_len)::BIGINT AS ref_len FROM sized GROUP BY g),
sums AS (SELECT g, {sums} FROM sized LEFT JOIN st USING (seg) GROUP BY g),
ps AS (SELECT sums.g, sys_len, ref_len, {", ".join(precisions)},
  CASE WHEN sys_len >= ref_len THEN 1.0::DOUBLE WHEN sys_len = 0 THEN 0.0::DOUBLE ELSE exp(1 - ref_len::DOUBLE / sys_len) END AS bp
  FROM sums JOIN lens ON sums.g IS NOT DISTINCT FROM lens.g)
SELECT {f"g AS {by}, " if by else ""}{", ".join(out)}, round(bp, 6) AS bp{", sys_len, ref_len" if lengths else ""} FROM ps"""


def _pairs_sql(g: str = "0", h: str = _H, refs: str = f"[{_R}]") -> str:
    return f"SELECT rec_id AS seg, {g} AS g, {h} AS h, {refs} AS refs {_WHERE}"


def _chrf_sql(by: str = "") -> str:
    grams = "unnest(list_transform(range(1, length({0}) - k.n + 2), lambda i: substr({0}, i, k.n)))"
    orders = "(SELECT unnest(range(1, 7)) AS n) k"
    counted = lambda s: f"SELECT seg, n, gram, count(*) AS c FROM (SELECT seg, k.n AS n, {grams.format(s)} AS gram FROM pairs, {orders}) GROUP BY ALL"
    key = "seg" if by else "0"
    return f"""
WITH pairs AS (SELECT rec_id AS seg, regexp_replace({GLOSSES}, '[\\s\\p{{Z}}]+', '', 'g') AS h, regexp_replace(translation, '[\\s\\p{{Z}}]+', '', 'g') AS r {_WHERE}),
hg AS ({counted("h")}), rg AS ({counted("r")}),
hn AS (SELECT {key} AS g, n, sum(c) AS h FROM hg GROUP BY 1, 2), rn AS (SELECT {key} AS g, n, sum(c) AS r FROM rg GROUP BY 1, 2),
cn AS (SELECT {key} AS g, n, sum(least(hg.c, rg.c)) AS m FROM hg JOIN rg USING (seg, n, gram) GROUP BY 1, 2),
pr AS (SELECT g, avg(coalesce(m, 0)::DOUBLE / h) AS p, avg(coalesce(m, 0)::DOUBLE / r) AS q FROM hn JOIN rn USING (g, n) LEFT JOIN cn USING (g, n) GROUP BY g),
every AS (SELECT DISTINCT {key} AS g FROM pairs)
SELECT {f"g AS {by}, " if by else ""}round(CASE WHEN coalesce(p + q, 0) = 0 THEN 0.0::DOUBLE ELSE 5 * p * q / (4 * p + q) END, 6) AS chrf FROM every LEFT JOIN pr USING (g)"""


def _lcs(name: str, ref: str) -> str:
    """CTEs up to ``lcs_<name> (rec_id, split, nh, nr, l)``: lengths and longest common subsequence of the glosses and ``ref``."""
    return f"""RECURSIVE pairs_{name} AS (SELECT rec_id, split, string_split({GLOSSES}, ' ') AS h, {ref} AS r {_WHERE}),
steps_{name} AS (
  SELECT rec_id, split, h, r, 1 AS i, (1::HUGEINT << len(r)) - 1 AS v FROM pairs_{name}
  UNION ALL
  SELECT rec_id, split, h, r, i + 1, (((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << len(r)) - 1)) FROM (
    SELECT *, list_sum(list_transform(range(len(r)), lambda j: CASE WHEN r[j + 1] = h[i] THEN 1::HUGEINT << j::INT ELSE 0::HUGEINT END))::HUGEINT AS m FROM steps_{name} WHERE i <= len(h))
), lcs_{name} AS (SELECT rec_id, split, len(h) AS nh, len(r) AS nr, len(r) - bit_count(v) AS l FROM steps_{name} WHERE i = len(h) + 1)"""


_ROUGE = f"""
WITH {_lcs("one", "string_split(translation, ' ')")},
scored AS (SELECT rec_id, split, CASE WHEN l = 0 THEN 0.0::DOUBLE ELSE (1 + 1.44::DOUBLE) * (l::DOUBLE / nh) * (l::DOUBLE / nr) / (l::DOUBLE / nr + 1.44::DOUBLE * (l::DOUBLE / nh)) END AS rouge FROM lcs_one)"""

_LITERAL = r"regexp_extract_all(label_char, '''((?:[^''\\]|\\.)*)''', 1)"

_ITEMS = items_sql([("corpus_a", "label_word"), ("corpus_a", "label_char")])
_ITEM_CHARS = "list_filter(string_split(regexp_replace(array_to_string({}.items, ''), '[\\s\\p{{Z}}]+', '', 'g'), ''), lambda x: x <> '')"

ORACLES = {
    "bleu_chars": bleu_sql(f"""SELECT a.rec_id AS seg, a.split AS g, {_ITEM_CHARS.format("w")} AS h, [{_ITEM_CHARS.format("c")}] AS refs FROM corpus_a a
        JOIN ({_ITEMS} SELECT rec_id, items FROM kept WHERE field = 'label_word') w ON a.rec_id = w.rec_id JOIN ({_ITEMS} SELECT rec_id, items FROM kept WHERE field = 'label_char') c ON a.rec_id = c.rec_id""", "split"),
    "bleu_corpus": bleu_sql(_pairs_sql()),
    "bleu_corpus_swapped": bleu_sql(_pairs_sql(h=_R, refs=f"[{_H}]")),
    "bleu_by_split": bleu_sql(_pairs_sql("split"), "split"),
    "bleu_stream": bleu_sql(_pairs_sql("split"), "split"),
    "bleu_sentence": bleu_sql(_pairs_sql("rec_id"), "rec_id", lengths=False),
    "bleu_multiref": bleu_sql(_pairs_sql("split", refs=f"[{_R}, {WORDS.format("regexp_replace(translation, '[,.!]', ' ', 'g')")}]"), "split"),
    "bleu_smooth_exp": bleu_sql(_pairs_sql("rec_id"), "rec_id", "exp", lengths=False),
    "bleu_smooth_addk": bleu_sql(_pairs_sql("rec_id"), "rec_id", "add-k", 1.0, lengths=False),
    "bleu_smooth_floor": bleu_sql(_pairs_sql("split"), "split", "floor", 0.1),
    "bleu_tokenized": bleu_sql(_pairs_sql(h=WORDS.format(_13a(GLOSSES)), refs=f"[{WORDS.format(_13a('translation'))}]"), smooth="exp"),
    "events_stream": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "ngram_counts": f"""SELECT n, gram, count(*) AS cnt FROM (SELECT k.n AS n, unnest(list_transform(range(1, len(w) - k.n + 2), lambda i: array_to_string(w[i:i + k.n - 1], ' '))) AS gram
        FROM (SELECT {_R} AS w FROM corpus_b WHERE translation IS NOT NULL), (VALUES (1), (2), (3), (4)) k(n)) GROUP BY ALL""",
    "chrf_corpus": _chrf_sql(),
    "chrf_sentence": _chrf_sql("rec_id"),
    "rouge_l": f"{_ROUGE} SELECT rec_id, round(rouge, 6) AS rouge FROM scored",
    "rouge_l_mean": f"{_ROUGE} SELECT split, round(avg(rouge) * 100, 6) AS rouge_l FROM scored GROUP BY split",
    "bag_overlap": f"""WITH p AS (SELECT rec_id, {_H} AS h, {_R} AS r {_WHERE}),
        hw AS (SELECT rec_id, w, count(*) AS c FROM (SELECT rec_id, unnest(h) AS w FROM p) GROUP BY ALL), rw AS (SELECT rec_id, w, count(*) AS c FROM (SELECT rec_id, unnest(r) AS w FROM p) GROUP BY ALL)
        SELECT p.rec_id, coalesce(sum(least(hw.c, rw.c)), 0)::INT AS common FROM p LEFT JOIN (hw JOIN rw USING (rec_id, w)) ON p.rec_id = hw.rec_id GROUP BY p.rec_id""",
    "bag_intersection": f"""SELECT word, count(*) AS n FROM (SELECT unnest({_R}) AS word FROM corpus_b WHERE split = 'dev' INTERSECT ALL SELECT unnest({_R}) FROM corpus_b WHERE split = 'train') GROUP BY word""",
    "tokenize_13a": f"SELECT doc_id, {_13a('text')} AS tokens FROM documents",
    "tokenize_intl": f"SELECT rec_id, {_intl('translation')} AS tokens FROM corpus_b",
    "tokenize_zh": f"SELECT doc_id, {_zh('text')} AS tokens FROM documents",
    "rouge_multiref": f"""WITH {_lcs("one", "string_split(translation, ' ')")}, {_lcs("two", "string_split(regexp_replace(translation, '[,.!]', '', 'g'), ' ')").removeprefix("RECURSIVE ")},
        best AS (SELECT rec_id, greatest(x.l::DOUBLE / x.nh, y.l::DOUBLE / y.nh) AS p, greatest(x.l::DOUBLE / x.nr, y.l::DOUBLE / y.nr) AS r FROM lcs_one x JOIN lcs_two y USING (rec_id))
        SELECT rec_id, round(CASE WHEN p = 0 OR r = 0 THEN 0.0::DOUBLE ELSE 2.44::DOUBLE * p * r / (r + 1.44::DOUBLE * p) END, 6) AS rouge FROM best""",
    "paired_bleu": bleu_sql(_pairs_sql()),
    "paired_places": """SELECT idx, a.rec_id AS hyp_rec_id, b.rec_id AS ref_rec_id FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS idx FROM corpus_a) a
        JOIN (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS idx FROM corpus_b) b USING (idx)""",
    "bleu_line": f"""WITH s AS ({bleu_sql(_pairs_sql())}), p AS (SELECT exp(ln(bleu1 / bp)) AS p1, * FROM s)
        SELECT format('BLEU = {{:.2f}}/{{:.2f}}/{{:.2f}}/{{:.2f}} {{:.1f}}/{{:.1f}}/{{:.1f}}/{{:.1f}} (BP = {{:.3f}} ratio = {{:.3f}} hyp_len = {{}} ref_len = {{}})', bleu1, bleu2, bleu3, bleu4,
          bleu1 / bp, CASE WHEN bleu1 > 0 THEN pow(bleu2 / bp, 2) / (bleu1 / bp) ELSE 0 END, CASE WHEN bleu2 > 0 THEN pow(bleu3 / bp, 3) / pow(bleu2 / bp, 2) ELSE 0 END, CASE WHEN bleu3 > 0 THEN pow(bleu4 / bp, 4) / pow(bleu3 / bp, 3) ELSE 0 END,
          bp, sys_len::DOUBLE / ref_len, sys_len, ref_len) AS line FROM p""",
    "windowed_stream": "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "split_characters": f"SELECT rec_id, CASE WHEN label_char IS NOT NULL AND trim(label_char) <> '' THEN array_to_string(list_filter(string_split(array_to_string({_LITERAL}, ''), ''), lambda x: x <> ''), ' ') || ' .' END AS spaced FROM corpus_a",
}
