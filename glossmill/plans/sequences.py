"""Queries over ordered samples: videos' frames, users' events, embeddings as frame vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import math
from glossmill.operators import images, multilabel, prototype, sequence, vocab
from glossmill.session import scratch, table
from glossmill.sources import delimited


def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "frame_meta").groupBy("video_id").agg(F.max("num_frames").alias("n"))


def _joined(ordinals: Column) -> Column:
    return F.array_join(ordinals.cast("array<string>"), ",")


def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _videos(spark, sf_dir).select("video_id", _joined(sequence.strided_or_all(F.col("n"))).alias("ordinals"))


def jitter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequence.jittered(F.col("video_id"), F.col("n"), epoch=3)
    return _videos(spark, sf_dir).where("n is not null").select("video_id", F.size(s).alias("n"), F.array_min(s).alias("first"), F.array_max(s).alias("last"))


def cap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _videos(spark, sf_dir).withColumn("s", sequence.strided(F.col("n")))
    return sequence.capped(v, "video_id", "s", 64).select("video_id", _joined(F.col("s")).alias("ordinals"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.coalesce("value", F.lit(0.0)).alias("value"), (F.col("event_type") != "error").alias("valid"))
    return sequence.positions(e, "user_id", "ts", "event_id")


def event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", "user_id", "pos")


def downsample_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.downsampled(_events(spark, sf_dir), "user_id", "value").withColumn("pooled", F.round("pooled", 6))


def local_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.local_mean(_events(spark, sf_dir), "user_id", "value").withColumn("mean", F.round("mean", 6))


def local_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("q", F.col("value") / 50)
    return sequence.local_attention(e, "user_id", "q", "value").withColumn("mixed", F.round("mixed", 6))


def causal_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.causal_sum(_events(spark, sf_dir), "user_id", "value").withColumn("total", F.round("total", 4))


def position_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.position_ids(_events(spark, sf_dir), "user_id", ~F.col("valid"))


def prefix_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _videos(spark, sf_dir).withColumnRenamed("n", "size")
    return sequence.prefix_offsets(v, "size", "video_id").select("video_id", "start", "end")


def concat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.concatenated([("a", table(spark, sf_dir, "corpus_a")), ("b", table(spark, sf_dir, "corpus_b"))], "rec_id")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = None
    for i, t in enumerate(("corpus_a", "corpus_b", "documents")):
        part = table(spark, sf_dir, t).agg(F.count("*").alias("size")).select(F.lit(i).alias("member_no"), F.lit(t).alias("member"), "size")
        sizes = part if sizes is None else sizes.unionByName(part)
    return sizes


def locate_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of the members laid end to end, counted from the start and from the end, and the first one beyond either."""
    sizes = _sizes(spark, sf_dir)
    total = sizes.agg(F.sum("size")).first()[0]
    return sequence.locate(spark.range(-total - 1, total + 1).withColumnRenamed("id", "idx"), sizes)


def full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sequence.batches(table(spark, sf_dir, "corpus_a").select("rec_id"), 16, "rec_id")
    return sequence.collate(b, "rec_id").select("batch_id", _joined(F.col("rec_id")).alias("ids"))


def pad_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strided ordinals in batches padded to the longest of each."""
    return _padded_batches(spark, sf_dir, None)


def epoch_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An epoch of at most 20 batches of 16 records."""
    b = sequence.batches(table(spark, sf_dir, "corpus_a").select("rec_id"), 16, "rec_id", drop_last=False)
    return sequence.first_batches(b, 20).select("batch_id", "slot", "rec_id")


def ragged_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of all users laid end to end in the order of the users, and split again by their numbers."""
    e = table(spark, sf_dir, "events").where("user_id is not null").select("user_id", "ts", "event_id")
    flat = sequence.global_index(e, "user_id", "ts", "event_id")
    lengths = e.groupBy("user_id").agg(F.count("*").alias("length"))
    return sequence.split_ragged(flat, lengths, "user_id", "idx", "event_id").select("user_id", _joined(F.col("event_id")).alias("events"))


def _padded_batches(spark: SparkSession, sf_dir: str, most: int | None) -> DataFrame:
    v = _videos(spark, sf_dir).withColumn("s", sequence.strided(F.coalesce("n", F.lit(0))))
    p = sequence.pad_batches(sequence.batches(v, 8, "video_id", drop_last=False), "s", most)
    return p.select("batch_id", "video_id", _joined(F.col("padded")).alias("padded"), F.size(F.filter("mask", lambda m: m)).alias("n_valid"))


def _sentence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(F.filter(F.split("translation", ""), lambda c: c != ""), lambda c: F.ascii(c))
    return table(spark, sf_dir, "corpus_b").where("translation is not null").select("rec_id", ids.alias("ids"))


def teacher_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all characters of each sentence, as inputs and targets."""
    inputs, targets = sequence.shifted(F.col("ids"))
    return _sentence_ids(spark, sf_dir).select("rec_id", _joined(inputs).alias("inputs"), _joined(targets).alias("targets"))


#: Ids of padding and of the end of a sentence, which no character has.
_PAD, _END = 1, 2


def until_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each sentence as a model gives them, with the end mark and padding after it, cut at the end mark."""
    given = F.concat("ids", F.array(F.lit(_END)), F.array_repeat(F.lit(_PAD), (F.col("rec_id") % 4).cast("int")))
    return _sentence_ids(spark, sf_dir).select("rec_id", _joined(sequence.until(given, _END)).alias("ids"))


def truncated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 64 ids of each sentence, the reference's limit."""
    return _sentence_ids(spark, sf_dir).select("rec_id", _joined(sequence.truncated(F.col("ids"), 64)).alias("ids"))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.floor(F.col("vec_id") / 10).alias("sample"), (F.col("vec_id") % 10).alias("t"), F.col("embedding").alias("vec"), F.col("embedding").isNotNull().alias("valid"), "label")


def _prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prototype.mean_vectors(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumnRenamed("label", "class_id")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prototype.prototype_scores(_frames(spark, sf_dir), _prototypes(spark, sf_dir))


def prototype_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).withColumn("score", F.round("score", 6))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = _frames(spark, sf_dir).groupBy("sample").agg(F.collect_set("label").alias("ids"))
    return multilabel.cells(_scores(spark, sf_dir), targets)


def recall_f1_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel.micro(_cells(spark, sf_dir))


def recall_f1_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel.macro(_cells(spark, sf_dir))


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel.per_class(_cells(spark, sf_dir))


def bce_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel.bce_loss(_cells(spark, sf_dir))


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prototype.frame_losses(_frames(spark, sf_dir).withColumn("target_id", F.col("label")), _prototypes(spark, sf_dir))


def ce_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multilabel.mean_ce(_losses(spark, sf_dir))


def ce_loss_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loss from logits in long form, over the positions that are not masked: every third one and those without vector are."""
    s = prototype.similarities(_frames(spark, sf_dir), _prototypes(spark, sf_dir))
    target = _frames(spark, sf_dir).select("sample", "t", F.col("label").alias("target_id"))
    logits = s.join(target, ["sample", "t"]).select("sample", "t", "class_id", (F.col("s") * 10).alias("logit"), "target_id", (F.col("t") % 3 != 0).alias("valid"))
    return multilabel.ce_loss(logits, ["sample", "t"])


def weighted_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = bce_loss(spark, sf_dir).unionByName(ce_loss(spark, sf_dir), allowMissingColumns=True).agg(F.max("bce").alias("bce"), F.max("ce").alias("ce"))
    return losses.select(F.round(multilabel.weighted_loss({"bce": F.col("bce"), "ce": F.col("ce")}, {"bce": 2.0}), 5).alias("loss"))


def arg_max_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _losses(spark, sf_dir).select("sample", "t", "class_id")


def cosine_to_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each vector with the mean of its label, held between 0.2 and 0.9."""
    e, p = table(spark, sf_dir, "embeddings"), _prototypes(spark, sf_dir)
    joined = e.join(F.broadcast(p), e["label"] == p["class_id"])
    return joined.select("vec_id", F.round(math.clamp(math.cosine(F.col("embedding"), F.col("vector")), 0.2, 0.9), 6).alias("cosine"))


_MEAN, _STD = [0.485, 0.456, 0.406], [0.229, 0.224, 0.225]


def _weighted_sum(values: Column) -> Column:
    return F.round(F.aggregate(F.transform(values, lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x), 5)


def normalized_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = F.transform("embedding", lambda x: F.pmod(F.floor(x.cast("double") * 1000), F.lit(256)))
    n = math.normalize_channels(pixels, _MEAN, _STD)
    return table(spark, sf_dir, "embeddings").select("vec_id", _weighted_sum(n).alias("normalized"), _weighted_sum(math.denormalize_channels(n, _MEAN, _STD)).alias("back"))


def rescaled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", _weighted_sum(math.rescale_points(F.col("embedding"), 1.0, 2.0)).alias("points"))


def sinusoid_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = spark.range(0, 512).withColumnRenamed("id", "pos")
    both = at.select("pos", F.posexplode(math.sinusoids(F.col("pos"), 16)).alias("i", "x")), at.select("pos", F.posexplode(math.sinusoid_halves(F.col("pos"), 17, 1)).alias("i", "y"))
    return both[0].join(both[1], ["pos", "i"], "full").select("pos", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def position_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of a table of sine and cosine values for the position of each event."""
    e = _events(spark, sf_dir).select("event_id", "pos")
    top = e.agg(F.coalesce(F.max("pos"), F.lit(0))).first()[0]
    rows = spark.range(0, top + 1).select("id", math.sinusoids(F.col("id"), 4).alias("row"))
    at = vocab.rows_at(e, "pos", rows, "id", "position")
    return at.select("event_id", "pos", *[F.round(F.get("row", F.lit(i)), 6).alias(f"p{i}") for i in range(4)])


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a vocabulary from a text file of word vectors, which lacks every seventh word."""
    e = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("lemma"), "embedding")
    at = scratch(spark, "vectors")
    delimited.write_vectors(e.where("vec_id % 7 > 0"), "lemma", "embedding", at)
    found = vocab.vocabulary_vectors(e.select("lemma", F.col("vec_id").alias("id")), delimited.read_vectors(spark, at))
    return found.select("id", "lemma", F.size("vec").alias("width"), F.round(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


def frame_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of raw pixels as the evaluation transform gives them at their own size: normalized values, summed by channel."""
    e = table(spark, sf_dir, "embeddings").where("embedding is not null and size(embedding) >= 48")
    byte = lambda x: F.lpad(F.hex(F.pmod(F.floor(x.cast("double") * 1000), F.lit(256))), 2, "0")
    raw = e.select("vec_id", F.unhex(F.array_join(F.transform(F.slice("embedding", 1, 48), byte), "")).alias("pixels"), F.lit(4).alias("side"))
    out = raw.select("vec_id", images.augmented(F.col("pixels"), F.col("side"), F.col("side"), F.col("vec_id").cast("string"), images.Augmentation(size=4).evaluation()).alias("v"))
    channel = lambda c: F.aggregate(F.filter("v", lambda x, i: i % 3 == c), F.lit(0.0), lambda s, x: s + x.cast("double"))
    return out.select("vec_id", F.size("v").alias("n"), *[F.round(channel(c), 3).alias(f"c{c}") for c in range(3)])


def rotary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", _weighted_sum(math.rotate_by_position(F.col("embedding"), F.col("vec_id") % 100)).alias("rotated"))


def shuffled_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training order of one epoch."""
    a = table(spark, sf_dir, "corpus_a").select("rec_id", sequence.shuffled_rank(F.col("rec_id"), 2).alias("h"))
    return sequence.global_index(a, "h", "rec_id").select("idx", "rec_id")


QUERIES = {
    f.__name__: f
    for f in (
        stride_sample, jitter_sample, cap_sample, event_positions, downsample_pool, local_window, local_attention, causal_sum, position_ids, prefix_offsets, concat_index, locate_ordinals, full_batches, epoch_cap, ragged_split,
        pad_mask, teacher_shift, until_end, truncated_ids, prototype_scores, recall_f1_micro, recall_f1_macro, class_counts, bce_loss, ce_loss, ce_loss_masked, weighted_loss, arg_max_class, cosine_to_first, normalized_channels, rescaled_points,
        sinusoid_table, position_rows, word_vectors, frame_values, rotary, shuffled_order,
    )
}

_V = "v AS (SELECT video_id, max(num_frames)::BIGINT AS n FROM frame_meta GROUP BY video_id)"
_E = "e AS (SELECT event_id, user_id, coalesce(value, 0.0)::DOUBLE AS value, event_type <> 'error' AS valid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)"
_NEAR = "(PARTITION BY user_id ORDER BY pos ROWS BETWEEN {0} PRECEDING AND {0} FOLLOWING)"
_DRAW = "('0x' || substr(md5(video_id || '|3|{0}'), 1, 15))::BIGINT % {1}"
_LONG = "f AS (SELECT vec_id, vec_id // 10 AS sample, vec_id % 10 AS t, label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)"
_SIM = f"""{_LONG}, p AS (SELECT label AS class_id, i, avg(x) AS y FROM f GROUP BY ALL),
fn AS (SELECT vec_id, sqrt(sum(x * x)) AS nf FROM f GROUP BY vec_id), pn AS (SELECT class_id, sqrt(sum(y * y)) AS np FROM p GROUP BY class_id),
d AS (SELECT f.vec_id, sample, t, label, class_id, sum(x * y) AS xy FROM f JOIN p USING (i) GROUP BY ALL),
s AS (SELECT sample, t, label, d.class_id, xy / (nf * np) AS s FROM d JOIN fn USING (vec_id) JOIN pn ON d.class_id = pn.class_id)"""
_SCORES = f"""WITH {_SIM}, z AS (SELECT sample, t, class_id, s FROM s UNION ALL SELECT DISTINCT sample, t, -1, 0.0::DOUBLE FROM s),
ab AS (SELECT sample, class_id, exp(s / 0.1::DOUBLE) / sum(exp(s / 0.1::DOUBLE)) OVER (PARTITION BY sample, t) * exp(s / 0.1::DOUBLE) / sum(exp(s / 0.1::DOUBLE)) OVER (PARTITION BY sample, class_id) AS ab FROM z),
sc AS (SELECT sample, class_id, sum(ab) AS score FROM ab WHERE class_id >= 0 GROUP BY ALL),
tg AS (SELECT DISTINCT vec_id // 10 AS sample, label AS class_id, 1 AS y FROM embeddings),
cells AS (SELECT sample, class_id, score, coalesce(y, 0) AS y FROM sc LEFT JOIN tg USING (sample, class_id)),
n AS (SELECT class_id, sum((score > 0.5 AND y = 1)::INT)::BIGINT AS tp, sum((score > 0.5 AND y = 0)::INT)::BIGINT AS fp, sum((score <= 0.5 AND y = 1)::INT)::BIGINT AS fn FROM cells GROUP BY class_id)"""
_BCE = "avg(CASE WHEN y = 1 THEN -ln(least(greatest(score, 1e-8), 1 - 1e-8)) ELSE -ln(1 - least(greatest(score, 1e-8), 1 - 1e-8)) END)"
_CE = """ce AS (SELECT avg(ln(se) - 0.9::DOUBLE * hit - 0.1::DOUBLE * m) AS ce FROM (SELECT sample, t, sum(exp(s * 10)) AS se, avg(s * 10) AS m, max(CASE WHEN class_id = label THEN s * 10 END) AS hit FROM s GROUP BY ALL) WHERE hit IS NOT NULL)"""
_EW = f"WITH {_LONG}"
_IDS = "c AS (SELECT rec_id, list_transform(range(1, length(translation) + 1), lambda i: unicode(substring(translation, i, 1))) AS ids FROM corpus_b WHERE translation IS NOT NULL)"

ORACLES = {
    "stride_sample": f"WITH {_V} SELECT video_id, CASE WHEN n IS NOT NULL THEN array_to_string(range(0, n, 2), ',') END AS ordinals FROM v",
    "jitter_sample": f"""WITH {_V}, r AS (SELECT video_id, range(least({_DRAW.format("start", 4)}, n), greatest(n - 4 + {_DRAW.format("end", 5)}, 0), 2) AS s FROM v WHERE n IS NOT NULL)
        SELECT video_id, len(s)::INT AS n, list_min(s)::INT AS first, list_max(s)::INT AS "last" FROM r""",
    "cap_sample": f"""WITH {_V}, x AS (SELECT video_id, unnest(range(0, n, 2)) AS i FROM v),
        r AS (SELECT video_id, i, row_number() OVER (PARTITION BY video_id ORDER BY md5(video_id || '|0|' || i)) AS k FROM x), o AS (SELECT video_id, string_agg(i::VARCHAR, ',' ORDER BY i) AS ordinals FROM r WHERE k <= 64 GROUP BY video_id)
        SELECT v.video_id, CASE WHEN n IS NOT NULL THEN coalesce(ordinals, '') END AS ordinals FROM v LEFT JOIN o USING (video_id)""",
    "event_positions": f"WITH {_E} SELECT event_id, user_id, pos FROM e",
    "downsample_pool": f"WITH {_E}, w AS (SELECT user_id, pos, sum(value) OVER {_NEAR.format(1)} / 3 AS pooled, pos = 0 OR bool_or(valid) OVER {_NEAR.format(1)} AS valid FROM e) SELECT user_id, (pos // 2)::INT AS pos, round(pooled, 6) AS pooled, valid FROM w WHERE pos % 2 = 0",
    "local_window": f"""WITH {_E}, w AS (SELECT user_id, pos, sum(CASE WHEN valid THEN value ELSE 0 END) OVER {_NEAR.format(3)} + CASE WHEN valid THEN 0 ELSE value END AS t, (sum(valid::INT) OVER {_NEAR.format(3)} + (NOT valid)::INT)::BIGINT AS n FROM e)
        SELECT user_id, pos, round(t / n, 6) AS mean, n FROM w""",
    "local_attention": f"""WITH {_E}, j AS (SELECT a.user_id, a.pos, exp(a.value / 50 * b.value / 50) AS w, b.value AS x FROM e a JOIN e b ON a.user_id = b.user_id AND abs(a.pos - b.pos) <= 3 AND (b.valid OR a.pos = b.pos))
        SELECT user_id, pos, round(sum(w * x) / sum(w), 6) AS mixed FROM j GROUP BY ALL""",
    "causal_sum": f"WITH {_E} SELECT user_id, pos, round(sum(value) OVER (PARTITION BY user_id ORDER BY pos), 4) AS total FROM e",
    "position_ids": f"WITH {_E} SELECT user_id, pos, CASE WHEN valid THEN 1 + sum(valid::INT) OVER (PARTITION BY user_id ORDER BY pos) ELSE 1 END::INT AS position_id FROM e",
    "prefix_offsets": f"""WITH {_V}, c AS (SELECT video_id, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (ORDER BY video_id)::BIGINT AS e FROM v) SELECT video_id, (e - n)::BIGINT AS start, e AS "end" FROM c""",
    "concat_index": """WITH u AS (SELECT 0 AS m, 'a' AS member, rec_id FROM corpus_a UNION ALL SELECT 1, 'b', rec_id FROM corpus_b)
        SELECT row_number() OVER (ORDER BY m, rec_id) - 1 AS idx, member, row_number() OVER (PARTITION BY m ORDER BY rec_id) - 1 AS local_idx, rec_id FROM u""",
    "locate_ordinals": """WITH s AS (SELECT 0 AS no, 'corpus_a' AS member, count(*) AS n FROM corpus_a UNION ALL SELECT 1, 'corpus_b', count(*) FROM corpus_b UNION ALL SELECT 2, 'documents', count(*) FROM documents),
        r AS (SELECT member, unnest(range(n)) AS local_idx, sum(n) OVER (ORDER BY no) - n AS lo, sum(n) OVER () AS total FROM s)
        SELECT (lo + local_idx)::BIGINT AS idx, member, local_idx FROM r UNION ALL SELECT (lo + local_idx - total)::BIGINT, member, local_idx FROM r
        UNION ALL SELECT unnest([sum(n), -sum(n) - 1])::BIGINT, NULL, NULL FROM s""",
    "full_batches": """WITH r AS (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS i FROM corpus_a) SELECT i // 16 AS batch_id, string_agg(rec_id::VARCHAR, ',' ORDER BY i) AS ids FROM r GROUP BY 1 HAVING count(*) = 16""",
    "pad_mask": f"""WITH {_V}, r AS (SELECT video_id, range(0, coalesce(n, 0), 2) AS s, (row_number() OVER (ORDER BY video_id) - 1) // 8 AS batch_id FROM v),
        l AS (SELECT *, max(len(s)) OVER (PARTITION BY batch_id) AS k FROM r)
        SELECT batch_id, video_id, array_to_string(list_transform(range(1, k + 1), lambda i: coalesce(s[i], 0)), ',') AS padded, len(s)::INT AS n_valid FROM l""",
    "teacher_shift": f"WITH {_IDS} SELECT rec_id, array_to_string(ids[:greatest(len(ids) - 1, 0)], ',') AS inputs, array_to_string(ids[2:], ',') AS targets FROM c",
    "epoch_cap": "SELECT i // 16 AS batch_id, (i % 16)::INT AS slot, rec_id FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS i FROM corpus_a) WHERE i < 320",
    "ragged_split": "SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS events FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    "until_end": f"WITH {_IDS} SELECT rec_id, array_to_string(ids, ',') AS ids FROM c",
    "truncated_ids": f"WITH {_IDS} SELECT rec_id, array_to_string(ids[:64], ',') AS ids FROM c",
    "prototype_scores": f"{_SCORES} SELECT sample, class_id, round(score, 6) AS score FROM sc",
    "recall_f1_micro": f"{_SCORES} SELECT round(sum(tp)::DOUBLE / sum(tp + fn), 6) AS recall_micro, round(sum(tp) / (sum(tp) + 0.5::DOUBLE * sum(fp + fn)), 6) AS f1_micro FROM n",
    "recall_f1_macro": f"{_SCORES} SELECT round(avg(tp / (tp + fn + 1e-8::DOUBLE)), 6) AS recall_macro, round(avg(tp / (tp + 0.5::DOUBLE * (fp + fn))), 6) AS f1_macro FROM n WHERE tp + fn > 0",
    "class_counts": f"{_SCORES} SELECT class_id, tp, fp, fn, round(CASE WHEN tp + fp + fn > 0 THEN tp / (tp + 0.5::DOUBLE * (fp + fn)) END, 6) AS f1 FROM n",
    "bce_loss": f"{_SCORES} SELECT round({_BCE}, 6) AS bce FROM cells",
    "ce_loss": f"WITH {_SIM}, {_CE} SELECT round(ce, 6) AS ce FROM ce",
    "ce_loss_masked": f"WITH {_SIM}, {_CE.replace('FROM s GROUP', 'FROM s WHERE t % 3 <> 0 GROUP')} SELECT round(ce, 6) AS ce FROM ce",
    "weighted_loss": f"{_SCORES}, {_CE} SELECT round(2 * round((SELECT {_BCE} FROM cells), 6) + round(ce, 6), 5) AS loss FROM ce",
    "arg_max_class": f"WITH {_SIM} SELECT sample, t, class_id FROM s QUALIFY row_number() OVER (PARTITION BY sample, t ORDER BY round(s * 10, 6) DESC, class_id) = 1",
    "cosine_to_first": f"WITH {_SIM} SELECT sample * 10 + t AS vec_id, round(least(greatest(s, 0.2::DOUBLE), 0.9::DOUBLE), 6) AS cosine FROM s WHERE class_id = label",
    "normalized_channels": f"""{_EW}, c AS (SELECT vec_id, i, (floor(x * 1000)::BIGINT % 256 + 256) % 256 AS p, [0.485, 0.456, 0.406][i % 3 + 1]::DOUBLE AS m, [0.229, 0.224, 0.225][i % 3 + 1]::DOUBLE AS s FROM f)
        SELECT vec_id, round(sum((p / 255.0::DOUBLE - m) / s * (i + 1)), 5) AS normalized, round(sum(p * (i + 1))::DOUBLE, 5) AS back FROM c GROUP BY vec_id""",
    "rescaled_points": f"{_EW} SELECT vec_id, round(sum(((x + 1) / 2 * 2 - 1) * (i + 1)), 5) AS points FROM f GROUP BY vec_id",
    "sinusoid_table": """WITH g AS (SELECT pos, unnest(range(17)) AS i FROM range(512) t(pos)),
        v AS (SELECT pos, i, pos / pow(10000.0::DOUBLE, (i - i % 2) / 16.0::DOUBLE) AS a, pos * pow(10000.0::DOUBLE, -(i % 8) / 7.0::DOUBLE) AS b FROM g)
        SELECT pos, i::INT AS i, round(CASE WHEN i < 16 THEN CASE WHEN i % 2 = 0 THEN sin(a) ELSE cos(a) END END, 6) AS x, round(CASE WHEN pos = 1 OR i = 16 THEN 0.0 WHEN i < 8 THEN sin(b) ELSE cos(b) END, 6) AS y FROM v""",
    "position_rows": f"WITH {_E} SELECT event_id, pos, round(sin(pos), 6) AS p0, round(cos(pos), 6) AS p1, round(sin(pos / 100.0::DOUBLE), 6) AS p2, round(cos(pos / 100.0::DOUBLE), 6) AS p3 FROM e",
    "word_vectors": f"{_EW} SELECT vec_id AS id, 'w' || vec_id AS lemma, 64::INT AS width, round(CASE WHEN vec_id % 7 > 0 THEN sum(x) ELSE 0 END, 4) AS total FROM f GROUP BY vec_id",
    "frame_values": f"""{_EW}, c AS (SELECT vec_id, i, ((floor(x * 1000)::BIGINT % 256 + 256) % 256 / 255.0::DOUBLE - [0.485, 0.456, 0.406][i % 3 + 1]::DOUBLE) / [0.229, 0.224, 0.225][i % 3 + 1]::DOUBLE AS v FROM f WHERE i < 48)
        SELECT vec_id, 48::INT AS n, round(sum(v) FILTER (i % 3 = 0), 3) AS c0, round(sum(v) FILTER (i % 3 = 1), 3) AS c1, round(sum(v) FILTER (i % 3 = 2), 3) AS c2 FROM c GROUP BY vec_id""",
    "rotary": f"""{_EW}, r AS (SELECT a.vec_id, a.i, a.x, CASE WHEN a.i < 32 THEN -b.x ELSE b.x END AS o, (a.vec_id % 100) * pow(10000.0::DOUBLE, -(a.i % 32) / 32.0::DOUBLE) AS g FROM f a JOIN f b ON a.vec_id = b.vec_id AND b.i = (a.i + 32) % 64)
        SELECT vec_id, round(sum((x * cos(g) + o * sin(g)) * (i + 1)), 5) AS rotated FROM r GROUP BY vec_id""",
    "shuffled_order": "SELECT row_number() OVER (ORDER BY md5(rec_id || '|0|2'), rec_id) - 1 AS idx, rec_id FROM corpus_a",
}
