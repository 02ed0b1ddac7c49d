import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.functions import math as M
from glossmill.operators import prototype, relations, sequence, vocab


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} int" for k in values)).select(column).first()[0]


@pytest.mark.parametrize("n", [0, 1, 4, 256, 257, 513, None])
@pytest.mark.parametrize("stride", [1, 2])
def test_strides(spark, n, stride):
    got = one(spark, sequence.strided(F.col("n"), stride), n=n)
    assert got == (None if n is None else list(range(0, n, stride)))


def test_jitter_stays_in_its_ranges(spark):
    df = spark.range(500).selectExpr("concat('v', id) AS v", "cast(id % 40 AS int) AS n")
    rows = df.select("n", sequence.jittered(F.col("v"), F.col("n")).alias("s")).collect()
    assert all(not r.s or (0 <= r.s[0] < 4 and r.n - 6 <= r.s[-1] < r.n) for r in rows)
    assert len({tuple(r.s) for r in rows if r.n == 30}) > 3
    a, b = (df.select(sequence.jittered(F.col("v"), F.col("n"), epoch=e).alias("s")).collect() for e in (1, 2))
    assert a != b


def test_cap_draws_without_replacement(spark):
    df = spark.createDataFrame([(i, list(range(i))) for i in (0, 3, 64, 65, 300)] + [(9, None)], "k int, s array<int>")
    got = {r.k: r.s for r in sequence.capped(df, "k", "s", 64).collect()}
    assert got[0] == [] and got[3] == [0, 1, 2] and got[64] == list(range(64)) and got[9] is None
    assert len(got[300]) == 64 and got[300] == sorted(set(got[300])) and set(got[300]) <= set(range(300))


@pytest.fixture
def walk(spark, monkeypatch):
    monkeypatch.setattr(sequence, "SLICE", 5)
    g = random.Random(1)
    rows = [(k, g.randrange(10**6), g.random() * 10, g.random() < 0.7) for k in [1] * 40 + [2] * 7 + [3] + [None] * 12]
    return rows, spark.createDataFrame(rows, "k int, t int, value double, valid boolean").repartition(5)


def by_key(rows):
    out = {}
    for k, t, v, ok in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.setdefault(k, []).append((v, ok))
    return out


def test_windows_over_slices_equal_whole_sequences(spark, walk):
    rows, df = walk
    p = sequence.positions(df, "k", "t")
    seqs = by_key(rows)
    got = {(r.k, r.pos): r for r in p.collect()}
    assert {(k, i) for k, s in seqs.items() for i in range(len(s))} == set(got)
    assert all(got[k, i].value == v for k, s in seqs.items() for i, (v, _) in enumerate(s))

    pooled = {(r.k, r.pos): (r.pooled, r.valid) for r in sequence.downsampled(p, "k", "value").collect()}
    local = {(r.k, r.pos): (r["mean"], r.n) for r in sequence.local_mean(p, "k", "value").collect()}
    mixed = {(r.k, r.pos): r.mixed for r in sequence.local_attention(p, "k", "value", "value").collect()}
    total = {(r.k, r.pos): r.total for r in sequence.causal_sum(p, "k", "value").collect()}
    ids = {(r.k, r.pos): r.position_id for r in sequence.position_ids(p, "k", ~F.col("valid")).collect()}
    for k, s in seqs.items():
        for i, (v, ok) in enumerate(s):
            if i % 2 == 0:
                near = s[max(0, i - 1) : i + 2]
                assert pooled[k, i // 2] == (pytest.approx(sum(x for x, _ in near) / 3), i == 0 or any(o for _, o in near))
            around = [(x, j) for j, (x, o) in enumerate(s) if abs(i - j) <= 3 and (o or i == j)]
            assert local[k, i] == (pytest.approx(sum(x for x, _ in around) / len(around)), len(around))
            top = max(v * x for x, _ in around)
            w = [math.exp(v * x - top) for x, _ in around]
            assert mixed[k, i] == pytest.approx(sum(a * x for a, (x, _) in zip(w, around)) / sum(w))
            assert total[k, i] == pytest.approx(sum(x for x, _ in s[: i + 1]))
            assert ids[k, i] == (1 + sum(o for _, o in s[: i + 1]) if ok else 1)


def test_carried_values_cross_partitions(spark):
    g = random.Random(2)
    rows = [(k, i, g.choice([None, None, None, "x", "y"])) for k in ("a", "b", "c") for i in range(60)]
    df = spark.createDataFrame(rows, "g string, o int, v string").repartition(6)
    want, last = {}, {}
    for k, i, v in sorted(rows):
        last[k] = v or last.get(k)
        want[k, i] = last[k]
    assert {(r.g, r.o): r.carried for r in relations.carried(df, "g", ["o"], F.col("v")).collect()} == want
    none = spark.createDataFrame([("a", i, None) for i in range(20)], "g string, o int, v string")
    assert {r.carried for r in relations.carried(none, "g", ["o"], F.col("v")).collect()} == {None}
    assert relations.carried(df.limit(0), "g", ["o"], F.col("v")).count() == 0


def test_global_index_and_offsets(spark):
    g = random.Random(3)
    rows = [(g.randrange(10**9), g.choice([0, 1, 5, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k bigint, size int").repartition(7)
    got = sorted((r.idx, r.k) for r in sequence.global_index(df, "k").collect())
    assert got == list(enumerate(sorted(k for k, _ in rows)))
    at = 0
    offsets = {r.k: (r.start, r.end) for r in sequence.prefix_offsets(df, "size", "k").collect()}
    for k, n in sorted(rows, key=lambda r: r[0]):
        assert offsets[k] == (at, at + (n or 0))
        at += n or 0
    assert sequence.global_index(df.limit(0), "k").count() == 0


def test_locate(spark):
    sizes = spark.createDataFrame([(0, "none", 0), (1, "one", 1), (2, "n", 5)], "member_no int, member string, size bigint")
    q = spark.createDataFrame([(i,) for i in (0, 1, 5, 6, -1, -6, -7, None)], "idx bigint")
    got = {r.idx: (r.member, r.local_idx) for r in sequence.locate(q, sizes).collect()}
    assert got == {0: ("one", 0), 1: ("n", 0), 5: ("n", 4), 6: (None, None), -1: ("n", 4), -6: ("one", 0), -7: (None, None), None: (None, None)}


def test_batches(spark):
    df = spark.createDataFrame([(i, list(range(i % 4))) for i in range(10)], "k int, s array<int>").repartition(3)
    full = sequence.batches(df, 4, "k")
    assert sorted(tuple(r.k) for r in sequence.collate(full, "k").collect()) == [(0, 1, 2, 3), (4, 5, 6, 7)]
    padded = sequence.pad_batches(sequence.batches(df, 4, "k", drop_last=False), "s", 2).collect()
    assert all(len(r.padded) == len(r["mask"]) <= 2 and sum(r["mask"]) == min(len(r.s), 2) for r in padded) and len(padded) == 10
    assert {len(r.padded) for r in padded if r.batch_id == 2} == {1}


def test_id_lists(spark):
    df = spark.createDataFrame([([5, 2, 7, 2],), ([],), ([2],), (None,)], "a array<int>")
    inputs, targets = sequence.shifted(F.col("a"))
    got = [tuple(r) for r in df.select(inputs, targets, sequence.until(F.col("a"), 2), sequence.truncated(F.col("a"), 2)).collect()]
    assert got[0] == ([5, 2, 7], [2, 7, 2], [5], [5, 2]) and got[1] == ([], [], [], []) and got[2] == ([], [], [], [2])


def test_prototypes(spark):
    vecs = {(0, 0): [1.0, 0.0], (0, 1): [0.6, 0.8], (0, 2): [0.0, 0.0]}
    frames = spark.createDataFrame([(s, t, v, True) for (s, t), v in vecs.items()] + [(0, 3, [9.0, 9.0], False), (1, 0, None, True)], "sample int, t int, vec array<float>, valid boolean")
    protos = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 3.0])], "class_id int, vector array<double>")
    cos = {(t, c): (v[c] / (math.hypot(*v) or 1)) for (_, t), v in vecs.items() for c in (0, 1)} | {(t, -1): 0.0 for t in range(3)}
    want = {}
    for c in (0, 1):
        want[c] = sum(
            math.exp(cos[t, c] / 0.1) / sum(math.exp(cos[t, d] / 0.1) for d in (0, 1, -1)) * math.exp(cos[t, c] / 0.1) / sum(math.exp(cos[u, c] / 0.1) for u in range(3)) for t in range(3)
        )
    got = {r.class_id: r.score for r in prototype.prototype_scores(frames, protos).collect()}
    assert got == pytest.approx(want, abs=1e-6)
    assert prototype.prototype_scores(frames.limit(0), protos).count() == 0
    assert prototype.prototype_scores(frames, protos.limit(0)).count() == 0 and prototype.similarities(frames, protos.limit(0)).count() == 0
    cold = prototype.prototype_scores(frames.repartition(5), protos, 0.0, 0.001).collect()
    assert {r.class_id: r.score for r in cold} == pytest.approx({0: 1.0, 1: 1.0}, abs=1e-6)
    soft = frames.where("valid").select("sample", "t", prototype.softmax_over(F.col("t") * 500.0, "sample").alias("p"))
    assert {r.t: round(r.p, 6) for r in soft.where("sample = 0").collect()} == {0: 0.0, 1: 0.0, 2: 1.0}


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = df.select(M.norm(F.col("a")), M.cosine(F.col("a"), F.col("a")), M.cosine(F.col("a"), F.col("z")), M.floored_log(F.lit(0.0)), M.f_beta(F.lit(0.0), F.lit(0.0), 2.0)).first()
    assert list(r) == [5.0, pytest.approx(1.0), 0.0, -9999999999.0, 0.0]
    turned = df.select(M.rotate_by_position(F.col("a"), F.lit(1))).first()[0]
    assert turned == pytest.approx([3 * math.cos(1) - 4 * math.sin(1), 4 * math.cos(1) + 3 * math.sin(1)])


def test_vocabulary_rules(spark):
    counts = spark.createDataFrame([("a", 4), ("b", 3), ("c", 25)], "lemma string, n bigint")
    assert {r.lemma for r in vocab.frequency_ratio(counts, 10).collect()} == {"b"}
    words = spark.createDataFrame([(1, ["c", "x", "a", "a"]), (2, []), (3, None)], "k int, w array<string>")
    ids = spark.createDataFrame([("a", 7), ("c", 1)], "lemma string, id int")
    assert {r.k: r.ids for r in vocab.lookup_ids(words, "k", "w", ids).collect()} == {1: [1, 7, 7], 2: [], 3: []}
    assert [tuple(r) for r in vocab.lookup_misses(words, "w", ids).collect()] == [("x", 1)]
    lexicon = spark.createDataFrame([("c", "C1", "NOUN"), ("a", "A1", "DET")], "word string, lemma string, pos string")
    tokens = vocab.lexicon_tags(words, "k", "w", lexicon)
    assert tokens.select(vocab.content_words(F.col("tokens"), field="lemma")).first()[0] == ["c1"]
    with pytest.raises(Exception, match="no id"):
        vocab.checked(spark.createDataFrame([(None,)], "id int"), "id", "id").collect()
    last = vocab.keep_last(spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 1, "z")], "k string, o int, v string"), "k", F.col("o"))
    assert {tuple(r) for r in last.collect()} == {("a", 2, None), (None, 1, "z")}


@pytest.mark.parametrize("most", [100, 1])
def test_ordinals_are_found_with_and_without_sending_the_members(spark, most):
    sizes = spark.createDataFrame([(3, "c", 2), (0, "a", 3), (1, "empty", 0), (2, "b", 1), (4, None, None)], "member_no int, member string, size bigint")
    q = spark.createDataFrame([(x,) for x in (*range(-8, 8), None, 3, 3)], "idx bigint")
    laid = [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0), ("c", 1)]
    got = sorted(((r.idx, r.member, r.local_idx) for r in sequence.locate(q, sizes, most).collect()), key=str)
    want = [(x, *(laid[x] if x is not None and -6 <= x < 6 else (None, None))) for x in (*range(-8, 8), None, 3, 3)]
    assert got == sorted(want, key=str)
    assert sequence.locate(q.limit(0), sizes, most).count() == 0
    assert [tuple(r)[1:] for r in sequence.locate(q.where("idx = 0"), sizes.limit(0), most).collect()] == [(None, None)]


def test_ragged_lists_come_back(spark):
    flat = spark.createDataFrame([(i, f"v{i}") for i in range(7)], "idx bigint, v string")
    lengths = spark.createDataFrame([("b", 2), ("a", 3), ("c", 0), ("d", None), ("e", 1)], "k string, length int")
    got = {r.k: r.v for r in sequence.split_ragged(flat, lengths, "k", "idx", "v").collect()}
    assert got == {"a": ["v0", "v1", "v2"], "b": ["v3", "v4"], "c": [], "d": [], "e": ["v5"]}


def test_pairs_by_place(spark):
    h = spark.createDataFrame([(i, f"h{i}") for i in (5, 1, 3)], "id int, text string")
    r = spark.createDataFrame([(i, f"r{i}") for i in (40, 10, 30)], "id int, text string")
    got = sorted((x.idx, x.hyp_text, x.ref_text) for x in relations.paired(h, r, ["id"]).collect())
    assert got == [(0, "h1", "r10"), (1, "h3", "r30"), (2, "h5", "r40")]
    assert relations.paired(h, r.where("id < 40"), ["id"], strict=False).count() == 2
    with pytest.raises(Exception, match="differ in length"):
        relations.paired(h, r.where("id < 40"), ["id"]).collect()
    assert relations.paired(h.limit(0), r.limit(0), ["id"]).count() == 0


def test_bag_overlap(spark):
    df = spark.createDataFrame([(["a", "a", "b", None], ["a", "a", "a", "c"]), ([], ["a"]), (None, ["a"]), (["x"], ["x", "x"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(relations.bag_overlap(df.a, df.b)).collect()] == [2, 0, 0, 1]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_prototypes_in_blocks_give_the_same(spark, block_bytes):
    g = np.random.default_rng(3)
    protos = g.normal(size=(7, 5))
    vecs = g.normal(size=(40, 5))
    p = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(protos)] + [(99, None)], "class_id int, vector array<double>")
    f = spark.createDataFrame([(i // 8, i % 8, v.tolist(), i % 5 > 0, i % 9) for i, v in enumerate(vecs)] + [(0, 99, None, True, 1)], "sample int, t int, vec array<double>, valid boolean, target_id int")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    s = unit(vecs) @ unit(protos).T
    e = np.exp(s / 0.1)
    a = e / (e.sum(axis=1, keepdims=True) + 1)
    keep = np.arange(40) % 5 > 0
    got = {(r.sample, r.class_id): r.score for r in prototype.prototype_scores(f, p, block_bytes=block_bytes).collect()}
    assert len(got) == 35
    for (sample, c), score in got.items():
        at = keep & (np.arange(40) // 8 == sample)
        assert score == pytest.approx((a[at, c] * e[at, c]).sum() / e[at, c].sum())
    losses = {(r.sample, r.t): r for r in prototype.frame_losses(f, p, block_bytes=block_bytes).collect()}
    assert len(losses) == keep.sum()
    for i in np.flatnonzero(keep):
        r, z = losses[i // 8, i % 8], s[i] * 10
        assert r["lse"] == pytest.approx(np.log(np.exp(z).sum())) and r["mean"] == pytest.approx(z.mean()) and r.class_id == z.argmax()
        assert (r.hit is None) if i % 9 > 6 else r.hit == pytest.approx(z[i % 9])
    assert prototype.similarities(f, p, block_bytes).count() == 7 * keep.sum()
    assert prototype.prototype_scores(f, p.limit(0)).count() == 0
