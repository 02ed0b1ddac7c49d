import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.operators import control, images, models, relations, vocab
from glossmill.session import shared_dir
from glossmill.sources import delimited, frames
from glossmill.sources import registry as sources
from glossmill.streaming import metrics


def test_checkpoints(spark):
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    same = paths("b_result_checkpoint_2_x_1.5.pt", "a_result_checkpoint_9_x_1.5.pt", "c_result_checkpoint_1_x_-101.pt")
    assert tuple(control.best_checkpoint(same, "path").first()) == ("a_result_checkpoint_9_x_1.5.pt", "9", 1.5)
    assert tuple(control.best_checkpoint(paths("x.pt", None), "path").first()) == ("", "0", 0.0)
    assert tuple(control.best_checkpoint(paths("c_result_checkpoint_1_x_-5.pt"), "path").first())[2] == -5.0
    assert control.latest_checkpoint(paths("latest_checkpoint_5.pt", "latest_checkpoint_40.pt", "best_9.pt"), "path").first().n == 40
    assert tuple(control.latest_checkpoint(paths("x.pt"), "path").first()) == (None, None)


def test_schedules(spark):
    row = lambda c: spark.range(1).select(c).first()[0]
    assert row(control.warmup_cosine_lr(F.lit(0), 1.0, 10, 20, 5, 0.01)) == pytest.approx(0.01)
    assert row(control.warmup_cosine_lr(F.lit(50), 1.0, 10, 20, 5, 0.01)) == pytest.approx(1.0)
    assert row(control.warmup_cosine_lr(F.lit(125), 1.0, 10, 20, 5, 0.01)) == pytest.approx((1 + 0.01) / 2)
    assert row(control.cosine_lr(F.lit(25), 1.0, 0.0, 100)) == pytest.approx((1 + math.cos(math.pi / 4)) / 2)
    assert row(control.multistep_lr(F.lit(60), 1.0, [30, 60])) == pytest.approx(0.01)


def test_plateau(spark):
    values = [5.0, 4.0, 4.0, 4.0, 4.0, 3.0, 3.0, 3.0, 3.0, 3.0]
    got = spark.createDataFrame([(values,)], "v array<double>").select(control.plateau_lr(F.col("v"), 1.0, factor=0.5, patience=1, cooldown=1)).first()[0]
    best, bad, cool, lr, want = None, 0, 0, 1.0, []
    for v in values:
        if best is None or v < best * (1 - 1e-4):
            best, bad = v, 0
        else:
            bad += 1
        if cool > 0:
            cool, bad = cool - 1, 0
        if bad > 1:
            lr, cool, bad = lr * 0.5, 1, 0
        want.append(lr)
    assert got == pytest.approx(want) and got[-1] < 1


def test_text(spark):
    row = lambda c: spark.range(1).select(c).first()[0]
    assert row(text.tokenize_13a(F.lit('Er sagt: &quot;3,5-mal&quot;, ja.\nEnde-\nlich 10.5'))) == 'Er sagt : " 3,5 - mal " , ja . Endelich 10.5'
    assert row(text.tokenize_13a(F.lit("A, b. 3.5 x-y 4-5 &amp;"))) == "A , b . 3.5 x-y 4 - 5 &"
    assert row(text.tokenize_intl(F.lit("3,5 €, «ja»!"))).split() == ["3,5", "€", ",", "«", "ja", "»", "!"]
    assert row(text.tokenize_zh(F.lit("今天ok，3.5"))) == "今 天 ok ， 3.5"
    assert row(text.tokenize_zh(F.lit("a→b㐀c"))) == "a → b 㐀 c"
    assert row(text.list_literal(F.lit("['a', '', 'b,c']"))) == ["a", "", "b,c"]
    assert row(text.list_literal(F.lit("__import__('os')"))) is None
    assert row(text.words(F.lit("  a  b "))) == ["a", "b"] and row(text.words(F.lit(""))) == [] and row(text.split_blanks(F.lit(""))) == [""]
    assert row(text.spaced_characters(F.lit("你a😀"))) == "你 a 😀"
    assert row(text.segment_text(F.lit('<seg id="3"> a  b </seg>'))) == "a b" and row(text.attribute(F.lit('<doc docid="x" >'), "docid")) == "x"
    assert row(text.inverted(F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("y"), F.lit("c"), F.lit("x")))) == {"y": "b", "x": "c"}
    assert row(text.replace_in_order(F.lit("ab"), [("a", "b"), ("bb", "c")])) == "c"


def test_bags(spark):
    a = spark.createDataFrame([("x", 1)] * 3 + [("y", None)] * 2, "s string, n int")
    b = spark.createDataFrame([("x", 1)] * 2 + [("y", None)] * 5 + [("z", 1)], "s string, n int")
    assert sorted(map(tuple, relations.bag_intersection(a, b).collect()), key=str) == sorted([("x", 1)] * 2 + [("y", None)] * 2, key=str)


def test_frames(spark, tmp_path):
    videos = spark.createDataFrame([("v1", b"abc"), ("v2", b""), ("v3", None), ("v4", b"x" * 300)], "video_id string, content binary")
    decoded = frames.decode_videos(videos, lambda content: (bytes([c]) for c in content))
    frames.write_store(decoded, f"file://{tmp_path}/store")
    counts = {r.video_id: r.num_frames for r in frames.details(spark, f"file://{tmp_path}/store").collect()}
    assert counts == {"v1": 3, "v4": 300}
    wanted = spark.createDataFrame([("v1", [0, 2, 2, 9]), ("v4", [299]), ("v9", [0])], "video_id string, ordinals array<int>")
    got = frames.select_frames(spark.read.parquet(f"file://{tmp_path}/store/frames"), wanted).select("video_id", "frame_no", "jpeg")
    assert sorted((r[0], r[1], bytes(r[2])) for r in got.collect()) == [("v1", 0, b"a"), ("v1", 2, b"c"), ("v4", 299, b"x")]


def test_files(spark, tmp_path):
    rows = [("a|b", 'q "x" | y', " lead"), ("b", "", None), ("c", "line\nend", "\t"), (None, None, "NA")]
    at = f"file://{tmp_path}/d"
    delimited.write_delimited(spark.createDataFrame(rows, delimited.CORPUS_B), at, "|")
    back = delimited.read_delimited(spark, at, delimited.CORPUS_B, "|")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "m.json").write_text('{"a": 1, "b": 2}')
    assert {tuple(r) for r in delimited.read_dictionary(spark, f"file://{tmp_path}/m.json", "k", "v").collect()} == {("a", 1), ("b", 2)}
    (tmp_path / "i").mkdir()
    for n in ("2.jpg", "1.png", "x.txt"):
        (tmp_path / "i" / n).write_bytes(b"1")
    assert [r.path[-5:] for r in delimited.list_images(spark, f"file://{tmp_path}/i").collect()] == ["1.png", "2.jpg"]
    one = spark.range(3)
    delimited.write_once(one, f"file://{tmp_path}/once")
    delimited.write_once(spark.range(9), f"file://{tmp_path}/once")
    assert spark.read.parquet(f"file://{tmp_path}/once").count() == 3


def test_images(spark):
    g = np.random.default_rng(0)
    frame = lambda: g.integers(0, 256, (40, 50, 3), np.uint8).tobytes()
    rows = [("a", frame(), 40, 50), ("a", frame(), 40, 50), ("b", frame(), 40, 50), ("b", b"x", 40, 50), ("b", None, 40, 50)]
    df = spark.createDataFrame(rows, "clip string, p binary, h int, w int")
    how = images.Augmentation(size=16)
    out = [r[0] for r in df.select(images.augmented(F.col("p"), F.col("h"), F.col("w"), F.col("clip"), how)).collect()]
    assert [x if x is None else len(x) for x in out] == [768, 768, 768, None, None]
    flat = np.full((40, 50, 3), 100, np.uint8)
    same = images.augment(flat, how.evaluation(), 1)
    assert same.shape == (16, 16, 3) and np.allclose(same, 100)
    whole = images.augment(np.arange(16 * 16 * 3).reshape(16, 16, 3) % 256, how.evaluation(), 5)
    assert np.allclose(whole, np.arange(16 * 16 * 3).reshape(16, 16, 3) % 256)
    seeds = [images.augment(np.frombuffer(rows[0][1], np.uint8).reshape(40, 50, 3), how, s) for s in (1, 1, 2)]
    assert np.array_equal(seeds[0], seeds[1]) and not np.array_equal(seeds[0], seeds[2])


def test_models(spark):
    @models.register("double")
    def double(by=2):
        return lambda: lambda batch: pa.RecordBatch.from_arrays([pa.array([x * by for x in batch.column(0).to_pylist()], pa.int64())], names=["id"])

    assert sorted(r[0] for r in models.apply_model(spark.range(4), models.create("double", by=3), "id bigint").collect()) == [0, 3, 6, 9]
    with pytest.raises(KeyError):
        models.create("none")
    with pytest.raises(ValueError):
        models.register("double")(double)


def test_stream_of_growing_files(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(f"2024-01-01 0{i}:10:00", "k", 1.0)], "ts string, key string, value double").selectExpr("cast(ts AS timestamp) AS ts", "key", "value").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/e")
    s = spark.readStream.schema("ts timestamp, key string, value double").parquet(f"file://{tmp_path}/e")
    got = metrics.run_to_end(metrics.windowed_counts(s, "ts", ["key"]), "windows")
    assert sorted(r.n for r in got.collect()) == [1, 1, 1]
    assert shared_dir(spark)


def test_epoch_means(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 4.0, 1.0), (2, None, 3.0), (2, None, None)], "epoch int, loss double, ce double")
    got = {(r.epoch, r.name): (r["mean"], r.n) for r in control.epoch_means(df, "epoch", ["loss", "ce"]).collect()}
    assert got == {(1, "avg_loss"): (3.0, 2), (1, "avg_ce"): (1.0, 1), (2, "avg_ce"): (3.0, 1)}
    assert control.epoch_means(df.limit(0), "epoch", ["loss"]).count() == 0


def test_schedules_by_name(spark):
    assert control.learning_rate("none", F.lit(0)) is None
    with pytest.raises(KeyError):
        control.learning_rate("other", F.lit(0))
    assert spark.range(1).select(control.learning_rate("step", F.lit(40), lr=1.0, milestones=[30, 60])).first()[0] == pytest.approx(0.1)


def test_decoded_ids(spark):
    pieces = spark.createDataFrame([(1, "<pad>"), (5, "wi"), (6, "nd"), (7, " ")], "id int, piece string")
    df = spark.createDataFrame([(0, [5, 6, 7, 5, 1, 1]), (1, []), (2, None), (3, [1, 9]), (4, [6, None, 5])], "k int, ids array<int>")
    assert {r.k: r.text for r in vocab.decoded(df, "k", "ids", pieces, [1]).collect()} == {0: "wind wi", 1: "", 2: None, 3: "", 4: "ndwi"}


@pytest.mark.parametrize("laid", [True, False])
@pytest.mark.parametrize("most", [1 << 20, 600, 0])
def test_frames_are_selected_without_a_broadcast_of_exploded_ordinals(spark, tmp_path, most, laid):
    videos = {"a": 9000, "b": 3, "c": 130, "d": 64, "e": 10, "f": 1}
    stand_in = spark.createDataFrame(list(videos.items()), "video_id string, n int").selectExpr("video_id", "explode(sequence(0, n - 1)) AS frame_no").selectExpr("*", "cast(concat(video_id, frame_no) AS binary) AS jpeg")
    frames.write_store(stand_in, f"file://{tmp_path}/store")
    store = spark.read.parquet(f"file://{tmp_path}/store/frames")
    asked = {"a": [0, 63, 64, 4095, 4096, 8999, 9000, 8999], "b": [-1, None, 2], "c": list(range(0, 130, 7)), "d": [63], "e": None, "f": [], "g": [0]}
    selection = spark.createDataFrame([*asked.items(), ("b", [0, 2]), (None, [1])], "video_id string, ordinals array<int>")
    wanted = {(v, i) for v, no in [*asked.items(), ("b", [0])] for i in no or [] if i is not None and 0 <= i < videos.get(v, 0)}
    got = frames.select_frames(store if laid else store.drop("bucket"), selection, most)
    assert got.columns == ["video_id", "frame_no", "jpeg"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(wanted) and {r[:2] for r in rows} == wanted and all(bytes(r[2]) == f"{r[0]}{r[1]}".encode() for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and ("BroadcastHashJoin" in plan) == (most == 1 << 20) and ("SortMergeJoin" in plan) == (most < 1 << 20 and not laid)
    assert frames.select_frames(store, selection.limit(0), most).count() == 0


@pytest.mark.parametrize("most", [vocab.VOCABULARY_BYTES, -1])
def test_decoded_ids_of_any_vocabulary_without_a_broadcast_of_their_rows(spark, most):
    pieces = spark.createDataFrame([(-3, "neg"), (5, "wi"), (6, "nd"), (6, "b"), (7, None), (None, "x"), (8, "日🌧")], "id int, piece string")
    lists = {0: [5, 6, -3, 5, 1], 1: [], 2: None, 3: [1, 9], 4: [6, None, 8], 5: [7]}
    df = spark.createDataFrame(list(lists.items()), "k int, ids array<int>").repartition(2)
    for special, between, want in (
        ([1], "", {0: "wibndnegwi", 4: "bnd日🌧"}),
        ([1, 5], "-", {0: "b-nd-neg", 4: "b-nd-日🌧"}),
        ([-3, 5, 6, 8], "-", {}),
    ):
        got = vocab.decoded(df, "k", "ids", pieces, special, between, most)
        assert {r.k: r.text for r in got.collect()} == {0: "", 1: "", 2: None, 3: "", 4: "", 5: ""} | want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and ("Generate" in plan) == (most < 0)


def test_dictionaries_of_several_maps_and_of_one_over_many_lines(spark, tmp_path):
    df = spark.createDataFrame([(f"w{i}", i) for i in range(50)] + [("w7", 3), (None, 1)], "lemma string, id int")
    delimited.write_dictionary(df, "lemma", "id", f"{tmp_path}/d", entries=9)
    assert sorted(map(tuple, delimited.read_dictionary(spark, f"{tmp_path}/d", "k", "v").collect())) == sorted((f"w{i}", i) for i in range(50))
    (tmp_path / "one.json").write_text('{\n "a": 1,\n "b": 2\n}\n')
    assert sorted(map(tuple, delimited.read_dictionary(spark, f"{tmp_path}/one.json", "k", "v").collect())) == [("a", 1), ("b", 2)]


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Fake())


def test_checkpoints_are_pruned(spark, tmp_path):
    names = ["m_result_checkpoint_3_bleu4_0.25.pt", "m_result_checkpoint_7_bleu4_0.31.pt", "latest_checkpoint_120.pt", "latest_checkpoint_95.pt", "notes.txt"]
    for n in names:
        (tmp_path / n).write_text("x")
    got = {r.path.rsplit("/", 1)[1]: r.kept for r in control.prune_checkpoints(spark, str(tmp_path)).collect()}
    assert got == {names[0]: False, names[1]: True, names[2]: True, names[3]: False}
    assert {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {names[1], names[2], names[4]}


def test_events_fire_their_handlers():
    seen = []
    events = control.Events()
    events.add("epoch", lambda s: seen.append(("all", s)))
    events.add("epoch", lambda s: seen.append(("second", s)), every=2)
    for i in range(3):
        events.fire("epoch", i)
    events.fire("other")
    assert seen == [("all", 0), ("all", 1), ("second", 1), ("all", 2)]


def test_sources_by_name(spark, tmp_path):
    spark.createDataFrame([("a", "dev"), ("b", "train")], "name string, split string").write.parquet(f"{tmp_path}/t")
    df, info = sources.load(spark, "parquet", path=f"{tmp_path}/t", split="dev")
    assert [r.name for r in df.collect()] == ["a"] and info["split"] == "dev"
    with pytest.raises(KeyError):
        sources.load(spark, "no_such_source_module")
    with pytest.raises(ValueError):
        sources.register("parquet")(lambda spark: None)


def test_rows_at_and_vectors(spark, tmp_path):
    rows = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id int, row array<double>")
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, pos int")
    assert {r.k: r.row for r in vocab.rows_at(df, "pos", rows, "id").collect()} == {"a": [2.0], "b": None}
    with pytest.raises(Exception, match="no such row"):
        vocab.rows_at(df.withColumn("pos", F.lit(7)), "pos", rows, "id").collect()
    (tmp_path / "v.vec").write_text("3 2\nwind 0.5 1.5\nregen -1 2\n\n")
    v = delimited.read_vectors(spark, f"{tmp_path}/v.vec")
    assert {r.word: r.vec for r in v.collect()} == {"wind": [0.5, 1.5], "regen": [-1.0, 2.0]}
    ids = spark.createDataFrame([("wind", 0), ("nord", 1)], "lemma string, id int")
    assert {r.lemma: r.vec for r in vocab.vocabulary_vectors(ids, v).collect()} == {"wind": [0.5, 1.5], "nord": [0.0, 0.0]}
