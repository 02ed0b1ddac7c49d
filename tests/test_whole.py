"""Queries give all of their tables, not the first part of them."""

import json

from glossmill.plans import registry

QUERIES, ORACLES = registry.collect()


def ids(text):
    return [ord(c) for c in text]


def joined(values):
    return ",".join(map(str, values))


def test_shift_takes_whole_sentences(spark, tmp_path):
    texts = ["morgen, im norden, regen bei zwölf grad und 日本 🌧", "x" * 200, "a", "", None]
    spark.createDataFrame(list(enumerate(texts)), "rec_id bigint, translation string").write.parquet(f"{tmp_path}/corpus_b.parquet")
    got = {r.rec_id: r for r in QUERIES["teacher_shift"](spark, str(tmp_path)).collect()}
    assert {i: (r.inputs, r.targets) for i, r in got.items()} == {i: (joined(ids(t)[:-1]), joined(ids(t)[1:])) for i, t in enumerate(texts[:-1])}
    assert {r.rec_id: r.ids for r in QUERIES["until_end"](spark, str(tmp_path)).collect()} == {i: joined(ids(t)) for i, t in enumerate(texts[:-1])}
    assert {r.rec_id: r.ids for r in QUERIES["truncated_ids"](spark, str(tmp_path)).collect()} == {i: joined(ids(t)[:64]) for i, t in enumerate(texts[:-1])}


def test_every_line_gives_its_fields(spark, tmp_path):
    texts = ["a\tb\tc\nd\n\n\te\n", "x\ty", "\n", "z\n\n", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["separated_fields"](spark, str(tmp_path)).collect()))
    assert got == [(0, 0, "a", "b"), (0, 1, "d", None), (0, 2, "", None), (0, 3, "", "e"), (1, 0, "x", "y"), (2, 0, "", None), (3, 0, "z", None), (3, 1, "", None)]


def test_samples_of_all_splits(spark, tmp_path):
    rows = [(i, f"n{i}", "REGEN  NORD", f'"{i}"', split) for i, split in enumerate(["train", "dev", "test", None])] + [(4, "n4", None, None, "train")]
    spark.createDataFrame(rows, "rec_id bigint, name string, orth string, translation string, split string").write.parquet(f"{tmp_path}/corpus_b.parquet")
    got = {r.rec_id: (json.loads(r.sample), r.n_glosses) for r in QUERIES["sample_projection"](spark, str(tmp_path)).collect()}
    assert got == {i: ({"rec_id": i, "sentence": f'"{i}"', "file_name": f"n{i}"}, 3) for i in range(4)} | {4: ({"rec_id": 4, "file_name": "n4"}, None)}


def test_chinese_tokens_of_all_documents(spark, tmp_path):
    rows = [(i, "今天ok，3.5", lang) for i, lang in enumerate(["zh", "de", "en", None])] + [(4, "wind, regen", "de"), (5, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.tokens for r in QUERIES["tokenize_zh"](spark, str(tmp_path)).collect()}
    assert got == {i: "今 天 ok ， 3.5" for i in range(4)} | {4: "wind , regen", 5: None}


def test_padding_cuts_nothing(spark, tmp_path):
    spark.createDataFrame([("a", 457), ("b", 3), ("c", None)], "video_id string, num_frames bigint").write.parquet(f"{tmp_path}/frame_meta.parquet")
    got = {r.video_id: (r.padded, r.n_valid) for r in QUERIES["pad_mask"](spark, str(tmp_path)).collect()}
    assert got == {"a": (joined(range(0, 457, 2)), 229), "b": (joined([0, 2] + [0] * 227), 2), "c": (joined([0] * 229), 0)}


def test_every_position_is_located(spark, tmp_path):
    for name, n in (("corpus_a", 3), ("corpus_b", 0), ("documents", 2)):
        spark.range(n).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.idx: (r.member, r.local_idx) for r in QUERIES["locate_ordinals"](spark, str(tmp_path)).collect()}
    all_of = [("corpus_a", 0), ("corpus_a", 1), ("corpus_a", 2), ("documents", 0), ("documents", 1)]
    assert got == dict(enumerate(all_of)) | dict(enumerate(all_of, -5)) | {5: (None, None), -6: (None, None)}
