"""A store of video frames: a table of frames by video and ordinal, and one of their numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.session import materialize, scratch

BUCKETS = 64
#: Frames per file at most.
MAX_ROWS = 100_000


def bucket(video: str = "video_id"):
    return F.pmod(F.xxhash64(video), F.lit(BUCKETS)).cast("int")


def write_store(frames: DataFrame, path: str) -> None:
    """Write ``frames (video_id, frame_no, jpeg)`` and the count of each video.

    Frames are laid in folders by a hash of their video and sorted by video and
    ordinal, so that a video's frames are read from one folder and few row
    groups; a folder per video would be one small file each. Rows are dealt by
    range, so a folder, or a long video, may be the work of many tasks. The
    committer publishes whole files.
    """
    laid = frames.withColumn("bucket", bucket()).repartitionByRange("bucket", "video_id", "frame_no").sortWithinPartitions("bucket", "video_id", "frame_no")
    laid.write.option("maxRecordsPerFile", MAX_ROWS).partitionBy("bucket").parquet(f"{path}/frames")
    counts = frames.groupBy("video_id").agg(F.count("*").cast("int").alias("num_frames"))
    counts.write.parquet(f"{path}/details")


def details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/details")


#: Most bytes of a selection that are sent to every task at once.
SELECTED_BYTES = 32 << 20


def select_frames(store: DataFrame, selection: DataFrame, most: int = SELECTED_BYTES) -> DataFrame:
    """``(video_id, frame_no, jpeg)`` of ``selection (video_id, ordinals array<int>)``; ordinals that the store lacks are left out, repeated ones come once.

    The selection is written to the shared folder as bits, a row for up to 4,096
    ordinals of a video. One of up to ``most`` bytes is sent to every task; more,
    in rounds over the store's folders, each read once, whose frames are written
    to the shared folder. What alone is larger, a folder or all of a store
    without folders, is joined by sorting. So the store is not shuffled, and
    nothing is broadcast by the size that the engine takes exploded rows to have.
    """
    columns, laid = [c for c in store.columns if c != "bucket"], "bucket" in store.columns
    picked = materialize(_picked(selection).withColumn("bucket", bucket() if laid else F.lit(0)), "selection")
    rounds: list[tuple[list[int], int]] = []
    for of, size in sorted(picked.groupBy("bucket").agg(F.sum(F.octet_length("video_id") + F.size("words") * 16 + 200)).collect()):
        if rounds and rounds[-1][1] + size <= most:
            rounds[-1] = [*rounds[-1][0], of], rounds[-1][1] + size
        else:
            rounds.append(([of], size))

    def found(buckets: list[int], size: int) -> DataFrame:
        part, some = store.where(F.col("bucket").isin(buckets)) if laid else store, picked.where(F.col("bucket").isin(buckets)).drop("bucket")
        no = F.col("frame_no")
        joined = part.withColumn("_block", F.shiftright(no, 12)).join(F.broadcast(some) if size <= most else some.hint("merge"), ["video_id", "_block"])
        bits = F.element_at("words", F.shiftright(no, 6).bitwiseAND(63).cast("int"))
        return joined.where(F.getbit(bits, no.bitwiseAND(63).cast("int")) == 1).select(columns)

    if len(rounds) < 2:
        return found(*rounds[0]) if rounds else store.select(columns).limit(0)
    path = scratch(store.sparkSession, "selected")
    for each in rounds:
        found(*each).write.mode("append").parquet(path)
    return store.sparkSession.read.schema(store.select(columns).schema).parquet(path)


def _picked(selection: DataFrame) -> DataFrame:
    """``(video_id, _block, words map<int, bigint>)``: a bit for each ordinal, 64 in a word, up to 64 words in a block."""
    each = selection.select("video_id", F.explode("ordinals").alias("no")).where("video_id is not null and no is not null")
    words = each.groupBy("video_id", F.shiftright("no", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(no & 63 AS int))")).alias("bits"))
    return words.groupBy("video_id", F.shiftright("word", 6).alias("_block")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(63).cast("int"), "bits"))).alias("words"))


def decode_videos(videos: DataFrame, decode: Callable[[bytes], Iterable[bytes]]) -> DataFrame:
    """``(video_id, frame_no, jpeg)``: the frames that ``decode`` gives for the ``content`` of each ``(video_id, content)``, in Arrow batches of bounded size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for video, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held: list[tuple[int, bytes]] = []
                for no, jpeg in enumerate(decode(content) if content is not None else ()):
                    held.append((no, jpeg))
                    if len(held) == 123:
                        yield _frames(video, held)
                        held = []
                if held:
                    yield _frames(video, held)

    return videos.select("video_id", "content").mapInArrow(run, "video_id string, frame_no int, jpeg binary")


def _frames(video: str, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([video] * len(held), pa.string()), pa.array([n for n, _ in held], pa.int32()), pa.array([j for _, j in held], pa.binary())], names=["video_id", "frame_no", "jpeg"])
