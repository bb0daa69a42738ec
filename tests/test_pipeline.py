"""The staged ingest with stand-ins in all slots."""

import math

import pytest
from pyspark.sql import functions as F

from reelquery.config import Settings
from reelquery.operators import slots
from reelquery.plans import pipeline

RATE = 16_000
SMALL = Settings(vector_size=64)


def vad(row):
    """Two regions a video with a silence from 4 to 6 seconds; in a segment one region, its second one too short."""
    if row["segment_id"] is None:
        return {"regions": [{"start_sample": RATE, "end_sample": 4 * RATE}, {"start_sample": 6 * RATE, "end_sample": 9 * RATE}]}
    if row["segment_id"] == "b_seg001":
        return {"regions": []}
    return {"regions": [{"start_sample": RATE, "end_sample": 3 * RATE}, {"start_sample": 4 * RATE, "end_sample": 4 * RATE + 100}]}


def asr(row):
    if row["given"] is not None:
        return {"logps": [math.log(0.8), math.log(0.8)]}
    assert row["to_sample"] - row["from_sample"] == 2 * RATE
    return {"text": "hello there.", "words": [{"text": " hello", "rel_start": 0.0, "rel_end": 0.5}, {"text": " there.", "rel_start": 0.5, "rel_end": None}]}


def diarize(row):
    return {"turns": [{"start_sec": 0.0, "end_sec": 5.0, "speaker": "S1"}]}


def codec(row):
    stop = row["to_frame"] if row["to_frame"] is not None else 125
    return {"frames": [{"frame_idx": k, "image": bytes([k])} for k in range(row["from_frame"], stop)]}


def frame_encoder(row):
    return {"vec": [1.0, 0.0] if row["frame_idx"] < 60 else [0.0, 1.0]}


def image_encoder(row):
    v = [0.0] * 64
    v[row["image"][0] % 64] = 1.0
    return {"vector": v}


@pytest.fixture
def models():
    before = dict(slots.REGISTRY)
    slots.register_stand_ins()
    slots.register("vad", lambda: vad, "regions array<struct<start_sample: bigint, end_sample: bigint>>")
    slots.register("asr", lambda: asr, "text string, words array<struct<text: string, rel_start: double, rel_end: double>>, logps array<double>")
    slots.register("diarize", lambda: diarize, "turns array<struct<start_sec: double, end_sec: double, speaker: string>>")
    slots.register("codec", lambda: codec, "frames array<struct<frame_idx: bigint, image: binary>>")
    slots.register("frame_encoder", lambda: frame_encoder, "vec array<float>")
    slots.register("image_encoder", lambda: image_encoder, "vector array<float>")
    yield
    slots.REGISTRY.clear()
    slots.REGISTRY.update(before)


def videos(spark, *names):
    return spark.createDataFrame([(n, 250_000) for n in names], "video_id string, length long")  # 250 frames, ten seconds


def test_all_stages(spark, tmp_path, models):
    out = f"file://{tmp_path}/out"
    log = {r.stage: (r.status, r.row_count, r.errors) for r in pipeline.run(spark, videos(spark, "a", "b"), out, Settings(embed_transcripts=True, vector_size=64), batch_size=1).collect()}
    assert log == {"segments": ("COMPLETED", 4, 0), "transcripts": ("COMPLETED", 4, 0), "keyframes": ("COMPLETED", 8, 0), "captions": ("COMPLETED", 4, 0), "embed": ("COMPLETED", 15, 0), "ingest": ("COMPLETED", 15, 0)}
    said = {r.segment_id: r for r in spark.read.parquet(f"{out}/transcripts").collect()}
    assert {k: r.full_text for k, r in said.items()} == {"a_seg000": "hello there.", "a_seg001": "hello there.", "b_seg000": "hello there.", "b_seg001": ""}
    (turn,) = said["a_seg001"].turns
    (sentence,) = turn.sentences
    assert (turn.speaker, turn.start, turn.end, sentence.confidence, sentence.quality) == ("S1", 1.0, 3.0, 0.8, "RELIABLE")
    assert said["b_seg001"].turns == []
    shown = {(r.segment_id, r.group_id): (r.local_start_frame, r.local_end_frame, r.global_keyframe, r.image) for r in spark.read.parquet(f"{out}/keyframes").collect()}
    assert shown["a_seg001", 0] == (0, 58, 125, bytes([0])) and shown["a_seg001", 1] == (60, 124, 185, bytes([60]))
    points = spark.read.parquet(f"{out}/ingest")
    assert {(r.collection, r.point_type): r["count"] for r in points.groupBy("collection", "point_type").count().collect()} == {("kf", "keyframe"): 8, ("cap", "caption"): 4, ("cap", "transcript"): 3}
    assert points.select("point_id").distinct().count() == 15 and points.where(F.expr("exists(vector, x -> x <> 0)")).count() == 15


def test_failed_segments_are_tried_again(spark, tmp_path, models):
    out = f"file://{tmp_path}/out"

    def broken(row):
        if row["segment_id"] == "a_seg001":
            raise ValueError("no frames")
        return codec(row)

    slots.register("codec", lambda: broken, "frames array<struct<frame_idx: bigint, image: binary>>")
    log = {r.stage: (r.row_count, r.errors) for r in pipeline.run(spark, videos(spark, "a"), out, SMALL).collect()}
    assert log["keyframes"] == (2, 1) and log["ingest"] == (4, 0)
    slots.register("codec", lambda: codec, "frames array<struct<frame_idx: bigint, image: binary>>")
    log = {r.stage: (r.row_count, r.errors) for r in pipeline.run(spark, videos(spark, "a"), out, SMALL).collect()}
    assert log["keyframes"] == (4, 0) and log["transcripts"] == (2, 0) and log["ingest"] == (6, 0)


def test_stages_without_models_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="keyframes needs the slots codec, frame_encoder, image_encoder"):
        pipeline.run(spark, videos(spark, "a"), f"file://{tmp_path}/out", stage="keyframe")
    with pytest.warns(UserWarning, match="transcripts is left out"):
        pipeline.run(spark, videos(spark, "a"), f"file://{tmp_path}/out")


def test_speech_table_stands_for_vad(spark, tmp_path, models):
    del slots.REGISTRY["vad"]
    speech = spark.createDataFrame([("a", 0, RATE, 3 * RATE), ("a", 1, 7 * RATE, 9 * RATE)], "video_id string, idx long, start_sample long, end_sample long")
    pipeline.run(spark, videos(spark, "a"), f"file://{tmp_path}/out", SMALL, strict=True, speech=speech)
    got = {r.segment_id: (r.full_text, r.turns[0].start) for r in spark.read.parquet(f"file://{tmp_path}/out/transcripts").collect()}
    assert got == {"a_seg000": ("hello there.", 1.0), "a_seg001": ("hello there.", 2.0)}


def test_force_replaces_its_own_videos_only(spark, tmp_path, models):
    out = f"file://{tmp_path}/out"
    pipeline.run(spark, videos(spark, "007", "b"), out, SMALL)
    before = {r.video_id: r["count"] for r in spark.read.schema("video_id string, point_id string").parquet(f"{out}/ingest").groupBy("video_id").count().collect()}
    log = {r.stage: (r.status, r.row_count) for r in pipeline.run(spark, videos(spark, "007"), out, SMALL, force=True).collect()}
    after = {r.video_id: r["count"] for r in spark.read.schema("video_id string, point_id string").parquet(f"{out}/ingest").groupBy("video_id").count().collect()}
    assert before == after and set(after) == {"007", "b"} and log["ingest"] == ("COMPLETED", sum(after.values()))


def test_vectors_of_another_size_are_errors(spark, tmp_path, models):
    out = f"file://{tmp_path}/out"
    log = {r.stage: (r.status, r.row_count, r.errors) for r in pipeline.run(spark, videos(spark, "a"), out, Settings(vector_size=63)).collect()}
    assert log["ingest"] == ("COMPLETED", 0, 6)
    assert {r.error for r in spark.read.parquet(f"{out}/ingest_errors").collect()} == {"vector has dimension 64"}
    log = {r.stage: (r.status, r.row_count, r.errors) for r in pipeline.run(spark, videos(spark, "a"), out, SMALL).collect()}
    assert log["ingest"] == ("COMPLETED", 6, 0) and spark.read.parquet(f"{out}/ingest_errors").count() == 0


def test_errors_of_other_videos_stay(spark, tmp_path, models):
    out = f"file://{tmp_path}/out"

    def broken(row):
        raise ValueError("no frames")

    slots.register("codec", lambda: broken, "frames array<struct<frame_idx: bigint, image: binary>>")
    pipeline.run(spark, videos(spark, "a"), out, SMALL)
    slots.register("codec", lambda: codec, "frames array<struct<frame_idx: bigint, image: binary>>")
    pipeline.run(spark, videos(spark, "b"), out, SMALL)
    assert {r.video_id for r in spark.read.parquet(f"{out}/keyframes_errors").collect()} == {"a"}
    pipeline.run(spark, videos(spark, "a"), out, SMALL)
    assert spark.read.parquet(f"{out}/keyframes_errors").count() == 0


def test_skip_and_cleanup(spark, tmp_path, models):
    cut = tmp_path / "cut"
    for v in ("a", "z"):
        (cut / v / "segments").mkdir(parents=True)
        (cut / v / "segments" / "s.mp4").write_bytes(b"x")
        (cut / v / "segments" / "s.m4a").write_bytes(b"x")
    log = pipeline.run(spark, videos(spark, "a"), f"file://{tmp_path}/out", SMALL, stage="all", skip=("transcripts",), cleanup=f"file://{cut}").collect()
    assert "transcripts" not in {r.stage for r in log}
    assert sorted(str(p.relative_to(cut)) for p in cut.rglob("*.m*")) == ["a/segments/s.m4a", "z/segments/s.m4a", "z/segments/s.mp4"]


def test_models_load_once_a_worker_and_take_batches(spark, tmp_path):
    marks = tmp_path / "loads"
    marks.mkdir()

    def factory():
        import os
        import uuid

        (marks / f"{os.getpid()}-{uuid.uuid4().hex}").touch()

        def model(batch):
            if 7 in batch.column("k").to_pylist():
                raise ValueError("seven")
            return {"caption": [str(x) for x in batch.column("k").to_pylist()]}

        return model

    slot = slots.Slot(factory, "caption string", batch=True)
    rows = spark.range(40).withColumnRenamed("id", "k").repartition(8)
    got = {r.k: (r.caption, r.error) for r in slots.apply("captioner", rows, slot).collect()}
    assert got == {k: (str(k), None) if k != 7 else (None, "ValueError: seven") for k in range(40)}
    slots.apply("captioner", rows, slot).collect()
    loads = [p.name.split("-")[0] for p in marks.iterdir()]
    assert len(loads) == len(set(loads))
    before = dict(slots.REGISTRY)
    try:
        slots.REGISTRY["captioner"] = slot
        assert {r.slot: r.status for r in slots.check(spark, ("captioner", "vad")).collect()} == {"captioner": "loaded", "vad": "not registered" if "vad" not in before else "loaded"}
    finally:
        slots.REGISTRY.clear()
        slots.REGISTRY.update(before)
