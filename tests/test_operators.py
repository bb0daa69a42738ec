"""Edge cases of the other operators: thresholds met exactly, ties, nulls, empty inputs."""

import uuid

import pytest
from pyspark.sql import functions as F

from reelquery.config import Settings, parse_collections
from reelquery.functions import exprs as X
from reelquery.operators import keyframes as K
from reelquery.operators import segments as G
from reelquery.operators import slots
from reelquery.operators import store as P
from reelquery.operators import transcript as R
from reelquery.sources import files

WORDS = "segment_id string, word_no long, start_sec double, end_sec double, text string, speaker string"


def test_quality_limits(spark):
    d = spark.createDataFrame([(k, c) for k, c in enumerate([None, 0.4999, 0.50, 0.6999, 0.70, 1.0])], "k int, c double")
    assert [r.q for r in d.orderBy("k").select(X.quality(F.col("c")).alias("q")).collect()] == ["REVIEW", "NCR", "REVIEW", "REVIEW", "RELIABLE", "RELIABLE"]


def test_clean_text(spark):
    d = spark.createDataFrame([("a \tb \n , c !",), (None,), ("  ",)], "t string")
    assert [r.t for r in d.select(X.clean_text(F.col("t")).alias("t")).collect()] == ["a b, c!", None, ""]


def test_uuid5(spark):
    names = ["v_s_kf_1", "é", ""]
    d = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.u for r in d.select(X.uuid5(X.DNS, F.col("n")).alias("u")).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def sentences(spark, words):
    d = spark.createDataFrame([("s", k, *w) for k, w in enumerate(words)], WORDS)
    return [(r.text, r.word_count) for r in R.sentences(d, ["segment_id"]).orderBy("sent_no").collect()]


def test_sentence_rules(spark):
    assert sentences(spark, [(0.0, 1.0, " a", "x"), (1.85, 2.0, " b", "x")]) == [("a", 1), ("b", 1)]  # a pause of exactly 0.85
    assert sentences(spark, [(0.0, 1.0, " a", "x"), (1.84, 2.0, " b", "x")]) == [("a b", 2)]
    assert sentences(spark, [(0.0, 1.0, " a", "x"), (1.0, 2.0, " b", None), (2.0, 3.0, " c", "y")]) == [("a b c", 3)]  # one side without a speaker
    assert sentences(spark, [(0.0, 1.0, ' a."', "x"), (1.0, 2.0, " b…", "x"), (2.0, 3.0, " c.)", "x")]) == [('a."', 1), ("b…", 1), ("c.)", 1)]
    assert sentences(spark, [(0.0, 9.0, " a", "x"), (9.0, 18.0, " b", "x"), (18.0, 19.0, " c", "x")]) == [("a b", 2), ("c", 1)]  # a span of exactly 18
    assert sentences(spark, [(0.0, 1.0, "  ", "x")]) == []


def test_turn_rules(spark):
    rows = [("s", 0, 0.0, 1.0, "A"), ("s", 2, 4.0, 5.0, "A"), ("s", 1, 2.5, 3.0, "A"), ("s", 3, 6.51, 7.0, "A"), ("s", 4, 7.0, 7.5, "B"), ("s", 5, 7.0, 7.2, "B")]
    d = spark.createDataFrame(rows, "segment_id string, sent_no long, start_sec double, end_sec double, speaker string")
    d = d.withColumns({"text": F.lit("t"), "confidence": F.lit(None).cast("double")})
    got = [(r.speaker, r.start, r.end, len(r.sentences)) for r in R.turns(d).orderBy("turn_no").collect()]
    assert got == [("A", 0.0, 5.0, 3), ("A", 6.51, 7.0, 1), ("B", 7.0, 7.5, 2)]


def test_speakers(spark):
    words = spark.createDataFrame([("s", 0, 0.0, 2.0), ("s", 1, 5.0, 5.2), ("s", 2, 9.0, 9.5), ("t", 0, 0.0, 1.0)], "segment_id string, word_no long, start_sec double, end_sec double")
    turns = spark.createDataFrame([("s", 0, 0.0, 1.0, "A"), ("s", 1, 1.0, 2.0, "B"), ("s", 2, 4.0, 4.9, "C"), ("s", 3, 5.3, 6.0, "D")], "segment_id string, turn_no long, start_sec double, end_sec double, speaker string")
    got = {(r.segment_id, r.word_no): r.speaker for r in R.assign_speaker(words, turns).collect()}
    assert got == {("s", 0): "B", ("s", 1): "C", ("s", 2): "D", ("t", 0): "UNKNOWN"}


@pytest.mark.parametrize(("n", "want"), [(1, [0]), (2, [0, 1]), (10, list(range(10))), (11, [0, 1, 2, 3, 4, 5, 6, 7, 8, 10]), (100, [0, 11, 22, 33, 44, 55, 66, 77, 88, 99])])
def test_spaced_candidates(spark, n, want):
    d = spark.range(n).select(F.lit("s").alias("segment_id"), F.lit(0).alias("group_id"), F.col("id").alias("pos"))
    assert [r.pos for r in K.candidates(d).orderBy("pos").collect()] == want


def test_groups_split_only_below_the_threshold(spark):
    d = spark.createDataFrame([("s", 0, 0, [1.0, 0.0]), ("s", 1, 1, [0.65, 1 - 0.65**2]), ("s", 2, 2, [0.0, 1.0])], "segment_id string, pos long, frame_idx long, vec array<double>")
    unit = d.withColumn("vec", X.normalize(F.col("vec")))
    sim = [r.sim for r in K.groups(unit, 0.0).orderBy("pos").collect()]
    assert [r.group_id for r in K.groups(unit, sim[1]).orderBy("pos").collect()][:2] == [0, 0]
    assert [r.group_id for r in K.groups(unit, sim[1] + 1e-6).orderBy("pos").collect()][:2] == [0, 1]


def test_equal_medoids_take_the_first(spark):
    d = spark.createDataFrame([("s", k, k, [1.0, 0.0], 0) for k in range(3)], "segment_id string, pos long, frame_idx long, vec array<float>, group_id long")
    (m,) = K.medoids(d).collect()
    assert (m.pos, m.num_frames) == (0, 3)


def test_segments_without_splits_and_open_ends(spark):
    videos = spark.createDataFrame([("a", 10.0, 25.0), ("b", -1.0, 25.0)], "video_id string, duration_sec double, fps double")
    speech = spark.createDataFrame([("a", 0, 0, 16000), ("a", 1, 48000, 64000), ("b", 0, 0, 5)], "video_id string, idx long, start_sample long, end_sample long")
    got = [(r.segment_id, r.start_time_sec, r.end_time_sec, r.duration_sec, r.global_start_frame) for r in G.segments(G.split_points(speech), videos).orderBy("segment_id").collect()]
    assert got == [("a_seg000", 0.0, 2.0, 2.0, 0), ("a_seg001", 2.0, 10.0, 8.0, 50), ("b_seg000", 0.0, -1.0, -1.0, 0)]
    ids = spark.range(1).select(X.segment_id(F.lit("v"), F.lit(1234)).alias("i"))
    assert ids.first().i == "v_seg1234"


def test_upsert_replaces_and_bad_vectors_are_named(spark):
    old = spark.createDataFrame([("1", "old"), ("2", "old")], "point_id string, text string")
    new = spark.createDataFrame([("2", "new"), ("3", "new")], "point_id string, text string")
    assert {r.point_id: r.text for r in P.upsert(old, new).collect()} == {"1": "old", "2": "new", "3": "new"}
    v = spark.createDataFrame([("1", [1.0]), ("2", None)], "point_id string, vector array<float>")
    assert [bool(r.error) for r in P.check_dimension(v, 1).orderBy("point_id").collect()] == [False, True]
    with pytest.raises(ValueError):
        P.merge({"v1": None}, "m")


def test_suffixes_are_taken_as_written(spark):
    d = spark.createDataFrame([("/a/1.mp4",), ("/a/2.AVI",), ("/a/3.MKV",), ("/a/4.txt",)], "path string")
    assert [r.video_id for r in files.discover(d).collect()] == ["1", "3"]


def test_slot_errors_stay_with_their_row(spark):
    def factory():
        def model(row):
            if row["k"] == 1:
                raise ValueError("bad")
            return {"caption": str(row["k"])}

        return model

    before = dict(slots.REGISTRY)
    try:
        slots.register("captioner", factory, "caption string")
        good, errors = files.split_errors(slots.apply("captioner", spark.range(3).withColumnRenamed("id", "k")))
        assert sorted(r.caption for r in good.collect()) == ["0", "2"]
        assert [r.error for r in errors.collect()] == ["ValueError: bad"]
    finally:
        slots.REGISTRY.update(before)


def test_staged_run_resumes(spark, tmp_path):
    from reelquery.plans import pipeline

    slots.register_stand_ins()
    videos = spark.createDataFrame([("a", 10_000_000), ("b", 20_000_000)], "video_id string, length long")
    out = f"file://{tmp_path}/out"
    assert {r.status for r in pipeline.run(spark, videos.limit(1), out, Settings(vector_size=64)).collect()} == {"COMPLETED"}
    log = {r.stage: r.row_count for r in pipeline.run(spark, videos, out, Settings(vector_size=64)).collect()}
    assert log == {"segments": 2, "captions": 2, "embed": 2, "ingest": 2}
    with pytest.raises(ValueError):
        pipeline.run(spark, videos, out, stage="nothing")


def test_settings(monkeypatch):
    monkeypatch.setenv("RQ_RRF_K", "10")
    monkeypatch.setenv("RQ_KEYFRAME_COLLECTIONS", "a, b,,")
    s = Settings.from_env()
    assert (s.rrf_k, s.keyframe_collections, s.vad_min_silence_ms) == (10, ("a", "b"), 1000)
    assert parse_collections([" x ", ""]) == ("x",)
    with pytest.raises(ValueError):
        Settings(ncr_below=0.9)


def test_positions_of_wide_rows(spark):
    n = 1_000_000
    d = spark.range(n, numPartitions=7).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("k"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"), F.col("id").alias("part"), F.col("id").alias("place"))
    got = G.dense_index(d, "k")
    assert got.columns == ["k", "payload", "part", "place", "embedding_index"]
    assert got.where("k <> embedding_index").count() == 0 and got.count() == n
    chunks = G.chunks(d, "k", 1000, offset=10, limit=5000)
    assert chunks.groupBy("batch_no").count().where("count <> 1000").count() == 0 and chunks.count() == 5000
    assert G.dense_index(d.where("k < 0"), "k").count() == 0


def test_natural_order(spark):
    names = ["a10", "a9", "a09b", "A1", "a", "10", "9", "b", "a" + "1" * 22, "a" + "1" * 21, "a!", "a1"]
    import re

    key = lambda p: [int(x) if x.isdigit() else x.lower() for x in re.split(r"(\d+)", p)]
    got = [r.n for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(X.natural_key(F.col("n")), F.lower("n"), F.desc("n")).collect()]
    assert [key(n) for n in got] == sorted(map(key, names))


def test_point_ids(spark):
    rows = [("v", None, "keyframe", 1), ("v", "s", "caption", 2), ("v", "s", "transcript", 2), ("v", "s", "caption", None)]
    d = spark.createDataFrame(rows, "video_id string, segment_id string, point_type string, frame_index long")
    names = ["v__kf_1", "v_s_cap_2", "v_s_tr_2", "v_s_cap_0"]
    assert {r.point_id for r in P.with_ids(d).collect()} == {str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


def test_upsert_takes_the_last_of_a_batch(spark):
    old = spark.createDataFrame([("1", "old")], "point_id string, text string")
    new = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 1), ("2", "c", 1)], "point_id string, text string, n int")
    assert sorted((r.point_id, r.text) for r in P.upsert(old, new, order="n").collect()) == [("1", "b"), ("2", "c")]
    assert P.upsert(old, new.drop("n")).count() == 2


def test_keyframe_files_meet_groups_of_their_clip(spark):
    files_ = spark.createDataFrame([("v", "s1", 5), ("w", "s1", 5)], "video_id string, segment_id string, frame_idx long")
    groups = spark.createDataFrame([("v", "s1", 5, 0), ("w", "s1", 5, 7)], "video_id string, segment_id string, global_keyframe long, group_id long")
    assert {(r.video_id, r.group_id) for r in P.keyframe_meta(files_, groups).collect()} == {("v", 0), ("w", 7)}


def test_listings(spark, tmp_path):
    assert files.list_videos(spark, f"file://{tmp_path}/none").count() == 0
    for name in ("x/L21_V001/segment_2.mp4", "x/L21_V001/segment_10.mp4", "x/L21_V002/segment_1.mp4", "x/other.mp4", "x/L21_V002/note.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = files.list_videos(spark, f"file://{tmp_path}")
    assert [r.path.rsplit("/", 2)[1:] for r in files.clips(found).collect()] == [["L21_V001", "segment_2.mp4"], ["L21_V001", "segment_10.mp4"], ["L21_V002", "segment_1.mp4"]]
    assert files.video_root(found).endswith("/x") and files.video_root(found.where("path like '%V001%'")).endswith("/x")
    assert files.discover(found, 1, 0).count() == 3 and files.discover(found, 1, 2).count() == 2
    with pytest.raises(FileNotFoundError):
        files.video_root(found.where("false"))


def test_json_artefacts_and_sinks(spark, tmp_path):
    import json

    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.json").write_text(json.dumps({"segment_id": "s10", "video_id": "v", "caption": "é", "global_start_frame": 5}, indent=2))
    (tmp_path / "c" / "2.json").write_text(json.dumps({"segment_id": "s9", "video_id": "v", "caption": "b"}, indent=2))
    got = files.json_rows(spark, f"file://{tmp_path}/c/*.json", files.CAPTION)
    assert {(r.segment_id, r.caption, r.global_start_frame) for r in got.collect()} == {("s10", "é", 5), ("s9", "b", None)}
    assert files.json_rows(spark, f"file://{tmp_path}/none/*.json", files.CAPTION).count() == 0
    (tmp_path / "k.json").write_text(json.dumps({"segment_id": "s", "groups": [{"group_id": 0, "keyframe": 3, "global_keyframe": 9, "image_path": "i"}]}))
    assert [tuple(r) for r in files.keyframe_rows(spark, f"file://{tmp_path}/k.json").collect()] == [("s", 0, 3, 9, "i")]
    (tmp_path / "m.json").write_text(json.dumps({"video_id": "v", "segments": [{"segment_id": "s", "file_path": "f", "start_time_sec": 0.0}]}, indent=2))
    assert [r.segment_id for r in files.manifests(spark, f"file://{tmp_path}/m.json").collect()] == ["s"]
    files.write_jsonl(got, f"file://{tmp_path}/out", "segment_id")
    lines = [json.loads(line)["segment_id"] for p in sorted((tmp_path / "out").glob("part-*")) for line in p.read_text().splitlines()]
    assert lines == ["s9", "s10"]
    files.write_summary(got.select("segment_id", "caption"), f"file://{tmp_path}/csv")
    heads = {p.read_bytes().split(b"\n")[0] for p in (tmp_path / "csv").glob("part-*") if p.stat().st_size}
    assert heads == {"\ufeffsegment_id,caption".encode()}


def test_speakers_by_brute_force(spark):
    import random

    rng = random.Random(5)
    words, turns = [], []
    for s in ("a", "b"):
        for k in range(120):
            x = round(rng.uniform(0, 200), 2)
            words.append((s, k, x, round(x + rng.choice([0.0, 0.3, 4.0]), 2)))
        for k in range(25):
            x = round(rng.uniform(0, 200), 2)
            turns.append((s, k, x, round(x + rng.choice([0.0, 1.0, 30.0]), 2), rng.choice("XYZ")))
    got = {(r.segment_id, r.word_no): r.speaker for r in R.assign_speaker(spark.createDataFrame(words, "segment_id string, word_no long, start_sec double, end_sec double"), spark.createDataFrame(turns, "segment_id string, turn_no long, start_sec double, end_sec double, speaker string")).collect()}
    for s, k, a, b in words:
        own = [t for t in turns if t[0] == s]
        over = [(round(min(b, t[3]) - max(a, t[2]), 6), t[4]) for t in own]
        mid = (a + b) / 2
        far = lambda t: 0.0 if t[2] <= mid <= t[3] else round(min(abs(mid - t[2]), abs(mid - t[3])), 6)  # noqa: E731, B023
        want = max(o for o in over if o[0] > 0)[1] if any(o[0] > 0 for o in over) else min((far(t), t[1], t[4]) for t in own)[2]
        assert got[s, k] == want
