"""Search semantics on hand-made points."""

import itertools
import random

import pytest

from reelquery.operators import search as S

COLUMNS = "collection string, point_id string, point_type string, video_id string, segment_id string, frame_index long, start_time_sec double, end_time_sec double, image_path string, text string, vector array<float>"


def point(pid, score, collection="kf", kind="keyframe", video="v", segment="s", frame=1, image=None, text=None):
    """Cosine with (1, 0) is the score."""
    return (collection, pid, kind, video, segment, frame, 0.0, 1.0, image, text, [float(score), float((1 - score * score) ** 0.5)])


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_every_hit_of_a_segment_adds_to_its_rank(spark):
    p = table(spark, [point("a", 0.9, segment="x"), point("b", 0.8, segment="y", frame=7), point("c", 0.7, segment="y", frame=8), point("d", 0.6, "cap", "caption", segment="y", text="hello")])
    rows = S.kis(p, [1.0, 0.0], ["kf"], ["cap"]).orderBy("rank").collect()
    assert [r.segment_id for r in rows] == ["y", "x"]
    assert rows[0].rrf_score == pytest.approx(1 / 62 + 1 / 63 + 1 / 61, abs=1e-6)
    assert (rows[0].frame_index, rows[0].text, rows[0].sources, rows[0].score) == (7, "hello", "cap,kf", 0.8)


def test_text_makes_a_hit_a_caption_and_null_segments_group(spark):
    p = table(spark, [point("a", 0.9, "cap", "transcript", segment=None, text="t"), point("b", 0.5, "cap", "caption", segment=None, text="u")])
    (row,) = S.kis(p, [1.0, 0.0], ["kf"], ["cap"]).collect()
    assert (row.keyframe_score, row.caption_score, row.text, row.image_path) == (None, pytest.approx(0.9), "t", None)


def test_points_of_another_dimension_are_no_hits(spark):
    p = table(spark, [point("a", 0.9), point("b", 0.8)[:-1] + ([1.0],), point("c", 0.8)[:-1] + (None,)])
    for engine in ("native", "arrow"):
        assert [r.point_id for r in S.knn(p, [[1.0, 0.0]], 5, engine).collect()] == ["a"]


def test_empty_collections(spark):
    p = table(spark, [])
    assert S.kis(p, [1.0, 0.0], ["kf"], ["cap"]).count() == 0
    assert S.trake(p, [], ["kf"]).count() == 0


def brute(rows, steps):
    """The best strictly rising chain of each video, by trying all."""
    out = {}
    for video in {r[0] for r in rows}:
        best = None
        for chain in itertools.product(*[[r for r in rows if r[0] == video and r[1] == k] for k in range(steps)]):
            if all(a[2] < b[2] for a, b in itertools.pairwise(chain)):
                total = sum(r[3] for r in chain)
                best = total if best is None else max(best, total)
        if best is not None:
            out[video] = round(best, 4)
    return out


def test_sequences_match_brute_force(spark):
    rng = random.Random(3)
    vectors = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    points, rows = [], []
    for k in range(40):
        raw = [round(rng.random(), 1) + 0.05 for _ in range(3)]
        n = sum(x * x for x in raw) ** 0.5
        video, frame = f"v{k % 3}", rng.randrange(12)
        points.append(("kf", f"{k:03d}", "keyframe", video, "s", frame, 0.0, 1.0, None, None, raw))
        rows += [(video, step, frame, raw[step] / n) for step in range(3)]
    got = {r.video_id: r.total_score for r in S.trake(table(spark, points), vectors, ["kf"]).collect()}
    assert got == pytest.approx(brute(rows, 3), abs=2e-4)


def test_equal_frames_make_no_sequence(spark):
    p = table(spark, [point("a", 0.9, frame=5), point("b", 0.8, frame=5)])
    assert S.trake(p, [[1.0, 0.0], [0.0, 1.0]], ["kf"]).count() == 0


def test_search_by_text(spark):
    from reelquery.operators.slots import embed_texts, register_stand_ins
    from reelquery.plans.search import search

    register_stand_ins()

    rows = [("kf", "a", "keyframe", "v", "s1", 1, 0.0, 1.0, "a.jpg", None, "a red car"), ("cap", "b", "caption", "v", "s2", 9, 1.0, 2.0, None, "blue sea", "blue sea")]
    texts = spark.createDataFrame(rows, COLUMNS.replace("vector array<float>", "t string"))
    points = embed_texts(texts.drop("text"), "t").withColumnRenamed("text", "said").join(texts.select("point_id", "text"), "point_id").select(*[c.split()[0] for c in COLUMNS.split(", ")])
    assert {r.segment_id: r.score for r in search(points, ["blue", "sea"]).collect()}["s2"] == 1.0
    assert search(points, ["a red car"], "flat").first().video_id == "v"
    assert search(points, ["red car"], "trake").first().frame_index == 1
