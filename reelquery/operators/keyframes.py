"""Keyframes: sub-sampling, similarity groups, medoids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import cosine, dot, frame_number, normalize


def sample_step(fps: float, sample_fps: float, target_fps: float = 25.0) -> int:
    fps = fps if fps > 0 else target_fps
    return max(1, round(fps / sample_fps)) if 0 < sample_fps < fps else 1


def sample(frames: DataFrame, step: int, frame_col: str = "frame_idx") -> DataFrame:
    return frames.where(F.col(frame_col) % step == 0)


def groups(frames: DataFrame, threshold: float = 0.65) -> DataFrame:
    """A new group starts where a frame's similarity to the one before is below the threshold."""
    w = Window.partitionBy("segment_id").orderBy("pos")
    sim = cosine(F.lag("vec").over(w), F.col("vec"))
    d = frames.withColumn("sim", F.when(F.lag("pos").over(w).isNotNull(), F.round(sim, 9)))
    return d.withColumn("group_id", F.sum(F.when(F.col("sim") < threshold, 1).otherwise(0)).over(w).cast("long"))


def candidates(grouped: DataFrame, most: int = 10) -> DataFrame:
    """At most `most` evenly spaced frames of each group, ends included."""
    w = Window.partitionBy("segment_id", "group_id")
    d = grouped.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("pos")) - 1}).withColumn("k", F.least("n", F.lit(most)))
    spaced = F.exists(F.sequence(F.lit(0), F.lit(most - 1)), lambda j: (j < F.col("k")) & (F.floor(j * (F.col("n") - 1) / F.greatest(F.col("k") - 1, F.lit(1))) == F.col("i")))
    return d.where((F.col("n") == 1) | spaced)


def medoids(grouped: DataFrame, most: int = 10) -> DataFrame:
    """The candidate of each group with the largest mean similarity to the others; the first at ties.

    A group has at most `most` candidates, so they are held in one array and compared there: one shuffle by
    segment, and no self-join.
    """
    c = candidates(grouped, most).withColumn("unit", normalize(F.col("vec")))
    g = c.groupBy("segment_id", "group_id").agg(F.first("n").alias("num_frames"), F.sort_array(F.collect_list(F.struct("pos", "frame_idx", "unit"))).alias("cs"))
    total = lambda x: F.round(F.aggregate("cs", F.lit(0.0), lambda s, y: s + dot(x["unit"], y["unit"])), 9)
    scored = F.transform("cs", lambda x: F.struct(total(x).alias("s"), (-x["pos"]).alias("p"), x["frame_idx"].alias("f")))
    return g.withColumn("best", F.array_max(scored)).select("segment_id", "group_id", F.col("num_frames").cast("long").alias("num_frames"), (-F.col("best.p")).alias("pos"), F.col("best.f").alias("frame_idx"))


def keyframe_table(grouped: DataFrame, segments: DataFrame, most: int = 10) -> DataFrame:
    """Groups with local and global frames; segments: (segment_id, global_start_frame)."""
    ends = grouped.groupBy("segment_id", "group_id").agg(F.min("frame_idx").alias("local_start_frame"), F.max("frame_idx").alias("local_end_frame"))
    m = medoids(grouped, most).withColumnRenamed("frame_idx", "local_keyframe").drop("pos")
    d = ends.join(m, ["segment_id", "group_id"]).join(segments, "segment_id")
    for name in ("start_frame", "end_frame", "keyframe"):
        d = d.withColumn(f"global_{name}", F.col("global_start_frame_of_segment") + F.col(f"local_{name}"))
    return d.drop("global_start_frame_of_segment").withColumn("image_path", F.concat("segment_id", F.lit("/keyframe_"), F.lpad(F.col("local_keyframe").cast("string"), 8, "0"), F.lit(".jpg")))


def running_offset(clips: DataFrame, partition: str, order: str, count: str) -> DataFrame:
    """The sum of the counts of all clips before."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return clips.withColumn("offset", F.coalesce(F.sum(count).over(w), F.lit(0)))


def frame_from_name(name):
    """The number at the end of a file's stem; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"(\d+)\.[^.]*$", 1), F.lit("")).cast("long")


def clip_frames(seconds, fps):
    return frame_number(seconds * fps)
