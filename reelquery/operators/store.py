"""Vector collections: gathering points, keyed upsert, merge, description, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import DNS, OID, base_name, unused, uuid5

POINT = ["collection", "point_id", "point_type", "video_id", "segment_id", "frame_index", "start_time_sec", "end_time_sec", "image_path", "text", "vector"]


def point_name(video: Column, segment: Column, frame: Column, kind: Column) -> Column:
    """What a point's id is made of. A missing part is empty and keeps its place, a missing frame is 0; transcripts are a kind of their own, as they share segment and frame with captions."""
    short = F.when(kind == "keyframe", "kf").when(kind == "transcript", "tr").otherwise("cap")
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(part(video), F.lit("_"), part(segment), F.lit("_"), short, F.lit("_"), F.coalesce(frame.cast("string"), F.lit("0")))


def with_ids(points: DataFrame) -> DataFrame:
    return points.withColumn("point_id", uuid5(DNS, point_name(F.col("video_id"), F.col("segment_id"), F.col("frame_index"), F.col("point_type"))))


def check_dimension(points: DataFrame, size: int) -> DataFrame:
    """Splits off nothing silently: rows of another dimension get an error text."""
    n = F.coalesce(F.size("vector"), F.lit(-1))
    return points.withColumn("error", F.when(n != size, F.concat(F.lit("vector has dimension "), n.cast("string"))))


def distinct_by(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row a key: the one with the greatest order (the last), or any."""
    if order is None:
        return rows.dropDuplicates([key])
    last, = unused(rows.columns, "last")
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias(last)).select(*[F.col(last)[c].alias(c) for c in rows.columns])


def upsert(old: DataFrame, new: DataFrame, key: str = "point_id", order: str | None = None) -> DataFrame:
    """New rows replace old ones of the same key; of new rows of one key the last by order stays (any, if order is None).

    One anti-join on the key: the side of keys is narrow, and vectors of old rows move only once.
    """
    one = distinct_by(new, key, order)
    return one.unionByName(old.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def dimension(points: DataFrame) -> int | None:
    """The dimension of a collection's vectors; null if it has none."""
    row = points.select(F.size("vector").alias("n")).where("n >= 0").first()
    return row.n if row else None


def merge(sources: dict[str, DataFrame | None], target: str) -> DataFrame:
    """Several collections in one: a version column, the original id, and new ids made of both. Missing sources are skipped."""
    out = None
    for version, points in sources.items():
        if points is None:
            continue
        p = points.withColumns({"version": F.lit(version), "original_id": F.col("point_id"), "collection": F.lit(target)}).withColumn("point_id", uuid5(OID, F.concat_ws("_", F.lit(version), F.col("original_id"))))
        out = p if out is None else upsert(out, p)
    if out is None:
        raise ValueError("no source collection exists")
    return out


def describe(points: DataFrame) -> DataFrame:
    """Per collection: points, dimension, distance, the payload columns in use, and one sample point."""
    payload = [c for c in points.columns if c not in ("collection", "point_id", "vector")]
    used = F.array_join(F.filter(F.array(*[F.when(F.max(F.col(c).isNotNull()), F.lit(c)) for c in sorted(payload)]), lambda x: x.isNotNull()), ",")
    return points.groupBy("collection").agg(F.count("*").alias("points"), F.max(F.size("vector")).cast("long").alias("vector_size"), F.lit("cosine").alias("distance"), used.alias("payload_keys"), F.min("point_id").alias("sample_id"))


def zip_by_position(vectors: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Vectors and metadata of equal position, for keys that hold as many of both; others are dropped whole.

    vectors: (key, vectors array), metadata: (key, items array). Only keys and sizes are compared before anything is exploded.
    """
    both = vectors.join(metadata, key).where(F.size("vectors") == F.size("items"))
    return both.select(key, F.posexplode(F.arrays_zip("vectors", "items")).alias("pos", "z")).select(key, "pos", F.col("z.vectors").alias("vector"), F.col("z.items").alias("item"))


def gather(segments: DataFrame, keyframes: DataFrame, captions: DataFrame, transcripts: DataFrame | None = None, embed_transcripts: bool = False) -> DataFrame:
    """What is to be embedded: keyframes, captions and, if asked for, transcripts, each with its segment's times."""
    s = segments.select("segment_id", "video_id", "start_time_sec", "end_time_sec", "global_start_frame")
    kf = s.join(keyframes.select("segment_id", F.col("global_keyframe").alias("frame_index"), "image_path"), "segment_id").select("video_id", "segment_id", F.lit("keyframe").alias("point_type"), "frame_index", "start_time_sec", "end_time_sec", "image_path", F.lit(None).cast("string").alias("text"))
    cap = s.join(captions.select("segment_id", F.col("caption").alias("text")), "segment_id")
    text = lambda d, kind: d.select("video_id", "segment_id", F.lit(kind).alias("point_type"), F.col("global_start_frame").alias("frame_index"), "start_time_sec", "end_time_sec", F.lit(None).cast("string").alias("image_path"), "text")
    out = kf.unionByName(text(cap.where("text <> ''"), "caption"))
    if embed_transcripts and transcripts is not None:
        out = out.unionByName(text(s.join(transcripts.select("segment_id", F.col("full_text").alias("text")), "segment_id").where("text <> ''"), "transcript"))
    return out


def caption_lookup(captions: DataFrame, segments: DataFrame) -> DataFrame:
    """Captions with their segment's first frame (the least, if a segment is there more than once), 0 where the segment is unknown."""
    starts = segments.groupBy("segment_id").agg(F.min("global_start_frame").alias("_f"))
    return captions.join(starts, "segment_id", "left").withColumn("global_start_frame", F.coalesce("_f", F.lit(0))).drop("_f")


def all_captions(captions: DataFrame) -> DataFrame:
    """The captions of a video in order of frames, as one list."""
    return captions.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("global_start_frame", "segment_id", "caption"))).alias("captions"))


def timeline_lookup(clips: DataFrame, timeline: DataFrame) -> DataFrame:
    """Each clip's entry in the source timeline by file name, or nulls."""
    return clips.withColumn("file", base_name(F.col("path"))).join(timeline, "file", "left")


def keyframe_meta(files: DataFrame, groups: DataFrame, clip: tuple[str, ...] = ("video_id", "segment_id")) -> DataFrame:
    """Keyframe files with the group whose keyframe they show: of the same clip, as frame numbers are those of a video."""
    return files.join(groups.withColumnRenamed("global_keyframe", "frame_idx"), [*clip, "frame_idx"])


def resume(work: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Work items without a valid checkpoint."""
    return work if force else work.join(done.where("valid").select(*keys).distinct(), keys, "left_anti")


def run_stats(results: DataFrame) -> DataFrame:
    """Per video: processed, skipped and failed items."""
    n = lambda s: F.count_if(F.col("status") == s)
    return results.groupBy("video_id").agg(n("processed").alias("processed"), n("skipped").alias("skipped"), n("error").alias("errors"))
