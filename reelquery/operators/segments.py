"""Segmentation of videos by silence, on tables of speech regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import frame_number, round_sec, segment_id, unused
from ..sources.shared import shared_dir


def split_points(speech: DataFrame, sample_rate: int = 16_000) -> DataFrame:
    """The middle of each silence between consecutive regions; a video of fewer than two regions has none.

    Rounded to milliseconds in whole numbers, since middles often lie exactly between two.
    """
    w = Window.partitionBy("video_id").orderBy("idx")
    both = F.col("end_sample") + F.lead("start_sample").over(w)
    return speech.select("video_id", "idx", (F.floor((both * 1000 + sample_rate) / (2 * sample_rate)) / 1000).alias("split_sec")).where("split_sec is not null")


def segments(splits: DataFrame, videos: DataFrame) -> DataFrame:
    """Segments between split points; videos: (video_id, duration_sec, fps). An open end or duration is -1.0."""
    points = videos.select("video_id", F.lit(0.0).alias("start_time_sec")).unionByName(splits.select("video_id", F.col("split_sec").alias("start_time_sec")))
    w = Window.partitionBy("video_id").orderBy("start_time_sec")
    p = points.select("video_id", "start_time_sec", (F.row_number().over(w) - 1).alias("seg_no"), F.lead("start_time_sec").over(w).alias("next_sec")).join(videos, "video_id")
    end = F.coalesce("next_sec", F.when(F.col("duration_sec") > 0, F.col("duration_sec")))
    length = round_sec(end - F.col("start_time_sec"))
    return p.select(
        "video_id", segment_id(F.col("video_id"), F.col("seg_no")).alias("segment_id"), F.col("seg_no").cast("long").alias("seg_no"), "start_time_sec",
        F.coalesce(F.nullif(end, F.lit(0.0)), F.lit(-1.0)).alias("end_time_sec"), F.coalesce(F.nullif(length, F.lit(0.0)), F.lit(-1.0)).alias("duration_sec"),
        frame_number(F.col("start_time_sec") * F.col("fps")).alias("global_start_frame"),
    )


def duration(frames: Column, fps: Column, probed: Column) -> Column:
    """Frames over rate, else what a probe says, else -1.0."""
    return F.coalesce(frames / F.nullif(fps, F.lit(0.0)), probed, F.lit(-1.0))


def bounds(meta: DataFrame) -> DataFrame:
    """Start and end of a segment from its metadata, and an id made of both."""
    start = F.when(F.col("start_time_sec") >= 0, F.col("start_time_sec")).otherwise(0.0)
    end = F.when(F.col("end_time_sec") >= start, F.col("end_time_sec")).otherwise(start + F.col("duration_sec"))
    return meta.withColumns({"start_sec": round_sec(start), "end_sec": round_sec(end)}).withColumn("bounds_id", F.format_string("%s_%06d_%06d", "video_id", frame_number(F.col("start_sec")), frame_number(F.col("end_sec"))))


def speech_islands(frames: DataFrame, threshold: float, min_speech: int, min_silence: int, pad: int) -> DataFrame:
    """Speech regions from frame probabilities (video_id, pos, prob): runs above the threshold, short silences bridged, short regions dropped, the rest padded."""
    w = Window.partitionBy("video_id").orderBy("pos")
    on = frames.where(F.col("prob") >= threshold)
    gap = F.col("pos") - F.lag("pos").over(w) - 1
    runs = on.withColumn("new", F.when(gap.isNull() | (gap >= min_silence), 1).otherwise(0)).withColumn("island", F.sum("new").over(w))
    r = runs.groupBy("video_id", "island").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count("*").alias("voiced"))
    return r.where(F.col("b") - F.col("a") + 1 >= min_speech).select("video_id", F.col("island").alias("idx"), F.greatest(F.col("a") - pad, F.lit(0)).alias("start_pos"), (F.col("b") + pad).alias("end_pos"), "voiced")


def chunks(rows: DataFrame, order: str, size: int, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Offset, limit, and a batch number for every `size` rows; size 0 is one batch.

    Numbers are given by partitions of a range sort and their counts, so no task sees all rows.
    """
    d = dense_index(rows, order, "row_no").where(F.col("row_no") >= offset)
    if limit is not None:
        d = d.where(F.col("row_no") < offset + limit)
    batch = F.lit(0) if size <= 0 else F.floor((F.col("row_no") - offset) / size)
    return d.withColumn("batch_no", batch.cast("long"))


def dense_index(rows: DataFrame, order: str, name: str = "embedding_index") -> DataFrame:
    """0-based positions in the order of one column (ties in any order): local positions plus the counts of the partitions before.

    The range-sorted rows are written once to the shared folder, each with its partition and its place there. Boundaries
    of a range sort are sampled, so counts taken from a second sort needn't be those of the first.
    """
    spark = rows.sparkSession
    part, place, before = unused([*rows.columns, name], "part", "place", "before")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = rows.repartitionByRange(n, order).sortWithinPartitions(order)
    d = d.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    path = shared_dir(spark)
    d.write.parquet(path)
    d = spark.read.schema(d.schema).parquet(path)
    counts = d.groupBy(part).agg((F.max(place) + 1).alias(before))
    first = counts.select(part, (F.sum(before).over(Window.orderBy(part)) - F.col(before)).alias(before))  # a row a partition
    return d.join(F.broadcast(first), part).withColumn(name, F.col(before) + F.col(place)).drop(part, place, before)
