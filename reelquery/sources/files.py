"""File sources and sinks of the pipeline's artefacts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import base_name, natural_key
from .shared import delete, exists, matching

#: The suffixes of raw videos, as written.
SUFFIXES = (".mp4", ".mkv", ".avi", ".mov", ".MP4", ".MKV")
MANIFEST = "video_id string, segments array<struct<segment_id string, file_path string, start_time_sec double, end_time_sec double, duration_sec double, global_start_frame bigint>>"


def with_suffix(files: DataFrame, column: str = "path", suffixes=SUFFIXES) -> DataFrame:
    wanted = None
    for s in suffixes:
        wanted = F.col(column).endswith(s) if wanted is None else wanted | F.col(column).endswith(s)
    return files.where(wanted)


def discover(files: DataFrame, offset: int = 0, limit: int | None = None, suffixes=SUFFIXES) -> DataFrame:
    """Videos of a listing (path): by suffix, sorted by path, then offset, then limit (0 or none: all)."""
    d = with_suffix(files, suffixes=suffixes).withColumn("video_id", F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1)).orderBy("path")
    if offset > 0:
        d = d.offset(offset)
    return d.limit(limit) if limit and limit > 0 else d


LISTING = "path string, modificationTime timestamp, length long"


def list_videos(spark: SparkSession, root: str) -> DataFrame:
    """A recursive listing; file contents are never read. A folder that isn't there has no files."""
    if not exists(spark, root):
        return spark.createDataFrame([], LISTING)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime", "length")


def clips(files: DataFrame) -> DataFrame:
    """The cut clips of a listing in natural order: those named segment_*.mp4, or all .mp4 if none is."""
    mp4 = files.where(F.col("path").endswith(".mp4"))
    named = mp4.where(base_name(F.col("path")).startswith("segment_"))
    return (mp4 if named.isEmpty() else named).orderBy(natural_key(F.col("path")))


def video_root(files: DataFrame) -> str:
    """The folder that all clips have in common; one step up if it is a single video's (as L21_V001)."""
    parent = F.regexp_replace("path", r"/[^/]*$", "")
    ends = clips(files).select(F.split(parent, "/").alias("p")).agg(F.min("p").alias("a"), F.max("p").alias("b")).first()
    if ends.a is None:
        raise FileNotFoundError("no .mp4 in the listing")
    same = ends.a  # all others lie between the least and the greatest
    for k, (a, b) in enumerate(zip(ends.a, ends.b)):
        if a != b:
            same = ends.a[:k]
            break
    if re.fullmatch(r"L\d+_V\d+", same[-1], re.IGNORECASE):
        same = same[:-1]
    return "/".join(same)


#: What the stages before keep as JSON, one file a segment.
CAPTION = "segment_id string, video_id string, caption string, global_start_frame bigint"
KEYFRAME = "segment_id string, groups array<struct<group_id bigint, keyframe bigint, global_keyframe bigint, image_path string>>"
TRANSCRIPT = "video_id string, segment_id string, global_start_frame bigint, start_time_sec double, end_time_sec double, full_text string"


def json_rows(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """The JSON files that a pattern names, one object each; a file that isn't there is no row."""
    paths = matching(spark, pattern)
    return spark.read.schema(schema).json(paths, multiLine=True) if paths else spark.createDataFrame([], schema)


def keyframe_rows(spark: SparkSession, pattern: str) -> DataFrame:
    return json_rows(spark, pattern, KEYFRAME).select("segment_id", F.explode("groups").alias("g")).select("segment_id", "g.*")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return explode_manifest(spark.read.schema(MANIFEST).json(path, multiLine=True))


def explode_manifest(manifest: DataFrame) -> DataFrame:
    return manifest.select("video_id", F.explode("segments").alias("s")).select("video_id", "s.*")


def write_collection(points: DataFrame, path: str) -> None:
    """Parquet by collection, sorted by video within files, so that filters on videos prune row groups."""
    (points.repartition("collection", F.pmod(F.xxhash64("point_id"), F.lit(64))).sortWithinPartitions("collection", "video_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collection").parquet(path))


def write_summary(summary: DataFrame, path: str) -> None:
    """CSV with a header, each file with a byte order mark before it."""
    first, *rest = summary.columns
    summary.withColumnRenamed(first, "\ufeff" + first).select("`\ufeff" + first + "`", *rest).write.mode("overwrite").option("header", "true").csv(path)


def write_jsonl(rows: DataFrame, path: str, order: str | None = None) -> None:
    """JSON lines, files and lines in natural order of a column."""
    if order:
        rows = rows.orderBy(natural_key(F.col(order)), order)
    rows.write.mode("overwrite").json(path)


def remove_segments(spark: SparkSession, root: str, videos: DataFrame) -> int:
    """Deletes root/<video_id>/segments/*.mp4 of a batch of videos; returns how many files went. Folders that aren't there are passed over."""
    n = 0
    for (video,) in videos.select("video_id").toLocalIterator():  # the videos of one batch
        for path in matching(spark, f"{root}/{video}/segments/*.mp4"):
            delete(spark, path)
            n += 1
    return n


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are good, and those for the error table."""
    return rows.where("error is null").drop("error"), rows.where("error is not null")
