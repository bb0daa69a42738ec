"""Views over the test tables that stand in for the pipeline's artefacts, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import epoch_seconds

QUERY_IDS = (3, 101, 250)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    video = F.concat(F.lit("v"), F.col("label").cast("string"))
    part = F.floor(F.col("vec_id") / 50).cast("long")
    keyframe = F.col("vec_id") % 2 == 0
    return e.select(
        F.when(keyframe, "kf").otherwise("cap").alias("collection"),
        F.lpad(F.col("vec_id").cast("string"), 8, "0").alias("point_id"),
        F.when(keyframe, "keyframe").otherwise("caption").alias("point_type"),
        video.alias("video_id"),
        F.concat(video, F.lit("_s"), part.cast("string")).alias("segment_id"),
        F.col("vec_id").alias("frame_index"),
        (part * 10.0).alias("start_time_sec"),
        (part * 10.0 + 10.0).alias("end_time_sec"),
        F.when(keyframe, F.concat(video, F.lit("/"), F.lpad(F.col("vec_id").cast("string"), 8, "0"), F.lit(".jpg"))).alias("image_path"),
        F.when(~keyframe, F.concat(F.lit("cap "), F.col("vec_id").cast("string"))).alias("text"),
        F.col("embedding").alias("vector"),
    )


POINTS = """points AS (SELECT CASE WHEN vec_id % 2 = 0 THEN 'kf' ELSE 'cap' END AS collection, lpad(vec_id::VARCHAR, 8, '0') AS point_id,
  CASE WHEN vec_id % 2 = 0 THEN 'keyframe' ELSE 'caption' END AS point_type, 'v' || label AS video_id,
  'v' || label || '_s' || (vec_id // 50) AS segment_id, vec_id AS frame_index,
  (vec_id // 50) * 10.0::DOUBLE AS start_time_sec, (vec_id // 50) * 10.0::DOUBLE + 10 AS end_time_sec,
  CASE WHEN vec_id % 2 = 0 THEN 'v' || label || '/' || lpad(vec_id::VARCHAR, 8, '0') || '.jpg' END AS image_path,
  CASE WHEN vec_id % 2 = 1 THEN 'cap ' || vec_id END AS text, embedding AS vector FROM embeddings)"""


def query_vectors(spark: SparkSession, sf_dir: str, ids=QUERY_IDS) -> list[list[float]]:
    """Stand-ins for encoded query texts."""
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isin(*ids)).select("vec_id", "embedding").collect()
    by = {r.vec_id: list(r.embedding) for r in rows}
    return [by[i] for i in ids]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("vec_id")
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.concat(F.lit("s"), F.col("label").cast("string")).alias("segment_id"), (F.row_number().over(w) - 1).cast("long").alias("pos"), F.col("vec_id").alias("frame_idx"), F.col("embedding").alias("vec"))


FRAMES = """frames AS (SELECT 's' || label AS segment_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos, vec_id AS frame_idx, embedding AS vec FROM embeddings)"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", epoch_seconds(F.col("ts")) / 36000)
    first = Window.partitionBy("user_id")
    number = Window.partitionBy("user_id").orderBy("ts", "event_id")
    start = F.round(F.col("at") - F.min("at").over(first), 3)
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("segment_id"),
        (F.row_number().over(number) - 1).cast("long").alias("word_no"),
        "event_id",
        F.concat(F.lit(" "), F.col("event_type"), F.when(F.col("event_id") % 7 == 0, ".").otherwise("")).alias("text"),
        start.alias("start_sec"),
        F.floor(F.least("value", F.lit(30.0))).alias("span"),
        F.col("event_type").alias("speaker"),
    ).withColumn("end_sec", F.round(F.col("start_sec") + F.col("span") / 100, 3)).drop("span")


WORDS = """timed AS (SELECT *, epoch_us(ts) / 1000000.0::DOUBLE / 36000 AS hr FROM events),
words0 AS (SELECT 'u' || user_id AS segment_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS word_no, event_id,
  ' ' || event_type || CASE WHEN event_id % 7 = 0 THEN '.' ELSE '' END AS text,
  round(hr - min(hr) OVER (PARTITION BY user_id), 3) AS start_sec, floor(least(value, 30.0)) AS span, event_type AS speaker FROM timed),
words AS (SELECT segment_id, word_no, event_id, text, start_sec, round(start_sec + span / 100, 3) AS end_sec, speaker FROM words0)"""


def diarisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth word of a segment opens a turn that lasts until the next such word."""
    w = Window.partitionBy("segment_id").orderBy("word_no")
    turns = words(spark, sf_dir).where(F.col("word_no") % 5 == 0)
    return turns.select("segment_id", F.floor(F.col("word_no") / 5).cast("long").alias("turn_no"), "start_sec", F.coalesce(F.lead("start_sec").over(w), F.col("end_sec")).alias("end_sec"), "speaker")


DIARISATION = """diar AS (SELECT segment_id, word_no // 5 AS turn_no, start_sec, coalesce(lead(start_sec) OVER (PARTITION BY segment_id ORDER BY word_no), end_sec) AS end_sec, speaker FROM words WHERE word_no % 5 = 0)"""


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    length = F.round(F.length("text") / 15.0, 3)
    gap = (F.col("turn") % 4) * 0.6
    start = F.round(F.coalesce(F.sum(length + gap).over(before), F.lit(0.0)), 3)
    return c.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("segment_id"),
        F.col("turn").alias("sent_no"),
        start.alias("start_sec"),
        F.round(start + length, 3).alias("end_sec"),
        "text",
        F.concat(F.lit("S"), (F.floor(F.col("turn") / 2) % 2).cast("string")).alias("speaker"),
        F.when((F.col("conv_id") + F.col("turn")) % 13 != 0, ((F.col("conv_id") * 37 + F.col("turn") * 11) % 101) / 100.0).alias("confidence"),
    )


SENTENCES = """sized AS (SELECT *, round(length(text) / 15.0::DOUBLE, 3) AS len, (turn % 4) * 0.6::DOUBLE AS gap FROM conversations),
placed AS (SELECT *, round(coalesce(sum(len + gap) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE), 3) AS start_sec FROM sized),
sentences AS (SELECT 'c' || conv_id AS segment_id, turn AS sent_no, start_sec, round(start_sec + len, 3) AS end_sec, text, 'S' || ((turn // 2) % 2) AS speaker,
  CASE WHEN (conv_id + turn) % 13 <> 0 THEN ((conv_id * 37 + turn * 11) % 101) / 100.0::DOUBLE END AS confidence FROM placed)"""


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a segment collapsed into regions that don't overlap, in samples."""
    w = Window.partitionBy("segment_id").orderBy("start_sec", "word_no")
    high = F.max("end_sec").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = words(spark, sf_dir).withColumn("new", F.when(high.isNull() | (F.col("start_sec") > high), 1).otherwise(0)).withColumn("r", F.sum("new").over(w))
    r = marked.groupBy(F.col("segment_id").alias("video_id"), (F.col("r") - 1).alias("idx")).agg(F.min("start_sec").alias("a"), F.max("end_sec").alias("b"))
    return r.select("video_id", "idx", F.bround(F.col("a") * 16000, 0).cast("long").alias("start_sample"), F.bround(F.col("b") * 16000, 0).cast("long").alias("end_sample"))


SPEECH = """flagged AS (SELECT *, CASE WHEN start_sec <= max(end_sec) OVER (PARTITION BY segment_id ORDER BY start_sec, word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM words),
regions AS (SELECT *, sum(fresh) OVER (PARTITION BY segment_id ORDER BY start_sec, word_no ROWS UNBOUNDED PRECEDING) AS r FROM flagged),
speech AS (SELECT segment_id AS video_id, (r - 1)::BIGINT AS idx, round_even(min(start_sec) * 16000, 0)::BIGINT AS start_sample, round_even(max(end_sec) * 16000, 0)::BIGINT AS end_sample FROM regions GROUP BY segment_id, r)"""
