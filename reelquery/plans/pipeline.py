"""The staged ingest: each stage is a function from tables to a table, kept as Parquet and skipped where done.

Stages are those of the reference: segments (1), transcripts (1.5), keyframes (2), captions (3), embed (4), ingest (5).
Transcripts and keyframes need models; without their slots a run of all stages leaves them out with a warning, and
asking for one by name is an error. What the slots get and give is told in ``operators.slots``.
"""

from __future__ import annotations

import argparse
import importlib
import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import Settings
from ..functions.exprs import clean_text
from ..operators import keyframes as K
from ..operators import segments as G
from ..operators import store
from ..operators import transcript as R
from ..operators.slots import KINDS, REGISTRY, apply, check, register_stand_ins
from ..sources import files
from ..sources.shared import delete, exists, replace

ALIASES = {
    "1": "segments", "vad": "segments", "1.5": "transcripts", "transcript": "transcripts", "2": "keyframes", "dino": "keyframes", "keyframe": "keyframes",
    "3": "captions", "vlm": "captions", "caption": "captions", "4": "embed", "embedding": "embed", "5": "ingest", "qdrant": "ingest", "db": "ingest",
}
#: Sampled frames that one call of the codec decodes.
CHUNK = 64
REGIONS, WORDS = "array<struct<start_sample bigint, end_sample bigint>>", "array<struct<text string, rel_start double, rel_end double>>"


@dataclass(frozen=True)
class Stage:
    name: str
    #: (context, videos) -> work items
    work: Callable[[dict, DataFrame], DataFrame]
    #: (context, work items) -> results with a video_id and, if rows can fail, an error column
    run: Callable[[dict, DataFrame], DataFrame]
    #: what tells work items and results apart
    key: Callable[[], Column]
    #: slots without which the stage is left out
    slots: tuple[str, ...] = ()


def _failed(*results: DataFrame, keys: tuple[str, ...] = ("video_id", "segment_id")) -> DataFrame:
    """One error of each item of which any row failed."""
    out = None
    for r in results:
        e = r.where("error is not null").select(*keys, "error")
        out = e if out is None else out.unionByName(e)
    return out.groupBy(*keys).agg(F.min("error").alias("error"))


def _segment_rows(ctx: dict, videos: DataFrame) -> DataFrame:
    """The segments of the videos with the videos' other columns."""
    s = ctx["read"]("segments")
    return s.join(videos.select("video_id", *[c for c in videos.columns if c not in s.columns]), "video_id")


def _segments(ctx: dict, videos: DataFrame) -> DataFrame:
    speech, failed = ctx.get("speech"), None
    if speech is None and "vad" in REGISTRY:
        whole = videos.withColumns({"segment_id": F.lit(None).cast("string"), "start_time_sec": F.lit(0.0), "end_time_sec": F.lit(None).cast("double")})
        heard = ctx["keep"](apply("vad", whole), "heard")
        failed = _failed(heard, keys=("video_id",))
        videos = videos.join(failed, "video_id", "left_anti")
        regions = heard.select("video_id", F.posexplode(F.col("regions").cast(REGIONS)).alias("idx", "r"))
        speech = regions.select("video_id", F.col("idx").cast("long").alias("idx"), "r.*")
    probed = apply("probe", videos)
    v = probed.select("video_id", G.duration(F.col("frames"), F.col("fps"), F.lit(None).cast("double")).alias("duration_sec"), "fps")
    splits = G.split_points(speech, ctx["settings"].sample_rate) if speech is not None else ctx["spark"].createDataFrame([], "video_id string, idx long, split_sec double")
    out = G.segments(splits, v)
    return out if failed is None else out.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


def _regions(ctx: dict, segs: DataFrame) -> DataFrame:
    """Adds regions (samples from the segment's start) and error: from the vad slot, else from the speech table."""
    if "vad" in REGISTRY:
        return apply("vad", segs).withColumn("regions", F.coalesce(F.col("regions").cast(REGIONS), F.array().cast(REGIONS)))
    sample = lambda c: F.bround(F.col(c) * ctx["settings"].sample_rate, 0).cast("long")
    begin, end = sample("start_time_sec"), F.when(F.col("end_time_sec") >= 0, sample("end_time_sec"))
    both = segs.select("video_id", "segment_id", begin.alias("_a"), end.alias("_z")).join(ctx["speech"].select("video_id", "start_sample", "end_sample"), "video_id")
    cut = both.select("segment_id", (F.greatest("start_sample", "_a") - F.col("_a")).alias("start_sample"), (F.least("end_sample", "_z") - F.col("_a")).alias("end_sample")).where("start_sample < end_sample")
    found = cut.groupBy("segment_id").agg(F.sort_array(F.collect_list(F.struct("start_sample", "end_sample"))).cast(REGIONS).alias("regions"))
    return segs.join(found, "segment_id", "left").withColumns({"regions": F.coalesce("regions", F.array().cast(REGIONS)), "error": F.lit(None).cast("string")})


def _transcripts(ctx: dict, segs: DataFrame) -> DataFrame:
    """Regions, words with speakers, sentences of each region, their confidence, turns; a row a segment, also without speech."""
    s, keep = ctx["settings"], ctx["keep"]
    none = F.lit(None).cast("string")
    found = keep(_regions(ctx, segs), "regions")
    ok = found.where("error is null").drop("error")
    parts = ok.select(*segs.columns, F.posexplode("regions").alias("region_no", "_r")).select(*segs.columns, "region_no", F.col("_r.start_sample").alias("from_sample"), F.col("_r.end_sample").alias("to_sample"))
    parts = R.region_filter(parts.withColumns({"start_sec": F.col("from_sample") / s.sample_rate, "end_sec": F.col("to_sample") / s.sample_rate}), s.min_region_sec).drop("start_sec", "end_sec")
    heard = keep(apply("asr", parts.withColumn("given", none)), "asr")
    spoken = keep(apply("diarize", ok.where(F.size("regions") > 0).drop("regions")), "diarized")

    plain = clean_text(F.col("text"))
    alone = F.array(F.struct(plain.alias("text"), F.lit(None).cast("double").alias("rel_start"), F.lit(None).cast("double").alias("rel_end"))).cast(WORDS)
    said = heard.where("error is null").where(F.coalesce(plain, F.lit("")) != "").withColumn("words", F.when(F.size("words") > 0, F.col("words").cast(WORDS)).otherwise(alone))
    words = said.select("segment_id", "region_no", F.col("start_time_sec").alias("clip_offset"), (F.col("from_sample") / s.sample_rate).alias("region_start"), (F.col("to_sample") / s.sample_rate).alias("region_end"), F.posexplode("words").alias("_k", "_w"))
    words = words.select("*", "_w.*").withColumn("text", F.coalesce("text", F.lit("")))
    words = R.rebase_words(words.withColumn("word_no", F.row_number().over(Window.partitionBy("segment_id").orderBy("region_no", "_k")) - 1)).drop("_k", "_w")
    turns = spoken.where("error is null").select("segment_id", F.posexplode("turns").alias("turn_no", "_t")).select("segment_id", "turn_no", "_t.start_sec", "_t.end_sec", "_t.speaker")
    words = words.join(R.assign_speaker(words, turns), ["segment_id", "word_no"])

    key = ["segment_id", "region_no", "sent_no"]
    sents = keep(R.sentences(words, key[:2], s.pause_sec, s.max_sentence_sec), "sentences")
    ask = sents.select(*key, "start_sec", "end_sec", F.col("text").alias("given")).join(ok.drop("regions"), "segment_id")
    ask = R.pad_clamp(ask.withColumn("duration_sec", F.when(F.col("duration_sec") > 0, F.col("duration_sec"))), s.pad_sec, s.sample_rate)
    scored = keep(apply("asr", ask.where("from_sample < to_sample").select(*parts.columns, "given", "sent_no")), "scores")
    sure = R.confidence(scored.where("error is null").select(*key, F.explode("logps").alias("logp")), key)
    sents = sents.join(sure, key, "left").withColumn("sent_no", F.row_number().over(Window.partitionBy("segment_id").orderBy("region_no", "sent_no")) - 1)
    done = R.transcripts(R.turns(sents, s.turn_gap_sec, s.ncr_below, s.reliable_from))

    failed = _failed(found, heard, spoken)
    kind = done.schema["turns"].dataType
    good = segs.select("video_id", "segment_id").join(failed.select("segment_id"), "segment_id", "left_anti").join(done, "segment_id", "left")
    good = good.select("video_id", "segment_id", F.coalesce("turns", F.array().cast(kind)).alias("turns"), F.coalesce("full_text", F.lit("")).alias("full_text"), none.alias("error"))
    unscored = scored.where("error is not null").select("video_id", "segment_id", F.concat(F.lit("a sentence has no confidence: "), "error").alias("error"))
    return good.unionByName(failed.unionByName(unscored), allowMissingColumns=True)


def _keyframes(ctx: dict, segs: DataFrame) -> DataFrame:
    """Sampled frames, groups of similar ones and their medoids with their images."""
    s = ctx["settings"]
    probed = apply("probe", ctx["videos"]).where("error is null").select("video_id", F.col("fps").alias("_fps"))
    rate = F.when(F.col("_fps") > 0, F.col("_fps")).otherwise(s.target_fps)
    step = F.when((F.lit(s.sample_fps) > 0) & (F.lit(s.sample_fps) < rate), F.greatest(F.lit(1), F.bround(rate / s.sample_fps, 0).cast("int"))).otherwise(1)
    d = segs.join(probed, "video_id", "left").withColumns({"fps": rate, "step": step}).drop("_fps")
    # chunks of CHUNK sampled frames; the last one is open, so rounded lengths lose no frame
    frames = F.when(F.col("duration_sec") > 0, F.ceil(F.col("duration_sec") * F.col("fps"))).otherwise(1).cast("long")
    size = (F.col("step") * CHUNK).cast("long")
    d = d.withColumn("from_frame", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(frames - 1, F.lit(0)), size)))
    d = d.withColumn("to_frame", F.when(F.col("from_frame") + size < frames, F.col("from_frame") + size))
    shots = apply("codec", d).select("video_id", "segment_id", "step", F.col("error").alias("_error"), F.explode_outer(F.col("frames").cast("array<struct<frame_idx bigint, image binary>>")).alias("_f"))
    shots = shots.select("video_id", "segment_id", "step", "_error", "_f.*").where((F.col("frame_idx") % F.col("step") == 0) | F.col("_error").isNotNull())
    seen = apply("frame_encoder", shots.drop("step")).withColumn("error", F.coalesce("_error", "error")).drop("_error")
    seen = ctx["keep"](seen, "frames")
    failed = _failed(seen)
    good = seen.join(failed.select("segment_id"), "segment_id", "left_anti")
    order = Window.partitionBy("segment_id").orderBy("frame_idx")
    grouped = K.groups(good.select("segment_id", "frame_idx", "vec").withColumn("pos", (F.row_number().over(order) - 1).cast("long")), s.group_threshold)
    table = K.keyframe_table(grouped, segs.select("segment_id", F.col("global_start_frame").alias("global_start_frame_of_segment")), s.max_candidates)
    images = good.select("video_id", "segment_id", F.col("frame_idx").alias("local_keyframe"), "image")
    return table.join(images, ["segment_id", "local_keyframe"]).withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


def _captions(ctx: dict, segs: DataFrame) -> DataFrame:
    return apply("captioner", segs.select("video_id", "segment_id", "global_start_frame"))


def _points(ctx: dict, videos: DataFrame) -> DataFrame:
    s = ctx["read"]("segments").join(videos.select("video_id"), "video_id", "left_semi")
    empty = ctx["spark"].createDataFrame([], "segment_id string, global_keyframe long, image_path string")
    keyframes, transcripts = ctx["maybe"]("keyframes"), ctx["maybe"]("transcripts")
    return store.gather(s, empty if keyframes is None else keyframes, ctx["read"]("captions"), transcripts, ctx["settings"].embed_transcripts)


def _embed(ctx: dict, points: DataFrame) -> DataFrame:
    texts = apply("text_encoder", points.where("point_type <> 'keyframe'"))
    keyframes = ctx["maybe"]("keyframes")
    if keyframes is None:
        return texts
    if "image_encoder" not in REGISTRY:
        raise ValueError("keyframes need the slot image_encoder")
    images = keyframes.select("segment_id", F.col("global_keyframe").alias("frame_index"), "image")
    shown = points.where("point_type = 'keyframe'").join(images, ["segment_id", "frame_index"]).select(*points.columns, "image")
    return texts.unionByName(apply("image_encoder", shown).drop("image"))


def _embedded(ctx: dict, videos: DataFrame) -> DataFrame:
    return ctx["read"]("embed").join(videos.select("video_id"), "video_id", "left_semi")


def _ingest(ctx: dict, points: DataFrame) -> DataFrame:
    """Points with their ids, one of each; vectors of another size than the collection's (of the settings, if it is new) are errors."""
    p = store.with_ids(points.withColumn("collection", F.when(F.col("point_type") == "keyframe", "kf").otherwise("cap")))
    old = ctx["maybe"]("ingest")
    size = (store.dimension(old) if old is not None else None) or ctx["settings"].vector_size
    return store.check_dimension(store.distinct_by(p, "point_id"), size)


def _video() -> Column:
    return F.col("video_id")


def _segment() -> Column:
    return F.col("segment_id")


def _point() -> Column:
    return store.point_name(F.col("video_id"), F.col("segment_id"), F.col("frame_index"), F.col("point_type"))


STAGES = [
    Stage("segments", lambda ctx, videos: videos, _segments, _video),
    Stage("transcripts", _segment_rows, _transcripts, _segment, ("vad", "asr", "diarize")),
    Stage("keyframes", _segment_rows, _keyframes, _segment, ("codec", "frame_encoder", "image_encoder")),
    Stage("captions", _segment_rows, _captions, _segment),
    Stage("embed", _points, _embed, _point),
    Stage("ingest", _embedded, _ingest, _point),
]


def run(spark: SparkSession, videos: DataFrame, out: str, settings: Settings | None = None, stage: str | None = None, force: bool = False, strict: bool = False, batch_size: int | None = None, skip: tuple[str, ...] = (), cleanup: str | None = None, **tables: DataFrame) -> DataFrame:
    """Runs all stages (None or "all"; not those in skip) or one; returns the run log: a row a stage with status, rows, errors and seconds.

    All stages are run for batch_size videos (of the settings, if None; 0 is all) before the next ones begin; one
    stage alone takes all videos at once. Tables are kept by video. An item (a video, a segment, a point) is done for a stage when the
    stage's table holds good rows of it; only others are worked on, and their rows are added. With force all items of the
    given videos are worked on and their videos' rows replaced; other videos' rows stay. <stage>_errors holds the last error of
    each item that has failed and not succeeded since; with strict any raises at the end of the stage. cleanup names the
    folder of cut segments, <cleanup>/<video_id>/segments, whose videos are deleted when a batch is done. tables: speech
    (video_id, idx, start_sample, end_sample), which stands for the vad slot where segments are cut, and in transcripts if
    there is no such slot.
    """
    settings = settings or Settings()
    scratch = f"{out}/_work"

    def read(name: str) -> DataFrame:
        found = spark.read.parquet(f"{out}/{name}")
        fields = [StructField("video_id", StringType()) if f.name == "video_id" else f for f in found.schema]  # ids like 007 stay texts
        return spark.read.schema(StructType(fields)).parquet(f"{out}/{name}")

    def filled(name: str) -> bool:
        """Whether the stage has kept rows; a table by video without any has no files."""
        try:
            return bool(spark.read.parquet(f"{out}/{name}").columns)
        except AnalysisException:
            return False

    def keep(rows: DataFrame, name: str) -> DataFrame:
        """rows, written once: models aren't asked again when a result is used twice."""
        rows.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{scratch}/{name}")

    ctx = {"spark": spark, "settings": settings, "read": read, "keep": keep, "maybe": lambda name: read(name) if filled(name) else None, **tables}
    wanted = ALIASES.get(stage, stage) if stage != "all" else None
    if wanted and wanted not in {s.name for s in STAGES}:
        raise ValueError(f"unknown stage {stage}")
    chosen = []
    for s in STAGES:
        missing = [k for k in s.slots if k not in REGISTRY and not (k == "vad" and ctx.get("speech") is not None)]
        if wanted == s.name and missing:
            raise ValueError(f"stage {s.name} needs the slots {', '.join(missing)}")
        if not wanted and s.name in skip:
            continue
        if not wanted and missing:
            warnings.warn(f"stage {s.name} is left out: the slots {', '.join(missing)} are not registered", stacklevel=2)
        elif wanted in (None, s.name):
            chosen.append(s)
    log: dict[str, tuple] = {}
    for number, part in enumerate(_batches(videos, settings.video_batch_size if batch_size is None else batch_size, spark, f"{out}/_batches") if wanted is None else [videos]):
        ctx["videos"] = part
        for s in chosen:
            began, status, n, bad = time.time(), "COMPLETED", 0, 0
            try:
                work = s.work(ctx, part)
                if not force and filled(s.name):
                    done = read(s.name).select(s.key().alias("_key"), F.lit(True).alias("valid"))
                    work = store.resume(work.withColumn("_key", s.key()), done, ["_key"]).drop("_key")
                rows = s.run(ctx, work)
                good, errors = files.split_errors(keep(rows, s.name)) if "error" in rows.columns else (rows, None)
                # with force a video's rows give way to its new ones
                (good.write.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic").partitionBy("video_id").parquet(f"{out}/{s.name}"))
                n = read(s.name).count() if filled(s.name) else 0
                if errors is not None:
                    bad = _errors(spark, f"{out}/{s.name}_errors", part, errors)
                    if bad and strict:
                        raise RuntimeError(f"{bad} rows failed in {s.name}")
            except Exception as e:  # noqa: BLE001  the log says why, and a strict run ends
                status = f"FAILED: {type(e).__name__}: {str(e)[:200]}"
                if strict:
                    raise
            finally:
                delete(spark, scratch)
            _, before, _, failed, spent = log.get(s.name, (None, "COMPLETED", 0, 0, 0.0))
            log[s.name] = (s.name, status if before == "COMPLETED" else before, n, failed + bad, round(spent + time.time() - began, 3))
        if cleanup and all(status == "COMPLETED" for _, status, *_ in log.values()):
            files.remove_segments(spark, cleanup, part)
    delete(spark, f"{out}/_batches")
    return spark.createDataFrame(list(log.values()), "stage string, status string, row_count long, errors long, seconds double")


def _errors(spark: SparkSession, path: str, videos: DataFrame, errors: DataFrame) -> int:
    """Puts the errors of these videos in place of their old ones; how many they are."""
    n = errors.count()
    old = spark.read.parquet(path).join(videos.select("video_id"), "video_id", "left_anti") if exists(spark, path) else None
    if n or old is not None:
        replace(errors if old is None else old.unionByName(errors, allowMissingColumns=True), path)
    return n


def _batches(videos: DataFrame, size: int, spark: SparkSession, path: str):
    """The videos in their order, size at a time."""
    n = videos.count()
    if size <= 0 or n <= size:
        yield videos
        return
    G.chunks(videos, "path" if "path" in videos.columns else "video_id", size).drop("row_no").write.mode("overwrite").parquet(path)
    numbered = spark.read.parquet(path)
    for k in range(-(-n // size)):
        yield numbered.where(F.col("batch_no") == k).drop("batch_no")


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(description="staged ingest of videos")
    a.add_argument("raw_dir")
    a.add_argument("out")
    a.add_argument("--offset", type=int, default=0)
    a.add_argument("--limit", type=int, help="0 or none: all")
    a.add_argument("--stage", default="all", choices=["all"] + [s.name for s in STAGES] + list(ALIASES))
    a.add_argument("--slots", help="a module that registers slots when imported")
    a.add_argument("--stand-ins", action="store_true", help="made-up captions, text vectors and lengths where no model is registered")
    a.add_argument("--speech", help="Parquet of speech regions: video_id, idx, start_sample, end_sample")
    a.add_argument("--video-batch-size", "--batch-size", type=int)
    a.add_argument("--no-transcript", "--skip-transcript", action="store_true")
    a.add_argument("--cleanup-segments", metavar="DIR", help="delete the cut videos under DIR/<video_id>/segments when a batch is done")
    a.add_argument("--force", action="store_true")
    a.add_argument("--strict", action="store_true")
    a.add_argument("--dry-run", action="store_true", help="list the videos, load every slot once, run nothing")
    args = a.parse_args(argv)
    if args.stand_ins:
        register_stand_ins()
    if args.slots:
        importlib.import_module(args.slots)
    spark = SparkSession.builder.appName("reelquery").getOrCreate()
    videos = files.discover(files.list_videos(spark, args.raw_dir), args.offset, args.limit)
    if args.dry_run:
        videos.explain("formatted")
        print(videos.count(), "videos")
        check(spark, KINDS).show(truncate=False)
        return
    tables = {"speech": spark.read.parquet(args.speech)} if args.speech else {}
    skip = ("transcripts",) if args.no_transcript else ()
    run(spark, videos, args.out, Settings.from_env(), args.stage, args.force, args.strict, args.video_batch_size, skip, args.cleanup_segments, **tables).show(truncate=False)


if __name__ == "__main__":
    main()
