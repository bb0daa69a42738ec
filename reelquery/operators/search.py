"""Search: nearest neighbours, known-item search fused by reciprocal rank, ordered event sequences.

Query vectors are few and given; they enter the plan as constants, so scoring is a projection of the scan and
no join. A scored hit drops its vector before anything is shuffled, and ``row_number() <= k`` prunes each
partition to k rows first (WindowGroupLimit).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import doubles

RRF_K = 60
SCALARS = ["collection", "point_id", "point_type", "video_id", "segment_id", "frame_index", "start_time_sec", "end_time_sec", "image_path", "text"]


def _native_score(vector: Sequence[float]):
    """Cosine with a constant vector: one fold for the product and one for the norm."""
    q = F.array(*[F.lit(float(x)) for x in vector])
    length = math.sqrt(sum(float(x) ** 2 for x in vector))
    v = doubles(F.col("vector"))
    product = F.aggregate(F.zip_with(v, q, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)) * length
    return F.when((norm > 0) & (F.size(v) == len(vector)), product / norm)


def existing(points: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted collections that exist, in the wanted order."""
    found = {r.collection for r in points.where(F.col("collection").isin(*wanted)).select("collection").distinct().collect()}
    return [c for c in wanted if c in found]


def score(points: DataFrame, vectors: Sequence[Sequence[float]], engine: str = "native") -> DataFrame:
    """(step, score, payload) for every point and query vector. Points of another dimension have no score and go."""
    if engine == "native":
        steps = F.array(*[F.struct(F.lit(k).alias("step"), F.round(_native_score(v), 9).alias("score")) for k, v in enumerate(vectors)])
        return points.select(*SCALARS, F.explode(steps).alias("s")).select("s.step", "s.score", *SCALARS).where("score is not null")
    queries = np.array(vectors, dtype=np.float64)
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)

    def run(batches):  # one matrix product a batch
        for b in batches:
            vec = b.column("vector")
            sizes = np.diff(vec.offsets.to_numpy()) if len(b) else np.zeros(0, int)
            ok = (sizes == queries.shape[1]) & ~np.asarray(vec.is_null())
            b = b.filter(pa.array(ok))
            m = b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, queries.shape[1])
            norms = np.sqrt((m * m).sum(axis=1))
            scores = (m @ queries.T) / np.where(norms > 0, norms, np.inf)[:, None]
            for k in range(len(queries)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), k, np.int32)), pa.array(scores[:, k].round(9)), *(b.column(c) for c in SCALARS)], ["step", "score", *SCALARS])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.select(*SCALARS).schema)
    return points.select(*SCALARS, "vector").mapInArrow(run, f"step int, score double, {kinds}")


def knn(points: DataFrame, vectors: Sequence[Sequence[float]], k: int, engine: str = "native") -> DataFrame:
    """The k best points of each collection and query, with their rank; ties go to the smaller point id."""
    w = Window.partitionBy("step", "collection").orderBy(F.desc("score"), "point_id")
    return score(points, vectors, engine).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def kis(points: DataFrame, vector: Sequence[float], keyframes: Sequence[str], captions: Sequence[str], top_k: int = 100, video_id: str | None = None, candidates: int | None = None, rrf_k: int = RRF_K, engine: str = "native") -> DataFrame:
    """Known-item search: hits of all collections fused per (video, segment) by summed reciprocal ranks.

    First-seen fields follow the order of collections, then ranks; the best keyframe hit gives frame and image;
    a modality without hits has no score; sources are the names of the collections that were hit; the shown score is the larger modality's best score, the order is by the unrounded sum.
    """
    collections = [*keyframes, *captions]
    order = F.array_position(F.array(*[F.lit(c) for c in collections]), F.col("collection")).cast("int")
    p = points.where(F.col("collection").isin(*collections))
    if video_id:
        p = p.where(F.col("video_id") == video_id)
    hits = knn(p, [vector], candidates or max(top_k, 50), engine).withColumn("ord", order)
    caption = (F.col("point_type") == "caption") | (F.coalesce(F.col("text"), F.lit("")) != "")
    seen = F.struct("ord", "rank")
    best = F.struct("score", -F.col("ord"), -F.col("rank"))
    g = hits.withColumns({"cap": F.coalesce(caption, F.lit(False)), "seen": seen, "best": best}).groupBy("video_id", "segment_id").agg(
        F.sort_array(F.collect_list("seen")).alias("ranks"),  # top_k per collection at most
        F.min("seen").alias("first"),
        *[F.min_by(c, "seen").alias(c) for c in ("start_time_sec", "end_time_sec")],
        F.min_by("frame_index", "seen").alias("f0"),
        F.max_by("frame_index", F.when(~F.col("cap"), F.col("best"))).alias("f1"), F.max_by("image_path", F.when(~F.col("cap"), F.col("best"))).alias("i1"),
        F.max_by("text", F.when(F.col("cap"), F.col("best"))).alias("text"),
        F.max(F.when(~F.col("cap"), F.col("score"))).alias("kf"), F.max(F.when(F.col("cap"), F.col("score"))).alias("cp"),
        F.array_join(F.array_sort(F.collect_set("collection")), ",").alias("sources"),
    )
    total = F.aggregate("ranks", F.lit(0.0), lambda s, r: s + 1.0 / (rrf_k + r["rank"]))
    g = g.withColumn("rrf", total).orderBy(F.desc("rrf"), "first").limit(top_k)
    final = Window.orderBy(F.desc("rrf"), "first")  # over top_k rows
    return g.select(
        F.row_number().over(final).cast("long").alias("rank"), "video_id", "segment_id", "start_time_sec", "end_time_sec",
        F.when(F.col("kf").isNotNull(), F.col("f1")).otherwise(F.col("f0")).alias("frame_index"),
        F.col("i1").alias("image_path"), "text", F.col("kf").alias("keyframe_score"), F.col("cp").alias("caption_score"),
        "sources", F.round("rrf", 6).alias("rrf_score"), F.coalesce(F.round(F.greatest("kf", "cp"), 4), F.lit(0.0)).alias("score"),
    )


def qa_context(points: DataFrame, vector: Sequence[float], keyframes: Sequence[str], captions: Sequence[str], top_k: int = 5) -> DataFrame:
    """Context for question answering: the first few known-item results."""
    return kis(points, vector, keyframes, captions, top_k)


def kis_flat(points: DataFrame, vector: Sequence[float], keyframes: Sequence[str], captions: Sequence[str], top_k: int = 100, engine: str = "native") -> DataFrame:
    """Hits of all collections in one list by raw score; collections that don't exist give no rows."""
    p = points.where(F.col("collection").isin(*keyframes, *captions))
    hits = knn(p, [vector], top_k, engine).orderBy(F.desc("score"), "point_id").limit(top_k)
    w = Window.orderBy(F.desc("score"), "point_id")  # over top_k rows
    return hits.select(F.row_number().over(w).cast("long").alias("rank"), F.round("score", 6).alias("score"), "video_id", "frame_index", "point_type", "image_path", F.col("text").alias("text_caption"))


def trake(points: DataFrame, vectors: Sequence[Sequence[float]], keyframes: Sequence[str], per_query: int = 50, top_k: int = 20, engine: str = "native") -> DataFrame:
    """Ordered event sequences: for each video the chain of hits, one a query, with strictly rising frames and the largest sum.

    One window a step over all candidates of a video: the best chain that ends on a smaller frame is a running
    maximum, so a step costs a sort and not a join. Result: one row a video and event.
    """
    if not vectors:
        return points.sparkSession.createDataFrame([], "rank long, video_id string, score double, total_score double, event_index int, frame_index long, segment_id string, image_path string, start_time_sec double, end_time_sec double, event_score double")
    hits = knn(points.where(F.col("collection").isin(*keyframes)), vectors, per_query, engine).where("video_id is not null and frame_index is not null")
    # keyframe collections one after another, each by rank: that is the order of first appearance
    order = F.array_position(F.array(*[F.lit(c) for c in keyframes]), F.col("collection"))
    hits = hits.withColumn("pos", order * 1_000_000 + F.col("rank")).select("step", "video_id", F.col("frame_index").alias("frame"), "pos", "score", F.struct("frame_index", "segment_id", "image_path", "start_time_sec", "end_time_sec", F.round("score", 6).alias("event_score")).alias("event"))
    first = hits.where("step = 0")
    chain = first.select("video_id", "frame", "pos", F.col("score").alias("tot"), F.array("event").alias("chain"), F.min("pos").over(Window.partitionBy("video_id")).alias("seen"))
    kinds = {f.name: f.dataType for f in chain.schema}
    w = Window.partitionBy("video_id").orderBy("frame").rangeBetween(Window.unboundedPreceding, -1)
    for k in range(1, len(vectors)):
        step = hits.where(F.col("step") == k).select("video_id", "frame", "pos", "score", "event", F.lit(None).cast("double").alias("tot"), F.lit(None).cast(kinds["chain"]).alias("chain"), F.lit(None).cast(kinds["seen"]).alias("seen"), F.lit(True).alias("next"))
        before = chain.select("video_id", "frame", "pos", F.lit(None).cast("double").alias("score"), F.lit(None).cast(kinds["chain"].elementType).alias("event"), "tot", "chain", "seen", F.lit(False).alias("next"))
        key = F.when(~F.col("next"), F.struct(F.col("tot"), -F.col("frame"), -F.col("pos")))
        both = before.unionByName(step).withColumn("b", F.max_by(F.struct("tot", "chain", "seen"), key).over(w)).where("next and b is not null")
        chain = both.select("video_id", "frame", "pos", (F.col("b.tot") + F.col("score")).alias("tot"), F.concat("b.chain", F.array("event")).alias("chain"), F.col("b.seen").alias("seen"))
    best = chain.groupBy("video_id").agg(F.max_by(F.struct("tot", "chain", "seen"), F.struct("tot", -F.col("frame"), -F.col("pos"))).alias("b"))
    best = best.select("video_id", F.col("b.chain").alias("chain"), F.col("b.seen").alias("seen"), F.round("b.tot", 4).alias("total_score"), F.round(F.col("b.tot") / len(vectors), 4).alias("score"))
    top = best.orderBy(F.desc("total_score"), "seen").limit(top_k)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total_score"), "seen")).cast("long"))  # over top_k rows
    return ranked.select("rank", "video_id", "score", "total_score", F.posexplode("chain").alias("event_index", "e")).select("rank", "video_id", "score", "total_score", "event_index", "e.*")
