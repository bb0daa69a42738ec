"""Search from the command line: python -m reelquery.plans.search POINTS QUERY... [--mode kis|trake|qa|flat]."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import search as S
from ..operators.slots import embed_texts, register_stand_ins


def encode(spark: SparkSession, texts: list[str]) -> list[list[float]]:
    """Query vectors by the text encoder slot, in order."""
    rows = embed_texts(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), "text").orderBy("k").collect()
    for r in rows:
        if r.error:
            raise RuntimeError(r.error)
    return [list(r.vector) for r in rows]


def search(points: DataFrame, texts: list[str], mode: str = "kis", top_k: int = 10, video_id: str | None = None, settings: Settings | None = None) -> DataFrame:
    s = settings or Settings()
    kf, cap = S.existing(points, s.keyframe_collections), S.existing(points, s.caption_collections)
    if mode == "trake":
        vectors = encode(points.sparkSession, texts) if texts else []
        found = S.trake(points, vectors, kf, top_k=top_k)
        return found.withColumn("query", F.element_at(F.array(*[F.lit(t) for t in texts]), F.col("event_index") + 1)) if texts else found
    (vector,) = encode(points.sparkSession, [" ".join(texts)])
    if mode == "qa":
        return S.qa_context(points, vector, kf, cap, top_k)
    if mode == "flat":
        return S.kis_flat(points, vector, kf, cap, top_k)
    return S.kis(points, vector, kf, cap, top_k, video_id)


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(description="search a point table")
    a.add_argument("points")
    a.add_argument("query", nargs="+")
    a.add_argument("--mode", choices=["kis", "trake", "qa", "flat"], default="kis")
    a.add_argument("--top-k", type=int, default=10)
    a.add_argument("--video-id")
    a.add_argument("--slots", help="a module that registers the slot text_encoder when imported")
    a.add_argument("--stand-ins", action="store_true", help="hashed words in place of a text encoder")
    args = a.parse_args(argv)
    if args.stand_ins:
        register_stand_ins()
    if args.slots:
        importlib.import_module(args.slots)
    spark = SparkSession.builder.appName("reelquery-search").getOrCreate()
    search(spark.read.parquet(args.points), args.query, args.mode, args.top_k, args.video_id, Settings.from_env()).show(args.top_k, truncate=False)


if __name__ == "__main__":
    main()
