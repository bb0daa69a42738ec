"""Streaming ingest, and speaker turns over live sentences."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.shared import shared_dir

TURN = "segment_id string, turn_no long, speaker string, start double, end double, sentences long"
STATE = "turn_no long, speaker string, start double, end double, sentences long"


def ingest(spark: SparkSession, landing: str, schema: str, batch_size: int, checkpoint: str, upsert: Callable[[DataFrame, int], None]):
    """New files in batches of batch_size; each is upserted once, also after a restart (upserts are keyed, so a repeated batch changes nothing)."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_size).parquet(landing)
    return files.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_points(stream: DataFrame, at: str = "arrived", late: str = "1 hour") -> DataFrame:
    """Points once each, as long as copies arrive within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(["point_id"])


def live_turns(sentences: DataFrame, gap: float = 1.50, at: str | None = None, idle: str = "1 hour") -> DataFrame:
    """Turns as they grow (update mode): each batch gives the new state of the turns that it touches.

    The state of a segment is its last turn. With `at`, a column of event times, it goes when the stream's times have passed
    the segment's last one by `idle` twice, and a sentence that comes later is late; without, states of all segments are kept. A segment's sentences must come in order from batch to batch; within a batch they are sorted.
    """

    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        turn = list(state.get) if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["start_sec", "end_sec", "sent_no"])
        out = []
        for r in rows.itertuples(index=False):
            if turn and turn[1] == r.speaker and round(r.start_sec - turn[3], 3) <= gap:
                turn[3], turn[4] = r.end_sec, turn[4] + 1
            else:
                if turn:
                    out.append((key[0], *turn))
                turn = [turn[0] + 1 if turn else 0, r.speaker, r.start_sec, r.end_sec, 1]
        out.append((key[0], *turn))
        state.update(tuple(turn))
        if at:
            state.setTimeoutTimestamp(max(int(rows[at].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + idle_ms)
        yield pd.DataFrame(out, columns=["segment_id", "turn_no", "speaker", "start", "end", "sentences"])

    keep = sentences.select("segment_id", "sent_no", "start_sec", "end_sec", "speaker", *([at] if at else []))
    if at:
        keep = keep.withWatermark(at, idle)
    timeout = GroupStateTimeout.EventTimeTimeout if at else GroupStateTimeout.NoTimeout
    return keep.groupBy("segment_id").applyInPandasWithState(step, TURN, STATE, "update", timeout)


def replay_turns(sentences: DataFrame, gap: float = 1.50) -> DataFrame:
    """live_turns over a table that is replayed as a stream; the last state of each turn."""
    spark, base = sentences.sparkSession, shared_dir(sentences.sparkSession)
    sentences.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(sentences.schema).parquet(f"{base}/in")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/n={number}")

    live_turns(stream, gap).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    states = spark.read.schema(f"{TURN}, batch int").option("recursiveFileLookup", "true").parquet(f"{base}/out")
    last = states.groupBy("segment_id", "turn_no").agg(F.max_by(F.struct("speaker", "start", "end", "sentences"), F.struct("batch", "sentences")).alias("s"))
    return last.select("segment_id", "turn_no", "s.speaker", "s.start", F.col("s.end").alias("end"), "s.sentences")
