"""The streams: file ingest with keyed upserts, distinct points, states that go."""

from pyspark.sql import functions as F

from reelquery.operators import store
from reelquery.streaming import ingest

POINT = "point_id string, text string, n long"


def test_files_are_upserted_once(spark, tmp_path):
    landing, table, done = (f"file://{tmp_path}/{x}" for x in ("in", "points", "done"))
    spark.createDataFrame([], POINT).write.parquet(f"{table}/0")
    state = {"at": 0}

    def upsert(batch, number):
        new = store.upsert(spark.read.parquet(f"{table}/{state['at']}"), batch, order="n")
        state["at"] += 1
        new.write.mode("overwrite").parquet(f"{table}/{state['at']}")

    spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], POINT).coalesce(1).write.parquet(f"{landing}/x=1")
    ingest.ingest(spark, f"{landing}/*", POINT, 1, done, upsert).awaitTermination()
    spark.createDataFrame([("b", "2", 2), ("c", "2", 2), ("c", "3", 3)], POINT).coalesce(1).write.parquet(f"{landing}/x=2")
    ingest.ingest(spark, f"{landing}/*", POINT, 1, done, upsert).awaitTermination()
    ingest.ingest(spark, f"{landing}/*", POINT, 1, done, upsert).awaitTermination()
    assert state["at"] == 2
    assert {r.point_id: r.text for r in spark.read.parquet(f"{table}/2").collect()} == {"a": "1", "b": "2", "c": "3"}


def test_points_come_once(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    rows = [("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:10:00"), ("b", "2026-01-01 00:20:00")]
    d = spark.createDataFrame(rows, "point_id string, arrived string").withColumn("arrived", F.col("arrived").cast("timestamp"))
    d.write.parquet(path)
    stream = ingest.distinct_points(spark.readStream.schema(d.schema).parquet(path))
    stream.writeStream.format("memory").queryName("once").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.point_id for r in spark.table("once").collect()) == ["a", "b"]


def test_states_of_old_segments_go(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    kinds = "segment_id string, sent_no long, start_sec double, end_sec double, speaker string, said timestamp"

    def say(n, segment, start, hour):
        rows = [(segment, n, start, start + 1, "A", hour)]
        d = spark.createDataFrame(rows, kinds.replace("timestamp", "string")).withColumn("said", F.col("said").cast("timestamp"))
        d.coalesce(1).write.parquet(f"{path}/x={n}")
        out = ingest.live_turns(spark.readStream.schema(kinds).parquet(f"{path}/*"), at="said")
        got = []
        q = out.writeStream.outputMode("update").foreachBatch(lambda b, k: got.extend(map(tuple, b.collect()))).option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return got, sum(int(p["stateOperators"][0]["numRowsTotal"]) for p in [q.recentProgress[-1]])

    assert say(0, "a", 0.0, "2026-01-01 00:00:00") == ([("a", 0, "A", 0.0, 1.0, 1)], 1)
    assert say(1, "a", 1.5, "2026-01-01 00:10:00") == ([("a", 0, "A", 0.0, 2.5, 2)], 1)
    got, states = say(2, "b", 0.0, "2026-01-01 09:00:00")
    assert ("b", 0, "A", 0.0, 1.0, 1) in got and states == 1
