"""One query for each operator of the blueprint, over views of the test tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import keyframes as K
from ..operators import search as S
from ..operators import segments as G
from ..operators import store as P
from ..operators import transcript as R
from ..sources import files as I
from ..sources import fixtures as V
from ..streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


# --- search -----------------------------------------------------------------------------------------

_COS = "round(list_dot_product(p.vector::DOUBLE[], q.v) / (sqrt(list_dot_product(p.vector::DOUBLE[], p.vector::DOUBLE[])) * sqrt(list_dot_product(q.v, q.v))), 9)"
_Q = "q AS (SELECT CASE vec_id WHEN 3 THEN 0 WHEN 101 THEN 1 ELSE 2 END AS step, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IN {})"


def _hits(ids: str, where: str, k: int, scored: str = "ranked") -> str:
    return f"""{V.POINTS}, {_Q.format(ids)},
scored AS (SELECT q.step, p.*, {_COS} AS score FROM points p, q WHERE {where}),
{scored} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY step, collection ORDER BY score DESC, point_id) AS rank FROM scored) WHERE rank <= {k})"""


_KNN = f"WITH {_hits('(3)', 'true', 50)} SELECT collection, rank, point_id, video_id, frame_index, round(score, 6) AS score FROM ranked"


@query("knn_topk", _KNN)
def knn_topk(spark, sf_dir):
    hits = S.knn(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,)), 50)
    return hits.select("collection", F.col("rank").cast("long").alias("rank"), "point_id", "video_id", "frame_index", *r6("score"))


@query("knn_topk_arrow", _KNN)
def knn_topk_arrow(spark, sf_dir):
    hits = S.knn(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,)), 50, engine="arrow")
    return hits.select("collection", F.col("rank").cast("long").alias("rank"), "point_id", "video_id", "frame_index", *r6("score"))


def _shown(rows):
    return rows.withColumns({c: F.round(c, 6) for c in ("keyframe_score", "caption_score")})


def _kis_sql(top_k: int, where: str = "true", vec: int = 3) -> str:
    q = _hits(f"({vec})", where, max(top_k, 50))
    return f"""WITH {q},
h AS (SELECT *, CASE collection WHEN 'kf' THEN 1 ELSE 2 END AS ord, point_type = 'caption' OR coalesce(text, '') <> '' AS cap FROM ranked),
g AS (SELECT video_id, segment_id, sum(1.0::DOUBLE / (60 + rank) ORDER BY ord, rank) AS rrf, min(ord * 1000000 + rank) AS seen,
  arg_min(start_time_sec, ord * 1000000 + rank) AS start_time_sec, arg_min(end_time_sec, ord * 1000000 + rank) AS end_time_sec,
  arg_min(frame_index, ord * 1000000 + rank) AS f0,
  max(score) FILTER (NOT cap) AS kf, max(score) FILTER (cap) AS cp,
  arg_min(frame_index, ord * 1000000 + rank) FILTER (NOT cap) AS f1, arg_min(image_path, ord * 1000000 + rank) FILTER (NOT cap) AS i1,
  arg_min(text, ord * 1000000 + rank) FILTER (cap) AS text,
  string_agg(DISTINCT collection, ',' ORDER BY collection) AS sources FROM h GROUP BY ALL),
t AS (SELECT *, row_number() OVER (ORDER BY rrf DESC, seen) AS rank FROM g)
SELECT rank, video_id, segment_id, start_time_sec, end_time_sec, CASE WHEN kf IS NOT NULL THEN f1 ELSE f0 END AS frame_index,
  i1 AS image_path, text, round(kf, 6) AS keyframe_score, round(cp, 6) AS caption_score,
  sources, round(rrf, 6) AS rrf_score, round(greatest(kf, cp), 4) AS score FROM t WHERE rank <= {top_k}"""


@query("kis", _kis_sql(100))
def kis(spark, sf_dir):
    return _shown(S.kis(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,))[0], ["kf"], ["cap"]))


@query("kis_filtered", _kis_sql(20, "p.video_id = 'v3'"))
def kis_filtered(spark, sf_dir):
    return _shown(S.kis(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,))[0], ["kf"], ["cap"], top_k=20, video_id="v3"))


@query("qa_context", _kis_sql(5))
def qa_context(spark, sf_dir):
    return _shown(S.qa_context(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,))[0], ["kf"], ["cap"]))


@query("kis_flat", f"""WITH {_hits('(3)', 'true', 100)}
SELECT * FROM (SELECT row_number() OVER (ORDER BY score DESC, point_id) AS rank, round(score, 6) AS score, video_id, frame_index, point_type, image_path, text AS text_caption FROM ranked) WHERE rank <= 100""")
def kis_flat(spark, sf_dir):
    return S.kis_flat(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir, (3,))[0], ["kf", "missing"], ["cap"])


@query("trake", f"""WITH {_hits('(3, 101, 250)', "p.collection = 'kf'", 50)},
c AS (SELECT a.video_id, a.rank AS r0, a.frame_index AS f0, b.frame_index AS f1, d.frame_index AS f2, b.rank AS r1, d.rank AS r2, a.score AS s0, b.score AS s1, d.score AS s2,
   a.segment_id AS g0, b.segment_id AS g1, d.segment_id AS g2, a.image_path AS i0, b.image_path AS i1, d.image_path AS i2, a.start_time_sec AS b0, b.start_time_sec AS b1, d.start_time_sec AS b2, a.score + b.score + d.score AS tot
  FROM ranked a JOIN ranked b ON a.video_id = b.video_id AND b.step = 1 AND a.frame_index < b.frame_index
  JOIN ranked d ON d.video_id = b.video_id AND d.step = 2 AND b.frame_index < d.frame_index WHERE a.step = 0),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY tot DESC, f2, r2, f1, r1, f0, r0) AS k FROM c) WHERE k = 1),
seen AS (SELECT video_id, min(rank) AS seen FROM ranked WHERE step = 0 GROUP BY video_id),
top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY round(tot, 4) DESC, seen) AS rank FROM one JOIN seen USING (video_id)) WHERE rank <= 20)
SELECT rank, video_id, round(tot / 3, 4) AS score, round(tot, 4) AS total_score, e.* FROM top,
 LATERAL (VALUES (0, f0, g0, i0, b0, b0 + 10, round(s0, 6)), (1, f1, g1, i1, b1, b1 + 10, round(s1, 6)), (2, f2, g2, i2, b2, b2 + 10, round(s2, 6))) e(event_index, frame_index, segment_id, image_path, start_time_sec, end_time_sec, event_score)""")
def trake(spark, sf_dir):
    return S.trake(V.points(spark, sf_dir), V.query_vectors(spark, sf_dir), ["kf"])


@query("cosine_pairs", f"""WITH {V.FRAMES} SELECT b.segment_id, b.pos, round(list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]), 6) AS sim
FROM frames a JOIN frames b ON a.segment_id = b.segment_id AND a.pos + 1 = b.pos""")
def cosine_pairs(spark, sf_dir):
    w = Window.partitionBy("segment_id").orderBy("pos")
    return V.frames(spark, sf_dir).withColumn("before", F.lag("vec").over(w)).where("before is not null").select("segment_id", "pos", F.round(X.cosine(F.col("before"), F.col("vec")), 6).alias("sim"))


@query("l2_normalize", """WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)
SELECT vec_id, round(v[1] / n, 6) AS first, round(v[len(v)] / n, 6) AS last, len(v) AS size FROM u""")
def l2_normalize(spark, sf_dir):
    u = V.table(spark, sf_dir, "embeddings").withColumn("u", X.normalize(F.col("embedding")))
    return u.select("vec_id", F.round(F.element_at("u", 1), 6).alias("first"), F.round(F.element_at("u", -1), 6).alias("last"), F.size("u").cast("long").alias("size"))


# --- segments ---------------------------------------------------------------------------------------

_SPEECH = f"{V.WORDS}, {V.SPEECH}"
_SPLITS = """splits AS (SELECT * FROM (SELECT video_id, idx, ((end_sample + lead(start_sample) OVER w) * 1000 + 16000) // 32000 / 1000.0::DOUBLE AS split_sec
 FROM speech WINDOW w AS (PARTITION BY video_id ORDER BY idx)) WHERE split_sec IS NOT NULL)"""
_VIDEOS = "videos AS (SELECT video_id, CASE WHEN ends_with(video_id, '7') THEN -1.0 ELSE round(max(end_sample) / 16000.0::DOUBLE + 1, 3) END::DOUBLE AS duration_sec, 25.0::DOUBLE AS fps FROM speech GROUP BY video_id)"
_SEGMENTS = """pts AS (SELECT video_id, 0.0::DOUBLE AS start_time_sec FROM videos UNION ALL SELECT video_id, split_sec FROM splits),
seq AS (SELECT *, row_number() OVER w - 1 AS seg_no, lead(start_time_sec) OVER w AS nxt FROM pts WINDOW w AS (PARTITION BY video_id ORDER BY start_time_sec)),
ended AS (SELECT *, coalesce(nxt, CASE WHEN duration_sec > 0 THEN duration_sec END) AS e FROM seq JOIN videos USING (video_id)),
segments AS (SELECT video_id, video_id || '_seg' || CASE WHEN seg_no < 1000 THEN lpad(seg_no::VARCHAR, 3, '0') ELSE seg_no::VARCHAR END AS segment_id, seg_no::BIGINT AS seg_no, start_time_sec,
  coalesce(nullif(e, 0), -1.0::DOUBLE) AS end_time_sec, coalesce(nullif(round(e - start_time_sec, 3), 0), -1.0::DOUBLE) AS duration_sec, round_even(start_time_sec * fps, 0)::BIGINT AS global_start_frame FROM ended)"""


def _videos(spark, sf_dir):
    s = V.speech(spark, sf_dir).groupBy("video_id").agg(F.max("end_sample").alias("e"))
    return s.select("video_id", F.when(F.col("video_id").endswith("7"), -1.0).otherwise(F.round(F.col("e") / 16000 + 1, 3)).alias("duration_sec"), F.lit(25.0).alias("fps"))


def _segments(spark, sf_dir):
    return G.segments(G.split_points(V.speech(spark, sf_dir)), _videos(spark, sf_dir))


@query("vad_split_points", f"WITH {_SPEECH}, {_SPLITS} SELECT * FROM splits")
def vad_split_points(spark, sf_dir):
    return G.split_points(V.speech(spark, sf_dir))


@query("segments_from_splits", f"WITH {_SPEECH}, {_SPLITS}, {_VIDEOS}, {_SEGMENTS} SELECT * FROM segments")
def segments_from_splits(spark, sf_dir):
    return _segments(spark, sf_dir)


@query("duration_coalesce", "SELECT l_orderkey, l_linenumber, coalesce(l_quantity / nullif(l_tax, 0), CASE WHEN l_returnflag = 'R' THEN l_extendedprice END, -1.0) AS duration_sec FROM lineitem")
def duration_coalesce(spark, sf_dir):
    d = V.table(spark, sf_dir, "lineitem")
    return d.select("l_orderkey", "l_linenumber", G.duration(F.col("l_quantity"), F.col("l_tax"), F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("duration_sec"))


@query("segment_bounds", """WITH m AS (SELECT 'v' || user_id AS video_id, event_id, CASE WHEN event_id % 5 = 0 THEN -1.0 ELSE value END AS s, CASE WHEN event_id % 3 = 0 THEN -1.0 ELSE value + 5 END AS e, 7.5::DOUBLE AS d FROM events),
b AS (SELECT video_id, event_id, round(CASE WHEN s >= 0 THEN s ELSE 0 END, 3) AS start_sec, round(CASE WHEN e >= CASE WHEN s >= 0 THEN s ELSE 0 END THEN e ELSE CASE WHEN s >= 0 THEN s ELSE 0 END + d END, 3) AS end_sec FROM m)
SELECT event_id, start_sec, end_sec, video_id || '_' || lpad(round_even(start_sec, 0)::BIGINT::VARCHAR, 6, '0') || '_' || lpad(round_even(end_sec, 0)::BIGINT::VARCHAR, 6, '0') AS bounds_id FROM b""")
def segment_bounds(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    meta = e.select("event_id", F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video_id"), F.when(F.col("event_id") % 5 == 0, -1.0).otherwise(F.col("value")).alias("start_time_sec"), F.when(F.col("event_id") % 3 == 0, -1.0).otherwise(F.col("value") + 5).alias("end_time_sec"), F.lit(7.5).alias("duration_sec"))
    return G.bounds(meta).select("event_id", "start_sec", "end_sec", "bounds_id")


@query("speech_islands", """WITH f AS (SELECT user_id::VARCHAR AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, (event_id * 37 % 101) / 100.0::DOUBLE AS prob FROM events),
o AS (SELECT *, pos - lag(pos) OVER (PARTITION BY video_id ORDER BY pos) - 1 AS gap FROM f WHERE prob >= 0.5),
i AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT video_id, island::BIGINT AS idx, greatest(min(pos) - 1, 0) AS start_pos, max(pos) + 1 AS end_pos, count(*) AS voiced FROM i GROUP BY video_id, island HAVING max(pos) - min(pos) + 1 >= 3""")
def speech_islands(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    f = V.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("video_id"), (F.row_number().over(w) - 1).cast("long").alias("pos"), ((F.col("event_id") * 37 % 101) / 100.0).alias("prob"))
    return G.speech_islands(f, 0.5, 3, 3, 1)


@query("frame_sample", "SELECT vec_id AS frame_idx, label FROM embeddings WHERE vec_id % 2 = 0")
def frame_sample(spark, sf_dir):
    e = V.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_idx"), "label")
    return K.sample(e, K.sample_step(25.0, 10.0))


@query("batch_chunks", "SELECT o_orderkey, row_no, (row_no - 100) // 5 AS batch_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM orders) WHERE row_no >= 100 AND row_no < 1100")
def batch_chunks(spark, sf_dir):
    return G.chunks(V.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 5, offset=100, limit=1000)


@query("dense_index", "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS embedding_index FROM part")
def dense_index(spark, sf_dir):
    return G.dense_index(V.table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")


_LINES = "lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS row_no FROM lineitem)"


def _lines(spark, sf_dir):
    """Line numbers repeat in the table, so the order takes more columns."""
    line = V.table(spark, sf_dir, "lineitem")
    return line.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("key"))


@query("dense_index_payload", f"WITH {_LINES} SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, row_no AS embedding_index FROM lines")
def dense_index_payload(spark, sf_dir):
    return G.dense_index(_lines(spark, sf_dir), "key").drop("key")


@query("batch_chunks_all", f"WITH {_LINES} SELECT l_orderkey, l_linenumber, l_quantity, row_no // 1000 AS batch_no FROM lines")
def batch_chunks_all(spark, sf_dir):
    return G.chunks(_lines(spark, sf_dir), "key", 1000).select("l_orderkey", "l_linenumber", "l_quantity", "batch_no")


# --- keyframes --------------------------------------------------------------------------------------

_GROUPS = f"""{V.FRAMES},
sims AS (SELECT b.*, CASE WHEN a.pos IS NOT NULL THEN round(list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]), 9) END AS sim FROM frames b LEFT JOIN frames a ON a.segment_id = b.segment_id AND a.pos + 1 = b.pos),
grouped AS (SELECT *, (sum(CASE WHEN sim < {{}} THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS group_id FROM sims)"""
_CANDIDATES = """numbered AS (SELECT *, count(*) OVER (PARTITION BY segment_id, group_id) AS n, row_number() OVER (PARTITION BY segment_id, group_id ORDER BY pos) - 1 AS i FROM grouped),
cands AS (SELECT * FROM numbered WHERE n = 1 OR list_contains(list_transform(range(least(n, 10)), lambda j: (j * (n - 1)) // greatest(least(n, 10) - 1, 1)), i))"""
_MEDOIDS = """totals AS (SELECT a.segment_id, a.group_id, a.n, a.pos, a.frame_idx, round(sum(list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[])), 9) AS s FROM cands a JOIN cands b ON a.segment_id = b.segment_id AND a.group_id = b.group_id GROUP BY ALL),
medoids AS (SELECT segment_id, group_id, n AS num_frames, pos, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY segment_id, group_id ORDER BY s DESC, pos) AS k FROM totals) WHERE k = 1)"""
THRESHOLD = -0.15


def _grouped(spark, sf_dir, threshold=THRESHOLD):
    return K.groups(V.frames(spark, sf_dir), threshold)


@query("frame_groups", f"WITH {_GROUPS.format(0.0)} SELECT segment_id, pos, frame_idx, round(sim, 6) AS sim, group_id FROM grouped")
def frame_groups(spark, sf_dir):
    return _grouped(spark, sf_dir, 0.0).select("segment_id", "pos", "frame_idx", *r6("sim"), "group_id")


@query("linspace_candidates", f"WITH {_GROUPS.format(THRESHOLD)}, {_CANDIDATES} SELECT segment_id, group_id, pos FROM cands")
def linspace_candidates(spark, sf_dir):
    return K.candidates(_grouped(spark, sf_dir)).select("segment_id", "group_id", "pos")


@query("keyframes_medoid", f"""WITH {_GROUPS.format(THRESHOLD)}, {_CANDIDATES}, {_MEDOIDS},
ends AS (SELECT segment_id, group_id, min(frame_idx) AS a, max(frame_idx) AS b FROM grouped GROUP BY ALL)
SELECT m.segment_id, m.group_id, a AS local_start_frame, b AS local_end_frame, num_frames, frame_idx AS local_keyframe, 1000 + a AS global_start_frame, 1000 + b AS global_end_frame, 1000 + frame_idx AS global_keyframe,
 m.segment_id || '/keyframe_' || lpad(frame_idx::VARCHAR, 8, '0') || '.jpg' AS image_path FROM medoids m JOIN ends e ON m.segment_id = e.segment_id AND m.group_id = e.group_id""")
def keyframes_medoid(spark, sf_dir):
    g = _grouped(spark, sf_dir)
    segs = V.table(spark, sf_dir, "embeddings").select(F.concat(F.lit("s"), F.col("label").cast("string")).alias("segment_id")).distinct().withColumn("global_start_frame_of_segment", F.lit(1000).cast("long"))
    return K.keyframe_table(g, segs)


@query("running_offset", """SELECT conv_id, turn, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM conversations""")
def running_offset(spark, sf_dir):
    c = V.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n"))
    return K.running_offset(c, "conv_id", "turn", "n")


@query("frame_from_name", "SELECT vec_id, CASE WHEN vec_id % 3 <> 0 THEN vec_id END AS frame FROM embeddings")
def frame_from_name(spark, sf_dir):
    name = F.when(F.col("vec_id") % 3 != 0, F.concat(F.lit("keyframe_"), F.lpad(F.col("vec_id").cast("string"), 8, "0"), F.lit(".jpg"))).otherwise("cover.jpg")
    return V.table(spark, sf_dir, "embeddings").select("vec_id", K.frame_from_name(name).alias("frame"))


@query("keyframe_meta_join", f"WITH {_GROUPS.format(THRESHOLD)}, {_CANDIDATES}, {_MEDOIDS} SELECT e.vec_id AS frame_idx, m.segment_id, m.group_id FROM embeddings e JOIN medoids m ON m.frame_idx = e.vec_id AND m.segment_id = 's' || e.label")
def keyframe_meta_join(spark, sf_dir):
    files = V.table(spark, sf_dir, "embeddings").select(F.concat(F.lit("s"), F.col("label").cast("string")).alias("segment_id"), F.col("vec_id").alias("frame_idx"))
    m = K.medoids(_grouped(spark, sf_dir)).select("segment_id", "group_id", F.col("frame_idx").alias("global_keyframe"))
    return P.keyframe_meta(files, m, ("segment_id",)).select("frame_idx", "segment_id", "group_id")


# --- transcripts ------------------------------------------------------------------------------------

_CLEAN = r"regexp_replace(trim(regexp_replace({}, '[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g')), '\s+([,.;:!?])', '\1', 'g')"
_QUALITY = "CASE WHEN confidence IS NULL THEN 'REVIEW' WHEN confidence < 0.50 THEN 'NCR' WHEN confidence >= 0.70 THEN 'RELIABLE' ELSE 'REVIEW' END"
_TURNS = f"""steps AS (SELECT *, {_QUALITY} AS quality, CASE WHEN lag(speaker) OVER w IS NOT DISTINCT FROM speaker AND round(start_sec - lag(end_sec) OVER w, 3) <= 1.5 THEN 0 ELSE 1 END AS fresh FROM sentences WINDOW w AS (PARTITION BY segment_id ORDER BY start_sec, end_sec, sent_no)),
in_turns AS (SELECT *, (sum(fresh) OVER (PARTITION BY segment_id ORDER BY start_sec, end_sec, sent_no ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS turn_no FROM steps)"""


@query("clean_text", f"SELECT doc_id, {_CLEAN.format('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query("quality_class", f"WITH {V.SENTENCES} SELECT segment_id, sent_no, confidence, {_QUALITY} AS quality FROM sentences")
def quality_class(spark, sf_dir):
    return V.sentences(spark, sf_dir).select("segment_id", "sent_no", "confidence", X.quality(F.col("confidence")).alias("quality"))


@query("confidence_score", "SELECT user_id, round(avg(CASE WHEN event_type <> 'click' THEN -(event_id % 50)::DOUBLE END), 4) AS avg_logprob, round(exp(greatest(-20.0, avg(CASE WHEN event_type <> 'click' THEN -(event_id % 50)::DOUBLE END))), 4) AS confidence FROM events GROUP BY user_id")
def confidence_score(spark, sf_dir):
    t = V.table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "click", -(F.col("event_id") % 50).cast("double")).alias("logp"))
    return R.confidence(t, ["user_id"])


@query("pad_clamp", f"WITH {V.WORDS} SELECT segment_id, word_no, round_even(greatest(0.0, start_sec - 0.15) * 16000, 0)::BIGINT AS from_sample, round_even(least(100.0, end_sec + 0.15) * 16000, 0)::BIGINT AS to_sample FROM words")
def pad_clamp(spark, sf_dir):
    return R.pad_clamp(V.words(spark, sf_dir).withColumn("duration_sec", F.lit(100.0))).select("segment_id", "word_no", "from_sample", "to_sample")


@query("region_filter", f"WITH {_SPEECH} SELECT video_id, idx, start_sample / 16000.0::DOUBLE AS start_sec, end_sample / 16000.0::DOUBLE AS end_sec FROM speech WHERE end_sample / 16000.0::DOUBLE - start_sample / 16000.0::DOUBLE >= 0.35")
def region_filter(spark, sf_dir):
    s = V.speech(spark, sf_dir).select("video_id", "idx", (F.col("start_sample") / 16000).alias("start_sec"), (F.col("end_sample") / 16000).alias("end_sec"))
    return R.region_filter(s)


@query("word_rebase", """WITH w AS (SELECT event_id, (user_id % 7)::DOUBLE AS a, (user_id % 7 + 20)::DOUBLE AS b, CASE WHEN event_id % 4 <> 0 THEN value / 10 END AS s, CASE WHEN event_id % 6 <> 0 THEN value / 7 + 1 END AS e, user_id * 60.0::DOUBLE AS o FROM events),
t AS (SELECT event_id, o, round(a + coalesce(s, 0), 3) AS start_sec, round(least(a + coalesce(e, b - a), b), 3) AS end_sec FROM w)
SELECT event_id, start_sec, end_sec, round(o + start_sec, 3) AS source_start, round(o + end_sec, 3) AS source_end FROM t""")
def word_rebase(spark, sf_dir):
    e, a = V.table(spark, sf_dir, "events"), (F.col("user_id") % 7).cast("double")
    w = e.select("event_id", a.alias("region_start"), (a + 20).alias("region_end"), F.when(F.col("event_id") % 4 != 0, F.col("value") / 10).alias("rel_start"), F.when(F.col("event_id") % 6 != 0, F.col("value") / 7 + 1).alias("rel_end"), (F.col("user_id") * 60.0).alias("clip_offset"))
    return R.rebase_words(w).select("event_id", "start_sec", "end_sec", "source_start", "source_end")


@query("assign_speaker", f"""WITH {V.WORDS}, {V.DIARISATION},
m AS (SELECT w.segment_id, w.word_no, d.turn_no, d.speaker AS who, round(least(w.end_sec, d.end_sec) - greatest(w.start_sec, d.start_sec), 6) AS ov,
  CASE WHEN (w.start_sec + w.end_sec) / 2 BETWEEN d.start_sec AND d.end_sec THEN 0 ELSE round(least(abs((w.start_sec + w.end_sec) / 2 - d.start_sec), abs((w.start_sec + w.end_sec) / 2 - d.end_sec)), 6) END AS dist
  FROM words w LEFT JOIN diar d ON w.segment_id = d.segment_id)
SELECT segment_id, word_no, coalesce((max({{'ov': ov, 'who': who}}) FILTER (ov > 0)).who, arg_min(who, {{'dist': dist, 'turn_no': turn_no}}), 'UNKNOWN') AS speaker FROM m GROUP BY segment_id, word_no""")
def assign_speaker(spark, sf_dir):
    return R.assign_speaker(V.words(spark, sf_dir), V.diarisation(spark, sf_dir))


_FOLD = f"""WITH RECURSIVE {V.WORDS},
ordered AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY start_sec, word_no) AS i, regexp_matches(regexp_replace(text, '["'')\\]}}”’» ]+$', ''), '[.!?…]$') AS stop FROM words),
fold AS (SELECT segment_id, i, word_no, text, start_sec, end_sec, speaker, 0::BIGINT AS sid, start_sec AS st, stop OR round(end_sec - start_sec, 3) >= 18 AS closed FROM ordered WHERE i = 1
 UNION ALL
 SELECT segment_id, i, word_no, text, start_sec, end_sec, speaker, sid + cut::BIGINT, CASE WHEN cut THEN start_sec ELSE st END, stop OR round(end_sec - CASE WHEN cut THEN start_sec ELSE st END, 3) >= 18
 FROM (SELECT o.*, f.sid, f.st, f.closed OR round(o.start_sec - f.end_sec, 3) >= 0.85 OR o.speaker <> f.speaker AS cut FROM fold f JOIN ordered o ON o.segment_id = f.segment_id AND o.i = f.i + 1))"""


@query("sentence_split", _FOLD + " SELECT segment_id, sid AS sent_no, round(min(start_sec), 3) AS start_sec, round(arg_max(end_sec, i), 3) AS end_sec, " + _CLEAN.format("string_agg(text, '' ORDER BY i)") + " AS text, count(*) AS word_count, arg_min(speaker, i) AS speaker FROM fold GROUP BY segment_id, sid")
def sentence_split(spark, sf_dir):
    return R.sentences(V.words(spark, sf_dir), ["segment_id"])


@query("sentence_split_long", _FOLD.replace("words),\nordered", "words),\nordered", 1).replace("0.85", "2.0").replace("OR o.speaker <> f.speaker", "").replace("18", "3") + " SELECT segment_id, word_no, sid AS sent_no FROM fold")
def sentence_split_long(spark, sf_dir):
    """Longer pauses, no speakers and a short span, so that the resettable state decides."""
    w = V.words(spark, sf_dir).withColumn("speaker", F.lit(None).cast("string"))
    return R.sentence_numbers(w, ["segment_id"], 2.0, 3.0).select("segment_id", "word_no", "sent_no")


@query("turn_grouping", f"WITH {V.SENTENCES}, {_TURNS} SELECT segment_id, turn_no, arg_min(speaker, sent_no) AS speaker, min(start_sec) AS start, arg_max(end_sec, {{'a': start_sec, 'b': end_sec, 'c': sent_no}}) AS \"end\", count(*) AS sentences FROM in_turns GROUP BY segment_id, turn_no")
def turn_grouping(spark, sf_dir):
    return R.turns(V.sentences(spark, sf_dir)).select("segment_id", "turn_no", "speaker", "start", "end", F.size("sentences").cast("long").alias("sentences"))


@query("flatten_transcript", f"WITH {V.SENTENCES}, flat AS (SELECT segment_id, string_agg(text, ' ' ORDER BY start_sec, end_sec, sent_no) AS t FROM sentences GROUP BY segment_id) SELECT segment_id, {_CLEAN.format('t')} AS full_text FROM flat")
def flatten_transcript(spark, sf_dir):
    return R.transcripts(R.turns(V.sentences(spark, sf_dir))).select("segment_id", "full_text")


@query("transcript_summary", f"WITH {V.SENTENCES}, {_TURNS} SELECT segment_id, count(DISTINCT turn_no) AS turn_count, count(*) AS sentence_count, count(*) FILTER (quality = 'RELIABLE') AS reliable_count, count(*) FILTER (quality = 'REVIEW') AS review_count, count(*) FILTER (quality = 'NCR') AS ncr_count FROM in_turns GROUP BY segment_id")
def transcript_summary(spark, sf_dir):
    return R.summary(R.turns(V.sentences(spark, sf_dir)))


@query("quality_totals", f"WITH {V.SENTENCES} SELECT t.quality, count(s.q) AS n FROM (VALUES ('RELIABLE'), ('REVIEW'), ('NCR')) t(quality) LEFT JOIN (SELECT {_QUALITY} AS q FROM sentences) s ON s.q = t.quality GROUP BY t.quality")
def quality_totals(spark, sf_dir):
    return R.quality_totals(V.sentences(spark, sf_dir))


@query("session_gap", f"""WITH {V.WORDS}, f AS (SELECT *, CASE WHEN start_sec - lag(end_sec) OVER w <= 1.5 THEN 0 ELSE 1 END AS fresh FROM words WINDOW w AS (PARTITION BY segment_id ORDER BY start_sec, word_no)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY segment_id ORDER BY start_sec, word_no ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM f)
SELECT segment_id, session, min(start_sec) AS start_sec, max(end_sec) AS end_sec, count(*) AS n FROM s GROUP BY segment_id, session""")
def session_gap(spark, sf_dir):
    w = Window.partitionBy("segment_id").orderBy("start_sec", "word_no")
    fresh = F.when(F.col("start_sec") - F.lag("end_sec").over(w) <= 1.5, 0).otherwise(1)
    d = V.words(spark, sf_dir).withColumn("fresh", fresh).withColumn("session", F.sum("fresh").over(w))
    return d.groupBy("segment_id", "session").agg(F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), F.count("*").alias("n"))


# --- sources and store ------------------------------------------------------------------------------


@query("src_discover", "SELECT url AS path, regexp_extract(url, '([^/]+)\\.[^./]*$', 1) AS video_id FROM (SELECT DISTINCT url FROM pages WHERE ends_with(url, '.html') OR ends_with(url, '7')) ORDER BY url OFFSET 5 LIMIT 40")
def src_discover(spark, sf_dir):
    return I.discover(V.table(spark, sf_dir, "pages").select(F.col("url").alias("path")).distinct(), 5, 40, (".html", "7"))


@query("manifest_explode", f"WITH {_SPEECH}, {_SPLITS}, {_VIDEOS}, {_SEGMENTS} SELECT video_id, segment_id, segment_id || '.mp4' AS file_path, start_time_sec, end_time_sec, duration_sec, global_start_frame FROM segments")
def manifest_explode(spark, sf_dir):
    s = _segments(spark, sf_dir).withColumn("file_path", F.concat("segment_id", F.lit(".mp4")))
    m = s.groupBy("video_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("segment_id", "file_path", "start_time_sec", "end_time_sec", "duration_sec", "global_start_frame")))).alias("json"))
    kind = I.MANIFEST.split("segments ", 1)[1]
    return I.explode_manifest(m.select("video_id", F.from_json("json", kind).alias("segments")))


@query("natural_sort", "SELECT url, row_number() OVER (ORDER BY k, url) AS n FROM (SELECT url, array_to_string(list_transform(regexp_extract_all(lower(url), '\\d+|\\D+'), lambda t: CASE WHEN regexp_full_match(t, '\\d+') THEN lpad(t, 20, '0') ELSE t END), '') AS k FROM (SELECT DISTINCT url FROM pages))")
def natural_sort(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages").select("url").distinct().withColumn("key", F.struct(X.natural_key(F.col("url")).alias("k"), "url"))
    return G.dense_index(p, "key", "n").select("url", (F.col("n") + 1).alias("n"))


@query("timeline_lookup", "SELECT page_id, page_id % 3 <> 0 AS known, CASE WHEN page_id % 3 <> 0 THEN page_id * 10.0::DOUBLE END AS clip_offset FROM pages")
def timeline_lookup(spark, sf_dir):
    p = V.table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("clips/x/"), F.col("page_id").cast("string"), F.lit(".mp4")).alias("path"))
    t = p.where("page_id % 3 <> 0").select(X.base_name(F.col("path")).alias("file"), (F.col("page_id") * 10.0).alias("clip_offset"))
    return P.timeline_lookup(p, t).select("page_id", F.col("clip_offset").isNotNull().alias("known"), "clip_offset")


@query("collection_info", f"WITH {V.POINTS} SELECT collection, count(*) AS points, max(len(vector)) AS vector_size, 'cosine' AS distance, CASE collection WHEN 'kf' THEN 'end_time_sec,frame_index,image_path,point_type,segment_id,start_time_sec,video_id' ELSE 'end_time_sec,frame_index,point_type,segment_id,start_time_sec,text,video_id' END AS payload_keys, min(point_id) AS sample_id FROM points GROUP BY collection")
def collection_info(spark, sf_dir):
    return P.describe(V.points(spark, sf_dir))


def _uuid(namespace: str, name: str) -> str:
    h = f"sha1(unhex('{namespace}') || encode({name}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', 1 + (('0x' || substr({h}, 17, 1))::INTEGER & 3), 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_NAME = "video_id || '_' || segment_id || CASE point_type WHEN 'keyframe' THEN '_kf_' ELSE '_cap_' END || frame_index"


@query("point_uuid5", f"WITH {V.POINTS} SELECT frame_index, {_uuid(X.DNS, _NAME)} AS point_id FROM points")
def point_uuid5(spark, sf_dir):
    return P.with_ids(V.points(spark, sf_dir)).select("frame_index", "point_id")


_UPSERT = """seen AS (SELECT point_id, CASE WHEN frame_index % 7 <> 0 THEN frame_index END AS frame_index, text, frame_index AS k FROM points),
batch AS (SELECT point_id, frame_index, 'new ' || k AS text, 1 AS arrived FROM seen WHERE k % 5 = 0 UNION ALL SELECT point_id, frame_index, 'newer ' || k, 2 FROM seen WHERE k % 10 = 0
  UNION ALL SELECT 'x' || point_id, frame_index, 'added', 1 FROM seen WHERE k % 50 = 0 UNION ALL SELECT 'x' || point_id, frame_index, 'again', 3 FROM seen WHERE k % 100 = 0),
fresh AS (SELECT point_id, arg_max({'f': frame_index, 't': text}, arrived) AS r FROM batch GROUP BY point_id)"""


@query("upsert_points", f"WITH {V.POINTS}, {_UPSERT} SELECT point_id, r.f AS frame_index, r.t AS text FROM fresh UNION ALL SELECT point_id, frame_index, text FROM seen WHERE k % 5 <> 0")
def upsert_points(spark, sf_dir):
    """A batch that replaces points, adds some, names some twice, and has frames that are null."""
    k = F.col("k")
    seen = V.points(spark, sf_dir).select("point_id", F.when(F.col("frame_index") % 7 != 0, F.col("frame_index")).alias("frame_index"), "text", F.col("frame_index").alias("k"))
    text = lambda part, word, n: part.withColumns({"text": F.concat(F.lit(f"{word} "), k.cast("string")), "arrived": F.lit(n)})
    add = lambda part, word, n: part.withColumns({"point_id": F.concat(F.lit("x"), F.col("point_id")), "text": F.lit(word), "arrived": F.lit(n)})
    batch = text(seen.where(k % 5 == 0), "new", 1).unionByName(text(seen.where(k % 10 == 0), "newer", 2)).unionByName(add(seen.where(k % 50 == 0), "added", 1)).unionByName(add(seen.where(k % 100 == 0), "again", 3))
    return P.upsert(seen, batch, order="arrived").select("point_id", "frame_index", "text")


@query("merge_collections", f"WITH {V.POINTS}, m AS (SELECT *, 'v1' AS version FROM points WHERE collection = 'kf' UNION ALL SELECT *, 'v2' FROM points WHERE collection = 'cap') SELECT 'merged' AS collection, version, point_id AS original_id, {_uuid(X.OID, chr(118) + 'ersion || ' + repr('_') + ' || point_id')} AS point_id, video_id, frame_index FROM m")
def merge_collections(spark, sf_dir):
    p = V.points(spark, sf_dir)
    m = P.merge({"v1": p.where("collection = 'kf'"), "v2": p.where("collection = 'cap'"), "v3": None}, "merged")
    return m.select("collection", "version", "original_id", "point_id", "video_id", "frame_index")


@query("zip_by_position", "SELECT conv_id, turn AS pos, length(text) AS vector, role AS item FROM conversations WHERE conv_id % 4 <> 0")
def zip_by_position(spark, sf_dir):
    c = V.table(spark, sf_dir, "conversations")
    order = lambda x: F.transform(F.sort_array(F.collect_list(F.struct("turn", x.alias("x")))), lambda s: s["x"])
    vectors = c.groupBy("conv_id").agg(order(F.length("text").cast("long")).alias("vectors"))
    items = c.where("conv_id % 4 <> 0 or turn > 0").groupBy("conv_id").agg(order(F.col("role")).alias("items"))
    return P.zip_by_position(vectors, items, "conv_id").select("conv_id", F.col("pos").cast("long").alias("pos"), "vector", "item")


_FX = "segs AS (SELECT o_orderkey AS k, 'g' || o_orderkey AS segment_id, 'v' || o_custkey AS video_id, o_orderkey * 25 AS gsf, o_orderkey * 1.0::DOUBLE AS a, o_orderkey + 1.0::DOUBLE AS b FROM orders)"


def _segs(spark, sf_dir):
    k = F.col("o_orderkey")
    return V.table(spark, sf_dir, "orders").select(F.concat(F.lit("g"), k.cast("string")).alias("segment_id"), F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("video_id"), (k * 25).alias("global_start_frame"), (k * 1.0).alias("start_time_sec"), (k + 1.0).alias("end_time_sec"))


@query("embed_gather", f"""WITH {_FX} SELECT video_id, segment_id, 'keyframe' AS point_type, gsf + l_linenumber AS frame_index, a AS start_time_sec, b AS end_time_sec, segment_id || '/' || l_linenumber || '.jpg' AS image_path, NULL::VARCHAR AS text FROM segs JOIN lineitem ON l_orderkey = k
UNION ALL SELECT video_id, segment_id, 'caption', gsf, a, b, NULL, o_orderpriority FROM segs JOIN orders ON o_orderkey = k WHERE k % 3 <> 0
UNION ALL SELECT video_id, segment_id, 'transcript', gsf, a, b, NULL, o_orderstatus FROM segs JOIN orders ON o_orderkey = k WHERE o_orderstatus <> 'O'""")
def embed_gather(spark, sf_dir):
    o, n = V.table(spark, sf_dir, "orders"), V.table(spark, sf_dir, "lineitem")
    g = F.concat(F.lit("g"), F.col("o_orderkey").cast("string")).alias("segment_id")
    seg = F.concat(F.lit("g"), F.col("l_orderkey").cast("string"))
    kf = n.select(seg.alias("segment_id"), (F.col("l_orderkey") * 25 + F.col("l_linenumber")).alias("global_keyframe"), F.concat(seg, F.lit("/"), F.col("l_linenumber").cast("string"), F.lit(".jpg")).alias("image_path"))
    cap = o.select(g, F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).otherwise("").alias("caption"))
    tr = o.select(g, F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise("").alias("full_text"))
    return P.gather(_segs(spark, sf_dir), kf, cap, tr, embed_transcripts=True)


@query("caption_lookup", "SELECT d.doc_id, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id * 25 END, 0) AS global_start_frame, d.lang AS caption FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def caption_lookup(spark, sf_dir):
    c = V.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("segment_id"), F.col("lang").alias("caption"))
    s = V.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("segment_id"), (F.col("doc_id") * 25).alias("global_start_frame"))
    return P.caption_lookup(c, s).select("doc_id", "global_start_frame", "caption")


@query("all_captions", "SELECT 'v' || (doc_id % 17) AS video_id, string_agg(lang || doc_id, '|' ORDER BY n_chars, doc_id) AS captions FROM documents GROUP BY ALL")
def all_captions(spark, sf_dir):
    c = V.table(spark, sf_dir, "documents").select(F.concat(F.lit("v"), (F.col("doc_id") % 17).cast("string")).alias("video_id"), F.col("n_chars").alias("global_start_frame"), F.col("doc_id").alias("segment_id"), F.concat("lang", F.col("doc_id").cast("string")).alias("caption"))
    return P.all_captions(c).select("video_id", F.array_join("captions.caption", "|").alias("captions"))


@query("resume_antijoin", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def resume_antijoin(spark, sf_dir):
    done = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_quantity") > 45).alias("valid"))
    return P.resume(V.table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("run_stats", "SELECT 'v' || user_id AS video_id, count(*) FILTER (event_id % 5 > 1) AS processed, count(*) FILTER (event_id % 5 = 1) AS skipped, count(*) FILTER (event_id % 5 = 0) AS errors FROM events GROUP BY ALL")
def run_stats(spark, sf_dir):
    k = F.col("event_id") % 5
    return P.run_stats(V.table(spark, sf_dir, "events").select(F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video_id"), F.when(k > 1, "processed").when(k == 1, "skipped").otherwise("error").alias("status")))


@query("json_props", "SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS total, count(*) AS n FROM events GROUP BY event_type")
def json_props(spark, sf_dir):
    return V.table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.from_json("props", "k bigint")["k"]).alias("total"), F.count("*").alias("n"))


@query("embed_text", r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM w), b AS (SELECT doc_id, h % 64 AS k, sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END)::DOUBLE AS s FROM h GROUP BY ALL),
n AS (SELECT doc_id, sqrt(sum(s * s)) AS n, max(s) FILTER (k = 0) AS s0, max(s) FILTER (k = 63) AS s63 FROM b GROUP BY doc_id)
SELECT doc_id, 64 AS size, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm, round(coalesce(s0 / nullif(n, 0), 0)::FLOAT::DOUBLE, 6) AS first, round(coalesce(s63 / nullif(n, 0), 0)::FLOAT::DOUBLE, 6) AS last FROM documents LEFT JOIN n USING (doc_id)""")
def embed_text(spark, sf_dir):
    from ..operators.slots import TEXT_STAND_IN, embed_texts

    out = embed_texts(V.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", TEXT_STAND_IN)
    part = lambda k: F.round(F.element_at("vector", k).cast("double"), 6)
    return out.select("doc_id", F.size("vector").alias("size"), F.round(X.l2norm(F.col("vector")), 6).alias("norm"), part(1).alias("first"), part(-1).alias("last"))


@query("live_turns", f"WITH {V.SENTENCES}, {_TURNS} SELECT segment_id, turn_no, arg_min(speaker, sent_no) AS speaker, min(start_sec) AS start, arg_max(end_sec, sent_no) AS \"end\", count(*) AS sentences FROM in_turns GROUP BY segment_id, turn_no")
def live_turns(spark, sf_dir):
    """Turn grouping as a stream: one file of sentences, read once."""
    return ingest.replay_turns(V.sentences(spark, sf_dir))
