"""Transcripts: words to sentences to speaker turns, speaker assignment, quality, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clean_text, quality, round_sec

#: What closes a sentence, and what may stand after it.
STOPS, CLOSERS = (".", "!", "?", "…"), "\"')]}”’»"


def region_filter(regions: DataFrame, least: float = 0.35) -> DataFrame:
    return regions.where(F.col("end_sec") - F.col("start_sec") >= least)


def pad_clamp(rows: DataFrame, pad: float = 0.15, rate: int = 16_000) -> DataFrame:
    """The audio window around a sentence, within the segment, in samples."""
    a, b = F.greatest(F.lit(0.0), F.col("start_sec") - pad), F.least(F.col("duration_sec"), F.col("end_sec") + pad)
    return rows.withColumns({"from_sample": F.bround(a * rate, 0).cast("long"), "to_sample": F.bround(b * rate, 0).cast("long")})


def rebase_words(words: DataFrame) -> DataFrame:
    """Region-relative word times to segment times: no start is 0, no end the region's length, the end within the region; source times add the clip's offset."""
    start = F.col("region_start") + F.coalesce("rel_start", F.lit(0.0))
    end = F.least(F.col("region_start") + F.coalesce(F.col("rel_end"), F.col("region_end") - F.col("region_start")), F.col("region_end"))
    return words.withColumns({"start_sec": round_sec(start), "end_sec": round_sec(end)}).withColumns({"source_start": round_sec(F.col("clip_offset") + F.col("start_sec")), "source_end": round_sec(F.col("clip_offset") + F.col("end_sec"))})


def confidence(tokens: DataFrame, keys: list[str], value: str = "logp") -> DataFrame:
    """avg_logprob and confidence of each sentence; null where there is no token."""
    mean = F.avg(value)
    return tokens.groupBy(*keys).agg(F.round(mean, 4).alias("avg_logprob"), F.round(F.exp(F.greatest(F.lit(-20.0), mean)), 4).alias("confidence"))


#: Seconds of a time bucket in which words and turns meet.
BUCKET = 10.0


def assign_speaker(words: DataFrame, turns: DataFrame) -> DataFrame:
    """The turn with most overlap names the speaker (the greatest name at ties); without overlap the turn nearest to the word's middle (the first at ties); without turns UNKNOWN.

    Words meet turns by segment and time bucket, so the rows made are in proportion to words and to the turns
    that touch them, not to words times turns. Words without overlap lie between the last turn that ends before their middle and
    the first that starts after it (or within turns of no length): running extremes over turns and middles in order of time find both.
    """
    t = turns.select("segment_id", "turn_no", F.col("start_sec").alias("ts"), F.col("end_sec").alias("te"), F.col("speaker").alias("who"))
    w = words.select("segment_id", "word_no", "start_sec", "end_sec")
    buckets = lambda a, b: F.explode(F.sequence(F.floor(F.least(a, b) / BUCKET), F.floor(F.greatest(a, b) / BUCKET))).alias("bucket")
    met = w.select("*", buckets("start_sec", "end_sec")).join(t.select("*", buckets("ts", "te")), ["segment_id", "bucket"])
    overlap = F.round(F.least("end_sec", "te") - F.greatest("start_sec", "ts"), 6)
    best = met.withColumn("ov", overlap).where("ov > 0").groupBy("segment_id", "word_no").agg(F.max(F.struct("ov", "who"))["who"].alias("a"))
    rest = w.join(best, ["segment_id", "word_no"], "left")

    # all events of a segment by time: turns as they start and end, middles of words
    mid = (F.col("start_sec") + F.col("end_sec")) / 2
    none = F.lit(None)
    ended = t.select("segment_id", F.col("te").alias("at"), F.lit(0).alias("kind"), F.struct("te", (-F.col("turn_no")).alias("k"), "who", "turn_no").alias("ended"), none.alias("begun"), none.cast("long").alias("word_no"))
    asked = rest.where("a is null").select("segment_id", mid.alias("at"), F.lit(1).alias("kind"), none.alias("ended"), none.alias("begun"), "word_no")
    begun = t.select("segment_id", F.col("ts").alias("at"), F.lit(2).alias("kind"), none.alias("ended"), F.struct("ts", "turn_no", "who").alias("begun"), none.cast("long").alias("word_no"))
    events = ended.unionByName(asked).unionByName(begun)
    past = Window.partitionBy("segment_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("segment_id").orderBy(F.desc("at"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = events.withColumns({"l": F.max("ended").over(past), "r": F.min("begun").over(ahead)}).where("kind = 1")
    side = lambda c, d: F.when(F.col(c).isNotNull(), F.struct(F.round(d, 6).alias("dist"), F.col(c)["turn_no"].alias("turn_no"), F.col(c)["who"].alias("who")))
    near = near.select("segment_id", "word_no", side("l", F.col("at") - F.col("l.te")).alias("l"), side("r", F.col("r.ts") - F.col("at")).alias("r"), "at")
    # a turn around the middle (of a word of no length, so without overlap) is nearest of all
    inside = met.withColumn("mid", mid).where("mid between ts and te").groupBy("segment_id", "word_no").agg(F.min(F.struct(F.lit(0.0).alias("dist"), "turn_no", "who")).alias("i"))
    near = near.join(inside, ["segment_id", "word_no"], "left").select("segment_id", "word_no", F.least("l", "r", "i")["who"].alias("b"))
    return rest.join(near, ["segment_id", "word_no"], "left").select("segment_id", "word_no", F.coalesce("a", "b", F.lit("UNKNOWN")).alias("speaker"))


def _ends_sentence(text):
    t = F.rtrim(F.rtrim(text, F.lit(CLOSERS + " ")), F.lit(" "))
    return t.endswith(STOPS[0]) | t.endswith(STOPS[1]) | t.endswith(STOPS[2]) | t.endswith(STOPS[3])


def sentence_numbers(words: DataFrame, keys: list[str], pause: float = 0.85, longest: float = 18.0) -> DataFrame:
    """Adds sent_no. A word opens a sentence after a pause or a change of speaker; a stop or a span as long as `longest` closes one.

    The span counts from the sentence's start, a state that fixed windows can't hold. So a window first cuts where
    pauses, speakers and stops say; only in pieces that are too long a fold over the sorted words resets the span.
    Pieces are short, so the fold is.
    """
    w = Window.partitionBy(*keys).orderBy("start_sec", "word_no")
    gap = F.round(F.col("start_sec") - F.lag("end_sec").over(w), 3)
    before, now = F.lag("speaker").over(w), F.col("speaker")
    cut = (gap >= pause) | ((F.coalesce(before, F.lit("")) != "") & (F.coalesce(now, F.lit("")) != "") & (before != now)) | _ends_sentence(F.lag("text").over(w))
    d = words.withColumn("_p", F.sum(F.when(F.coalesce(cut, F.lit(False)), 1).otherwise(0)).over(w))
    item = F.struct("start_sec", "word_no", "end_sec")
    pieces = d.groupBy(*keys, "_p").agg(F.sort_array(F.collect_list(item)).alias("ws"))
    start = F.struct(F.lit(0).alias("k"), F.lit(None).cast("double").alias("s"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        s = F.coalesce(a["s"], x["start_sec"])
        over = F.round(x["end_sec"] - s, 3) >= longest
        return F.struct((a["k"] + F.when(over, 1).otherwise(0)).alias("k"), F.when(~over, s).alias("s"), F.concat(a["out"], F.array(a["k"])).alias("out"))

    long_ = F.round(F.array_max(F.transform("ws", lambda x: x["end_sec"])) - F.col("ws")[0]["start_sec"], 3) >= longest
    parts = F.when(long_, F.aggregate("ws", start, step)["out"]).otherwise(F.transform("ws", lambda _: F.lit(0)))
    numbered = pieces.select(*keys, "_p", F.explode(F.arrays_zip(F.col("ws"), parts.alias("part"))).alias("z")).select(*keys, "_p", F.col("z.ws.word_no").alias("word_no"), F.col("z.part").alias("_k"))
    joined = d.join(numbered, [*keys, "_p", "word_no"])
    w2 = Window.partitionBy(*keys).orderBy("_p", "_k")
    return joined.withColumn("sent_no", (F.dense_rank().over(w2) - 1).cast("long")).drop("_p", "_k")


def sentences(words: DataFrame, keys: list[str], pause: float = 0.85, longest: float = 18.0) -> DataFrame:
    """Sentences with their words joined and cleaned; those without text go."""
    d = sentence_numbers(words, keys, pause, longest)
    g = d.groupBy(*keys, "sent_no").agg(
        F.round(F.min("start_sec"), 3).alias("start_sec"), F.round(F.max_by("end_sec", F.struct("start_sec", "word_no")), 3).alias("end_sec"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start_sec", "word_no", "text"))), lambda x: x["text"]), "").alias("text"),
        F.count("*").alias("word_count"), F.min_by("speaker", F.struct("start_sec", "word_no")).alias("speaker"),
    )
    return g.withColumn("text", clean_text(F.col("text"))).where("text <> ''")


def turn_numbers(sents: DataFrame, gap: float = 1.50) -> DataFrame:
    """Adds turn_no: a sentence joins the turn before if the speaker is the same and it starts within `gap` of that turn's last sentence's end."""
    w = Window.partitionBy("segment_id").orderBy("start_sec", "end_sec", "sent_no")
    same = (F.lag("speaker").over(w).eqNullSafe(F.col("speaker"))) & (F.round(F.col("start_sec") - F.lag("end_sec").over(w), 3) <= gap)
    return sents.withColumn("turn_no", F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(w).cast("long") - 1)


def turns(sents: DataFrame, gap: float = 1.50, ncr_below: float = 0.50, reliable_from: float = 0.70) -> DataFrame:
    """Speaker turns with their sentences nested; a turn ends with its last sentence."""
    order = F.struct("start_sec", "end_sec", "sent_no")
    d = turn_numbers(sents, gap).withColumn("quality", quality(F.col("confidence"), ncr_below, reliable_from))
    item = F.struct(F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "sent_no", "text", "confidence", "quality")
    return d.groupBy("segment_id", "turn_no").agg(F.min_by("speaker", order).alias("speaker"), F.min("start_sec").alias("start"), F.max_by("end_sec", order).alias("end"), F.sort_array(F.collect_list(item)).alias("sentences"))


def transcripts(turn_rows: DataFrame) -> DataFrame:
    """One row a segment: turns nested twice, and the flat text."""
    t = turn_rows.groupBy("segment_id").agg(F.sort_array(F.collect_list(F.struct("turn_no", "speaker", "start", "end", "sentences"))).alias("turns"))
    return t.withColumn("full_text", clean_text(F.array_join(F.flatten(F.transform("turns", lambda x: x["sentences"]["text"])), " ")))


def summary(turn_rows: DataFrame) -> DataFrame:
    """Per segment: turns, sentences, and sentences of each quality."""
    count = lambda q: F.sum(F.size(F.filter("sentences", lambda s: F.coalesce(s["quality"], F.lit("REVIEW")) == q))).cast("long")
    return turn_rows.groupBy("segment_id").agg(F.count("*").alias("turn_count"), F.sum(F.size("sentences")).cast("long").alias("sentence_count"), count("RELIABLE").alias("reliable_count"), count("REVIEW").alias("review_count"), count("NCR").alias("ncr_count"))


def quality_totals(sents: DataFrame) -> DataFrame:
    """Sentences of each quality, zeros included."""
    q = quality(F.col("confidence"))
    names = F.array(F.lit("RELIABLE"), F.lit("REVIEW"), F.lit("NCR"))
    one = sents.agg(*[F.count_if(q == n).alias(n) for n in ("RELIABLE", "REVIEW", "NCR")])
    return one.select(F.explode(F.arrays_zip(names.alias("quality"), F.array("RELIABLE", "REVIEW", "NCR").alias("n"))).alias("z")).select("z.quality", "z.n")
