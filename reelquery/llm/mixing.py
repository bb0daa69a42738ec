"""Operator 8: mixing sources to target weights by temperature, realised as budgeted block permutations.

Source token shares p become weights proportional to p^t. The exponent t in [0, 1] is bisected: the
smallest one at which the mixture's entropy is at most ``ENTROPY`` of the largest possible and no source
is used more than ``REPEATS`` times. The default budget is the smallest that uses every source at least
once, so no document is lost; a budget in tokens may be given instead, and then large sources are cut.

A source's budget is whole epochs and a rest. In each epoch its blocks (``BLOCK`` documents or so, by a hash
of the id) come in a new order, and so do the documents of a block; the rest takes the first blocks of one
more epoch, up to the document that meets the budget. Running totals are taken over blocks first and then
within blocks, so no source is one task. ``position`` is the used share of the source's budget: in its
order every stretch of the stream holds the sources at their weights.

Where no exponent meets the target (sources of like size have too much entropy at any), t is 1, the sources' own shares, and
``target_met`` is false.

Tokens are words here (``tokens`` takes any column). Null sources are a source of their own. Documents
without tokens come once an epoch and cost nothing; a source without tokens is used once. Very long texts are counted whole
and may pass the budget by what the last one has. Ties in the order of blocks and documents are broken by their numbers and ids. Rows with equal
ids share a block and are told apart by nothing else. An empty table gives no placements. Other columns
aren't read.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, quoted, unused

ENTROPY, REPEATS, BLOCK, SEED = 0.98, 2.0, 1000, 7
#: Bound of the table of sources that the driver holds.
MOST_SOURCES = 100_000


def weights_at(totals: list[float], t: float) -> list[float]:
    top = max(totals)
    raw = [(x / top) ** t if x else 0.0 for x in totals]
    return [x / sum(raw) for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w)


def solve(totals: list[float], budget: float | None = None, target: float = ENTROPY, repeats: float = REPEATS) -> tuple[float, list[float], list[float]]:
    """The exponent, the weights and the repetitions of each source."""

    def at(t: float):
        w = weights_at(totals, t)
        b = budget if budget is not None else max(x / v for x, v in zip(totals, w, strict=True) if x)
        return w, [v * b / x if x else 1.0 for x, v in zip(totals, w, strict=True)]

    def fits(t: float) -> bool:
        w, r = at(t)
        return entropy(w) <= target * math.log(max(2, sum(1 for x in totals if x))) + 1e-12 and max(r) <= repeats + 1e-9

    low, high = 0.0, 1.0
    if not any(totals):
        return 1.0, [0.0] * len(totals), [1.0] * len(totals)
    if fits(0.0):
        high = 0.0
    for _ in range(60 if high else 0):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high, *at(high)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tokens: Column | None = None, budget: float | None = None, target: float = ENTROPY, repeats: float = REPEATS, seed: int = SEED) -> DataFrame:
    """One row a placement: id, source, n_tokens, weight, repetitions, epoch, block, position, exponent, target_met."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    d = scratch.write(docs.select(quoted(id_col).alias("id"), quoted(source_col).alias("source"), (tokens if tokens is not None else word_count(quoted(text_col))).alias("n_tokens")), "docs")
    sources = d.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).orderBy("source").limit(MOST_SOURCES + 1).toArrow()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals, counts = (sources.column(k).to_pylist() for k in ("t", "n"))
    exponent, met, weights, reps = 1.0, True, [], []
    if totals:
        exponent, weights, reps = solve([float(t) for t in totals], budget, target, repeats)
        met = entropy(weights) <= target * math.log(max(2, sum(1 for t in totals if t))) + 1e-9 and max(reps) <= repeats + 1e-9
    rows = pa.table({"_source": sources.column("source"), "weight": pa.array(weights, pa.float64()), "repetitions": pa.array(reps, pa.float64()), "_t": sources.column("t"), "_blocks": pa.array([-(-n // BLOCK) for n in counts], pa.int64())})
    plan = F.broadcast(spark.createDataFrame(rows))  # MOST_SOURCES rows at most; from Arrow, as a list would start Python workers of its own
    d = d.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("_blocks")))
    epochs = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("repetitions") - 1e-9), F.lit(1)).cast("int") - 1)).alias("epoch")
    blocks = d.groupBy("source", "block").agg(F.sum("n_tokens").alias("_bt"), F.first("_t").alias("_t"), F.first("repetitions").alias("_r")).select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_r") - 1e-9), F.lit(1)).cast("int") - 1)).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "source", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(F.col("source").alias("s2"), F.col("block").alias("b2"), F.col("epoch").alias("e2"), F.coalesce(F.sum("_bt").over(order), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("source", "block", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "id"), "id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    out = d.select("*", epochs).withColumn("_in", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    out = out.join(before, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")) & (F.col("epoch") == F.col("e2")))
    used = F.col("epoch") + F.when(F.col("_t") > 0, (F.col("_before") + F.col("_in")) / F.col("_t")).otherwise(0.0)
    # whole epochs hold every document, wordless ones at their end too; the rest of the budget is met by counting
    whole = F.col("epoch") < F.floor(F.col("repetitions") + 1e-9)
    out = out.withColumn("_used", used).where(whole | (F.col("_used") < F.col("repetitions") - 1e-9))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", "weight", "repetitions", F.col("epoch").cast("long").alias("epoch"), "block", F.least(F.col("_used") / F.col("repetitions"), F.lit(1.0)).alias("position"), F.lit(exponent).alias("exponent"), F.lit(met).alias("target_met"))


def realise(docs: DataFrame, id_col: str = "doc_id", ordered: bool = True, **options) -> DataFrame:
    """docs with each row as often as the mixture uses it, in the order of the mixture: by position, from partition to partition and within each.

    ordered=False leaves the rows where they are, for readers that give them places of their own: a range sort of whole texts is saved.

    Of rows with equal ids each comes as often as the id is placed by one of them.
    """
    number, at = unused(docs, "epoch", "position")
    key, = unused(docs.withColumns({number: F.lit(0), at: F.lit(0)}), "id")
    placed = mix(docs, id_col, **options).groupBy(quoted(id_col).alias(key), F.col("epoch").alias(number)).agg(F.min("position").alias(at))
    # a document of a late epoch is in all earlier ones, so its places are one row
    placed = placed.groupBy(key).agg(F.collect_list(at).alias(at))
    both = docs.join(placed, quoted(id_col).eqNullSafe(F.col(key)))
    names = [quoted(c) for c in docs.columns]
    rows = both.select(*names, F.explode(at).alias(at))
    return (rows.orderBy(at, F.xxhash64(quoted(id_col))) if ordered else rows).select(*names)
