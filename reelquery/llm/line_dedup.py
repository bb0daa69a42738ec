"""Operator 1: line dedup over levelled sorted runs of line hashes (DataFrame operations only).

Documents are taken in batches of falling ids. A batch is hashed once into (line hash, document)
rows. Its own run, one row a line with the number of documents, is merge-joined with the runs of
earlier batches: a line that no earlier run holds (the anti-join) is new, and the largest document of
this batch becomes its keeper; of a line known before, only the count is added. Runs are bucketed and
sorted by hash. As soon as a level has ``FANOUT`` runs they are compacted into one run of the next
level, and at the end all levels into one, whose lines with enough documents are the frequent ones.

Null ids are one id below all others. Null and empty texts are one empty line. Rows with equal ids are one document
where documents are counted, and each gives a row of the result; rows that share the largest id all keep the line.
Very long texts are split as they are, a line of theirs being one row. An empty table gives an empty result. Columns
other than the two named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, BLANKS, Scratch, ascii_lower, quoted

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES, FANOUT, HOT, BUCKET_ROWS = 4, 2, 5000, 5_000_000
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


class LineIndex:
    """The levelled runs. First batch that holds a line keeps it, so batches come in falling order of ids."""

    def __init__(self, scratch: Scratch, buckets: int):
        self.scratch, self.buckets, self.levels, self.made = scratch, buckets, [[]], 0

    def _write(self, df: DataFrame) -> tuple[str, DataFrame]:
        self.made += 1
        return (name := f"run{self.made}"), self.scratch.write_run(df.repartition(self.buckets, *HASH), name, HASH, self.buckets)

    def _merge(self, runs: list[tuple[str, DataFrame]]) -> tuple[str, DataFrame]:
        if len(runs) == 1:
            return runs[0]
        one = runs[0][1]
        for _, run in runs[1:]:  # both sides are bucketed and sorted by hash: a merge without a shuffle
            other = run.select(*HASH, F.col("n").alias("n2"), F.col("keeper").alias("keeper2"))
            one = one.hint("merge").join(other, HASH, "full").select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"), F.greatest("keeper", "keeper2").alias("keeper"))
        out = self._write(one)
        for name, _ in runs:
            self.scratch.drop(name)
        return out

    def add(self, rows: DataFrame) -> None:
        """rows: (h1, h2, id), each line of a document once."""
        new = rows.groupBy(*HASH).agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        known = F.lit(False)
        for k, (_, run) in enumerate(r for level in self.levels for r in level):
            new = new.join(run.select(*HASH, F.col("n").alias(f"in{k}")), HASH, "left")
            known = known | F.col(f"in{k}").isNotNull()
        self.levels[0].append(self._write(new.select(*HASH, "n", F.when(~known, F.col("keeper")).alias("keeper"))))
        at = 0
        while len(self.levels[at]) >= FANOUT:
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._merge(self.levels[at]))
            self.levels[at] = []
            at += 1

    def compact(self) -> DataFrame:
        runs = [r for level in self.levels for r in level]
        self.levels = [[self._merge(runs)]]
        return self.levels[0][0][1]


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, carry: bool = False) -> DataFrame:
    """One row a document: id, n_lines, n_dropped, text (the lines that stay, joined by line feeds).

    With carry, the columns of docs instead, in their order, and the new text in place of the old; a null text stays null.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    own = F.struct(*[quoted(c).alias(c) for c in (docs.columns if carry else [id_col])])
    d = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("id"), own.alias("own"), quoted(text_col).alias("text"))
    hashes = lambda: F.transform(_lines("text"), _hashed)

    def _hashed(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(line) >= min_chars, F.when(F.char_length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("2nd"), key).alias("h2"))))

    lines = d.select("id", F.explode(F.array_distinct(hashes())).alias("h")).where("h is not null").select("h.h1", "h.h2", "id")
    if d.groupBy("id").count().where("count > 1").limit(1).count():
        lines = lines.distinct()
    lines = scratch.write(lines, "lines")
    # batches of like size; cuts change the work only
    n, cuts = lines.agg(F.count("*"), F.percentile_approx("id", [k / batches for k in range(1, batches)] or [0.5], 1000)).first()
    cuts = sorted(set(cuts or []) if batches > 1 else set(), reverse=True)
    index = LineIndex(scratch, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS)))
    for upper, lower in zip([None, *cuts], [*cuts, None], strict=True):
        part = lines if lower is None else lines.where(F.col("id") > lower)
        index.add(part if upper is None else part.where(F.col("id") <= upper))
    index_rows = index.compact()
    total = index_rows.agg(F.sum("n")).first()[0] or 0
    frequent = index_rows.where(F.col("n") >= min_docs)
    # as counts add up to total, at most HOT lines are this frequent: they are sent to the lines, which so don't meet in one task
    is_hot = F.col("n") > total / HOT
    hot, cold = F.broadcast(frequent.where(is_hot).select(*HASH, "keeper")), frequent.where(~is_hot).select(*HASH, "keeper")
    matched = lines.join(hot, HASH).unionByName(lines.join(hot, HASH, "left_anti").join(cold, HASH))
    drops = matched.where("id <> keeper").groupBy("id").agg(F.collect_set("h1").alias("drop"))
    kept = F.filter(_lines("text"), lambda x: ~F.coalesce(F.array_contains(F.col("drop"), _hashed(x)["h1"]), F.lit(False)))
    out = d.join(drops, "id", "left").select("own", "text", F.when(F.col("drop").isNull(), _lines("text")).otherwise(kept).alias("kept"))
    if carry:
        return out.select(*[(F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")) if c == text_col else F.col("own")[c]).alias(c) for c in docs.columns])
    return out.select(F.col("own")[id_col].alias(id_col), F.size(_lines("text")).cast("long").alias("n_lines"), (F.size(_lines("text")) - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
