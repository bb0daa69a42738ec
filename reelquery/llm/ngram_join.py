"""Operator 3: n-gram Jaccard self-join with vertical partitioning.

Sets of word shingles are arrays of 64-bit hashes; equal sets are one class, so copies cost one row each.
The global n-gram order puts n-grams that repeat most last: each task counts the n-grams that occur in
two or more of its classes, the counts are summed, and the most frequent ones (``MOST_FREQUENT`` at most, a
fixed bound) form the order's tail; all others come before them by hash. Any order gives the same links;
this one keeps frequent passages out of prefixes. The order is cut into ``FRAGMENTS`` fragments by hash and one
more, the tail; every set is cut at the same places.

1. Candidates: two sets with Jaccard >= 75 % share an n-gram of their prefixes (the first
   n - ceil(0.75 n) + 1 of each in the global order). Prefix rows meet by n-gram; those alone, or without another
   of like size, go, and lists with the same members become one, with the number of its n-grams. Rows of
   the tail are dealt by row and counted by partial sums, so a hot n-gram isn't one task.
2. Pairs: a list of ``SMALL`` members or fewer gives all its pairs. In a longer one every class is paired with
   the first and the last one by hash, which is in proportion to the list. A pair is checked only if the sizes, the
   places of the shared n-gram and the number of n-grams that the two prefixes share (summed over lists) allow 75 %.
3. Vertical partitioning: the sets of candidate pairs are cut into fragments. The partial overlap of a pair is counted
   in each fragment apart, and the counts are summed per pair. A set's fragments travel as one row, so a pair is one row.
4. Longer lists that still hold several components are put in ``TRIES`` new orders, and each class outside the
   list's largest component is paired with that component's next ones before and after. Last, every pair of
   different components that such a list still holds, in blocks of ``SALT`` rows. Pairs within a component need no
   check, so no link between components is lost.

Null, empty and wordless texts have empty sets and link with nothing. Texts with fewer words than a shingle
are one n-gram; very long texts are hashed whole, a set being one row of arrays. Rows with equal
ids are told apart by their sets; null ids rank below all others in the work and stay null. Ties (equal sizes, equal
counts) are broken by hash and never change results. An empty table gives an empty result. Columns other than the two
named aren't read. Two different sets are taken for one if all 64 bits of their hashes agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, Scratch, connected_components, quoted, sliced, trim, unused, words_of

WORDS, PERCENT = 5, 75
FRAGMENTS, MOST_FREQUENT, FREQUENT_FROM, FLUSH, AT_ONCE = 4, 1 << 20, 2, 2_000_000, 50_000
SMALL, SALT, HOT, BITMAP, TRIES = 8, 20_000, 5_000, 1 << 26, 12
#: The low bits of a mark.
MARK = (1 << 16) - 1
_K, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The sorted hashes of a text's distinct n-grams (uint64)."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    m = max(1, len(h) - width + 1)
    out = np.zeros(m, np.uint64)
    for k in range(min(width, len(h))):
        out = out * _K + h[k : k + m]
    if len(h) < width:
        out = out + np.uint64(len(h))  # no shingle of full width equals it
    out = (out ^ (out >> np.uint64(30))) * _A
    out = (out ^ (out >> np.uint64(27))) * _B
    return np.unique(out ^ (out >> np.uint64(31)))


def signature(s: np.ndarray) -> int:
    """A set's hash as a signed number."""
    x = xxhash.xxh3_64_intdigest(s.tobytes())
    return x - 2**64 if x >= 2**63 else x


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _longs(a) -> pa.Array:
    return pa.array(np.asarray(a, np.uint64).view(np.int64))


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """(id, sig, n) of each row; and (null, n-gram, classes) of n-grams that a task saw in several classes."""

    def run(batches):
        seen: set[int] = set()
        held, count = [], 0
        schema = pa.schema([("id", pa.int64()), ("sig", pa.int64()), ("n", pa.int64())])

        def repeated():
            grams, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            several = times > 1
            return pa.RecordBatch.from_arrays([pa.nulls(int(several.sum()), pa.int64()), _longs(grams[several]), pa.array(times[several], pa.int64())], schema=schema)

        for b in sliced(batches):
            sigs, sizes = [], []
            for text in b.column(1).to_pylist():
                s = shingles(text, width)
                sig = signature(s)
                sigs.append(sig)
                sizes.append(len(s))
                if sig not in seen:
                    seen.add(sig)
                    held.append(s)
                    count += len(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.int64()), pa.array(sizes, pa.int64())], schema=schema)
            if count > FLUSH:
                yield repeated()
                held, count = [], 0
        yield repeated()

    return docs.mapInArrow(run, "id long, sig long, n long")


class Order:
    """The global order: n-grams outside the tail by hash, then the tail by count."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        by = grams.argsort()
        self.grams, self.counts = grams[by], counts[by]
        self.pivots = np.array([k * 2**64 // FRAGMENTS for k in range(1, FRAGMENTS)], np.uint64)

    def tail(self, s: np.ndarray) -> np.ndarray:
        """Counts of those in the tail, 0 for others."""
        if not len(self.grams):
            return np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.grams, s), len(self.grams) - 1)
        return np.where(self.grams[at] == s, self.counts[at], 0)

    def cut(self, s: np.ndarray) -> list[np.ndarray]:
        """The FRAGMENTS + 1 parts of a sorted set."""
        last = self.tail(s) > 0
        rest = s[~last]
        return [*np.split(rest, np.searchsorted(rest, self.pivots)), s[last]]


def _prefixes(docs: DataFrame, order, width: int, percent: int) -> DataFrame:
    """A row for each n-gram of a class's prefix: place is its number in the prefix, negative (-1 - place) in the tail."""

    def run(batches):
        ranks = Order(*order.value)
        seen: set[int] = set()
        for b in sliced(batches):
            grams, sigs, sizes, places = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text, width)
                if not len(s) or (sig := signature(s)) in seen:
                    continue
                seen.add(sig)
                tail = ranks.tail(s)
                first = np.lexsort((s, tail))[: prefix_size(len(s), percent)]
                place = np.arange(len(first))
                grams.append(s[first])
                places.append(np.where(tail[first] > 0, -1 - place, place))
                sigs.append(np.full(len(first), sig, np.int64))
                sizes.append(np.full(len(first), len(s), np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays([_longs(np.concatenate(grams)), pa.array(np.concatenate(sigs)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places).astype(np.int32))], ["gram", "sig", "n", "place"])

    return docs.mapInArrow(run, "gram long, sig long, n int, place int")


def _runs(gram: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, int)


def _meet(posts: DataFrame, percent: int) -> DataFrame:
    """Rows that meet others: (list, sig, n, pos, c) outside the tail, where list is a hash of the members; and (n-gram, sig, n, pos, null) in the tail.

    Rows outside the tail are dealt by n-gram; each task holds at most one class of them twice, so lists are no longer
    than there are tasks, but for n-grams beyond the tail's bound. Rows of the tail are dealt by n-gram and class.
    """
    n_parts = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col("place") < 0
    dealt = posts.repartition(n_parts, F.when(hot, F.xxhash64("gram", "sig")).otherwise(F.col("gram"))).sortWithinPartitions("gram")
    schema = pa.schema([("gram", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()), ("pos", pa.int64()), ("c", pa.int64())])

    def run(batches):
        held: list[np.ndarray] = []  # rows of the last n-gram, which may go on

        def done(rows: list[np.ndarray]):
            gram, sig, n, place = rows
            hot = place < 0
            out = [pa.RecordBatch.from_arrays([pa.array(gram[hot]), pa.array(sig[hot]), pa.array(n[hot]), pa.array(-1 - place[hot]), pa.nulls(int(hot.sum()), pa.int64())], schema=schema)]
            gram, sig, n, place = (x[~hot] for x in rows)
            # alone in the list: most rows
            again = np.zeros(len(gram), bool)
            if len(gram):
                same = gram[1:] == gram[:-1]
                again[1:] |= same
                again[:-1] |= same
            gram, sig, n, place = (x[again] for x in (gram, sig, n, place))
            by = np.lexsort((place, sig, n, gram))
            gram, sig, n, place = (x[by] for x in (gram, sig, n, place))
            if len(gram):
                # a class that several tasks gave: the same row twice
                new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (sig[1:] != sig[:-1])])
                gram, sig, n, place = (x[new] for x in (gram, sig, n, place))
                alike = (gram[1:] == gram[:-1]) & (100 * n[:-1] >= percent * n[1:])
                near = np.zeros(len(gram), bool)
                near[1:] |= alike
                near[:-1] |= alike
                gram, sig, n, place = (x[near] for x in (gram, sig, n, place))
            if len(gram):
                at = _runs(gram)
                c = np.diff(np.append(at, len(gram)))
                mixed = sig.view(np.uint64) * _A
                mixed = (mixed ^ (mixed >> np.uint64(29))) * _B
                key = np.bitwise_xor.reduceat(mixed ^ (mixed >> np.uint64(32)), at) + c.astype(np.uint64) * _K
                out.append(pa.RecordBatch.from_arrays([pa.array(np.repeat(key, c).view(np.int64)), pa.array(sig), pa.array(n), pa.array(place), pa.array(np.repeat(c, c))], schema=schema))
            return out

        def blocks():
            """Batches put together, as each costs some calls."""
            some, n = [], 0
            for b in batches:
                some.append(b)
                n += len(b)
                if n >= AT_ONCE:
                    yield pa.Table.from_batches(some)
                    some, n = [], 0
            if some:
                yield pa.Table.from_batches(some)

        for b in blocks():
            rows = [b.column(k).to_numpy().astype(np.int64) for k in range(4)]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            last = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            held = [x[last:] for x in rows]
            if last:
                yield from done([x[:last] for x in rows])
        if held:
            yield from done(held)
        trim()

    return dealt.mapInArrow(run, "gram long, sig long, n long, pos long, c long")


def _by_list(rows: DataFrame, info: DataFrame) -> DataFrame:
    """rows joined with the row of their list in info (gram, c = number of rows, ...).

    Lists of more than a HOT-th of all rows, fewer than HOT of them, are sent to the rows, which so don't meet in one task.
    """
    total = info.agg(F.sum("c")).first()[0] or 0
    hot = F.col("c") > total / HOT
    few, many = F.broadcast(info.where(hot)), info.where(~hot)
    return rows.join(few, "gram").unionByName(rows.join(few.select("gram"), "gram", "left_anti").join(many, "gram"))


def _lists(met: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, sig, n, c, pos, k): lists by their members; pos is the first place of a member in any of the k n-grams that are merged."""
    cold, hot = met.where("c is not null"), met.where("c is null").select("gram", "sig", "n", "pos").distinct()
    info = hot.groupBy("gram").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("sig")).alias("x"), F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("c > 1")
    info = scratch.write(info.select("gram", "c", F.xxhash64("c", "x", "lo", "hi").alias("list")), "tail")
    hot = _by_list(hot, info).select(F.col("list").alias("gram"), "sig", "n", "pos", "c")
    return scratch.write(cold.unionByName(hot).groupBy("gram", "sig").agg(F.max("n").alias("n"), F.max("c").alias("c"), F.min("pos").alias("pos"), F.count("*").alias("k")), "lists")


def _bits(id_col: str) -> list:
    """Two bit numbers of an id."""
    return [F.pmod(F.xxhash64(id_col), F.lit(BITMAP)), F.pmod(F.xxhash64(F.lit("2nd"), id_col), F.lit(BITMAP))]


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ids, of BITMAP bits whatever their number; when crowded it lets more pass, never less."""
    words = ids.select(F.explode(F.array(*_bits("id"))).alias("k")).groupBy(F.floor(F.col("k") / 64).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(k % 64 AS int)))").alias("x")).toArrow()
    out = np.zeros(BITMAP // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("x").to_numpy()
    return out


def _fragments(docs: DataFrame, ids: DataFrame, order, width: int) -> DataFrame:
    """(sig, parts): the sets of the named rows, and of a few more, cut into fragments. Texts stay where they are: ids travel, as a bitmap."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))  # BITMAP / 8 bytes

    def run(batches):
        ranks = Order(*order.value)
        seen: set[int] = set()
        for b in sliced(batches, 200):
            hit = np.ones(len(b), bool)
            for k in (1, 2):
                bit = b.column(k).to_numpy(zero_copy_only=False)
                hit &= (wanted.value[bit >> 6] >> (bit & 63)) & 1 == 1
            sigs, parts = [], []
            for text in b.column(0).filter(pa.array(hit)).to_pylist():
                s = shingles(text, width)
                sig = signature(s)
                if sig in seen:
                    continue
                seen.add(sig)
                sigs.append(sig)
                parts.append([part.view(np.int64) for part in ranks.cut(s)])
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(parts, pa.list_(pa.list_(pa.int64())))], ["sig", "parts"])

    return docs.select("text", *[x.alias(f"k{k}") for k, x in enumerate(_bits("id"))]).mapInArrow(run, "sig long, parts array<array<long>>")


def _fetch(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order, scratch: Scratch, name: str, width: int) -> DataFrame:
    """The fragments of all classes in pairs, once each, bucketed by class: joins with pairs then move one side of the pairs only."""
    sigs = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    sets = _fragments(docs, classes.join(sigs, "sig").select("id"), order, width)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.write_run(sets.repartition(buckets, "sig").dropDuplicates(["sig"]), f"sets{name}", ["sig"], buckets)


def _verify(pairs: DataFrame, sets: DataFrame, scratch: Scratch, name: str, percent: int) -> DataFrame:
    """Pairs (a, b) whose overlaps, counted in each fragment and summed, are enough."""
    side = lambda x: sets.select(F.col("sig").alias(x), F.col("parts").alias(f"p{x}"))
    partial = F.zip_with("pa", "pb", lambda x, y: F.size(F.array_intersect(x, y)).cast("long"))
    counted = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", F.aggregate(partial, F.lit(0).cast("long"), lambda s, x: s + x).alias("o"))
    return scratch.write(counted.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b"), f"links{name}")


def _unite(roots: DataFrame | None, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(sig, root) after more links. Only roots are linked anew, so a group's links shrink to one edge a component."""
    ends = links.select(F.explode(F.array("a", "b")).alias("sig")).distinct().select("sig", F.col("sig").alias("root"))
    if roots is not None:
        ends = roots.union(ends.join(roots.select("sig"), "sig", "left_anti"))
        ends = scratch.write(ends, f"ends{name}")
        links = links.join(ends.select(F.col("sig").alias("a"), F.col("root").alias("ra")), "a").join(ends.select(F.col("sig").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
    found = connected_components(links, scratch, f"cc{name}").select(F.col("node").alias("root"), F.col("root").alias("top"))
    return scratch.write(ends.join(found, "root", "left").select("sig", F.coalesce("top", "root").alias("root")), f"roots{name}")


def _open(lists: DataFrame, roots: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Lists of more than one component: rows with their component and the list's largest one (big)."""
    placed = scratch.write(lists.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")), f"placed{name}")
    groups = placed.groupBy("gram", "root").agg(F.count("*").alias("k")).groupBy("gram").agg(F.max_by("root", F.struct("k", "root")).alias("big"), F.count("*").alias("roots"), F.sum("k").alias("c")).where("roots > 1")
    groups = scratch.write(groups.select("gram", "big", "c"), f"groups{name}")
    return scratch.write(_by_list(placed.drop("c"), groups), f"open{name}")


def _possible(percent: int, m=None, p=None):
    """Whether sets of n and m n-grams can be alike if the first n-gram that they share stands at pos in one and at p in the other."""
    m, p = (F.col("m") if m is None else m), (F.col("p") if p is None else p)
    most = F.least(F.col("n") - F.col("pos"), m - p)
    return (100 + percent) * most >= percent * (F.col("n") + m)


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b, na, nb), a < b, of rows (sig, n, pos, s, m, p) that can be alike."""
    up = F.col("sig") < F.col("s")
    pick = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    return rows.where(_possible(percent)).select(pick("sig", "s").alias("a"), pick("s", "sig").alias("b"), pick("n", "m").alias("na"), pick("m", "n").alias("nb")).distinct()


def _marks(lists: DataFrame, scratch: Scratch) -> DataFrame:
    """(sig, marks): a number for each list of a class, of its hash and, in the bits of MARK, of how many n-grams it stands for (all set: so many or more)."""
    mark = F.col("gram").bitwiseAND(F.lit(~MARK)).bitwiseOR(F.least("k", F.lit(MARK)))
    return scratch.write(lists.groupBy("sig").agg(F.collect_set(mark).alias("marks")), "marks")


def _likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes share enough n-grams: what the prefixes don't share must come from the rest of one of the sets."""
    rest = lambda n: F.ceil(F.col(n) * percent / 100) - 1
    side = lambda x: marks.select(F.col("sig").alias(x), F.col("marks").alias(f"m{x}"))
    count = lambda s, x: s + F.when(x.bitwiseAND(F.lit(MARK)) == MARK, F.lit(1 << 40)).otherwise(x.bitwiseAND(F.lit(MARK)))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", F.aggregate(F.array_intersect("ma", "mb"), F.lit(0).cast("long"), count).alias("shared"))
    most = F.col("shared") + F.greatest(rest("na"), rest("nb"))
    return both.where((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))).drop("shared")


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, Scratch]:
    """(id, sig, n) of each row with null ids as NO_ID; and (sig, id, root) of each class."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    d = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("id"), quoted(text_col).alias("text"))
    scanned = scratch.write(_scan(d, width), "scan")
    rows = scanned.where("id is not null")
    classes = scratch.write(rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("id"), F.max("n").alias("n")), "classes")
    often = scanned.where("id is null").groupBy("sig").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "sig").limit(MOST_FREQUENT).toArrow()
    order = spark.sparkContext.broadcast((often.column("sig").to_numpy().view(np.uint64), often.column("n").to_numpy()))  # 16 bytes x MOST_FREQUENT at most

    lists = _lists(scratch.write(_meet(_prefixes(d, order, width, percent), percent), "met"), scratch)
    scratch.drop("met", "tail")
    marks = _marks(lists, scratch)
    short, long = lists.where(F.col("c") <= SMALL), lists.where(F.col("c") > SMALL)

    # all pairs of short lists; in long ones the first and last class by hash: lists of one group share them, so few pairs are new
    row = F.struct(F.col("sig").alias("s"), F.col("n").alias("m"), F.col("pos").alias("p"))
    all_of = short.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("sig", "n", "pos"))).alias("rows")).select("rows", F.explode("rows").alias("x"))  # SMALL rows at most
    within = all_of.select("x.*", F.explode(F.filter("rows", lambda y: y["sig"] > F.col("x.sig"))).alias("y")).select("sig", "n", "pos", F.col("y.sig").alias("s"), F.col("y.n").alias("m"), F.col("y.pos").alias("p"))
    spread = Window.partitionBy("gram", F.pmod("sig", F.ceil(F.col("c") / SALT)))
    ends = long.select("sig", "n", "pos", F.array(F.min(row).over(spread), F.max(row).over(spread)).alias("os")).select("sig", "n", "pos", F.explode("os").alias("o")).where("o.s <> sig").select("sig", "n", "pos", "o.*")
    first = scratch.write(_likely(_pairs(within.unionByName(ends), percent), marks, percent), "pairs1")
    sets = _fetch(first, d, classes, order, scratch, "1", width)
    roots = _unite(None, _verify(first, sets, scratch, "1", percent), scratch, "1")

    # one round in TRIES new orders; a pair without sets waits for the last round
    open_ = _open(long, roots, scratch, "2")
    big = F.when(F.col("root") == F.col("big"), row)
    beside = []
    for x in range(TRIES):
        turn = Window.partitionBy("gram", F.pmod("sig", F.ceil(F.col("c") / SALT))).orderBy(F.xxhash64(F.lit(x), "sig"), "sig")
        beside += [F.last(big, True).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.first(big, True).over(turn.rowsBetween(1, Window.unboundedFollowing))]
    near = open_.select("*", F.array_distinct(F.array(*beside)).alias("os")).where("root <> big")
    near = near.select("sig", "n", "pos", F.explode(F.filter("os", lambda o: o.isNotNull() & _possible(percent, o["m"], o["p"]))).alias("o")).select("sig", "n", "pos", "o.*")
    have = sets.select("sig").distinct()
    near = _pairs(near, percent).join(first.select("a", "b"), ["a", "b"], "left_anti")
    near = near.join(have.withColumnRenamed("sig", "a"), "a", "left_semi").join(have.withColumnRenamed("sig", "b"), "b", "left_semi")
    second = scratch.write(_likely(near, marks, percent), "pairs2")
    roots = _unite(roots, _verify(second, sets, scratch, "2", percent), scratch, "2")
    scratch.drop("sets1", "placed2", "groups2", "open2")

    # every pair of different components left, a list's rows in blocks of SALT
    open_ = _open(long, roots, scratch, "3").withColumn("blocks", F.ceil(F.col("c") / SALT).cast("int"))
    others = open_.where("root <> big").select("gram", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("sig").alias("s"), F.col("n").alias("m"), F.col("pos").alias("p"), F.col("root").alias("r"))
    pairs = others.join(open_.select("gram", F.pmod("sig", "blocks").cast("int").alias("block"), "sig", "n", "pos", "root", "big"), ["gram", "block"]).where("r <> root and (root = big or s < sig)").where(_possible(percent))
    tried = first.select("a", "b").union(second.select("a", "b"))
    rest = scratch.write(_likely(_pairs(pairs, percent).join(tried, ["a", "b"], "left_anti"), marks, percent), "pairs3")
    scratch.drop("placed3", "groups3", "open3", "lists", "marks")
    roots = _unite(roots, _verify(rest, _fetch(rest, d, classes, order, scratch, "3", width), scratch, "3", percent), scratch, "3")
    mapped = scratch.write(classes.select("sig", "id").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig")), "mapped")
    order.unpersist()
    scratch.drop("sets3", "classes", *(f"{kind}{k}" for kind in ("pairs", "links", "ends", "roots") for k in (1, 2, 3)))
    return rows, mapped, scratch


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row a document: id, n_shingles, component_id."""
    rows, mapped, _ = _components(docs, id_col, text_col, width, percent)
    least = mapped.groupBy("root").agg(F.min("id").alias("component"))
    mapped = mapped.join(least, "root").select("sig", "component")
    out = rows.join(mapped, "sig", "left")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, real("component")).otherwise(real("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    Of rows with that id and equal texts one stays, whichever; rows with that id and other texts stay too. Null ids are one id below all
    others. A document without words is a component of its own.
    """
    rows, mapped, scratch = _components(docs, id_col, text_col, WORDS, PERCENT)
    least = mapped.groupBy("root").agg(F.min("id").alias("id")).select("id")
    keep = scratch.write(least.union(rows.where("n = 0").select("id")).distinct(), "keep")
    key, mark = unused(docs, "key", "mark")
    d = docs.withColumn(key, F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)))
    d = d.join(keep.withColumnRenamed("id", key), key, "left_semi")
    if rows.groupBy("id").count().where("count > 1").limit(1).count():
        same = Window.partitionBy(key, F.xxhash64(quoted(text_col)), F.xxhash64(F.lit("2nd"), quoted(text_col))).orderBy(key)
        d = d.withColumn(mark, F.row_number().over(same)).where(F.col(mark) == 1)
    return d.select(*[quoted(c) for c in docs.columns])
