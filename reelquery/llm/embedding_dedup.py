"""Operator 6: embedding near-dedup over an inverted multi-index.

Equal vectors of a label are one class. Unit vectors are cut in halves, each half has a codebook of its
own (k-means on a bounded sample, ``SAMPLE`` classes at most), and a vector's cell is the pair of its
nearest centroids. A vector visits the cells nearest to it in the order of the multi-sequence algorithm;
how many is set on the sample: the fewest (a power of two) at which ``RECALL`` of vectors moved by just
the threshold still lie in a visited cell. If more than ``MOST_CELLS`` were needed, or all of them, the codebooks
are halved until fewer do; with one cell all pairs are compared. All classes are indexed, all visit, and every meeting is
verified by the cosine in double precision.

A pair may be met from either side or both, so each side carries the cells that it visits: a pair is
counted once whichever side met it, without listing pairs. Cells are worked off in blocks of ``BLOCK``
by ``BLOCK`` vectors; a block gives link counts a vector and a spanning forest of its links, so dense
groups give rows in proportion to vectors, not pairs.

Vectors that are null, zero, or hold null or non-finite components, and rows without a label, link with
nothing and are their own component. Ids are taken as unique; rows with equal ids are classed by their own
vectors. Vectors of different lengths don't meet. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components

COSINE, CENTROIDS, SAMPLE, RECALL, BLOCK, MOST_CELLS, SEED = 0.98, 64, 20_000, 0.97, 1024, 256, 5


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


class MultiIndex:
    """Two codebooks and the number of cells that a vector visits."""

    def __init__(self, sample: np.ndarray, cosine: float = COSINE):
        self.half, self.visits = sample.shape[1] // 2, 1
        k = max(1, min(CENTROIDS, len(sample) // 8))
        while True:
            self.books = [kmeans(sample[:, : self.half], k), kmeans(sample[:, self.half :], k)]
            if k == 1 or len(sample) < 2 or sample.shape[1] < 2:
                break
            if visits := self._calibrate(sample[:2000], cosine):
                self.visits = visits
                break
            k //= 2

    @classmethod
    def of(cls, half: int, books: list, visits: int) -> MultiIndex:
        self = cls.__new__(cls)
        self.half, self.books, self.visits = half, books, visits
        return self

    def cells(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The nearest cells of each row, nearest first. The best cells have ranks i, j with (i + 1)(j + 1) <= visits."""
        a, b = distances(x[:, : self.half], self.books[0]), distances(x[:, self.half :], self.books[1])
        k, m = a.shape[1], b.shape[1]
        visits = min(visits, k * m)
        oa, ob = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        pairs = np.array([(i, j) for i in range(min(k, visits)) for j in range(min(m, visits // (i + 1)))])
        i, j = pairs[:, 0], pairs[:, 1]
        far = np.take_along_axis(a, oa, 1)[:, i] + np.take_along_axis(b, ob, 1)[:, j]
        best = far.argsort(axis=1, kind="stable")[:, :visits]
        return (oa[:, i] * m + ob[:, j])[np.arange(len(x))[:, None], best]

    def _calibrate(self, x: np.ndarray, cosine: float) -> int | None:
        """The number of cells to visit; None if MOST_CELLS, or fewer than all there are, aren't enough."""
        rng = np.random.default_rng(SEED)
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(axis=1, keepdims=True) * x
        moved = cosine * x + np.sqrt(1 - cosine**2) * unit(noise)
        own, most = self.cells(moved, 1), self.cells(x, MOST_CELLS)
        hit = np.where((most == own).any(axis=1), (most == own).argmax(axis=1), MOST_CELLS)
        visits = 1
        while (hit < visits).mean() < RECALL:
            visits *= 2
            if visits > MOST_CELLS or visits >= len(self.books[0]) * len(self.books[1]):
                return None
        return visits


def block_links(a_id, a_vec, a_cell, a_visits, b_id, b_vec, b_n, b_cell, b_visits, a_n, cosine: float):
    """Visitors a against members b of their cells: link counts by id, and a spanning forest of the links."""
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    near = (a_vec @ b_vec.T) / (norm(a_vec)[:, None] * norm(b_vec)[None, :]) >= cosine
    near &= a_id[:, None] != b_id[None, :]
    i, j = np.nonzero(near)
    counts: dict[int, int] = {}
    for x, n in zip(a_id.tolist(), np.bincount(i, b_n[j], len(a_id)).tolist(), strict=True):
        if n:
            counts[x] = counts.get(x, 0) + int(n)
    other = ~(b_visits[j] == a_cell[i][:, None]).any(axis=1)  # b doesn't meet a itself
    for x, n in zip(b_id.tolist(), np.bincount(j[other], a_n[i[other]], len(b_id)).tolist(), strict=True):
        if n:
            counts[x] = counts.get(x, 0) + int(n)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    forest = []
    for x, y in zip(a_id[i].tolist(), b_id[j].tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            forest.append((x, y))
    return counts, forest


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row a vector: id, n_links, component_id, kept."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    v = F.col("v")
    real = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("g"))
    rows = rows.withColumn("ok", real & F.col("g").isNotNull() & F.col("id").isNotNull()).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit("2nd"), "v")})
    keys = ["g", "h1", "h2"]
    classes = scratch.write(rows.where("ok").groupBy(*keys).agg(F.min("id").alias("id"), F.count("*").alias("n"), F.any_value("v").alias("v")), "classes")
    found = spark.createDataFrame([], "a long, b long, n long")
    for width, n in sorted(map(tuple, classes.groupBy(F.size("v").alias("w")).count().collect())):  # one, as a rule
        own = classes.where(F.size("v") == width)
        sample = [r.v for r in own.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(1_000_000)) < SAMPLE / n * 1_000_000).select("v").limit(2 * SAMPLE).collect()] or [own.first().v]
        found = found.unionByName(_meet(own, MultiIndex(unit(np.array(sample)), cosine), width, scratch, cosine))
    found = scratch.write(found, "found")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    roots = connected_components(found.where("b is not null").select("a", "b"), scratch)
    known = classes.select(*keys, "id", "n").join(links.withColumnRenamed("a", "id"), "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    known = known.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "id").alias("root"))
    on = F.col("ok") & (F.col("g") == F.col("_g")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    out = rows.drop("v").join(known, on, "left")
    root = F.coalesce("root", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), F.coalesce(root == F.col("id"), F.lit(True)).alias("kept"))


def _meet(classes: DataFrame, index: MultiIndex, width: int, scratch: Scratch, cosine: float) -> DataFrame:
    """(a, null, n): n more links of class a; (a, b, null): a link of the forest."""
    sent = classes.sparkSession.sparkContext.broadcast((index.half, index.books, index.visits))

    def assign(batches):
        index = MultiIndex.of(*sent.value)
        for b in batches:
            raw = np.array(b.column("v").to_pylist(), float).reshape(-1, width)
            visits = index.cells(unit(raw), index.visits) if len(raw) else np.zeros((0, 1), int)
            own = visits[:, 0]
            yield pa.RecordBatch.from_arrays([b.column("g"), b.column("id"), b.column("n"), pa.array([x.tobytes() for x in raw], pa.binary()), pa.array(own, pa.int64()), pa.array(visits.tolist(), pa.list_(pa.int64()))], ["g", "id", "n", "v", "cell", "visits"])

    placed = scratch.write(classes.select("g", "id", "n", "v").mapInArrow(assign, "g string, id long, n long, v binary, cell long, visits array<long>"), f"placed{width}")
    # how many blocks a cell's members and visitors fill; one row a cell
    members = placed.groupBy("g", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("mb"))
    visitors = placed.select("g", F.explode("visits").alias("cell")).groupBy("g", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("vb"))
    blocks = members.join(visitors, ["g", "cell"])
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    side = ["g", "at", "x", "y", "member", "id", "n", "v", "cell", "visits"]
    m = placed.withColumn("at", F.col("cell")).join(blocks.withColumnRenamed("cell", "at"), ["g", "at"]).select("*", block("mb").alias("x"), spread("vb").alias("y"), F.lit(True).alias("member")).select(*side)
    q = placed.withColumn("at", F.explode("visits")).join(blocks.withColumnRenamed("cell", "at"), ["g", "at"]).select("*", block("vb").alias("y"), spread("mb").alias("x"), F.lit(False).alias("member")).select(*side)

    def verify(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy(zero_copy_only=False)
        sides = []
        for keep in (~member, member):
            t = table.filter(pa.array(keep))
            vec = np.frombuffer(b"".join(t.column("v").to_pylist())).reshape(-1, width)
            sides.append((t.column("id").to_numpy(), vec, t.column("cell").to_numpy(), np.array(t.column("visits").to_pylist(), np.int64).reshape(len(vec), -1), t.column("n").to_numpy()))
        (ai, av, ac, ax, an), (bi, bv, bc, bx, bn) = sides
        a, b, n = [], [], []
        if len(ai) and len(bi):
            counts, forest = block_links(ai, av, ac, ax, bi, bv, bn, bc, bx, an, cosine)
            a, b, n = [*counts, *(x for x, _ in forest)], [*[None] * len(counts), *(y for _, y in forest)], [*counts.values(), *[None] * len(forest)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return m.unionByName(q).groupBy("g", "at", "x", "y").applyInArrow(verify, "a long, b long, n long")
