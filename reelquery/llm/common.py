"""What the operators of this package share: scratch tables, text keys, connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import sys
import tempfile
import types
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, as every contract of this package names it.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands in for a null id, below every real one.
NO_ID = -(2**63)
#: Rows that the JVM sends to Python at once.
BATCH_ROWS = 2_000
#: What a Python worker takes at once, what its memos hold, and what an entry of a dict costs besides its key.
SLICE_BYTES, MEMO_BYTES, ENTRY_BYTES = 8 << 20, 96 << 20, 120


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of that very name, also with dots or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Names like those wanted that no column of df has (case apart)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """A folder of its own under ``spark.checkpoint.dir`` for tables that cut lineage.

    The setting is read from the session; only where it is unset and the master is local (tests) a temporary
    folder takes its place, on a cluster that is an error. Every executor sees the tables, so losing one executor
    loses nothing. Tables go when they are dropped, the rest when the driver ends.
    """

    _own: str | None = None

    def __init__(self, spark: SparkSession):
        self.spark = spark
        conf = spark.sparkContext.getConf()
        base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            if Scratch._own is None:
                Scratch._own = tempfile.mkdtemp(prefix="reelquery-")
            base = f"file://{Scratch._own}"
        self.path = f"{base.rstrip('/')}/rq-{uuid.uuid4().hex}"
        self.tables: dict[str, str] = {}
        atexit.register(self.close)

    @contextlib.contextmanager
    def _settings(self):
        """What is written in here is never computed again, so its shuffle files go as soon as it is written; and texts go to Python few at a time."""
        own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}
        before = {name: self.spark.conf.get(name) for name in own}
        for name, value in own.items():
            self.spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and returns it as read back."""
        to = f"{self.path}/{name}"
        with self._settings():
            df.write.mode("overwrite").parquet(to)
        gc.collect()  # plans that only cycles in Python still hold
        return self.spark.read.schema(df.schema).parquet(to)

    def write_run(self, df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
        """Writes df, dealt by keys into as many partitions, bucketed and sorted by keys, so that joins and merges on them don't shuffle it again."""
        named = f"rq_{uuid.uuid4().hex}"
        with self._settings():
            (df.write.mode("overwrite").option("path", f"{self.path}/{name}").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(named))
        self.tables[name] = named
        return self.spark.table(named)

    def drop(self, *names: str) -> None:
        """Deletes the tables named, or all."""
        jvm = self.spark.sparkContext._jvm
        for name in names or ("",):
            for k in [name] if name else list(self.tables):
                if k in self.tables:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(k)}")
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        try:
            self.drop()
        except Exception:  # noqa: BLE001  the session is gone; the folder belongs to it
            pass


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    ``lower`` has fast paths but changes other letters too; it serves where the text has no such
    letter, and the slower ``translate`` takes the rest.
    """
    others = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]")
    return F.when((F.octet_length(text) == F.char_length(text)) | ~others, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id) -> int:
    """crc32(doc_id as text) mod 4."""
    return zlib.crc32(str(doc_id).encode()) % 4


def in_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """mapInArrow with one function from columns to columns, given by make() and kept between the tasks of a Python worker."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds, key = to_arrow_schema(StructType.fromDDL(schema)), uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = kept(key, make)
        for batch in sliced(batches, 2000):
            out = work({k: batch.column(i).to_pylist() for i, k in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in kinds], schema=kinds)

    return df.mapInArrow(run, schema)


def kept(key: str, make: Callable):
    """What make() gives, kept by the Python worker for its next tasks until it is asked for another key."""
    box = sys.modules.setdefault("_reelquery_kept", types.ModuleType("_reelquery_kept"))
    if getattr(box, "key", None) != key:
        box.key = box.value = None
        box.value = make()
        box.key = key
    return box.value


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1000, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of few rows and about `most` bytes (or one row), so that a worker holds little besides; at the end the task's memory goes back to the system."""
    for b in batches:
        at = 0
        while at < len(b):
            part = b.slice(at, rows)
            while len(part) > 1 and part.nbytes > most:
                part = part.slice(0, len(part) // 2)
            yield part
            at += len(part)
    trim()


def within_chars(rows: DataFrame, group: str, text: str, order: str, most: int) -> DataFrame:
    """Of each group the first rows by a hash of order, up to the one whose text passes `most` code points in all."""
    w = Window.partitionBy(group).orderBy(F.xxhash64(F.lit("sample"), order), order).rowsBetween(Window.unboundedPreceding, -1)
    before, = unused(rows, "before")
    return rows.withColumn(before, F.coalesce(F.sum(F.coalesce(F.char_length(text), F.lit(0))).over(w), F.lit(0))).where(F.col(before) < most).drop(before)


def trim() -> None:
    """Workers are kept between tasks; what one has freed would otherwise stay with the worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Memo(dict):
    """A dict from texts that works out what it lacks; of two generations of half as many bytes the older one goes, so memory stays bounded however long keys are."""

    def __init__(self, work: Callable, most: int = MEMO_BYTES):
        super().__init__()
        self.work, self.most, self.held, self.older = work, most // 2, 0, {}

    def __missing__(self, key):
        if self.held >= self.most:
            self.older = dict(self)
            self.clear()
            self.held = 0
        value = self.older[key] if key in self.older else self.work(key)
        self[key] = value
        self.held += ENTRY_BYTES + getsizeof(key)
        return value


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that links reach.

    Alternating large-star and small-star steps; each step only groups and joins, and its edges are
    written to the shared folder. Hot nodes are reduced by partial aggregation, and joins on them
    can be split by adaptive execution. Stops when a round changes no edge.
    """
    e = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}0")
    last, k = None, 0
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        k += 1
        e_new = scratch.write(small, f"{name}{k}")
        now = e_new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}{k - 1}")
        e = e_new
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())
