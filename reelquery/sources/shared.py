"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir, deleted when the driver ends. Where that is unset: a temporary folder with a local master (tests), else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='reelquery-')}"
    path = f"{base.rstrip('/')}/rq-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session is gone; the folder belongs to it
        pass


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names, without reading any."""
    fs, p = _at(spark, pattern)
    return [str(x.getPath()) for x in fs.globStatus(p) or []]


def replace(df: DataFrame, path: str) -> None:
    """Writes df beside path and swaps it in, so that path can be what df reads, and readers never see a part of it."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}_next")
    fs, p = _at(spark, path)
    old, new = (_at(spark, f"{path}_{x}")[1] for x in ("old", "next"))
    fs.delete(old, True)
    if fs.exists(p):
        fs.rename(p, old)
    fs.rename(new, p)
    fs.delete(old, True)
