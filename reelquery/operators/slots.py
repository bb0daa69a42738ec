"""Slots for models and codecs, with deterministic stand-ins.

A slot turns a DataFrame into one with the slot's output columns. Real models register a factory: it is called
once a Python worker, which keeps the model for its next tasks, and its result is applied to Arrow batches: to a row dict at a time,
or, registered with batch=True, to a whole pyarrow.RecordBatch, from which it gives a dict of columns. A row that fails
gets an ``error`` text and doesn't stop the task; the rows of a batch that fails are tried one by one. Stand-ins
for captioner, text_encoder and probe count only after ``register_stand_ins``.

What the staged ingest gives a slot beside the columns of the video (and of the segment, if there is one), and takes:

* probe: a video; frames double, fps double.
* vad: a segment, or a whole video (segment_id null); regions array<struct<start_sample, end_sample>>.
* asr: from_sample, to_sample of a segment, and given. Where given is null, it transcribes: text, and words
  array<struct<text, rel_start, rel_end>> with seconds from from_sample. Else given is a sentence to be scored: logps
  array<double> of its tokens, prompt and end left out.
* diarize: a segment; turns array<struct<start_sec, end_sec, speaker>>.
* codec: a segment's fps, step, from_frame and to_frame (exclusive; null is the segment's end), counted from the segment's
  start; frames array<struct<frame_idx, image>> of frame numbers that step divides (others are dropped).
* frame_encoder: frame_idx, image; vec array<float>.
* captioner: segment_id, global_start_frame; caption string.
* text_encoder: text; image_encoder: a keyframe's image; both vector array<float>.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

KINDS = ("codec", "vad", "asr", "diarize", "frame_encoder", "image_encoder", "text_encoder", "captioner", "probe")
@dataclass(frozen=True)
class Slot:
    #: Makes the function from a row dict to an output dict, or from a batch to columns.
    factory: Callable[[], Callable]
    #: DDL of the output columns.
    schema: str
    batch: bool = False
    #: Under this name a worker keeps the model.
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


REGISTRY: dict[str, Slot] = {}


def register(kind: str, factory: Callable[[], Callable], schema: str, batch: bool = False) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown slot {kind}")
    REGISTRY[kind] = Slot(factory, schema, batch)


def _kept(key: str, factory: Callable):
    """The model of a slot, loaded once by a Python worker."""
    box = sys.modules.setdefault("_reelquery_models", types.ModuleType("_reelquery_models"))
    if key not in box.__dict__:
        box.__dict__[key] = factory()
    return box.__dict__[key]


def _rows(model: Callable, b: pa.RecordBatch, added: pa.Schema) -> pa.Table:
    out = []
    for row in b.to_pylist():
        try:
            out.append(model(row) | {"error": None})
        except Exception as e:  # noqa: BLE001  whatever the model raises belongs to the row
            out.append({"error": f"{type(e).__name__}: {e}"})
    return pa.Table.from_pylist(out, schema=added)


def _batch(model: Callable, b: pa.RecordBatch, added: pa.Schema) -> pa.Table:
    try:
        columns = model(b)
        return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(b), f.type) for f in added], schema=added)
    except Exception as e:  # noqa: BLE001
        if len(b) == 1:
            return pa.Table.from_pylist([{"error": f"{type(e).__name__}: {e}"}], schema=added)
        return pa.concat_tables(_batch(model, b.slice(k, 1), added) for k in range(len(b)))


def apply(kind: str, rows: DataFrame, slot: Slot | None = None) -> DataFrame:
    """rows with the columns of the slot (the one registered, if none is given) and error added."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if slot is None and kind not in REGISTRY:
        raise ValueError(f"the slot {kind} is not registered")
    slot = slot or REGISTRY[kind]
    added = to_arrow_schema(StructType.fromDDL(slot.schema + ", error string"))

    def run(batches):
        model = _kept(slot.key, slot.factory)
        for b in batches:
            new = (_batch if slot.batch else _rows)(model, b, added)
            yield pa.RecordBatch.from_arrays([*b.columns, *(new.column(n).combine_chunks() for n in added.names)], [*b.schema.names, *added.names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, {slot.schema}, error string")


def check(spark: SparkSession, kinds: tuple[str, ...] = ()) -> DataFrame:
    """(slot, status): loads the model of each registered slot on an executor once, as a dry run does."""
    out = []
    for kind in kinds or tuple(REGISTRY):
        slot = REGISTRY.get(kind)

        def load(batches, slot=slot):
            for b in batches:
                try:
                    _kept(slot.key, slot.factory)
                    status = "loaded"
                except Exception as e:  # noqa: BLE001
                    status = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pydict({"status": [status] * len(b)})

        status = spark.range(1).repartition(1).mapInArrow(load, "status string").first().status if slot else "not registered"
        out.append((kind, status))
    return spark.createDataFrame(out, "slot string, status string")


#: Words of the stand-in encoder: runs of digits, letters and all that isn't ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hashed_encoder(size: int = 64) -> Callable[[], Callable[[dict], dict]]:
    """Words hashed into signed buckets (by MD5, so that SQL can follow), normalised: equal texts get equal vectors."""

    def factory():
        def encode(row: dict) -> dict:
            v = np.zeros(size)
            for w in WORD.findall((row.get("text") or "").lower()):
                h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
                v[h % size] += 1 if h >> 31 else -1
            n = np.linalg.norm(v)
            return {"vector": (v / n if n else v).astype(np.float32).tolist()}

        return encode

    return factory


TEXT_STAND_IN = Slot(hashed_encoder(), "vector array<float>")


def register_stand_ins() -> None:
    """Made-up captions, text vectors and video lengths, for tests and trials without models."""
    REGISTRY["text_encoder"] = TEXT_STAND_IN
    register("captioner", lambda: lambda row: {"caption": f"segment {row.get('segment_id')}"}, "caption string")
    register("probe", lambda: lambda row: {"frames": float(row["length"] or 0) // 1000, "fps": 25.0}, "frames double, fps double")


def embed_texts(rows: DataFrame, text_col: str, slot: Slot | None = None) -> DataFrame:
    return apply("text_encoder", rows.withColumnRenamed(text_col, "text"), slot)
