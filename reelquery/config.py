"""Settings, with overrides from the environment (prefix ``RQ_``). There are no credentials here."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    keyframe_collections: tuple[str, ...] = ("kf",)
    caption_collections: tuple[str, ...] = ("cap",)
    vector_size: int = 2048
    rrf_k: int = 60
    default_candidates: int = 50
    video_batch_size: int = 5
    sample_rate: int = 16_000
    vad_min_silence_ms: int = 1000
    target_fps: float = 25.0
    sample_fps: float = 10.0
    group_threshold: float = 0.65
    max_candidates: int = 10
    min_region_sec: float = 0.35
    pause_sec: float = 0.85
    max_sentence_sec: float = 18.0
    turn_gap_sec: float = 1.50
    pad_sec: float = 0.15
    reliable_from: float = 0.70
    ncr_below: float = 0.50
    embed_transcripts: bool = False

    def __post_init__(self):
        if not 0 <= self.ncr_below <= self.reliable_from <= 1:
            raise ValueError("quality limits must rise within 0..1")
        if min(self.rrf_k, self.default_candidates, self.video_batch_size, self.vector_size, self.max_candidates) < 1:
            raise ValueError("counts must be positive")

    @classmethod
    def from_env(cls) -> Settings:
        found = {}
        for f in fields(cls):
            if (raw := os.environ.get(f"RQ_{f.name.upper()}")) is not None:
                kind = type(f.default)
                found[f.name] = parse_collections(raw) if kind is tuple else raw.lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        return cls(**found)


def parse_collections(value) -> tuple[str, ...]:
    """A list or comma-separated string of names; blanks go."""
    items = value.split(",") if isinstance(value, str) else value or ()
    return tuple(x.strip() for x in items if x and x.strip())
