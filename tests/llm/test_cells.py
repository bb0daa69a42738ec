"""Calibrated recall is met, with coarser codebooks if need be."""

import numpy as np

from reelquery.llm import embedding_dedup as E


def test_recall_is_met_where_cells_are_too_few(monkeypatch):
    monkeypatch.setattr(E, "MOST_CELLS", 2)
    rng = np.random.default_rng(4)
    x = E.unit(rng.normal(size=(2000, 32)))
    index = E.MultiIndex(x)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    moved = E.COSINE * x + np.sqrt(1 - E.COSINE**2) * E.unit(noise)
    hit = (index.cells(x, index.visits) == index.cells(moved, 1)).any(axis=1).mean()
    assert index.visits <= 2 and hit >= E.RECALL - 0.02
