"""Quotations of any length on a line, and hits without end."""

import random
import time

from reelquery.llm import toxicity


def test_long_quotations():
    text = 'he wrote "' + "word " * 100 + "slurs " + "word " * 100 + '" there'
    at = text.index("slurs")
    assert toxicity.score_hits(text, [(at, at + 5, 0, 0.4)]) < toxicity.THRESHOLD < toxicity.score_hits(text.replace('"', " "), [(at, at + 5, 0, 0.4)])
    assert toxicity.quoted_spans(text) == [(text.index('"'), text.rindex('"'))]
    assert toxicity.quoted_spans('a "b\nc" d “e” « “f”') == [(10, 12), (16, 18)]


def test_marks_never_closed_take_no_square_time():
    assert toxicity.quoted_spans("“" * 1_000_000) == []


def plain_score(text, hits):
    """Every hit against every span and every other hit."""
    spans = toxicity.quoted_spans(text)
    inside = [any(a < s and e <= b for a, b in spans) for s, e, *_ in hits]
    bare = [h[0] for h, q in zip(hits, inside, strict=True) if not q]
    total = 0.0
    for (s, _, edits, weight), q in zip(hits, inside, strict=True):
        weight *= toxicity.FUZZY if edits else 1
        total += weight * (toxicity.QUOTED if q and not any(abs(s - b) <= toxicity.WINDOW for b in bare) else 1)
    return total


def test_windows_by_brute_force():
    import math

    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice(["word", "idiot", '"', "“", "”", "\n", "idiot"]) + " " * rng.randrange(1, 40) for _ in range(60)]
        text, hits = "", []
        for w in words:
            if w.startswith("idiot"):
                hits.append((len(text), len(text) + 5, rng.randrange(2), 0.01))
            text += w
        assert math.isclose(-math.log(1 - toxicity.score_hits(text, hits)) if hits else 0.0, plain_score(text, hits), abs_tol=1e-9)


def test_many_hits_take_no_square_time():
    text = '"idiot" idiot ' * 100_000
    hits = [(14 * k + j, 14 * k + j + 5, 0, 0.1) for k in range(100_000) for j in (1, 8)]
    began = time.perf_counter()
    assert toxicity.score_hits(text, hits) > 0.9 and time.perf_counter() - began < 5


def test_learned_by_hand(spark):
    """The whole query against plain counting: terms are found in held-out texts, quotation is told from abuse."""
    rows, labels = [], []
    for k in range(1600):
        rows.append((k, f"some {k} blarghead {k * 7 % 31} here" if k % 4 == 0 else f"some {k} words {k * 7 % 31} here"))
        labels.append((k, int(k % 4 == 0)))
    rows += [(2000, "you blarghead you"), (2001, "you blargheed you"), (2002, 'they wrote "blarghead" in a book'), (2003, "nothing"), (2004, None)]
    got = {r.doc_id: r for r in toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[k].predicted == int(k % 4 == 0) for k in range(1600))
    assert (got[2000].predicted, got[2002].predicted, got[2003].score, got[2004].score) == (1, 0, 0.0, 0.0)
    assert got[2000].score > got[2001].score > got[2003].score and got[2001].n_hits == 1
