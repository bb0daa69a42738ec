"""Mixing keeps documents without tokens wherever they come in the order."""

import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from reelquery.llm import mixing


def test_wordless_documents_stay(spark):
    rows = [(k, "a", "") for k in range(200)] + [(200 + k, "b", "w " * 10) for k in range(10)] + [(300, "a", "w " * 100)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(d).collect()
    assert Counter((r.doc_id, r.epoch) for r in got) == Counter((r[0], 0) for r in rows)
    assert all(0 <= r.position <= 1 for r in got)
    assert sorted(r.doc_id for r in mixing.realise(d).collect()) == sorted(r[0] for r in rows)


def test_wordless_documents_of_a_repeated_source_come_once_an_epoch(spark):
    rows = [(k, "small", "") for k in range(50)] + [(50, "small", "w " * 10), (51, "large", "w " * 1000)]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [r for r in mixing.mix(d).collect() if r.source == "small"]
    assert {r.repetitions for r in got} != {1.0}
    assert {r.doc_id for r in got if r.epoch == 0} == set(range(51))
    assert max(Counter((r.doc_id, r.epoch) for r in got).values()) == 1


def spark_hash(*values):
    """Spark's xxhash64 of ints, longs and texts."""
    h = 42
    for v, kind in values:
        h = xxhash.xxh64_intdigest(v.encode() if kind == "s" else struct.pack("<" + kind, v), seed=h)
    return h - 2**64 if h >= 2**63 else h


def test_placements_by_brute_force(spark):
    """The whole operator again, row by row: weights, budgets, block permutations, positions."""
    sizes = {"a": 4000, "b": 300, "c": 2500}
    rows = [(n, s, 1 + (n * 7919) % 13) for n, s in enumerate(s for s, k in sizes.items() for _ in range(k))]
    d = spark.createDataFrame([(i, s, "w " * k) for i, s, k in rows], "doc_id long, source string, text string")
    got = {(r.doc_id, r.epoch): r for r in mixing.mix(d).collect()}
    total = Counter()
    for _, s, k in rows:
        total[s] += k
    names = sorted(total)
    t, weights, reps = mixing.solve([float(total[s]) for s in names])
    want = {}
    for s, w, rep in zip(names, weights, reps, strict=True):
        blocks = defaultdict(list)
        n_blocks = -(-sizes[s] // mixing.BLOCK)
        for i, source, k in rows:
            if source == s:
                blocks[spark_hash((mixing.SEED, "i"), (i, "q")) % n_blocks].append((i, k))
        epoch, used = 0, 0
        while epoch < rep - 1e-9:
            used = 0
            for b in sorted(blocks, key=lambda b: (spark_hash((mixing.SEED, "i"), (epoch, "i"), (s, "s"), (b, "q")), b)):
                for i, k in sorted(blocks[b], key=lambda x: (spark_hash((mixing.SEED, "i"), (epoch, "i"), (x[0], "q")), x)):
                    at = epoch + used / total[s]
                    if epoch < int(rep + 1e-9) or at < rep - 1e-9:
                        want[i, epoch] = (b, min(at / rep, 1.0), w, rep)
                    used += k
            epoch += 1
    assert set(got) == set(want)
    for key, (b, at, w, rep) in want.items():
        r = got[key]
        assert r.block == b and (r.position, r.weight, r.repetitions, r.exponent) == pytest.approx((at, w, rep, t))
    order = [r.doc_id for r in mixing.realise(d).collect()]
    place = defaultdict(list)
    for (i, _), (_, at, _, _) in want.items():
        place[i].append(at)
    assert Counter(order) == Counter({i: len(x) for i, x in place.items()})
    seen, last = Counter(), 0.0
    for i in order:
        at = sorted(place[i])[seen[i]]
        seen[i] += 1
        assert at >= last - 1e-12
        last = at


def test_a_target_that_no_exponent_meets_is_told(spark):
    rows = [(k, "ab"[k % 2], "w w") for k in range(10)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert {(r.exponent, r.target_met) for r in got} == {(1.0, False)} and len(got) == 10
