"""Packing: the whole query against the tokenizer and the lengths; hot lengths; memory by bytes."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from reelquery.llm import packing
from reelquery.llm.common import Memo, Scratch


def laid_out(rows, max_len):
    """Each sequence is gapless from 0, no longer than max_len, and padded as told."""
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length, r.padded_length))
    for parts in spans.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_len and {p for *_, p in parts} == {at if at & (at - 1) == 0 else max_len}
    return spans


def test_equal_rows_and_hot_lengths_are_blocks(spark):
    rows = [(1, 0, 64, 7, 64)] * 500 + [(k, 0, 40, 3, 40) for k in range(300)] + [(k, 0, 1 + k % 24, 5, 1 + k % 24) for k in range(700)]
    pieces = Scratch(spark).write(spark.createDataFrame(rows, packing.PIECE).repartition(3), "pieces")
    got = packing.pack_pieces(pieces, 64, block_rows=20).collect()
    spans = laid_out(got, 64)
    assert Counter((r.doc_id, r.length) for r in got) == Counter((r[0], r[2]) for r in rows)
    assert set(spans) == set(range(len(spans)))
    tokens = sum(r[2] for r in rows)
    assert len(spans) <= 1.02 * tokens / 64 + 1


def test_the_query_is_laid_out(spark, sf):
    from reelquery.llm.queries import QUERIES

    rows = QUERIES["op9_packing"](spark, sf).collect()
    spans = laid_out(rows, packing.MAX_LEN)
    assert len(spans) <= 1.02 * sum(r.length for r in rows) / packing.MAX_LEN + 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for parts in by_doc.values():
        at = 0
        for start, length, _ in sorted(parts):
            assert start == at
            at += length
        assert {n for *_, n in parts} == {at}


def test_words_are_kept_by_bytes():
    ids = packing.WordIds(packing.default_tokenizer(), most=1 << 20)
    one = [b"x%d" % k + b"y" * 100_000 for k in range(40)]
    for w in one:
        ids.learn({w, b"again"})
        assert {w, b"again"} <= ids.known.keys()
        assert sum(map(len, ids.known)) <= (1 << 20) + 2 * 100_100


def test_memos_are_kept_by_bytes():
    made = []
    memo = Memo(lambda w: made.append(w) or len(w), most=1 << 20)
    for k in range(200):
        assert memo[f"{k}" + "z" * 50_000] == 50_000 + len(str(k)) and memo["often"] == 5
    assert sum(map(len, memo)) + sum(map(len, memo.older)) <= 1.2 * (1 << 20) and made.count("often") <= 2


def test_plain_words_go_straight_to_the_model():
    """Every text has the ids that the tokenizer gives it, whichever way its words take."""
    import random

    rnd = random.Random(5)
    signs = "abcdeABCZßéñœÿ÷Éıſǆ 's't́​,.;!?$*&%|<>_`\"09٣½²λΣσς中文字 \t\n\x0b\x0c\r\x1c\x85 　😀Ñ-"
    texts = [None, "", "   ", " a ", "<|endoftext|> Ab", "a<|endoftext|>B", "ab's", "l'été,", "a''s", "É!!", "ab " * 9000]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 60))) for _ in range(1500)]
    texts += [("".join(rnd.choice("abcdehéèüßñ") for _ in range(rnd.randrange(1, 9))) + rnd.choice(["", "!!!", "***", ",", "'", "'s", ".'"]) + " ") * 2 for _ in range(1500)]
    make = packing.piece_maker(packing.default_tokenizer(), packing.MAX_LEN, packing.END_ID)
    got = defaultdict(list)
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    for r in make()(batch).to_pylist():
        got[r["doc_id"]].append(r)
    words = packing.WordIds(packing.default_tokenizer())
    assert words.simple
    for k, text in enumerate(texts):
        ids = words.tok.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        cut = [ids[at : at + packing.MAX_LEN] for at in range(0, len(ids), packing.MAX_LEN)]
        assert [(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got[k]] == [
            (packing.MAX_LEN * n, len(c), zlib.crc32(np.array(c, "<u4").tobytes()), len(ids)) for n, c in enumerate(cut)
        ]


def test_a_worker_holds_little():
    """Arrays of ids and known words stay small beside an executor's heap, whatever the batch."""
    import tracemalloc

    class Caught:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    def batches():
        for b in range(6):
            texts = [" ".join(f"{chr(97 + k % 26)}w{b}x{k}y{j}" for j in range(60)) + " of the" * 500 for k in range(1000)]
            yield pa.record_batch({"doc_id": pa.array(range(1000), pa.int64()), "text": pa.array(texts, pa.string())})

    run = packing.tokenized(Caught(), packing.default_tokenizer(), packing.MAX_LEN, packing.END_ID)
    tracemalloc.start()
    try:
        assert sum(len(b) for b in run(batches())) == 6000
        assert tracemalloc.get_traced_memory()[1] < 130e6
    finally:
        tracemalloc.stop()


def test_small_tables_start_no_python_workers(spark):
    """A list given to createDataFrame passes through Python workers of another kind, with a daemon of their own."""
    from reelquery.llm import mixing

    pieces = Scratch(spark).write(spark.createDataFrame([(1, 0, 64, 7, 64)], packing.PIECE), "pieces")
    docs = Scratch(spark).write(spark.createDataFrame([(1, "a", "x y")], "doc_id long, source string, text string"), "docs")
    for df in (packing.pack_pieces(pieces, 64), mixing.mix(docs)):
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()
        assert df.count() == 1
