"""Operator 5: token counts by a count-only Viterbi search.

An Aho-Corasick automaton over a unigram vocabulary lists all pieces that match in a word; dynamic
programming carries the best score to each position and the number of pieces on that path, nothing else.
Rules are those of the public unigram tokenizer: at equal scores the path whose last piece starts first
(the longer piece) stays, a letter without a piece of its own costs ``UNKNOWN_PENALTY`` below the worst
piece, and a run of such letters is one token. Scores are added from left to right in double precision,
so that ties come out as there.

The vocabulary is that of a public tokenizer file; a piece's score is the logarithm of one over its rank.
Byte pieces are left out; letters without a piece are unknown. Pieces hold space marks at their start only, or
are a run of them, so a text is cut where a run of spaces begins: each distinct part, a run and what
follows up to the next, is segmented once while a worker keeps it and texts of any length only add counts up. A vocabulary with a mark
after another letter is an error.

Null and empty texts have 0 tokens. Rows count one by one, also with equal ids; null ids stay null. An empty
table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, in_batches, quoted

MARK, UNKNOWN_PENALTY = "▁", 10.0
PART = re.compile(" +[^ ]*")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in order of rank; the first is the unknown piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    if inner := [p for p in pieces if MARK in p.lstrip(MARK)]:
        raise ValueError(f"pieces with a space mark after another letter: {inner[:3]}")
    return [("<unk>", -20.0)] + [(p, -math.log(k + 2)) for k, p in enumerate(pieces)]


def parts_of(text: str) -> list[str]:
    """The parts of a text without the first space of each, which the mark before the text or a space gives."""
    t = text.replace(MARK, " ")
    if t[:1] == " " or "  " in t:
        return [p[1:] for p in PART.findall(" " + t)]
    return t.split(" ")


class Counter:
    """count(part): the number of tokens of a part of a text that starts with the space mark."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY

    def count(self, part: str) -> int:
        n = len(part)
        best, pieces, broken = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        single, unknown = self.single, self.unknown
        done = 0  # positions whose unknown letter has been tried

        def letters(upto: int) -> None:
            nonlocal done
            while done < upto:
                if part[done] not in single and best[done] + unknown > best[done + 1]:
                    best[done + 1], pieces[done + 1], broken[done + 1] = best[done] + unknown, pieces[done] + (not broken[done]), True
                done += 1

        end = -1
        for end, (length, score) in self.auto.iter(part):  # by end, the longest first
            if done < end:
                letters(end)
            start = end + 1 - length
            total = score + best[start]
            if total > best[end + 1]:
                best[end + 1], pieces[end + 1], broken[end + 1] = total, pieces[start] + 1, False
        letters(n)
        return pieces[n]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row a document: id, n_tokens."""
    path = vocabulary or default_vocabulary()

    def make():
        counter = Counter(unigram_vocabulary(path))
        known = Memo(lambda part: counter.count(MARK + part.replace(" ", MARK)))

        def work(cols: dict) -> dict:
            return {"id": cols["id"], "n_tokens": [sum(map(known.__getitem__, parts_of(t))) if t else 0 for t in cols["text"]]}

        return work

    d = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(d, make, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)
