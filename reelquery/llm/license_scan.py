"""Operator 4: licence scans by a positional rare-token index.

Templates are short licence statements, each with mandatory key phrases. A first pass counts, over all
documents, in how many each template word occurs (the vocabulary is fixed, so the counts are few). The
index holds the ``RARE`` words of highest inverse document frequency of each template, with their positions.
In the second pass a document's words are looked up in the index; each posting votes for the place where
its template would start (document position less template position). Places with enough votes are
aligned word by word, and a template's label is given when all its key phrases stand there and
``MIN_MATCH`` of its words match.

The base labels are places of three fixed phrases and are counted apart; the index only adds labels.
Words are those of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. On UTF-8 bytes that
is one translation and one split, as all bytes from 0x80 on belong to words.

score is the best share of template words matched, 1.0 for a base phrase, 0.0 without any label.
Null and empty texts have no words and labels. Rows count one by one, also with equal ids; null ids stay null. Of
words of equal frequency the first in order of bytes are the rare ones; of places with equal shares any stands. Very
long texts are scanned whole, in time in proportion to their words. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, quoted, sliced

RARE, MIN_MATCH = 4, 0.75

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed values: (label, statement, mandatory key phrases).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["hereby granted free of charge"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license", ["in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use", "source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc0", "dedicated to the public domain under creative commons zero", ["public domain"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

_WORD = [(48 <= c <= 57) or (65 <= c <= 90) or (97 <= c <= 122) or c >= 128 for c in range(256)]
#: Lower-cases A-Z and turns all that is in no word into blanks.
TO_WORDS = bytes((c + 32 if 65 <= c <= 90 else c) if _WORD[c] else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


def find_phrase(words: list[bytes], phrase: list[bytes], low: int = 0, high: int | None = None) -> list[int]:
    """All places where the phrase's words stand consecutively."""
    out, at, n = [], low - 1, len(phrase)
    high = len(words) if high is None else min(high, len(words))
    while True:
        try:
            at = words.index(phrase[0], at + 1, high)
        except ValueError:
            return out
        if words[at : at + n] == phrase:
            out.append(at)


def _split(text: str) -> list[bytes]:
    return text.encode().split()


class Index:
    def __init__(self, frequency: dict[bytes, int], n_docs: int):
        self.templates = [(label, _split(text), [_split(k) for k in keys]) for label, text, keys in TEMPLATES]
        self.base = [(_split(phrase), label) for phrase, label in BASE.items()]
        idf = lambda w: math.log((1 + n_docs) / (1 + frequency.get(w, 0)))
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed = []
        for k, (_, words, _) in enumerate(self.templates):
            rare = sorted(set(words), key=lambda w: (-idf(w), w))[:RARE]
            self.needed.append(max(1, math.ceil(MIN_MATCH * len(rare))))
            for at, w in enumerate(words):
                if w in rare:
                    self.postings.setdefault(w, []).append((k, at))
        self.first = {p[0] for p, _ in self.base}

    def labels(self, words: list[bytes], present: set[bytes]) -> dict[str, float]:
        """Labels of the templates found, with the best share of words matched."""
        votes: Counter = Counter()
        for w in present & self.postings.keys():
            for at in find_phrase(words, [w]):
                for k, place in self.postings[w]:
                    votes[k, at - place] += 1
        out: dict[str, float] = {}
        for (k, start), n in votes.items():
            # a word or two put in or left out moves later words: neighbouring places count too
            if n + sum(votes.get((k, start + s), 0) for s in (-2, -1, 1, 2)) < self.needed[k]:
                continue
            label, text, keys = self.templates[k]
            low, high = max(0, start - 2), start + len(text) + 2
            if not all(find_phrase(words, key, low, high) for key in keys):
                continue
            here = Counter(words[low:high])
            share = sum(min(c, here[w]) for w, c in Counter(text).items()) / len(text)
            if share >= MIN_MATCH:
                out[label] = max(out.get(label, 0.0), share)
        return out

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        present = set(words)
        found, base = [], set()
        if present & self.first:
            for phrase, label in self.base:
                if phrase[0] in present and (places := find_phrase(words, phrase)):
                    found += places
                    base.add(label)
        more = self.labels(words, present)
        score = 1.0 if base else max(more.values(), default=0.0)
        return len(words), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(base)), ",".join(sorted(base | more.keys())), score


def word_frequencies(docs: DataFrame, text_col: str) -> tuple[dict[bytes, int], int]:
    """In how many documents each template word occurs, and the number of documents; one row a word and task reaches the shuffle."""
    vocabulary = frozenset(w for _, text, _ in TEMPLATES for w in _split(text))

    def count(batches):
        import pyarrow as pa

        df: Counter = Counter()
        n = 0
        for b in sliced(batches):
            for text in b.column(0).to_pylist():
                df.update(vocabulary.intersection(words_of(text)))
                n += 1
        yield pa.RecordBatch.from_pydict({"word": ["", *(w.decode() for w in df)], "n": [n, *df.values()]}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    rows = docs.select(quoted(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r.word.encode(): r.n for r in rows}
    return counts, counts.pop(b"", 0)


FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id and FIELDS."""
    frequency, n = word_frequencies(docs, text_col)

    def make():
        index = Index(frequency, n)

        def work(cols: dict) -> dict:
            rows = [index.scan(t) for t in cols["text"]]
            return {"id": cols["id"]} | {f: [r[k] for r in rows] for k, f in enumerate(FIELDS)}

        return work

    d = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(d, make, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double").withColumnRenamed("id", id_col)
