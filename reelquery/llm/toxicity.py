"""Operator 2: toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned from a bounded sample of labelled documents (``SAMPLE`` toxic ones and ``CLEAN`` times
as many others, outside the held-out fold, and ``SAMPLE_CHARS`` code points of each label): words that occur in toxic documents in many different contexts and hardly in others.
Counting different contexts (neighbouring words), one a document, keeps words of copied and of very long
documents out. Beside whole terms the lexicon holds stems, beginnings that several such words share: a node of the
trie that accepts whatever follows. Stems take in inflected forms; they are matched without edits.

The lexicon's trie is intersected with the Levenshtein automaton of each term (one edit for terms of
``FUZZY_FROM`` letters or more): a state is the set of (trie node, edits) pairs alive, made when first
reached. Most words leave the automaton after a few letters, so misspelled terms cost little to find. Words of
the sample's clean documents are words of their own, not misspellings.

Each hit has a weight (less for misspelled ones). Its context window tells quotation from abuse: a
hit between quotation marks counts ``QUOTED`` of its weight, unless other hits stand near it outside
quotation marks. The score is 1 - exp(-sum of weights).

Null and empty texts score 0. Without labelled toxic rows the lexicon is empty and all score 0. Rows with
equal ids are scored one by one; a null id is in the fold of the text "None". A word that is one edit from several terms
takes the one of most weight. Very long texts are scored whole, in time n log n in their hits. An empty table gives an empty
result. Other columns aren't read.
"""

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, fold, in_batches, quoted, trim, within_chars

SAMPLE, SAMPLE_CHARS, HELD_OUT, THRESHOLD = 1_500, 30_000_000, 2, 0.3
#: A term occurs in so many contexts at least, and in a larger sample in this share of toxic documents.
MIN_CONTEXTS, MIN_SHARE, MIN_RATIO = 3, 0.012, 20.0
#: -log of the chance that a term's contexts would all be toxic; lengths of stems; words that a stem stands for; weight per unit of log ratio.
SURE, STEMS, STEM_WORDS, PER_LOG = 8.0, (4, 5, 6, 7, 8), 3, 0.058
#: So many clean documents for each toxic one are sampled.
CLEAN = 3
FUZZY_FROM = 5
EXACT, FUZZY, QUOTED, WINDOW = 0.45, 0.45, 0.25, 60
WORD = re.compile(r"[^\W_]+")
#: Opening and closing quotation marks.
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›"}


class Lexicon:
    """The automaton: match(word) is 0 for a term and for words that a stem (term*) begins, 1 for a term with one edit, None for other words."""

    def __init__(self, terms):
        self.next: list[dict[str, int]] = [{}]
        self.end: list[bool] = [False]
        self.depth: list[int] = [0]
        self.long: list[bool] = [False]  # a term that may be misspelled lies below
        self.stem: list[bool] = [False]
        self.weight: dict[int, float] = {}
        for term in terms:
            term, _, weight = term.partition(":")
            star, term = term.endswith("*"), term.rstrip("*")
            at, fuzzy = 0, len(term) >= FUZZY_FROM and not star
            path = [0]
            for c in term:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    for column, value in ((self.next, {}), (self.end, False), (self.depth, self.depth[at] + 1), (self.long, False), (self.stem, False)):
                        column.append(value)
                at = self.next[at][c]
                path.append(at)
            (self.stem if star else self.end)[at] = True
            self.weight[at] = max(float(weight or EXACT), self.weight.get(at, 0.0))
            if fuzzy:
                for node in path:
                    self.long[node] = True
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stemmed: list[bool] = []
        self.start = self._state({(0, 0)} if len(self.next) > 1 else set())

    def _close(self, pairs: set) -> frozenset:
        """Adds what a left-out letter reaches, and keeps the fewest edits of each node."""
        least: dict[int, int] = {}
        for node, edits in pairs:
            least[node] = min(edits, least.get(node, 9))
        for node, edits in list(least.items()):
            if edits == 0:
                for child in self.next[node].values():
                    if self.long[child] and child not in least:
                        least[child] = 1
        return frozenset(least.items())

    def _state(self, pairs: set) -> int:
        s = self._close(pairs)
        if s not in self.ids:
            self.ids[s] = len(self.states)
            self.states.append(s)
            self.moves.append({})
            self.stemmed.append(any(edits == 0 and self.stem[node] for node, edits in s))
        return self.ids[s]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, edits in self.states[state]:
            if c in self.next[node] and (edits == 0 or self.long[self.next[node][c]]):
                out.add((self.next[node][c], edits))
            if edits == 0 and self.long[node]:
                out.add((node, 1))  # one letter too many
                out.update((child, 1) for x, child in self.next[node].items() if x != c and self.long[child])  # another letter
        if len(self.states) > 200_000:  # states are few unless the lexicon is large
            self.__dict__.update(ids={}, states=[], moves=[], stemmed=[])
            self.start = self._state({(0, 0)})
            state = self.start
            return self._state(out)
        self.moves[state][c] = to = self._state(out) if out else -1
        return to

    def find(self, word: str) -> tuple[int, float] | None:
        """(edits, weight) of the term that the word is; of several, that of fewest edits and most weight."""
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            if to is None:
                to = self._move(state, c)
            if to < 0:
                return None
            state = to
            if self.stemmed[state]:
                return 0, max(self.weight[node] for node, edits in self.states[state] if edits == 0 and self.stem[node])
        found = [(edits, -self.weight[node]) for node, edits in self.states[state] if self.end[node] and (edits == 0 or self.depth[node] >= FUZZY_FROM)]
        return (min(found)[0], -min(found)[1]) if found else None

    def match(self, word: str) -> int | None:
        return (self.find(word) or (None,))[0]


def learn(rows: list[tuple[str, int]]) -> tuple[list[str], list[str]]:
    """The lexicon from (text, toxic) rows (term:weight, stems with a star at the end); and words of clean rows that are one edit from a term, so no misspellings.

    A term must be far more frequent in toxic rows, and meet in enough contexts that chance has no part in it
    (``SURE``). A stem stands for several words.
    """
    contexts: dict[str, set] = defaultdict(set)
    df = (Counter(), Counter())
    total = [0, 0]
    for text, toxic in rows:
        words = WORD.findall((text or "").lower())
        toxic = int(bool(toxic))
        total[toxic] += 1
        df[toxic].update(set(words))
        if toxic:
            first = {}  # one context of a word a document, so a long document isn't many witnesses
            for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                if len(w) > 2:
                    first.setdefault(w, (before, after))
            for w, around in first.items():
                contexts[w].add(around)
    if not total[1]:
        return [], []
    least = max(MIN_CONTEXTS, MIN_SHARE * total[1], SURE / math.log((total[0] + 1 + total[1]) / total[1]))
    ratio = lambda toxic, clean: (toxic / total[1]) / ((clean + 0.5) / (total[0] + 1))
    rare = 0.002 * total[0]
    good = [(len(seen), ratio(df[1][w], df[0][w]), w) for w, seen in contexts.items() if len(seen) >= least and df[0][w] <= rare]
    stems: dict[str, list[str]] = defaultdict(list)
    for w in contexts:
        for n in STEMS:
            if len(w) > n:
                stems[w[:n]].append(w)
    stems = {x: ws for x, ws in stems.items() if sum(len(contexts[w]) > 1 for w in ws) >= STEM_WORDS and sum(len(contexts[w]) for w in ws) >= least}
    clean = Counter()
    for w, n in df[0].items():
        clean.update({x: n for k in STEMS if len(w) > k and (x := w[:k]) in stems})
    for x, ws in stems.items():
        if clean[x] <= rare:  # a shorter stem stands for all longer ones
            n = sum(len(contexts[w]) for w in ws)
            if not any(x[:k] in stems and clean[x[:k]] <= rare for k in range(min(STEMS), len(x))):
                good.append((n, ratio(min(n, total[1]), clean[x]), x + "*"))
    terms = [f"{w}:{weight_of(r):.3f}" for _, r, w in sorted(good, key=lambda t: (-t[0], t[2])) if r >= MIN_RATIO]
    lexicon = Lexicon(terms)
    natural = sorted(w for w in df[0] if lexicon.match(w) == 1)
    contexts.clear()
    df[0].clear()
    trim()  # the driver's memory goes back to the system
    return terms, natural


def weight_of(ratio: float) -> float:
    """A term's weight: in proportion to the log of how much likelier it makes a toxic text."""
    return min(EXACT, PER_LOG * math.log(ratio))


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Spans between matching quotation marks of one line, however long."""
    out, line = [], 0
    for part in text.split("\n"):
        at, open_ = 0, set()  # marks that are not closed any more on the line
        while at < len(part):
            mark = part[at]
            if mark in QUOTES and mark not in open_:
                stop = part.find(QUOTES[mark], at + 1)
                if stop > 0:
                    out.append((line + at, line + stop))
                    at = stop
                else:
                    open_.add(mark)
            at += 1
        line += len(part) + 1
    return out


def score_hits(text: str, hits: list[tuple[int, int, int, float]]) -> float:
    """hits: (start, end, edits, weight). Higher for abuse than for quotation."""
    if not hits:
        return 0.0
    spans = quoted_spans(text) if any(q in text for q in QUOTES) else []  # one after the other
    opens = [a for a, _ in spans]

    def is_inside(start: int, end: int) -> bool:
        k = bisect_left(opens, start) - 1
        return k >= 0 and end <= spans[k][1]

    inside = [is_inside(s, e) for s, e, *_ in hits]
    bare = sorted(s for (s, *_), q in zip(hits, inside, strict=True) if not q)

    def is_alone(start: int) -> bool:
        k = bisect_left(bare, start - WINDOW)
        return k == len(bare) or bare[k] > start + WINDOW

    total = 0.0
    for (s, _, edits, weight), q in zip(hits, inside, strict=True):
        if edits:
            weight *= FUZZY
        if q and is_alone(s):
            weight *= QUOTED
        total += weight
    return 1 - math.exp(-total)


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> list[tuple[str, int]]:
    """`most` toxic rows or a few more and CLEAN times as many others, chosen by a hash of the id; labels are picked first, so few texts move."""
    y = labels.select(quoted(id_col).alias("i"), F.col("toxic").cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("i").isNotNull() & (F.pmod(F.crc32(F.col("i").cast("string")), F.lit(4)) != HELD_OUT))
    n = dict(y.groupBy("y").count().collect())
    share = F.when(F.col("y") == 1, most / max(1, n.get(1, 0))).otherwise(CLEAN * most / max(1, n.get(0, 0)))
    chosen = y.where(F.pmod(F.xxhash64("i"), F.lit(1_000_000)) < share * 1_000_000).limit((CLEAN + 2) * most)
    d = docs.select(quoted(id_col).alias("i"), quoted(text_col).alias("t"))
    taken = d.join(F.broadcast(chosen), "i").limit((CLEAN + 2) * most)  # so many small rows at most; ids may repeat
    taken = within_chars(taken, "y", "t", "i", SAMPLE_CHARS).select("t", "y").toArrow()
    return list(zip(taken.column("t").to_pylist(), taken.column("y").to_pylist(), strict=True))


def scorer(terms: list[str], natural: list[str]):
    """The function from a text to (score, hits), with the words it has met."""
    lexicon, natural = Lexicon(terms), frozenset(natural)
    known = Memo(lambda w: None if w in natural else lexicon.find(w))

    def score(text: str | None) -> tuple[float, int]:
        low = (text or "").lower()
        hits = []
        if any(known[w] is not None for w in set(WORD.findall(low))):
            hits = [(m.start(), m.end(), *known[m[0]]) for m in WORD.finditer(low) if known[m[0]] is not None]
        return score_hits(low, hits), len(hits)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row a document: id, held_out, score, predicted, n_hits."""
    learned = learn(sample_of(docs, labels, id_col, text_col, sample))

    def make():
        score = scorer(*learned)

        def work(cols: dict) -> dict:
            rows = [score(t) for t in cols["text"]]
            return {"id": cols["id"], "held_out": [fold(i) == HELD_OUT for i in cols["id"]], "score": [s for s, _ in rows], "predicted": [int(s >= THRESHOLD) for s, _ in rows], "n_hits": [n for _, n in rows]}

        return work

    d = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(d, make, f"id {kind}, held_out boolean, score double, predicted int, n_hits long").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The documents that score below the threshold, with all their columns; scored within the scan, nothing is joined."""
    learned = learn(sample_of(docs, labels, id_col, text_col, sample))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = scorer(*learned)
        for texts in parts:
            yield texts.map(lambda t: f(t)[0]).astype(float)
        del f
        trim()

    return docs.where(F.coalesce(score(quoted(text_col)), F.lit(0.0)) < THRESHOLD)
