"""Operator 10: language ID by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a word is
the sum, over all ways to cut it into pieces, of the product of the pieces' probabilities; the forward
algorithm gets it without listing the cuts. Piece probabilities come from expectation maximisation with
the forward-backward algorithm over a bounded sample of labelled documents (``SAMPLE`` of them in all,
at most, and ``SAMPLE_CHARS`` code points, shared out to the languages), with all words of theirs; everything else covers
whole texts of all documents. Every language of the labels is learned; more than ``MAX_LANGS`` are an error.

Words are runs of letters (Unicode category L), lower-cased. The algorithm runs for many words at once, one step a word
position and piece length, and each distinct word is scored once a task. Words of more than ``MANY`` letters go one by one,
in logarithms and over as many positions as the longest piece has letters, so they may be of any length and nothing is cut.

``und`` with score 0 is the result for null, empty or letterless texts, and for all texts if there is
nothing to learn from. Ties go to the smaller language name. Rows with equal ids are scored one by one;
null ids stay null and belong to the fold of the text "None". Very long texts are scored whole; an empty table gives an empty
result. Columns other than those named aren't read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, in_batches, quoted, within_chars

SAMPLE, SAMPLE_CHARS, MAX_LANGS = 4_000, 50_000_000, 1_000
#: Up to so many letters products of probabilities are far from underflow.
ROUNDS, MANY = 3, 40
HELD_OUT = 2
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = 1e-7


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_in(text: str | None) -> list[str]:
    """Lower-cased runs of letters. What the pattern takes for a letter besides (as in m²) parts words."""
    words = LETTERS.findall(text.lower()) if text else []
    if not all(map(str.isalpha, words)):
        words = [x for w in words for x in "".join(c if c.isalpha() else " " for c in w).split()]
    return words


class Pieces:
    """The vocabulary's pieces of letters, and where they match in a list of words."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = (sp.id_to_piece(i).replace("▁", "") for i in range(sp.get_piece_size()))
        self.texts = sorted({t for t in texts if t == t.lower() and t.isalpha()})
        self.auto = ahocorasick.Automaton()
        for k, t in enumerate(self.texts):
            self.auto.add_word(t, k)
        self.auto.make_automaton()
        self.lengths = np.array([len(t) for t in self.texts], np.int32)
        self.longest = int(self.lengths.max(initial=1))
        self.single = {t for t in self.texts if len(t) == 1}

    def matches(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, end, length, piece) of all matches by end and length, and the words' lengths; unknown letters are pieces of their own, number len(texts)."""
        size = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(size + 1) - size - 1
        found = np.array(list(self.auto.iter("\n".join(words))), np.int64).reshape(-1, 2)
        piece = found[:, 1]
        length = self.lengths[piece].astype(np.int64)
        word = np.searchsorted(start, found[:, 0], "right") - 1
        end = found[:, 0] - start[word] + 1
        seen = np.zeros(int(size.sum() + len(words)), bool)
        single = length == 1
        seen[found[single, 0]] = True
        seen[start + size] = True  # the line feeds
        gaps = np.flatnonzero(~seen)
        w = np.searchsorted(start, gaps, "right") - 1
        word, end = np.concatenate([word, w]), np.concatenate([end, gaps - start[w] + 1])
        length = np.concatenate([length, np.ones(len(gaps), np.int64)])
        piece = np.concatenate([piece, np.full(len(gaps), len(self.texts))])
        order = np.lexsort((length, end))
        return word[order], end[order], length[order], piece[order], size


    def ends(self, word: str):
        """For each position of one word: (lengths, pieces) of the matches that end there."""
        found = self.auto.iter(word)
        end, k = next(found, (len(word), 0))
        for at, c in enumerate(word):
            lengths, pieces = ([], []) if c in self.single else ([1], [len(self.texts)])
            while end == at:
                lengths.append(int(self.lengths[k]))
                pieces.append(k)
                end, k = next(found, (len(word), 0))
            yield np.array(lengths), np.array(pieces)


def steps(end: np.ndarray, length: np.ndarray):
    """Ranges of equal (end, length); in one, each word occurs once at most."""
    key = end * (int(length.max(initial=0)) + 1) + length
    cuts = np.flatnonzero(np.diff(key)) + 1
    return zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(key)]]).tolist(), strict=True) if len(key) else ()


def forward(words: list[str], pieces: Pieces, prob: np.ndarray):
    """alpha[word, position, language], and the matches. prob: a row a piece, a column a language."""
    word, end, length, piece, size = m = pieces.matches(words)
    alpha = np.zeros((len(words), int(size.max(initial=0)) + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for a, b in steps(end, length):
        w, e = word[a:b], end[a]
        alpha[w, e] += alpha[w, e - length[a]] * prob[piece[a:b]]
    return alpha, m


def log_scores(words: list[str], pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """log of each word's probability, all segmentations summed: a row a word, a column a language."""
    if not words:
        return np.zeros((0, prob.shape[1]))
    alpha, m = forward(words, pieces, prob)
    return np.log(np.maximum(alpha[np.arange(len(words)), m[4]], 1e-300))


def log_score(word: str, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """The same for one word of any length, by logarithms of the probabilities; a row of a language each."""
    ring = np.full((pieces.longest + 1, logs.shape[1]), -np.inf)
    ring[0] = 0
    for at, (lengths, k) in enumerate(pieces.ends(word), 1):
        ring[at % len(ring)] = np.logaddexp.reduce(ring[(at - lengths) % len(ring)] + logs[k], axis=0)
    return ring[len(word) % len(ring)]


def long_counts(word: str, pieces: Pieces, prob: np.ndarray, counts: np.ndarray, weight: float) -> None:
    """Adds the expected piece counts of one word of any length."""
    logs, matches = np.log(prob), list(pieces.ends(word))
    alpha, beta = np.full(len(word) + 1, -np.inf), np.full(len(word) + 1, -np.inf)
    alpha[0] = beta[len(word)] = 0
    for at, (lengths, k) in enumerate(matches, 1):
        alpha[at] = np.logaddexp.reduce(alpha[at - lengths] + logs[k])
    for at in range(len(word), 0, -1):
        lengths, k = matches[at - 1]
        np.add.at(counts, k, weight * np.exp(alpha[at - lengths] + logs[k] + beta[at] - alpha[-1]))
        beta[at - lengths] = np.logaddexp(beta[at - lengths], beta[at] + logs[k])


def expected_counts(words: list[str], weight: np.ndarray, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected piece counts of one language (prob has one column), by forward-backward."""
    if max(map(len, words)) > MANY:
        short = np.array([len(w) <= MANY for w in words])
        few = [w for w in words if len(w) <= MANY]
        counts = expected_counts(few, weight[short], pieces, prob) if few else np.zeros(len(prob))
        for w, x in zip(words, weight.tolist(), strict=True):
            if len(w) > MANY:
                long_counts(w, pieces, prob[:, 0], counts, x)
        return counts
    alpha, (word, end, length, piece, size) = forward(words, pieces, prob)
    beta = np.zeros(alpha.shape[:2])
    beta[np.arange(len(words)), size] = 1
    total = np.maximum(alpha[np.arange(len(words)), size, 0], 1e-300)
    counts = np.zeros(len(prob))
    p = prob[:, 0]
    for a, b in reversed(list(steps(end, length))):
        w, e, x = word[a:b], end[a], piece[a:b]
        beta[w, e - length[a]] += beta[w, e] * p[x]
        np.add.at(counts, x, weight[w] * alpha[w, e - length[a], 0] * p[x] * beta[w, e] / total[w])
    return counts


def fit(texts: list[tuple[str, str]], path: str) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and piece probabilities, from (text, language) rows."""
    pieces = Pieces(path)
    seen: dict[str, Counter] = {}
    for text, lang in texts:
        seen.setdefault(lang, Counter()).update(words_in(text))
    langs = sorted(lang for lang, c in seen.items() if c)
    n = len(pieces.texts)
    prob = np.zeros((n + 1, len(langs)))
    for k, lang in enumerate(langs):
        words = [w for w, _ in seen[lang].most_common()]
        weight = np.array([seen[lang][w] for w in words], float)
        p = np.full((n + 1, 1), 1 / n)
        p[n] = UNKNOWN
        for _ in range(ROUNDS):
            counts = sum(expected_counts(words[a : a + 20_000], weight[a : a + 20_000], pieces, p) for a in range(0, len(words), 20_000))
            counts = counts[:n] + 0.01
            p[:n, 0] = counts / counts.sum()
        prob[:, k] = p[:, 0]
    return langs, prob


def sample_of(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> list[tuple[str, str]]:
    """About `most` labelled rows outside the held-out fold, chosen by a hash of their ids, as many of each language as there are."""
    d = docs.select(quoted(id_col).alias("i"), quoted(text_col).alias("t"), quoted(lang_col).alias("g")).where(F.col("g").isNotNull() & F.col("i").isNotNull() & (F.pmod(F.crc32(F.col("i").cast("string")), F.lit(4)) != HELD_OUT))
    counts = d.groupBy("g").count().orderBy(F.desc("count"), "g").limit(MAX_LANGS + 1).collect()
    if not counts:
        return []
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    each = max(1, most // len(counts))
    kind = d.schema["g"].dataType.simpleString()
    shares = F.broadcast(d.sparkSession.createDataFrame([(g, each / n) for g, n in counts], f"g {kind}, share double"))  # MAX_LANGS rows at most
    taken = d.join(shares, "g").where(F.pmod(F.xxhash64("i"), F.lit(1_000_000)) < F.col("share") * 1_000_000).select("i", "t", "g").limit(2 * max(most, len(counts)))
    taken = within_chars(taken, "g", "t", "i", SAMPLE_CHARS // len(counts)).select("t", "g").toArrow()
    return list(zip(taken.column("t").to_pylist(), taken.column("g").to_pylist(), strict=True))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabulary: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row a document: id, held_out, lang_pred, score (the posterior, tempered by the number of words)."""
    path = vocabulary or default_vocabulary()
    langs, prob = fit(sample_of(docs, id_col, text_col, lang_col, sample), path)
    sent = docs.sparkSession.sparkContext.broadcast(prob)  # pieces x languages, both bounded

    def make():
        pieces, prob = Pieces(path), sent.value
        wide = max(1, len(langs))
        # rows kept, words at once and texts at once shrink as languages grow, so memory doesn't grow with them
        most, some, step = min(500_000, 24_000_000 // wide), min(5_000, 250_000 // wide), min(1_000, max(20, 50_000 // wide))
        block = max(1_000, 4_000_000 // wide)
        known: dict[str, int] = {}
        rows = np.zeros((most, wide))

        def add(words: list[str]) -> None:
            nonlocal rows
            if (need := len(known) + len(words)) > len(rows):  # a slice of texts with more words than are kept
                rows = np.concatenate([rows, np.zeros((need - len(rows) + some, wide))])
            short = sorted((w for w in words if len(w) <= MANY), key=len)
            for x in range(0, len(short), some):
                part, n = short[x : x + some], len(known)
                rows[n : n + len(part)] = log_scores(part, pieces, prob)
                known.update(zip(part, range(n, n + len(part)), strict=True))
            if len(short) < len(words):
                logs = np.log(prob)
                for w in words:
                    if len(w) > MANY:
                        rows[len(known)] = log_score(w, pieces, logs)
                        known[w] = len(known)

        def work(cols: dict) -> dict:
            nonlocal rows
            out = {"id": cols["id"], "held_out": [fold(i) == HELD_OUT for i in cols["id"]], "lang_pred": [], "score": []}
            for k in range(0, len(cols["text"]), step):
                split = [words_in(t) for t in cols["text"][k : k + step]]
                new = list({w for ws in split for w in ws if w not in known})
                if len(known) + len(new) > most:
                    known.clear()
                    rows = rows[:most]
                    new = list({w for ws in split for w in ws})
                if langs:
                    add(new)
                for ws in split:
                    if not ws or not langs:
                        out["lang_pred"].append("und")
                        out["score"].append(0.0)
                        continue
                    at = list(map(known.__getitem__, ws))
                    total = sum(rows[at[x : x + block]].sum(axis=0) for x in range(0, len(at), block))
                    best = int(total.argmax())
                    soft = np.exp((total - total[best]) / np.sqrt(len(ws)))
                    out["lang_pred"].append(langs[best])
                    out["score"].append(float(1 / soft.sum()))
                while known and len(last := next(reversed(known))) > MANY:  # long words come last and aren't kept
                    del known[last]
            return out

        return work

    d = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(d, make, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
