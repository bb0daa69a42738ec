"""The operators against brute force, their SQL, the public tokenizers, and held-out labels."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from reelquery.llm import embedding_dedup, language_id, license_scan, mixing, ngram_join, packing, token_counts, toxicity
from reelquery.llm.common import Scratch, connected_components
from reelquery.llm.queries import ORACLES, QUERIES

from ..oracle import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), ORACLES[name], sf)


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


# --- components -------------------------------------------------------------------------------------


def smallest(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {x: find(x) for x in list(root)}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(1000, 1100)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark)).collect()}
    assert got == {k: v for k, v in smallest(p for p in pairs if p[0] != p[1]).items()}


# --- op3 --------------------------------------------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def jaccard_components(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    roots = smallest(pairs)
    return {i: (len(s), roots.get(i, i)) for i, s in sets.items()}


def test_groups_of_near_copies_and_a_common_passage(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(80)]
    texts = {}
    for k in range(150):
        near = list(base)
        for _ in range(rng.randrange(3)):
            near[rng.randrange(80)] = word()
        texts[k] = " ".join(near)
    for k in range(150, 260):
        texts[k] = " ".join(passage + [word() for _ in range(rng.randrange(5, 90))])
    chain = [word() for _ in range(100)]
    for k in range(260, 275):
        chain = chain[4:] + [word() for _ in range(4)]
        texts[k] = " ".join(chain)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(d).collect()}
    assert got == jaccard_components(texts)


def test_keep_one_leaves_one_of_each_group(spark, documents, texts):
    small = {i: texts[i] for i in sorted(texts)[:120]}
    d = documents.where(documents.doc_id.isin(*small))
    assert {r.doc_id for r in ngram_join.keep_one(d).collect()} == {c for _, c in jaccard_components(small).values()}


# --- op2, op10 --------------------------------------------------------------------------------------


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=8), min_size=1, max_size=6), st.lists(st.text("abcd", min_size=1, max_size=9), max_size=12))
def test_automaton_is_edit_distance(terms, words):
    lexicon = toxicity.Lexicon(terms)
    for w in words:
        if w in terms:
            assert lexicon.match(w) == 0
        elif any(len(t) >= toxicity.FUZZY_FROM and edit_distance(t, w) == 1 for t in terms):
            assert lexicon.match(w) == 1
        else:
            assert lexicon.match(w) is None


def test_quotation_counts_less():
    text = 'they said "you are an idiot" and left'
    at = text.index("idiot")
    assert toxicity.score_hits(text, [(at, at + 5, 0, 0.4)]) < toxicity.THRESHOLD < toxicity.score_hits(text.replace('"', " "), [(at, at + 5, 0, 0.4)])


def test_toxic_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op2_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.9 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces(language_id.default_vocabulary())
    rng = np.random.default_rng(1)
    prob = np.concatenate([rng.random((len(pieces.texts), 2)) / len(pieces.texts), np.full((1, 2), language_id.UNKNOWN)])
    number = {t: k for k, t in enumerate(pieces.texts)}

    def total(word, lang):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, min(len(word), pieces.longest) + 1):
            k = number.get(word[:n], len(pieces.texts) if n == 1 else None)
            if k is not None:
                out += prob[k, lang] * total(word[n:], lang)
        return out

    words = ["the", "thing", "Ωmega".lower(), "a", "straße", "ß漢"]
    got = language_id.log_scores(words, pieces, prob)
    assert np.allclose(got, np.log([[total(w, 0), total(w, 1)] for w in words]))


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    r = QUERIES["op10_language_id"](spark, sf).where("held_out").join(d, "doc_id").selectExpr("avg(int(lang = lang_pred)) AS right").first()
    assert r.right > 0.97


# --- op4 --------------------------------------------------------------------------------------------


def test_base_labels_by_brute_force(spark, sf, texts):
    got = {r.doc_id: r for r in QUERIES["op4_license_scan"](spark, sf).collect()}
    for i, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(","))


def test_templates_are_found_where_words_moved():
    index = license_scan.Index({}, 100)
    for label, text, keys in license_scan.TEMPLATES:
        assert index.scan(f"x y {text} z")[5].split(",").count(label) == 1
        moved = text.replace(keys[0], f"{keys[0]} indeed")  # a word more, but not within a key phrase
        assert label in index.scan(moved)[5]
        assert label not in index.scan(text.replace(keys[0], " indeed ".join(keys[0].split())))[5]
    assert index.scan("general words about a license and the public, in version 3")[5] == ""
    assert index.scan("License the Apache way: version of 2 and 0")[5] == ""
    assert index.scan("CC-BY")[:5] == (2, 1, 0, 0, "cc-by")


# --- op5 --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram():
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = token_counts.unigram_vocabulary(token_counts.default_vocabulary())
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


def test_counts_are_the_tokenizers(spark, sf, texts, unigram):
    got = {r.doc_id: r.n_tokens for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    assert got == {i: len(unigram.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in texts.items()}


def test_ties_are_the_tokenizers():
    from tokenizers import Tokenizer, models

    rng = random.Random(4)
    for _ in range(200):
        pieces = {"".join(rng.choice("▁ab") for _ in range(rng.randrange(1, 4))) for _ in range(8)}
        pieces = {p for p in pieces if "▁" not in p[1:]} | {"▁"}
        vocabulary = [("<unk>", -20.0)] + [(p, -float(rng.randrange(1, 4))) for p in sorted(pieces)]
        t, c = Tokenizer(models.Unigram(vocabulary, unk_id=0)), token_counts.Counter(vocabulary)
        for _ in range(10):
            part = "▁" + "".join(rng.choice("abcd") for _ in range(rng.randrange(8)))
            assert c.count(part) == len(t.encode(part).ids)


# --- op6 --------------------------------------------------------------------------------------------


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").where("label is not null").collect()
    links = Counter()
    for group in {r.label for r in rows}:
        own = [r for r in rows if r.label == group]
        m = np.array([r.embedding for r in own], float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(m @ m.T >= 0.98), strict=True):
            if i != j:
                links[own[i].vec_id] += 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_dedup(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()}
    assert all(n <= links[i] for i, n in got.items())
    assert sum(got.values()) >= 0.95 * sum(links.values())


def test_cells_are_the_nearest():
    rng = np.random.default_rng(2)
    x = embedding_dedup.unit(rng.normal(size=(500, 8)))
    index = embedding_dedup.MultiIndex(x)
    got = index.cells(x[:20], 10)
    a, b = embedding_dedup.distances(x[:20, :4], index.books[0]), embedding_dedup.distances(x[:20, 4:], index.books[1])
    far = (a[:, :, None] + b[:, None, :]).reshape(20, -1)
    assert np.allclose(np.sort(np.take_along_axis(far, got, 1), 1), np.sort(far, 1)[:, :10])


# --- op8 --------------------------------------------------------------------------------------------


def test_weights_meet_the_limits():
    totals = [1000.0, 100.0, 10.0, 0.0]
    t, w, r = mixing.solve(totals)
    assert 0 < t < 1 and sum(w) == pytest.approx(1) and max(r) <= 2 + 1e-6 and min(r[:3]) == pytest.approx(1)
    assert mixing.solve([5.0, 5.0], budget=5.0)[2] == pytest.approx([0.5, 0.5])
    assert mixing.solve([0.0])[2] == [1.0]


def test_budgets_are_met(spark, sf, documents):
    rows = QUERIES["op8_mixing"](spark, sf).collect()
    used, reps, total, longest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in rows:
        used[r.source] += r.n_tokens
        reps[r.source] = r.repetitions
        longest[r.source] = max(longest[r.source], r.n_tokens)
    for r in documents.collect():
        total[r.source] += len((r.text or "").split())
    for s in total:
        assert reps[s] * total[s] - 1 <= used[s] + longest[s] and used[s] <= reps[s] * total[s] + longest[s]
    assert all(0 <= r.position <= 1 for r in rows)
    assert max(Counter((r.doc_id, r.epoch) for r in rows).values()) == 1


# --- op9 --------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_packing_places_each_piece_once(histogram):
    slots, sequences = packing.shortest_pack_first(histogram, 64)
    spans = defaultdict(list)
    for length, n in histogram.items():
        own = [s for s in slots.tolist() if s[0] == length]
        for r in range(n):
            _, first, sequence, offset = max((s for s in own if s[1] <= r), key=lambda s: s[1])
            spans[sequence + r - first].append((offset, length))
    assert set(spans) == set(range(sequences))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_pieces_round_trip(spark, sf, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    got = defaultdict(list)
    for r in QUERIES["op9_packing"](spark, sf).collect():
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert sorted(got[i]) == [(k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()), len(ids)) for k in range(0, len(ids), 4096)]


def test_odd_words_round_trip():
    from tokenizers import Tokenizer

    words = ["don't", "a.", "1,", "<|endoftext|>", "É", "éx", "İx", "漢字!", " a", "x y", "a-b", "'s", "\x1c", "naïve,", "̈a"]
    known = packing.WordIds(packing.default_tokenizer())
    known.learn({w.encode() for w in words})
    tok = Tokenizer.from_file(packing.default_tokenizer())
    for w in words:
        assert np.frombuffer(known.known[w.encode()], "<u4").tolist() == tok.encode(w, add_special_tokens=False).ids


# --- pipeline ---------------------------------------------------------------------------------------


def test_stages(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard", "mixing", "packing"]
    scratch = Scratch(spark)
    kept = scratch.write(stages["toxicity"](spark, docs, sf), "t")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(texts) - toxic
    lines = scratch.write(stages["line_dedup"](spark, kept, sf), "l")
    assert lines.columns == columns and lines.count() == kept.count()
    once = scratch.write(stages["ngram_jaccard"](spark, lines, sf), "n")
    assert once.columns == columns
    assert {r.doc_id for r in once.collect()} == {c for _, c in jaccard_components({r.doc_id: r.text for r in lines.collect()}).values()}
    mixed = scratch.write(stages["mixing"](spark, once, sf), "m")
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in once.collect()}
    packed = stages["packing"](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in mixed.collect())
    assert corpus_pipeline.run(spark, sf).count() == len(packed)
