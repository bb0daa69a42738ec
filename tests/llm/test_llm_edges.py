"""Each operator on messy tables: nulls, empty and very long texts, repeated rows, no rows, clashing column names."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from reelquery.llm import embedding_dedup, language_id, license_scan, line_dedup, mixing, ngram_join, packing, quality, token_counts, toxicity

LONG = " ".join(f"word{k % 977} idiot" for k in range(60_000))
LINE = "the same line in several documents"
#: Names that the operators use inside stand here as columns of the table.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, sig long, h1 long, _w string, score double, keeper long, _text string, epoch int, block int, pos int, n_tokens long, _id long, _last int, _epoch int, `a.b` long, key long, mark int, own string"
FILL = (1, 2, 3, 4, "w", 0.5, 6, "t", 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, "o")


def docs(spark, rows):
    return spark.createDataFrame([(*r, *FILL) for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def messy(spark):
    return docs(spark, [
        (1, f"{LINE}\nfirst", "en", "a", 1), (2, f"  {LINE.upper()}\t\nsecond", "en", "a", None), (3, f"{LINE}", None, None, 1),
        (4, None, "en", "a", 1), (5, "", "fr", "b", 1), (6, " \t\n ", "fr", "b", 1), (None, f"{LINE}\nnone", "en", "a", 1),
        (7, LONG, "en", "a", 1), (8, "twice", "en", "c", 1), (8, "twice", "en", "c", 1), (9, "ÀÉ İ ǅ 漢字 ", "fr", "b", 1), (10, "12 34 !!", "fr", "b", 1),
    ]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (7, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


EMPTY = [
    line_dedup.line_dedup, quality.quality_rules, packing.pack, language_id.language_id, token_counts.token_counts,
    license_scan.license_scan, mixing.mix, mixing.realise, ngram_join.ngram_join, ngram_join.keep_one,
]


@pytest.mark.parametrize("operator", EMPTY, ids=lambda f: f.__name__)
def test_empty_tables(spark, operator):
    assert operator(docs(spark, [])).count() == 0


def test_empty_tables_with_a_second_input(spark, labels):
    assert toxicity.toxicity(docs(spark, []), labels).count() == 0
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def by_id(df, *columns):
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=repr)


def test_line_dedup(messy):
    got = {r.doc_id: r for r in line_dedup.line_dedup(messy).collect()}
    assert len(got) == 11
    assert (got[1].text, got[2].text, got[3].text, got[None].text) == ("first", "second", LINE, "none")
    assert (got[4].n_lines, got[4].n_dropped, got[4].text) == (1, 0, "")
    assert got[7].text == LONG and got[6].n_lines == 2
    carried = line_dedup.line_dedup(messy, carry=True)
    rows = {r.doc_id: r for r in carried.collect()}
    assert carried.columns == messy.columns and carried.count() == 12
    assert rows[1].text == "first" and rows[4].text is None and rows[5].text == "" and rows[1]["a.b"] == 14


def test_rows_with_one_id_are_one_document(spark):
    d = docs(spark, [(k, LINE, "en", "a", 1) for k in (1, 1, 1, 2)])
    assert {r.n_dropped for r in line_dedup.line_dedup(d).collect()} == {0}
    d = docs(spark, [(k, LINE, "en", "a", 1) for k in (1, 2, 3, 3)])
    assert by_id(line_dedup.line_dedup(d), "n_dropped") == [(1, 1), (2, 1), (3, 0), (3, 0)]


def test_lines_in_two_documents_stay(spark):
    d = docs(spark, [(k, f"{LINE}\nx", "en", "a", 1) for k in (1, 2)])
    assert by_id(line_dedup.line_dedup(d), "n_dropped") == [(1, 0), (2, 0)]
    d = docs(spark, [(k, f"{LINE}\n{LINE}\nshort", "en", "a", 1) for k in range(40)])
    assert by_id(line_dedup.line_dedup(d), "n_dropped") == sorted(((k, 2 * (k < 39)) for k in range(40)), key=repr)


def test_lines_only_lower_ascii(spark):
    d = docs(spark, [(k, t, "en", "a", 1) for k, t in enumerate(["ÀÀ long enough to be a key", "àà long enough to be a key", "àà LONG enough to be a key", "İİ LONG enough to be a key"])])
    assert {r.n_dropped for r in line_dedup.line_dedup(d).collect()} == {0}


def test_quality(messy):
    got = {r.doc_id: r for r in quality.quality_rules(messy).collect()}
    assert (got[4].n_words, got[4].base_failed, got[4].kept) == (0, True, False)
    assert got[7].n_words == 120_000 and got[7].n_repeat_words == 120_000 and got[7].base_failed
    assert got[2].n_words == 7


def repeated(words):
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    return len({k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)})


def test_repeated_windows(spark):
    texts = ["a b c d a b c", "a a a a", "a b", "a b c", "x y z x y z x", "a b c\na b c\n\n \na b c"]
    d = docs(spark, [(k, t, "en", "a", 1) for k, t in enumerate(texts)])
    got = {r.doc_id: (r.n_repeat_words, r.n_dup_lines) for r in quality.quality_rules(d).collect()}
    assert got == {k: (repeated(t.split()), 2 * (k == 5)) for k, t in enumerate(texts)}


def test_packing(messy):
    rows = packing.pack(messy).collect()
    assert sorted(r.length for r in rows if r.doc_id in (4, 5, 6)) == [1, 1, 1]
    assert sum(r.length for r in rows if r.doc_id == 7) == next(r.doc_tokens for r in rows if r.doc_id == 7)
    assert len([r for r in rows if r.doc_id == 8]) == 2 and len([r for r in rows if r.doc_id is None]) == 1
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 4096


def test_language(messy):
    got = {r.doc_id: r for r in language_id.language_id(messy).collect()}
    assert {got[k].lang_pred for k in (4, 5, 6, 10)} == {"und"} and got[4].score == 0.0
    assert got[1].lang_pred in ("en", "fr") and 0 <= got[1].score <= 1
    assert got[1].held_out == (zlib.crc32(b"1") % 4 == 2)


def test_nothing_to_learn_from(spark):
    d = docs(spark, [(1, "some text", None, "a", 1)])
    assert language_id.language_id(d).first().lang_pred == "und"
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(d, none).first().score == 0.0


def test_toxicity(messy, labels):
    rows = toxicity.toxicity(messy, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert {r.predicted for r in rows if r.doc_id in (4, 5, 6)} == {0}
    assert toxicity.keep_clean(messy, labels).columns == messy.columns


def test_token_counts(messy):
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(messy).collect()}
    assert got[4] == 0 and got[5] == 0 and got[6] > 0 and got[7] > 120_000


def test_license_scan(messy):
    got = {r.doc_id: r for r in license_scan.license_scan(messy).collect()}
    assert (got[4].n_words, got[4].first_word, got[4].labels, got[4].score) == (0, None, "", 0.0)
    assert got[7].n_words == 120_000


def test_mixing(messy):
    rows = mixing.mix(messy).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None}
    assert {r.source for r in rows} == {"a", "b", "c", None}
    assert mixing.realise(messy).columns == messy.columns


def test_ngram_join(messy):
    got = {r.doc_id: r for r in ngram_join.ngram_join(messy).collect()}
    assert (got[4].n_shingles, got[4].component_id) == (0, 4) and got[6].component_id == 6
    assert got[8].n_shingles == 1 and got[8].component_id == 8
    assert got[None].component_id is None
    once = ngram_join.keep_one(messy)
    assert once.columns == messy.columns
    assert sorted((r.doc_id for r in once.collect()), key=repr) == sorted([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None], key=repr)


def test_one_of_repeated_rows_stays(spark):
    a, b = "one two three four five six", "another text of some words here"
    d = docs(spark, [(1, a, "en", "a", 1), (1, a, "en", "a", 1), (2, a, "en", "a", 1), (3, b, "en", "a", 1), (3, "", "en", "a", 1), (3, "", "en", "a", 1)])
    assert sorted((r.doc_id, r.text) for r in ngram_join.keep_one(d).collect()) == [(1, a), (3, ""), (3, b)]


def test_embeddings(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, [1.0, 0.0], 1, "x"), (4, [1.0, 0.0], 2, "x"), (5, [1.0, 0.0], None, "x"), (6, None, 1, "x"),
            (7, [0.0, 0.0], 1, "x"), (8, [1.0, None], 1, "x"), (9, [nan, 1.0], 1, "x"), (10, [inf, 1.0], 1, "x"), (11, [], 1, "x"), (12, [1.0, 0.1], 1, "x"), (13, [1.0, 0.0, 0.0], 1, "x")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, g string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_dedup(d).collect()}
    assert {k: got[k] for k in (1, 2, 3, 12)} == {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 12: (3, 1, False)}
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 13))


def test_hash_of_kept_text(spark):
    d = docs(spark, [(1, "é\nx", "en", "a", 1)])
    got = line_dedup.line_dedup(d).select(F.sha2("text", 256).alias("h")).first().h
    assert got == hashlib.sha256("é\nx".encode()).hexdigest()


def test_words_are_the_contracts(spark):
    text = "A\x0bb\x1cc d\u0085e"
    assert quality.quality_rules(docs(spark, [(1, text, "en", "a", 1)])).first().n_words == len(re.findall(r"[^\x20\x09-\x0D]+", text))
    assert license_scan.words_of("a-b_Ç d") == ["a".encode(), "b".encode(), "Ç".encode(), b"d"]
