"""Language ID learns all pieces, words and languages."""

import numpy as np
import pytest

from reelquery.llm import language_id


def test_long_pieces_count():
    import sentencepiece

    path = language_id.default_vocabulary()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {sp.id_to_piece(i).replace("▁", "") for i in range(sp.get_piece_size())}
    pieces = language_id.Pieces(path)
    assert set(pieces.texts) == {t for t in texts if t == t.lower() and t.isalpha()}
    prob = np.zeros((len(pieces.texts) + 1, 1))
    long = max(pieces.texts, key=len)
    prob[pieces.texts.index(long)] = 0.25
    assert language_id.log_scores([long], pieces, prob) == pytest.approx(np.log(0.25))


def test_rare_words_are_learned():
    letters = "abcdefghijklmnopqrst"
    common = [a + b + c + d for a in letters for b in letters for c in letters for d in letters[:8]]
    path = language_id.default_vocabulary()
    langs, prob = language_id.fit([(" ".join(common * 2) + " ж", "x")], path)
    p = prob[language_id.Pieces(path).texts.index("ж"), 0]
    assert len(common) > 60_000 and p > 10 * prob[:-1, 0].min()


def test_every_language_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12)) for _ in range(230)]
    rows = [(230 * n + k, f"l{k:03d}", " ".join([w] * 5)) for n in range(3) for k, w in enumerate(words)]
    d = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(d, sample=3000).collect()}
    learned = {g for i, g, _ in rows if language_id.fold(i) != language_id.HELD_OUT}
    assert len(learned) > 200 and [(i, g, got[i]) for i, g, _ in rows if g in learned and got[i] != g] == []
    monkeypatch.setattr(language_id, "MAX_LANGS", 204)
    with pytest.raises(ValueError, match="more than 204 languages"):
        language_id.language_id(d)


def test_words_are_letters():
    assert language_id.words_in("½ ② ² Ⅷ 12 _") == []
    assert language_id.words_in("m²n Ab½ ǅ ß漢 ªº") == ["m", "n", "ab", "ǆ", "ß漢", "ªº"]


def test_letterless_texts_are_und(spark):
    rows = [(k, "en", "the words of this language") for k in range(20)] + [(100, "en", "½ ② ²"), (101, None, "Ⅷ 7")]
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert (got[1], got[100], got[101]) == ("en", "und", "und")


def test_long_words_are_whole():
    """A word of any length gets the sum over all segmentations, in scoring and in learning."""
    pieces = language_id.Pieces(language_id.default_vocabulary())
    rng = np.random.default_rng(1)
    prob = np.concatenate([rng.random((len(pieces.texts), 2)) / 100, np.full((1, 2), language_id.UNKNOWN)])
    words = ["internationalisierungß漢", "aaaaaaaaa", "x"]
    for w, want in zip(words, language_id.log_scores(words, pieces, prob), strict=True):
        assert np.allclose(language_id.log_score(w, pieces, np.log(prob)), want)
    one = prob[:, :1]
    for w in words:
        counts = np.zeros(len(prob))
        language_id.long_counts(w, pieces, one[:, 0], counts, 2.0)
        assert np.allclose(counts, language_id.expected_counts([w], np.array([2.0]), pieces, one))
    long = "wort" * 500 + "ß漢" + "straße" * 300
    assert np.isfinite(language_id.log_score(long, pieces, np.log(prob))).all()


def test_a_text_of_one_very_long_word(spark):
    rows = [(k, g, t) for k in range(40) for g, t in [("xx", "abab abba baba"), ("yy", "cdcd dccd dcdc")]]
    rows = [(n, g, t) for n, (_, g, t) in enumerate(rows)] + [(1000, None, "ab" * 20_000), (1001, None, "cd" * 20_000), (1002, None, "ab" * 20_000 + " cd")]
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert (got[1000], got[1001], got[1002], got[0], got[1]) == ("xx", "yy", "xx", "xx", "yy")
