"""Token counts use the vocabulary's runs of spaces."""

import random

from reelquery.llm import token_counts


def test_runs_of_spaces_are_pieces(spark):
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = token_counts.unigram_vocabulary(token_counts.default_vocabulary())
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    rng = random.Random(6)
    texts = ["", " ", "a", " a", "a ", "if x:\n        return  y", " " * 40, "▁▁▁a   b", *("".join(rng.choice("  ab\nc") for _ in range(60)) for _ in range(200))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(d).collect()}
    assert got == {k: len(t.encode(x, add_special_tokens=False).ids) if x else 0 for k, x in enumerate(texts)}
    assert got[6] < 10
