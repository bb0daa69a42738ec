"""The corpus pipeline: stages that each apply one operator of reelquery.llm to what the stage before kept."""

from pyspark.sql import functions as F

from reelquery.llm import line_dedup, mixing, ngram_join, packing, toxicity
from reelquery.llm.common import Scratch, table


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity operator rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark, docs, sf_dir):
    """Lines found in three documents or more stay in one; n_chars follows the text."""
    out = line_dedup.line_dedup(docs, carry=True)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def mix_sources(spark, docs, sf_dir):
    """Each document once or more, as often as its source's weight asks for; packing gives the rows their places."""
    return mixing.realise(docs, ordered=False)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents, placed in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_jaccard", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]
#: Scoring, tokenizing and packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs, name)
    return docs
