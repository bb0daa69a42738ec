"""Operator 7: quality rules as one Spark projection (DataFrame operations only).

The threshold table ``RULES`` is compiled into one boolean expression over counts that are columns of
the same row: no shuffle, no user function, no second pass.

Null or empty texts have no words and fail the base rule; so do texts of white space. Repeated ids are
independent rows, null ids stay null, very long texts cost n log n in their words. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "that", "is", "was", "for", "it", "with", "on", "be", "a", "an",
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "qui", "pour", "est", "au",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "auf", "für", "nicht",
    "el", "los", "las", "y", "por", "con", "una", "su", "se", "del", "al",
]

#: (measure, "min" or "max", limit). A document is kept when every measure is within its limit.
RULES = [
    ("n_words", "min", 50.0),
    ("n_words", "max", 1e9),
    ("mean_word_chars", "min", 2.0),
    ("mean_word_chars", "max", 20.0),
    ("symbol_ratio", "max", 0.25),
    ("dup_line_ratio", "max", 0.6),
    ("repeat_word_ratio", "max", 0.5),
    ("stop_words", "min", 2.0),
]


def measures(text: Column) -> list[dict[str, Column]]:
    """Columns to add, step by step; each step may name those before it."""
    c, at = F.col, F.get
    window = lambda i: F.xxhash64(at(c("_w"), i), at(c("_w"), i + 1), at(c("_w"), i + 2))
    hash_at = lambda i: at(c("_s"), i)["h"]
    same = lambda i, j: F.coalesce(hash_at(i) == hash_at(j), F.lit(False))
    n = F.size("_w")
    return [
        {"_t": F.coalesce(text, F.lit(""))},
        {"_w": F.filter(F.split(c("_t"), r"[\x20\x09-\x0D]+"), lambda w: w != ""), "_l": F.filter(F.split(c("_t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))},
        {"_g": F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))},
        # only texts that repeat a window sort theirs
        {"_s": F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(F.transform(c("_g"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))},
        {"_p": F.when(c("_s").isNotNull(), F.transform(F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: same(i, i + 1) | ((i > 0) & same(i, F.greatest(i - 1, F.lit(0))))), lambda i: at(c("_s"), i)["i"]))},
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_repeat_words": F.when(c("_p").isNull(), 0).otherwise(F.size(F.array_distinct(F.concat(c("_p"), F.transform("_p", lambda i: i + 1), F.transform("_p", lambda i: i + 2))))).cast("long"),
            "stop_words": F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
            "n_lines": F.size("_l").cast("long"),
        },
        {
            "base_failed": (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words")),
            "mean_word_chars": c("word_chars") / F.greatest(c("n_words"), F.lit(1)),
            "symbol_ratio": c("n_symbols") / F.greatest(c("n_words"), F.lit(1)),
            "dup_line_ratio": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
            "repeat_word_ratio": c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
        },
    ]


def verdict(rules=RULES) -> Column:
    ok = F.lit(True)
    for name, side, limit in rules:
        ok = ok & (F.col(name) >= limit if side == "min" else F.col(name) <= limit)
    return ok


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row a document: the id, the counts, base_failed and kept."""
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    for step in measures(F.col("_text")):
        d = d.withColumns(step)
    return d.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_words", "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))
