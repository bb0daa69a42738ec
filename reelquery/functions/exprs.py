"""Column expressions that several operators share. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The name spaces of RFC 4122.
DNS, OID = "6ba7b8109dad11d180b400c04fd430c8", "6ba7b8129dad11d180b400c04fd430c8"


def clean_text(text: Column) -> Column:
    """White space (Unicode) to single blanks, stripped, none before , . ; : ! ?"""
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), r"\s+([,.;:!?])", "$1")


def round_sec(x: Column) -> Column:
    return F.round(x, 3)


def frame_number(x: Column) -> Column:
    """Half to even, as frame numbers fall on exact halves."""
    return F.bround(x, 0).cast("long")


def quality(confidence: Column, ncr_below: float = 0.50, reliable_from: float = 0.70) -> Column:
    return F.when(confidence.isNull(), "REVIEW").when(confidence < ncr_below, "NCR").when(confidence >= reliable_from, "RELIABLE").otherwise("REVIEW")


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Sum from left to right in double precision."""
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(a), F.lit(0.0), lambda s, x: s + x * x))


def normalize(a: Column) -> Column:
    n = l2norm(a)
    return F.when(n > 0, F.transform(doubles(a), lambda x: x / n)).otherwise(doubles(a))


def cosine(a: Column, b: Column) -> Column:
    n = l2norm(a) * l2norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5 of a UTF-8 name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lpad(F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("long").bitwiseAND(63).bitwiseOR(128))), 2, "0")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def natural_key(path: Column) -> Column:
    """Sorts runs of digits as numbers, of any length, and the rest lower-cased: texts and numbers in turn, a text first.

    A number is its digits without leading zeros after how many they are, so that texts sort as numbers.
    """
    runs = F.regexp_extract_all(F.lower(path), F.lit(r"(\d+|\D+)"), F.lit(1))
    digits = lambda t: F.regexp_replace(t, "^0+", "")
    number = lambda t: F.concat(F.lpad(F.length(digits(t)).cast("string"), 10, "0"), digits(t))
    key = F.transform(runs, lambda t: F.when(t.rlike(r"^\d+$"), number(t)).otherwise(t))
    return F.when(path.rlike(r"^\d"), F.concat(F.array(F.lit("")), key)).otherwise(key)


def unused(taken: list[str], *wanted: str) -> list[str]:
    """Names like those wanted that aren't taken (case apart)."""
    have, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def segment_id(video: Column, number: Column) -> Column:
    return F.format_string("%s_seg%03d", video, number)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a time without zone, whatever the session's zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    return days * 86400.0 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts).cast("double")
