"""Fixtures and brute-force versions for the corpus operators."""

import re
import zlib

WS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that carry names the operators use themselves.
EXTRA = ("_row", "_kept", "key", "pos", "size", "n", "row", "h1", "words", "_words", "score", "kept", "class_id", "length")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """A documents table from (doc_id, text[, lang[, source]]) rows, with clashing extra columns on request."""
    full = [(r + (None, None))[:4] if len(r) < 4 else r for r in rows]
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for c in EXTRA:
            df = df.withColumn(c, F.lit("x"))
    return df


def words(text):
    return WS.findall((text or "").translate(LOW))


def held(doc_id, n, r):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n == r


ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, "a"), (4, "one", "en", None), (5, "one", "en", "b"),
    (6, "one two three four five six seven", "en", "b"), (6, "one two three four five six seven", "en", "b"),
    (7, "x " * 20_000, "fr", "c"), (None, "nameless words stand here today", "en", "c"), (8, "Ünïcödé Über straße\n\nzwei  drei", "de", "c"),
    (9, "123 456 !!!", "en", "a"), (10, "line that is long enough to count\nb\nline that is long enough to count", "en", "a"),
    (11, "Line that is long ENOUGH to count \nrest", "en", "a"), (12, " line that is long enough to count", "en", "a"),
]
