"""Line dedup: range-partitioned line hashes, first occurrences streamed, keep bitmaps returned.

Every line of every text becomes (two 64-bit hashes of its key, document,
position).  The rows are range-partitioned by (hash, document), so one very
common line is spread over many tasks, and sorted within them by position.
The stream over each sorted range marks the first occurrence of a key in a
document; the marks alone are counted per key (partial sums before the
shuffle).  The result is a sparse bitmap of the dropped positions per text,
never text: a caller applies it to the text it already has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CHARS, ascii_lower, boxed, stored, table

#: Positions per bitmap word (a long without its sign).
WORD_BITS = 62


def _lines(c):
    return F.split(F.coalesce(c, F.lit("")), "\n")


def drop_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_key, words): which lines of a text go.

    A line's key is the line stripped of white space with A-Z lower-cased.  Keys
    of at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines except those in the largest doc_id that holds them.
    ``words`` is an array of (word, bits): bit b of word w set means that line
    ``w * WORD_BITS + b`` goes; words without a set bit are left out, texts without
    a dropped line have no row.

    A null text is one empty line.  Rows that share a doc_id are one document
    (its rows differ by ``text_key``, a hash of the text); null doc_ids are one
    document, smaller than all others.  Only doc_id and text are read.
    """
    key = ascii_lower(F.btrim("line", F.lit(WS_CHARS)))
    lines = (docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
             .withColumn("key", key).filter(F.length("key") >= min_chars)
             .select("doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")))
    lines = stored(lines, "lines")  # the range sampling and three readers share it
    ranged = lines.repartitionByRange("h1", "h2", "doc_id")
    stream = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos", "text_key")
    firsts = ranged.withColumn("nth", F.row_number().over(stream)).filter("nth = 1")
    repeated = (firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
                .filter(F.col("n_docs") >= min_docs).drop("n_docs"))
    repeated = stored(repeated, "repeated", light=True)  # a plain read, so that the join may split a common line's partition
    gone = (lines.join(repeated, ["h1", "h2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    bits = (gone.groupBy("doc_id", "text_key", F.expr(f"CAST(pos DIV {WORD_BITS} AS INT)").alias("word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, CAST(pos % {WORD_BITS} AS INT)))").alias("bits")))
    return bits.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(_row, doc_id, n_lines, n_dropped, kept): every row of ``docs`` as a struct, and the text of its kept lines.

    See :func:`drop_bitmaps` for nulls, empty texts and repeated rows.  Extra
    columns travel inside the struct, whatever their names.
    """
    words = drop_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), F.col("words").alias("_words"))
    joined = boxed(docs, "doc_id", "text").withColumn("_tk", F.xxhash64("text")).join(
        words, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_tk") == F.col("_t")), "left")
    # The sparse words as a dense array, so that a line finds its bit by index: each word behind the empty ones before it.
    dense = ("CASE WHEN _words IS NULL THEN NULL ELSE flatten(transform(_words, (w, i) -> "
             "concat(array_repeat(0L, w.word - IF(i = 0, 0, _words[i - 1].word + 1)), array(w.bits)))) END")
    kept = (f"CASE WHEN _dense IS NULL THEN coalesce(text, '') ELSE array_join(filter(_lines, (l, i) -> "
            f"i DIV {WORD_BITS} >= size(_dense) OR "
            f"(shiftright(_dense[CAST(i DIV {WORD_BITS} AS INT)], CAST(i % {WORD_BITS} AS INT)) & 1L) = 0L), '\\n') END")
    return (joined.withColumn("_lines", _lines(F.col("text")))
            .withColumn("_dense", F.expr(dense))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dropped", F.expr("CASE WHEN _words IS NULL THEN 0L ELSE "
                                            "aggregate(_words, 0L, (a, w) -> a + bit_count(w.bits)) END"))
            .withColumn("kept", F.expr(kept))
            .select("_row", "doc_id", "n_lines", "n_dropped", "kept"))


def op4_line_dedup(spark, sf_dir) -> DataFrame:
    """Line dedup of all documents: counts and the digest of what stays."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, u.pos AS pos, u.line AS line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents) u
), r AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT l.doc_id, l.pos, l.line, (r.k IS NOT NULL AND l.doc_id <> r.keeper) AS gone FROM l LEFT JOIN r ON l.k = r.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
