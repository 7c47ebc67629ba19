"""Resampling by importance: documents drawn by how much their hashed n-grams look like a target's.

The tokenizers library cuts lower-cased texts into words with their offsets (an
untrained pattern split).  Every run of one to ``GRAMS`` neighbouring offset pairs is a
feature; its CRC picks a bucket.  The histograms of the corpus and of the target
give each bucket a gain, a document's weight is the mean gain of its
features, and a Gumbel draw per document turns weights into a sample without
replacement.  Each text is cut once; its buckets are kept as a table of two bytes a feature.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, global_index, stored, table
from .fim import draws

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
GRAMS = 2
#: Documents of fewer words are never drawn; so many of 100 of the others are.
LEAST_WORDS, PERCENT = 20, 25
SEED = 7
#: Code points that go to the library at once; a cut falls between words.
PIECE = 1 << 16

_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_ASCII_LOWER = str.maketrans(UPPER, LOWER)


def splitter():
    """texts -> their words' (start, end) offsets, by an untrained pattern split."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True).pre_tokenize_str


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` code points that no word crosses."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def buckets_of(text: str | None, split, buckets: int = BUCKETS, grams: int = GRAMS) -> tuple[np.ndarray, int]:
    """(the bucket of every feature, number of words) of a text; null has none."""
    if not text:
        return np.empty(0, np.uint32), 0
    words = [w.encode() for piece in pieces(text.translate(_ASCII_LOWER)) for w in _words(piece, split)]
    crcs = [zlib.crc32(w) for w in words]
    found = [crcs]
    spaced = [b" " + w for w in words]
    for n in range(1, grams):  # the CRC of a run goes on from that of the run without its last word
        crcs = list(map(zlib.crc32, spaced[n:], crcs))
        found.append(crcs)
    return np.concatenate([np.array(f, np.uint32) for f in found]) % np.uint32(buckets), len(words)


def _words(piece: str, split) -> list[str]:
    """The words of a piece, read through their offsets."""
    return [piece[a:b] for _, (a, b) in split(piece)]


def featured(docs: DataFrame, buckets: int = BUCKETS, grams: int = GRAMS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (of them the columns ``keep``) as ``_row`` with n_features, n_words and the buckets of their features.

    The buckets are packed as uint16, beyond 65,536 buckets as uint32.
    """
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    @F.pandas_udf("n_features long, n_words long, buckets binary")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        split = splitter()
        for texts in batches:
            rows = []
            for text in texts.tolist():
                b, n = buckets_of(text, split, buckets, grams)
                rows.append((len(b), n, b.astype(kind).tobytes()))
            yield pd.DataFrame(rows, columns=["n_features", "n_words", "buckets"])

    row = F.struct(*[docs[c] for c in docs.columns if keep is None or c in keep])
    return docs.select(row.alias("_row"), cut(docs["text"]).alias("_f")).select("_row", "_f.*")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: a task sends one row a bucket at most."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["buckets"]), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"b": at, "n": total[at]})

    out = np.zeros(buckets, np.int64)
    # Bounded: one row a bucket.
    for b, n in features.select("buckets").mapInPandas(count, "b int, n long").groupBy("b").agg(F.sum("n")).collect():
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths of a nat, add-one smoothed, rounded down."""
    s, t, k = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + k) / ((a + 1) * (t + k)))) for a, b in zip(corpus.tolist(), target.tolist())],
                    np.int64)


def gumbel(h: Column) -> Column:
    """A standard Gumbel draw in thousandths from a 32-bit number, rounded down."""
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             grams: int = GRAMS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (of them the columns ``keep``, doc_id among them; all by default) as ``_row`` with n_features, weight, score, rank.

    rank is null for what was not drawn.  Drawn are the ``percent`` highest scores of the documents of ``least_words`` words or
    more, ties by smaller doc_id (null ids last); rows equal in both are ranked in any order.  A
    null or empty text has no features and weight 0.  The draw of a row depends on
    ``seed`` and doc_id alone, so rows of one doc_id share theirs.  A very long
    text is cut in pieces between words and counted whole.  An empty target leaves the
    corpus alone to decide; an empty table gives an empty one.  Other columns, whatever their
    names, stay in ``_row`` and are written three times on the way, so leave long ones out by
    ``keep`` where the ids will do; ``target`` needs a text column.
    """
    features = stored(featured(docs, buckets, grams, keep), "features")
    gain = gains(histogram(features, buckets), histogram(featured(target.select("text"), buckets, grams), buckets))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    @F.pandas_udf("long")
    def weigh(packed: pd.Series) -> pd.Series:
        found = (np.frombuffer(b, kind) for b in packed)
        return pd.Series([int(gain[b].sum()) // len(b) if len(b) else 0 for b in found], dtype="int64")

    doc_id = F.col("_row.doc_id")
    scored = (features.withColumn("weight", weigh("buckets"))
              .select("_row", "n_features", "n_words", "weight", (F.col("weight") + gumbel(draws(doc_id, seed, 1)[0])).alias("score")))
    scored = stored(scored, "scored")
    enough = F.col("n_words") >= least_words
    some = scored.filter(enough).withColumn("_at", F.monotonically_increasing_id())  # parts equal rows among partitions
    placed, n = global_index(some, [F.col("score").desc(), doc_id.asc_nulls_last(), F.col("_at")], "_place", "ranked")
    drawn = percent * n // 100
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    columns = ["_row", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark, sf_dir) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's distribution."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select(F.col("_row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


# The CRC of a feature goes over its bytes with the table of the polynomial 0xEDB88320.
OP13_SQL = r"""
WITH RECURSIVE
steps(b, k, v) AS (SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) r(i)
                   UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS tab FROM steps WHERE k = 8),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
texts AS (SELECT 'd' AS side, row, text FROM d UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
w AS (SELECT side, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS (SELECT side, row, unnest(words) AS feature FROM w
      UNION ALL SELECT side, row, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM w),
crc AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(feature)) + 1),
                            lambda i: ('0x' || substr(hex(feature), 2 * i - 1, 2))::BIGINT)),
                            lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT feature FROM f), crc_table),
hist AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f JOIN crc USING (feature) GROUP BY bucket),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM hist),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
         FROM hist, total),
per_doc AS (SELECT row, count(*) AS n_features, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight
            FROM f JOIN crc USING (feature) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (SELECT d.row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) >= 20 AS enough,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM d JOIN w ON w.side = 'd' AND w.row = d.row LEFT JOIN per_doc ON per_doc.row = d.row),
placed AS (SELECT *, CASE WHEN enough THEN row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id NULLS LAST) END AS place,
                  count(*) FILTER (enough) OVER () AS n FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank FROM placed
"""
