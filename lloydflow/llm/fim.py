"""Fill-in-middle documents: two cuts per text, found on a wavelet matrix over character classes.

Every code point has a class: line end, white space, first character of a
word, any other.  A wavelet matrix over the classes of many texts answers "how many of
class c stand before position i" in two steps.  Ranks add up to boundary counts (units
of lines, words or characters before a position), and bisection on those counts
finds where a unit ends.  Only three numbers a text come back from Python; the
texts are cut and put together by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, table, unboxed

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts, how many are rearranged, and how many of those put the suffix first.
RATE, SUFFIX_FIRST = 100, 50
SEED = 7
UNITS = ("line", "word", "char")

LINE_END, SPACE, WORD_START, OTHER = range(4)
#: Code points that share one matrix; a longer text has one of its own.
CHUNK = 1 << 22


class Bits:
    """A bit vector with ranks in constant time."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[:len(packed)] = packed
        self.words = padded.view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks over a sequence of symbols 0 to 2 ** levels - 1, highest bit first."""

    def __init__(self, symbols: np.ndarray, levels: int = 2):
        self.n, self.levels = len(symbols), []
        for bit in range(levels - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(symbols) - np.count_nonzero(ones))))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))  # zeros first, order kept

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each position."""
        low, high = np.zeros(len(i), np.int64), np.asarray(i, np.int64)
        for bit, bits, zeros in self.levels:
            a, b = bits.rank1(low), bits.rank1(high)
            low, high = (zeros + a, zeros + b) if symbol >> bit & 1 else (low - a, high - b)
        return high - low


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every code point; ``starts`` are the places where a text begins."""
    line = points == 10
    white = line | (points == 32) | ((points >= 9) & (points <= 13))
    first = np.empty(len(points), bool)
    first[1:] = white[:-1]
    first[starts[starts < len(points)]] = True
    out = np.full(len(points), OTHER, np.uint8)
    out[first & ~white] = WORD_START
    out[white] = SPACE
    out[line] = LINE_END
    return out


class Boundaries:
    """Units of texts that lie in one matrix from ``begin`` to ``end``."""

    def __init__(self, matrix: WaveletMatrix, begin: np.ndarray, end: np.ndarray, unit: str):
        self.matrix, self.begin, self.end, self.unit = matrix, begin, end, unit
        self.symbol = {"line": LINE_END, "word": WORD_START, "char": None}[unit]
        if self.symbol is not None:
            self.first = matrix.rank(self.symbol, begin)
            self.marks = matrix.rank(self.symbol, end) - self.first
        if unit == "line":  # a last line without its end is a unit too
            last = np.maximum(end - 1, begin)
            open_end = (matrix.rank(LINE_END, end) == matrix.rank(LINE_END, last)) & (end > begin)
            self.n = self.marks + open_end
        else:  # white space before the first word belongs to it
            self.n = end - begin if unit == "char" else np.where(end > begin, np.maximum(self.marks, 1), 0)

    def done(self, i: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Marks of each chosen text before position ``i``."""
        return self.matrix.rank(self.symbol, i) - self.first[which]

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Where the first ``units`` units of each text end, counted from its begin."""
        if self.unit == "char":
            return units
        out = np.where(units >= self.n, self.end, self.begin)
        # The end of ``units`` lines lies behind that many line ends; of words, before the next word's start.
        which = np.flatnonzero((units > 0) & (units < self.n))
        goal = units[which] + (self.unit == "word")
        low, high = self.begin[which], self.end[which]  # low: fewer marks than the goal; high: at least as many
        while len(which) and (open_ := high - low > 1).any():
            middle = (low + high) >> 1
            reached = self.done(middle, which) >= goal
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle, low)
        out[which] = high - (self.unit == "word")
        return out - self.begin


def cuts(texts: list[str | None], h1: np.ndarray, h2: np.ndarray, unit: str = "line") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, end of the prefix, end of the middle) of every text, in code points; null texts are empty."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")
    out = [np.zeros(len(texts), np.int64) for _ in range(3)]
    lengths = np.array([len(t) if isinstance(t, str) else 0 for t in texts], np.int64)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(lengths[at:]), CHUNK, "right")) + at)
        joined = "".join(t for t in texts[at:stop] if isinstance(t, str))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        end = np.cumsum(lengths[at:stop])
        begin = end - lengths[at:stop]
        units = Boundaries(WaveletMatrix(classes(points, begin)), begin, end, unit)
        a, b = h1[at:stop] % (units.n + 1), h2[at:stop] % (units.n + 1)
        for o, v in zip(out, (units.n, units.cut(np.minimum(a, b)), units.cut(np.maximum(a, b)))):
            o[at:stop] = v
        at = stop
    return tuple(out)


def draws(doc_id: Column, seed: int = SEED, n: int = 4) -> list[Column]:
    """The first ``n`` 8-digit groups of the hex sha256 of ``seed:doc_id`` as numbers; a null id is empty text."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def fill_in_middle(docs: DataFrame, unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED,
                   marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` as ``_row`` with n (units), form, prefix_chars, middle_chars, output.

    The form is ``plain`` (the text as it is) if the text is empty, contains a mark
    or is not drawn by ``rate``; else ``spm`` or ``psm``.  A null text is empty.  The draws
    depend on ``seed`` and doc_id alone: rows of one doc_id (null included) have the same
    draws, and equal rows the same result.  A very long text is cut whole, at
    about six times its size in memory.  An empty table gives an empty one.  Other
    columns, whatever their names, stay in ``_row``.
    """
    @F.pandas_udf("n long, a long, b long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, h1, h2 in batches:
            n, a, b = cuts(text.tolist(), h1.to_numpy(np.int64), h2.to_numpy(np.int64), unit)
            yield pd.DataFrame({"n": n, "a": a, "b": b})

    p, s, m = (F.lit(x) for x in marks)
    text = F.coalesce(F.col("text"), F.lit(""))
    h = draws(F.col("doc_id"), seed)
    found = (boxed(docs, "doc_id", "text")
             .select("_row", text.alias("_text"), *[c.alias(f"_h{i}") for i, c in enumerate(h)])
             .withColumn("_cut", cut("_text", "_h0", "_h1")))
    plain = (F.col("_text") == "") | (F.col("_h2") % 100 >= rate)
    for mark in marks:
        plain = plain | F.contains(F.col("_text"), F.lit(mark))
    form = F.when(plain, "plain").when(F.col("_h3") % 100 < suffix_first, "spm").otherwise("psm")
    a, b = F.col("_cut.a"), F.col("_cut.b")
    parts = found.select(
        "_row", "_text", F.col("_cut.n").alias("n"), form.alias("form"), a.alias("_a"), (b - a).alias("_m"),
        F.substring("_text", F.lit(1), a.cast("int")).alias("_prefix"),
        F.substring("_text", (a + 1).cast("int"), (b - a).cast("int")).alias("_middle"),
        F.substring("_text", (b + 1).cast("int"), F.lit(2 ** 31 - 1)).alias("_suffix"))
    output = (F.when(F.col("form") == "plain", F.col("_text"))
              .when(F.col("form") == "psm", F.concat(p, "_prefix", s, "_suffix", m, "_middle"))
              .otherwise(F.concat(s, "_suffix", p, "_prefix", m, "_middle")))
    kept = F.col("form") != "plain"
    return parts.select("_row", "n", "form", F.when(kept, F.col("_a")).alias("prefix_chars"),
                        F.when(kept, F.col("_m")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)  # the text holds no mark: an empty piece, then three
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second))
            .otherwise(F.concat(second, middle, first)))


def transformed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with their output as text, all other columns as they were."""
    return unboxed(fill_in_middle(docs, **options), docs.columns, text=F.col("output"))


def op11_fill_in_middle(spark, sf_dir) -> DataFrame:
    """Every document rearranged by lines, and its text rebuilt."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(F.col("_row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


OP11_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units,
             ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
             coalesce(array_to_string(units[a + 1:b], ''), '') AS middle, coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
