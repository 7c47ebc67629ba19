"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram's vector binds
(multiplies) its letters' vectors, each permuted once per place from the end;
a document's vector bundles (adds) the vectors of all its n-grams; a language's
prototype bundles its training documents.  The prediction is the prototype with
the greatest cosine.  A bundle over documents is the sum of count times n-gram
vector, so only the n-grams present in a batch are ever bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, crc_mod, stored, table, unboxed

DIM = 1024
ORDER = 3
#: Letter symbols: 0 is the gap between words, 1 to 26 are a to z, the rest share the other letters.
SYMBOLS = 64
SEED = 20240
#: Documents, and about how many of their code points, that are bundled in one go; n-grams per matrix product.
BATCH, CHARS, GRAMS = 256, 1 << 21, 4096
UNKNOWN = "und"
#: Standard deviations that the floors of the scores lie below their mean, labelled rows a length needs.
SPREAD, FLOOR_LEAST = 5.0, 100


def letter_vectors(dim: int = DIM) -> np.ndarray:
    """The random +1/-1 vector of each symbol."""
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), size=(SYMBOLS, dim))


def ngram_vectors(grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bound vectors of n-gram codes (base SYMBOLS, first letter most significant)."""
    out = np.ones((len(grams), letters.shape[1]), np.int8)
    for place in range(ORDER):  # place 0 is the last letter: not permuted
        out *= np.roll(letters, place, axis=1)[grams % SYMBOLS]
        grams = grams // SYMBOLS
    return out


def _process_store() -> dict:
    return np.__dict__.setdefault("_kept_symbols", {})


def _symbols() -> np.ndarray:
    """Symbol of each code point after lower-casing: 0 where it is no letter."""
    kept = _process_store()
    if "t" not in kept:
        t = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                t[c] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
        kept["t"] = t
    return kept["t"]


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram codes, their document's index, whether each document has a letter).

    Runs of other characters count as one gap, with a gap at both ends.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = _symbols()[points]
    doc = np.repeat(np.arange(len(texts)), lengths)
    # One gap before and after each document keeps its n-grams to itself.
    ends = np.cumsum(lengths)
    edges = np.stack([ends - lengths, ends], axis=1).ravel()
    sym = np.insert(sym, edges, 0)
    doc = np.insert(doc, edges, np.repeat(np.arange(len(texts)), 2))
    has = np.zeros(len(texts), bool)
    has[doc[sym > 0]] = True
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] > 0) | (sym[:-1] > 0) | (doc[1:] != doc[:-1])
    sym, doc = sym[keep].astype(np.int64), doc[keep]
    n = len(sym) - ORDER + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), has
    code = np.zeros(n, np.int64)
    for i in range(ORDER):
        code = code * SYMBOLS + sym[i:i + n]
    same = doc[:n] == doc[ORDER - 1:]
    return code[same], doc[:n][same], has


def _bundle(codes: np.ndarray, group: np.ndarray, n_groups: int, letters: np.ndarray) -> np.ndarray:
    """Sum of the n-gram vectors of each group (n_groups x dim), for ``GRAMS`` of the n-grams present at a time."""
    present = np.zeros(SYMBOLS ** ORDER, bool)
    present[codes] = True
    grams = np.flatnonzero(present)
    place = np.zeros(SYMBOLS ** ORDER, np.int64)
    place[grams] = np.arange(len(grams))
    at = place[codes]
    out = np.zeros((n_groups, letters.shape[1]), np.float32)
    for first in range(0, len(grams), GRAMS):
        some = grams[first:first + GRAMS]
        here = slice(None) if len(grams) <= GRAMS else (at >= first) & (at < first + GRAMS)
        counts = np.bincount(group[here] * len(some) + at[here] - first, minlength=n_groups * len(some))
        out += counts.reshape(n_groups, len(some)).astype(np.float32) @ ngram_vectors(some, letters).astype(np.float32)
    return out


def _parts(texts: list[str]) -> Iterator[slice]:
    """Runs of at most ``BATCH`` texts and about ``CHARS`` code points; a longer text is a run of its own."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= BATCH or chars + len(t) > CHARS):
            yield slice(start, i)
            start, chars = i, 0
        chars += len(t)
    if len(texts) > start:
        yield slice(start, len(texts))


def train(labelled: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) from (text, lang), over all rows with both.

    Each task bundles what it reads; a language gives one row of ``dim`` sums per
    task, added up by (language, dimension).  What reaches the driver is one
    vector per language.
    """
    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, sums = letter_vectors(dim), {}
        for batch in batches:
            texts, own = batch["text"].tolist(), batch["lang"].to_numpy().astype(str)
            for at in _parts(texts):
                langs, group = np.unique(own[at], return_inverse=True)
                codes, doc, _ = gram_codes(texts[at])
                for name, v in zip(langs, _bundle(codes, group[doc], len(langs), letters).astype(np.float64)):
                    sums[name] = sums.get(name, 0) + v
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": list(sums.values())})

    parts = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInPandas(
        bundle, "lang string, v array<double>")
    rows = (parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect())
    if not rows:
        return [], np.zeros((0, dim), np.float32)
    protos = np.array([[p["x"] for p in r["v"]] for r in rows])
    norms = np.linalg.norm(protos, axis=1, keepdims=True)
    return [r["lang"] for r in rows], (protos / np.where(norms > 0, norms, 1)).astype(np.float32)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """(_row, doc_id, lang_pred, score): every row of ``docs`` as a struct, and what its text says.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learnt.  Ties go to the language that is first by name.  The score is the cosine, at
    least 0.  A very long text is bundled whole, a part of its n-grams at a time.
    """
    dim = prototypes.shape[1]

    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_vectors(dim)
        for batch in texts:
            names, scores = [], []
            values = ["" if t is None else t for t in batch.tolist()]
            for at in _parts(values):
                part = values[at]
                codes, doc, has = gram_codes(part)
                v = _bundle(codes, doc, len(part), letters)
                norm = np.linalg.norm(v, axis=1)
                if languages:
                    cos = (v @ prototypes.T) / np.where(norm > 0, norm, 1)[:, None]
                    best = cos.argmax(axis=1)
                    top = np.clip(cos[np.arange(len(part)), best], 0, 1)
                    names += [languages[b] if h else UNKNOWN for b, h in zip(best, has)]
                    scores += np.where(has, top, 0.0).astype(float).tolist()
                else:
                    names += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
            yield pd.DataFrame({"lang": names, "score": scores})

    udf = F.pandas_udf(judge, "lang string, score double")
    return (boxed(docs, "doc_id", "text").withColumn("_judged", udf(F.col("text")))
            .select("_row", "doc_id", F.col("_judged.lang").alias("lang_pred"), F.col("_judged.score").alias("score")))


def length_class(text: str = "text") -> F.Column:
    """The power of two that the number of a text's letters reaches."""
    return F.floor(F.log2(F.length(F.regexp_replace(text, r"[^\p{L}]", "")) + 1)).cast("int")


def score_floors(labelled: DataFrame, spread: float = SPREAD, least: int = FLOOR_LEAST) -> dict[int, float]:
    """Per length class the cosine below which a text is like none of the labelled ones, from (score, c) of them all.

    It lies ``spread`` standard deviations below the mean of the labelled texts of that length; a class of
    fewer than ``least`` has none.
    """
    found = labelled.groupBy("c").agg(F.count(F.lit(1)), F.avg("score"), F.stddev_pop("score")).collect()  # a row a power of two
    return {c: mean - spread * sd for c, n, mean, sd in found if c is not None and n >= least}


def accepted(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """The rows of ``docs`` (columns and order of columns kept) that read as one of the learnt languages.

    Rejected are texts without a letter (null and empty ones too), and texts whose cosine lies
    below the floor of their length: endless repetition, codes, foreign scripts.  Where
    nothing could be learnt every text with a letter stays.  Equal rows share their fate.
    """
    def labelled(doc_id: F.Column, text: F.Column, lang: F.Column) -> F.Column:
        return (crc_mod(doc_id, folds) != held_out) & text.isNotNull() & lang.isNotNull()

    languages, prototypes = train(docs.filter(labelled(F.col("doc_id"), F.col("text"), F.col("lang"))).select("text", "lang"))
    if not languages:
        return docs.filter(F.coalesce(length_class(), F.lit(0)) > 0)
    # Every text is judged once: the floors are learnt from the labelled scores, then all are held to them.
    judged = stored(predict(docs, languages, prototypes).withColumn("c", length_class("_row.text")), "judged")
    row = F.col("_row")
    floors = score_floors(judged.filter(labelled(row.getField("doc_id"), row.getField("text"), row.getField("lang"))).select("score", "c"))
    kept = judged.filter(F.col("lang_pred") != UNKNOWN)
    if floors:
        floor = F.create_map(*[F.lit(x) for c, low in floors.items() for x in (c, low)])
        kept = kept.filter(F.col("score") >= F.coalesce(floor[F.col("c")], F.lit(0.0)))
    return unboxed(kept, docs.columns)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """(_row, doc_id, held_out, lang_pred, score): one row per row of ``docs``, its own columns in the struct.

    Learns from the rows with a text and a lang whose crc32(doc_id) modulo
    ``folds`` is not ``held_out``; a null doc_id counts as the empty text.
    """
    fold = crc_mod(F.col("doc_id"), folds)
    languages, prototypes = train(docs.filter(fold != held_out).select("text", "lang"))
    return predict(docs, languages, prototypes).withColumn("held_out", fold == held_out)


def op5_language_id(spark, sf_dir) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
