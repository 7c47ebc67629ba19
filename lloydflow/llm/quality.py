"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate.

Fixed rules drop short and repetitive texts.  Of the others, every line gets a few
discrete features (length, letters, symbols, case, repetition), Viterbi decoding finds
the best sequence of the two labels, and a document stays if enough of its words lie in
content lines.  The field is trained on a bounded sample of labelled documents: the
lines of good ones are content; of the lines of bad ones those are boilerplate that a
first model of single lines takes for it, so that mixed documents teach the transitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, table

BOILERPLATE, CONTENT = 0, 1
#: Labelled documents of each quality that train the field, and lines of each (a run that starts anywhere).
TRAIN_DOCS, TRAIN_LINES = 1000, 32
#: Share of a document's words in content lines from which it is kept.
LEAST_CONTENT = 0.5
#: Fixed rules: words a document needs, and percent of its words that may lie in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Training: steps of gradient ascent, their size, and the pull of all weights towards 0.
STEPS, RATE, PULL = 150, 0.1, 1e-3
#: Code points whose features are computed together; a longer text has an array of its own.
CHUNK = 1 << 21

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_ENDS = ".!?。！？…:;,\"')”»"
# Classes of code points.
WHITE, UPPER, LOWER, DIGIT, SYMBOL, END, OTHER = range(7)

# Bounds of the buckets of each feature: a value's bucket is the number of bounds it reaches.
WORDS = (1, 2, 4, 8, 16, 32, 64)
WORD_LENGTH = (2, 3, 4, 5, 6, 8, 12, 20)
SHARE = (1e-9, 0.02, 0.05, 0.1, 0.2, 0.35, 0.6)
FEATURES = (("words", WORDS), ("word_length", WORD_LENGTH), ("symbols", SHARE), ("upper", SHARE), ("digits", SHARE), ("ends", SHARE),
            ("other", SHARE), ("bare", SHARE), ("repeated", (1,)), ("last", (1, 2, 3)))
_OFFSETS = np.cumsum([0] + [len(b) + 1 for _, b in FEATURES])
N_FEATURES = int(_OFFSETS[-1])


def _class_table() -> np.ndarray:
    """The class of each code point of the basic plane; beyond it all are lower-case letters."""
    out = np.full(1 << 16, OTHER, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isupper():
            out[i] = UPPER
        elif c.isalpha() or 0x300 <= i < 0x370:  # combining marks belong to letters
            out[i] = LOWER
        elif c.isdigit():
            out[i] = DIGIT
    for chars, kind in ((_ENDS, END), (_SYMBOLS, SYMBOL), (" \t\n\x0b\x0c\r", WHITE)):
        out[[ord(c) for c in chars]] = kind
    return out


_TABLE: list[np.ndarray] = []


def _classes(points: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_class_table())
    return np.where(points < 1 << 16, _TABLE[0][np.minimum(points, (1 << 16) - 1)], np.uint8(LOWER))


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window that the text holds twice or more."""
    n = len(words)
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if n < 4 or len(ids) == n:
        return 0
    pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    _, which, count = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = count[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


class Lines:
    """Features of the lines of several texts; null texts are empty, and an empty text is one empty line."""

    def __init__(self, texts: list[str | None]):
        texts = [t if isinstance(t, str) else "" for t in texts]
        points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        kind = _classes(points)
        ends = np.flatnonzero(points == 10)
        begins = np.concatenate(([0], ends[:-1] + 1))
        white = kind == WHITE
        start = ~white
        start[1:] &= white[:-1]
        # A word without a letter or digit is bare.
        word_at = np.flatnonzero(start)
        solid = np.concatenate(([0], np.cumsum((kind == UPPER) | (kind == LOWER) | (kind == DIGIT))))
        closes = np.flatnonzero(~white & np.concatenate((white[1:], [True]))) + 1
        bare = np.zeros(len(points), bool)
        bare[word_at] = solid[closes] == solid[word_at]

        def per_line(flags: np.ndarray) -> np.ndarray:
            """How many code points of each line have the flag."""
            up_to = np.concatenate(([0], np.cumsum(flags)))
            return up_to[ends] - up_to[begins]

        self.words = per_line(start)
        self.chars = per_line(~white)
        self.symbols = per_line(kind == SYMBOL)
        upper, lower, digits, closing, other = (per_line(kind == k) for k in (UPPER, LOWER, DIGIT, END, OTHER))
        counts = np.array([t.count("\n") + 1 for t in texts], np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts)))  # each text's first line
        repeated = np.zeros(len(ends), bool)
        for i, t in enumerate(texts):
            if counts[i] > 1:
                seen: set[str] = set()
                for j, line in enumerate(t.split("\n"), int(self.first[i])):
                    if line in seen:
                        repeated[j] = True
                    seen.add(line)
        self.repeated = repeated & (self.words > 0)
        chars, letters = np.maximum(self.chars, 1), np.maximum(upper + lower, 1)
        last = np.maximum(ends - 1, 0)
        last_kind = np.where(self.chars > 0, kind[last], WHITE)
        values = {"words": self.words, "word_length": self.chars / np.maximum(self.words, 1), "symbols": self.symbols / chars,
                  "upper": upper / letters, "digits": digits / chars, "ends": closing / chars, "other": other / chars,
                  "bare": per_line(bare) / np.maximum(self.words, 1), "repeated": self.repeated,
                  "last": np.select([last_kind == END, last_kind == SYMBOL, last_kind == WHITE], [3, 2, 0], 1)}
        #: One active feature of each group per line.
        self.features = np.stack([np.searchsorted(bounds, values[name], "right") + o
                                  for (name, bounds), o in zip(FEATURES, _OFFSETS)], axis=1).astype(np.uint8)

    def per_text(self, of_lines: np.ndarray) -> np.ndarray:
        """The sum over the lines of each text."""
        up_to = np.concatenate(([0], np.cumsum(of_lines)))
        return up_to[self.first[1:]] - up_to[self.first[:-1]]


class Field:
    """A linear-chain conditional random field of two labels."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, begin: np.ndarray):
        self.emit, self.move, self.begin = emit, move, begin  # (N_FEATURES, 2), (2, 2), (2,)

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best label of every line; ``first`` holds each text's first line and the number of lines.

        All texts step together, longest first, so that those still running stand in front.  On
        equal scores the label is content.
        """
        score = self.emit[features].sum(axis=1)
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = first[:-1][order], lengths[order]
        running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # texts longer than t
        came = np.zeros((len(score), 2), np.uint8)
        best = self.begin + score[starts]
        final = np.zeros(len(starts), np.uint8)
        for t in range(1, len(running)):
            m = running[t]
            at = starts[:m] + t
            through = best[:m, :, None] + self.move  # text, from, to
            came[at] = through[:, CONTENT] >= through[:, BOILERPLATE]
            best[:m] = through.max(axis=1) + score[at]
        final[:] = best[:, CONTENT] >= best[:, BOILERPLATE]
        labels = np.zeros(len(score), np.uint8)
        labels[starts + lengths - 1] = final
        for t in range(len(running) - 1, 0, -1):
            at = starts[:running[t]] + t
            labels[at - 1] = came[at, labels[at]]
        return labels


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def likelihood(field: Field, features: np.ndarray, labels: np.ndarray, mask: np.ndarray):
    """(log-likelihood, its gradient by emit, move and begin) of padded sequences (sequence, line[, group])."""
    n, length = labels.shape
    one = np.eye(2)
    score = field.emit[features].sum(axis=2) * mask[:, :, None]
    forward = np.empty((n, length, 2))
    forward[:, 0] = field.begin + score[:, 0]
    for t in range(1, length):
        step = _log_add(forward[:, t - 1, :, None] + field.move, 1) + score[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    backward = np.zeros((n, length, 2))
    for t in range(length - 2, -1, -1):
        step = _log_add(field.move + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
    total = _log_add(forward[:, -1], 1)
    chance = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    observed = one[labels] * mask[:, :, None]
    both = (forward[:, :-1, :, None] + field.move + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
    inner = mask[:, 1:, None, None]
    d_move = np.where(inner, one[labels[:, :-1]][:, :, :, None] * one[labels[:, 1:]][:, :, None, :]
                      - np.exp(np.where(inner, both, -np.inf)), 0).sum(axis=(0, 1))
    d_emit = np.zeros((N_FEATURES, 2))
    rest = (observed - chance)[mask]
    for group in range(features.shape[2]):
        for label in range(2):
            d_emit[:, label] += np.bincount(features[:, :, group][mask], rest[:, label], N_FEATURES)
    gold = ((score * observed).sum() + field.begin[labels[:, 0]].sum()
            + (field.move[labels[:, :-1], labels[:, 1:]] * mask[:, 1:]).sum())
    return gold - total.sum(), d_emit, d_move, (observed - chance)[:, 0].sum(axis=0)


def _ascend(gradients, shapes: list[tuple[int, ...]], steps: int = STEPS, rate: float = RATE) -> list[np.ndarray]:
    """Weights after ``steps`` of gradient ascent with per-weight step sizes (moving averages of the gradient and its square)."""
    w = [np.zeros(s) for s in shapes]
    mean, square = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for t in range(1, steps + 1):
        for i, g in enumerate(gradients(*w)):
            g = g - PULL * w[i]
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            w[i] = w[i] + rate * mean[i] / (1 - 0.9 ** t) / (np.sqrt(square[i] / (1 - 0.99 ** t)) + 1e-8)
    return w


def train(sequences: list[np.ndarray], good: list[bool]) -> Field | None:
    """The field learnt from the line features of documents and their quality; None unless both qualities are there."""
    if not any(good) or all(good):
        return None
    lengths = np.array([len(s) for s in sequences])
    features = np.zeros((len(sequences), lengths.max(), len(FEATURES)), np.uint8)
    for i, s in enumerate(sequences):
        features[i, :len(s)] = s
    mask = np.arange(lengths.max()) < lengths[:, None]
    labels = np.repeat(np.array(good, np.int64)[:, None], lengths.max(), axis=1)
    # Both qualities weigh alike in the model of single lines.
    flat, y = features[mask], labels[mask]
    weight = np.where(y == CONTENT, 0.5 / max(1, (y == CONTENT).sum()), 0.5 / max(1, (y == BOILERPLATE).sum()))

    def single(w):
        p = 1 / (1 + np.exp(-np.clip(w[flat].sum(axis=1), -50, 50)))
        rest = weight * (y - p)
        return [sum(np.bincount(flat[:, g], rest, N_FEATURES) for g in range(flat.shape[1]))]

    (alone,) = _ascend(single, [(N_FEATURES,)])
    taken = (alone[features].sum(axis=2) >= 0).astype(np.int64)
    labels = np.where(labels == CONTENT, CONTENT, taken)

    def chained(emit, move, begin):
        _, *d = likelihood(Field(emit, move, begin), features, labels, mask)
        return [g / len(sequences) for g in d]

    return Field(*_ascend(chained, [(N_FEATURES, 2), (2, 2), (2,)]))


def learn(docs: DataFrame, labels: DataFrame, docs_per_quality: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> Field | None:
    """The field of the documents whose quality ``labels`` gives (1 good, 0 bad; null or other values say nothing).

    Bounded: the ``docs_per_quality`` labelled ids of smallest hash of each quality, as
    many rows again of the documents that carry them, and ``lines`` lines of each.  Only
    their line features (a byte a group) come to the driver.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).filter("_id IS NOT NULL AND _quality IN (0, 1)")
    known = known.groupBy("_id").agg(F.min("_quality").alias("_quality"))
    order = F.xxhash64("_id")
    picked = [known.filter(F.col("_quality") == q).orderBy(order, "_id").limit(docs_per_quality) for q in (0, 1)]

    @F.pandas_udf("binary")
    def line_features(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        out = []
        for text, h in zip(texts, hashes):
            f = Lines([text]).features
            at = int(h) % max(1, len(f) - lines + 1)
            out.append(f[at:at + lines].tobytes())
        return pd.Series(out, dtype=object)

    rows = []
    for q, ids in enumerate(picked):
        # Broadcast: docs_per_quality ids.
        found = (docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
                 .select("_id", "text", F.xxhash64("_id", "text").alias("_h")))
        chosen = found.orderBy("_h", "_id").limit(docs_per_quality).select(line_features("text", F.pmod("_h", F.lit(1 << 31))).alias("f"), "_h")
        rows += [(r["_h"], bytes(r["f"]), q == 1) for r in chosen.collect()]
    rows.sort()
    return train([np.frombuffer(f, np.uint8).reshape(-1, len(FEATURES)) for _, f, _ in rows], [g for _, _, g in rows])


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "n_lines", "content_lines")


def measured(texts: list[str | None], field: Field | None) -> pd.DataFrame:
    """``COLUMNS`` of every text; without a field all lines are content."""
    out = []
    lengths = np.cumsum([0] + [len(t) + 1 if isinstance(t, str) else 1 for t in texts])
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(lengths, lengths[at] + CHUNK, "right")) - 1)
        lines = Lines(texts[at:stop])
        labels = field.viterbi(lines.features, lines.first) if field else np.ones(len(lines.words), np.uint8)
        repeats = [repeated_words(_WORD.findall(t)) if isinstance(t, str) else 0 for t in texts[at:stop]]
        out.append(np.stack([lines.per_text(lines.words), lines.per_text(lines.chars), lines.per_text(lines.symbols),
                             lines.per_text(lines.repeated), np.array(repeats, np.int64),
                             lines.per_text(lines.words * labels), np.diff(lines.first), lines.per_text(labels.astype(np.int64))], axis=1))
        at = stop
    return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, len(COLUMNS)), np.int64), columns=list(COLUMNS))


def judge(docs: DataFrame, labels: DataFrame, least_content: float = LEAST_CONTENT, least_words: int = LEAST_WORDS,
          most_repeated: int = MOST_REPEATED) -> DataFrame:
    """``docs`` as ``_row`` with ``COLUMNS``, base_failed, kept.

    kept is false if a fixed rule fails, else whether the share of words in content lines
    reaches ``least_content``.  A null or empty text has no words and fails.  A tie between two
    label sequences goes to content.  Equal rows have equal results; a very long text
    is decoded whole.  If ``labels`` hold no document of one quality nothing is learnt and the
    fixed rules alone decide; an empty table gives an empty one.  Other columns, whatever
    their names, stay in ``_row``.
    """
    field = learn(docs, labels)

    @F.pandas_udf(", ".join(f"{c} long" for c in COLUMNS))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield measured(texts.tolist(), field)

    found = boxed(docs, "text").select("_row", measure("text").alias("_m")).select("_row", "_m.*")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return (found.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("content_words") >= least_content * F.col("n_words"))))


def line_labels(docs: DataFrame, field: Field | None) -> DataFrame:
    """(_row, line_no, line, content): every line of every text with its label, for a look at the verdicts."""
    @F.pandas_udf("array<boolean>")
    def label(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            lines = Lines([text])
            marks = field.viterbi(lines.features, lines.first) if field else np.ones(len(lines.words))
            out.append([bool(m) for m in marks])
        return pd.Series(out, dtype=object)

    split = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    both = boxed(docs, "text").select("_row", F.arrays_zip(split.alias("line"), label("text").alias("content")).alias("_l"))
    return both.select("_row", F.posexplode("_l").alias("line_no", "_l")).select("_row", "line_no", "_l.line", "_l.content")


def op12_quality_rules(spark, sf_dir) -> DataFrame:
    """Every document's counts and verdict."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "content_words")
