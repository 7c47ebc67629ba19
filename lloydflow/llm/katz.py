"""Katz back-off language model over bigrams, counted and evaluated block against table.

Texts become blocks of token codes, written once.  A block asks for the counts of
its distinct words, then of its distinct bigrams: the questions (keys with the
block's own training counts) are dealt to buckets by key, a bucket adds up what
all blocks tell it, which makes its part of the n-gram table, and answers
every block.  So each distinct n-gram of a block travels once.  With a word's count comes a
short id that stands for it in the bigrams.

Bigrams are bucketed by their history, so that a bucket can also sum what the
back-off weight of the history needs; histories that hold more than
``HOT_SHARE`` of all tokens are few by definition, and their bigrams are
spread over all buckets and their sums added up apart.

Discounts are Good-Turing with Katz's correction for counts up to ``K``; every bigram of the
training texts is listed, those seen once too.  For every history the probabilities of
all known words and of the unknown word sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, ascii_lower, crc_mod, stored, table

#: Counts that are discounted.
K = 5
#: Tokens in a block; questions in a bucket; share of all tokens that makes a history hot.
BLOCK_TOKENS, BUCKET_KEYS, HOT_SHARE = 1_500_000, 1_200_000, 1 / 400
#: Word hash of the end token, the least of all.
END = 0
#: Ids: words that training has not seen, the history of a first token (not a token), the end token, then all others.
UNSEEN, START_ID, END_ID = 0, 1, 2

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def planes(a: np.ndarray) -> bytes:
    """The array byte plane by byte plane, compressed: sorted keys and small numbers become short."""
    split = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(split.tobytes())


def unplanes(b: bytes, dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(b)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def discounts(of_counts: list[int], k: int = K) -> np.ndarray:
    """Factor for counts 0 to k from the numbers of n-grams that occur 1, 2, ... k + 1 times.

    Good-Turing with Katz's correction, so that nothing above k is discounted.  Where the raw numbers
    give no factor in (0, 1] for some count, numbers smoothed by a line through their
    logarithms are used; where there is no falling line either, all take half a count off.
    """
    def factors(n: np.ndarray) -> np.ndarray | None:
        rest = (k + 1) * n[k] / n[0]
        r = np.arange(1, k + 1)
        d = ((r + 1) * n[1:] / (r * n[:-1]) - rest) / (1 - rest) if rest != 1 else np.zeros(k)
        return np.append(1.0, d) if ((d > 0) & (d <= 1)).all() else None

    n = np.array(of_counts[:k + 1], np.float64)
    found = None
    if (n > 0).all():
        x = np.log(np.arange(1, k + 2))
        found = factors(n)
        if found is None:
            found = factors(np.exp(np.polyval(np.polyfit(x, np.log(n), 1), x)))
    return found if found is not None else np.array([1.0, *[(r - 0.5) / r for r in range(1, k + 1)]])


class Unigrams:
    """P(word) from its training count; exactly normalised with the unknown word."""

    def __init__(self, total: int, types: int, of_counts: list[int]):
        self.total, self.types, self.d = total, types, discounts(of_counts)
        seen = [r * n for r, n in enumerate(of_counts[:K], 1)]
        kept = sum(self.d[r] * x for r, x in enumerate(seen, 1)) + (total - sum(seen))
        left = total - kept
        # Nothing was discounted: the unknown word takes one more count.
        self.scale, self.unknown = (total, left / total) if left > 1e-9 else (total + 1, 1 / (total + 1))

    def p(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        low = self.d[np.minimum(counts, K).astype(np.int64)] * c
        return np.where(counts == 0, self.unknown, np.where(counts > K, c, low) / self.scale)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.types + 1)))


def backoff(stats: np.ndarray, history: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(back-off weight, denominator) per history from its sums and training count.

    ``stats`` columns: listed bigrams with counts 1 to K, the counts above K, and the
    unigram probability of all listed words.  An unseen history has weight 1.
    """
    spent = stats[:, :K] @ (d[1:] * np.arange(1, K + 1)) + stats[:, K]
    seen = history > 0
    total = np.where(seen, history, 1).astype(np.float64)
    # Nothing left for unseen words: they get one more count.
    total = np.where(seen & (total - spent <= 1e-9 * total), total + 1, total)
    weight = np.where(seen, (1 - spent / total) / (1 - stats[:, K + 1]), 1.0)
    return weight, total


def _blocks(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    """The texts as blocks: (block, n_tokens, n_words, doc_ids, flags, lengths, vocab, order, codes)."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, ids, flags, words, n = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close() -> pd.DataFrame:
            lengths = np.array([len(w) + 1 for w in words], np.int64)
            hashes = np.full(int(lengths.sum()), END, np.uint64)
            text = np.ones(len(hashes), bool)
            text[np.cumsum(lengths) - 1] = False
            hashes[text] = np.concatenate(words).view(np.uint64)
            vocab, codes, times = np.unique(hashes, return_inverse=True, return_counts=True)
            # Codes by frequency; ``order`` leads back to the order of the hashes.
            order = np.argsort(-times, kind="stable")
            by_times = np.empty(len(order), np.uint32)
            by_times[order] = np.arange(len(order))
            return pd.DataFrame({
                "block": [(part << 33) + seq], "n_tokens": [len(hashes)], "n_words": [len(vocab)],
                "doc_ids": [np.array(ids, np.int64).tobytes()], "flags": [np.array(flags, np.uint8).tobytes()],
                "lengths": [lengths.tobytes()], "vocab": [planes(vocab)],
                "order": [planes(order.astype(np.uint32))], "codes": [planes(by_times[codes])]})

        for b in batches:
            for d, held, w in zip(b["doc_id"].tolist(), b["held"].tolist(), b["words"]):
                null = d is None or d != d
                ids.append(0 if null else int(d))
                flags.append(2 * bool(held) + null)
                words.append(np.asarray(w, np.int64))
                n += len(w) + 1
                if n >= BLOCK_TOKENS:
                    yield close()
                    seq, ids, flags, words, n = seq + 1, [], [], [], 0
        if words:
            yield close()

    t = F.btrim(ascii_lower(F.col("text")), F.lit(WS_CHARS))
    words = F.when(t.isNull() | (t == ""), F.array().cast("array<long>")).otherwise(
        F.transform(F.split(t, WS_CLASS + "+"), lambda w: F.xxhash64(w)))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), folds) == held_out).alias("held"),
                      words.alias("words"))
    return stored(src.mapInPandas(build, "block long, n_tokens long, n_words long, doc_ids binary, flags binary, "
                                         "lengths binary, vocab binary, order binary, codes binary"), "token_blocks")


class Block:
    """One block's tokens, opened; its words are numbered in the order of their hashes."""

    def __init__(self, row):
        self.id = int(row["block"])
        self.codes = unplanes(row["order"], np.uint32).astype(np.int64)[unplanes(row["codes"], np.uint32)]
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.flags = np.frombuffer(row["flags"], np.uint8)
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.train = np.repeat(self.flags < 2, self.lengths)

    def pairs(self, ids: np.ndarray, hot: np.ndarray, buckets: int):
        """Distinct bigrams as (history, word) numbers, those to ask for first and by bucket; the bucket
        of each of them; each token's place among all.

        The number len(ids) stands for the history of a first token.
        """
        n = len(ids)
        before = np.empty(len(self.codes), np.int64)
        before[1:] = self.codes[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = n
        distinct, place = np.unique(before * (n + 1) + self.codes, return_inverse=True)
        v, w = distinct // (n + 1), distinct % (n + 1)
        ids = np.append(ids, np.uint64(START_ID))
        spread = np.isin(ids, hot)
        key = np.where(spread[v], mix(ids[v] + mix(ids[w])), mix(ids[v]))
        # A bigram with a word that training has not seen has no count.
        bucket = np.where((ids[v] != UNSEEN) & (ids[w] != UNSEEN), bucket_of(key, buckets), buckets)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        asked = int((bucket < buckets).sum())
        return v[order], w[order], bucket[order][:asked], rank[place], ids


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key: equal ranges of the hash space, in the order of the keys."""
    return ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _slices(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of a sorted array."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(bucket))):
        if b > a:
            yield int(bucket[a]), int(a), int(b)


def _of_counts(totals: np.ndarray) -> list[int]:
    return np.bincount(totals[(totals > 0) & (totals <= K + 1)].astype(np.int64), minlength=K + 2)[1:].tolist()


_TABLE = "order int, bucket int, block long, keys binary, counts binary, extra binary, total long, types long, of_counts array<long>"


def _row(order, bucket, block, keys=b"", counts=b"", extra=b"", total=0, types=0, of_counts=None):
    return (order, bucket, block, keys, counts, extra, total, types, of_counts or [0] * (K + 1))


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in _TABLE.split(", ")])


#: Values of ``block`` in rows of the n-gram table that answer no block.
MODEL, HOT = -1, -2


def _totals(rows: DataFrame) -> tuple[int, int, list[int]]:
    """(tokens, types, numbers of types that occur 1, 2, ... times) of one order's table."""
    r = rows.filter(F.col("block") == MODEL).agg(
        F.sum("total"), F.sum("types"), *[F.sum(F.col("of_counts")[i]) for i in range(K + 1)]).first()
    return int(r[0] or 0), int(r[1] or 0), [int(x or 0) for x in r[2:]]


def _count_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """The unigram table (``block`` MODEL) and every block's answers."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, row in b.iterrows():
                x, vocab = Block(row), unplanes(row["vocab"], np.uint64)
                counts = np.bincount(x.codes[x.train], minlength=len(vocab)).astype(np.uint32)
                yield pd.DataFrame([(k, x.id, planes(vocab[i:j]), planes(counts[i:j])) for k, i, j in
                                    _slices(bucket_of(vocab, buckets))], columns=["bucket", "block", "keys", "counts"])

    def add(asked: pd.DataFrame) -> pd.DataFrame:
        asked = asked.sort_values("block")
        keys = [unplanes(k, np.uint64) for k in asked["keys"]]
        counts = np.concatenate([unplanes(c, np.uint32) for c in asked["counts"]]).astype(np.float64)
        names, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, weights=counts).astype(np.uint64)
        seen, k = totals > 0, int(asked["bucket"].iloc[0])
        # Ids are dense within a bucket and differ between buckets; the end token is the first of the first.
        ids = np.where(seen, (np.cumsum(seen) - 1) * buckets + k + END_ID, UNSEEN).astype(np.uint64)
        out = [_row(1, k, MODEL, planes(names[seen]), planes(totals[seen]), planes(ids[seen]), int(totals.sum()), int(seen.sum()), _of_counts(totals))]
        ends = np.cumsum([len(x) for x in keys])
        for block, x, e in zip(asked["block"], keys, ends):
            mine = place[e - len(x):e]
            out.append(_row(1, k, int(block), counts=planes(totals[mine]), extra=planes(ids[mine])))
        return _frame(out)

    asked = blocks.mapInPandas(ask, "bucket int, block long, keys binary, counts binary")
    return stored(asked.groupBy("bucket").applyInPandas(add, _TABLE), "ngrams_1")


def _answer(answers: pd.DataFrame, order: int) -> pd.DataFrame:
    return answers[answers["order"] == order].sort_values("bucket")


def _words(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(training count, id) of each of a block's words."""
    told = _answer(answers, 1)
    return tuple(np.concatenate([unplanes(x, np.uint64) for x in told[c]]) for c in ("counts", "extra"))


def _firsts(v: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.append(0, np.flatnonzero(v[1:] != v[:-1]) + 1)


def _pack_stats(stats: np.ndarray) -> bytes:
    """The sums' columns: numbers of bigrams and counts as integers, the probabilities as they are."""
    return _joined(*[planes(stats[:, i].astype(np.uint64)) for i in range(K + 1)], planes(stats[:, K + 1]))


def _unpack_stats(data: bytes) -> np.ndarray:
    kinds = [np.uint64] * (K + 1) + [np.float64]
    return np.stack([unplanes(p, t).astype(np.float64) for p, t in zip(_parted(data), kinds)], axis=1)


def _joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _parted(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 4], "little")
        yield data[at + 4:at + 4 + n]
        at += 4 + n


def pack_pairs(v: np.ndarray, w: np.ndarray, totals: np.ndarray) -> tuple[bytes, bytes]:
    """Bigrams in order as their histories with run lengths and their words; and their counts."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    first = _firsts(v) if len(v) else np.empty(0, np.int64)
    runs = np.diff(np.append(first, len(v))).astype(np.uint32)
    return _joined(planes(v[first]), planes(runs), planes(w)), planes(totals[order])


def unpack_pairs(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(histories, words, counts) of a stored part of the bigram table."""
    heads, runs, words = (unplanes(p, t) for p, t in zip(_parted(keys), (np.uint64, np.uint32, np.uint64)))
    return np.repeat(heads, runs), words, unplanes(counts, np.uint64)


def _count_pairs(blocks: DataFrame, words: DataFrame, uni: Unigrams, hot: np.ndarray, buckets: int) -> DataFrame:
    """The bigram table (``block`` MODEL), sums of hot histories (HOT), and every block's answers."""
    def ask(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        x = Block(block.iloc[0])
        c1, ids = _words(answers)
        v, w, bucket, place, ids = x.pairs(ids, hot, buckets)
        counts = np.bincount(place[x.train], minlength=len(v)).astype(np.uint32)
        out = []
        for k, i, j in _slices(bucket):
            first = _firsts(v[i:j])
            out.append((k, x.id, planes(ids[v[i:j]][first]), planes(np.diff(np.append(first, j - i)).astype(np.uint32)),
                        planes(ids[w[i:j]]), planes(c1[w[i:j]]), planes(counts[i:j])))
        return pd.DataFrame(out, columns=["bucket", "block", "vs", "runs", "ws", "c1", "counts"])

    def add(asked: pd.DataFrame) -> pd.DataFrame:
        asked = asked.sort_values("block")
        heads = [unplanes(x, np.uint64) for x in asked["vs"]]
        runs = [unplanes(x, np.uint32) for x in asked["runs"]]
        v = np.concatenate([np.repeat(a, r) for a, r in zip(heads, runs)])
        w, c1, counts = (np.concatenate([unplanes(x, t) for x in asked[c]]) for c, t in (("ws", np.uint64), ("c1", np.uint64), ("counts", np.uint32)))
        _, first, place = np.unique(mix(v + mix(w)), return_index=True, return_inverse=True)
        totals = np.bincount(place, weights=counts.astype(np.float64)).astype(np.uint64)
        v, w, c1 = v[first], w[first], c1[first]
        listed = np.flatnonzero(totals)
        names, at = np.unique(v[listed], return_inverse=True)
        t = totals[listed]
        sums = [np.bincount(at, weights=(t == r).astype(np.float64), minlength=len(names)) for r in range(1, K + 1)]
        sums += [np.bincount(at, weights=x, minlength=len(names)) for x in (np.where(t > K, t, 0).astype(np.float64), uni.p(c1[listed]))]
        stats = np.stack(sums, axis=1)
        k, mine = int(asked["bucket"].iloc[0]), np.isin(names, hot)
        out = [_row(2, k, MODEL, *pack_pairs(v[listed], w[listed], t), b"", int(totals.sum()), int((totals > 0).sum()), _of_counts(totals)),
               _row(2, k, HOT, names[mine].tobytes(), extra=stats[mine].tobytes())]
        end = 0
        for block, h, r in zip(asked["block"], heads, runs):
            n = int(r.sum())
            own = np.flatnonzero(np.isin(h, names))
            rows = np.searchsorted(names, h[own])
            out.append(_row(2, k, int(block), planes(own.astype(np.uint32)), planes(totals[place[end:end + n]].astype(np.uint32)),
                            _pack_stats(stats[rows])))
            end += n
        return _frame(out)

    asked = blocks.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(
        ask, "bucket int, block long, vs binary, runs binary, ws binary, c1 binary, counts binary")
    return stored(asked.groupBy("bucket").applyInPandas(add, _TABLE), "ngrams_2")


def _hot_sums(pairs: DataFrame) -> dict[int, np.ndarray]:
    """{history: its sums} of the hot histories; fewer than 1 / HOT_SHARE + 1 rows reach the driver."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, extra in zip(b["keys"], b["extra"]):
                stats = np.frombuffer(extra).reshape(-1, K + 2)
                yield pd.DataFrame({"v": np.frombuffer(keys, np.int64), **{f"s{i}": stats[:, i] for i in range(K + 2)}})

    exploded = pairs.filter(F.col("block") == HOT).select("keys", "extra").mapInPandas(
        rows, "v long, " + ", ".join(f"s{i} double" for i in range(K + 2)))
    return {r[0]: np.array(r[1:]) for r in exploded.groupBy("v").agg(*[F.sum(f"s{i}") for i in range(K + 2)]).collect()}


def score(docs: DataFrame, folds: int = 5, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    Tokens are the words (A-Z lower-cased, told apart by 64-bit hashes) and one end per text;
    null and blank texts are the end alone.  The model learns from the rows whose crc32(doc_id)
    modulo ``folds`` is not ``held_out``; a null doc_id counts as the empty text.  ``score``
    is the log10 probability of the text, in which every unknown word has the probability of the
    unknown class.  Rows that repeat a doc_id are texts of their own.  Without training rows every word
    is unknown and has probability 1.  An empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    blocks = _blocks(docs, folds, held_out)
    tokens, keys = blocks.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    if not tokens:
        return spark.createDataFrame([], schema)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = _count_words(blocks, max(least, -(-keys // BUCKET_KEYS)))
    uni = Unigrams(*_totals(words))

    # Histories that hold more than a share of all tokens: fewer than 1 / HOT_SHARE.
    def hot_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for c, ids in zip(b["counts"], b["extra"]):
                yield pd.DataFrame({"v": unplanes(ids, np.uint64)[unplanes(c, np.uint64) > uni.total * HOT_SHARE].view(np.int64)})

    model = words.filter(F.col("block") == MODEL).select("counts", "extra")
    hot = np.array(sorted({START_ID, *(r[0] for r in model.mapInPandas(hot_words, "v long").collect())}), np.uint64)
    answers_1 = words.filter(F.col("block") >= 0).select("order", "bucket", "block", "keys", "counts", "extra")
    blocks = blocks.drop("n_tokens", "n_words", "vocab")
    buckets = max(least, -(-tokens // BUCKET_KEYS))
    pairs = _count_pairs(blocks, answers_1, uni, hot, buckets)
    d = discounts(_totals(pairs)[2])
    hot_sums = _hot_sums(pairs)
    first_tokens = blocks.select("flags").mapInPandas(
        lambda bs: (pd.DataFrame({"n": [int((np.frombuffer(f, np.uint8) < 2).sum()) for f in b["flags"]]}) for b in bs), "n long")
    starts = int(first_tokens.agg(F.sum("n")).first()[0])

    def evaluate(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        x = Block(block.iloc[0])
        c1, ids = _words(answers)
        v, w, bucket, place, ids = x.pairs(ids, hot, buckets)
        # The answers stand in the order of the questions.
        c2 = np.zeros(len(v), np.uint64)
        stats = np.zeros((len(ids), K + 2))
        told = {int(k): (n, c, e) for k, n, c, e in zip(*(_answer(answers, 2)[q] for q in ("bucket", "keys", "counts", "extra")))}
        for k, i, j in _slices(bucket):
            own, counts, extra = told[k]
            c2[i:j] = unplanes(counts, np.uint32)
            stats[v[i:j][_firsts(v[i:j])][unplanes(own, np.uint32)]] = _unpack_stats(extra)
        for name, sums in hot_sums.items():
            stats[ids == _U(name)] = sums
        history = np.where(ids == END_ID, 0, np.append(c1, np.uint64(starts)))  # nothing follows an end
        weight, total = backoff(stats, history, d)
        p1 = uni.p(c1)
        listed = c2 > 0
        discounted = np.where(c2 > K, 1.0, d[np.minimum(c2, K).astype(np.int64)]) * c2
        # Listed bigrams at their own probability, all others at the weighted lower order.
        p2 = np.where(listed, discounted / total[v], weight[v] * p1[w])
        doc = np.repeat(np.arange(len(x.lengths)), x.lengths)

        def per_doc(values):
            return np.bincount(doc, weights=values, minlength=len(x.lengths))

        null = (x.flags & 1) > 0
        return pd.DataFrame({
            "doc_id": pd.array(np.where(null, None, x.doc_ids), "Int64"), "held_out": x.flags >= 2, "n_tokens": x.lengths,
            "n_known": per_doc((c1 > 0).astype(float)[x.codes]).astype(np.int64), "train_tokens": uni.total,
            "base_score": per_doc(uni.base(c1)[x.codes]), "score": per_doc(np.log10(p2)[place])})

    told = answers_1.union(pairs.filter(F.col("block") >= 0).select(answers_1.columns))
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(evaluate, schema)


def op1_katz_lm(spark, sf_dir) -> DataFrame:
    """Back-off and unigram scores of every document."""
    return score(table(spark, sf_dir, "documents"))
