"""N-gram Jaccard self-join of documents by chosen paths.

A document is the set of hashes of its five-word shingles; equal sets are
collapsed first.  Each run sends a set into the buckets of a few sampled
shingles (the same hash decides for every set, so similar sets meet).  Buckets
that are small are compared by brute force.  In a larger one everything close to a pivot
is tied to it, so that a large group of near copies leaves in linear time; the
others are split again on sampled entries of their sketches that the pivot does not share, so
that a passage which is common to the whole bucket does not keep it together (every member
has children, however short its text).  Runs are repeated until a pair at the
threshold is missed with less than the allowed probability.

Bucket comparisons use 128-bin minimum sketches with a wide margin and only
decide which documents to look at together.  Inside the groups so found
every pair's exact Jaccard similarity is computed, block against block; links and
classes come from those alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, ascii_lower, boxed, cell_index, stored, table, unboxed
from .components import components

WORDS, SIMILARITY = 5, 0.8
#: Probability that a pair at the threshold meets in a bucket of some run.
RECALL = 0.9999
#: Sampled shingles per run, over 1 / similarity; sketch entries that split a node.
OVERSAMPLE, BRANCH = 1.5, 2
#: Buckets up to this size are compared by brute force; levels of splitting.
SMALL, DEPTH = 1024, 4
BINS = 128
#: Estimated similarity that ties two documents of a small bucket, that ties one to the pivot of a large bucket,
#: and from which it leaves the large bucket.  1 - J is a metric: a partner of a document that leaves is itself
#: at least LEAVE - (1 - SIMILARITY) from the pivot, well above STAR, so it is tied as well.
TIE, STAR, LEAVE = 0.6, 0.3, 0.7
#: Documents of a candidate group that are compared in one block.
BLOCK = 512

_U = np.uint64


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY) -> int:
    """Runs until a pair at the threshold meets in an unsplit bucket of one of them, whatever is split on the way."""
    # A pair that a pivot does not tie has a member less than STAR from it, which shares at most this part
    # of the pair's union with the pivot; what is left of the pair's common entries decides on its children.
    masked = STAR * (1 + similarity) / (1 + STAR)
    kept = (similarity - masked) / (1 - masked)
    parted = 0.0  # probability that a pair in one bucket is in no common bucket DEPTH levels below
    for _ in range(DEPTH):
        parted = (1 - kept * (1 - parted)) ** BRANCH
    miss = math.exp(-OVERSAMPLE * (1 - parted))  # Poisson: OVERSAMPLE shared samples are expected in a run
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text's word hashes; a shorter text is one shingle."""
    w = words.view(np.uint64)
    if not len(w):
        return w
    n = max(1, len(w) - size + 1)
    h = np.full(n, min(len(w), size), np.uint64)
    for i in range(min(len(w), size)):
        h = mix(h * _U(0x9E3779B97F4A7C15) + w[i:i + n])
    return np.unique(h)


def sketch(s: np.ndarray) -> np.ndarray:
    """Per bin of the hash range the low bits of its least member; 0 where the bin is empty."""
    bounds = np.arange(BINS, dtype=np.uint64) << _U(57)
    at = np.searchsorted(s, bounds)
    full = np.append(at[1:], len(s)) > at
    out = np.zeros(BINS, np.uint16)
    out[full] = (s[at[full]] & _U(0xFFFF)).astype(np.uint16) | np.uint16(1)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches, along the last axis."""
    either = ((a > 0) | (b > 0)).sum(axis=-1)
    return ((a == b) & (a > 0)).sum(axis=-1) / np.maximum(either, 1)


def unshared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketches ``a`` without the entries that are those of ``b``; whole where nothing would be left."""
    out = np.where(a == b, np.uint16(0), a)
    return np.where((out > 0).any(axis=-1, keepdims=True), out, a)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each of ``n`` vertices' component under the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def word_hashes(text) -> "F.Column":
    """The words' 64-bit hashes, A-Z lower-cased; null and blank texts have none."""
    t = F.btrim(ascii_lower(text), F.lit(WS_CHARS))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<long>")).otherwise(
        F.transform(F.split(t, WS_CLASS + "+"), lambda w: F.xxhash64(w)))


def _sketched(docs: DataFrame, runs: int, similarity: float) -> DataFrame:
    """(row, doc_id, text_key, n, k1, k2, keys, sketch) of every row; k1, k2 identify the shingle set."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = mix(np.arange(1, 2 * runs + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
        for b in batches:
            sets = [shingles(np.asarray(w, np.int64)) for w in b["words"]]
            sizes = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            own = np.repeat(np.arange(len(sets)), sizes)
            share = np.minimum(OVERSAMPLE / similarity / np.maximum(sizes, 1), 1.0)
            limit = (share * float(2 ** 64 - 4096)).astype(np.uint64)[own]
            picked = [[] for _ in sets]
            for r in range(runs):
                at = np.flatnonzero(mix(every + seeds[r]) <= limit)
                for i, key in zip(own[at].tolist(), mix(every[at] ^ seeds[runs + r]).view(np.int64).tolist()):
                    picked[i].append(key)
            with np.errstate(over="ignore"):
                k1 = [int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else 0 for s in sets]
                k2 = [int(np.add.reduce(mix(s ^ _U(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0 for s in sets]
            yield pd.DataFrame({"row": b["row"], "doc_id": b["doc_id"].astype("Int64"), "text_key": b["text_key"], "n": sizes,
                                "k1": k1, "k2": k2, "keys": picked, "sketch": [sketch(s).tobytes() for s in sets]})

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64("text").alias("text_key"), word_hashes(F.col("text")).alias("words"))
    return stored(src.mapInPandas(make, "row long, doc_id long, text_key long, n long, k1 long, k2 long, "
                                        "keys array<long>, sketch binary"), "sketches")


def _grouped(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Batches cut so that rows of one key (which follow each other) stay together."""
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        last = (b[key] == b[key].iloc[-1]).all(axis=1).to_numpy()
        start = len(b) if not last.any() else int(np.flatnonzero(~last).max(initial=-1)) + 1
        rest = b.iloc[start:]
        if start:
            yield b.iloc[:start].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def _sketches(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), BINS)


def _brute(members: DataFrame) -> DataFrame:
    """Edges (a, b) that tie the similar members (bucket, row, sketch) of each small bucket."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _grouped(batches, ["bucket"]):
            bucket, rows, sk = b["bucket"].to_numpy(), b["row"].to_numpy(), _sketches(b["sketch"])
            left, right, d = [], [], 1
            while True:  # every row against the d-th row after it in its bucket
                at = np.flatnonzero(bucket[:-d] == bucket[d:]) if d < len(bucket) else np.empty(0, np.int64)
                if not len(at):
                    break
                for part in np.array_split(at, len(at) // 20_000 + 1):
                    near = part[estimate(sk[part], sk[part + d]) >= TIE]
                    left.append(near)
                    right.append(near + d)
                d += 1
            if left:
                label = forest(len(rows), np.concatenate(left), np.concatenate(right))
                tied = np.flatnonzero(label != np.arange(len(rows)))
                if len(tied):
                    yield pd.DataFrame({"a": rows[tied], "b": rows[label[tied]]}).drop_duplicates()

    dealt = members.repartition("bucket").sortWithinPartitions("bucket", "row")
    return dealt.mapInPandas(compare, "a long, b long")


def _child(node: np.ndarray, sk: np.ndarray, t: int) -> np.ndarray:
    """The t-th child of each member (node, sketch): by its first filled bin in the order that node and t give the bins.

    Every set has a filled bin, however short it is, and two sets choose the same
    entry with the probability of their similarity.
    """
    own = mix(node + _U(t))
    order = mix(own[:, None] + np.arange(1, BINS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    bin_ = np.where(sk > 0, order, ~_U(0)).argmin(axis=1)
    value = sk[np.arange(len(sk)), bin_].astype(np.uint64)
    return mix(own + (value | bin_.astype(np.uint64) << _U(16)))


def _split(members: DataFrame) -> DataFrame:
    """(bucket, row): the child buckets of (bucket, row, sketch), BRANCH for each member."""
    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            node, sk = b["bucket"].to_numpy(np.int64).view(np.uint64), _sketches(b["sketch"])
            for t in range(1, BRANCH + 1):
                yield pd.DataFrame({"bucket": _child(node, sk, t).view(np.int64), "row": b["row"].to_numpy()})

    return members.mapInPandas(children, "bucket long, row long")


def _ties(sets: DataFrame) -> DataFrame:
    """Candidate edges (a, b) between rows of ``sets`` (row, keys, sketch), enough to connect what is similar."""
    sk = sets.select("row", "sketch")
    buckets = sets.select(F.explode("keys").alias("bucket"), "row")
    found, small = [], []
    for level in range(DEPTH + 1):
        counts = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets", light=True)
        # Sketches grow with the documents: they are merged at every size, never broadcast.
        met = stored(buckets.join(counts, "bucket").join(sk.hint("merge"), "row").select("bucket", "n", "row", "sketch"), "met")
        small.append(met.filter(F.col("n") <= SMALL).select("bucket", "row", "sketch"))
        large = met.filter(F.col("n") > SMALL).drop("n")
        if large.isEmpty():
            break
        # Everything close to the bucket's pivot is tied to it; what is very close needs no further look.
        pivots = stored(large.groupBy("bucket").agg(F.min("row").alias("pivot"))
                        .join(sk.withColumnRenamed("row", "pivot").withColumnRenamed("sketch", "pivot_sketch"), "pivot"), "pivots")

        def measure(batches: Iterator[pd.DataFrame], split: bool = level < DEPTH) -> Iterator[pd.DataFrame]:
            for b in batches:
                own, pivot = _sketches(b["sketch"]), _sketches(b["pivot_sketch"])
                left = b["sketch"] if not split else [r.tobytes() for r in unshared(own, pivot)]
                yield b.assign(near=estimate(own, pivot), sketch=left).drop(columns="pivot_sketch")

        measured = stored(large.join(pivots, "bucket").select("bucket", "row", "sketch", "pivot", "pivot_sketch")
                          .mapInPandas(measure, "bucket long, row long, sketch binary, pivot long, near double"), "measured")
        found.append(measured.filter((F.col("near") >= STAR) & (F.col("row") != F.col("pivot")))
                     .select(F.col("row").alias("a"), F.col("pivot").alias("b")))
        rest = measured.filter(F.col("near") < LEAVE).select("bucket", "row", "sketch")
        if level == DEPTH:
            # What no level could split is compared in full, block against block.
            indexed = stored(cell_index(rest, ["bucket"], ["row"], "_i"), "unsplit")
            found.append(_block_pairs(indexed, "bucket", BLOCK, ["row", "sketch"], _block_ties, "a long, b long"))
        else:
            # Counted and joined above: written, so that no child is made twice.
            buckets = stored(_split(rest), "children", light=True)
    edges = _brute(_union(small))
    return _union([edges, *found]).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _block_pairs(indexed: DataFrame, key: str, size: int, columns: list[str], match, schema: str) -> DataFrame:
    """``match(members, one block alone?)`` on every pair of blocks of ``size`` members of each ``key``.

    ``indexed`` has the members' index ``_i`` within their key.  Every member goes once to each
    block of its key, so a task holds two blocks at a time.  ``match`` gets the
    rows of one pair with their block number ``_b``.
    """
    blocks = stored(indexed.groupBy(key).agg((F.floor(F.max("_i") / size) + 1).cast("long").alias("_n")), "blocks", light=True)
    own = F.floor(F.col("_i") / size).cast("long")
    dealt = (indexed.join(blocks, key).withColumn("_b", own)
             .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
             .withColumn("_lo", F.least("_b", "_o")).withColumn("_hi", F.greatest("_b", "_o"))
             .select(key, "_lo", "_hi", "_b", *columns))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ks = [key, "_lo", "_hi"]
        for b in _grouped(batches, ks):
            k = b[ks].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            out = [match(b.iloc[i:j]) for i, j in zip(np.append(0, cuts), np.append(cuts, len(b)))]
            out = [o for o in out if len(o)]
            if out:
                yield pd.concat(out)

    return dealt.repartition(key, "_lo", "_hi").sortWithinPartitions(key, "_lo", "_hi", "_b").mapInPandas(run, schema)


def _block_ties(b: pd.DataFrame) -> pd.DataFrame:
    rows, sk = b["row"].to_numpy(), _sketches(b["sketch"])
    near = [np.flatnonzero(estimate(sk[i], sk) >= TIE) for i in range(len(sk))]
    label = forest(len(rows), np.repeat(np.arange(len(sk)), [len(x) for x in near]), np.concatenate(near))
    tied = np.flatnonzero(label != np.arange(len(rows)))
    return pd.DataFrame({"a": rows[tied], "b": rows[label[tied]]})


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets."""
    m = len(sets)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(place, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    keep = often[place]
    owner, column = owner[keep], column[place[keep]]
    out, width = np.zeros((m, m), np.float32), 4096
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(often.sum()), width):
        i, j = np.searchsorted(column, [at, at + width])
        x = np.zeros((m, min(width, int(column[j - 1]) - at + 1)), np.float32)
        x[owner[i:j], column[i:j] - at] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _links(docs: DataFrame, reps: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """(row, links, least): exact links of the rows of every candidate group ``groups`` (v, root)."""
    wanted = stored(groups.withColumnRenamed("v", "row").join(reps, "row").select(
        "root", "row", "copies", F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")), "wanted", light=True)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_k"), "text")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"root": b["root"], "row": b["row"], "copies": b["copies"],
                                "set": [shingles(np.asarray(w, np.int64)).tobytes() for w in b["words"]]})

    # Equal rows may match a representative more than once; one is enough.  What is wanted grows
    # with the documents, so the join is a merge at every size.
    sets = (texts.join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t")))
            .select("root", "row", "copies", word_hashes(F.col("text")).alias("words"))
            .mapInPandas(cut, "root long, row long, copies long, set binary").dropDuplicates(["root", "row"]))
    indexed = stored(cell_index(stored(sets, "sets"), ["root"], ["row"], "_i"), "groups")

    def link(b: pd.DataFrame) -> pd.DataFrame:
        rows, copies, block = b["row"].to_numpy(), b["copies"].to_numpy(), b["_b"].to_numpy()
        members = [np.frombuffer(s, np.uint64) for s in b["set"]]
        n = np.array([len(s) for s in members], np.int64)
        both = shared_counts(members)
        linked = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if block[0] != block[-1]:  # two blocks: links inside each are counted where it meets itself
            linked &= block[:, None] != block[None, :]
        label = forest(len(rows), *np.nonzero(linked))
        return pd.DataFrame({"row": rows, "links": linked @ copies, "least": rows[label]})

    return stored(_block_pairs(indexed, "root", BLOCK, ["row", "copies", "set"], link, "row long, links long, least long"), "links", light=True)


def jaccard_classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(row, doc_id, class_id, n_links, text_key, root): one row per row of ``docs``.

    Words are runs outside the white space, A-Z lower-cased; a text of fewer than
    five words is one shingle of them all; null and blank texts have no shingle, no
    link and a class of their own.  ``class_id`` is the smallest doc_id of the connected
    group of documents with similarity of at least ``similarity``; ``n_links``
    the number of other documents that are that similar to this one, equal ones
    included.  Rows that repeat a doc_id are documents of their own (equal
    texts are linked).  Null doc_ids only name a class that has no other.  An empty table gives no rows.  ``row``
    tells equal rows apart within one result; ``root`` is one of its class's (null without shingles).  A
    very long text is one set of shingles of its whole length.  Other columns are not read.
    """
    rows = _sketched(docs, runs_needed(recall, similarity), similarity)
    same = stored(rows.filter("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id")), "same", light=True)
    reps = stored(same.join(rows.select("row", "doc_id", "text_key", "keys", "sketch"), "row"), "reps")
    groups = components(_ties(reps.select("row", "keys", "sketch")))
    links = _links(docs, reps.select("row", "copies", "doc_id", "text_key"), groups, similarity)
    classes = components(links.filter(F.col("row") != F.col("least")).select(F.col("row").alias("a"), F.col("least").alias("b")))
    total = links.groupBy("row").agg(F.sum("links").alias("links"))
    named = stored(same.join(classes.withColumnRenamed("v", "row"), "row", "left").join(total, "row", "left").select(
        "k1", "k2", "n", "copies", "least_id", F.coalesce("root", "row").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named", light=True)
    names = stored(named.groupBy("root").agg(F.min("least_id").alias("class_id")), "names", light=True)
    by_set = stored(named.join(names, "root").select("k1", "k2", "n", "class_id", "n_links", "root"), "classes", light=True)
    return rows.join(by_set, ["k1", "k2", "n"], "left").select(
        "row", "doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "text_key", "root")


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` of each class, and every row without a link.

    Of a class the row of the smallest doc_id stays (null ids last, then by the text's hash); one
    of equal rows.  Null and blank texts have no link.  All columns are kept as they are;
    an empty table gives an empty one.
    """
    linked = jaccard_classes(docs, similarity).filter("n_links > 0")
    linked = stored(linked.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times")), "linked", light=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key")).alias("s")
    stays = linked.groupBy("root").agg(first).select(F.col("s.doc_id").alias("_d"), F.col("s.text_key").alias("_t"))
    match = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))
    gone = stored(linked.join(stays, match, "left_anti").select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")), "gone", light=True)
    keyed = boxed(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    stay = keyed.join(gone, match, "left_anti")
    # Of equal rows of one doc_id one stays.
    twice = linked.filter("times > 1")
    if not twice.isEmpty():
        again = stored(twice.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")), "twice", light=True)
        one = stay.join(again, match, "left_semi").dropDuplicates(["doc_id", "text_key"])
        stay = stay.join(again, match, "left_anti").unionByName(one)
    return unboxed(stay, docs.columns)


def op10_jaccard_join(spark, sf_dir) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


OP10_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 4), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM t WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), rare AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM sh a JOIN rare USING (s) JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE shared >= 0.8 * (nx.n + ny.n - shared) - 1e-9
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x
)
SELECT d.doc_id, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS class_id,
       (SELECT count(*) FROM e WHERE e.x = d.doc_id) AS n_links
FROM documents d
"""
