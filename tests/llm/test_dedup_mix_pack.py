"""Jaccard join, mixing, packing, token files and the pipeline on small fixtures."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from lloydflow.llm import jaccard_join, mixing, packing, pfor, tokenize

from .helpers import ODD, documents, words


def brute_jaccard(rows, similarity=0.8):
    """(doc_id, class_id, n_links) per row."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted(((d, min((x for x in least[find(i)] if x is not None), default=None), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(n, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(n):
        base = [rng.choice(vocab) for _ in range(rng.randint(8, 150))]
        for _ in range(rng.choice([1, 1, 1, 2, 3, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_jaccard_join_against_brute_force(spark):
    rows = near_copies(120) + [(5000 + i, t) for i, t in enumerate(["same text of six words here"] * 3)] + [r[:2] for r in ODD]
    got = jaccard_join.jaccard_classes(documents(spark, rows, extra=True)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=str) == brute_jaccard(rows)


def test_jaccard_join_large_groups_in_small_buckets(spark, monkeypatch):
    # Every limit made small, so that splitting, pivots and block pairs all take part.
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "LEAVE", 0.97)
    monkeypatch.setattr(jaccard_join, "DEPTH", 1)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + r[0], r[1]) for r in near_copies(30, seed=4)]
    got = jaccard_join.jaccard_classes(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=str) == brute_jaccard(rows)


def frequent_lines(n, seed=6):
    """Pairs of near copies of two lines each; their common shingles are in many other texts."""
    rng = random.Random(seed)
    lines = [" ".join(f"l{j}w{i}" for i in range(6 + j % 2)) for j in range(12)]
    bases = [" ".join((rng.choice(lines), rng.choice(lines))) for _ in range(n)]
    return [(2 * g + i, f"{base} end{2 * g + i}") for g, base in enumerate(bases) for i in range(2)]


def test_jaccard_join_short_texts_of_frequent_lines(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    rows = frequent_lines(400)
    got = jaccard_join.jaccard_classes(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=str) == brute_jaccard(rows)


def test_jaccard_join_splits_give_short_texts_children(spark):
    # 13 to 15 words in one bucket: each has its children, and near copies mostly share one.
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2 ** 63, 10).astype(np.uint64)) for _ in range(300)]
    rows = [(7, 2 * g + i, bytearray(jaccard_join.sketch(np.unique(np.append(s, np.uint64(2 * g + i) << np.uint64(54)))).tobytes()))
            for g, s in enumerate(sets) for i in range(2)]
    children = defaultdict(set)
    for r in jaccard_join._split(spark.createDataFrame(rows, "bucket long, row long, sketch binary")).collect():
        children[r["row"]].add(r["bucket"])
    assert all(len(children[i]) == jaccard_join.BRANCH for i in range(600))
    # At J = 10 / 12 a pair shares none with probability (2 / 12) ** 2.
    assert sum(bool(children[2 * g] & children[2 * g + 1]) for g in range(300)) >= 280


def test_jaccard_join_empty_and_one_per_class(spark):
    assert jaccard_join.jaccard_classes(documents(spark, [])).count() == 0
    docs = documents(spark, [(9, "a b c d e f g"), (4, "A b c d e f g"), (4, "A b c d e f g"), (5, None), (6, "other words")], extra=True)
    out = jaccard_join.one_per_class(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [4, 5, 6]


@pytest.mark.parametrize("rows,kept", [
    ([(None, "a b c d e f g h i j k"), (None, "a b c d e f g h i j k l"), (None, "a b c d e f g h i j k l m")], 1),
    ([(7, "a b c d e f g h i j k"), (7, "a b c d e f g h i j k l"), (8, "other words that stand alone here")], 2),
    ([(7, "a b c d e f g h i j k"), (7, "a b c d e f g h i j k"), (None, "a b c d e f g h i j k l"), (9, None), (9, None), (9, " ")], 4)])
def test_one_row_of_a_class_stays_whatever_its_ids(spark, rows, kept):
    docs = documents(spark, rows, extra=True)
    out = jaccard_join.one_per_class(docs).collect()
    assert len(out) == kept
    if rows[0][0] == 7:
        assert sum(r["doc_id"] == 7 for r in out) == 1


def common_passage(m, seed=9):
    """``m`` texts of which two fifths are one passage, a near copy of every fourth among them."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(m):
        if i % 4 == 3:
            text = list(rows[-1][1].split())
            text[rng.randrange(60)] = f"x{i}"
        else:
            text = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
            text[30:30] = passage
        rows.append((i, " ".join(text)))
    return rows


def test_jaccard_join_of_a_hot_passage_grows_with_its_members(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 32)
    made = []
    for m in (200, 400):
        children, edges = [], []
        split, ties = jaccard_join._split, jaccard_join._ties
        monkeypatch.setattr(jaccard_join, "_split", lambda d: (children.append(d.count()), split(d))[1])
        monkeypatch.setattr(jaccard_join, "_ties", lambda d: (lambda e: (edges.append(e.count()), e)[1])(ties(d)))
        rows = common_passage(m)
        got = jaccard_join.jaccard_classes(documents(spark, rows)).collect()
        monkeypatch.setattr(jaccard_join, "_split", split)
        monkeypatch.setattr(jaccard_join, "_ties", ties)
        assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=str) == brute_jaccard(rows)
        made.append((sum(children), sum(edges)))
    (c1, e1), (c2, e2) = made
    assert c2 <= 2.6 * c1 and c2 <= 16 * 400 and e2 <= 3 * e1


def test_components_of_parallel_edges(spark):
    from lloydflow.llm.components import components

    rng = random.Random(3)
    edges = [(rng.randrange(g * 100, g * 100 + 60), rng.randrange(g * 100, g * 100 + 60)) for g in range(8) for _ in range(40 + 30 * g)]
    label = {v: v for e in edges for v in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {v: r for v, r in label.items() if any(v in e and e[0] != e[1] for e in edges)}
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_targets(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not over:
            return {s: float(fixed.get(s, weight[s] * level)) for s in order}
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_targets_and_bounds(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["a", "b", "é", "Z", None])) for i in range(300)]
    rows += [(1000 + i, "long " * 900, "en", "big") for i in range(40)] + [(2000, "tiny source", "en", "t")] + [(r + (None, None))[:4] for r in ODD]
    docs = documents(spark, rows, extra=True)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = brute_targets(sizes)
    assert {s: round(t, 6) for s, t in target.items()} == {s: round(t, 6) for s, t in want.items()}
    assert Counter(r["source_size"] == sizes[r["source"]] for r in out) == {True: len(out)}
    for s in sizes:
        # As near as whole copies allow: everything that would still fit the gap is at its cap.
        gap = int(want[s]) - taken[s]
        assert gap >= 0
        assert all(r["copies"] == 3 for r in out if r["source"] == s and 0 < r["size"] <= gap)
    again = mixing.mix(docs).collect()
    key = lambda r: (str(r["doc_id"]), r["tie"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    drawn = mixing.mixed_documents(docs)
    assert drawn.columns == docs.columns and drawn.count() == sum(r["copies"] for r in out)


def test_mix_empty_table_and_blank_texts(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    out = mixing.mix(documents(spark, [(1, None, None, "a"), (2, " ", None, "b")])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in out] == [(0, 0, 0.0)] * 2


def ids_of(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenize.tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = ["", "a", " a", "a ", "a  b", "a\n\nb", "a\nb", "x.\ny! z?", "don't stop", "éa.b,c", "a\tb c", "a\r\nb", "日本 語。 x", "1.5, 2;", "it's. we'll\nfoo",
         "a\n", "\na", "a \t b", "a\x85 b", " ", "\n \n", "word " * 3000, "Große Ærøskøbing façade\nŁódź ǅ ſtraße ᾳ x\nЖук жук", "Plain words, and more words. Plain words!"]


def test_cached_encoding_equals_the_library():
    enc = tokenize.encoder()
    for _ in range(2):
        got = enc([*TEXTS, None])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(t) for t in [*TEXTS, None]]


@pytest.mark.parametrize("ids", [[], [0], [2 ** 32 - 1], list(range(1000)), [7] * 256, [5, 2 ** 31] * 300, [1] * 250 + [2 ** 32 - 1] * 20 + [3] * 10])
def test_pfor_round_trip_and_block_access(ids):
    a = np.array(ids, np.uint32)
    data = pfor.pack(a)
    assert (pfor.unpack(data) == a).all()
    if len(a) > pfor.BLOCK:
        assert (pfor.unpack(data, 1, 1) == a[pfor.BLOCK:2 * pfor.BLOCK]).all()


def test_pfor_random_round_trips():
    rng = np.random.default_rng(1)
    for n in (1, 255, 256, 257, 5000):
        for top in (2, 300, 65_535, 65_536, 2 ** 32 - 1):
            a = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            a[rng.random(n) < 0.03] = 2 ** 32 - 1
            assert (pfor.unpack(pfor.pack(a)) == a).all()


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(pfor, "IMAGE_IDS", 500)
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [r[:2] for r in ODD]
    got = pfor.read_tokens(pfor.write_tokens(documents(spark, rows, extra=True))).collect()
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of(t)
        want.append((str(d), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert pfor.read_tokens(pfor.write_tokens(documents(spark, []))).count() == 0


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, capacity):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "be", "gamma delta", "x."]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    rows += [r[:2] for r in ODD] + [(3000 + i, t) for i, t in enumerate(TEXTS)]
    got = packing.pack(documents(spark, rows, extra=True), capacity).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for d, t in rows:
        ids = ids_of(t)
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want[d] += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in want.items()}
    for places in seqs.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r["length"] for r in got) // capacity)
    assert len(seqs) <= least * 1.06 + 3
    assert packing.pack(documents(spark, [])).count() == 0


def test_plan_holds_every_piece_and_is_near_the_bound():
    rng = np.random.default_rng(2)
    for shape in (rng.integers(1, 1024, 5000), rng.integers(300, 600, 3000), np.full(1000, 513), rng.integers(1, 60, 4000), np.array([], int)):
        histogram = {int(k): int(v) for k, v in Counter(shape.tolist()).items()}
        bins = packing.plan_bins(histogram)
        held = Counter()
        for t, lengths in bins:
            assert sum(lengths) <= 1024 and t > 0
            for n in lengths:
                held[n] += t
        assert held == histogram
        if len(shape) == 5000:
            assert sum(t for t, _ in bins) <= 1.02 * -(-int(shape.sum()) // 1024)


def test_pipeline_stages(spark, tmp_path):
    rows = near_copies(25) + [(900, None), (901, "12 34"), (902, ""), (903, "a clean document of its own words stands here")]
    docs = documents(spark, [(d, t, "en", f"s{d % 3}" if d % 5 else None) for d, t in rows] + [(None, "nameless words of a text", None, None)] * 2)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "mixing", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        seen[name], columns = spark.read.parquet(str(tmp_path / name)), docs.columns
        assert name == "packing" or seen[name].columns == columns
        docs = seen[name]
    kept = {r["doc_id"] for r in seen["language_id"].collect()}
    assert {900, 901, 902}.isdisjoint(kept) and {903, *range(20)} <= kept
    classes = {c for d, c, _ in brute_jaccard([(r["doc_id"], r["text"]) for r in seen["line_dedup"].collect()])}
    assert {r["doc_id"] for r in seen["near_duplicates"].collect()} == classes
    assert {r["doc_id"] for r in seen["mixing"].collect()} <= classes
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, "")
        assert empty_out.count() == 0


def test_jaccard_join_makes_each_child_once(spark, monkeypatch):
    """The levels of splitting make BRANCH children a member, however often the buckets are read."""
    monkeypatch.setattr(jaccard_join, "SMALL", 32)
    made, members, split = spark.sparkContext.accumulator(0), [], jaccard_join._split

    def tally(batches):
        for b in batches:
            made.add(len(b))
            yield b

    def counted(d):
        members.append(d.count())
        return split(d).mapInPandas(tally, "bucket long, row long")

    monkeypatch.setattr(jaccard_join, "_split", counted)
    rows = common_passage(200)
    got = jaccard_join.jaccard_classes(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=str) == brute_jaccard(rows)
    assert sum(members) and made.value == jaccard_join.BRANCH * sum(members)


def test_middling_buckets_are_compared_not_split(spark, monkeypatch):
    """Unlike texts that share one shingle have no children up to the size that is compared in full."""
    rng = np.random.default_rng(4)
    rows = [(i, [7], bytearray((rng.integers(1, 1 << 16, jaccard_join.BINS) if i else np.ones(jaccard_join.BINS)).astype(np.uint16).tobytes()))
            for i in range(700)]
    rows.append((700, [7], rows[699][2]))
    monkeypatch.setattr(jaccard_join, "_split", lambda members: (_ for _ in ()).throw(AssertionError("split")))
    ties = jaccard_join._ties(spark.createDataFrame(rows, "row long, keys array<long>, sketch binary"))
    assert {tuple(sorted(r)) for r in ties.collect()} == {(699, 700)}
