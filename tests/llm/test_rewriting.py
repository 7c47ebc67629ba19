"""Fill-in-middle, quality rules and importance resampling against brute-force versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lloydflow.llm import fim, importance, quality

from .helpers import EXTRA, LOW, ODD, documents

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s:.)"}
LONG = [(40, "a\n" * 3000 + "end"), (41, "x" * 5000), (42, "\n\n\n"), (43, "has <S> inside"), (44, " lead\n \ttail "), (45, "𝔘𝔫\n𝔦 ünï\r\ncode"), (45, "𝔘𝔫\n𝔦 ünï\r\ncode"),
        (46, "one <\nP> two\n"), (47, "l1\nl2<\nl3\nl4<S\nl5")]


def draws(doc_id):
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]


def units_of(text, unit):
    if unit == "word":
        starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)][1:]
        return [text[a:b] for a, b in zip([0] + starts, starts + [len(text)])] if text else []
    return re.findall(PATTERNS[unit], text)


def brute_fim(doc_id, text, unit="line", rate=100):
    text = text or ""
    u = units_of(text, unit)
    h = draws(doc_id)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(k in text for k in fim.MARKS) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate", [("line", 100), ("word", 60), ("char", 0), ("char", 100)])
@pytest.mark.parametrize("chunk", [1 << 22, 50])
def test_fim_against_brute_force(spark, monkeypatch, unit, rate, chunk):
    rng = random.Random(3)
    rows = [r[:2] for r in ODD] + LONG + [(100 + i, "".join(rng.choice("ab \n\tü") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    monkeypatch.setattr(fim, "CHUNK", chunk)  # reaches the tasks: the function is shipped by value
    made = fim.fill_in_middle(documents(spark, rows, extra=True), unit=unit, rate=rate)
    got = made.select("_row.*", "_row.n", F.struct(made["n"], "form", "prefix_chars", "middle_chars", "output").alias("out"),
                      fim.restored(F.col("output"), F.col("form")).alias("back"))
    found = [(r["doc_id"], r["text"], tuple(r["out"]), r["back"]) for r in got.select("doc_id", "text", "out", "back").collect()]
    want = [(d, t, brute_fim(d, t, unit, rate), t or "") for d, t in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_fim_keeps_columns_and_empty_tables(spark):
    docs = documents(spark, [(1, "a\nb\nc")], extra=True)
    out = fim.transformed(docs)
    assert out.columns == docs.columns and out.collect()[0]["text"] == brute_fim(1, "a\nb\nc")[4]
    assert fim.fill_in_middle(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        fim.cuts(["a"], np.array([0]), np.array([1]), "page")


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 4, n).astype(np.uint8)
        m = fim.WaveletMatrix(s)
        at = np.arange(n + 1)
        for c in range(4):
            assert (m.rank(c, at) == np.concatenate(([0], np.cumsum(s == c)))).all()


# ------------------------------------------------------------------ importance

def brute_resample(rows, target, percent=25, grams=2):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(t):
        w = word.findall((t or "").translate(LOW))
        return len(w), [" ".join(w[i:i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    cut = [(d, *features(t)) for d, t in rows]
    s = Counter(bucket(f) for _, _, fs in cut for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    out = []
    for d, n, fs in cut:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = draws(d)[0]
        out.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    some = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(some[:percent * len(some) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("piece,grams", [(1 << 16, 2), (40, 3)])
def test_resampling_against_brute_force(spark, monkeypatch, piece, grams):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "ÄB", "x9", "日本"]
    rows = [r[:2] for r in ODD + LONG] + [(200 + i // 2, "-".join(rng.choice(vocab) for _ in range(rng.randint(0, 70)))) for i in range(160)]
    target = [" ".join(rng.choice(vocab[:20]) for _ in range(50)) for _ in range(20)] + [None, ""]
    monkeypatch.setattr(importance, "PIECE", piece)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    out = importance.resample(documents(spark, rows, extra=True), bench, percent=30, grams=grams)
    got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])
           for r in out.select("_row.doc_id", "n_features", "weight", "score", "rank").collect()]
    want = brute_resample(rows, target, 30, grams)
    assert [r[:4] for r in sorted(got, key=repr)] == [r[:4] for r in want]
    drawn = lambda rs: sorted((r[4], r[3], r[0]) for r in rs if r[4])
    assert drawn(got) == drawn(want)  # rows equal in score and doc_id share their ranks


def test_resampling_edges(spark):
    docs, none = documents(spark, [r[:2] for r in ODD]), spark.createDataFrame([], "text string")
    assert importance.resample(documents(spark, []), docs).count() == 0
    rows = importance.resample(docs, none).collect()
    assert len(rows) == len(ODD) and {r["weight"] for r in rows if r["n_features"] == 0} == {0}
    extra = documents(spark, [(1, "a b")], extra=True)
    assert set(EXTRA) <= set(importance.resample(extra, none).schema["_row"].dataType.names)
    assert importance.resample(extra, none, keep=["doc_id", "n"]).schema["_row"].dataType.names == ["doc_id", "n"]


def test_split_finds_the_words_of_the_pattern():
    split = importance.splitter()
    word = re.compile(importance.WORD)
    for t in ("", " ", "a\x00b c~d", "é·ß x-1", " z　y", "a" * 1000 + " b" * 300):
        assert importance._words(t, split) == word.findall(t)
        assert [t[a:b] for _, (a, b) in split(t)] == word.findall(t)


# ------------------------------------------------------------------ quality

def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) for j in range(3) if windows[tuple(w[i:i + 3])] > 1}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def corpus(n, seed=4):
    """Prose (even ids) and symbol-laden menus (odd ids), each with a line of the other kind now and then."""
    rng = random.Random(seed)
    vocab = ["stone", "river", "walks", "under", "yellow", "sky", "and", "the", "of", "many", "birds"]
    prose = lambda: (" ".join(rng.choice(vocab) for _ in range(rng.randint(12, 25))).capitalize() + ".")
    menu = lambda: " | ".join(rng.choice(vocab) + rng.choice(vocab) + rng.choice(["$$$", "***", "##"]) for _ in range(rng.randint(8, 16)))
    rows = []
    for i in range(n):
        own, other = (prose, menu) if i % 2 == 0 else (menu, prose)
        rows.append((i, "\n".join(other() if rng.random() < 0.1 else own() for _ in range(rng.randint(6, 12)))))
    return rows


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_counts_and_verdicts(spark):
    rows = [r[:2] for r in ODD + LONG] + corpus(200) + [(900, "same three words " * 40), (901, "w " * 49 + "z"), (902, None)]
    known = labels(spark, [(i, int(i % 2 == 0), 0) for i in range(0, 100)] + [(None, 1, 0), (5, None, 0)])
    out = quality.judge(documents(spark, [(d if d is None or d >= 900 else d + 1000, t) if i < len(ODD) + len(LONG) else (d, t)
                                          for i, (d, t) in enumerate(rows)], extra=True), known)
    got = out.select("_row.doc_id", "_row.text", *quality.COLUMNS[:5], "base_failed", "kept").collect()
    for r in got:
        want = brute_counts(r["text"])
        assert tuple(r[c] for c in quality.COLUMNS[:5]) == want, r
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    verdict = {r["doc_id"]: r["kept"] for r in got if r["doc_id"] is not None and 100 <= r["doc_id"] < 200 and not r["base_failed"]}
    assert len(verdict) > 60 and sum(kept == (i % 2 == 0) for i, kept in verdict.items()) == len(verdict)
    assert not any(r["kept"] for r in got if r["doc_id"] in (900, 901, 902))


def test_quality_without_labels_or_rows(spark):
    none = labels(spark, [])
    kept = quality.judge(documents(spark, corpus(6)), none).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in kept)
    assert quality.judge(documents(spark, []), none).count() == 0
    assert quality.judge(documents(spark, []), labels(spark, [(1, 1, 0), (2, 0, 0)])).count() == 0


def random_field(rng):
    return quality.Field(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(1)
    lengths = [1, 7, 3, 1, 5, 2]
    features = rng.integers(0, quality.N_FEATURES, (sum(lengths), len(quality.FEATURES)))
    first = np.concatenate(([0], np.cumsum(lengths)))
    for _ in range(20):
        f = random_field(rng)
        got = f.viterbi(features, first)
        for a, b in zip(first[:-1], first[1:]):
            def total(s):
                x = f.emit[features[a:b]].sum(axis=1)
                return f.begin[s[0]] + sum(x[i, l] for i, l in enumerate(s)) + sum(f.move[p, q] for p, q in zip(s, s[1:]))

            best = max(itertools.product((0, 1), repeat=int(b - a)), key=total)
            assert total(tuple(got[a:b])) == pytest.approx(total(best))
    tie = quality.Field(np.zeros((quality.N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    assert tie.viterbi(features, first).all()  # on a tie: content
    assert len(tie.viterbi(features[:0], np.array([0]))) == 0


def test_likelihood_gradient_and_sum():
    rng = np.random.default_rng(2)
    n, length = 4, 5
    features = rng.integers(0, quality.N_FEATURES, (n, length, len(quality.FEATURES)))
    mask = np.arange(length) < np.array([5, 1, 3, 2])[:, None]
    y = rng.integers(0, 2, (n, length))
    f = random_field(rng)
    value, *d = quality.likelihood(f, features, y, mask)
    # Probabilities of all sequences of the third text sum to one.
    total = sum(math.exp(quality.likelihood(f, features[2:3], np.array([[*s, 0, 0]]), mask[2:3])[0]) for s in itertools.product((0, 1), repeat=3))
    assert total == pytest.approx(1)
    for w, g in zip((f.emit, f.move, f.begin), d):
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(8)] + [(int(features[0, 0, 0]), 1)[:w.ndim]] * (w.shape[0] > 2):
            w[at] += 1e-5
            up = quality.likelihood(f, features, y, mask)[0]
            w[at] -= 1e-5
            assert (up - value) / 1e-5 == pytest.approx(g[at], abs=1e-3)


def test_line_labels_show_every_line(spark):
    docs = documents(spark, [(1, "a\nb\n"), (2, None)], extra=True)
    rows = quality.line_labels(docs, None).select("_row.doc_id", "line_no", "line", "content").orderBy("doc_id", "line_no").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a", True), (1, 1, "b", True), (1, 2, "", True), (2, 0, "", True)]
