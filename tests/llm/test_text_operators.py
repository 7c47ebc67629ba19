"""Line dedup, secret scan, language ID and Katz scores against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lloydflow.llm import katz, lang_id, line_dedup, secret_scan

from .helpers import ODD, documents, held, words

STRIP = " \t\n\x0b\x0c\r"


def brute_lines(rows, min_docs=3):
    keys = [(d, [(line, line.strip(STRIP).translate(katz_low())) for line in (t or "").split("\n")]) for d, t in rows]
    holders = defaultdict(set)
    for d, lines in keys:
        for _, k in lines:
            if len(k) >= 20:
                holders[k].add(d)
    keeper = {k: max((x for x in h if x is not None), default=None) for k, h in holders.items() if len(h) >= min_docs}
    return sorted(((d, len(lines), sum(k in keeper and d != keeper[k] for _, k in lines),
                    "\n".join(line for line, k in lines if not (k in keeper and d != keeper[k]))) for d, lines in keys), key=str)


def katz_low():
    return str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_line_dedup_odd_rows(spark):
    out = line_dedup.dedup_lines(documents(spark, ODD, extra=True)).collect()
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out), key=str)
    assert got == brute_lines([(r[0], r[1]) for r in ODD])


def test_line_dedup_many_lines_and_a_common_one(spark):
    rows = [(i, "\n".join([f"this line is number {i} of all", "the same line in every document", *(f"l{j}" for j in range(i % 200)),
                           "the same line in every document"])) for i in range(400)]
    rows.append((1000, "\n".join(f"a numbered line of the long text {j % 150}" for j in range(300))))
    rows += [(2000 + k, "\n".join(f"A numbered line of the long text {j}" for j in range(0, 150, 1 + k))) for k in range(3)]
    out = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out), key=str) == brute_lines(rows)


def test_line_dedup_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


HEX = "0123456789abcdef"


def base_brute(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@pytest.mark.parametrize("text", [
    'Token : "abc" token=token:abcdef passwd = x', "apikey='abcdef' API_KEY:=abcdef", "AKIAAKIA" + "A" * 12 + " AKIA123", "é" * 5 + "a" * 24,
    "password=" + "f" * 30, "ſecret=abcdefgh toKen=abcdefgh", "", None, "0123456789abcdef" * 2 + "G" + "a" * 23,
])
def test_base_spans(text):
    assert [s[:3] for s in secret_scan.base_spans(text or "")] == base_brute(text)


def test_secret_scan_finds_the_format_elsewhere(spark):
    rng = np.random.default_rng(3)
    secret = lambda n: "".join(rng.choice(list(HEX), n))
    rows = [(i, f"some words before password={secret(18)} and extraordinarily long words after it") for i in range(60)]
    rows += [(100 + i, f"plain words and {secret(18)} among internationalisation") for i in range(10)]
    long = lambda: "".join(rng.choice(["tion", "ing", "able", "ment", "or", "an", "ver", "ly"], 5))
    rows += [(200 + i, " ".join(long() + "." * (j % 7 == 0) for j in range(15))) for i in range(60)]
    rows += [(9000 + (r[0] or 0), r[1]) for r in ODD]
    out = secret_scan.scan(documents(spark, rows, extra=True)).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    found = {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["found"]] for r in out if r["found"]}
    assert len(found) >= 7 and all(100 <= d < 110 for d in found)  # bare ones are recognised, and nothing else
    for r in out:
        if r["doc_id"] in texts:
            assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == base_brute(texts[r["doc_id"]])
    assert secret_scan.scan(documents(spark, [])).count() == 0


def test_automaton_is_a_distribution_over_its_examples():
    a = secret_scan.Automaton(["ab1", "ab2", "cd3"] * 20)
    assert a.score("ab1") > a.score("zz9") and a.score("ab1") < 0


def test_short_secrets_and_tokens_beyond_a_span_are_found(spark):
    rng = np.random.default_rng(8)
    pick = lambda chars, n: "".join(rng.choice(list(chars), n))
    words = lambda: " ".join(pick("abcdefghijklmnopqrstuvwxyz", rng.integers(3, 12)) for _ in range(20))
    short = lambda: pick("ABCDEFGHJKLMNPQRSTUVWXYZ23456789", 10)
    wide = lambda: "ghp_" + pick(HEX, 30) + "XYZW"
    rows = [(i, f"{words()} password={short() if i % 2 else wide()} {words()}") for i in range(80)]
    rows += [(100 + i, f"{words()} {short()} {words()}") for i in range(10)] + [(200 + i, f"{words()} {wide()} {words()}") for i in range(5)]
    rows += [(300 + i, words()) for i in range(60)]
    out = {r["doc_id"]: r for r in secret_scan.scan(documents(spark, rows)).collect()}
    texts = dict(rows)
    for d, r in out.items():
        found = [texts[d][s["start"]:s["end"]] for s in r["found"]]
        want = [w for w in texts[d].split() if "=" not in w and (w[0].isupper() or w[0].isdigit() or w.startswith("ghp_"))]
        assert found == want, d
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == base_brute(texts[d])  # the bare hexadecimal span stays


def test_automaton_scores_against_every_way_through():
    rng = random.Random(4)
    strings = ["ab" + "".join(rng.choice("01cx") for _ in range(rng.randint(2, 6))) for _ in range(200)]
    a = secret_scan.Automaton(strings)

    def brute(token):
        at, p, rest = 0, 0.0, token
        for want in a.prefix:
            if token.startswith(a.prefix):
                rest = token[len(a.prefix):]
            else:
                p += 0.0 if token[a.prefix.index(want):a.prefix.index(want) + 1] == want else a.unseen[0]
                rest = token[len(a.prefix):]
        for ch in rest:
            kind = next(i for i, cs in enumerate(secret_scan._CLASSES) if ch in cs)
            if (at, kind) in a.steps:
                p, at = p + a.steps[at, kind][1], a.steps[at, kind][0]
            else:
                p += a.unseen[at] - math.log(len(secret_scan._CLASSES[kind]))
        return p + a.ends.get(at, a.unseen[at])

    for token in strings[:20] + ["abzzz", "xb01", "a", "zz9.", "ab"]:
        assert a.score(token) == pytest.approx(brute(token))
    # Without what was never seen the probabilities of all strings sum to one: those of up to sixty characters to nearly one.
    layers, total = {0: 1.0}, 0.0
    for _ in range(60):
        total += sum(p * math.exp(a.ends[s]) for s, p in layers.items() if s in a.ends)
        nxt = {}
        for (s, c), (t, lp) in a.steps.items():
            if s in layers:
                nxt[t] = nxt.get(t, 0) + layers[s] * math.exp(lp) * len(secret_scan._CLASSES[c])
        layers = nxt
    assert total == pytest.approx(1, abs=1e-4)


def test_least_strings_by_hash():
    rng = random.Random(2)
    values = [f"v{rng.randrange(3000)}" for _ in range(20_000)]
    least = secret_scan.Least(50)
    for v in values:
        least.add(v)
    assert sorted(least.values()) == sorted((zlib.crc32(v.encode()), v) for v in set(values))[:50]


def test_tokens_that_touch_spans():
    spans = [(0, 0, 12, ""), (3, 2, 9, ""), (20, 2, 30, "")]
    text = "abcdefghijkl inside__ x" + "y" * 7 + "zzzz freeword"
    got = secret_scan.other_tokens(text, spans)
    want = [(m.start(), m[0], any(s < m.end() and m.start() < e for s, _, e, _ in spans)) for m in secret_scan._TOKEN.finditer(text)
            if not any(s <= m.start() and m.end() <= e for s, _, e, _ in spans)]
    assert got == want and len(got) == 3


def test_language_id(spark):
    rng = np.random.default_rng(5)
    vocab = {"en": "the and with from that have this would there their".split(), "de": "der und nicht eine auch wird über schön straße für".split(),
             "fr": "le les dans une pour qui avec été être où".split()}
    rows = [(i, " ".join(rng.choice(vocab[g], 40)), g, "s") for i, g in enumerate(list(vocab) * 40)]
    out = lang_id.identify(documents(spark, rows + ODD, extra=True)).collect()
    assert len(out) == len(rows) + len(ODD)
    by = [r for r in out if r["held_out"] and r["_row"]["lang"] in vocab and len(r["_row"]["text"] or "") > 60 and r["_row"]["source"] == "s"]
    assert len(by) > 15 and np.mean([r["lang_pred"] == r["_row"]["lang"] for r in by]) >= 0.97
    for r in out:
        letters = any(c.isalpha() for c in r["_row"]["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"], 4, 2)
    assert {r["lang_pred"] for r in lang_id.identify(documents(spark, [(1, "words", None, None)])).collect()} == {"und"}
    assert lang_id.identify(documents(spark, [])).count() == 0


def test_language_filter_keeps_clean_texts(spark):
    rng = np.random.default_rng(6)
    vocab = {"en": "the and with from that have this would there their".split(), "de": "der und nicht eine auch wird über schön straße für".split()}
    rows = [(i, " ".join(rng.choice(vocab[g], rng.integers(30, 60))), g, "s") for i, g in enumerate(list(vocab) * 300)]
    strange = [(5000, "qxzq " * 60, None, "s"), (5001, "жук лес " * 30, None, "s"), (5002, "zzzz" * 60, "en", "s")]
    odd = [(6000 + i, t, None, "s") for i, t in enumerate([None, "", " 12 ", "!?"])]
    docs = documents(spark, rows + strange + odd, extra=True)
    out = lang_id.accepted(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {r[0] for r in rows}
    unknown = documents(spark, [(r[0], r[1], None, r[3]) for r in rows[:5] + strange + odd])
    assert {r["doc_id"] for r in lang_id.accepted(unknown).collect()} == {r[0] for r in rows[:5] + strange}
    assert lang_id.accepted(documents(spark, [])).count() == 0


def test_language_floors_come_from_all_labelled_rows(spark, monkeypatch):
    """More labelled rows than once were looked at: every one counts in its length's mean and deviation."""
    words = ["haus", "baum", "wasser", "tree", "house", "water", "maison", "arbre"]
    rows = [(i, " ".join(words[(i * k) % 8] for k in range(1, 2 + i % 4)), "de" if i % 3 else "fr", None) for i in range(30_000)]
    docs, found, learn = documents(spark, rows), [], lang_id.score_floors

    def kept(*a, **k):
        found.append(learn(*a, **k))
        return found[-1]

    monkeypatch.setattr(lang_id, "score_floors", kept)
    lang_id.accepted(docs).count()
    labelled = docs.filter(lang_id.crc_mod(docs["doc_id"], 4) != 2)
    languages, prototypes = lang_id.train(labelled.select("text", "lang"))
    scored = lang_id.predict(labelled, languages, prototypes).select("score", lang_id.length_class("_row.text").alias("c")).toPandas()
    groups = {int(c): g["score"].to_numpy() for c, g in scored.groupby("c")}
    exact = {c: v.mean() - lang_id.SPREAD * v.std() for c, v in groups.items() if len(v) >= lang_id.FLOOR_LEAST}
    assert len(scored) > 20_000 and len(exact) > 1 and found[0].keys() == exact.keys()
    assert all(abs(found[0][c] - exact[c]) < 1e-9 for c in exact)


def test_bundles_in_slices_and_parts(monkeypatch):
    texts = ["some words of a text", "x" * 40, "", "other words"] * 5
    letters = lang_id.letter_vectors(64)
    codes, doc, _ = lang_id.gram_codes(texts)
    whole = lang_id._bundle(codes, doc, len(texts), letters)
    monkeypatch.setattr(lang_id, "GRAMS", 3)
    assert (lang_id._bundle(codes, doc, len(texts), letters) == whole).all()
    monkeypatch.setattr(lang_id, "CHARS", 30)
    parts = [texts[s] for s in lang_id._parts(texts)]
    assert sum(parts, []) == texts and all(len(p) == 1 or sum(map(len, p)) <= 30 for p in parts) and list(lang_id._parts([])) == []


def test_bundles_are_sums_of_bound_letters():
    texts = ["Ab c", "", "ßx, y!z"]
    letters = lang_id.letter_vectors(64)
    codes, doc, has = lang_id.gram_codes(texts)
    got = lang_id._bundle(codes, doc, 3, letters)
    for i, t in enumerate(texts):
        s = [0] + [int(lang_id._symbols()[ord(c)]) for c in t] + [0]
        s = [x for j, x in enumerate(s) if x or not j or s[j - 1]]
        want = sum((np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c] for a, b, c in zip(s, s[1:], s[2:])), np.zeros(64))
        assert (got[i] == want).all() and has[i] == any(c.isalpha() for c in t)


def brute_katz(rows):
    """(n_tokens, n_known, N, base, score) per row, and the model's P(word | history)."""
    toks = [(d, held(d, 5, 1), words(t) + ["</s>"]) for d, t in rows]
    c1 = Counter(w for _, h, t in toks if not h for w in t)
    c2, hist = Counter(), Counter()
    for _, h, t in toks:
        if not h:
            for a, b in zip(["<s>"] + t, t):
                c2[a, b] += 1
                hist[a] += 1
    total = sum(c1.values())

    def numbers(c):
        x = Counter(c.values())
        return [x[i] for i in range(1, 7)]

    d1, d2 = katz.discounts(numbers(c1)), katz.discounts(numbers(c2))
    kept = sum((d1[c] if c <= 5 else 1) * c for c in c1.values())
    scale, unknown = (total, (total - kept) / total) if total - kept > 1e-9 else (total + 1, 1 / (total + 1))
    p1 = lambda w: (d1[c1[w]] if c1[w] <= 5 else 1) * c1[w] / scale if c1[w] else unknown
    spent, lower = defaultdict(float), defaultdict(float)
    for (a, b), c in c2.items():
        if c >= 1:
            spent[a] += (d2[c] if c <= 5 else 1) * c
            lower[a] += p1(b)

    def p2(a, b):
        if not hist[a]:
            return p1(b)
        n = hist[a] + (hist[a] - spent[a] <= 1e-9 * hist[a])
        c = c2[a, b]
        return (d2[c] if c <= 5 else 1) * c / n if c >= 1 else (1 - spent[a] / n) / (1 - lower[a]) * p1(b)

    for a in list(hist)[:20]:
        assert abs(sum(p2(a, w) for w in c1) + p2(a, "\0") - 1) < 1e-9
    den = math.log10(total + 0.5 * (len(c1) + 1))
    return sorted(((str(d), h, len(t), sum(c1[w] > 0 for w in t), total, round(sum(math.log10(c1[w] + 0.5) - den for w in t), 6),
                    round(sum(math.log10(p2(a, b)) for a, b in zip(["<s>"] + t, t)), 6)) for d, h, t in toks))


@pytest.mark.parametrize("rows", [[r[:2] for r in ODD], [(i, " ".join(f"w{(i * j * j) % (7 + i % 13)}" for j in range(1, 60))) for i in range(80)],
                                  [(1, "a b a b"), (2, "a b a b")]])
def test_katz_against_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(katz, "HOT_SHARE", 1 / 20)
    got = katz.score(documents(spark, rows, extra=True)).collect()
    found = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    want = brute_katz(rows)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    for f, w in zip(found, want):
        assert f[5:] == pytest.approx(w[5:], abs=1e-5)


def test_katz_table_lists_every_training_bigram(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 11}" for j in range(1, 30))) for i in range(40)]
    kept = []
    stored = katz.stored
    monkeypatch.setattr(katz, "stored", lambda df, name, **k: (kept.append((name, stored(df, name, **k))), kept[-1][1])[1])
    katz.score(documents(spark, rows)).count()
    table = dict(kept)["ngrams_2"].filter(f"block = {katz.MODEL}").collect()
    counts = sorted(c for r in table for c in katz.unpack_pairs(r["keys"], r["counts"])[2].tolist())
    want = Counter(p for d, t in rows if not held(d, 5, 1) for p in zip(["<s>"] + words(t), words(t) + ["</s>"]))
    assert counts == sorted(want.values()) and 1 in counts


def test_katz_without_training_rows_and_empty(spark):
    only = next(i for i in range(50) if held(i, 5, 1))
    r = katz.score(documents(spark, [(only, "a b")])).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and r["score"] == 0 and r["base_score"] == 0
    assert katz.score(documents(spark, [])).count() == 0


def test_discounts_fall_back():
    assert katz.discounts([0] * 6)[1] == 0.5
    d = katz.discounts([100, 40, 22, 14, 10, 7])
    assert ((d > 0) & (d <= 1)).all()
    assert (katz.discounts([184712, 23127, 5984, 1951, 2262, 607]) <= 1).all()
