"""Secret scan: fixed patterns, and probabilistic automata inferred from what they find.

The strings that the patterns label are the examples.  Per kind, their prefix
tree over character classes is generalised by merging states whose final and
outgoing frequencies are statistically compatible (Hoeffding bound, with
recursion into the common subtrees).  A further automaton is inferred from
other tokens.  Every token as long as a labelled credential may be is a candidate.  It is a
secret of a kind if that kind's automaton finds its format as likely, per character, as that of
the labelled examples (their low percentile, less ``SLACK``), and explains it better than
the background does, by ``LEAST_GAIN``.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

KINDS = ("assign", "access", "hex")
#: The labelled sample: distinct strings per kind, and background tokens, by smallest hash.
EXAMPLES, BACKGROUND = 600, 6000
#: Shortest candidate token (and labelled credential); confidence of the merge test; the examples' percentile that a
#: candidate's log-likelihood per character must reach, less some slack, and the least log-odds against the background.
CANDIDATE, ALPHA, PERCENTILE, SLACK, LEAST_GAIN = 6, 0.05, 2, 0.5, math.log(1000)

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# The lengths asked of a run are part of these patterns: a run that is too short has no longer match inside.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % CANDIDATE)

_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-", ".", "=")
_CLASS_OF = {c: i for i, cs in enumerate(_CLASSES) for c in cs}
_WITHIN = [-math.log(len(cs)) for cs in _CLASSES]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) of the fixed patterns, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= CANDIDATE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def other_tokens(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, str, bool]]:
    """(start, token, touches a span) of the tokens that do not lie within one span."""
    starts, furthest, top = [], [], -1
    for start, _, end, _ in spans:  # by start
        top = max(top, end)
        starts.append(start)
        furthest.append(top)
    out = []
    for m in _TOKEN.finditer(text):
        if not starts:
            out.append((m.start(), m[0], False))
            continue
        i = bisect_right(starts, m.start()) - 1
        if i < 0 or furthest[i] < m.end():  # no span that begins before the token reaches its end
            j = bisect_left(starts, m.end()) - 1
            out.append((m.start(), m[0], j >= 0 and furthest[j] > m.start()))
    return out


class Least:
    """The ``k`` distinct strings of smallest hash."""

    def __init__(self, k: int):
        self.k, self.kept, self.limit = k, {}, 1 << 32

    def add(self, value: str) -> None:
        h = zlib.crc32(value.encode())
        if h <= self.limit:
            self.kept[value] = h
            if len(self.kept) > 4 * self.k:
                self._cut()

    def _cut(self) -> None:
        self.kept = dict(sorted(self.kept.items(), key=lambda x: (x[1], x[0]))[:self.k])
        if len(self.kept) == self.k:
            self.limit = max(self.kept.values())

    def values(self) -> list[tuple[int, str]]:
        self._cut()
        return [(h, v) for v, h in self.kept.items()]


class Automaton:
    """Probabilistic automaton over character classes, inferred by state merging."""

    def __init__(self, strings: list[str]):
        self.count, self.final, self.next, self.freq = [0], [0], [{}], [{}]
        # What all examples begin with is part of the format, letter by letter.
        self.prefix = os.path.commonprefix(strings)
        for s in strings:
            at = 0
            self.count[0] += 1
            for ch in s[len(self.prefix):]:
                c = _CLASS_OF[ch]
                if c not in self.next[at]:
                    self.next[at][c] = len(self.count)
                    self.count.append(0)
                    self.final.append(0)
                    self.next.append({})
                    self.freq.append({})
                self.freq[at][c] = self.freq[at].get(c, 0) + 1
                at = self.next[at][c]
                self.count[at] += 1
            self.final[at] += 1
        self._infer()

    def _compatible(self, a: int, b: int) -> bool:
        pairs, width = [(a, b)], math.sqrt(0.5 * math.log(2 / ALPHA))
        while pairs:
            a, b = pairs.pop()
            n, m = self.count[a], self.count[b]
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m)) if n and m else 1
            if a == b or bound >= 1:
                continue  # too few strings to tell, here and in everything below
            if abs(self.final[a] / n - self.final[b] / m) > bound:
                return False
            for c in {*self.freq[a], *self.freq[b]}:
                if abs(self.freq[a].get(c, 0) / n - self.freq[b].get(c, 0) / m) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    pairs.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the state a."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.count[a] += self.count[b]
            self.final[a] += self.final[b]
            for c, child in self.next[b].items():
                self.freq[a][c] = self.freq[a].get(c, 0) + self.freq[b][c]
                if c in self.next[a]:
                    pairs.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _infer(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = [(self.count[t], r, c, t) for r in red for c, t in self.next[r].items() if t not in known]
            if not blue:
                break
            _, parent, c, state = max(blue, key=lambda x: (x[0], -x[3]))
            home = next((r for r in red if self._compatible(r, state)), None)
            if home is None:
                red.append(state)
            else:
                self.next[parent][c] = home
                self._fold(home, state)
        self.steps = {(s, c): (t, math.log(self.freq[s][c] / self.count[s]) + _WITHIN[c]) for s in red for c, t in self.next[s].items()}
        self.ends = {s: math.log(self.final[s] / self.count[s]) for s in red if self.final[s]}
        # What a state has never seen counts as half a string.
        self.unseen = {s: math.log(0.5 / (self.count[s] + 0.5 * len(_CLASSES))) for s in red}
        del self.count, self.final, self.next, self.freq

    def walk(self, token: str) -> tuple[float, float]:
        """log-probability of the token's characters, and of its end there.

        A class or an end that the state has never seen, and each letter that is not the common
        prefix's, costs ``unseen`` and leaves the state as it is.
        """
        at, total = 0, 0.0
        if not token.startswith(self.prefix):
            total = self.unseen[0] * (len(self.prefix) - sum(a == b for a, b in zip(token, self.prefix)))
        for ch in token[len(self.prefix):]:
            c = _CLASS_OF[ch]
            step = self.steps.get((at, c))
            if step:
                at, total = step[0], total + step[1]
            else:
                total += self.unseen[at] + _WITHIN[c]
        return total, self.ends.get(at, self.unseen[at])

    def score(self, token: str) -> float:
        """log-probability of the token."""
        return sum(self.walk(token))


def infer(examples: dict[str, list[str]], background: list[str]):
    """(automaton of the background, {kind: (automaton, least log-likelihood per character)}) from labelled strings.

    Unlabelled secrets are among the other tokens, so the background is inferred twice: the second
    time without those that a kind explains better than the first.
    """
    found = {}
    for kind, strings in examples.items():
        if strings:
            a = Automaton(strings)
            found[kind] = (a, float(np.percentile([a.walk(s)[0] / len(s) for s in strings], PERCENTILE)) - SLACK)
    ground = Automaton(background)
    plain = [t for t in background if verdict(t, ground, found, 0.0)[0] < 0]
    return Automaton(plain) if plain else ground, found


def verdict(token: str, ground: Automaton, automata: dict, least: float = LEAST_GAIN) -> tuple[int, float]:
    """(index of the kind that the token is of, its log-odds against the background); -1 if of none."""
    plain, best = ground.score(token), (-1, 0.0)
    for i, k in enumerate(KINDS):
        if k in automata:
            body, end = automata[k][0].walk(token)
            gain = body + end - plain
            if gain >= least and gain > best[1] and body >= automata[k][1] * len(token):
                best = (i, gain)
    return best


def labelled_sample(texts: DataFrame, examples: int = EXAMPLES, background: int = BACKGROUND) -> tuple[dict[str, list[str]], list[str]]:
    """({kind: credentials}, other tokens): the distinct ones of smallest hash over all ``texts``.

    Each task sends its own smallest, so no more than the bounds leaves it.
    """
    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [Least(examples) for _ in KINDS] + [Least(background)]
        for b in batches:
            for t in b["text"]:
                if t:
                    spans = base_spans(t)
                    for _, k, _, value in spans:
                        kept[k].add(value)
                    for _, token, touches in other_tokens(t, spans):
                        if not touches:
                            kept[-1].add(token)
        yield pd.DataFrame([(k, h, v) for k, some in enumerate(kept) for h, v in some.values()], columns=["kind", "h", "value"])

    found = stored(texts.select("text").mapInPandas(least, "kind int, h long, value string").distinct(), "labelled", light=True)
    picked = [[r[0] for r in found.filter(F.col("kind") == k).orderBy("h", "value").limit(n).select("value").collect()]
              for k, n in enumerate([examples] * len(KINDS) + [background])]
    return dict(zip(KINDS, picked)), picked[-1]


def scan(docs: DataFrame, examples: int = EXAMPLES, background: int = BACKGROUND) -> DataFrame:
    """(doc_id, base, found): one row per row of ``docs``.

    ``base`` and ``found`` are arrays of (start, kind, end, score), in code points with
    exclusive end, of the fixed patterns and of the further tokens that an automaton
    recognises; such a token may reach beyond a fixed span, which stays beside it.  On equal
    gains the kind that is listed first wins.  Null texts are empty, very long ones are scanned
    whole.  Rows that repeat a doc_id are scanned each for itself.  A kind without
    a labelled string gives no further spans, and an empty table no rows.  Other columns are not read.
    """
    ground, automata = infer(*labelled_sample(docs, examples, background))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, float]] = {}

        for b in batches:
            base, found = [], []
            for t in b["text"].tolist():
                spans = base_spans(t or "")
                base.append([{"start": s, "kind": k, "end": e, "score": None} for s, k, e, _ in spans])
                more = []
                for start, token, _ in other_tokens(t or "", spans):
                    if token not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[token] = verdict(token, ground, automata)
                    kind, gain = known[token]
                    if kind >= 0:
                        more.append({"start": start, "kind": kind, "end": start + len(token), "score": gain})
                found.append(more)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "base": base, "found": found})

    span = "array<struct<start:long,kind:int,end:long,score:double>>"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInPandas(judge, f"doc_id long, base {span}, found {span}")


def op3_secret_scan(spark, sf_dir) -> DataFrame:
    """Secrets in every document: counts and digests of the spans."""
    out = scan(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(c):
        return F.array_join(F.transform(F.sort_array(c), lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      joined(F.concat("base", "found")).alias("spans"))
