"""Token ids of whole texts with a public tokenizer, cached by word.

The byte-level pattern of the tokenizer never lets a token cross a single space
or line end that stands between two visible characters.  So a text whose spaces
and line ends are all of that kind may be cut there and its words encoded
alone.  Words repeat, so each worker keeps a bounded table of encoded words, and
the words that a batch of texts adds to it are encoded together.  Other texts
go to the library whole.  Both ways give the library's ids.
"""

from __future__ import annotations

import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
#: Most words kept by one Python worker; what a batch needs beyond it lives as long as the batch.
CACHE_ENTRIES = 500_000
#: New words that go to the library in one call.
BULK = 2000

END_BYTES = np.array([END_ID], "<u4").tobytes()
# Stops after a letter: the library's pattern always cuts between the two.
_STOPS = ".,;:!?"


def tokenizer_path(path: str | None = None) -> str:
    """The tokenizer file: ``path``, or the installed public byte-level vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# The last letter that the library's pattern and Python surely agree on as one.
_LATIN = "\u024f"
# Byte-level vocabularies write a byte as a letter: printable ones as themselves, the others as U+0100 and up, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE = chr(_BYTE_LETTERS[32])


class _Words(dict):
    """word -> its ids as little-endian uint32 bytes.

    A word stands for itself after a space; one that starts with a line end, for the line end
    and itself.
    """

    def __init__(self, tokenizer, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.tokenizer, self.entries, self.spare, self.tails = tokenizer, entries, {}, {}

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def keep(self, word: str, ids: bytes) -> bytes:
        (self if len(self) < self.entries else self.spare)[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        if word in self.spare:
            return self.spare[word]
        stem = word.rstrip(_STOPS)
        if len(stem) < len(word) and stem[-1:].isalpha():
            tail = word[len(stem):]
            if tail not in self.tails:
                self.tails[tail] = self.raw(tail)
            return self[stem] + self.tails[tail]
        return self.keep(word, self.raw(word if word[0] == "\n" else " " + word))

    def learn(self, words: list[str]) -> None:
        """Encode the new words of a batch: Latin letters by the library's model alone, other letters many to a call."""
        self.spare.clear()
        new = [w for w in {w.rstrip(_STOPS) for w in words} if w not in self]
        lead, tokenize, rest = self.raw("\n"), self.tokenizer.model.tokenize, []
        for w in new:
            letters = w[1:] if w[:1] == "\n" else w
            if not letters.isalpha():
                continue  # one by one, when asked for
            if letters.isascii():  # ASCII letters stand for themselves
                mapped = letters
            elif max(letters) > _LATIN:
                rest.append(w)
                continue
            else:
                mapped = letters.encode().decode("latin-1").translate(_BYTE_LETTERS)
            self.keep(w, _packed(tokenize(_SPACE + mapped)) if letters is w else lead + _packed(tokenize(mapped)))
        for mark, some in ((" ", [w for w in rest if w[0] != "\n"]), ("\n", [w for w in rest if w[0] == "\n"])):
            for at in range(0, len(some), BULK):
                part = some[at:at + BULK]
                enc = self.tokenizer.encode(" " + " ".join(part) if mark == " " else "".join(part), add_special_tokens=False)
                ids, of = np.array(enc.ids, "<u4"), np.array(enc.word_ids)
                cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(ids)]
                if mark == "\n":  # the line end is a token of its own, before each word
                    cuts = cuts[::2]
                if len(cuts) == len(part) + 1:  # else the words go to the library one by one
                    raw = ids.tobytes()
                    for w, a, b in zip(part, cuts, cuts[1:]):
                        self.keep(w, raw[4 * a:4 * b])


def _packed(tokens) -> bytes:
    return array("I", [t.id for t in tokens]).tobytes()


def _process_store() -> dict:
    """What one Python process keeps between its tasks (this module is shipped by value, so its globals are per task)."""
    return sys.modules["tokenizers"].__dict__.setdefault("_kept_encoders", {})


def encoder(path: str | None = None, entries: int = CACHE_ENTRIES):
    """A function texts -> each text's ids and the end id (little-endian uint32); null texts are empty.

    The words of a batch of texts are cut and told apart by Arrow, each different one is looked
    up once, and all ids are gathered by their offsets.
    """
    path = tokenizer_path(path)
    from tokenizers import Tokenizer

    kept = _process_store()
    if (path, entries) not in kept:
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True  # their strings in a text are ordinary text
        # The cutting rule belongs to the byte-level pattern; other tokenizers get whole texts.
        byte_level = tok.normalizer is None and str(tok.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False")
        kept[path, entries] = (_Words(tok, entries), byte_level)
    words, byte_level = kept[path, entries]

    def encode(texts: list) -> list[memoryview]:
        if not byte_level:
            return [memoryview(words.raw(t) + END_BYTES if t else END_BYTES) for t in texts]
        # Every word's mark: a line end of its own, or (not written) the space before it.
        pieces = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") if t else "\n" for t in texts], pa.large_string()), " ")
        coded = pieces.flatten().dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        begin = np.asarray(pieces.offsets, np.int64) - pieces.offsets[0].as_py()
        ids = [*map(words.get, distinct)]
        # An empty word, or one with white space at an end: the text has white space side by side, or at an end.
        new = [i for i, raw in enumerate(ids) if raw is None]
        loose = np.zeros(len(distinct), bool)
        loose[[i for i in new if not (w := distinct[i]).isalnum() and (w in ("", "\n") or w[w[0] == "\n":].strip() != w[w[0] == "\n":])]] = True
        empty = np.array([not t for t in texts], bool)
        whole = np.logical_or.reduceat(loose[at], begin[:-1]) & ~empty if loose.any() else np.zeros(len(texts), bool)
        learnt = [i for i in new if not loose[i]]
        words.learn([distinct[i] for i in learnt])
        for i in learnt:
            ids[i] = words[distinct[i]]
        lead = words.raw("\n")
        # Words that only such texts hold are not looked up; an empty text is its mark alone.
        for i in np.flatnonzero(loose):
            ids[i] = lead
        ids.append(END_BYTES)
        # A text has fewer than 2 ** 31 ids, so 32 bits index them.
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        at = np.insert(at, begin[1:], len(ids) - 1)  # the end id after each text
        begin = begin + np.arange(len(begin))
        count = sizes[at]
        out = np.cumsum(count, dtype=np.int32)
        source = np.repeat(starts[at] - out + count, count)
        source += np.arange(len(source), dtype=np.int32)
        raw = memoryview(flat[source].tobytes())
        edge = np.concatenate(([0], out)).astype(np.int64)[begin] * 4
        del pieces, coded, at, count, out, source
        skip = len(lead)
        return [memoryview(words.raw(t) + END_BYTES) if w else raw[a + skip:b] if t else raw[b - 4:b]
                for t, w, a, b in zip(texts, whole.tolist(), edge[:-1].tolist(), edge[1:].tolist())]

    return encode


#: Texts that are encoded together.
TEXTS, CHARS = 1500, 1 << 21


def encoded(batches, columns: list[str], path: str | None = None, entries: int = CACHE_ENTRIES, texts_at_once: int = TEXTS, chars: int = CHARS):
    """(values of ``columns``, ids with the end id) of every row of pandas batches with a text column."""
    enc = encoder(path, entries)
    for batch in batches:
        texts = [t if isinstance(t, str) else None for t in batch["text"].tolist()]
        values = list(zip(*(batch[c].tolist() for c in columns)))
        for at in cuts(texts, texts_at_once, chars):
            yield from zip(values[at], enc(texts[at]))


def cuts(texts: list, most: int = TEXTS, most_chars: int = CHARS) -> list[slice]:
    """Runs of at most ``most`` texts and about ``most_chars`` code points; a longer text is a run of its own."""
    out, start, chars = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (i - start >= most or chars + n > most_chars):
            out.append(slice(start, i))
            start, chars = i, 0
        chars += n
    return [*out, slice(start, len(texts))] if len(texts) > start else out
