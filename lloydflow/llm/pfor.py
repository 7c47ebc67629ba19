"""Token ids in patched frame-of-reference files.

A file image holds whole documents in order.  Its ids are cut into blocks of
``BLOCK`` ids; a block stores its minimum, the width that covers the chosen
percentile of (id - minimum), the packed low bits and a list of exceptions
(position, high bits) for ids that need more.  An index of block starts gives
access to a single block.  Images are the rows of a Parquet table, whose
commit protocol keeps half-written files of lost executors out.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .tokenize import encoded

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 90
#: An image is closed when it holds this many ids (a longer document makes a longer image).
IMAGE_IDS = 1 << 18
#: Words that a worker keeps encoded, texts and code points that are encoded together: there is room beside the images.
KEPT_WORDS, TEXTS, CHARS = 1_000_000, 3000, 1 << 22


def _pack_bits(values: np.ndarray, w: int) -> np.ndarray:
    """Rows of ``BLOCK`` values of ``w`` bits as bytes, lowest bit first: eight values fill ``w`` bytes."""
    kind = np.uint32 if w <= 25 else np.uint64  # a value and its shift span at most w + 7 bits
    eights = np.ascontiguousarray(values.reshape(-1, 8).T).astype(kind)
    planes = np.zeros((w, eights.shape[1]), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * w, 8)
        v = eights[k] << kind(shift)
        for j in range(byte, min(w, byte + (shift + w + 7) // 8)):
            planes[j] |= (v >> kind(8 * (j - byte))).astype(np.uint8)
    return planes.T.reshape(len(values), BLOCK * w // 8)


def _unpack_bits(body: np.ndarray, w: int) -> np.ndarray:
    """The values of such rows."""
    planes = np.ascontiguousarray(body.reshape(-1, w).T)
    out = np.empty((8, planes.shape[1]), np.uint32)
    kind = np.uint32 if w <= 25 else np.uint64  # a value and its shift span at most w + 7 bits
    mask = kind((1 << w) - 1)
    for k in range(8):
        byte, shift = divmod(k * w, 8)
        v = np.zeros(planes.shape[1], kind)
        for j in range(byte, min(w, byte + (shift + w + 7) // 8)):
            v |= planes[j].astype(kind) << kind(8 * (j - byte))
        out[k] = (v >> kind(shift)) & mask
    return out.T.reshape(len(body), BLOCK)


def pack(ids: np.ndarray) -> bytes:
    """ids (uint32) as blocks: header, index of block starts, blocks."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = ids[-1]
    rows = padded.reshape(n_blocks, BLOCK)
    base = rows.min(axis=1) if n else np.empty(0, np.uint32)
    rest = rows - base[:, None]
    k = BLOCK * PERCENTILE // 100 - 1
    at = np.partition(rest, k, axis=1)[:, k] if n else np.empty(0, np.uint32)
    width = np.ceil(np.log2(at.astype(np.float64) + 1)).astype(np.uint8)
    limit = (np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)
    over = rest > limit[:, None]
    low = (rest & limit[:, None].astype(np.uint32)).astype("<u4")
    packed: list = [b""] * n_blocks
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        if w:
            for i, b in zip(of, _pack_bits(low[of], int(w))):
                packed[i] = b.tobytes()
    n_over = over.sum(axis=1).astype(np.uint16)
    where = np.nonzero(over)
    positions = where[1].astype(np.uint8)
    high = (rest[where] >> width[where[0]].astype(np.uint32)).astype("<u4")
    ends = np.cumsum(n_over, dtype=np.int64)
    starts, parts, at_byte = np.empty(n_blocks, "<u8"), [], 0
    for i in range(n_blocks):
        a, b = int(ends[i] - n_over[i]), int(ends[i])
        block = struct.pack("<IBH", int(base[i]), int(width[i]), b - a) + packed[i] + positions[a:b].tobytes() + high[a:b].tobytes()
        starts[i] = at_byte
        at_byte += len(block)
        parts.append(block)
    return struct.pack("<QI", n, n_blocks) + starts.tobytes() + b"".join(parts)


def unpack(data: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """The ids of ``count`` blocks from block ``first`` (all by default)."""
    n, n_blocks = struct.unpack_from("<QI", data)
    starts = np.frombuffer(data, "<u8", n_blocks, 12)
    body = 12 + 8 * n_blocks
    last = n_blocks if count is None else min(n_blocks, first + count)
    raw = np.frombuffer(data, np.uint8)
    begins = starts[first:last].astype(np.int64) + body
    heads = raw[begins[:, None] + np.arange(7)]
    bases, widths = np.ascontiguousarray(heads[:, :4]).view("<u4")[:, 0], heads[:, 4]
    n_over = np.ascontiguousarray(heads[:, 5:]).view("<u2")[:, 0].astype(np.int64)
    begins += 7
    out = np.zeros((len(heads), BLOCK), np.uint32)
    for w in np.unique(widths):
        if w:
            of = np.flatnonzero(widths == w)
            out[of] = _unpack_bits(raw[begins[of][:, None] + np.arange(BLOCK * int(w) // 8)], int(w))
    block = np.repeat(np.arange(len(heads)), n_over)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
    lists = (begins + BLOCK * widths.astype(np.int64) // 8)[block]  # positions, then high bits
    high = np.ascontiguousarray(raw[(lists + n_over[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    out[block, raw[lists + nth]] |= high << widths[block].astype(np.uint32)
    out += bases[:, None]
    end = n if last == n_blocks else last * BLOCK
    return out.reshape(-1)[: end - first * BLOCK]


def image(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """A file image: magic, documents (id, null flag, length), packed ids."""
    null = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([MAGIC, struct.pack("<I", len(doc_ids)), known.tobytes(), null.tobytes(),
                     np.array(lengths, "<u8").tobytes(), pack(ids)])


def read_image(data: bytes):
    """(doc_ids, lengths, ids) of a file image."""
    if data[:4] != MAGIC:
        raise ValueError("not a token file image")
    (n,) = struct.unpack_from("<I", data, 4)
    known = np.frombuffer(data, "<i8", n, 8)
    null = np.frombuffer(data, np.uint8, n, 8 + 8 * n)
    lengths = np.frombuffer(data, "<u8", n, 8 + 9 * n)
    return [None if z else int(d) for d, z in zip(known, null)], lengths, unpack(data[8 + 17 * n:])


def write_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The token files of ``docs`` in ascending doc_id order, as the written table (part, seq, n_ids, data).

    Texts are dealt by ranges of doc_id and sorted before they are encoded, so
    (part, seq) is the files' order.  Null texts are empty, null doc_ids come
    first, rows with one doc_id stand in the order of their texts; an empty table
    gives no file.  Other columns are not read.
    """
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, lengths, chunks, n = [], [], [], 0

        def close() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(chunks), "<u4")
            return pd.DataFrame({"part": [part], "seq": [seq], "n_ids": [n], "data": [image(doc_ids, lengths, ids)]})

        for (d,), data in encoded(batches, ["doc_id"], tokenizer, KEPT_WORDS, TEXTS, CHARS):
            doc_ids.append(None if d is None or d != d else int(d))
            lengths.append(len(data) // 4)
            chunks.append(data)
            n += lengths[-1]
            if n >= IMAGE_IDS:
                yield close()
                doc_ids, lengths, chunks, n, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield close()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return stored(ordered.mapInPandas(encode, "part int, seq int, n_ids long, data binary"), "tokens")


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    # Shifts: over the parts (one row each), then over the files of a part.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_p"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (files.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("_s"))
              .join(parts, "part").select("part", "seq", (F.col("_p") + F.col("_s")).alias("_start")))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, seq, data in zip(batch["part"], batch["seq"], batch["data"]):
                doc_ids, lengths, ids = read_image(data)
                ends = np.cumsum(lengths.astype(np.int64))
                begins = ends - lengths.astype(np.int64)
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                yield pd.DataFrame({
                    "part": part, "seq": seq, "doc_id": pd.array(doc_ids, "Int64"), "_rel": begins, "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins, ends)]})

    docs = files.select("part", "seq", "data").mapInPandas(
        decode, "part int, seq int, doc_id long, _rel long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("_start") + F.col("_rel")).alias("start"), "n_tokens", "ids_crc32")


def op8_pfor_tokens(spark, sf_dir) -> DataFrame:
    """All documents' ids written to token files and read back."""
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")))
