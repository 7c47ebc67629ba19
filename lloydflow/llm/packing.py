"""Best-fit packing of documents into sequences by linear grouping.

Lengths are integers of at most the capacity, so the number of pieces of each
length is an exact and bounded statistic (at most ``capacity`` rows).  From it
the driver makes a plan: large lengths are grouped by equal cardinality and
rounded up to the longest of their group, a linear programme over the few
rounded sizes (column generation) chooses how often each configuration is used,
actual lengths are substituted, and what is left is best-fit, longest first,
into the room that remains.  The plan says, for the i-th piece of each length,
its sequence and its place; the pieces look it up where they are.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cell_index, stored, table
from .tokenize import CACHE_ENTRIES, encoded

CAPACITY = 1024
#: Groups of the large lengths; lengths up to CAPACITY // SMALL_PART are small.
GROUPS, SMALL_PART = 40, 8
#: Room up to which a substituted configuration may be kept; the plan with the fewest sequences wins.
KEEP_ROOM = (0, 2, 5, 10, 20, 40, 80, 160)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, entries: int = CACHE_ENTRIES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut where they exceed ``capacity``.

    A document is its ids and the end id.  Of a longer one the first piece holds
    the remainder, all others are full.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            return out.assign(doc_id=out["doc_id"].astype("Int64"))

        for (d,), data in encoded(batches, ["doc_id"], tokenizer, entries):
            data = memoryview(data)
            n, at, k = len(data) // 4, 0, 0
            size = n % capacity or capacity
            while at < n:
                rows.append((d, k, at, size, zlib.crc32(data[4 * at:4 * (at + size)])))
                at, k, size = at + size, k + 1, capacity
            if len(rows) >= 50_000:
                yield frame()
                rows.clear()
        if rows:
            yield frame()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long"))


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, count per size) from the linear programme, rounded down.

    Column generation: the basis starts with one configuration per size; each
    round prices the best configuration by a knapsack over the capacity.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    weight = np.array(sizes)
    for _ in range(60 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(weight.min()), capacity + 1):
            worth = np.where(weight <= c, best[np.maximum(c - weight, 0)] + price, -1.0)
            j = int(worth.argmax())
            best[c], pick[c] = best[c - 1], -1
            if worth[j] > best[c] + 1e-12:
                best[c], pick[c] = worth[j], j
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if pick[c] < 0:
                c -= 1
            else:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        level, change = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    times = np.floor(np.linalg.solve(basis, need) + 1e-6).astype(np.int64)
    left, chosen = list(demand), []
    for j in range(k):
        counts = basis[:, j].round().astype(np.int64).tolist()
        t = min([int(times[j])] + [left[g] // a for g, a in enumerate(counts) if a])
        if t > 0:
            chosen.append((t, counts))
            left = [x - t * a for x, a in zip(left, counts)]
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, list[int]]]:
    """(number of sequences, their lengths) for all pieces shorter than ``capacity``.

    Its work depends on the capacity and the number of groups, not on the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if 0 < n < capacity and c > 0}
    large = sorted((n for n in left if n > capacity // SMALL_PART), reverse=True)
    total = sum(left[n] for n in large)
    each = -(-total // groups) if total else 1
    # Equal cardinality: group g holds the pieces of ranks g * each to (g + 1) * each, longest first.
    members: list[list[list[int]]] = []  # per group: [length, count]
    rank = 0
    for n in large:
        c = left[n]
        while c:
            if rank % each == 0:
                members.append([])
            t = min(c, each - rank % each)
            members[-1].append([n, t])
            rank, c = rank + t, c - t
    # Groups that round to one size are one size of the programme.
    rounded: dict[int, list[list[int]]] = {}
    for m in members:
        rounded.setdefault(m[0][0], []).extend(m)
    sizes = list(rounded)
    queues = [rounded[s] for s in sizes]
    bins: list[tuple[int, list[int]]] = []
    for times, counts in _configurations(sizes, [sum(c for _, c in q) for q in queues], capacity):
        # Substitute actual lengths: each slot takes the next pieces of its group.
        slots: list[list[list[int]]] = []
        for g, a in enumerate(counts):
            for _ in range(a):
                run, need = [], times
                while need:
                    n, c = queues[g][0]
                    t = min(c, need)
                    run.append([n, t])
                    need -= t
                    if t == c:
                        queues[g].pop(0)
                    else:
                        queues[g][0][1] -= t
                slots.append(run)
        for run in slots:
            for n, t in run:
                left[n] -= t
        while slots and slots[0]:
            t = min(run[0][1] for run in slots)
            bins.append((t, [run[0][0] for run in slots]))
            for run in slots:
                run[0][1] -= t
                if not run[0][1]:
                    run.pop(0)
    # A substituted configuration with much room is worth less than its pieces
    # are to best fit: try several limits of room and keep the best plan.
    plans = []
    for limit in KEEP_ROOM:
        kept, rest = [], dict(left)
        for t, lengths in bins:
            if capacity - sum(lengths) <= limit:
                kept.append((t, lengths))
            else:
                for n in lengths:
                    rest[n] += t
        plans.append(_best_fit(kept, rest, capacity))
    return min(plans, key=lambda p: sum(t for t, _ in p))


def _best_fit(bins: list[tuple[int, list[int]]], left: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """``bins`` with the ``left`` pieces (length -> count) added best-fit, longest first."""
    room: dict[int, list[tuple[int, list[int]]]] = {}
    rooms: list[int] = []  # sorted residuals that have sequences

    def put(t: int, lengths: list[int]) -> None:
        r = capacity - sum(lengths)
        if r not in room:
            room[r] = []
            bisect.insort(rooms, r)
        room[r].append((t, lengths))

    for t, lengths in bins:
        put(t, lengths)
    for n in sorted((n for n in left if left[n]), reverse=True):
        c = left[n]
        while c:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                full, rest = divmod(c, capacity // n)
                if full:
                    put(full, [n] * (capacity // n))
                if rest:
                    put(1, [n] * rest)
                break
            r = rooms[at]
            t, lengths = room[r].pop()
            if not room[r]:
                del room[r]
                rooms.pop(at)
            k = r // n
            use = min(t, c // k)
            if use:
                put(use, lengths + [n] * k)
                if t > use:
                    put(t - use, lengths)
                c -= use * k
            else:  # fewer than one sequence takes
                put(1, lengths + [n] * c)
                if t > 1:
                    put(t - 1, lengths)
                c = 0
    return [x for r in rooms for x in room[r]]


def _lookup(bins: list[tuple[int, list[int]]]):
    """Sorted keys (length << 40 | first index) with the sequence and the offset of that index; the number of sequences."""
    rows, taken, first = [], {}, 0
    for t, lengths in bins:
        offset = 0
        for n in lengths:
            i = taken.get(n, 0)
            rows.append(((n << 40) + i, first, offset))
            taken[n] = i + t
            offset += n
        first += t
    rows.sort()
    return (*(np.array([r[j] for r in rows], np.int64) for j in range(3)), first)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, entries: int = CACHE_ENTRIES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    Null and empty texts are one end id.  Rows that repeat a doc_id are packed
    each for itself.  Null doc_ids stay null.  An empty table gives no rows;
    other columns are not read.  Every sequence is filled gaplessly from 0.  ``entries`` bounds the
    words that a Python worker keeps encoded (about 200 bytes each).
    """
    cut = stored(pieces(docs, capacity, tokenizer, entries), "pieces")
    # At most ``capacity`` rows.
    histogram = {int(n): int(c) for n, c in cut.groupBy("length").count().collect()}
    keys, firsts, offsets, n_bins = _lookup(plan_bins(histogram, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length, i = b["length"].to_numpy(), b.pop("_i").to_numpy()
            if len(keys):
                at = np.maximum(np.searchsorted(keys, (length << 40) + i, "right") - 1, 0)
                seq, off = firsts[at] + (length << 40) + i - keys[at], offsets[at]
            else:
                seq = off = np.zeros(len(b), np.int64)
            full = length == capacity
            yield b.assign(sequence_id=np.where(full, n_bins + i, seq), offset=np.where(full, 0, off), doc_id=b["doc_id"].astype("Int64"))

    indexed = cell_index(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "_i")
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return indexed.select("doc_id", "piece", "start", "length", "ids_crc32", "_i").mapInPandas(
        place, fields + ", sequence_id long, offset long")


def op9_best_fit_packing(spark, sf_dir) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))
