"""Best-fit packing of token sequences by a linear grouping scheme.

Lengths are at most ``capacity``, so the whole packing is planned on a histogram of at most
``capacity`` entries, whatever the number of documents; tasks then look their pieces up in the plan.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import materialize

CAPACITY, EOS = 1024, 2
#: Pre-tokens of the vocabulary: contractions, words, numbers and signs with a leading space, other white space.
PRETOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


class Encoder:
    """Ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit bytes.

    The same merges are run by the faster of the two libraries that read them. Texts with the
    vocabulary's special string, or beyond the Latin blocks, whose character classes the libraries
    share, go to the tokenizer itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.part = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=merges, special_tokens={})

    def ids(self, text: str) -> bytes:
        odd = not text.isascii() and max(text) > "ɏ" and any("ɏ" < c and not "‐" <= c <= "…" for c in set(text))
        if odd or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.part.encode_ordinary(text)
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


def cut(ids: bytes, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only longer ones are cut, and only the first piece is shorter."""
    n = len(ids) // 4
    first = n % capacity or capacity
    return [(0, min(n, first)), *((s, capacity) for s in range(first, n, capacity))]


# ---- planning on the histogram ---------------------------------------------------------------


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Few-size configurations by column generation: (items per size, whole bins), rounded down.

    What the rounding leaves is packed first-fit over the same sizes, so the demand is met.
    """
    k = len(sizes)
    base = np.diag((capacity // sizes).astype(float))
    level = demand / np.diag(base)
    for _ in range(rounds):
        price = np.linalg.solve(base.T, np.ones(k))
        # best value for each capacity with up to j items
        best, picks = np.zeros(capacity + 1), []
        for _ in range(int(capacity // sizes.min())):
            room = np.arange(capacity + 1)[:, None] - sizes[None, :]
            worth = np.where(room >= 0, best[np.maximum(room, 0)] + price[None, :], -1.0)
            pick = worth.argmax(1)
            top = worth[np.arange(capacity + 1), pick]
            picks.append(np.where(top > best + 1e-12, pick, -1))
            best = np.maximum(best, top)
        if best[capacity] <= 1 + 1e-9:
            break
        column, c = np.zeros(k), capacity
        for pick in reversed(picks):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        way = np.linalg.solve(base, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(way > 1e-9, level / way, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        level = np.maximum(level - ratio[out] * way, 0)
        level[out] = ratio[out]
        base[:, out] = column
    found: dict[tuple[int, ...], int] = {}
    left = demand.astype(np.int64).copy()
    for j in np.argsort(-level):
        col = base[:, j].round().astype(np.int64)
        times = int(level[j] + 1e-7)
        if times and col.any():
            times = min([times, *(int(left[g] // col[g]) for g in np.flatnonzero(col))])
        if times:
            found[tuple(col)] = found.get(tuple(col), 0) + times
            left -= times * col
    while left.any():
        col, room = np.zeros(k, np.int64), capacity
        for g in range(k):
            col[g] = min(left[g], room // sizes[g])
            room -= int(col[g] * sizes[g])
        times = min(int(left[g] // col[g]) for g in np.flatnonzero(col))
        found[tuple(col)] = found.get(tuple(col), 0) + times
        left -= times * col
    return [(np.array(c), n) for c, n in found.items()]


def plan(histogram: dict[int, int], capacity: int, share: float, groups: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (length, first rank, count, first sequence, offset) for every piece, and the sequences used.

    The i-th piece of a slot's ranks goes to the i-th of its sequences.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(histogram, 0)
    spare: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: runs (first sequence, bins)
    made = 0

    def put(length: int, count: int, seq: int, offset: int) -> None:
        slots.append((length, taken[length], count, seq, offset))
        taken[length] += count

    large = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if n > share * capacity]
    total = sum(c for _, c in large)
    if total:
        each = -(-total // groups)
        queues: list[list[list[int]]] = [[]]
        room = each
        for n, c in large:
            while c:
                if not room:
                    queues.append([])
                    room = each
                t = min(c, room)
                queues[-1].append([n, t])
                c, room = c - t, room - t
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(t for _, t in q) for q in queues], float)
        # groups of one length are one size
        keys, where = np.unique(-sizes, return_inverse=True)
        merged: list[list[list[int]]] = [[] for _ in keys]
        for q, w in zip(queues, where, strict=True):
            merged[w] += q
        for counts, bins in configurations(-keys, np.bincount(where, demand), capacity):
            places = [g for g in np.flatnonzero(counts) for _ in range(counts[g])]
            pieces = []
            for g in places:  # actual documents for the rounded sizes, longest first
                need, own = bins, []
                while need:
                    n, c = merged[g][0]
                    t = min(c, need)
                    own.append((n, t))
                    need -= t
                    merged[g][0][1] -= t
                    if not merged[g][0][1]:
                        merged[g].pop(0)
                pieces.append(own)
            marks = sorted({0, bins, *(int(x) for own in pieces for x in np.cumsum([t for _, t in own]))})
            at = [(0, 0)] * len(pieces)  # entry and its end so far
            for lo, hi in zip(marks, marks[1:], strict=False):
                offset = 0
                for p, own in enumerate(pieces):
                    i, end = at[p]
                    while end <= lo:
                        end += own[i][1]
                        i += 1
                    at[p] = (i, end)
                    put(own[i - 1][0], hi - lo, made, offset)
                    offset += own[i - 1][0]
                spare[capacity - offset].append((made, hi - lo))
                made += hi - lo
    for n in sorted((n for n in histogram if n <= share * capacity), reverse=True):
        left = histogram[n]
        while left:
            r = next((r for r in range(n, capacity + 1) if spare[r]), None)
            if r is None:
                r, run = capacity, (made, -(-left // (capacity // n)))
                made += run[1]
            else:
                run = spare[r].pop()
            fit, (seq, bins) = r // n, run
            full = min(bins, left // fit)
            for k in range(fit):
                if full:
                    put(n, full, seq, capacity - r + k * n)
            if full:
                spare[r - fit * n].append((seq, full))
            left -= full * fit
            if full < bins:
                for k in range(left):
                    put(n, 1, seq + full, capacity - r + k * n)
                if left:
                    spare[r - left * n].append((seq + full, 1))
                if bins - full - bool(left):
                    spare[r].append((seq + full + bool(left), bins - full - bool(left)))
                left = 0
    return slots, made


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """The shortest plan over a fixed set of large-item shares and group counts."""
    tried = [plan(histogram, capacity, share, groups) for share, groups in ((1 / 4, 64), (1 / 3, 64), (1 / 6, 48), (1 / 2, 96))]
    return min(tried, key=lambda p: p[1])


# ---- over tables -------------------------------------------------------------------------------


def tokenized_pieces(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, with its rank among the equal lengths of its task (``_pid``, ``_rank``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, pid, seen = Encoder(vocabulary, ranks), TaskContext.get().partitionId(), [0] * (capacity + 1)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "_pid", "_rank"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for b in batches:
            rows: list[tuple] = []
            for i in range(b.num_rows):
                doc, ids = b.column(0)[i].as_py(), enc.ids(b.column(1)[i].as_py() or "") + EOS.to_bytes(4, "little")
                for k, (s, n) in enumerate(cut(ids, capacity)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), pid, seen[n]))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, _pid int, _rank long")


def pack(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and ``offset``.

    A null or empty text is the end token alone. Repeated rows are packed as often as they come,
    null ids are kept, extra columns are ignored, and an empty table gives no rows.
    """
    pieces = materialize(tokenized_pieces(docs, vocabulary, ranks, capacity))
    counts = materialize(pieces.groupBy("_pid", "length").agg(F.count("*").alias("n")))
    # at most one row per possible length
    histogram = {int(n): int(c) for n, c in counts.groupBy("length").agg(F.sum("n")).collect()}
    slots, _ = best_plan(histogram, capacity)
    slots.sort()
    length, rank, _, seq, offset = (np.array(x, np.int64) for x in zip(*slots, strict=True)) if slots else [np.zeros(0, np.int64)] * 5
    shared = docs.sparkSession.sparkContext.broadcast(((length << 48) | rank, rank, seq, offset))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    ranked = pieces.join(counts.select("_pid", "length", F.coalesce(before, F.lit(0)).alias("_before")), ["_pid", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, seq, offset = shared.value
        for b in batches:
            n, r = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            at = np.searchsorted(key, (n << 48) | r, side="right") - 1
            cols = [*b.columns[:5], pa.array(seq[at] + r - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
