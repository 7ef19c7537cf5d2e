"""Substring deduplication over sliding sentence spans."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import bit_filter, discard, identified, materialize
from folio.llm.simhash import LOWER, P2, P3, SPACE, U, text_chunks, xxh64_slices

#: Words that a run has at least, and that a sentence may have before it is cut further. Any
#: ``LEAST + 2 * LONGEST + 2`` = 50 words that two texts share hold a run that both cut alike.
LEAST, LONGEST = 30, 10
#: Bytes of text that are cut together.
CHUNK = 1 << 20
#: First bytes of signs that are words by themselves, U+3000 to U+D7FF and U+F000 to U+3FFFF: most have no spaces between words.
ALONE = np.zeros(256, bool)
ALONE[[*range(0xE3, 0xEE), 0xEF, 0xF0]] = True
#: Bytes that end a sentence at the end of a word, and the signs that do so anywhere (。！？｡).
ENDS = np.zeros(256, bool)
ENDS[[*b".!?"]] = True
FULL_STOPS = tuple(np.frombuffer(c.encode(), np.uint8) for c in "。！？｡")
#: Odd bases of the two rolling sums that make a run's 128-bit key.
BASES = (U(0x9E3779B97F4A7C15 | 3), U(0xD1B54A32D192ED03))


class Cut(NamedTuple):
    """Texts cut into sentences of words; every place is a place among the words of all texts."""

    begins: np.ndarray  # first byte of each word
    words: np.ndarray  # first word of each text, and the end
    sentences: np.ndarray  # first word of each sentence
    first: np.ndarray  # first sentence of each text, and the end
    hashes: np.ndarray


def chosen(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` places in a row the one with the smallest hash, the last of equal ones.

    It depends on these words alone, so texts that share a passage cut it alike.
    """
    low = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window).argmin(1)[::-1]
    return np.arange(len(low)) + window - 1 - low


def cut(texts: list[bytes], longest: int = LONGEST) -> Cut:
    """Sentences end behind a word that ends in ``.``, ``!`` or ``?``, behind a CJK full stop and at line ends.

    Sentences of more than ``longest`` words are cut further, before words that their own hashes
    choose. Words are what white space (ASCII) leaves; each CJK sign is one.
    """
    raw = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    if not len(raw):
        none = np.zeros(len(texts) + 1, np.int64)
        return Cut(none[:0], none, none[:0], none, np.zeros(0, U))
    ends = np.cumsum([len(t) + 1 for t in texts])
    gap = SPACE[raw]
    start = ~gap
    start[1:] &= gap[:-1]
    stops = np.zeros(len(raw), bool)
    if (raw >= 0xE3).any():
        lead = (raw & 0xC0) != 0x80  # a sign's first byte
        alone = ALONE[raw]
        sign = np.cumsum(lead) - 1
        after = np.zeros(sign[-1] + 2, bool)
        after[1:] = alone[lead]
        start |= ~gap & lead & (alone | after[sign])
        for stop in FULL_STOPS:
            at = np.flatnonzero((raw[:-2] == stop[0]) & (raw[1:-1] == stop[1]) & (raw[2:] == stop[2])) if len(raw) > 2 else []
            stops[at] = True
    begins = np.flatnonzero(start)
    words = np.searchsorted(begins, np.concatenate([[0], ends]))
    n = len(begins)
    if not n:
        return Cut(begins, words, np.zeros(0, np.int64), words, np.zeros(0, U))
    spaces = np.flatnonzero(gap)
    past = np.minimum(spaces[np.searchsorted(spaces, begins)], np.append(begins[1:], len(raw)))
    hashes = xxh64_slices(raw, begins, past - begins)
    lines = np.cumsum(raw == 0x0A)
    fresh = np.ones(n, bool)
    fresh[1:] = (ENDS[raw[past[:-1] - 1]] & (past[:-1] < begins[1:])) | (lines[begins[1:]] != lines[begins[:-1]]) | stops[begins[:-1]]
    if n >= longest:
        owner = np.cumsum(fresh)
        whole = (owner[: n - longest + 1] == owner[longest - 1 :]) & (np.bincount(owner)[owner[: n - longest + 1]] > longest)
        fresh[chosen(hashes, longest)[whole]] = True
    sentences = np.flatnonzero(fresh)
    return Cut(begins, words, sentences, np.searchsorted(sentences, words), hashes)


def runs(c: Cut, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first sentence, past the last, two-word keys) of every run, text by text.

    From every sentence on, the shortest run of at least ``least`` words; and the shortest that ends
    with the text, where no other does.
    """
    n = len(c.sentences)
    text = np.repeat(np.arange(len(c.words) - 1), np.diff(c.first))
    bounds = np.append(c.sentences, len(c.begins))
    to = np.searchsorted(bounds, c.sentences + least)
    fits = to <= c.first[1:][text]
    a, b, text = np.flatnonzero(fits), to[fits], text[fits]
    tail = np.searchsorted(c.sentences, c.words[1:] - least, side="right") - 1
    ended = np.zeros(len(c.words) - 1, bool)
    ended[text[b == c.first[1:][text]]] = True
    more = np.flatnonzero(~ended & (tail >= c.first[:-1]) & (c.words[1:] - c.words[:-1] >= least))
    a, b, text = np.append(a, tail[more]), np.append(b, c.first[1:][more]), np.append(text, more)
    order = np.lexsort((b, a))
    a, b, text = a[order], b[order], text[order]
    lo, hi = bounds[a], bounds[np.minimum(b, n)]
    keys = np.empty((len(a), 2), U)
    h = c.hashes
    with np.errstate(over="ignore"):
        for k, base in enumerate(BASES):
            inverse = U(pow(int(base), -1, 1 << 64))
            power = np.cumprod(np.concatenate([np.ones(1, U), np.full(len(h), base, U)]))
            sums = np.concatenate([np.zeros(1, U), np.cumsum(h * power[:-1])])
            back = np.cumprod(np.concatenate([np.ones(1, U), np.full(len(h), inverse, U)]))
            x = (sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(U)
            x = (x ^ (x >> U(31))) * P2
            keys[:, k] = x ^ (x >> U(29))
            h = (h ^ (h >> U(32))) * P3
    return text, a, b, keys.view(np.int64)


def _repeated(text: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Marks runs that their own text holds before."""
    order = np.lexsort((keys[:, 1], keys[:, 0], text))
    t, k = text[order], keys[order]
    out = np.zeros(len(text), bool)
    out[order[1:]] = (t[1:] == t[:-1]) & (k[1:] == k[:-1]).all(1)
    return out


def dedup_spans(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_removed``, ``removed`` (sentence places from 0) and the ``text`` left.

    A run of sentences (see ``cut`` and ``runs``) that occurs more than once in the corpus is kept where
    it comes first (smallest id, then file order, then place); every sentence that another occurrence
    covers is removed. So of a repeated passage of ``least`` + 2 * ``longest`` + 2 words or more the later
    ones lose all but up to ``longest`` words at either end, and shared runs of fewer than ``least``
    words stay. The case of A-Z and white space don't count. Null and empty texts have no sentences
    and stay as they are; repeated rows are occurrences like any other; a null id comes last. Extra
    columns are ignored; an empty table gives no rows.
    """
    rows = identified(docs).select(F.col("_file").alias("file"), F.col("_at").alias("at"), F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.text").cast("string").alias("text"))
    schema = "file long, at long, doc long, h1 long, h2 long"

    def distinct_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [b.column(k).fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False) for k in range(3)]
            for at, texts in text_chunks(b.column(3), CHUNK):
                text, _, _, keys = runs(cut(texts, longest), least)
                new = ~_repeated(text, keys)
                yield pa.RecordBatch.from_arrays([*(pa.array(x[at + text[new]]) for x in ids), *(pa.array(keys[new, k]) for k in range(2))], names=["file", "at", "doc", "h1", "h2"])

    first = F.min(F.struct("doc", "file", "at")).alias("first")
    shared = materialize(rows.mapInArrow(distinct_runs, schema).groupBy("h1", "h2").agg(first, F.count("*").alias("n")).filter("n > 1").select("h1", "h2", F.col("first.file").alias("file0"), F.col("first.at").alias("at0")))
    hit = bit_filter(shared, "h1", "h2")

    def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in distinct_runs(batches):
            yield b.filter(pa.array(hit(b.column(3).to_numpy(), b.column(4).to_numpy())))

    # a run has one row on the right, so the rows of a passage that very many texts hold can be split on the left
    met = rows.mapInArrow(shared_runs, schema).join(shared, ["h1", "h2"]).filter("file <> file0 or at <> at0")
    met = materialize(met.select("file", "at", "h1", "h2"))
    discard(shared)
    later = met.groupBy("file", "at").agg(F.collect_list(F.struct("h1", "h2")).alias("gone"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone = b.column(2).to_pylist()
            for at, texts in text_chunks(b.column(1), CHUNK):
                c = cut(texts, longest)
                text, lo, hi, keys = runs(c, least)
                off = _repeated(text, keys)
                ends = np.searchsorted(text, np.arange(len(texts) + 1))
                for i, found in enumerate(gone[at : at + len(texts)]):
                    if found:
                        known, own = {(g["h1"], g["h2"]) for g in found}, slice(ends[i], ends[i + 1])
                        off[own] |= np.fromiter((k in known for k in map(tuple, keys[own].tolist())), bool, ends[i + 1] - ends[i])
                depth = np.zeros(len(c.sentences) + 1, np.int64)
                np.add.at(depth, lo[off], 1)
                np.add.at(depth, hi[off], -1)
                covered = np.cumsum(depth)[:-1] > 0
                size, n, removed = np.diff(c.first), [], []
                left, base, said = b.column(1).slice(at, len(texts)).to_pylist(), 0, np.append(c.begins[c.sentences], 0)
                for i, t in enumerate(texts):
                    own = covered[c.first[i] : c.first[i + 1]]
                    places = np.flatnonzero(own)
                    n.append(len(places))
                    removed.append(places.astype(np.int32))
                    if len(places):
                        marks = said[c.first[i] : c.first[i + 1] + 1] - base
                        marks[0], marks[-1] = 0, len(t)
                        left[i] = b"".join(t[marks[k] : marks[k + 1]] for k in np.flatnonzero(~own)).decode("utf-8", "replace")
                    base += len(t) + 1
                cols = [b.column(0).slice(at, len(texts)), pa.array(size.astype(np.int64)), pa.array(n, pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_sentences", "n_removed", "removed", "text"])

    joined = rows.join(later, ["file", "at"], "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(clean, "doc_id long, n_sentences long, n_removed long, removed array<int>, text string")
