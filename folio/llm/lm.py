"""Log-bilinear language model trained by noise-contrastive estimation, and unigram base scores.

The model predicts units: every word that training met ``LEAST_COUNT`` times is a unit of its own (the
most frequent ``UNITS`` of them), all other words fall into classes by their last letters, and a word
within a class has its smoothed share of it. So every word, seen or not, has a normalised
probability. A unit's score is ``(R1[before] + R2[last]) . Q[unit] + b[unit]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import discard, materialize
from folio.llm.simhash import LOWER, SPACE, text_chunks

SMOOTH = 0.1
#: A word is a unit of its own from this count on; so many of them at most; so many of these stand
#: for themselves as context too, others by their class.
LEAST_COUNT, UNITS, CONTEXTS = 16, 32_000, 2_000
#: Classes of all other words, by a hash of so many last bytes.
CLASSES, SUFFIX = 248, 3
#: Words whose counts every task holds, at most, each of at most ``SHORT`` bytes; others are joined.
HEAD, SHORT = 400_000, 64
END = b" "  # words are kept with one space behind; this is the empty one
#: Bytes with A-Z lower-cased and every white space a space.
FOLDED = np.where(SPACE, 0x20, LOWER).astype(np.uint8).tobytes()
#: Training goes over all tokens, ``BATCH`` at a time, each against ``NOISE`` noise tokens; these enter by
#: their expectation over ``DRAWN`` tokens of the batch, so noise is drawn by frequency. Tasks start
#: from common parameters, and what they learn is averaged after every ``ROUND`` tokens (at most
#: ``PARTS`` times a pass). A corpus of fewer tokens is gone over again, up to ``PASSES`` times.
WIDTH, NOISE, DRAWN, BATCH, ROUND, PARTS, PASSES = 16, 32, 192, 3072, 1 << 24, 8, 12
#: Length of a parameter row's vector at most.
LONGEST = 6.0
#: Bytes of text that are cut together, parameter rows that are sent together, and contexts whose normalisers are.
CHUNK, BLOCK, STRIP = 4 << 20, 1024, 192


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(words of each text, the distinct words with a space behind, each word's place among them); A-Z lower-cased."""
    raw = np.frombuffer(b" ".join([*texts, b""]).translate(FOLDED), np.uint8)
    gap = raw == 0x20
    first = ~gap
    first[1:] &= gap[:-1]
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    n = np.diff(np.searchsorted(np.flatnonzero(first), ends))
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    norm = raw[keep]
    offsets = np.concatenate([[0], np.flatnonzero(norm == 0x20) + 1]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(norm)]).dictionary_encode()
    return n, found.dictionary, found.indices.to_numpy()


def class_of(words: pa.Array) -> np.ndarray:
    """0 to ``CLASSES`` - 1, from the last bytes of each word."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b" ", np.uint8)
    key = np.zeros(len(words), np.int64)
    for back in range(2, 2 + SUFFIX):
        place = at[1:] - back
        key = key * 256 + np.where(place >= at[:-1], data[np.maximum(place, 0)], 0)
    return (key * 2654435761 >> 15) % CLASSES


class Units:
    """Units of words: 0 is the end, then the words of their own, then the classes. Contexts likewise, with fewer words."""

    def __init__(self, own: list[bytes]):
        self.own = pa.array(own, pa.binary())
        self.near = min(len(own), CONTEXTS)
        self.targets, self.contexts = 1 + len(own) + CLASSES, 1 + self.near + CLASSES

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(unit, unit as context) of each word."""
        place = pc.index_in(words, value_set=self.own).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = class_of(words)
        return np.where(place >= 0, 1 + place, 1 + len(self.own) + rest), np.where((place >= 0) & (place < self.near), 1 + place, 1 + self.near + rest)


def tokens(n: np.ndarray, words: pa.Array, place: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, before, last, next) of each token and end, from ``words_of``; a text begins as if after two ends."""
    target, context = units.of(words)
    ends = np.cumsum(n + 1) - 1
    is_word = np.ones(len(place) + len(n), bool)
    is_word[ends] = False
    nxt, seen = np.zeros((2, len(is_word)), np.int32)
    nxt[is_word], seen[is_word] = target[place], context[place]
    last, before = np.zeros((2, len(is_word)), np.int32)
    last[1:], before[2:] = seen[:-1], seen[:-2]
    before[np.append(0, ends[:-1] + 1)[: len(n)]] = 0
    return np.repeat(np.arange(len(n)), n + 1), before, last, nxt


def _gather(ids: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of ``grads`` by id."""
    order = np.argsort(ids)
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return ids[first], np.add.reduceat(grads[order], first, axis=0)


class LogBilinear:
    """The parameters: rows of ``R1``, then ``R2``, then ``Q``, whose last column is ``b``."""

    def __init__(self, contexts: int, targets: int, table: np.ndarray):
        self.contexts, self.targets, self.table = contexts, targets, table
        self.r1, self.r2, self.q = table[:contexts, :WIDTH], table[contexts : 2 * contexts, :WIDTH], table[2 * contexts :]

    @classmethod
    def begin(cls, contexts: int, counts: np.ndarray, seed: int = 5) -> LogBilinear:
        """Small random vectors and the units' own shares as biases."""
        table = np.random.default_rng(seed).normal(0, 0.1, (2 * contexts + len(counts), WIDTH + 1)).astype(np.float32)
        table[: 2 * contexts, WIDTH] = 0
        table[2 * contexts :, WIDTH] = np.log((counts + 1) / (counts + 1).sum())
        return cls(contexts, len(counts), table)

    def train(self, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], rate: float, seed: int) -> np.ndarray:
        """Noise-contrastive steps over (before, last, next); how often each row was met as it comes in a text.

        The biases stay at the logarithms of the units' shares, which are the noise too.
        """
        rng, met = np.random.default_rng(seed), np.zeros(len(self.table), np.int64)
        squares = np.full(len(self.table), 10, np.float32)
        base, log_noise = np.int32(2 * self.contexts), np.float32(np.log(NOISE))
        for h1, h2, u in batches:
            h2 = h2 + np.int32(self.contexts)
            ctx = self.table[h1] + self.table[h2]
            ctx[:, WIDTH] = -1
            drawn = u[rng.integers(0, len(u), DRAWN)]
            q, qn = self.q[u], self.q[drawn]
            q[:, WIDTH] = qn[:, WIDTH] = log_noise  # a score over its noise: the biases cancel
            with np.errstate(over="ignore"):  # past the largest float the quotient is 0
                right = 1 / (1 + np.exp(np.einsum("ij,ij->i", ctx, q)))  # 1 - P(data)
                wrong = np.exp(ctx @ -qn.T)
            wrong += 1
            np.divide(np.float32(-NOISE / DRAWN), wrong, out=wrong)  # -P(data)
            dctx = right[:, None] * q + wrong @ qn
            ctx[:, WIDTH] = dctx[:, WIDTH] = 0
            for ids, grads in ((np.concatenate([base + u, base + drawn]), np.concatenate([right[:, None] * ctx, wrong.T @ ctx])), (np.concatenate([h1, h2]), np.concatenate([dctx, dctx]))):
                rows, total = _gather(ids, grads)
                squares[rows] += np.einsum("ij,ij->i", total, total) / WIDTH
                self.table[rows] += rate * total / np.sqrt(squares[rows])[:, None]
            np.add.at(met, np.concatenate([h1, h2, base + u]), 1)
        return met.astype(np.float32)

    def settle(self) -> None:
        """Vectors of a length over ``LONGEST`` are cut to it, so that no exponential can overflow."""
        size = np.linalg.norm(self.table[:, :WIDTH], axis=1, keepdims=True)
        self.table[:, :WIDTH] *= np.minimum(1, LONGEST / np.maximum(size, 1e-9))

    def log_norms(self, rows: np.ndarray) -> np.ndarray:
        """Natural logarithm of the sum over all units, for contexts (row, any), by matrix products in strips of units."""
        out = np.zeros((len(rows), self.contexts))
        for at in range(0, self.targets, 4096):
            q = self.q[at : at + 4096]
            out += np.exp(self.r1[rows] @ q[:, :WIDTH].T) @ np.exp(self.r2 @ q[:, :WIDTH].T + q[:, WIDTH]).T
        return np.log(out)

    def log10(self, norms: np.ndarray, h1: np.ndarray, h2: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the units."""
        out = np.empty(len(u))
        for at in range(0, len(u), 1 << 14):
            s = slice(at, at + (1 << 14))
            ctx = self.table[h1[s]] + self.table[self.contexts + h2[s]]
            ctx[:, WIDTH] = 1
            out[s] = (np.einsum("ij,ij->i", ctx, self.q[u[s]]) - norms[h1[s], h2[s]]) / np.float32(np.log(10))
        return out


def train_model(spark: SparkSession, train: DataFrame, units: Units, counts: np.ndarray, total: int) -> tuple[LogBilinear, np.ndarray]:
    """The model and its normalisers, from whole texts in the column ``text``; ``part`` spreads the rows over rounds.

    What the driver and a task hold is bounded by the numbers of units, whatever the corpus.
    """
    model = LogBilinear.begin(units.contexts, counts)
    passes = max(1, min(PASSES, -(-ROUND // max(total, 1)))) if total else 0
    parts = max(1, min(PARTS, total // ROUND))
    blocks = -(-len(model.table) // BLOCK)
    for step in range(passes * parts):
        rate = 0.3 * (1 - step / (passes * parts)) + 0.01
        shared = spark.sparkContext.broadcast((model.table, units))

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate, step=step) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            pid = TaskContext.get().partitionId()
            start, units = shared.value
            mine = LogBilinear(units.contexts, units.targets, start.copy())

            def cells() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
                for b in batches:
                    for _, texts in text_chunks(b.column(0), CHUNK):
                        _, *grams = tokens(*words_of(texts), units)
                        steps = -(-len(grams[0]) // BATCH)
                        for k in range(steps):  # a batch has tokens from all over the texts
                            yield tuple(g[k::steps] for g in grams)

            met = mine.train(cells(), rate, 1000 * step + pid)
            if met.any():
                moved = (mine.table - start).astype(np.float16)
                cut = range(0, len(met), BLOCK)
                cols = [pa.array(range(len(cut)), pa.int32()), pa.array([pid] * len(cut), pa.int32()), pa.array([met[k : k + BLOCK].tobytes() for k in cut], pa.binary()), pa.array([moved[k : k + BLOCK].tobytes() for k in cut], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["block", "pid", "met", "moved"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Moves weighed by how often a task met the row, summed as they come."""
            sums: dict[int, list[np.ndarray]] = {}
            for b in batches:
                for block, met, moved in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                    weight = np.frombuffer(met, np.float32).astype(float) + 1e-3
                    move = np.frombuffer(moved, np.float16).reshape(len(weight), -1) * weight[:, None]
                    own = sums.setdefault(block, [np.zeros(len(weight)), np.zeros(move.shape)])
                    own[0] += weight
                    own[1] += move
            for block, (weight, move) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([(move / weight[:, None]).astype(np.float32).tobytes()], pa.binary())], names=["block", "move"])

        rows = train.filter(F.col("part") % parts == step % parts).select("text")
        moves = rows.mapInArrow(learn, "block int, pid int, met binary, moved binary").repartition(blocks, "block").sortWithinPartitions("block", "pid")
        for r in moves.mapInArrow(average, "block int, move binary").collect():  # one row per block
            at = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
            model.table[at] += np.frombuffer(r["move"], np.float32).reshape(-1, WIDTH + 1)
        model.settle()
        shared.destroy()
    shared = spark.sparkContext.broadcast((model.table, units))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, units = shared.value
        own = LogBilinear(units.contexts, units.targets, table)
        for b in batches:
            for k in b.column(0).to_pylist():
                rows = np.arange(STRIP * k, min(STRIP * k + STRIP, units.contexts))
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([own.log_norms(rows).astype(np.float32).tobytes()], pa.binary())], names=["id", "norms"])

    strips = -(-units.contexts // STRIP)
    norms = spark.range(0, strips, 1, strips).mapInArrow(normalise, "id long, norms binary").collect()  # contexts x contexts cells
    return model, np.concatenate([np.frombuffer(r["norms"], np.float32) for r in sorted(norms)]).reshape(-1, units.contexts)


def language_scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Counts and the model come from all rows whose id's crc32 mod 10 is not 0 (a null id counts as
    the empty text, so it is held out). A null or empty text is one end token. Repeated rows count
    as often as they come; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), held_out(F.col("doc_id")).alias("held"))
    train = src.filter("not held").select("text", F.pmod(F.xxhash64("doc_id"), F.lit(840)).alias("part"))  # 840: all of 1 to 8 divide it

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in text_chunks(b.column(0), 2 * CHUNK):
                _, words, place = words_of(texts)
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(place, minlength=len(words)))], names=["word", "c"])
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([b.num_rows], pa.int64())], names=["word", "c"])

    counted = train.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    vocab = materialize(counted.filter("c > 0"))
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    short = vocab.filter((F.octet_length("word") <= SHORT) & (F.col("word") != END))
    # the least count with at most HEAD words from it on
    steps = short.groupBy(F.least("c", F.lit(1 << 16)).alias("c")).count().orderBy(F.col("c").desc()).collect()
    least, room = 1 << 62, HEAD
    for r in steps:
        if r["count"] > room:
            break
        least, room = r["c"], room - r["count"]
    top = short.filter(F.col("c") >= least).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    names, counts = top["word"].combine_chunks().cast(pa.binary()), top["c"].to_numpy()
    n_own = int(min(UNITS, (counts >= LEAST_COUNT).sum()))
    units = Units(names.slice(0, n_own).to_pylist())
    ends = vocab.filter(F.col("word") == END).first()
    ends = ends["c"] if ends else 0

    own = spark.sparkContext.broadcast(units.own)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros((2, CLASSES), np.int64)
        for b in batches:
            rest = pc.and_(pc.invert(pc.is_in(b.column(0), value_set=own.value)), pc.not_equal(b.column(0), END))
            words, c = b.column(0).filter(rest), b.column(1).filter(rest).to_numpy()
            cls = class_of(words)
            n += np.bincount(cls, c, CLASSES).astype(np.int64)
            v += np.bincount(cls, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(v)], names=["k", "n", "v"])

    rest, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in vocab.mapInArrow(classes, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        rest[r["k"]], kinds[r["k"]] = r["n"], r["v"]
    model, norms = train_model(spark, train, units, np.concatenate([[ends], counts[:n_own], rest]).astype(float), total)
    shared = spark.sparkContext.broadcast((names, np.log10(counts + SMOOTH), units, model.table, norms, np.log10(rest + SMOOTH * (kinds + 1))))
    all_mass = float(np.log10(total + SMOOTH * (distinct + 1)))
    end_share = float(np.log10(ends + SMOOTH))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, logs, units, table, norms, mass = shared.value
        model = LogBilinear(units.contexts, units.targets, table)
        pid, row = TaskContext.get().partitionId(), 0
        for b in batches:
            for at, texts in text_chunks(b.column(1), CHUNK):
                size = len(texts)
                n, words, place = words_of(texts)
                text, h1, h2, u = tokens(n, words, place, units)
                p = model.log10(norms, h1, h2, u)
                cls = u - 1 - len(units.own)
                p[cls >= 0] -= mass[cls[cls >= 0]]
                known = pc.index_in(words, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
                share = np.where(known >= 0, logs[np.maximum(known, 0)] if len(logs) else 0.0, 0.0)[place]
                owner = np.repeat(np.arange(size), n)
                head = known[place] >= 0
                base = np.bincount(owner, share, size) + end_share - (n + 1) * all_mass
                p[np.flatnonzero(u > 0)] += np.where(cls[u > 0] >= 0, share, 0.0)
                rare, times = np.unique(owner[~head] * np.int64(max(len(words), 1)) + place[~head], return_counts=True)
                lists = np.searchsorted(rare, np.arange(size + 1) * np.int64(max(len(words), 1))).astype(np.int32)
                cols = [pa.array((pid << 33) + row + np.arange(size)), b.column(0).slice(at, size), b.column(2).slice(at, size), pa.array(n + 1), pa.array(np.bincount(owner, head, size).astype(np.int64) + (ends > 0)), pa.array(base), pa.array(np.bincount(text, p, size))]
                cols += [pa.ListArray.from_arrays(pa.array(lists), words.take(pa.array(rare % max(len(words), 1)))), pa.ListArray.from_arrays(pa.array(lists), pa.array(times.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(cols, names=["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "words", "times"])
                row += size

    scored = materialize(src.select("doc_id", "text", "held").mapInArrow(score, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<binary>, times array<int>"))
    rare = scored.filter(F.size("words") > 0).select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("rid", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    found = rare.join(vocab, "word", "left")
    share = F.log10(F.coalesce("c", F.lit(0)) + SMOOTH) * F.col("times")
    late = materialize(found.groupBy("rid").agg(F.sum(share).alias("late"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("late_known")))
    discard(vocab)
    late_sum = F.coalesce("late", F.lit(0.0))
    return scored.drop("words", "times").join(late, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("late_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + late_sum).alias("base_score"), (F.col("score") + late_sum).alias("score"),
    )
