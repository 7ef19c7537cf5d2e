"""Toxicity scores: a learned lexicon trie met by Levenshtein automata, weighed in context windows."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import discard, materialize

#: Labelled rows that the classifier is fitted on, at most (those with the smallest hash of the id).
MAX_LABELLED = 20_000
#: Terms of the lexicon, entries that are looked at for them, and letters of a word that can be one, at most.
MAX_TERMS, MAX_ENTRIES, MAX_LETTERS = 256, 4_000, 40
#: Log odds that make a term, and a misspelled hit of one.
LEAST = 2
THRESHOLD = 0.3
WORD = re.compile(r"\w+")
WINDOW = 8
# Marks and words that introduce another's speech.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset("said says called quoted quote wrote alleged sagte nannte zitat dit appelé citation dijo llamó cita".split())


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


# ---- lexicon and automaton -----------------------------------------------------------------------


class Matcher:
    """Words within a term's edit distance, by one lazily built automaton.

    A state is a set of (trie node, edits so far): the Levenshtein automata of all terms run
    through the trie at once. Transitions are kept, so known words cost one step a letter.
    A term ending in ``$`` is a whole word; others are stems, met by any word that begins so.
    The first letter must be right, and stems and words under five letters whole, unless ``loose``:
    then edits begin at the first letter, and stems and words of four letters allow one.
    """

    def __init__(self, terms: list[str], loose: bool = False, most_states: int = 100_000):
        self.loose, self.most_states = loose, most_states
        self.kids: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.stem: list[bool] = [False]
        self.room: list[int] = [0]
        self.allowed: list[int] = []
        for t, term in enumerate(terms):
            whole = term.endswith("$")
            text = term.removesuffix("$")
            if loose:
                most = 0 if len(text) < 4 else 1 if not whole or len(text) < 8 else 2
            else:
                most = 0 if not whole or len(text) < 5 else 1 if len(text) < 8 else 2
            self.room[0] = max(self.room[0], most)
            self.allowed.append(most)
            node = 0
            for ch in text:
                if ch not in self.kids[node]:
                    self.kids[node][ch] = len(self.kids)
                    self.kids.append({})
                    self.ends.append(-1)
                    self.stem.append(False)
                    self.room.append(0)
                node = self.kids[node][ch]
                self.room[node] = max(self.room[node], most)
            self.ends[node], self.stem[node] = t, not whole
        self._begin()

    def _begin(self) -> None:
        self.known: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.final: list[tuple[int, int] | None] = []
        self.sticky: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, at: dict[int, int]) -> int:
        todo = list(at.items())
        while todo:  # a letter of the term that the word lacks
            n, e = todo.pop()
            if n or self.loose:
                for k in self.kids[n].values():
                    if e + 1 <= self.room[k] and at.get(k, 9) > e + 1:
                        at[k] = e + 1
                        todo.append((k, e + 1))
        key = frozenset(at.items())
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(at)
            self.moves.append({})
            done = [(e, self.ends[n]) for n, e in at.items() if self.ends[n] >= 0 and not self.stem[n] and e <= self.allowed[self.ends[n]]]
            self.final.append((min(done)[1], min(done)[0]) if done else None)
            stems = [(e, self.ends[n]) for n, e in at.items() if self.stem[n] and e <= self.allowed[self.ends[n]]]
            self.sticky.append((min(stems)[1], min(stems)[0]) if stems else None)
        return self.known[key]

    def _step(self, s: int, ch: str) -> int:
        nxt: dict[int, int] = {}
        for n, e in self.sets[s].items():
            for c, k in self.kids[n].items():
                cost = e + (c != ch)
                if cost <= self.room[k] and (n or self.loose or c == ch):
                    nxt[k] = min(nxt.get(k, 9), cost)
            if (n or self.loose) and e + 1 <= self.room[n]:
                nxt[n] = min(nxt.get(n, 9), e + 1)
        return self._state(nxt) if nxt else -1

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, distance) of the nearest term, or None."""
        if len(self.sets) > self.most_states:
            self._begin()
        s, stem = self.start, None
        for ch in word:
            row = self.moves[s]
            s = row[ch] if ch in row else row.setdefault(ch, self._step(s, ch))
            if s < 0:
                return stem
            now = self.sticky[s]
            if now and (not stem or now[1] < stem[1]):
                stem = now
        return self.final[s] if self.final[s] and (not stem or self.final[s][1] == 0 or self.final[s][1] < stem[1]) else stem


def entries(text: str) -> set[str]:
    """What a text offers to the lexicon: its words (``word$``) and their beginnings of 4 to 9 letters."""
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        if len(w) <= MAX_LETTERS:
            out.add(w + "$")
            out.update(w[:k] for k in range(4, min(9, len(w)) + 1))
    return out


def choose_terms(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Terms and weights (log odds) from (entry, toxic documents, clean documents) rows."""
    scored = []
    for entry, n1, n0 in rows:
        w = math.log((n1 + 0.5) / (toxic + 1)) - math.log((n0 + 0.5) / (clean + 1))
        if n1 >= max(4, 0.012 * toxic) and w >= LEAST:
            scored.append((-round(w * math.sqrt(n1), 6), not entry.endswith("$"), len(entry), entry, w, n1))
    out: dict[str, float] = {}
    counts: dict[str, int] = {}
    for *_, entry, w, n1 in sorted(scored):
        begun = any(not t.endswith("$") and entry.startswith(t) for t in out)
        looser = not entry.endswith("$") and any(t.startswith(entry) and n1 <= 1.3 * counts[t] for t in out)
        if not begun and not looser:
            out[entry], counts[entry] = w, n1
        if len(out) == MAX_TERMS:
            break
    return out


def loose_weights(weights: list[float], met: list[tuple[int, int, int]], toxic: int, clean: int) -> list[float]:
    """Log odds of each term's hits at distance 1 and 2, from (2 * term + distance - 1, toxic documents, clean documents).

    The term's own weight where there are no such hits, and at most that.
    """
    out, rest = [w for w in weights for _ in range(2)], 0.5 / (toxic + 1)
    for k, n1, n0 in met:
        out[k] = min(out[k], math.log((n1 / (toxic + 1) + rest) / (n0 / (clean + 1) + rest * math.exp(-out[k]))))
    return out


def features(text: str, matcher: Matcher, cache: dict, weights: list[float], loose: list[float] | None = None) -> tuple[list[float], list[tuple[int, int]]]:
    """The document's feature vector and its hits (term, distance)."""
    low = text.lower()
    words = WORD.findall(low)
    if not any(map(cache.__getitem__, words)):
        return [1.0, 0, 0, 0, 0, 0, 0, 0], []
    spots = [(i, m.start(), m.end(), cache[m.group()]) for i, m in enumerate(WORD.finditer(low)) if cache[m.group()]]
    best, count, hits, near = [0.0] * 3, [0] * 3, [], 0
    for k, (i, a, b, (term, dist)) in enumerate(spots):
        said = REPORTING & set(words[max(0, i - WINDOW) : i])
        before, after = low[max(0, a - 120) : a], low[b : b + 120]
        marks = sum(map(before.count, QUOTES))
        quoted = (marks % 2 == 1 and any(q in after for q in QUOTES)) or bool(said and marks)
        worth = (loose[2 * term + dist - 1] if loose and dist else weights[term]) / (1 + 0.25 * dist)
        kind = 2 if quoted else 1 if dist else 0
        best[kind] = max(best[kind], worth)
        count[kind] += 1
        hits.append((term, dist))
        near += not quoted and (k > 0 and i - spots[k - 1][0] <= WINDOW)
    v = [1.0]
    for b, n in zip(best, count, strict=True):
        v += [b / 4, math.log1p(n)]
    return [*v, math.log1p(near)], hits


class Cache(dict):
    """Word to match, filled on demand and started anew when it is large. Misspelled hits that weigh less than a term must are none."""

    def __init__(self, matcher: Matcher, most: int = 400_000, loose: list[float] | None = None):
        super().__init__()
        self.matcher, self.most, self.loose = matcher, most, loose

    def __missing__(self, word: str):
        if len(self) >= self.most:
            self.clear()
        out = self.matcher.match(word)
        if out and out[1] and self.loose and self.loose[2 * out[0] + out[1] - 1] < LEAST:
            out = None
        self[word] = out
        return out


#: Where the data say nothing: weights of the constant, plain, misspelled and quoted hits, and hits close together.
PRIOR = np.array([-3.0, 1.5, 0.8, 1.2, 0.6, 0.3, 0.1, 0.3])


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, rounds: int = 100) -> np.ndarray:
    """Newton steps towards the labels, held to ``prior`` and halved until they lower the loss."""
    theta, hold = prior.copy(), np.array([0.05, *[0.3] * (len(prior) - 1)])

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((np.logaddexp(0, z) - y * z).sum() + (hold * (t - prior) ** 2).sum() / 2)

    now = loss(theta)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * (theta - prior))
        while (then := loss(theta + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if then > now or np.abs(step).max() < 1e-8:
            break
        theta, now = theta + step, then
    return theta


# ---- over tables ---------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` labelled training rows, one an id (of a repeated id the least text).

    The label side is bounded, so it is broadcast; the result is written once, as it is read three times.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg((F.max("toxic") >= 1).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return materialize(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon, weights and classifier from the labelled training rows."""
    rows = labelled_sample(docs, labels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], names=["entry", "n1", "n0"])
            seen[0].clear()
            seen[1].clear()
            return out

        for b in batches:
            for text, toxic in zip(b.column(1), b.column(2), strict=True):
                found = seen[toxic.as_py()]
                found.update(entries(text.as_py()))
                found[""] += 1  # counts the documents
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield flush()
        yield flush()

    table = rows.mapInArrow(count, "entry string, n1 long, n0 long").groupBy("entry").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter("n1 >= 4 or entry = ''")
    worth = F.log((F.col("n1") + 0.5) / (F.col("n0") + 0.5)) * F.sqrt("n1")
    top = table.orderBy(F.col("entry") != "", worth.desc(), "entry").limit(MAX_ENTRIES + 1).collect()
    toxic, clean = next(((r["n1"], r["n0"]) for r in top if r["entry"] == ""), (0, 0))
    terms = choose_terms([(r["entry"], r["n1"], r["n0"]) for r in top if r["entry"]], toxic, clean)
    names, weights = list(terms), list(terms.values())

    def misspelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = Cache(Matcher(names, loose=True)), np.zeros((2, 2 * len(names)), np.int64)
        for b in batches:
            for text, bad in zip(b.column(1), b.column(2), strict=True):
                hits = map(cache.__getitem__, set(WORD.findall(text.as_py().lower())))
                seen[bad.as_py(), list({2 * h[0] + h[1] - 1 for h in hits if h and h[1]})] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * len(names))), pa.array(seen[1]), pa.array(seen[0])], names=["k", "n1", "n0"])

    met = rows.mapInArrow(misspelled, "k long, n1 long, n0 long").groupBy("k").agg(F.sum("n1"), F.sum("n0")).collect() if names else []  # at most 2 * MAX_TERMS rows
    loose = loose_weights(weights, [tuple(x) for x in met], toxic, clean)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(names, loose=True)
        cache = Cache(m, loose=loose)
        for b in batches:
            xs = [features(t.as_py(), m, cache, weights, loose)[0] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), b.column(2)], names=["x", "y"])

    got = rows.mapInArrow(measure, "x array<double>, y int").collect()  # at most MAX_LABELLED rows
    x = np.array([r["x"] for r in got], float).reshape(-1, len(PRIOR))
    y = np.array([r["y"] for r in got], float)
    discard(rows)
    theta = PRIOR
    if len(x):  # misspelled hits weigh like plain ones as far as the data don't say otherwise
        plain = logistic(x, y)
        theta = logistic(x, y, np.concatenate([plain[:3], 0.9 * np.maximum(plain[1:3], 0), PRIOR[5:]]))
    return {"terms": names, "weights": weights, "loose": loose, "theta": theta.tolist()}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The columns of ``docs`` other than ``text``, with ``score``; null and empty texts score the constant."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        matcher, theta = Matcher(m["terms"], loose=True), np.array(m["theta"])
        cache = Cache(matcher, loose=m["loose"])
        for b in batches:
            x = np.array([features(t.as_py() or "", matcher, cache, m["weights"], m["loose"])[0] for t in b.column(len(keep))]).reshape(-1, len(theta))
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(p)], names=[*keep, "score"])

    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text"))
    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields]).add("score", DoubleType())
    return src.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every whole text.

    Labels count only where the id's crc32 mod 4 is not 2; only the text enters a score. Without
    usable labels the lexicon is empty and all texts score the same. Repeated rows, null ids and
    extra columns are harmless; an empty table gives no rows.
    """
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under ``THRESHOLD``.

    Null and empty texts score the constant; null ids and repeated rows are ordinary rows; other
    columns are carried along, whatever their names; an empty table gives no rows.
    """
    model = fit(docs, labels)
    scored = score(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_said")), model, "_said")
    return scored.filter(F.col("score") < THRESHOLD).select("_row.*")
