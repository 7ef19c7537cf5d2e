"""Near copies at a similarity of five-word shingle sets, for the SimHash stage of the pipeline.

At similarity 0.8 two SimHash fingerprints differ in about 15 of 100 bits, too many for the four
segments of 64 bits. So the fingerprints are longer, and texts meet by equal segments of them.
There pigeonring chains and the Hamming check prune on further words of the fingerprint; what
stays near is joined to groups, and inside these the shingle sets are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import bit_filter, connected_components, discard, materialize
from folio.llm.simhash import P2, U, majority, shingle_hashes, text_chunks, within

WORDS, SIMILAR = 5, 0.8
#: 64-bit words of a fingerprint that prune, and those after them that are cut into segments.
CHECKED, CUT = 3, 21
#: Bits of a segment. A bit differs with probability 0.152 at ``SIMILAR`` (0.161 at worst, for sets of
#: 13 and 14 shingles), so one of the 96 segments is equal with probability 0.99996 (0.9998).
SEGMENT = 14
#: Sets of up to so many shingles have twice the segments: with few, more bits are tied (0.188 differ
#: between 4 and 5 shingles, and one of 192 segments is equal with probability 0.99998).
FEW = 5
#: Bits in which fingerprints at ``SIMILAR`` differ at most, in a word (9.7 on average with a deviation
#: of 2.9) and in all words that prune (29 and 5).
BUDGET, BUDGET_ALL = 24, 58
#: Groups with more sets than this are compared in pairs of blocks.
BLOCK = 512
#: Rows of whole buckets taken at a time, and rows of a bucket that is searched group by group.
TAKEN, HOT = 1 << 15, 1024
#: Edges contracted at a time.
EDGES = 1 << 20


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text; the texts that have any; where each of these begins."""
    h, has, n = shingle_hashes(texts, WORDS)
    owner = np.repeat(has, n)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, has, np.searchsorted(owner, has)


def _words(h: np.ndarray, n: np.ndarray, first: int, last: int) -> np.ndarray:
    """Words ``first`` to ``last`` of the SimHash of every group of ``n`` hashes in a row; word 0 is that of the hashes themselves."""
    odd = np.random.default_rng(11).integers(0, 1 << 63, last, dtype=U) * U(2) + U(1)
    out = np.zeros((len(n), last - first), U)
    for i in range(first, last):
        x = h
        if i:
            x = (h ^ (h >> U(32))) * odd[i]
            x = (x ^ (x >> U(29))) * P2
            x ^= x >> U(32)
        out[:, i - first] = majority(x, n)
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, others) batches to (others, d1, d2, fp): a 128-bit digest of the set and the words of its SimHash."""
    for b in batches:
        for at, texts in text_chunks(b.column(0)):
            h, has, seg = shingle_sets(texts)
            digest, fp = np.zeros((2, len(texts)), U), [b""] * len(texts)
            if len(has):
                n = np.diff(np.append(seg, len(h)))
                digest[0, has] = np.add.reduceat(h, seg)
                digest[1, has] = np.bitwise_xor.reduceat(h * P2 ^ (h * P2 >> U(29)), seg)
                for i, row in zip(has, _words(h, n, 0, CHECKED + CUT), strict=True):
                    fp[i] = row.tobytes()
                few = n <= FEW
                if few.any():
                    for i, row in zip(has[few], _words(h[np.repeat(few, n)], n[few], CHECKED + CUT, CHECKED + 2 * CUT), strict=True):
                        fp[i] += row.tobytes()
            others = [c.slice(at, len(texts)) for c in b.columns[1:]]
            yield pa.RecordBatch.from_arrays([*others, *(pa.array(d.view(np.int64)) for d in digest), pa.array(fp, pa.binary())], names=[*b.schema.names[1:], "d1", "d2", "fp"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, fp) batches to (key, node, words that prune): one row for each segment, known by its place and bits."""
    cut = CUT * 64 // SEGMENT
    for big in batches:
        for at in range(0, big.num_rows, 1000):
            b = big.slice(at, 1000)
            nodes, fps = b.column(0).to_numpy(), b.column(1).to_pylist()
            for part in (0, 1):  # the segments of all sets, then those that small sets have besides
                own = np.array([i for i, x in enumerate(fps) if len(x) >= 8 * (CHECKED + (part + 1) * CUT)], np.int64)
                if not len(own):
                    continue
                words = np.stack([np.frombuffer(fps[i], U, CHECKED) for i in own])
                body = np.stack([np.frombuffer(fps[i], np.uint8, 8 * CUT, 8 * (CHECKED + part * CUT)) for i in own])
                bits = np.unpackbits(body, axis=1)[:, : cut * SEGMENT].reshape(len(own), cut, SEGMENT)
                key = bits @ (1 << np.arange(SEGMENT, dtype=np.int32)) + ((part * cut + np.arange(cut, dtype=np.int32)) << SEGMENT)
                cols = [pa.array(key.astype(np.int32).ravel()), pa.array(np.repeat(nodes[own], cut))]
                cols += [pa.array(np.repeat(words[:, k].view(np.int64), cut)) for k in range(CHECKED)]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "node", *(f"w{k}" for k in range(CHECKED))])


def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Marks rows of words (last axis) that pass the chain test and the Hamming check in each word and the check over all."""
    x, y = np.broadcast_arrays(x, y)
    out = np.bitwise_count(x[..., 0] ^ y[..., 0]) <= BUDGET  # most rows end here
    at = np.nonzero(out)
    for k in range(CHECKED):
        keep = within(x[..., k][at] ^ y[..., k][at], BUDGET)
        at = tuple(i[keep] for i in at)
    keep = np.bitwise_count(x[at] ^ y[at]).sum(-1) <= BUDGET_ALL
    out = np.zeros(out.shape, bool)
    out[tuple(i[keep] for i in at)] = True
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole buckets from batches in order of key, about ``TAKEN`` rows at a time."""
    held, n, goal = [], 0, TAKEN
    for b in batches:
        held.append([c.to_numpy() for c in b.columns])
        n += b.num_rows
        if n >= goal:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last bucket may go on
            if cut:
                yield [c[:cut] for c in cols]
            held, n = [[c[cut:] for c in cols]], n - cut
            goal = max(TAKEN, 2 * n)
    if n:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _lowest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Lowest place reachable from each of ``n`` places over the links (a, b)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        nxt = low.copy()
        np.minimum.at(nxt, a, m)
        np.minimum.at(nxt, b, m)
        nxt = nxt[nxt]
        if (nxt == low).all():
            return low
        low = nxt


def _forest(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(a, b) batch of a star for each set of nodes that the edges join: every other node once, with the smallest."""
    node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = _lowest(place[: len(a)], place[len(a) :], len(node))
    moved = np.flatnonzero(low != np.arange(len(node)))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[low[moved]])], names=["a", "b"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) batches in order of a to fewer edges that join the same nodes."""
    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= EDGES:
            yield _forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield _forest(*(np.concatenate(c) for c in zip(*held, strict=True)))


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges that join the same nodes as (a, b), about one a node.

    A large group meets in many buckets or block pairs, each with a smallest node of its own. Here all
    edges of a node come together, at most one from each of these, and its many leads become one star.
    """
    return edges.repartition("a").sortWithinPartitions("a").mapInArrow(_contract, "a long, b long")


def _group(words: np.ndarray) -> np.ndarray:
    """``_lowest`` of one large bucket: whoever is found near leaves the rest, so a group of copies takes few rounds."""
    low, rest = np.arange(len(words)), np.arange(len(words))
    while len(rest):
        lead, rest = rest[0], rest[1:]
        queue = [lead]
        while queue and len(rest):
            hit = near(words[rest], words[queue.pop()])
            low[rest[hit]] = lead
            queue.extend(rest[hit])
            rest = rest[~hit]
    return low


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, words) batches in order of key to (a, b): all that near fingerprints in some bucket join, as stars."""
    for key, node, *words in _buckets(batches):
        words = np.stack(words, 1).view(U)
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(begin, len(key)))
        low = np.arange(len(key))
        for at, n in zip(begin[size > HOT], size[size > HOT], strict=True):
            low[at : at + n] = at + _group(words[at : at + n])
        after = np.repeat(begin + size, size) - 1 - low  # rows of the bucket behind each
        after[np.repeat(size > HOT, size)] = 0
        left, right, row, step = [low[:0]], [low[:0]], np.flatnonzero(after > 0), 1
        while len(row):
            hit = row[near(words[row], words[row + step])]
            left.append(hit)
            right.append(hit + step)
            step += 1
            row = row[after[row] >= step]
        low = np.minimum(low, _lowest(np.concatenate(left), np.concatenate(right), len(key)))
        moved = np.flatnonzero(low != np.arange(len(key)))
        yield _forest(node[moved], node[low[moved]])


def _sets(batches: Iterator[pa.RecordBatch], hit) -> Iterator[pa.RecordBatch]:
    """(file, at, h, text) batches to the shingle sets of rows whose ``h`` may be wanted."""
    for b in batches:
        b = b.filter(pa.array(hit(b.column(2).to_numpy(), b.column(2).to_numpy() >> 24)))
        for at, texts in text_chunks(b.column(3)):
            h, has, seg = shingle_sets(texts)
            parts = [b""] * len(texts)
            for i, part in zip(has, np.split(h, seg[1:]), strict=True) if len(has) else ():
                parts[i] = part.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), b.column(1).slice(at, len(texts)), pa.array(parts, pa.binary())], names=["_file", "_at", "shingles"])


def _links(pdf):
    """Links of one block pair at ``SIMILAR`` or more, as a star per linked group: never all pairs."""
    import pandas as pd

    pdf = pdf.sort_values("node")  # a star is led by its smallest, so that block pairs agree on few leads
    nodes, fps = pdf["node"].to_numpy(), np.stack([np.frombuffer(x, U, CHECKED) for x in pdf["fp"]])
    like = near(fps[:, None], fps[None, :])
    apart = like.sum(1) > 1
    if not apart.any():
        return pd.DataFrame({"a": nodes[:0], "b": nodes[:0]})
    pdf, nodes, like = pdf[apart], nodes[apart], like[np.ix_(apart, apart)]
    sets = [np.frombuffer(s, U) for s in pdf["shingles"]]
    size = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    met = times[column] > 1
    owner, column = np.repeat(np.arange(len(nodes)), size)[met], (np.cumsum(times > 1) - 1)[column[met]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(nodes), len(nodes)), np.float32)  # counts under 2**24 are exact
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        holds = np.zeros((len(nodes), min(4096, int(column[-1]) + 1 - first)), np.float32)
        holds[owner[a:b], column[a:b] - first] = 1
        common += holds @ holds.T
    linked = like & (common >= SIMILAR * (size[:, None] + size - common.astype(np.float64)) - 1e-6)
    root = np.arange(len(nodes))
    for row in linked:
        old = np.unique(root[row])
        if len(old) > 1:
            root[np.isin(root, old)] = old[0]
    moved = root != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})


def near_copy_classes(docs: DataFrame) -> DataFrame:
    """``_file``, ``_at``, ``id`` and ``root`` of every row (these and ``text``): texts linked at similarity ``SIMILAR`` or more share a root.

    Texts of fewer than ``WORDS`` words are one shingle; null and blank texts are alike. Equal sets meet by
    digest. Others meet in buckets of equal fingerprint segments, where those that stay near by chain test
    and Hamming check are joined; all near ones of a joined group are compared exactly, once. A pair at
    ``SIMILAR`` that meets in no segment is missed, with the probabilities given above. The table returned
    is materialised.
    """
    kind = docs.schema["id"].dataType.simpleString()
    sketch = docs.select("text", "_file", "_at", "id").mapInArrow(_sketches, f"_file long, _at long, id {kind}, d1 long, d2 long, fp binary")
    sketch = materialize(sketch.withColumn("rid", F.monotonically_increasing_id()))
    same = materialize(sketch.groupBy("d1", "d2").agg(F.min(F.struct("rid", "_file", "_at")).alias("one"), F.first("fp").alias("fp")).select("d1", "d2", "one.*", "fp").withColumnRenamed("rid", "node"))
    words = ", ".join(f"w{k} long" for k in range(CHECKED))
    keyed = same.filter("length(fp) > 0").select("node", "fp").mapInArrow(_segments, f"key int, node long, {words}")
    met = keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_meet, "a long, b long")
    inside = materialize(connected_components(_contracted(met), "a", "b").withColumnRenamed("component", "group"))
    members = same.join(inside, "node").select("node", "_file", "_at", "fp")
    known = F.xxhash64("_file", "_at").alias("h")
    hit = bit_filter(members.select(known, F.shiftright(known, 24).alias("h2")), "h", "h2")
    found = docs.select("_file", "_at", known, "text").mapInArrow(lambda it: _sets(it, hit), "_file long, _at long, shingles binary")
    sets = materialize(found.join(members.hint("merge"), ["_file", "_at"]).select("node", "fp", "shingles"))
    sizes = materialize(inside.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    placed = inside.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = placed.select("group", "node", F.least("own", "o").alias("x"), F.greatest("own", "o").alias("y")).join(sets, "node")
    links = pairs.groupBy("group", "x", "y").applyInPandas(_links, "a long, b long")
    linked = connected_components(_contracted(links), "a", "b")
    discard(inside, sizes, sets)
    named = sketch.select("_file", "_at", "id", "d1", "d2").join(same.select("d1", "d2", "node"), ["d1", "d2"]).join(linked, "node", "left")
    out = materialize(named.select("_file", "_at", "id", F.coalesce("component", "node").alias("root")))
    discard(sketch, same)
    return out
