"""SimHash fingerprints of word shingles and near-duplicate classes by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import connected_components, discard, identified, materialize

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
# The five 64-bit primes of the published XXH64 hash function.
P1, P2, P3, P4, P5 = map(U, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64_slices(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many slices of one byte buffer. Slices under 32 bytes are hashed together in numpy."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(padded, (len(buf) + 1, 8), (1, 1))
    out = np.empty(len(start), U)
    for at in range(0, len(start), 1 << 16):
        s, n = start[at : at + (1 << 16)], length[at : at + (1 << 16)]
        with np.errstate(over="ignore"):
            acc = U(seed) + P5 + n.astype(U)
            for i in range(3):
                k = np.flatnonzero(n >= 8 * i + 8)
                lane = lanes[s[k] + 8 * i].view("<u8")[:, 0]
                acc[k] = _rotl(acc[k] ^ (_rotl(lane * P2, 31) * P1), 27) * P1 + P4
            k = np.flatnonzero(n & 4)
            lane = lanes[s[k] + (n[k] & ~7)].view("<u4")[:, 0].astype(U)
            acc[k] = _rotl(acc[k] ^ (lane * P1), 23) * P2 + P3
            for j in range(3):
                k = np.flatnonzero((n & 3) > j)
                acc[k] = _rotl(acc[k] ^ (padded[s[k] + (n[k] & ~3) + j].astype(U) * P5), 11) * P1
            acc ^= acc >> U(33)
            acc *= P2
            acc ^= acc >> U(29)
            acc *= P3
            acc ^= acc >> U(32)
        for k in np.flatnonzero(n >= 32):
            acc[k] = xxhash.xxh64_intdigest(buf[s[k] : s[k] + n[k]].tobytes(), seed)
        out[at : at + (1 << 16)] = acc
    return out


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """XXH64 of every ``width``-word shingle (A-Z lower-cased) in order; the texts that have any; how many each has."""
    raw = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    gap = SPACE[raw]
    first = ~gap
    first[1:] &= gap[:-1]
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    words = np.diff(np.searchsorted(np.flatnonzero(first), np.concatenate([[0], ends_at])))  # per text
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    norm = raw[keep]
    if not words.any():
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sep = SPACE[norm]
    norm[sep] = 0x20
    begin = np.flatnonzero(np.concatenate([[True], sep[:-1]]))
    stop = np.flatnonzero(sep)
    shingles = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    at_word = np.concatenate([[0], np.cumsum(words)[:-1]])
    has = np.flatnonzero(shingles)
    n = shingles[has]
    seg = np.concatenate([[0], np.cumsum(n)[:-1]])
    i = np.arange(n.sum()) - np.repeat(seg - at_word[has], n)
    last = i + np.repeat(np.minimum(words[has], width) - 1, n)
    return xxh64_slices(norm, begin[i], stop[last] - begin[i]), has, n


def majority(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One 64-bit SimHash per group of ``n`` hashes in a row: bits that are set in over half of them."""
    seg = np.concatenate([[0], np.cumsum(n)[:-1]])
    out = np.zeros(len(n), U)
    # eight bits at a time in the bytes of a word, in runs short enough not to overflow a byte
    cuts = np.unique(np.concatenate([seg, *(s + np.arange(255, c, 255) for s, c in zip(seg, n, strict=True) if c > 255)]))
    owner = np.searchsorted(seg, cuts, side="right") - 1
    first_run = np.searchsorted(owner, np.arange(len(seg)))
    for bit in range(8):
        part = np.add.reduceat((h >> U(bit)) & U(0x0101010101010101), cuts)
        counts = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for byte in range(8):
            out |= (2 * counts[:, byte] > n).astype(U) << U(8 * byte + bit)
    return out


def fingerprints(texts: list[bytes], width: int = 3) -> np.ndarray:
    """One 64-bit SimHash per text: lower-cased A-Z, ``width``-word shingles, majority of XXH64 bits."""
    out = np.zeros(len(texts), U)
    h, has, n = shingle_hashes(texts, width)
    if len(has):
        out[has] = majority(h, n)
    return out


def text_chunks(column: pa.Array, chunk_bytes: int = 4 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of bounded chunks; a null is the empty text."""
    texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= chunk_bytes):
            size += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


def fingerprint_batches(batches: Iterator[pa.RecordBatch], chunk_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to (id, fp) batches, in bounded chunks of text."""
    for b in batches:
        fps = np.concatenate([np.zeros(0, U), *(fingerprints(texts) for _, texts in text_chunks(b.column(1), chunk_bytes))])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])


# ---- classes over whole tables -------------------------------------------------------------

SEGMENTS, BUDGET = 4, 3
#: Buckets with more distinct fingerprints than this are compared block by block instead of by a join.
HOT_BUCKET, BLOCK = 512, 2048


def _turned(fp: Column, i: int) -> Column:
    """The fingerprint rotated so that segment ``i`` is on top."""
    k = 64 // SEGMENTS * i
    return fp if k == 0 else F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k))


def _keys(fps: DataFrame) -> DataFrame:
    """Rows (seg, key, fp, cleared): a segment and its successor, exact or with one set bit of the successor cleared.

    Two fingerprints whose first segment is equal and whose second differs in at most one bit share
    an exact key with a key of the other kind, because the one with the extra bit clears it.
    """
    turned = [_turned(F.col("fp"), i) for i in range(SEGMENTS)]
    heads = F.array(*[F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned(t, 32).alias("key")) for i, t in enumerate(turned)])
    bits = F.array(*[F.lit(0), *[F.lit(1 << b) for b in range(16)]])
    flat = fps.select("fp", F.explode(heads).alias("h")).select("fp", "h.seg", "h.key")
    return flat.select("seg", "fp", F.explode(F.filter(bits, lambda x: (x == 0) | (F.col("key").bitwiseAND(x.cast("long")) != 0))).alias("bit"), "key").select(
        "seg", F.col("key").bitwiseAND(F.bitwise_not(F.col("bit").cast("long"))).alias("key"), "fp", (F.col("bit") != 0).alias("cleared")
    )


def _chain(a: Column, b: Column, seg: Column) -> Column:
    """Pigeonring test: every chain of 1..4 consecutive segments stays within its share of the budget."""
    test = F.lit(False)
    for i in range(SEGMENTS):
        diff = _turned(a.bitwiseXOR(b), i)
        ok = F.lit(True)
        for n in range(1, SEGMENTS + 1):
            head = diff if n == SEGMENTS else F.shiftrightunsigned(diff, 64 - 64 // SEGMENTS * n)
            ok = ok & (F.bit_count(head) <= n * BUDGET // SEGMENTS)
        test = test | ((seg == i) & ok)
    return test


def within(x: np.ndarray, budget: int) -> np.ndarray:
    """Marks XORs of fingerprints that pass the chain test of some segment and the full Hamming check at ``budget``."""
    part = 64 // SEGMENTS
    count = np.stack([np.bitwise_count((x >> U(64 - part * (i + 1))) & U((1 << part) - 1)) for i in range(SEGMENTS)]).astype(np.int16)
    out = np.zeros(x.shape, bool)
    for i in range(SEGMENTS):
        ok, total = np.ones(x.shape, bool), np.zeros(x.shape, np.int16)
        for n in range(SEGMENTS):
            total += count[(i + n) % SEGMENTS]
            ok &= total * SEGMENTS <= (n + 1) * budget
        out |= ok
    return out


def _hot_links(pdf):
    """Links inside one pair of blocks of a hot bucket, as a star per linked group: never all pairs."""
    import pandas as pd

    left, right = pdf[pdf["side"] == 0]["fp"].to_numpy(), pdf[pdf["side"] == 1]["fp"].to_numpy()
    nodes = np.unique(np.concatenate([left, right]))
    root = np.arange(len(nodes))
    place = np.searchsorted(nodes, right)
    for x in left:
        near = np.bitwise_count((right ^ x).view(U)) <= BUDGET
        group = np.append(place[near], np.searchsorted(nodes, x))
        old = np.unique(root[group])
        root[np.isin(root, old)] = old[0]
    moved = root != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})


def similar_pairs(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect every two of the distinct fingerprints at ``BUDGET`` or fewer differing bits.

    ``fps`` has one column ``fp`` of distinct longs. Candidates come from pigeonring keys; a chain
    test prunes them before the full Hamming check. Buckets over ``HOT_BUCKET`` are compared in
    pairs of bounded blocks that give star links, so a large group of near copies stays linear in rows.
    """
    keys = materialize(_keys(fps))
    hot = materialize(keys.groupBy("seg", "key").count().filter(F.col("count") > HOT_BUCKET))
    exact = keys.filter(~F.col("cleared")).select("seg", "key", F.col("fp").alias("b"))
    cool = keys.join(F.broadcast(hot.select("seg", "key")), ["seg", "key"], "left_anti") if hot.limit(100_001).count() <= 100_000 else keys.join(hot, ["seg", "key"], "left_anti")
    pairs = cool.join(exact, ["seg", "key"]).filter(F.col("cleared") | (F.col("fp") < F.col("b")))
    pairs = pairs.filter(_chain(F.col("fp"), F.col("b"), F.col("seg"))).select(F.col("fp").alias("a"), "b")
    if hot.isEmpty():
        return pairs
    inside = keys.join(hot, ["seg", "key"]).withColumn("n", F.ceil(F.col("count") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    spread = inside.select("seg", "key", "fp", "own", other.alias("o")).select(
        "seg", "key", "fp", F.least("own", "o").alias("x"), F.greatest("own", "o").alias("y"), "own"
    )
    sides = spread.select("seg", "key", "x", "y", "fp", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.lit(0), F.lit(1))).when(F.col("own") == F.col("x"), F.array(F.lit(0))).otherwise(F.array(F.lit(1)))).alias("side"))
    return pairs.unionByName(sides.groupBy("seg", "key", "x", "y").applyInPandas(_hot_links, "a long, b long"))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate classes of whole texts: ``doc_id``, ``fp`` (long), ``component_id``.

    Null and blank texts have fingerprint zero and link like any other. Ties and repeated rows each
    keep their own output row; extra columns are ignored. A null id takes part but never names a
    class unless the whole class has null ids. An empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fps = materialize(src.mapInArrow(fingerprint_batches, "doc_id long, fp long"))
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    linked = connected_components(similar_pairs(distinct.select("fp")), "a", "b").withColumnRenamed("node", "fp")
    named = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("component", "fp")).select("fp", "rep", "root")
    low = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = materialize(named.join(low, "root").select("fp", "component_id"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each class of near copies (five-word shingles, similarity 0.8): that of the smallest id (nulls last), then the first in file order.

    Null and blank texts are one class. Repeated rows are copies; other columns are carried along,
    whatever their names; an empty table gives no rows.
    """
    from folio.llm.nearcopies import near_copy_classes

    rows = identified(docs)
    classes = near_copy_classes(rows.select("_file", "_at", F.col("_row.text").cast("string").alias("text"), F.col("_row.doc_id").alias("id")))
    order = F.struct(F.col("id").isNull(), "id", "_file", "_at")
    # a table of its own, so that the rows of a very large class can be split in the join
    first = materialize(classes.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first._file").alias("file0"), F.col("first._at").alias("at0")))
    gone = materialize(classes.join(first, "root").filter("_file <> file0 or _at <> at0").select("_file", "_at"))
    discard(classes, first)
    # joined alike at every size: what goes grows with the corpus
    return rows.join(gone.hint("merge"), ["_file", "_at"], "left_anti").select("_row.*")
