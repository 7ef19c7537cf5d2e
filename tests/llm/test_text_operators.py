"""Operators on documents against brute force, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from folio.llm import lm, mixing, packing, pii, sharding, simhash, spans, toxicity
from folio.llm.entry import vocabulary_paths
from tests.llm.conftest import rows


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# ---- mixing


def test_mix_reaches_targets(docs):
    out = mixing.mix(mixing.sized_documents(docs)).collect()
    assert len(out) == len(rows())
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = {s: w for s, w in weights.items() if s not in full}
        rest = total - sum(2 * sizes[s] for s in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weights[s] / sum(free.values()) for s in sizes}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in out:
        assert 0 <= r["copies"] <= 2
        s = None if r["src"] == "n" else r["src"][1:]
        assert math.isclose(r["target"], target[s], rel_tol=1e-9) and r["source_size"] == sizes[s]
        taken[s] += r["copies"] * r["size"]
    for s in sizes:
        longest = max(len(words(r[1])) for r in rows() if r[3] == s)  # copies are whole
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], longest / 2)


def test_mix_repeats_and_keeps_columns(docs, no_docs):
    a, b = (sorted(map(str, mixing.mix_documents(d).collect())) for d in (docs, docs.repartition(7)))
    assert a == b
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mix(mixing.sized_documents(no_docs)).count() == 0


def test_tilts_solve_the_dual(spark):
    sized = spark.createDataFrame([("va", 10, 1), ("va", 200, 2), ("va", 3, 3), ("vb", 5, 4)], "src string, size long, doc_id long")
    targets = mixing.source_targets(sized)
    lam = {r["src"]: r for r in mixing.tilts(sized, targets).collect()}
    goal = {r["src"]: r["target"] for r in targets.collect()}
    got = sum(n * min(2, math.exp(lam["va"]["tilt"] * n / lam["va"]["scale"])) for n in (10, 200, 3))
    assert abs(got - goal["va"]) < 0.3


# ---- personal data

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((x - 9 if x > 9 else x) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)]) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(RULES.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email") or (kind == "ip" and all(int(p) < 256 for p in m.group().split("."))) or (kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    names = list(RULES)
    return [f"{names[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_personal_data_matches_the_rules(spark, docs):
    hard = ["a@b.c_d@e.f", "1" * 3000, "1 " * 3000 + "x", "4111111111111111 " * 700, "a" * 5000 + "@", "x@y." * 400, "+1" + "-" * 3000 + "2", "1.2.3.4.5.6.7.8", "0000255.1.1.1 256.1.1.1", "5105-1051 0510-5100é", "😀+49 30 1234567"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    want = Counter()
    for i, t in [*((1000 + i, t) for i, t in enumerate(hard)), *((r[0], r[1]) for r in rows())]:
        b = base_spans(t)
        want[i, *[sum(x.startswith(k) for x in b) for k in RULES], hashlib.sha256(",".join(b).encode()).hexdigest()] += 1
    out = pii.personal_data(more).collect()
    assert Counter(tuple(r)[:6] for r in out) == want
    for r in out:
        own = next(t for i, t in [*((1000 + i, t) for i, t in enumerate(hard)), *((x[0], x[1]) for x in rows())] if i == r["doc_id"])
        assert set(base_spans(own)) <= set(r["spans"].split(",")) | {""}


def test_redaction_covers_base_spans(docs, no_docs):
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[500]["text"].startswith("mail [EMAIL] or call [PHONE], ip [IP] card [CARD] bad ") and got[500]["n_chars"] == len(got[500]["text"])
    assert got[300]["text"] is None and got[301]["text"] == ""
    assert pii.redact(no_docs).count() == 0


def test_classifier_adds_marked_spans(spark):
    texts = [f"please write email person{i}@site.example.com now" for i in range(40)] + [f"call +1 (234) 555-{1000 + i} now" for i in range(40)]
    texts += ["my email is ann (at) site (dot) com thanks", "phone (234) 555-9876 thanks"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    assert got[80] == f"email:12:{12 + len('ann (at) site (dot) com')}"


# ---- packing


def test_packing_round_trip(docs, no_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary_paths()[0])
    ids = {}
    for r in rows():
        ids.setdefault(r[0], [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2])
    out = packing.pack(docs, *vocabulary_paths()).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for p in out:
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(own) == p["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == p["ids_crc32"]
        pieces[p["doc_id"]].append((p["piece"], p["start"], p["length"]))
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    copies = Counter(r[0] for r in rows())
    for doc, own in pieces.items():
        want = [(k, s, n) for k, (s, n) in enumerate(packing.cut(np.array(ids[doc], "<u4").tobytes(), 1024))]
        assert sorted(own) == sorted(want * copies[doc])
    used = 0
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
        used += end
    assert len(places) <= -(-used // 1024) + 2
    assert packing.pack(no_docs, *vocabulary_paths()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_exact_covers(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 1025, 3000) if seed % 2 else np.minimum(1024, rng.geometric(0.004, 3000))
    h = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    slots, made = packing.best_plan(h)
    bins, ranks = defaultdict(list), defaultdict(list)
    for n, r, c, seq, off in slots:
        ranks[n] += range(r, r + c)
        for i in range(c):
            bins[seq + i].append((off, n))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in h.items()}
    for own in bins.values():
        end = 0
        for off, n in sorted(own):
            assert off == end
            end += n
        assert end <= 1024
    assert len(bins) == made <= math.ceil(lengths.sum() / 1024) * 1.06 + 2


def test_special_string_and_scripts_encode_like_the_tokenizer():
    from tokenizers import Tokenizer

    enc, tok = packing.Encoder(*vocabulary_paths()), Tokenizer.from_file(vocabulary_paths()[0])
    for t in ("", "a<|endoftext|>b", "日本語 テスト", "“x” — ½ ² don't  \n\n x ", "İı ſ ǅ", "a\x85b\xa0c", "٣٤ ४"):
        assert enc.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


# ---- toxicity


def test_every_sign_encodes_like_the_tokenizer():
    """Each code point between letters, digits, spaces and its own kind, against the tokenizer."""
    enc = packing.Encoder(*vocabulary_paths())
    for first in range(0, 0x30000, 64):
        signs = [chr(c) for c in range(first, first + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"ab{c}cd {c}{c} 1{c}2\n{c}" for c in signs)
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == enc.whole.encode(text, add_special_tokens=False).ids, hex(first)


def test_matcher_equals_edit_distance():
    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
        return d[-1]

    terms = ["idiot", "pathetic", "scum", "worthless"]
    m = toxicity.Matcher([t + "$" for t in terms] + ["lowei"])
    rng = np.random.default_rng(0)
    for _ in range(3000):
        w = list(terms[rng.integers(4)])
        for _ in range(rng.integers(0, 4)):
            k = int(rng.integers(1, len(w)))
            kind = rng.integers(3)
            w[k : k + (kind != 0)] = [] if kind == 1 else ["aeiotsx"[rng.integers(7)]]
        w = "".join(w)
        allowed = {"idiot": 1, "pathetic": 2, "scum": 0, "worthless": 2}
        near = [(d, i) for i, t in enumerate(terms) if t[0] == w[0] and (d := distance(t, w)) <= allowed[t]]
        got = m.match(w)
        assert (got is None) == (not near) and (not near or got[1] == min(near)[0]), w
    assert m.match("loweiung") == (4, 0) and m.match("lowe") is None


def test_misspelled_first_letters_stems_and_short_terms_are_hits():
    m = toxicity.Matcher(["idiot$", "scum$", "lowei", "bad$"], loose=True)
    for word, hit in {"1diot": (0, 1), "diot": (0, 1), "kidiot": (0, 1), "idiot": (0, 0), "scuum": (1, 1), "skum": (1, 1), "cum": (1, 1), "loweiung": (2, 0), "lpweiung": (2, 1), "oweiung": (2, 1)}.items():
        assert m.match(word) == hit, word
    assert m.match("bat") is None and m.match("dot") is None and m.match("scuuum") is None
    assert toxicity.Matcher(["idiot$"], loose=True, most_states=1).match("1diot") == (0, 1)
    told = toxicity.loose_weights([4.0, 4.0], [(0, 0, 50)], 100, 900)
    assert told[0] < 0 and told[1:] == [4.0] * 3
    cache = toxicity.Cache(toxicity.Matcher(["idiot$", "scum$"], loose=True), loose=told)
    assert cache["1diot"] is None and cache["idiot"] == (0, 0) and cache["skum"] == (1, 1)


def test_toxicity_learns_finds_misspellings_and_spares_quotes(spark, docs, no_docs):
    from tests.llm.conftest import prose

    bad = [(i, prose(i, 50) + " you idiot and moron " + prose(i + 1, 20)) for i in range(1000, 1120)]
    good = [(i, prose(i, 70)) for i in range(2000, 2300)]
    odd = [(3000, prose(1, 30) + " what an idi0t he is, such an idiiot " + prose(2, 20)), (3001, prose(1, 40) + " said “idiot” " + prose(2, 20)), (3002, prose(4, 40)), (3003, ""), (3004, None)]
    df = spark.createDataFrame([*bad, *good, *odd], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, 1) for i, _ in bad), *((i, 0) for i, _ in good), (None, 1), (5, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, labels).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    held = [i for i in got if got[i]["held_out"] and i < 3000]
    assert np.mean([got[i]["predicted"] == (i < 2000) for i in held]) > 0.98
    assert got[3000]["predicted"] == 1 and got[3001]["score"] < got[3000]["score"]
    assert got[3002]["predicted"] == got[3003]["predicted"] == got[3004]["predicted"] == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == docs.count()


# ---- SimHash


def brute_fingerprint(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_classes(docs, no_docs):
    data = rows()
    fps = [brute_fingerprint(r[1]) for r in data]
    comp = components(fps)
    low = defaultdict(list)
    for r, c in zip(data, comp, strict=True):
        if r[0] is not None:
            low[c].append(r[0])
    want = Counter((r[0], f, min(low[c], default=None)) for r, f, c in zip(data, fps, comp, strict=True))
    got = Counter((r[0], r[1] & (1 << 64) - 1, r[2]) for r in simhash.simhash_classes(docs).collect())
    assert got == want
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(comp))
    assert simhash.simhash_classes(no_docs).count() == 0


@pytest.mark.parametrize("block", [512, 3])
def test_stage_drops_near_copies_at_similarity(spark, monkeypatch, block):
    """Copies with one to twelve words changed, against all pairs of five-word shingle sets."""
    from folio.llm import nearcopies

    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rng, texts = np.random.default_rng(3), []
    for _ in range(20):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        for changes in (0, 1, 2, 3, 4, 4, 5, 8, 12):
            said = list(own)
            for k in rng.integers(0, 200, changes):
                said[k] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(said))
    texts += [None, "", " ", "a b", "A  b", "a b c"]
    sets = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    low = {r: min(i for i in range(len(root)) if root[i] == r) for r in set(root)}
    got = simhash.without_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(low.values())


@pytest.mark.parametrize("hot", [1024, 2])
def test_near_copies_meet_by_fingerprint_segments(monkeypatch, hot):
    """Texts at similarity 0.8, of many words and of eight and nine, are joined by segments of their SimHash; others are not."""
    import pyarrow as pa

    from folio.llm import nearcopies

    monkeypatch.setattr(nearcopies, "HOT", hot)
    texts = []
    for i in range(300):
        own = [f"w{i}_{k}" for k in range(200)]
        texts += [" ".join(own), " ".join([*own[:179], *(f"x{i}_{k}" for k in range(21))])]  # 175 of 196 shingles
        texts += [" ".join(own[50:58]), " ".join([*own[50:58], "more"])]  # 4 of 5
    texts += [None, "", texts[0]]
    out = next(nearcopies._sketches(iter([pa.record_batch({"text": texts, "node": list(range(len(texts)))})])))
    fps = [np.frombuffer(x, np.uint64) for x in out.column("fp").to_pylist()]
    assert fps[0][0] == simhash.fingerprints([texts[0].encode()], 5)[0] and not len(fps[-3]) and not len(fps[-2])
    batches = nearcopies._segments(iter([pa.record_batch({"node": out.column("node"), "fp": out.column("fp")})]))
    rows = next(batches)
    first = "".join(f"{x:08b}" for x in fps[0][nearcopies.CHECKED :].view(np.uint8))
    bits = [rows.column("key")[k].as_py() & (1 << nearcopies.SEGMENT) - 1 for k in range(3)]
    assert bits == [int(first[nearcopies.SEGMENT * k : nearcopies.SEGMENT * (k + 1)][::-1], 2) for k in range(3)]
    table = pa.Table.from_batches([rows, *batches]).sort_by("key")
    root = list(range(len(texts)))
    for b in nearcopies._meet(iter(table.to_batches(max_chunksize=1000))):
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if root[x] != root[y]:
                old, new = max(root[x], root[y]), min(root[x], root[y])
                root = [new if r == old else r for r in root]
    want = [i - i % 2 for i in range(len(texts) - 3)]
    assert root == [*want, len(texts) - 3, len(texts) - 2, 0]


@pytest.mark.parametrize("block", [512, 40])
def test_a_large_group_of_near_copies_sends_few_edges(spark, monkeypatch, block):
    """Copies with none to four words changed meet in many buckets and block pairs, but no more than one edge a node and some leads are joined."""
    from folio.llm import nearcopies

    sent, real = [], nearcopies.connected_components

    def counted(edges, a, b):
        met = nearcopies.materialize(edges)
        nodes = met.select(a).union(met.select(b)).distinct().count()
        sent.append((met.filter(f"{a} <> {b}").distinct().count(), nodes))
        return real(met, a, b)

    monkeypatch.setattr(nearcopies, "BLOCK", block)
    monkeypatch.setattr(nearcopies, "connected_components", counted)
    rng, texts = np.random.default_rng(5), []
    for i in range(500):
        said = [f"w{k}" for k in range(80)]
        for k in rng.integers(0, 80, i % 5):
            said[k] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(said))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    low = {r: min(i for i in range(len(root)) if root[i] == r) for r in set(root)}
    got = simhash.without_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(low.values())
    assert sent[0][1] > 350 and all(edges < 1.5 * nodes for edges, nodes in sent), sent


@pytest.mark.parametrize("size", [1 << 20, 7])
def test_contracted_edges_join_the_same_nodes(monkeypatch, size):
    """Random edges, also in pieces: the same sets, no loop, at most one edge a node of a piece."""
    import pyarrow as pa

    from folio.llm import nearcopies

    monkeypatch.setattr(nearcopies, "EDGES", size)
    rng = np.random.default_rng(size)
    edges = np.sort(rng.integers(0, 300, (260, 2)), axis=1)[:, ::-1]
    edges = edges[np.argsort(edges[:, 0])]

    def joined(pairs):
        root = list(range(300))
        for x, y in pairs:
            if root[x] != root[y]:
                old, new = max(root[x], root[y]), min(root[x], root[y])
                root = [new if r == old else r for r in root]
        return root

    table = pa.table({"a": edges[:, 0].copy(), "b": edges[:, 1].copy()})
    out = list(nearcopies._contract(iter(table.to_batches(max_chunksize=5))))
    got = [p for b in out for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert joined(got) == joined(edges.tolist()) and all(x > y for x, y in got)
    assert all(len(set(b.column(0).to_pylist())) == b.num_rows for b in out)
    assert list(nearcopies._contract(iter([]))) == []


@pytest.mark.parametrize("hot", [10_000, 2])
def test_links_connect_like_all_pairs(spark, monkeypatch, hot):
    """Clusters around random centres; a low limit sends every shared bucket down the block route."""
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = np.random.default_rng(hot)
    fps = {0, (1 << 64) - 1}
    for c in rng.integers(0, 1 << 63, 12):
        for _ in range(25):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    from folio.llm.common import connected_components

    pairs = simhash.similar_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"))
    node = {r["node"]: r["component"] for r in connected_components(pairs, "a", "b").collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for x, s, c in zip(fps, signed, components(fps), strict=True):
        groups[node.get(s, s)].add(x)
        want[c].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# ---- sharding


def test_shards_fit_and_are_minimal(docs, no_docs, tmp_path):
    limit = 2000
    got = sharding.shard(docs, limit).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows())
    sums = defaultdict(list)
    for r in got:
        assert len(r["prefix"]) == r["depth"]
        sums[r["prefix"], r["page"]].append(r)
    for own in sums.values():
        total = sum(r["bytes"] for r in own)
        assert total == own[0]["shard_bytes"] and (total <= limit or len(own) == 1)
    whole = defaultdict(int)
    for r in got:
        for d in range(r["depth"]):
            whole[r["prefix"][:d]] += r["bytes"]
    assert all(b > limit for b in whole.values())  # only oversized buckets split
    assert sharding.shard(no_docs).count() == 0
    sharding.write_shards(docs, f"file://{tmp_path}/shards", 100_000)
    back = docs.sparkSession.read.parquet(f"file://{tmp_path}/shards")
    assert back.count() == docs.count() and set(docs.columns) < set(back.columns)


def test_equal_rows_overflow_into_pages(spark):
    df = spark.createDataFrame([(1, "x" * 30)] * 10 + [(2, "y")], "doc_id long, text string")
    got = sharding.shard(df, 100).collect()
    pages = Counter(r["page"] for r in got if r["doc_id"] == 1)
    assert sorted(pages.values()) == [1, 3, 3, 3] and all(r["shard_bytes"] <= 100 for r in got)


# ---- language model


def test_language_scores(docs, no_docs):
    data = rows()
    said = [[*(r[1] or "").encode().lower().split(), b" "] for r in data]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in data]
    c = Counter(w for s, h in zip(said, held, strict=True) if not h for w in s)
    n, v = sum(c.values()), len(c)
    want = sorted((str(r[0]), h, len(s), sum(c[w] > 0 for w in s), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s), 4)) for r, s, h in zip(data, said, held, strict=True))
    out = lm.language_scores(docs).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 4)) for r in out) == want
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm.language_scores(no_docs).count() == 0


def test_scores_equal_a_plain_loop(docs, monkeypatch):
    """``score`` of every text from the model's own tables, one token at a time."""
    used = {}

    def known_model(spark, train, units, counts, total):
        model = lm.LogBilinear.begin(units.contexts, counts, seed=3)
        model.table[:, :-1] *= 8
        model.settle()
        used.update(model=model, units=units)
        return model, model.log_norms(np.arange(units.contexts)).astype(np.float32)

    monkeypatch.setattr(lm, "train_model", known_model)
    monkeypatch.setattr(lm, "LEAST_COUNT", 5)
    monkeypatch.setattr(lm, "CONTEXTS", 7)
    monkeypatch.setattr(lm, "HEAD", 150)
    out = lm.language_scores(docs).collect()
    model, units = used["model"], used["units"]
    own = [w[:-1] for w in units.own.to_pylist()]
    data = rows()
    said = [(r[1] or "").encode().lower().split() for r in data]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in data]
    c = Counter(w for s, h in zip(said, held, strict=True) if not h for w in s)
    assert len(own) > 7 and [c[w] for w in own] == sorted(c.values(), reverse=True)[: len(own)]
    cls = {w: int(lm.class_of(pa.array([w + b" "], pa.binary()))[0]) for s in said for w in s}
    mass = defaultdict(lambda: 0.1)
    for w, n in c.items():
        if w not in own:
            mass[cls[w]] += n + 0.1
    r1, r2, q, bias = model.r1.astype(float), model.r2.astype(float), model.q[:, :-1].astype(float), model.q[:, -1].astype(float)
    want = []
    for r, words in zip(data, said, strict=True):
        before = last = 0
        total = 0.0
        for w in [*words, None]:
            u = 0 if w is None else 1 + own.index(w) if w in own else 1 + len(own) + cls[w]
            z = (r1[before] + r2[last]) @ q.T + bias
            total += (z[u] - np.log(np.exp(z).sum())) / math.log(10)
            if w is not None:
                if w not in own:
                    total += math.log10((c[w] + 0.1) / mass[cls[w]])
                before, last = last, (1 + own.index(w) if w in own[:7] else 1 + 7 + cls[w])
        want.append((str(r[0]), round(total / (len(words) + 1), 3)))
    assert sorted((str(r["doc_id"]), round(r["score"] / r["n_tokens"], 3)) for r in out) == sorted(want)


def test_words_are_those_of_split():
    texts = [b"", b" \t", "Ab  cD\x0b\x0cä Ü\u00a0x\n".encode(), b"x" * 70_000 + b" y", b"a a A"]
    n, words, place = lm.words_of(texts)
    got = [w[:-1] for w in words.take(pa.array(place)).to_pylist()]
    assert got == [w for t in texts for w in t.lower().split()] and n.tolist() == [len(t.split()) for t in texts]
    units = lm.Units([b"a "])
    text, before, last, nxt = lm.tokens(*lm.words_of([b"a b a", b"", b"a"]), units)
    b = 2 + int(lm.class_of(pa.array([b"b "], pa.binary()))[0])
    assert text.tolist() == [0, 0, 0, 0, 1, 2, 2]
    assert list(zip(before.tolist(), last.tolist(), nxt.tolist())) == [(0, 0, 1), (0, 1, b), (1, b, 1), (b, 1, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]


def test_model_is_normalised_and_learns():
    units = lm.Units([b"a ", b"b "])
    _, *grams = lm.tokens(*lm.words_of([b"a b " * 200] * 20), units)
    counts = np.bincount(grams[2], minlength=units.targets).astype(float)
    model = lm.LogBilinear.begin(units.contexts, counts)
    model.train((tuple(g[k : k + 500] for g in grams) for k in list(range(0, len(grams[0]), 500)) * 20), 0.3, 1)
    norms = model.log_norms(np.arange(units.contexts))
    all_units = np.arange(units.targets)
    for h1, h2 in ((0, 0), (1, 2), (2, 1), (9, 200)):
        p = 10 ** model.log10(norms, np.full(len(all_units), h1), np.full(len(all_units), h2), all_units)
        assert abs(p.sum() - 1) < 1e-4
    assert 10 ** model.log10(norms, np.array([1]), np.array([2]), np.array([1]))[0] > 0.8 > counts[1] / counts.sum()


def test_training_meets_every_token(spark, monkeypatch):
    """Each row of the parameters that some text meets has moved, over several parts and passes."""
    monkeypatch.setattr(lm, "ROUND", 300)
    texts = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(60))) for i in range(20)]
    units = lm.Units([f"w{k} ".encode() for k in range(40)])
    _, h1, h2, u = lm.tokens(*lm.words_of([t.encode() for _, t in texts]), units)
    counts = np.bincount(u, minlength=units.targets).astype(float)
    train = spark.createDataFrame(texts, "doc_id long, text string").select(F.col("text").cast("binary").alias("text"), F.pmod(F.xxhash64("doc_id"), F.lit(840)).alias("part"))
    model, norms = lm.train_model(spark, train, units, counts, len(u))
    moved = (model.table != lm.LogBilinear.begin(units.contexts, counts).table).any(1)
    met = np.unique(np.concatenate([h1, units.contexts + h2, 2 * units.contexts + u]))
    assert moved[met].all() and norms.shape == (units.contexts, units.contexts)


# ---- sentence spans

SIGN = "[\u3000-\ud7ff\uf000-\U0003ffff]"


def plain_sentences(text, longest):
    """Lists of words (lower A-Z), cut by the rules one word at a time."""
    found = list(re.finditer(rf"{SIGN}|(?:(?!{SIGN})[^\x20\x09-\x0d])+", text))
    out = []
    for k, m in enumerate(found):
        before = found[k - 1] if k else None
        if not k or "\n" in text[before.end() : m.start()] or before.group() in "。！？｡" or (before.group()[-1] in ".!?" and before.end() < m.start()):
            out.append([])
        out[-1].append(re.sub("[A-Z]+", lambda x: x.group().lower(), m.group()))
    cut = []
    for s in out:
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in s]
        at = {0}
        if len(s) > longest:
            for i in range(len(s) - longest + 1):
                window = h[i : i + longest]
                at.add(i + max(j for j, x in enumerate(window) if x == min(window)))
        at = [*sorted(at), len(s)]
        cut += [s[x:y] for x, y in zip(at, at[1:])]
    return cut


def plain_runs(parts, least):
    out = []
    for a in range(len(parts)):
        b = next((b for b in range(a, len(parts) + 1) if sum(map(len, parts[a:b])) >= least), None)
        if b is not None:
            out.append((a, b))
    if out and out[-1][1] < len(parts):
        out.append((max(a for a in range(len(parts)) if sum(map(len, parts[a:])) >= least), len(parts)))
    return out


def plain_dedup(table, least, longest):
    """(id, sentences, removed places) of each row, by a loop over all runs in order."""
    order = sorted(range(len(table)), key=lambda i: (table[i][0] is None, table[i][0] or 0, i))
    cuts = [plain_sentences(t or "", longest) for _, t in table]
    seen, out = {}, [None] * len(table)
    for i in order:
        off = set()
        for a, b in plain_runs(cuts[i], least):
            key = tuple(w for s in cuts[i][a:b] for w in s)
            if seen.setdefault(key, (i, a)) != (i, a):
                off.update(range(a, b))
        out[i] = (table[i][0], len(cuts[i]), sorted(off))
    return out


def passages():
    rng = np.random.default_rng(4)
    own = lambda n: " ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 6))) + str(rng.choice(["", "", "", ",", ".", "!\n"])) for _ in range(n))
    shared = [own(n) for n in (51, 55, 70, 120)] + ["数据处理系统需要检查每一个文件的内容并且删除重复的段落。这样模型就不会多次看到相同的文字！最后的结果保存在磁盘上供以后使用。" * 2]
    table = [(int(i), " ".join([own(int(rng.integers(0, 40))), *(x for k in rng.permutation(5)[: rng.integers(0, 3)] for x in (shared[k], own(9)))])) for i in rng.permutation(60)]
    return shared, [*table, (None, shared[0]), (7, table[7][1]), (7, None), (61, ""), (62, " \n\t"), (63, "the " * 300 + "x" * 60_000), (64, "END. " * 40)]


@pytest.mark.parametrize(("least", "longest"), [(30, 10), (6, 4)])
def test_spans_equal_a_plain_loop(spark, least, longest):
    _, table = passages()
    df = spark.createDataFrame([(i, t, "x") for i, t in table], "doc_id long, text string, file string").coalesce(1)
    got = spans.dedup_spans(df, least, longest).collect()
    want = plain_dedup(table, least, longest)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r["doc_id"], r["n_sentences"], list(r["removed"])) for r in got], key=key) == sorted(want, key=key)
    assert all(r["n_removed"] == len(r["removed"]) for r in got)


def test_spans_find_every_passage_of_fifty_one_words(spark):
    shared, table = passages()
    got = {r["doc_id"]: r for r in spans.dedup_spans(spark.createDataFrame([(i, t) for i, t in table if i is not None and i < 60 and i != 7], "doc_id long, text string")).collect()}
    seen = set()
    for i, t in sorted((x for x in table if x[0] in got), key=lambda x: x[0]):
        held = {k for k, p in enumerate(shared) if p in t}
        assert (got[i]["n_removed"] > 0) == bool(held & seen), i
        if got[i]["n_removed"] == 0:
            assert got[i]["text"] == t
        seen |= held


def test_spans_keep_the_first(spark, docs, no_docs):
    p = "Alpha one two. Beta three four! Gamma five? Delta six. "
    df = spark.createDataFrame([(5, "Own start. " + p + "Own end."), (2, p + "Tail."), (9, "Lead. " + p.upper().replace(" ", "  ")), (7, p + "Mid. " + p), (8, None), (1, ""), (3, "Alpha one two. Beta three four! Other."), (None, p)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in spans.dedup_spans(df, 7, 4).collect()}
    assert got[2]["n_removed"] == 0 and got[2]["text"] == p + "Tail."
    assert got[5]["text"] == "Own start. Own end." and got[5]["removed"] == [1, 2, 3, 4]
    assert got[9]["text"].strip() == "Lead."
    assert got[7]["text"] == "Mid. " and got[None]["text"] == ""
    assert got[8]["text"] is None and got[1]["text"] == "" and got[3]["n_removed"] == 0
    assert spans.dedup_spans(no_docs).count() == 0
    out = spans.dedup_spans(docs).collect()
    assert len(out) == len(rows())
    twice = sorted(r["n_removed"] for r in out if r["doc_id"] == 200)
    assert twice[1] > 0


def test_ids_survive(docs):
    assert docs.filter(F.col("doc_id").isNull()).count() == 1
