"""Each stage on its own input against a plain Python version, and the whole on a small table."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import pii, toxicity
from folio.llm.entry import vocabulary_paths
from tests.llm.conftest import DOCS, prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Labelled prose with two bad words, copies, personal data, nulls, empty and repeated rows, clashing names; and a folder with its labels."""
    rows, labels = [], []
    for i in range(160):
        bad = i % 5 == 0
        words = prose(i, 70).split()
        if bad:
            words[20:20] = ["blargh", "snorkfiend"]
        if i % 7 == 1:
            words[9:9] = ["write", "to", f"user{i}@mail.example.org", "or", "call", f"+1 (234) 555-{1000 + i}"]
        rows.append((i, " ".join(words), "en", f"s{i % 3}"))
        labels.append((i, 1, int(bad)))
    near = rows[3][1].split()
    near[30] = "changed"
    rows += [(200, rows[3][1], "en", "s1"), (201, " ".join(near), "en", "s2"), (202, rows[4][1], None, None), (202, rows[4][1], None, None)]
    rows += [(300, None, None, None), (301, "", "en", None), (None, prose(777, 50), "en", "s0"), (302, "x" * 30_000 + " " + prose(8, 5000), "en", "s0"), (303, "you blargh snorkfiend", "en", "s1")]
    full = [(i, t, lang, s, None if t is None else len(t), "9", "many", "v", None) for i, t, lang, s in rows]
    folder = f"file://{tmp_path_factory.mktemp('small')}"
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), folder


def plain(rows):
    return Counter(tuple(r) for r in rows)


def test_toxicity_drops_what_a_plain_score_rejects(spark, small):
    docs, folder = small
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    matcher = toxicity.Matcher(model["terms"], loose=True)
    keep = []
    for r in docs.collect():
        x, _ = toxicity.features(r["text"] or "", matcher, toxicity.Cache(matcher, loose=model["loose"]), model["weights"], model["loose"])
        if 1 / (1 + math.exp(-float(np.dot(x, model["theta"])))) < toxicity.THRESHOLD:
            keep.append(r)
    got = STAGES["toxicity"](spark, docs, folder)
    assert got.columns == docs.columns and plain(got.collect()) == plain(keep)
    left = {r["doc_id"] for r in keep}
    assert 303 not in left and not left & set(range(0, 160, 5)) and {1, 2, 3, 200, 300, 301, None} <= left


def test_dedup_keeps_one_of_each_class(spark, small):
    docs, folder = small
    rows = docs.collect()
    sets = []
    for r in rows:
        w = re.sub("[A-Z]+", lambda m: m.group().lower(), r["text"] or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    want = Counter()
    for c in set(root):
        own = [r for r, x in zip(rows, root, strict=True) if x == c]
        want[min((r["doc_id"] is None, r["doc_id"] or 0) for r in own)] += 1
    got = STAGES["simhash_dedup"](spark, docs, folder)
    assert got.columns == docs.columns and not plain(got.collect()) - plain(rows)
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == want


def test_redaction_replaces_the_found_spans(spark, small):
    docs, folder = small
    spans = {}
    for r in pii.personal_data(docs).collect():
        spans[r["doc_id"]] = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
    want = Counter()
    for r in docs.collect():
        text, end, out = r["text"], 0, []
        for kind, a, b in spans[r["doc_id"]]:
            if a >= end:
                out += [text[end:a], f"[{kind.upper()}]"]
            end = max(end, b)
        new = text if not spans[r["doc_id"]] else "".join([*out, text[end:]])
        want[len(r), r["doc_id"], new, r["source"], None if new is None else len(new)] += 1
    got = STAGES["personal_data"](spark, docs, folder)
    assert got.columns == docs.columns
    assert Counter((len(r), r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in got.collect()) == want
    assert sum("[EMAIL]" in (k[2] or "") for k in want) >= 20


def test_mixing_repeats_whole_rows_near_the_targets(spark, small):
    docs, folder = small
    rows, got = docs.collect(), STAGES["mixing"](spark, docs, folder)
    assert got.columns == docs.columns
    have, taken = plain(rows), plain(got.collect())
    assert set(taken) <= set(have) and all(n <= 2 * have[r] for r, n in taken.items())
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    total, longest, words = Counter(), Counter(), Counter()
    for r in rows:
        total[r["source"]] += size(r)
        longest[r["source"]] = max(longest[r["source"]], size(r))
    for r, n in taken.items():
        words[r[3]] += n * size(r)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate([*sorted(s for s in total if s), None])}
    full = set()
    while True:
        rest = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        goal = {s: 2 * total[s] if s in full else rest * weight[s] / sum(w for t, w in weight.items() if t not in full) for s in total}
        over = {s for s in goal if s not in full and goal[s] > 2 * total[s]}
        if not over:
            break
        full |= over
    assert all(abs(words[s] - goal[s]) <= max(1, longest[s] / 2, 0.01 * goal[s]) for s in total)


def test_packing_holds_every_token_once(spark, small):
    from tokenizers import Tokenizer

    docs, folder = small
    tok = Tokenizer.from_file(vocabulary_paths()[0])
    want = Counter()
    for r in docs.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(min(first, len(ids)), len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = STAGES["packing"](spark, docs, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(places) <= 1.05 * -(-sum(k[3] * n for k, n in want.items()) // 1024) + 1


def test_stages_of_nothing(spark, small):
    docs, folder = small
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        n = stage(spark, blank, folder).count()
        assert n == (1 if name == "simhash_dedup" else docs.count()) or name == "mixing", name


def test_run_goes_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "personal_data", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == docs.count()
