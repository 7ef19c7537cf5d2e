"""Personal data by weak supervision, in DataFrame functions only.

Regex, gazetteer and context labelers vote on candidate spans; expectation-maximisation over the
vote histogram estimates how reliable each is; a naive-Bayes span classifier is trained on the
posteriors. Spans of the base rules always stay, the classifier adds others.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
# Each pattern finds what its plain form finds; possessive loops and left guards keep it linear on long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": (0, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (1, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (2, r"[0-9]++(?:[\x20-][0-9]++)*+"),
    "phone": (3, r"\+[0-9][\x20().0-9-]+[0-9]"),
    # looser shapes, never base spans
    "email_said": (0, rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:[(\[]at[)\]]| at ) ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]| dot |\.) ?[A-Za-z0-9-]++)++"),
    "ip_six": (1, r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "phone_local": (3, r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}
#: Only texts with one of these can match.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": "[0-9][0-9 -]{10,}[0-9]",
    "phone": r"\+[0-9]",
    "email_said": r"[(\[]at[)\]]| dot ",
    "ip_six": ":[0-9A-Fa-f]{1,4}:",
    "phone_local": r"[0-9]{3}[ .)-].?[0-9]{3}",
}
# Word lists of the gazetteer and context labelers.
ENDINGS = "com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|ca|au|ch|at|it|nl"
CUES = {0: "e-?mail|contact|write|reply", 1: r"\bip\b|server|host|address|login", 2: "card|visa|credit|account|payment", 3: "call|phone|tel|mobile|fax|whatsapp"}
AGAINST = r"(?i)(?:version|order|isbn|invoice|token|sha|uuid|serial)\W{0,4}$|[=#\"'/]$"
VOTES = 6
BLOCK = 256


def _prefix_sums(d: Column) -> Column:
    """Sums of all earlier entries, by blocks so that long arrays stay cheap."""
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = F.sequence(F.lit(0), F.floor((F.size(d) - 1) / BLOCK).cast("int"))

    def block(b: Column) -> Column:
        own = F.slice(d, b * BLOCK + 1, F.lit(BLOCK))
        base = add(F.slice(d, F.lit(1), b * BLOCK))
        return F.transform(F.sequence(F.lit(0), F.size(own) - 1), lambda j: base + add(F.slice(own, F.lit(1), j)))

    return F.flatten(F.transform(blocks, block))


def _valid(kind: int, said: Column) -> Column:
    digits = F.regexp_replace(said, "[^0-9]", "")
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return {
        0: F.lit(True),
        1: said.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        2: F.length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        3: F.length(digits).between(9, 15),
    }[kind]


def _found(df: DataFrame, name: str) -> DataFrame:
    """Adds ``_c_<name>``: the pattern's matches as (start, kind, end, strict, tags)."""
    kind, pattern = PATTERNS[name]
    text, some = F.col("_text"), F.col("_text").rlike(NEEDS[name])
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    m, g = F.col("_m"), F.col("_g")
    df = df.withColumn("_d", F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda a, b: (F.length(a) + F.length(b)).cast("long")))
    df = df.withColumn("_s", F.when(F.size(m) > 0, _prefix_sums(F.col("_d"))).otherwise(F.array().cast("array<bigint>")))

    def span(before: Column, i: Column) -> Column:
        said, left, right = F.get(m, i), F.right(F.get(g, i), F.lit(24)), F.left(F.get(g, i + 1), F.lit(2))
        start = before + F.length(F.get(g, i))
        strict = _valid(kind, said) if name in KINDS else F.lit(False)
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(said)).alias("end"), strict.alias("strict"), _tags(kind, name, said, left, right, strict).alias("tags"))

    spans = F.transform("_s", span)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,strict:boolean,tags:array<string>>>")
    least = {"card": 12}.get(name, 1)
    kept = F.filter(F.coalesce(spans, empty), lambda s: s["end"] - s["start"] >= least)
    return df.withColumn(f"_c_{name}", kept).drop("_m", "_g", "_d", "_s")


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, 0, or - where the labeler abstains; without ``no`` it votes 0 instead of abstaining."""
    return F.when(yes, "1").when(~yes if no is None else no, "0").otherwise("-")


def _tags(kind: int, name: str, said: Column, left: Column, right: Column, strict: Column) -> Column:
    """Votes of the six labelers, then other features of the span, as ``place=value``."""
    digits = F.length(F.regexp_replace(said, "[^0-9]", ""))
    canonical = {
        0: said.rlike(r"^[A-Za-z][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+$"),
        1: said.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | said.contains(":"),
        2: said.rlike(r"^(?:[0-9]{13,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$"),
        3: said.rlike(r"^\+?[0-9]{0,3} ?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}$"),
    }[kind]
    listed = {
        0: said.rlike(rf"(?i)(?:\.|dot ?[)\]]? ?)(?:{ENDINGS})$"),
        1: ~said.rlike(r"^(?:0+|255)\."),
        2: said.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"),
        3: said.rlike(r"^\+[1-9]|^\(?[2-9][0-9]{2}"),
    }[kind]
    clear = (F.length(left) == 0) | left.rlike(r"[\s(\[:,;]$")
    after = (F.length(right) == 0) | right.rlike(r"^[\s)\],;:.!?]")
    against = left.rlike(AGAINST)
    loose = F.lit(name not in KINDS)  # the strict rule and the usual form say nothing of looser shapes
    votes = [_vote(strict & ~loose, ~strict & ~loose), _vote(canonical & ~loose, ~canonical & ~loose), _vote(listed), _vote(left.rlike(f"(?i){CUES[kind]}"), F.lit(False)), _vote(~against & F.lit(False), against), _vote(clear & after)]
    more = [
        F.concat(F.lit("digits="), F.when(digits == 0, "0").when(digits < 9, "few").when(digits < 12, "phone").when(digits < 16, "long").when(digits == 16, "16").otherwise("more")),
        F.concat(F.lit("left="), F.when(F.length(left) == 0, "none").when(left.rlike(r"\s$"), "space").when(left.rlike(r"[A-Za-z]$"), "letter").when(left.rlike("[0-9]$"), "digit").otherwise("sign")),
        F.concat(F.lit("right="), F.when(F.length(right) == 0, "none").when(right.rlike(r"^\s"), "space").when(right.rlike("^[A-Za-z]"), "letter").when(right.rlike("^[0-9]"), "digit").otherwise("sign")),
    ]
    return F.array(*[F.concat(F.lit(f"{i}="), v) for i, v in enumerate(votes)], *more)


def candidates(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_cands``: every candidate span of the whole text (null: empty)."""
    df = docs.withColumn("_text", F.coalesce(text.cast("string"), F.lit("")))
    for name in PATTERNS:
        df = _found(df, name)
    names = [f"_c_{n}" for n in PATTERNS]
    return df.withColumn("_cands", F.concat(*names)).drop(*names)


def fit(cands: DataFrame, rounds: int = 8) -> dict[tuple[int, str], float]:
    """Weights of the span classifier by (kind, feature); ``prior`` is the constant.

    An abstaining labeler is no feature. The histogram of (kind, features) has a bounded number of rows whatever the corpus; each
    round of expectation-maximisation is one aggregation over it.
    """
    one = cands.select(F.explode("_cands").alias("c")).select("c.kind", "c.tags")
    cells = materialize(one.groupBy("kind", "tags").agg(F.count("*").alias("n")))
    first = F.element_at("tags", 1)
    shape = 0.2 + F.when(F.element_at("tags", 3) == "2=1", 0.2).otherwise(0.0) + F.when(F.element_at("tags", 4) == "3=1", 0.4).otherwise(0.0)
    post = F.when(first == "0=1", 0.95).when(first == "0=0", 0.15).otherwise(shape)
    for _ in range(rounds):
        sums = []
        for i in range(VOTES):
            v = F.element_at("tags", i + 1)
            for y, w in (("y", F.col("p")), ("n", 1 - F.col("p"))):
                sums += [F.sum(F.when(v == f"{i}=1", F.col("n") * w).otherwise(0.0)).alias(f"{y}1{i}"), F.sum(F.when(v == f"{i}=0", F.col("n") * w).otherwise(0.0)).alias(f"{y}0{i}")]
        rows = cells.withColumn("p", post).groupBy("kind").agg(F.sum(F.col("n") * F.col("p")).alias("y"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"), *sums).collect()
        logit = F.lit(0.0)
        for r in rows:  # one row per kind
            score = F.lit(math.log((r["y"] + 1) / (r["no"] + 1)))
            for i in range(VOTES):
                a, b = (r[f"y1{i}"] + 1) / (r[f"y1{i}"] + r[f"y0{i}"] + 2), (r[f"n1{i}"] + 1) / (r[f"n1{i}"] + r[f"n0{i}"] + 2)
                v = F.element_at("tags", i + 1)
                score = score + F.when(v == f"{i}=1", math.log(a / b)).when(v == f"{i}=0", math.log((1 - a) / (1 - b))).otherwise(0.0)
            logit = F.when(F.col("kind") == r["kind"], score).otherwise(logit)
        post = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))
    soft = cells.withColumn("p", post).select("kind", (F.col("n") * F.col("p")).alias("y"), (F.col("n") * (1 - F.col("p"))).alias("no"), F.explode(F.concat(F.array(F.lit("prior")), F.filter("tags", lambda t: ~t.endswith("=-")))).alias("tag"))
    rows = soft.groupBy("kind", "tag").agg(F.sum("y").alias("y"), F.sum("no").alias("no")).collect()  # a few dozen features
    prior = {r["kind"]: (r["y"], r["no"]) for r in rows if r["tag"] == "prior"}
    out = {}
    for r in rows:
        y, no = prior[r["kind"]]
        part = y / (y + no)  # a feature seen once or twice says what the kind says
        both = math.log((r["y"] + part + 1e-3) / (r["no"] + 1 - part + 1e-3))
        # candidates of the base rules are mostly good; that alone must not carry a looser one
        out[r["kind"], r["tag"]] = min(both, 1.0) if r["tag"] == "prior" else both - math.log((y + 1e-3) / (no + 1e-3))
    return out


def decide(cands: DataFrame, model: dict[tuple[int, str], float]) -> DataFrame:
    """Adds ``_base`` and ``_spans`` (base spans and the accepted others), each sorted (start, kind, end)."""
    slim = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    df = cands.withColumn("_base", F.array_sort(F.transform(F.filter("_cands", lambda s: s["strict"]), slim)))
    if not model:
        return df.withColumn("_spans", F.col("_base"))
    weights = F.create_map(*[F.lit(x) for (k, t), w in sorted(model.items()) for x in (f"{k}:{t}", w)])

    def accepted(s: Column) -> Column:
        start = F.coalesce(F.element_at(weights, F.concat(s["kind"].cast("string"), F.lit(":prior"))), F.lit(0.0))
        score = F.aggregate(s["tags"], start, lambda a, t: a + F.coalesce(F.element_at(weights, F.concat(s["kind"].cast("string"), F.lit(":"), t)), F.lit(0.0)))
        return ~s["strict"] & (score > 0)

    more = F.transform(F.filter("_cands", accepted), slim)
    df = df.withColumn("_more", more)
    clear = F.when(F.size("_more") == 0, F.col("_more")).otherwise(F.filter("_more", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    return df.withColumn("_spans", F.array_sort(F.concat("_base", clear))).drop("_more")


def said(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: ``doc_id``, counts and digest of the base spans, and all spans.

    Null and empty texts have none. Every row, repeated or with a null id, has its own result row;
    other columns are ignored; an empty table gives no rows.
    """
    cands = materialize(candidates(docs.select("doc_id", "text"), F.col("text")).select("doc_id", "_cands"))
    df = decide(cands, fit(cands))
    of = F.transform("_base", lambda s: s["kind"])
    counts = [(F.size(of) - F.size(F.array_remove(of, k))).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return df.select("doc_id", *counts, F.sha2(said(F.col("_base")), 256).alias("base_sha256"), said(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The same rows with every found span replaced by its kind in brackets; ``n_chars`` follows the text.

    Overlapping spans are covered by the first one's mark. Null and empty texts, null ids, repeated rows
    and other columns, whatever their names, stay as they are; an empty table gives no rows.
    """
    packed = docs.select(F.struct("*").alias("_row"))
    some = F.coalesce(reduce(Column.__or__, [F.col("_row.text").cast("string").rlike(p) for p in NEEDS.values()]), F.lit(False))
    # only rows that can hold a span are written, once: the fit reads the candidates alone, and each half stays small enough to compile well
    found = materialize(candidates(packed.filter(some), F.col("_row.text")).select("_row", "_cands"))
    df = decide(found, fit(found)).withColumn("_text", F.coalesce(F.col("_row.text").cast("string"), F.lit("")))
    df = df.withColumn("_ends", F.transform("_spans", lambda s: s["end"]))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    before = lambda i: F.coalesce(F.array_max(F.slice("_ends", F.lit(1), i)), F.lit(0))

    def piece(i: Column) -> Column:
        s = F.get(F.col("_spans"), i)
        gap = F.substring(F.col("_text"), (before(i) + 1).cast("int"), F.greatest(s["start"] - before(i), F.lit(0)).cast("int"))
        return F.when(s["start"] >= before(i), F.concat(gap, F.get(marks, s["kind"]))).otherwise("")

    n = F.size("_spans")
    body = F.concat(F.array_join(F.transform(F.sequence(F.lit(0), n - 1), piece), ""), F.substring(F.col("_text"), (before(n) + 1).cast("int"), F.lit(2147483647)))
    text = F.when((n > 0) & F.col("_row.text").isNotNull(), body).otherwise(F.col("_row.text"))
    df = df.withColumn("_new", text)
    names = {"text": F.col("_new"), "n_chars": F.when(n > 0, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("_new")}
    return packed.filter(~some).select("_row.*").union(df.select(*[names.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]))
