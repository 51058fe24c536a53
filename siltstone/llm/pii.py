"""Personal data: candidate gradient boosting, with DataFrame functions only.

Base spans of the kinds email, ip, card and phone come from fixed patterns and checks and always stay. High-recall
generators propose further, overlapping spans (written-out addresses, phone numbers without a plus, cards with other
separators, IPv6 and bracketed IPv4). Each candidate gets format and context features; boosted trees, written as
nested conditions, score them; a threshold for each kind, calibrated on candidates kept aside, selects.

The trees are trained on the driver on candidates that are generated from templates, a fixed number of them
(TRAIN_CANDIDATES); no table is read for that. Everything on rows is one projection: no shuffle, no Python.

Positions are code points. A match's place is the sum of the pieces and matches before it; sums are taken in blocks, so
that texts with very many matches stay affordable.

Defined results: null and empty texts have no spans; repeated rows are answered row by row; null ids pass through; an
empty table gives an empty result; other columns are ignored, or kept as they are by redact_documents.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import pick, table

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns. Guards against a start inside a run that was tried already change no match and
#: keep long runs linear; possessive repeats give the same matches where nothing follows them.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text needs to have any match, cheaper than the pattern.
NEEDS = {"email": "@", "phone": "+"}
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?(?:\(at\)|\[at\])\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}+){1,6}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?:[0-9]{1,3}(?:\[\.\]|\(\.\)|\x20dot\x20)){3}[0-9]{1,3})(?![0-9A-Fa-f])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}+[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[\x20./-]{1,2}[0-9]{2,6}){1,4}(?![0-9])",
}
CUES = {
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell)[^\n]{0,12}$",
    "card": r"(?i)(?:card|visa|credit|amex|pay)[^\n]{0,12}$",
    "ip": r"(?i)(?:\bip|host|server|addr)[^\n]{0,12}$",
    "email": r"(?i)(?:mail|write to|reach|contact)[^\n]{0,12}$",
    "other": r"(?i)(?:order|invoice|\bid|ref|serial|isbn|version|page|date|total|price|year)[^\n]{0,12}$",
}
TLD = r"(?i)(?:\.|dot|\))\x20?(?:com|org|net|edu|gov|io|info|co|uk|de|fr|es|example)$"
CONTEXT = 24
TRAIN_CANDIDATES = 4000
TREES, DEPTH, RATE, PRECISION = 16, 3, 0.3, 0.97
BLOCK = 128


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find(text: Column, pattern: str) -> Column:
    """array<struct<start,end,s,before,after>> of all matches; start and end in code points."""
    kind = "array<struct<start:int,end:int,s:string,before:string,after:string>>"
    none = F.array().cast(kind)

    def placed(m: Column, p: Column) -> Column:
        # Struct i: match, the piece before it, the piece after it.
        z = F.arrays_zip(m.alias("m"), F.slice(p, 1, F.size(m)).alias("p"), F.slice(p, 2, F.size(m)).alias("n"))
        step = lambda x: F.length(x["m"]) + F.length(x["p"])

        def one(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["p"])
            end = start + F.length(x["m"])
            span = F.struct(
                start.alias("start"), end.alias("end"), x["m"].alias("s"), F.right(x["p"], F.lit(CONTEXT)).alias("before"), F.left(x["n"], F.lit(CONTEXT)).alias("after")
            )
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        def blocks(z: Column) -> Column:
            cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int")), lambda i: F.slice(z, i * BLOCK + 1, BLOCK))
            sums = F.aggregate(
                cut,
                F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                lambda acc, b: F.struct((acc["at"] + F.aggregate(b, F.lit(0), lambda a, x: a + step(x))).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                lambda acc: acc["out"],
            )
            return F.zip_with(cut, sums, lambda b, at: F.aggregate(b, F.struct(at.alias("at"), none.alias("out")), one, lambda acc: acc["out"]))

        return F.flatten(let(z, blocks))

    whole = F.lit(0)
    return let(
        F.regexp_extract_all(text, F.lit(pattern), whole),
        lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda p: placed(m, p))),
    )


def digits(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]", "")


def base_check(kind: str, s: Column) -> Column:
    n = F.length(digits(s))
    if kind == "ip":
        return s.rlike(IP_PARTS)
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", digits(s))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


SPAN = "array<struct<start:int,rank:int,end:int>>"


def base_spans(text: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    found = F.filter(find(text, BASE[kind]), lambda x: base_check(kind, x["s"]))
    spans = F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))
    if kind in NEEDS:
        spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(F.array().cast(SPAN))
    return spans


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def features(x: Column, kind: str) -> Column:
    """Numbers of a candidate; feature_values is the same for the driver."""
    s, d = x["s"], digits(x["s"])
    cue = lambda k: _flag(x["before"].rlike(CUES[k]))
    return F.array(
        F.lit(float(KINDS.index(kind))),
        F.length(d).cast("double"),
        F.length(s).cast("double"),
        F.length(F.regexp_replace(s, r"[^\x20()./_:-]", "")).cast("double"),
        F.length(F.regexp_replace(s, r"[^A-Za-z]", "")).cast("double"),
        _flag(F.length(d).between(12, 19) & F.call_function("luhn_check", F.when(F.length(d) > 0, d).otherwise("1"))),
        *[cue(k) for k in CUES],
        _flag(x["before"].rlike(r"[A-Za-z0-9]$")),
        _flag(x["after"].rlike(r"^[A-Za-z0-9]")),
        _flag(s.rlike(r"(?i)\(at\)|\[at\]|\[\.\]|\(\.\)")),
        _flag(s.rlike(TLD)),
        _flag(s.rlike(r"\(")),
        _flag(x["before"].rlike(r"\+$")),
    )


def _luhn(d: str) -> bool:
    t = [int(c) for c in reversed(d)]
    return bool(t) and (sum(t[::2]) + sum(sum(divmod(2 * c, 10)) for c in t[1::2])) % 10 == 0


def feature_values(kind: str, before: str, s: str, after: str) -> list[float]:
    d = re.sub(r"[^0-9]", "", s)
    before, after = before[-CONTEXT:], after[:CONTEXT]
    has = lambda p, v: float(bool(re.search(p, v)))
    return [
        float(KINDS.index(kind)),
        float(len(d)),
        float(len(s)),
        float(len(re.sub(r"[^\x20()./_:-]", "", s))),
        float(len(re.sub(r"[^A-Za-z]", "", s))),
        float(12 <= len(d) <= 19 and _luhn(d)),
        *[has(p, before) for p in CUES.values()],
        has(r"[A-Za-z0-9]\Z", before),
        has(r"^[A-Za-z0-9]", after),
        has(r"(?i)\(at\)|\[at\]|\[\.\]|\(\.\)", s),
        has(TLD, s),
        has(r"\(", s),
        has(r"\+\Z", before),
    ]


def training_candidates(n: int = TRAIN_CANDIDATES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of candidates from templates: personal data and look-alikes, with and without cues."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randint(2, 8)))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    cues = {"phone": ["call ", "phone: ", "tel. ", "fax "], "card": ["card ", "visa: ", "credit card no "], "ip": ["host ", "server at ", "ip "], "email": ["mail ", "contact: ", "write to "]}
    other = ["order ", "invoice ", "ref ", "page ", "version ", "serial ", "total "]

    def card() -> str:
        d = num(15)
        return next(d + c for c in "0123456789" if _luhn(d + c))

    def joined(d: str, sep: str, k: int) -> str:
        return sep.join(d[i : i + k] for i in range(0, len(d), k))

    rows, labels = [], []
    for _ in range(n):
        kind, good = rng.choice(KINDS), rng.random() < 0.5
        if kind == "email":
            at, dot = rng.choice([("(at)", "."), ("[at]", "[dot]"), (" at ", " dot "), (" (at) ", " (dot) "), ("@", ".")])
            s = f"{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}" if good else f"{word()} at {word()}.{word().title()}"
        elif kind == "phone":
            s = rng.choice([f"({num(3)}) {num(3)}-{num(4)}", joined(num(9), "-", 3), f"{num(3)}.{num(3)}.{num(4)}", f"0{num(2)} {num(7)[:3]} {num(4)}"])
            if not good:
                s = rng.choice([f"{num(2)}/{num(2)}/{num(4)}", f"{num(4)}-{num(4)}", f"{num(2)}.{num(2)}", f"{num(4)}-{num(2)}-{num(2)}", f"{num(3)} {num(2)}", joined(card(), " ", 4), ".".join(num(rng.randint(2, 3)) for _ in range(4)), s])
        elif kind == "card":
            s = joined(card(), rng.choice([".", "_", "  ", "/", "-", ""]), 4)
            if not good:
                s = joined(num(rng.randint(13, 19)), rng.choice([".", "", "-", " "]), 4)
        else:
            s = ":".join("%x" % rng.randrange(65536) for _ in range(8)) if rng.random() < 0.5 else "[.]".join(str(rng.randrange(256)) for _ in range(4))
            if not good:
                s = ":".join(num(2) for _ in range(rng.randint(4, 5)))
        cue = rng.random()
        plain = kind == "phone" and re.fullmatch(r"\(?[0-9]{3}[\x20).-]{1,2}[0-9]{3}[.\x20-][0-9]{3,4}", s)
        if good:
            before = word() + " " + (rng.choice(cues[kind]) if cue < 0.6 or kind == "phone" else "")
        elif plain:
            before = word() + " " + (rng.choice(other) if cue < 0.7 else "")
        else:
            before = word() + " " + (rng.choice(other) if cue < 0.5 else rng.choice(cues[kind]) if cue < 0.55 else "")
        if kind == "phone" and not good and cue > 0.9:
            before += "+1 "[: rng.randint(1, 3)]
        rows.append(feature_values(kind, before, s, rng.choice([" ", ". ", ", ", "\n"]) + word()))
        labels.append(float(good))
    return np.array(rows), np.array(labels)


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients: (feature, threshold, left, right) or a leaf's value."""
    value = float(g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 20:
        return value
    best, pick_ = 1e-6, None
    base = g.sum() ** 2 / (h.sum() + 1)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        cut = np.nonzero(v[1:] > v[:-1])[0]
        if len(cut):
            gain = cg[cut] ** 2 / (ch[cut] + 1) + (cg[-1] - cg[cut]) ** 2 / (ch[-1] - ch[cut] + 1) - base
            k = int(gain.argmax())
            if gain[k] > best:
                best, pick_ = float(gain[k]), (f, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if pick_ is None:
        return value
    left = x[:, pick_[0]] <= pick_[1]
    return (*pick_, grow(x[left], g[left], h[left], depth - 1), grow(x[~left], g[~left], h[~left], depth - 1))


def tree_value(tree, row) -> float:
    while not isinstance(tree, float):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@functools.lru_cache(maxsize=1)
def model() -> tuple[list, list[float]]:
    """Trees and, for each kind, the smallest score whose candidates are right with PRECISION on those kept aside."""
    x, y = training_candidates()
    fit = np.arange(len(x)) % 4 != 0
    raw, trees = np.zeros(len(x)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(x[fit], (y - p)[fit], (p * (1 - p))[fit], DEPTH)
        trees.append(tree)
        raw += RATE * np.array([tree_value(tree, r) for r in x])
    cuts = []
    for k in range(len(KINDS)):
        own = ~fit & (x[:, 0] == k)
        order = np.argsort(-raw[own], kind="stable")
        score, right = raw[own][order], np.cumsum(y[own][order])
        ok = np.nonzero((right / np.arange(1, len(score) + 1) >= PRECISION) & (score > 0))[0]
        cuts.append(float(score[ok[-1]]) if len(ok) else float("inf"))
    return trees, cuts


def tree_column(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(RATE * tree)
    return F.when(f[tree[0]] <= tree[1], tree_column(tree[2], f)).otherwise(tree_column(tree[3], f))


def added_spans(text: Column, kind: str) -> Column:
    """Candidates of a generator that the trees accept."""
    trees, cuts = model()
    rank = KINDS.index(kind)
    seen = F.transform(find(text, GENERATORS[kind]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), features(x, kind).alias("f")))
    score = lambda x: functools.reduce(lambda a, b: a + b, [tree_column(t, x["f"]) for t in trees])
    kept = F.filter(seen, lambda x: score(x) >= cuts[rank])
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))


def with_spans(df: DataFrame, text: Column) -> DataFrame:
    """df with _base (array by kind) and _spans (all, sorted): structs of start, rank (place in KINDS) and end."""
    whole = F.coalesce(text, F.lit(""))
    number = whole.rlike(r"[0-9]")
    none = F.array().cast(SPAN)
    base = [base_spans(whole, k) for k in KINDS]
    base = [b if k in NEEDS else F.when(number, b).otherwise(none) for k, b in zip(KINDS, base)]
    more = [F.when(number if k != "email" else whole.rlike(r"@|(?<=[\x20(\[])at(?=[\x20)\]])"), added_spans(whole, k)).otherwise(none) for k in KINDS]
    df = df.withColumn("_base", F.array(*base))
    found = F.array_distinct(F.concat(F.flatten("_base"), *more))
    return df.withColumn("_spans", F.array_sort(found))


def written(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """text with every run of overlapping spans replaced by the mark of its first span's kind."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    first = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["end"] + 1, s["start"] - acc["end"])
        return F.when(
            s["start"] >= acc["end"],
            F.struct(s["end"].alias("end"), F.concat(acc["out"], F.array(gap, F.element_at(marks, s["rank"] + 1))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["end"], s["end"]).alias("end"), acc["out"].alias("out")))

    def close(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["end"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, first, step, close))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text, base spans by kind and all spans."""
    rows = pick(docs, {"doc_id": "long", "text": "string"})
    return with_spans(rows, F.col("text"))


def redact_documents(docs: DataFrame) -> DataFrame:
    """docs with personal data in text replaced by marks; columns and their names stay."""
    names = docs.columns
    lower = [n.lower() for n in names]
    at = names.index("text") if "text" in names else lower.index("text")
    flat = with_spans(docs.toDF(*[f"_c{i}" for i in range(len(names))]), F.col(f"_c{at}"))
    text = redacted(F.col(f"_c{at}"), F.col("_spans"))
    return flat.select(*[(text if i == at else F.col(f"_c{i}")).alias(f"_c{i}") for i in range(len(names))]).toDF(*names)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.element_at("_base", i + 1)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    base = written(F.array_sort(F.flatten("_base")))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_documents(docs)


#: The contract's patterns, for the plain version that tests compare with.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rank, end) of base spans, sorted; one match after another."""
    out = []
    for rank, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


QUERIES = {"op1_pii": op1_pii}
ORACLES: dict[str, str] = {}
