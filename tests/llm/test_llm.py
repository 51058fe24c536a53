"""Operators for training data against plain versions, with nulls, empty and long texts, repeats and clashing columns."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import chat, decontaminate, graph, jaccard, lm_scoring, nearest, packing, pii, quality, sharding, warc
from siltstone.llm._common import pick, shared_dir

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (5, "The quick brown fox jumps over the lazy dog and runs far away today."),
    (6, "one two"),
    (7, "one two"),
    (8, LONG),
    (9, LONG + " tail"),
    (None, "a row without an id says a.b@c.example.com here"),
    (10, "日本語 ünïcödé 𝒳 +1 (212) 555-0100 and 4111 1111 1111 1111, 10.0.0.1!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns that clash with inner and result names, some by case only."""
    kind = "score double, doc_id long, text string, lang string, source string, n_chars long, Text string, sid long, comp long, token long, part int, _c0 string"
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        rows = [(0.5, i, t, "en", "s", len(t or ""), "other", 1, 2, 3, 4, "x") for i, t in TEXTS]
        df = spark.createDataFrame(rows, kind)
        path = shared_dir(spark)
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def key(i):
    return -1 if i is None else i


# -- personal data ---------------------------------------------------------------------------------------------------
PII_TEXTS = [
    "a@b.c_d@e.f x@y", "a.b+c@d-e.f.g, a@b@c.de", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255", "4111 1111 1111 1111 4111-1111-1111-1112 12",
    "+1 (212) 555-0100 +12 +123456789012345678 +1 2.3.4.5.6.7.8.9.0 ", "+1+1 555 555 0100", "é😀 a@b.co 10.0.0.1", "a" * 50_000, "1 " * 20_000 + "x", "+1 " + "." * 50_000,
    "x@y.z " * 1500, "@@@ ...", "4111111111111111@a.b.c", "0000 0000 0000 00",
]


def test_pii_matches_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    found = pii.find_personal_data(df).select("doc_id", pii.F.array_sort(pii.F.flatten("_base")).alias("b"), pii.F.col("_spans").alias("s"))
    for r in found.collect():
        assert [tuple(x) for x in r.b] == pii.plain_base(PII_TEXTS[r.doc_id]), PII_TEXTS[r.doc_id][:60]
        assert {tuple(x) for x in r.b} <= {tuple(x) for x in r.s}


def test_pii_random_texts(spark):
    import random

    rng = random.Random(1)
    bits = ["a", "Z", "@", ".", "-", "+", " ", "1", "22", "255", "256", "(", ")", "_", "%", "é", "1.1.1.1", "+1 212 555 0100", "4111111111111111", "b@c.de"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_personal_data(df).select("doc_id", pii.F.array_sort(pii.F.flatten("_base")).alias("b")).collect():
        assert [tuple(x) for x in r.b] == pii.plain_base(texts[r.doc_id]), texts[r.doc_id]


def test_pii_added_spans_and_redaction(spark):
    rows = [(1, "write to bob (at) mail (dot) com or call (212) 555-0100 now"), (2, "see page 12.50 at noon. The end"), (3, "a@b.co and 10.0.0.1"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = {r.doc_id: r.text for r in pii.redact_documents(df).collect()}
    assert text[1] == "write to [EMAIL] or call [PHONE] now"
    assert text[2] == rows[1][1] and text[3] == "[EMAIL] and [IP]" and text[4] is None


def test_pii_features_agree(spark):
    F = pii.F
    rows = [("phone", "call ", "(212) 555-0100", " now"), ("card", "visa: ", "4111.1111.1111.1111", ","), ("email", "mail ", "a(at)b.com", "x"), ("ip", "+", "1[.]2[.]3[.]4", "")]
    df = spark.createDataFrame(rows, "kind string, before string, s string, after string")
    x = F.struct("before", "s", "after")
    for k, b, s, a in rows:
        got = df.where(F.col("kind") == k).select(pii.features(x, k).alias("f")).first().f
        assert got == pii.feature_values(k, b, s, a)


def test_pii_edges(docs, none, spark):
    out = pii.redact_documents(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    assert pii.find_personal_data(none).count() == 0
    plan = pii.find_personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


# -- WARC ------------------------------------------------------------------------------------------------------------
def test_warc_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", "", None, "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\nWARC/1.1\r\n", "x\r\n\r\ny", "<p>a</p>", "é" * 1000]
    rows = [(i, f"http://h/{i} \r\n", h) for i, h in enumerate(html)] + [(0, "again", "<p>a</p>"), (None, None, "solo"), (0, "again", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = shared_dir(spark)
    warc.write_archive(pages, path)
    records = warc.read_archive(spark, path)
    assert Counter(r.type for r in records.select("type").collect()) == {"request": 11, "metadata": 11, "response": 6, "revisit": 5}
    got = warc.assemble(records).collect()
    assert len(got) == 11 and all(r.request is not None and len(r.metadata) == 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.response.record_id.split(":")[2], []).append(r.response)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    for i, h in enumerate(html):
        assert all((x.payload_digest, x.payload_bytes) == (digest(h), len((h or "").encode())) for x in by[str(i)])
    assert by["6"][0].type == "response" and by["6"][0].payload == b"<p>a</p>"
    assert all(x.type == "revisit" and x.refers_to == by["6"][0].record_id for k in ("0", "1") for x in by[k])
    assert by["3"][0].type == "response" and by["2"][0].type == "revisit"
    assert by["4"][0].payload == html[4].encode() and by[""][0].type == "response"


def test_warc_thresholds_and_empty(spark):
    rows = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    path = shared_dir(spark)
    warc.write_archive(rows, path, min_revisit_bytes=3)
    kinds = {r.record_id.split(":")[2]: r.type for r in warc.read_archive(spark, path).where("type in ('response', 'revisit')").collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
    path = shared_dir(spark)
    warc.write_archive(rows.limit(0), path)
    assert warc.assemble(warc.read_archive(spark, path)).count() == 0


# -- packing ---------------------------------------------------------------------------------------------------------
def test_packing(docs, none, spark):
    rows = packing.pack_documents(docs, keep_ids=True).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, t in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            own = ids[a : a + 4096]
            want[(key(i), k, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((key(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
    assert len(seqs) == -(-sum(r.length for r in rows) // 4096)
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_packing_plans_are_exact_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    size = rng.choice([rng.integers(1, 4097, 3000), np.minimum(4096, rng.lognormal(6, 1.3, 3000).astype(int) + 1)])
    hist = dict(zip(*(x.tolist() for x in np.unique(size, return_counts=True))))
    plan = packing.plan_sequences(hist, rounds=6)
    back = Counter()
    for config, times in plan:
        assert sum(n * k for n, k in config) <= 4096
        for n, k in config:
            back[n] += k * times
    assert back == hist
    bound = -(-int(size.sum()) // 4096)
    used = sum(t for _, t in plan)
    assert used <= max(bound * 1.06 + 2, sum(size > 2048) + bound * 0.1)
    look = packing.Lookup(plan)
    for n in list(hist)[:50]:
        seq, off = look.place(np.full(hist[n], n), np.arange(hist[n]))
        assert len(set(zip(seq.tolist(), off.tolist()))) == hist[n]
    assert look.sequences == used


def test_packing_exact_fit_needs_the_program():
    # First fit decreasing wastes here: pairs of 2600 + 1496 and triples of 1366, 1365, 1365.
    hist = {2600: 300, 1496: 300, 1366: 100, 1365: 200}
    assert sum(t for _, t in packing.plan_sequences(hist)) == 400


def test_packing_uses_part_filled_configurations():
    # No combination of these lengths is 4096: 600 of 2057 + 1034 + 1004 and 300 of 1043 + 1043 + 1004 + 1004 are best.
    hist = {2057: 600, 1043: 600, 1034: 600, 1004: 1200}
    plan = packing.plan_sequences(hist)
    assert sum(t for _, t in plan) == 900
    back = Counter()
    for config, times in plan:
        back.update({n: k * times for n, k in config})
    assert back == hist


def test_word_ids_are_the_tokenizers(spark):
    own = packing.WordIds(packing.default_tokenizer())
    for t in ["It's İstanbul ΣΑΣ <|endoftext|> x", "a\x1cb c\x85d\xa0e ½ x² 'safe don't'S", "日本語 é é ﬁ", "", " ", "naïve_co-op 12a3…", "\x00a\x7f b\xad"]:
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids


# -- sharding ------------------------------------------------------------------------------------------------------------
def test_sharding(docs, none):
    out = sharding.hypergeometric_shards(pick(docs, {"doc_id": "long", "text": "string"}), 5)
    rows = out.collect()
    assert Counter((key(r.doc_id), r.text) for r in rows) == Counter((key(i), t) for i, t in TEXTS)
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 5
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert sharding.hypergeometric_shards(none, 4).count() == 0


def test_communication_matrix():
    counts, capacity = [10, 0, 7, 23], [14, 13, 13]
    total = np.zeros((4, 3))
    for seed in range(300):
        m = sharding.communication_matrix(counts, capacity, seed)
        assert m.sum(1).tolist() == counts and m.sum(0).tolist() == capacity
        total += m
    want = np.outer(counts, capacity) / 40
    assert np.abs(total / 300 - want).max() < 0.4


def test_large_populations():
    rng = np.random.default_rng(0)
    x = [sharding.hypergeometric(rng, 3 * 10**9, 7 * 10**9, 10**6) for _ in range(300)]
    assert abs(np.mean(x) - 300_000) < 150 and 300 < np.std(x) < 620


# -- near duplicates -----------------------------------------------------------------------------------------------------
def plain_components(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key(d), len(sets[i]), key(min(ids)) if sets[i] and ids else key(d)))
    return Counter(out)


def test_near_duplicates_edges(docs, none):
    got = Counter((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in jaccard.near_duplicates(docs).collect())
    assert got == plain_components(TEXTS)
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(key(r.doc_id) for r in kept.select("doc_id").collect())
    assert ids[1] == 1 and 5 not in ids and 7 not in ids and 9 not in ids and ids[6] == 1 and ids[2] == ids[3] == ids[4] == 1


def test_near_duplicates_against_brute_force(spark):
    import random

    rng = random.Random(2)
    words = [f"v{i}" for i in range(400)]
    rows, line = [], " ".join(rng.choice(words) for _ in range(12))
    for b in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 9, 20, 60, 150]))]
        for _ in range(rng.choice([1, 2, 30])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 22))):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.5:
                own = own[: rng.randint(max(1, int(len(own) * 0.8)), len(own))]
            rows.append((len(rows), " ".join(own) + (" " + line if rng.random() < 0.3 else "")))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect())
    assert got == plain_components(rows)


def test_keep_one_tells_rows_apart(spark):
    rows = [(None, "a row without an id"), (None, "another row without one"), (None, "a row without an id"), (1, "one text of id one"), (1, "quite a different text of it"), (2, "one text of id one"), (None, None), (None, "")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, kept.collect())) == Counter([*rows[:2], *rows[3:5], *rows[6:]])


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7), (200, 150)]
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 150: 150, 200: 150}


def test_components_that_do_not_settle_are_refused(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        graph.components(chain, most=1)


# -- language model ------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("head", [500_000, 3])
def test_lm_scores(docs, spark, head, monkeypatch):
    monkeypatch.setattr(lm_scoring.train, "__defaults__", (lm_scoring.ORDER, 1 << 22, head))
    rows = lm_scoring.lm_scores(docs).collect()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [None] for _, t in TEXTS]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in TEXTS]
    count = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    want = Counter()
    for (i, _), ws, h in zip(TEXTS, words, held):
        want[(key(i), h, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 5))] += 1
    assert Counter((key(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    assert all(r.score < 0 for r in rows)


def test_lm_empty(none):
    assert lm_scoring.lm_scores(none).count() == 0


def test_log_frequency_filter():
    f = lm_scoring.LogFrequencyFilter(1 << 20, 16)
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 4000, dtype=np.int64).astype(np.uint64)
    counts = rng.integers(1, 3000, 4000)
    f.add(keys, counts)
    level = np.floor(np.log2(counts)).astype(int) + 1
    assert (f.levels(keys) >= level).all() and (f.levels(keys) == level).mean() > 0.97
    assert (f.levels(rng.integers(0, 2**63, 4000, dtype=np.int64).astype(np.uint64)) == 0).mean() > 0.97


@pytest.mark.parametrize("members", [3_000, 300_000])
def test_filter_grows_with_its_members(members):
    # Counts of a block that is 100 times as large are read back as well.
    keys = np.random.default_rng(2).integers(0, 2**63, 2 * members, dtype=np.int64).astype(np.uint64)
    counts = np.random.default_rng(3).integers(1, 9, members)
    f = lm_scoring.block_filter([(keys[:members], counts)])
    level = np.floor(np.log2(counts)).astype(int) + 1
    assert (f.levels(keys[:members]) >= level).all() and (f.levels(keys[:members]) == level).mean() > 0.98
    assert (f.levels(keys[members:]) == 0).mean() > 0.98


@pytest.mark.parametrize("chunk", [3, 6_000_000])
def test_lm_counts_of_a_large_corpus(spark, monkeypatch, chunk):
    # A filter of a fixed size, as small as LEAST_BITS is here, would take every bigram for a frequent one.
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 2000, 1500)) for _ in range(40)]
    monkeypatch.setattr(lm_scoring.train, "__defaults__", (2, 1 << 10, chunk))
    rows = lm_scoring.lm_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    words = [[*t.split(), None] for t in texts]
    one, two = Counter(), Counter()
    for r, ws in zip(sorted(rows), words):
        if not r.held_out:
            one.update(ws)
            two.update(zip([None, *ws], ws))
    rough = lambda c: lm_scoring.middle(np.array([c.bit_length()]))[0]
    total = sum(one.values()) + len(one) + 1
    assert len(rows) == 40 and {r.held_out for r in rows} == {False, True}
    for r, ws in zip(sorted(rows), words):
        want = 0.0
        for a, b in zip([None, *ws], ws):
            c = max(rough(one[a]), 1)
            want += math.log10((min(rough(two[a, b]), c) + 20 * (rough(one[b]) + 1) / total) / (c + 20))
        assert abs(r.score - want) < 0.01 * abs(want)


# -- decontamination -------------------------------------------------------------------------------------------------------
ITEMS = [
    (11, "The quick brown fox jumps over the lazy dog and runs far away today yes indeed"), (12, "one"), (13, None), (14, "..."), (2, "lazy dog"),
    (15, " ".join(f"w{i % 977}x{i % 13}" for i in range(100, 140))), (None, "quick brown"), (2, "lazy dog"),
]


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_decontamination(docs, spark, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate.decontamination_report(docs, items, block_words).collect()
    want = Counter()
    for i, t in TEXTS:
        want[(key(i), *decontaminate.brute_force([(i, t)], ITEMS)[i])] += 1
    assert Counter((key(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == want
    kept = decontaminate.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert Counter(key(r.doc_id) for r in kept.select("doc_id").collect()) == Counter(k[0] for k in want.elements() if not k[-1])


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_decontamination_removes_rows(spark, block_words):
    bad = "The quick brown fox jumps over the lazy dog and runs far away today"
    rows = [(None, bad), (None, "clean text without an id"), (1, bad), (1, "clean text of a repeated id"), (2, None), (3, "one")]
    kept = decontaminate.remove_contaminated(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), spark.createDataFrame(ITEMS, "item_id long, text string"), block_words)
    assert Counter(map(tuple, kept.collect())) == Counter([rows[1], rows[3], rows[4]])


def test_decontamination_empty(docs, none, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontamination_report(none, items).count() == 0
    assert decontaminate.decontamination_report(docs, items.limit(0)).where("contaminated").count() == 0


def test_suffix_search_random():
    rng = np.random.default_rng(3)
    for vocab in (2, 3, 9):
        docs = [[b"%d" % x for x in rng.integers(0, vocab, rng.integers(0, 60))] for _ in range(12)]
        items = [(k, [b"%d" % x for x in rng.integers(0, vocab - (vocab > 2), rng.integers(0, 25))]) for k in range(5)]
        tests = decontaminate.Tests(items, 4)
        for ws, (runs, found, (size, at, item)) in zip(docs, decontaminate.shard_hits(tests, docs)):
            text, low = " ".join(x.decode() for x in ws), [(n, " ".join(x.decode() for x in w)) for n, w in items]
            want = decontaminate.brute_force([(0, text)], low, 4)[0]
            names = sorted({tests.names[i] for i in found})
            assert (sum(e - s for s, e in runs), len(names)) == want[1:3]
            if size:
                iw = tests.stream[[s for s in range(len(tests.stream))]]
                assert any(ws[at : at + size] == w[k : k + size] for _, w in items for k in range(len(w)))


# -- nearest neighbours ----------------------------------------------------------------------------------------------------
def test_nearest_exact_on_small_tables(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rows[50][1], 1) for i in range(30)]  # copies of a query
    rows += [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] + [1.0] * 7, 1), (2003, [None] + [1.0] * 7, 1), (2004, [1.0], 1), (None, [1.0] * 8, 1), (2005, [1e300] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {}
    for r in nearest.nearest(df).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ok = [(i, np.array(v)) for i, v, _ in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    assert sorted(got) == sorted(i for i, _ in ok if i % 50 == 0)
    unit = lambda v: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())
    hits = 0
    for q in got:
        u = unit(dict(ok)[q])
        want = sorted((-round(float(unit(v) @ u), 12), i) for i, v in ok if i != q)[:5]
        hits += sum(got[q][k + 1][0] == i for k, (_, i) in enumerate(want))
        assert [got[q][k][1] for k in range(1, 6)] == sorted((got[q][k][1] for k in range(1, 6)), reverse=True)
    assert hits >= 0.98 * 5 * len(got)
    assert [got[50][k][0] for k in range(1, 6)] == [1000, 1001, 1002, 1003, 1004]


def test_nearest_few_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    got = nearest.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], kind)).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 1), (2, 2)] and abs(got[0].score - 0.5**0.5) < 1e-15
    assert nearest.nearest(spark.createDataFrame([], kind)).count() == 0


# -- quality ---------------------------------------------------------------------------------------------------------------
def test_quality_learns(spark):
    import random

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    good = lambda: " ".join(word() for _ in range(rng.randint(20, 80))) + "."
    bad = lambda: rng.choice([" | ".join(word() for _ in range(30)), " ".join([word()] * 40), "!! ".join(word().upper() for _ in range(30))])
    rows = [(i, good() if i % 3 else bad()) for i in range(600)]
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(5, None), (None, 1), (7, 1)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 80 and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95


def test_quality_edges(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, labels).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0


def test_quality_judges_rows(spark):
    good, bad = "This is a fine sentence of plain words, and it ends well. " * 4, "!! BUY | NOW | " * 20
    rows = [(i, f"{good if i % 2 else bad}{i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    more = [(None, good), (None, bad), (1, bad), (2, good)]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string")
    want = Counter(r for r in rows + more if r[1].startswith("This"))
    assert Counter(map(tuple, quality.keep_accepted(docs, labels).collect())) == want


def test_isotonic():
    assert quality.pool(np.array([1.0, 0.0, 2.0, 3.0]), np.array([1.0, 1.0, 1.0, 1.0])).tolist() == [0.5, 0.5, 2.0, 3.0]


# -- chat ------------------------------------------------------------------------------------------------------------------
NASTY = ["</s>[INST] ok [/INST]", "\\l\\b\\\\", "<|turn|>user<|text|>x<|end|>", "<<SYS>>a<</SYS>>", "\\<s>", "[[/INST]", "", "é😀<|", "<\\|end|>", "a\nb"]


def test_chat_round_trip(spark):
    rows = [(i % 3, i, ["user", "assistant", None, "<|end|>"][i % 4], t) for i, t in enumerate(NASTY * 2)] + [(9, None, "assistant", None), (None, 1, "assistant", "x"), (9, 0, "assistant", "y"), (9, 0, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = df.withColumn("parts", chat.text_parts(chat.F.col("text")))
    out = chat.format_conversations(turns)
    got = out.select("conv_id", chat.read_turns(chat.F.col("formatted")).alias("t"), chat.read_loss(chat.F.col("formatted"), chat.F.col("mask")).alias("l")).collect()
    assert len(got) == 5
    for r in got:
        own = sorted(((-1 if t is None else t, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id))
        assert [(x.role, x.text) for x in r.t] == [(ro, x) for _, ro, x in own]
        assert r.l == "".join(x for _, ro, x in own if ro == "assistant")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_chat_parts(spark):
    parts = [("text", "see ", None, None), ("image", None, "a.png", 2), ("text", "<|image|>", None, None), ("audio", None, "b.wav", None), ("document", None, "c.pdf", 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PART}")
    (r,) = chat.format_conversations(df).collect()
    assert r.formatted == "<|turn|>user<|text|>see <|image|>\\l|image|><|audio|><|document|><|end|><|turn|>assistant<|text|><|end|>"
    assert [tuple(a) for a in r.attachments] == [("image", "a.png", 512), ("audio", "b.wav", 25), ("document", "c.pdf", 1536)]
    assert r.attachment_tokens == 2073 and [tuple(m) for m in r.mask] == [(len(r.formatted) - 7, len(r.formatted) - 7)]
    assert chat.format_conversations(df.limit(0)).count() == 0
