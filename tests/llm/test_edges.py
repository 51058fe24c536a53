"""Clashing columns, very long texts, ties, hot keys, odd letters, large counts: cases beside those of test_llm."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siltstone.llm import chat, jaccard, lm_scoring, nearest, packing, quality, sharding, warc
from siltstone.llm._common import discard, materialise
from tests.llm.test_llm import plain_components

F = chat.F


# -- packing -------------------------------------------------------------------------------------------------------------
def test_ids_of_every_letter_below_u0250():
    own = packing.WordIds(packing.default_tokenizer())
    chars = [chr(c) for c in range(1, 0x250)]
    texts = [x for c in chars for x in (c, f"a{c}b", f"{c}'s 1{c}2", f"{c}!{c}")]
    rng = random.Random(3)
    texts += ["".join(rng.choices(chars, k=rng.randint(1, 30))) for _ in range(2000)]
    want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    for t, got, w in zip(texts, own.encode(texts), want):
        assert np.frombuffer(got, "<u4").tolist() == w.ids, repr(t)


# -- sharding ------------------------------------------------------------------------------------------------------------
def test_blocks_keep_their_size_at_many_partitions():
    for parts, total in ((1_000, 60_000_000), (250_000, 15_000_000_000)):
        _, rows = sharding.block_sizes(total, 16, sharding.BLOCK_ROWS, 400)
        assert rows.sum() == total and rows.max() <= sharding.BLOCK_ROWS and rows.min() > sharding.BLOCK_ROWS // 2
        assert rows.max() - rows.min() <= 2
    before = np.arange(250_001, dtype=np.int64) * 60_000  # 15 thousand million rows, more than numpy draws from
    capacity = np.full(16 * 40, 15_000_000_000 // 640, np.int64)
    row = sharding.matrix_row(123_456, before, capacity, 5)
    assert row.sum() == 60_000 and row.min() > 30 and row.max() < 200  # 94 a block on average
    assert (row == sharding.matrix_row(123_456, before, capacity, 5)).all()


@pytest.mark.parametrize("limit", [sharding.NUMPY_LIMIT, 8])
def test_matrix_has_exact_sums_and_its_law(limit, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_BLOCKS", 2)
    counts, capacity, times = [3, 0, 2, 4], [4, 3, 2], 4000
    seen = Counter()
    for seed in range(times):
        m = sharding.communication_matrix(counts, capacity, seed, limit)
        assert m.sum(1).tolist() == counts and m.sum(0).tolist() == capacity
        seen[tuple(m.ravel().tolist())] += 1
    # Probability of a matrix: products of factorials of the sums over those of the entries.
    fact = math.factorial
    rows = [[r for r in itertools.product(range(5), repeat=3) if sum(r) == n] for n in counts]
    law = {}
    for m in itertools.product(*rows):
        if np.array(m).sum(0).tolist() == capacity:
            x = tuple(itertools.chain(*m))
            law[x] = math.prod(map(fact, counts + capacity)) / fact(9) / math.prod(map(fact, x))
    assert abs(sum(law.values()) - 1) < 1e-9 and set(seen) <= set(law)
    chi = sum((seen[x] - p * times) ** 2 / (p * times) for x, p in law.items())
    assert chi < len(law) + 5 * math.sqrt(2 * len(law))


def test_every_arrangement_is_as_likely(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(4)], "doc_id long").repartition(2).write.parquet(f"{tmp_path}/four")
    four = spark.read.parquet(f"{tmp_path}/four")
    seen, times = Counter(), 120
    for seed in range(times):
        rows = sharding.hypergeometric_shards(four, 2, seed=seed, stable=True).collect()
        seen[tuple(r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)))] += 1
    assert sum((seen[x] - 5) ** 2 / 5 for x in itertools.permutations(range(4))) < 23 + 5 * math.sqrt(46)


# -- near duplicates -----------------------------------------------------------------------------------------------------
def _copies(n_near, n_same):
    base = [f"w{i}" for i in range(120)]
    rows = [" ".join(base)] * n_same
    for k in range(n_near):
        words = base.copy()
        words[k % 110] = f"x{k}"
        rows.append(" ".join(words))
    rng = random.Random(1)
    rows += [" ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, "", "one two"]
    return list(enumerate(rows))


@pytest.mark.parametrize("change", [{}, {"HOT_POSTINGS": 3}, {"ASKERS": 2}, {"BLOCK_POSTINGS": 50, "RUN_POSTINGS": 300}, {"BITMAP_BITS": 1 << 10, "SEEN_CLASSES": 3}])
def test_near_duplicates_with_hot_groups(spark, tmp_path, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = _copies(60, 20)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/d")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.read.parquet(f"{tmp_path}/d")).collect())
    assert got == plain_components(rows)


def test_words_of_any_length_and_place():
    edge = "b" * jaccard.SEGMENT
    huge = "a" * (jaccard.SEGMENT + 5)
    for text in (f"{edge} q", f"q {edge}", f"x {huge} y  {huge.upper()}  z", f" {edge}B c", "p " * jaccard.SEGMENT, " " * (2 * jaccard.SEGMENT) + "k"):
        words = text.split()
        got = jaccard.word_hashes(text).tolist()
        assert len(got) == len(words)
        own = {w.lower(): jaccard.word_hashes(w).tolist() for w in set(words)}
        assert all([g] == own[w.lower()] for w, g in zip(words, got))
        assert len({tuple(x) for x in own.values()}) == len(own)


def test_sets_of_rows_in_a_sliced_column():
    texts = ["A b c d e f", None, "", "a B c d e f", "é É x y z q", "one two"] * 40
    col = pa.array(texts)
    whole = list(jaccard.shingle_sets(col))
    assert [len(s) for s in whole[:6]] == [2, 0, 0, 2, 1, 1] and (whole[0] == whole[3]).all()
    assert all((a == b).all() for a, b in zip(jaccard.shingle_sets(col.slice(7, 50)), whole[7:57]))


# -- language model ------------------------------------------------------------------------------------------------------
def test_scores_of_a_plain_bigram_model(spark, tmp_path):
    """score equals a smoothed bigram model on counts that are read back by powers of two."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{min(int(rng.expovariate(0.1)), 60)}" for _ in range(rng.randint(0, 80)))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    docs = spark.read.parquet(f"{tmp_path}/d").withColumn("held_out", held)
    model = lm_scoring.train(docs, least_bits=1 << 18)  # no false positives, so the model alone is looked at
    got = {r.doc_id: r for r in lm_scoring.score_documents(docs, model).collect()}
    one, two = Counter(), Counter()
    tokens = {i: [*t.split(), None] for i, t in rows}
    for i, ts in tokens.items():
        if not got[i].held_out:
            one.update(ts)
            two.update(zip([None, *ts], ts))
    read = lambda c: (1.5 * 2.0 ** math.floor(math.log2(c)) * 2 - 1) / 2 if c else 0.0
    n, v = sum(one.values()), len(one)
    for i, ts in tokens.items():
        score = 0.0
        for before, t in zip([None, *ts], ts):
            p = (read(one[t]) + 1) / (n + v + 1)
            context = max(read(one[before]), 1)
            score += math.log10(min((min(read(two[before, t]), context) + lm_scoring.KAPPA * p) / (context + lm_scoring.KAPPA), 1.0))
        assert abs(score - got[i].score) < 1e-6


def test_false_positives_stay_rare_at_any_size():
    rng = np.random.Generator(np.random.PCG64(1))
    for n in (1_000, 30_000, 300_000):
        keys = rng.integers(0, 2**63, 2 * n, np.uint64)
        f = lm_scoring.block_filter([(keys[:n], np.ones(n, np.int64))])
        assert (f.levels(keys[:n]) >= 1).all()
        assert (f.levels(keys[n:]) > 0).mean() < 0.02


# -- nearest -------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("dim", [64, 768])
def test_recall_on_unstructured_vectors(spark, tmp_path, dim):
    n = 11 * nearest.CHUNK
    x = np.random.default_rng(dim).normal(size=(n, dim)).astype(np.float32)
    flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": flat}), f"{tmp_path}/e.parquet", row_group_size=nearest.CHUNK)
    got = {}
    for r in nearest.nearest(spark.read.parquet(f"{tmp_path}/e.parquet"), query_mod=1000).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, n, 1000):
        s = u @ u[q]
        s[q] = -2
        hits += len(got[q] & set(np.argpartition(-s, 5)[:5].tolist()))
    recall = hits / 5 / len(got)
    print(f"recall at 5, {dim} dimensions: {recall:.4f}")
    assert recall >= 0.9


def test_nearest_ties_beyond_the_finalists(spark):
    rows = [(i, [1.0, float(i % 2), 0.0]) for i in range(0, 400)] + [(1000 + i, [0.0, 0.0, float(i + 1)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.nearest(df, query_mod=50).where("query_id = 1000").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1001 + i, 1.0) for i in range(5)]
    clash = df.selectExpr("vec_id", "embedding", "1 AS codes", "2 AS norm", "3 AS score", "4 AS rank", "5 AS query_id")
    assert sorted(map(tuple, nearest.nearest(clash, query_mod=50).collect())) == sorted(map(tuple, nearest.nearest(df, query_mod=50).collect()))


# -- quality -------------------------------------------------------------------------------------------------------------
def test_sums_are_those_of_one_machine(spark):
    rows = [(i, (f"Good plain words number {i} are here. " if i % 2 else f"!! {i} $$ ## ") * (1 + i % 7)) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    weights, _, _ = quality.fit(materialise(quality.document_statistics(docs)), labels)
    crc = lambda t: __import__("zlib").crc32(t.encode())
    own = [(i, t) for i, t in rows if crc(str(i)) % 5 != 0 and crc(f"fold{i}") % 4 != 0]
    z = quality.fourier(np.array([quality.statistics(t) for _, t in own]))
    y = np.array([i % 2 for i, _ in own], float)
    ridge = quality.RIDGE * len(own) * np.diag([1.0] * (quality.FEATURES - 1) + [1e-6])
    assert np.allclose(weights, np.linalg.solve(z.T @ z + ridge, z.T @ y), atol=1e-6)


# -- WARC ----------------------------------------------------------------------------------------------------------------
def test_warc_long_payloads_and_clashing_columns(spark, tmp_path):
    long = "<p>WARC/1.1\r\n\r\n\r\n\r\n" * 60_000
    rows = [(1, "u", long, "x", 7), (2, "u", long, "y", 8), (3, None, None, "z", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n long")
    warc.write_archive(pages, f"{tmp_path}/a")
    got = {r.capture.split(":")[2]: r for r in warc.assemble(warc.read_archive(spark, f"{tmp_path}/a")).collect()}
    assert bytes(got["2"].response.payload).decode() == long and got["1"].response.type == "revisit"
    assert got["1"].response.payload_bytes == len(long) and got["3"].response.payload_bytes == 0


# -- chat ----------------------------------------------------------------------------------------------------------------
def test_ties_go_by_the_text(spark):
    rows = [(1, 0, "user", t) for t in ("A", "<s>", "[INST]", "\\", "z")] + [(1, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    r = chat.format_conversations(turns).select(chat.read_turns(F.col("formatted")).alias("t")).first()
    assert [(x.role, x.text) for x in r.t] == [("", "")] + [("user", t) for t in sorted(("A", "<s>", "[INST]", "\\", "z"))]


def test_placeholders_are_told_from_texts(spark):
    parts = [("text", "see <|image|> \\l|image|>", None, None), ("image", None, "ref1", 2), ("audio", None, "ref2", None), ("text", "<|audio|>", None, None), ("document", None, "r3", 1)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PART}")
    r = chat.format_conversations(df).select(chat.read_parts(F.col("formatted")).alias("p"), "attachments").first()
    assert [(x.type, x.text) for x in r.p[0].parts] == [(t, x) for t, x, _, _ in parts]
    assert [a.ref for a in r.attachments] == ["ref1", "ref2", "r3"]


def test_chat_long_texts_and_clashing_columns(spark):
    long = "<s>[INST] \\ " * 40_000
    df = spark.createDataFrame([(1, 0, "assistant", long, 1, 2)], "conv_id long, turn long, role string, text string, ws int, body int").withColumn("parts", chat.text_parts(F.col("text")))
    r = chat.format_conversations(df).select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("mask")).alias("loss")).first()
    assert r.t[0].text == long and r.loss == long


# -- tables in between ---------------------------------------------------------------------------------------------------
def test_discarded_tables_are_gone(spark):
    import os

    t = materialise(spark.range(3))
    assert t.count() == 3 and os.path.isdir(t._stored)
    discard(t, None, spark.range(1))
    assert not os.path.exists(t._stored)


def test_workers_give_free_memory_back():
    import re
    from pathlib import Path

    from siltstone.llm._common import releasing

    def held():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    def run(batches):
        for b in batches:
            held_back = [bytearray(1000) for _ in range(200_000)]
            kept.append(held_back[::1000])  # small rests keep the rest from going by itself
            yield b

    kept = []
    before = held()
    plain = list(run(iter([1, 2])))
    grown = held() - before
    assert list(releasing(run)(iter([1, 2]))) == plain
    assert grown > 100 and held() - before < 50


def test_packing_with_ids_keeps_fewer_words(spark, monkeypatch):
    path = packing.default_tokenizer()
    texts = [f"word{i} w{i}-x{i} {i}" for i in range(300)] * 2
    few, all_ = packing.WordIds(path, 20), packing.WordIds(path)
    assert few.encode(texts) == all_.encode(texts)
    assert max(len(k) for c in (few.ids, few.parts) for k in (c, c.before)) <= 20 < len(all_.ids)
    monkeypatch.setattr(packing, "CACHE_WORDS_WITH_IDS", 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = packing.stage(spark, docs, "").collect()
    own = all_.encode(texts)
    assert {r.doc_id: np.array(r.ids, "<u4").tobytes() for r in got} == {i: x + b"\1\0\0\0" for i, x in enumerate(own)}
    assert packing.worker_tokenizer(path, 20) is packing.worker_tokenizer(path, 20)
    assert packing.worker_tokenizer(path).ids.most is None and len(packing._WORKER) == 1
