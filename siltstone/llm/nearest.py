"""Approximate nearest neighbours by additive quantisation.

Codebooks of full dimension are fitted stage by stage to the residuals of a bounded sample of unit vectors. Every
vector is encoded by beam search over the stages: the sum of one codeword a stage approximates it; the codes and the
norm of the sum are stored beside the vector. A block of queries makes one lookup table per stage, code scores are sums
of table entries divided by the stored norm, and the best of each partition are reranked by the exact cosine in double
precision before anything is exchanged, so a partition sends `k` rows a query. How many are reranked follows from the
sample: where the codes say little, as with unstructured vectors of many dimensions, more are.

Equal vectors (copies) tie exactly: only the k + 1 smallest ids of each distinct vector of a chunk can be among the
answers, and only those are scored, so large groups of copies can't crowd others out.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
an id; a vector whose length differs from the most common one takes no part; a row never answers a query of its own
id; of repeated ids each row is a candidate, the best row counts, and the query is the row with the smallest vector;
fewer candidates than k give fewer ranks; no rows give no results. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, pick, table

STAGES = 16
CODES = 64
BEAM = 4
#: Rows that the codebooks are fitted on, about; twice as many at most: the bounded sample, chosen by hash.
SAMPLE_ROWS = 8_192
#: Queries in one broadcast block.
QUERY_BLOCK = 4_096
#: Candidates of a chunk that are reranked exactly for each query, at least.
RERANK = 256
CHUNK = 4_096
#: Queries of the sample that the number of candidates is found with, and the share of their answers it must hold.
TRIALS, TRIAL_SHARE = 128, 0.99
#: Numbers that reranking holds at once; best of a chunk that are compared once more where all its cosines are at hand.
HELD_NUMBERS, FINALISTS = 4_000_000, 64


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision, without overflow."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of matching rows in double precision."""
    q = q / np.abs(q).max(axis=-1, keepdims=True)
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return (q * x).sum(-1) / (np.sqrt((q * q).sum(-1)) * np.sqrt((x * x).sum(-1)))


def fit_codebooks(sample: np.ndarray, stages: int = STAGES, codes: int = CODES, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """(stages, codes, dim): k-means of what the stages before leave over."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left, out = sample.astype(np.float32), []
    for _ in range(stages):
        book = left[rng.choice(len(left), codes, replace=len(left) < codes)].copy()
        for _ in range(rounds):
            near = (left @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
            member = (near == np.arange(codes)[:, None]).astype(np.float32)
            total, n = member @ left, member.sum(1)
            book = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], left[rng.integers(0, len(left), codes)])
        near = (left @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
        left = left - book[near]
        out.append(book)
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes and the norm of their sum, by beam search: the beam best partial sums of each vector go on."""
    n, dim = x.shape
    x = x.astype(np.float32)
    total = np.zeros((n, 1, dim), np.float32)
    codes = np.zeros((n, 1, 0), np.uint8)
    for book in books:
        left = x[:, None, :] - total
        gain = (left.reshape(-1, dim) @ book.T).reshape(n, left.shape[1], -1) * -2 + (book * book).sum(1) + (left * left).sum(2)[:, :, None]
        width = gain.shape[2]
        keep = min(beam, gain.shape[1] * width)
        best = np.argpartition(gain.reshape(n, -1), keep - 1, axis=1)[:, :keep]
        parent, code = best // width, best % width
        rows = np.arange(n)[:, None]
        total = total[rows, parent] + book[code]
        codes = np.concatenate([codes[rows, parent], code[:, :, None].astype(np.uint8)], axis=2)
    error = ((x[:, None, :] - total) ** 2).sum(2)
    best = error.argmin(1)
    rows = np.arange(n)
    norm = np.sqrt((total[rows, best] ** 2).sum(1))
    return codes[rows, best], np.maximum(norm, 1e-12)


def code_scores(luts: np.ndarray, codes: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Scores (queries, rows) from lookup tables (stages, queries, codes)."""
    score = np.zeros((luts.shape[1], len(codes)), np.float32)
    for m in range(len(luts)):
        score += luts[m][:, codes[:, m]]
    return score / norm


def lookup_tables(queries: np.ndarray, books: np.ndarray) -> np.ndarray:
    return np.einsum("qd,mcd->mqc", queries, books).astype(np.float32)


def rerank_depth(sample: np.ndarray, books: np.ndarray, k: int, least: int = RERANK) -> int:
    """How deep among a chunk's code scores the k nearest lie, by queries from the sample of unit vectors."""
    rows = sample[:CHUNK]
    n = min(TRIALS, len(rows))
    if len(rows) <= max(least, k + 1):
        return least
    score = code_scores(lookup_tables(rows[:n].astype(np.float32), books), *encode(rows, books))
    exact = rows[:n] @ rows.T
    for x in (score, exact):
        x[np.arange(n), np.arange(n)] = -np.inf
    best = np.argpartition(-exact, k - 1, axis=1)[:, :k]
    own = score[np.arange(n)[:, None], best]
    place = (score[:, None, :] > own[:, :, None]).sum(2) + 1
    return max(least, int(np.ceil(1.25 * np.quantile(place, TRIAL_SHARE) * CHUNK / len(rows))))


def valid_vectors(df: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that take part."""
    rows = pick(df, {"vec_id": "long", "embedding": "array<double>"})
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    ok = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(ok & F.exists("embedding", lambda v: v != 0))
    dims = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("embedding") == (dims[0].d if dims else 0))


def build_index(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, np.ndarray | None, np.ndarray | None]:
    """Table (vec_id, embedding, codes, norm) of every valid row, the codebooks, and the sample's unit vectors."""
    rows = valid_vectors(df)
    # Rows whose hash falls into one of `every` classes: tasks send their share of the sample only.
    every = max(1, -(-rows.count() // sample_rows))
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0)
    pandas = some.orderBy(F.xxhash64("vec_id"), "vec_id").select("embedding").limit(2 * sample_rows).toPandas()
    sample = unit(np.stack(pandas["embedding"].to_numpy()).astype(np.float64)) if len(pandas) else None
    books = fit_codebooks(sample) if sample is not None else None

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                c = b.slice(at, CHUNK)
                x = c.column(1).flatten().to_numpy(zero_copy_only=False).reshape(c.num_rows, -1)
                codes, norm = encode(unit(x), books)
                yield pa.RecordBatch.from_arrays([*c.columns, pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(norm, pa.float32())], names=["vec_id", "embedding", "codes", "norm"])

    if books is None:
        return rows.select("*", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("float").alias("norm")).limit(0), None, None
    return materialise(rows.mapInArrow(run, "vec_id long, embedding array<double>, codes binary, norm float")), books, sample


def _search_block(index: DataFrame, books: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, rerank: int) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast((ids, queries, unit(queries).astype(np.float32)))

    def run(batches):
        import pyarrow as pa

        qid, full, short = sent.value
        luts = lookup_tables(short, books)
        full_unit = unit(full)
        best = [np.empty(0, np.int64) for _ in range(3)]

        def top(q, i, s):
            """The k best of each query, of repeated ids the best row."""
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            pair = np.lexsort((np.arange(len(q)), i, q))
            dup = np.zeros(len(q), bool)
            dup[pair[1:]] = (q[pair[1:]] == q[pair[:-1]]) & (i[pair[1:]] == i[pair[:-1]])
            q, i, s = q[~dup], i[~dup], s[~dup]
            first = np.searchsorted(q, q, "left")
            keep = np.arange(len(q)) - first < k
            return q[keep], i[keep], s[keep]

        def ranked(rows, cand, vid, x):
            """The k best of candidates by the exact cosine, never a query itself."""
            exact = cosine(full[rows][:, None, :], x[cand])
            q = np.broadcast_to(rows[:, None], cand.shape)
            other = vid[cand] != qid[q]
            return top(q[other], vid[cand][other], exact[other])

        def answer(vid, x, codes, norm):
            order = np.lexsort((vid,))
            vid, x, codes, norm = vid[order], x[order], codes[order], norm[order]
            view = np.ascontiguousarray(x).view([("", x.dtype)] * x.shape[1]).ravel()
            _, group = np.unique(view, return_inverse=True)
            by = np.argsort(group, kind="stable")
            sizes = np.bincount(group)
            nth = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = np.sort(by[nth <= k])
            vid, x, codes, norm = vid[keep], x[keep], codes[keep], norm[keep]
            r = min(-(-rerank * max(len(vid), CHUNK) // CHUNK), len(vid))
            whole = r * 8 > len(vid) and r > FINALISTS  # so many that all cosines at once cost less
            near_unit = unit(x) if whole else None
            found = []
            for a in range(0, len(qid), 256):
                score = code_scores(luts[:, a : a + 256], codes, norm)
                cand = np.argpartition(-score, r - 1, axis=1)[:, :r] if r < len(vid) else np.broadcast_to(np.arange(len(vid)), score.shape)
                close = np.zeros(len(score), bool)
                if whole:
                    dots = np.take_along_axis(full_unit[a : a + 256] @ near_unit.T, cand, axis=1)
                    order = np.argpartition(-dots, FINALISTS - 1, axis=1)[:, :FINALISTS]
                    held = np.sort(np.take_along_axis(dots, order, axis=1), axis=1)
                    close = held[:, 0] > held[:, -k - 1] - 1e-9  # too many alike: all candidates are compared
                    found.append(ranked(a + np.nonzero(~close)[0], np.take_along_axis(cand, order, axis=1)[~close], vid, x))
                rest = np.nonzero(close)[0] if whole else np.arange(len(score))
                each = max(1, HELD_NUMBERS // (r * x.shape[1]))
                for at in range(0, len(rest), each):
                    some = rest[at : at + each]
                    found.append(ranked(a + some, cand[some], vid, x))
            return [np.concatenate(z) for z in zip(*found)]

        held: list = []

        def flush():
            nonlocal best, held
            if held:
                vid, x, codes, norm = (np.concatenate(z) for z in zip(*held))
                got = answer(vid, x, codes, norm)
                best = list(top(*[np.concatenate([b, g]) for b, g in zip(best, got)])) if len(best[0]) else got
                held = []

        rows = 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                c = b.slice(at, CHUNK)
                x = c.column(1).flatten().to_numpy(zero_copy_only=False).reshape(c.num_rows, -1)
                codes = np.frombuffer(b"".join(c.column(2).to_pylist()), np.uint8).reshape(c.num_rows, -1)
                held.append((c.column(0).to_numpy(), x, codes, c.column(3).to_numpy()))
                rows += c.num_rows
                if rows >= CHUNK:
                    flush()
                    rows = 0
        flush()
        if len(best[0]):
            q, i, s = best
            yield pa.RecordBatch.from_arrays([pa.array(qid[q]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, query_mod: int = 50, k: int = 5, rerank: int | None = None, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k nearest by cosine, of all other rows, for every row whose id is divisible by query_mod.

    rerank: candidates of a chunk that are compared exactly; None: as many as the sample asks for.
    """
    spark = df.sparkSession
    index, books, sample = build_index(df)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if books is None:
        return empty
    if rerank is None:
        rerank = rerank_depth(sample, books, k)
    queries = index.where(F.col("vec_id") % query_mod == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    parts: list[DataFrame] = []
    ids: list[int] = []
    vectors: list[list[float]] = []

    def block() -> None:
        found = _search_block(index, books, np.array(ids, np.int64), np.array(vectors, np.float64), k, rerank)
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        parts.append(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
        ids.clear()
        vectors.clear()

    for r in queries.toLocalIterator():
        ids.append(r.vec_id)
        vectors.append(r.embedding)
        if len(ids) == query_block:
            block()
            parts[-1] = materialise(parts[-1])  # its query block can go
    if ids:
        block()
    out = parts[0] if parts else empty
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_nearest": op8_nearest}
ORACLES: dict[str, str] = {}
