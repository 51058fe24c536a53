"""Language-model scoring from a log-frequency Bloom filter.

N-gram counts of all training documents are summed exactly: documents are looked at a chunk at a time, tasks send the
distinct n-grams of a chunk as sorted runs of (hash, count) by hash block, and a block is merged by one task at a time.
A count c is stored as 1 + floor(log2 c) members (n-gram, 1), (n-gram, 2), ... of the block's Bloom filter, which has a
fixed number of bits for each of its members, so false positives are as rare in a large corpus as in a small one; reading
it back asks for one member after another until one is missing. No filter leaves its task: the block answers each run
with the levels of its n-grams, and of words with their exact counts too, and the answers meet the chunk's documents
again. Probabilities are smoothed towards the unigrams that the same filter holds. The exact unigram score comes beside.

Defined results: a null or empty text is its end alone; a row without an id counts as training; repeated rows count
and are scored each; a very long text is a chunk of its own; an empty table gives an empty result; without any training row counts are zero; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import crc32_text, materialise, pick, table
from .jaccard import mix, scramble, word_hashes

ORDER = 2
#: Bits of a block's filter: at least so many for each member, so a probe is wrong for fewer than one in ten.
BITS_EACH, LEAST_BITS = 20, 1 << 10
PROBES = 2
LEVELS = 40
#: Weight of the unigrams in a bigram's probability, in counts.
KAPPA = 20.0
#: Text of a chunk and of a block's training documents, in bytes.
CHUNK_BYTES, BLOCK_BYTES = 6_000_000, 8_000_000
END = np.uint64(0xA5A5_5A5A_1234_9876)
#: What lies before a text.
BEFORE = np.array([END])


def tokens_of(text: str | None) -> np.ndarray:
    """Hashes of the words and, last, the end."""
    return np.append(word_hashes(text), END)


def ngrams(tokens: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the order-grams that end at each token; what lies before the text is ends."""
    if order == 1:
        return tokens
    return mix(np.concatenate([np.full(order - 1, END), tokens]), order)


class LogFrequencyFilter:
    """A Bloom filter in blocks: all members of an n-gram lie in the block of its hash's top bits."""

    def __init__(self, bits: int, blocks: int):
        self.block_bits = bits // blocks
        self.shift = np.uint64(64 - (blocks.bit_length() - 1)) if blocks > 1 else None
        self.words = np.zeros(bits // 8, np.uint8)

    def block(self, key: np.ndarray) -> np.ndarray:
        return (key >> self.shift).astype(np.int64) if self.shift is not None else np.zeros(len(key), np.int64)

    def place(self, key: np.ndarray, level: int, probe: int) -> np.ndarray:
        salt = np.uint64(0x9E3779B97F4A7C15 * (level * PROBES + probe + 1) & (2**64 - 1))
        x = scramble(key * np.uint64(2 * level + 1) + salt)
        return self.block(key) * self.block_bits + (x & np.uint64(self.block_bits - 1)).astype(np.int64)

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        level = np.floor(np.log2(count)).astype(int) + 1
        for j in range(1, int(level.max(initial=0)) + 1):
            some = key[level >= j]
            for i in range(PROBES):
                at = self.place(some, j, i)
                np.bitwise_or.at(self.words, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def levels(self, key: np.ndarray) -> np.ndarray:
        """How many members of each n-gram are found in a row."""
        out = np.zeros(len(key), np.int64)
        live = np.arange(len(key))
        for j in range(1, LEVELS):
            for i in range(PROBES):
                at = self.place(key[live], j, i)
                live = live[(self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(live):
                break
            out[live] = j
        return out

    def counts(self, key: np.ndarray) -> np.ndarray:
        return middle(self.levels(key))


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level."""
    level = level.astype(np.int64)
    return np.where(level > 0, (1.5 * 2.0 ** np.maximum(level - 1, 0) * 2 - 1) / 2, 0.0)


def block_filter(grams: list[tuple[np.ndarray, np.ndarray]], least_bits: int = LEAST_BITS) -> LogFrequencyFilter:
    """The filter of a block's (keys, counts), as large as its members ask for."""
    members = sum(int(np.floor(np.log2(count)).sum()) + len(count) for _, count in grams)
    bits = least_bits
    while bits < BITS_EACH * members:
        bits *= 2
    out = LogFrequencyFilter(bits, 1)
    for key, count in grams:
        out.add(key, count)
    return out


def _chunks(batches, text: int, chunk_bytes: int):
    """Batches with the chunk of each row: rows in a row of one task that have about chunk_bytes of text together."""
    from pyspark import TaskContext
    import pyarrow.compute as pc

    base, done = TaskContext.get().partitionId() << 32, 0
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        upto = done + np.cumsum(size)
        done += int(size.sum())
        yield b, base + (upto - size) // chunk_bytes


def _gather(docs: DataFrame, order: int, blocks: int, chunk_bytes: int) -> DataFrame:
    """Sorted runs of (hash, training count) by chunk, order and hash block; docs: text, held_out."""
    shift = np.uint64(64 - (blocks.bit_length() - 1))

    def run(batches):
        import pyarrow as pa

        kind = pa.schema([("block", pa.int32()), ("chunk", pa.int64()), ("gram", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
        current, own = None, {False: [], True: []}

        def flush():
            for g in range(1, order + 1):
                # Held-out documents, and what lies before a text, are asked for but not counted.
                known, count = np.unique(np.concatenate([ngrams(t, g) for t in own[False]] or [np.zeros(0, np.uint64)]), return_counts=True)
                key = np.union1d(known, np.concatenate([ngrams(t, g) for t in [*own[True], BEFORE]]))
                every = np.zeros(len(key), np.int64)
                every[np.searchsorted(key, known)] = count
                edge = np.searchsorted((key >> shift).astype(np.int64), np.arange(blocks + 1)).tolist()
                rows = []
                for k, (lo, hi) in enumerate(zip(edge, edge[1:])):
                    if lo < hi:
                        part = every[lo:hi]
                        rows.append({"block": k, "chunk": current, "gram": g, "keys": key[lo:hi].tobytes(), "counts": part.astype(_width(int(part.max()))).tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

        for b, chunk in _chunks(batches, 0, chunk_bytes):
            for c, text, held in zip(chunk.tolist(), b.column(0), b.column(1).to_pylist()):
                if c != current and current is not None:
                    yield from flush()
                    own = {False: [], True: []}
                current = c
                own[held].append(tokens_of(text.as_py()))
        if current is not None:
            yield from flush()

    return docs.mapInArrow(run, "block int, chunk long, gram int, keys binary, counts binary")


def _width(most: int) -> type:
    return np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int64


def _merge(runs: DataFrame, blocks: int, least_bits: int) -> DataFrame:
    """The answer to each run: levels of its n-grams and counts of its words; and a row of totals (gram 0) for each block."""

    def run(batches):
        import pyarrow as pa

        kind = pa.schema([("block", pa.int32()), ("chunk", pa.int64()), ("gram", pa.int32()), ("levels", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64())])
        current, own = None, {}

        def close():
            merged = {}
            for g, parts in own.items():
                key = np.concatenate([p[1] for p in parts])
                order = np.argsort(key, kind="stable")
                key, count = key[order], np.concatenate([p[2] for p in parts])[order]
                first = np.concatenate([[True], key[1:] != key[:-1]])
                edge = np.nonzero(first)[0]
                place = np.empty(len(key), np.int64)
                place[order] = np.cumsum(first) - 1
                merged[g] = key[edge], np.add.reduceat(count, edge), place
            filter_ = block_filter([(key[count > 0], count[count > 0]) for key, count, _ in merged.values()], least_bits)
            for g, parts in own.items():
                key, count, place = merged[g]
                level, at, rows = filter_.levels(key).astype(np.uint8), 0, []
                for chunk, keys, _ in parts:
                    some = place[at : at + len(keys)]
                    at += len(keys)
                    rows.append({"block": current, "chunk": chunk, "gram": g, "levels": level[some].tobytes(), "counts": count[some].tobytes() if g == 1 else None})
                if g == 1:
                    rows.append({"block": current, "gram": 0, "tokens": int(count.sum()), "distinct": int((count > 0).sum())})
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

        for b in batches:
            for k, chunk, g, keys, counts in zip(*[b.column(i).to_pylist() for i in range(3)], b.column(3), b.column(4)):
                if k != current and own:
                    yield from close()
                    own = {}
                current = k
                key, count = np.frombuffer(keys.as_py(), np.uint64), counts.as_py()
                kind_ = {1: np.uint8, 2: np.uint16, 8: np.int64}[len(count) // len(key)]
                own.setdefault(g, []).append((chunk, key, np.frombuffer(count, kind_).astype(np.int64)))
        if own:
            yield from close()

    parts = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks // 4, 1)
    sorted_runs = runs.repartition(parts, "block").sortWithinPartitions("block")
    return sorted_runs.mapInArrow(run, "block int, chunk long, gram int, levels binary, counts binary, tokens long, distinct long")


class Model:
    """The answers to the chunks of documents, how they were cut, and the totals."""

    def __init__(self, answers: DataFrame, tokens: int, distinct: int, order: int, chunk_bytes: int, tasks: int):
        self.answers, self.tokens, self.distinct, self.order, self.chunk_bytes, self.tasks = answers, tokens, distinct, order, chunk_bytes, tasks


def score_chunk(docs: list[np.ndarray], levels: dict[int, np.ndarray], exact: np.ndarray, tokens: int, distinct: int, order: int):
    """Per document of a chunk: n_tokens, known words, base score, model score; levels and counts by sorted distinct n-gram."""
    size = np.array([len(d) for d in docs])
    start = np.cumsum(size) - size
    first = np.zeros(int(size.sum()), bool)
    first[start] = True
    for g in range(1, order + 1):
        key, inv = np.unique(np.concatenate([ngrams(d, g) for d in [*docs, BEFORE]]), return_inverse=True)
        if len(key) != len(levels.get(g, ())) or (g == 1 and len(key) != len(exact)):
            raise RuntimeError("the documents changed while they were scored")
        found = middle(levels[g])[inv]
        count, before = found[:-1], found[-1]
        if g == 1:
            own = exact[inv[:-1]]
            base = np.add.reduceat(np.log10((own + 1) / (tokens + distinct + 1)), start)
            known = np.add.reduceat((own > 0).astype(np.int64), start)
            p = (count + 1) / (tokens + distinct + 1)
        else:
            p = (np.minimum(count, np.maximum(context, 1)) + KAPPA * p) / (np.maximum(context, 1) + KAPPA)
        context = np.where(first, before, np.concatenate([[0.0], count[:-1]]))
    return size, known, base, np.add.reduceat(np.log10(np.minimum(p, 1.0)), start)


def train(docs: DataFrame, order: int = ORDER, least_bits: int = LEAST_BITS, chunk_bytes: int = CHUNK_BYTES) -> Model:
    """What the rows of docs (text, held_out) that are not held out say about the n-grams of all rows; docs must be stable."""
    parts = docs.rdd.getNumPartitions()
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 64
    while blocks < 65536 and (blocks < parts or blocks * BLOCK_BYTES < length):
        blocks *= 2
    merged = materialise(_merge(_gather(docs.select("text", "held_out"), order, blocks, chunk_bytes), blocks, least_bits))
    total = merged.where("gram = 0").agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    answers = merged.where("gram > 0").select("chunk", "gram", "block", "levels", "counts")
    return Model(answers, total.n or 0, total.v or 0, order, chunk_bytes, length // (4 * chunk_bytes))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text, held_out), as the model was trained on, with the exact base score and the model's score."""
    tokens, distinct, order, chunk_bytes = model.tokens, model.distinct, model.order, model.chunk_bytes

    def number(batches):
        import pyarrow as pa

        for b, chunk in _chunks(batches, 1, chunk_bytes):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(chunk, pa.int64())], names=[*b.schema.names, "chunk"])

    def score(own, answers):
        import pyarrow as pa

        answers = answers.sort_by("block")
        joined = {g: [] for g in range(1, order + 1)}
        exact = []
        for g, level, count in zip(answers["gram"].to_pylist(), answers["levels"], answers["counts"]):
            joined[g].append(np.frombuffer(level.as_py(), np.uint8))
            if g == 1:
                exact.append(np.frombuffer(count.as_py(), np.int64))
        levels = {g: np.concatenate(x) for g, x in joined.items() if x}
        docs = [tokens_of(t.as_py()) for t in own["text"]]
        size, known, base, total = score_chunk(docs, levels, np.concatenate(exact or [np.zeros(0)]), tokens, distinct, order)
        cols = [own["doc_id"], own["held_out"], pa.array(size), pa.array(known), pa.array(np.full(len(size), tokens)), pa.array(base), pa.array(total)]
        return pa.Table.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), model.tasks, 1)
    numbered = docs.select("doc_id", "text", "held_out").mapInArrow(number, "doc_id long, text string, held_out boolean, chunk long")
    both = [x.repartition(parts, "chunk").groupBy("chunk") for x in (numbered, model.answers)]
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both[0].cogroup(both[1]).applyInArrow(score, kind)


def lm_scores(docs: DataFrame, mod: int = 7, held: int = 2, order: int = ORDER, stable: bool = False) -> DataFrame:
    """stable: docs has the same rows in the same partitions whenever it is computed, as a plain Parquet scan does."""
    docs = pick(docs, {"doc_id": "long", "text": "string"})
    if not stable:
        docs = materialise(docs)
    docs = docs.withColumn("held_out", F.coalesce(crc32_text(F.col("doc_id")) % mod == held, F.lit(False)))
    return score_documents(docs, train(docs, order))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), stable=True)


QUERIES = {"op6_lm_scoring": op6_lm_scoring}
ORACLES: dict[str, str] = {}
