"""Best-fit packing by a configuration linear program over the length histogram.

A configuration says how many pieces of each length share a sequence. Multiplicative weights look for a fractional
cover of the histogram with few sequences: weights of lengths that are covered too little grow, and a knapsack dynamic
program prices, for every length, the best configuration that holds it. The averaged solution is rounded down to whole
multiplicities, once with completely filled configurations only and once with all of them, what is left goes best-fit
decreasing into sequences, length class by length class, and the plan with fewer sequences counts.

The driver sees the histogram only (capacity entries at most), whatever the number of pieces. Pieces learn their rank
among those of their length from counts of (input partition, length), so no length class meets in one task, and look up
sequence and offset in the plan, whose size is bounded by the number of lengths.

Defined results: a null text is empty and gives one piece that holds the end id alone; null ids and repeated rows are
packed like others; very long texts are cut into full sequences and a last piece; pieces of one length are alike, so ties
go by place; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, pick, releasing, table

CAPACITY = 4096
END_ID = 1
ROUNDS = 24
#: Entries of a generation of a worker's word cache; there are two at most, of words and of their parts.
CACHE_WORDS = 200_000
#: The same where the ids are kept, as in the pipeline: more is held beside it there, and time is not short.
CACHE_WORDS_WITH_IDS = 50_000
#: Texts that are looked at together for new words, in characters.
GROUP_CHARS = 2_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _latin(category: str) -> str:
    """Characters below U+0250 of a Unicode category, for a pattern's brackets."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == category)


#: How the tokenizer cuts lower-cased Latin text; other texts are left to itself.
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_latin('L')}]+|[{_latin('N')}]|[^\s{_latin('L')}{_latin('N')}]+")
_OTHER = re.compile(r"[^\x00-\x1b\x20-\u024f]|<\|")
_PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    rest = [b for b in range(256) if b not in set(_PLAIN_BYTES)]
    return {b: 256 + k for k, b in enumerate(rest)}


def _is_latin(text: str) -> bool:
    """Only characters that _CUT knows, and no special token."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not _OTHER.search(text)
    return b"<|" not in raw and not any(c in raw for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))


class _Kept(dict):
    """Values by key, made when first asked for; a full generation makes room, and keys that are asked for again stay."""

    def __init__(self, make, most: int | None = None):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        if len(self) >= (self.most or CACHE_WORDS):
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordIds:
    """Ids of texts. The tokenizer drops white space and never joins words across it, so ids of words are kept."""

    def __init__(self, path: str, most: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.parts = _Kept(self._part, most)
        self.ids = _Kept(self._word, most)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        mapped = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        cut = _CUT.findall(word)
        return self._part(word) if len(cut) == 1 else b"".join(map(self.parts.__getitem__, cut))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        get, out = self.ids.__getitem__, []
        for t in texts:
            lower = t.lower()  # judged in lower case: some capitals below U+0250 become letters beyond
            out.append(b"".join(map(get, lower.split())) if _is_latin(lower) else self._whole(t))
        return out


_WORKER: dict[tuple[str, int | None], WordIds] = {}


def worker_tokenizer(path: str, most: int | None = None) -> WordIds:
    """One tokenizer, with its cache, for each Python worker; another one takes its place."""
    if (path, most) not in _WORKER:
        _WORKER.clear()
        _WORKER[path, most] = WordIds(path, most)
    return _WORKER[path, most]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, part and nth (its rank in the task's length class)."""
    path = tokenizer or default_tokenizer()
    most = CACHE_WORDS_WITH_IDS if keep_ids else None

    def run(batches):
        from pyspark import TaskContext
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        tok = worker_tokenizer(path, most)
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * keep_ids

        def answer(keys, texts):
            cols: list[list] = [[] for _ in names]
            for key, ids in zip(keys, tok.encode(texts)):
                ids += end
                n = len(ids) // 4
                for k, at in enumerate(range(0, n, capacity)):
                    own = ids[4 * at : 4 * (at + capacity)]
                    size = len(own) // 4
                    row = (key, k, at, size, zlib.crc32(own), part, int(seen[size]), *([np.frombuffer(own, "<i4")] * keep_ids))
                    seen[size] += 1
                    for c, v in zip(cols, row):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                keys.append(key)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= GROUP_CHARS:
                    yield answer(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield answer(keys, texts)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * keep_ids
    return pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(releasing(run), kind)


def knapsack(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: largest value that fits into c; last[c]: index of a size used there, -1 for none."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c], last[c] = best[c - 1], -2
        k = upto[c]
        if k:
            got = best[c - sizes[:k]] + value[:k]
            i = int(got.argmax())
            if got[i] > best[c]:
                best[c], last[c] = got[i], i
    return best, last


def _trace(last: np.ndarray, sizes: np.ndarray, c: int) -> list[int]:
    out = []
    while c > 0:
        if last[c] == -2:
            c -= 1
        else:
            out.append(int(last[c]))
            c -= int(sizes[last[c]])
    return out


def fractional_cover(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS, eps: float = 0.3) -> dict[tuple[int, ...], float]:
    """Configurations (sorted size indices) with average multiplicities, by multiplicative weights."""
    weight = np.ones(len(sizes))
    budget = float((sizes * demand).sum()) / capacity
    x: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        value = weight * sizes / capacity
        best, last = knapsack(sizes, value, capacity)
        whole = value + best[capacity - sizes]
        near = np.nonzero(whole >= (1 - 0.02) * whole.max())[0]
        share = demand[near] * sizes[near]
        share = share / share.sum() * budget
        cover = np.zeros(len(sizes))
        for i, s in zip(near.tolist(), share.tolist()):
            config = tuple(sorted([i, *_trace(last, sizes, capacity - int(sizes[i]))]))
            x[config] = x.get(config, 0.0) + s / rounds
            np.add.at(cover, list(config), s)
        ratio = cover / demand
        weight *= np.exp(-eps * np.clip(ratio - 1, -1, 1))
        weight /= weight.max()
    return x


def plan_sequences(hist: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[list[tuple[int, int]], int]]:
    """(pieces of a sequence as (length, copies), number of such sequences); covers the histogram exactly."""
    left = {n: c for n, c in hist.items() if c > 0}
    out: list[tuple[list[tuple[int, int]], int]] = []
    if left.get(capacity):
        out.append(([(capacity, 1)], left.pop(capacity)))
    if left:
        sizes = np.array(sorted(left), np.int64)
        rest = np.array([left[int(s)] for s in sizes], np.int64)
        cover = fractional_cover(sizes, rest, capacity, rounds)
        # Part-filled configurations may waste what best fit avoids, or be the only good ones: the shorter plan counts.
        plans = [_rounded(cover, sizes, rest, capacity, least) for least in (capacity, 0)]
        out += min(plans, key=lambda plan: sum(times for _, times in plan))
    return out


def _rounded(cover: dict[tuple[int, ...], float], sizes: np.ndarray, demand: np.ndarray, capacity: int, least: int) -> list[tuple[list[tuple[int, int]], int]]:
    """The cover's configurations of at least that length, rounded down, and best fit for the rest."""
    rest, out = demand.copy(), []
    full = lambda c: int(sizes[list(c)].sum())
    for config, x in sorted(cover.items(), key=lambda cx: (-full(cx[0]), -cx[1], cx[0])):
        if full(config) < least or x < 1:
            continue
        index, copies = np.unique(np.array(config), return_counts=True)
        times = int(min(int(x), (rest[index] // copies).min()))
        if times:
            rest[index] -= times * copies
            out.append(([(int(sizes[i]), int(k)) for i, k in zip(index, copies)], times))
    return out + _best_fit(list(zip(sizes.tolist(), rest.tolist())), capacity)


def _best_fit(rest: list[tuple[int, int]], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing for counts of lengths; equal open sequences are handled together."""
    room: list[list[tuple[list[tuple[int, int]], int]]] = [[] for _ in range(capacity + 1)]
    used = np.zeros(capacity + 1, bool)

    def put(config, times, space):
        if times:
            room[space].append((config, times))
            used[space] = True

    for size, m in sorted(rest, reverse=True):
        while m:
            at = int(used[size:].argmax()) + size
            if used[at]:
                config, times = room[at].pop()
                used[at] = bool(room[at])
                if m >= times:
                    k = min(at // size, m // times)
                    put([*config, (size, k)], times, at - k * size)
                    m -= k * times
                else:
                    put([*config, (size, 1)], m, at - size)
                    put(config, times - m, at)
                    m = 0
            else:
                k = min(capacity // size, m)
                times = m // k
                put([(size, k)], times, capacity - k * size)
                m -= k * times
    return [x for spaces in room for x in spaces]


class Lookup:
    """Arrays that give sequence and offset of the r-th piece of a length."""

    SHIFT = 48

    def __init__(self, plan: list[tuple[list[tuple[int, int]], int]]):
        used: dict[int, int] = {}
        rows, base = [], 0
        for config, times in plan:
            at = 0
            for size, copies in config:
                lo = used.get(size, 0)
                rows.append(((size << self.SHIFT) + lo, lo, copies, base, at))
                used[size] = lo + copies * times
                at += copies * size
            base += times
        rows.sort()
        self.key, self.lo, self.copies, self.base, self.offset = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
        self.sequences = base

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = np.searchsorted(self.key, (length << self.SHIFT) + rank, "right") - 1
        r = rank - self.lo[e]
        return self.base[e] + r // self.copies[e], self.offset[e] + r % self.copies[e] * length


def pack(cut: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """pieces() with sequence_id and offset; cut must be stable, as a written table is."""
    spark = cut.sparkSession
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = materialise(counts)
    hist = {int(r.length): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = spark.sparkContext.broadcast(Lookup(plan_sequences(hist, capacity, rounds)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"))
    # Grows with the input: never broadcast.
    ranked = cut.join(start.hint("merge"), ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth")).drop("first", "nth", "part")
    names = [c for c in cut.columns if c not in ("part", "nth")]
    ranked = ranked.select(*names, "rank")

    def run(batches):
        import pyarrow as pa

        plan = sent.value
        for b in batches:
            length, rank = b.column(b.schema.get_field_index("length")).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            seq, offset = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    order = dict(cut.dtypes)
    kind = ", ".join(f"{n} {order[n]}" for n in names) + ", sequence_id long, offset long"
    return ranked.mapInArrow(releasing(run), kind)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences; keep_ids adds the ids themselves."""
    return pack(materialise(pieces(docs, tokenizer, capacity, keep_ids)), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and their places in sequences."""
    return pack_documents(docs, keep_ids=True)


QUERIES = {"op3_packing": op3_packing}
ORACLES: dict[str, str] = {}
