"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of five-word shingles, as 64-bit hashes. Documents with equal sets are one class from the start.
Tokens are ordered rarest first by a count sketch of fixed size over all documents (any order is valid for prefixes; a
better one makes them cheaper). A class of size n must share at least l of the first n - ceil(0.8 n) + l tokens with any
partner; each class picks its own l by estimated cost: the postings that a longer prefix reads against the candidates
that a higher l saves. A pair must share as many prefix tokens as the smaller l asks, and as many as its sizes ask.

Postings meet by block of their tokens, packed, and those of tokens that one class alone holds go no further. Sets of
the classes that are left are written once, in buckets by class, so that verification moves the sets of hubs only.

A large group of near copies shares the same tokens, and its pairs are never written out. Rounds of stars come first:
each posting list offers one hub, each class verifies against the hub it meets most often, and verified links are
contracted to components. Then only pairs of different components that share enough prefix tokens remain; all of them
are verified, so no component is missed. A hub that many ask for is copied, so they need not meet in one task, and the
postings of a token that the sketch counts very often are dealt out by task.

Sets are told apart by 64-bit hashes of their shingles and verified by the upper 48 bits of them.

Defined results: null, empty and blank texts have no shingles, link with nothing and are their own component; texts of
fewer than five words are one shingle of all their words; repeated texts are in one component; a row without an id
takes part, but can't name its component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import discard, materialise, pick, releasing, shared_dir, table, tidy
from .graph import components

WORDS = 5
#: Cells of the sketch, in chunks; the broadcast is CELLS * 4 bytes whatever the input.
CELLS, CHUNK = 1 << 21, 1 << 16
#: Every class asks for n // 16 shared prefix tokens at least, 32 at most, and may ask for up to twice as many.
LEAST_DIV, LEAST_MOST = 16, 32
STEPS = (1.0, 1.25, 1.5, 2.0)
#: Cost of verifying a candidate, in postings read.
VERIFY_COST = 30.0
STAR_ROUNDS = 3
#: Postings of a run and of a block, about; classes that a task knows as seen; postings of a token that is dealt out.
RUN_POSTINGS, BLOCK_POSTINGS, SEEN_CLASSES, HOT_POSTINGS = 1_000_000, 500_000, 300_000, 500_000
#: Bits of the broadcast bitmap at most; bytes of a token of a set and of a bucket of sets; askers of one copy of a set.
BITMAP_BITS, SET_BYTES, BUCKET_BYTES, ASKERS = 1 << 27, 6, 64 << 20, 256
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes that are hashed together. A longer word is hashed by itself.
SEGMENT = 1 << 19
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = np.random.Generator(np.random.PCG64(5)).integers(0, 2**64 - 1, 256, np.uint64)[np.frombuffer(_FOLD, np.uint8)]
_BASE = 0xC2B2AE3D27D4EB4F


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(SEGMENT, base, np.uint64)]), dtype=np.uint64)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words in bytes of several texts that begin at starts; polynomials by one running sum."""
    space = _IS_SPACE[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    starts = starts[(starts > 0) & (starts < len(data))]
    before[starts], after[starts - 1] = True, True
    np.logical_not(space, out=space)
    begin, end = np.nonzero(space & before)[0], np.nonzero(space & after)[0] + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWER[: len(data)], out=total[1:])
    size = (end - begin).astype(np.uint64)
    return scramble((total[end] - total[begin]) * _INVERSE[begin] + size * _A), begin


def _long_text(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text beyond SEGMENT bytes, cut between words."""
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        space = _IS_SPACE[data[at : at + SEGMENT + 1]]
        if space[0]:
            at += len(space) if space.all() else int(space.argmin())
            continue
        gap = np.nonzero(space)[0]
        if len(space) <= SEGMENT or len(gap):
            stop = at + (len(space) if len(space) <= SEGMENT else int(gap[-1]))
            out.append(_words(data[at:stop], np.zeros(0, np.int64))[0])
        else:
            stop = at + len(space)
            while stop < len(data) and not _IS_SPACE[data[stop]]:
                space = _IS_SPACE[data[stop : stop + SEGMENT]]
                stop += int(space.argmax()) if space.any() else len(space)
            out.append(np.array([xxhash.xxh3_64_intdigest(data[at:stop].tobytes().translate(_FOLD))], np.uint64))
        at = stop
    return np.concatenate(out)


def _groups(column):
    """(word hashes, bounds of the rows in them) for rows of about SEGMENT bytes together; column: an Arrow string array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_binary()), b"") if column.null_count else column.cast(pa.large_binary())
    offset = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2] if len(column) else None
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offset, offset[row] + SEGMENT, "right")) - 1)
        bytes_, starts = data[offset[row] : offset[stop]], offset[row : stop + 1] - offset[row]
        if len(bytes_) > SEGMENT:
            h = _long_text(bytes_)
            yield h, [0, len(h)]
        else:
            h, begin = _words(bytes_, starts)
            yield h, np.searchsorted(begin, starts).tolist()
        row = stop


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words: lower-cased (A-Z only) runs without ASCII white space."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return _long_text(data) if len(data) > SEGMENT else _words(data, np.zeros(0, np.int64))[0]


def mix(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` word hashes; order counts."""
    n = len(h) - size + 1
    x = np.zeros(n, np.uint64)
    for i in range(size):
        x = ((x * _A) ^ (x >> np.uint64(29))) + h[i : n + i] * _B
    x ^= x >> np.uint64(32)
    x *= _A
    return x ^ (x >> np.uint64(29))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_sets(column, words: int = WORDS):
    """The set of shingle hashes of each row, sorted."""
    for h, bounds in _groups(column):
        runs = mix(h, words) if len(h) >= words else None
        for lo, hi in zip(bounds, bounds[1:]):
            n = hi - lo
            if n >= words:
                yield _distinct(runs[lo : hi - words + 1])
            else:  # all words are one shingle
                yield mix(h[lo:hi], n) + np.uint64(n) if n else h[:0]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of shingle hashes of one text, sorted."""
    import pyarrow as pa

    return next(shingle_sets(pa.array([text or ""]), words))


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(tokens)) - (1 << 63)


def fifths(n):
    """ceil(0.8 n)"""
    return -(-4 * n // 5)


def least_level(n):
    """The smallest l that a class of size n may pick; it grows with n."""
    return np.minimum(LEAST_MOST, np.maximum(1, n // LEAST_DIV))


def _first_pass(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, sid) and, at the end of each task, its share of the sketch in chunks."""

    def run(batches):
        import pyarrow as pa

        cells = np.zeros(CELLS, np.int32)
        names = ["doc_id", "n", "sid", "chunk", "cells"]
        kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64()), ("chunk", pa.int32()), ("cells", pa.binary())])
        for b in batches:
            ids, sizes, held, size = [], [], [], 0
            for s in shingle_sets(b.column(1)):
                sizes.append(len(s))
                ids.append(set_id(s))
                held.append(s)
                size += len(s)
                if size > SEGMENT:
                    np.add.at(cells, (np.concatenate(held) & np.uint64(CELLS - 1)).astype(np.int64), 1)
                    held, size = [], 0
            if held:
                np.add.at(cells, (np.concatenate(held) & np.uint64(CELLS - 1)).astype(np.int64), 1)
            none = pa.nulls(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        for k in range(CELLS // CHUNK):
            part = cells[k * CHUNK : (k + 1) * CHUNK]
            if part.any():
                part = np.minimum(part, 65535).astype(np.uint16)
                yield pa.RecordBatch.from_pylist([{"chunk": k, "cells": part.tobytes()}], schema=kind)

    return docs.mapInArrow(releasing(run), "doc_id long, n long, sid long, chunk int, cells binary")


def _sketch(rows: DataFrame) -> np.ndarray:
    """Cell sums over all tasks: CELLS numbers on the driver, whatever the input."""

    def add(batches):
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1)):
                total[k] = total.get(k, 0) + np.frombuffer(c.as_py(), np.uint16).astype(np.int64)
        for k, c in total.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "cells": pa.array([np.minimum(c, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())})

    out = np.zeros(CELLS, np.int32)
    for r in rows.select("chunk", "cells").repartition(CELLS // CHUNK, "chunk").mapInArrow(releasing(add), "chunk int, cells binary").toLocalIterator():
        out[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(bytes(r.cells), np.int32)
    return out


def prefix(tokens: np.ndarray, counts: np.ndarray, noise: float) -> tuple[np.ndarray, int]:
    """The class's prefix, rarest tokens first, and its l."""
    n = len(tokens)
    most = fifths(n)
    levels = sorted({min(most, int(least_level(n) * x)) for x in STEPS})
    # Rarest first; counts below the sketch's noise are alike, so the hash decides there. Tokens come sorted.
    key = np.maximum(counts - noise, 0).astype(np.int64)
    order = np.argsort(key, kind="stable")[: n - most + levels[-1]]
    reads = np.cumsum(key[order] + 1.0)
    cost = [reads[n - most + l - 1] * (1 + VERIFY_COST / l) for l in levels]
    level = levels[int(np.argmin(cost))]
    return tokens[order[: n - most + level]], level


def block_bits(tokens: int) -> int:
    """Bits of a token that name its block: blocks hold about BLOCK_POSTINGS of the prefixes of so many tokens."""
    return min(18, max(4, int(np.ceil(np.log2(max(tokens * 0.3 / BLOCK_POSTINGS, 1))))))


def to_planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of unsigned numbers, all lowest ones first: they compress better than whole numbers."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _postings(docs: DataFrame, sketch: np.ndarray, bits: int) -> DataFrame:
    """Runs of postings by block of their tokens: 40 more bits of each token, its class, l and how many prefix tokens
    of the class lie behind it (255: or more). A task repeats no class.

    A token that is in HOT_POSTINGS places or more by the sketch is shared for certain. Its runs need no block to meet
    in, so they are dealt out by task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(sketch)
    noise = float(np.median(sketch))

    def run(batches):
        from pyspark import TaskContext
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        cells, seen = sent.value, set()
        kind = pa.schema([("block", pa.int32()), ("home", pa.int32()), ("hot", pa.bool_()), ("token", pa.binary()), ("sid", pa.binary()), ("l", pa.binary()), ("behind", pa.binary())])

        def answer(out):
            token = np.concatenate([o[0] for o in out]) >> np.uint64(24 - bits)
            sizes = [len(o[0]) for o in out]
            sid = np.repeat(np.array([o[1] for o in out], np.int64), sizes)
            level = np.repeat(np.array([o[2] for o in out], np.uint8), sizes)
            behind = np.concatenate([np.minimum(np.arange(n - 1, -1, -1), 255).astype(np.uint8) for n in sizes])
            hot = np.concatenate([o[3] for o in out])
            rows = []
            for is_hot in (False, True):
                at = np.nonzero(hot == is_hot)[0]
                at = at[np.argsort(token[at], kind="stable")]
                home = (token[at] >> np.uint64(40)).astype(np.int64)
                edge = np.searchsorted(home, np.arange((1 << bits) + 1)).tolist() if len(at) else []
                for k, (lo, hi) in enumerate(zip(edge, edge[1:])):
                    if lo < hi:
                        some = at[lo:hi]
                        block = (k + part) % (1 << bits) if is_hot else k
                        rows.append({"block": block, "home": k, "hot": is_hot, "token": to_planes(token[some], 5), "sid": sid[some].tobytes(), "l": level[some].tobytes(), "behind": behind[some].tobytes()})
            return pa.RecordBatch.from_pylist(rows, schema=kind)

        out, size = [], 0
        for b in batches:
            for s in shingle_sets(b.column(1)):
                sid = set_id(s)
                if len(s) < 4 or sid in seen:  # smaller sets link with equal ones only
                    continue
                if len(seen) < SEEN_CLASSES:
                    seen.add(sid)
                count = cells[(s & np.uint64(CELLS - 1)).astype(np.int64)]
                p, l = prefix(s, count, noise)
                often = cells[(p & np.uint64(CELLS - 1)).astype(np.int64)] - noise >= HOT_POSTINGS
                out.append((p, sid, l, often))
                size += len(p)
                if size > RUN_POSTINGS:
                    yield answer(out)
                    out, size = [], 0
        if out:
            yield answer(out)

    return docs.mapInArrow(releasing(run), "block int, home int, hot boolean, token binary, sid binary, l binary, behind binary")


def _several(runs: DataFrame, bits: int) -> DataFrame:
    """(token, sid, l, behind) of the tokens that two classes hold at least; a block is looked at by one task at a time."""

    def run(batches):
        import pyarrow as pa

        current, own = None, []
        names = ["token", "sid", "l", "behind"]

        def answer(cols):
            for at in range(0, len(cols[0]), 500_000):
                token, sid, l, behind = (c[at : at + 500_000] for c in cols)
                yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(sid), pa.array(l.astype(np.int16)), pa.array(behind.astype(np.int16))], names=names)

        def close():
            cols = [np.concatenate(c) for c in zip(*own)]
            order = np.lexsort((cols[1], cols[0]))
            token, sid = cols[0][order], cols[1][order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
            order = order[new]
            token = token[new]
            first = np.nonzero(np.concatenate([[True], token[1:] != token[:-1]]))[0]
            size = np.diff(np.append(first, len(token)))
            yield from answer([c[order[np.repeat(size > 1, size)]] for c in cols])

        for b in batches:
            for block, home, hot, token, *rest in zip(*[b.column(i).to_pylist() for i in range(3)], *[b.column(i) for i in range(3, 7)]):
                sid, l, behind = (np.frombuffer(c.as_py(), k) for c, k in zip(rest, (np.int64, np.uint8, np.uint8)))
                cols = [from_planes(token.as_py(), 5) + np.uint64(home << 40), sid, l, behind]
                if hot:
                    yield from answer(cols)
                    continue
                if block != current and own:
                    yield from close()
                    own = []
                current = block
                own.append(cols)
        if own:
            yield from close()

    parts = max(_tasks(runs.sparkSession), (1 << bits) // 8)
    return runs.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(releasing(run), "token long, sid long, l short, behind short")


def _tasks(spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _mark(ids) -> np.ndarray:
    """Places in a bitmap before it is folded to its size; a missing id has a place too."""
    return scramble(np.array([-1 if i is None else i for i in ids], np.int64).view(np.uint64))


def _bitmap(ids: DataFrame, n: int) -> np.ndarray:
    """A bitmap of n ids, 16 bits for each up to BITMAP_BITS in all: beyond that it lets more of the others pass."""
    bits = 1 << 16
    while bits < min(16 * n, BITMAP_BITS):
        bits *= 2
    chunk = min(bits, 1 << 20)

    def place(batches):
        import pyarrow as pa

        for b in batches:
            at = _mark(b.column(0).to_pylist()) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array((at // np.uint64(chunk)).astype(np.int32)), pa.array((at % np.uint64(chunk)).astype(np.int32))], names=["chunk", "at"])

    def fill(batches):
        import pyarrow as pa

        out: dict[int, np.ndarray] = {}
        for b in batches:
            k, at = b.column(0).to_numpy(), b.column(1).to_numpy()
            for c in np.unique(k).tolist():
                out.setdefault(c, np.zeros(chunk, bool))[at[k == c]] = True
        for c, x in out.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "bits": pa.array([np.packbits(x).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    rows = ids.mapInArrow(releasing(place), "chunk int, at int").repartition(min(bits // chunk, 64), "chunk").mapInArrow(releasing(fill), "chunk int, bits binary")
    for r in rows.toLocalIterator():
        out[r.chunk * chunk // 8 : (r.chunk + 1) * chunk // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


class Sets:
    """The token sets of some classes, as a table in buckets by class, so that looking them up moves no set.

    wanted: (sid, doc_id), a document of each class. A bitmap of bounded size passes over most other documents before
    their texts are read; an exact join leaves out the rest.
    """

    def __init__(self, docs: DataFrame, wanted: DataFrame):
        spark = docs.sparkSession
        size = wanted.agg(F.count("*").alias("n"), F.sum("n").alias("tokens")).first()
        sent = spark.sparkContext.broadcast(_bitmap(wanted.select("doc_id"), size.n))
        self.spark, self.name, self.path = spark, f"siltstone_sets_{uuid.uuid4().hex}", shared_dir(spark)
        self.buckets = max(_tasks(spark), -(-SET_BYTES * (size.tokens or 0) // BUCKET_BYTES))

        def run(batches):
            import pyarrow as pa

            bits = sent.value
            for b in batches:
                at = _mark(b.column(0).to_pylist()) & np.uint64(8 * len(bits) - 1)
                hit = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
                out = list(shingle_sets(b.column(1).filter(pa.array(hit == 1))))
                yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in out], pa.int64()), pa.array([len(s) for s in out], pa.int32()), pa.array([to_planes(s >> np.uint64(16), 6) for s in out], pa.binary())], names=["sid", "size", "tokens"])

        found = docs.mapInArrow(releasing(run), "sid long, size int, tokens binary").repartition(self.buckets, "sid")
        exact = found.join(wanted.select("sid").hint("shuffle_hash"), "sid", "left_semi").dropDuplicates(["sid"])
        with tidy(spark):
            exact.write.bucketBy(self.buckets, "sid").option("path", self.path).saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        gone = self.spark.range(0)
        gone._stored = self.path
        discard(gone)

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets have a Jaccard similarity of 0.8 or more. listed: how many classes may ask for b.

        The set of b goes to those who ask for it; of one that many may ask for there are several copies, each for some.
        """

        def run(batches):
            import pyarrow as pa

            for b in batches:
                keep = []
                for n, m, x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4), b.column(5)):
                    both = len(np.intersect1d(from_planes(x.as_py(), 6), from_planes(y.as_py(), 6), assume_unique=True))
                    keep.append(100 * both >= 80 * (n + m - both))
                yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

        pairs = pairs.select("a", "b", F.ceil(F.col("listed") / ASKERS).cast("int").alias("copies"))
        pairs = materialise(pairs.withColumn("copy", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int")))
        asked = pairs.groupBy("b").agg(F.max("copies").alias("copies"))
        sent = asked.join(self.table().select(F.col("sid").alias("b"), F.col("size").alias("m"), F.col("tokens").alias("y")), "b")
        sent = sent.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
        mine = pairs.select("a", "b", "copy").join(sent.hint("merge"), ["b", "copy"])
        own = self.table().select(F.col("sid").alias("a"), F.col("size").alias("n"), F.col("tokens").alias("x"))
        both = mine.join(own.hint("merge"), "a").select("a", "b", "n", "m", "x", "y")
        out = materialise(both.mapInArrow(releasing(run), "a long, b long"))
        discard(pairs)
        return out


def _needed(n1, l1, n2, l2):
    """Shared prefix tokens that two linked classes must have; ceil(4 (n1 + n2) / 9) is their least intersection."""
    least = F.floor((4 * (n1 + n2) + 8) / 9)
    beyond = F.greatest(F.floor((4 * n1 + 4) / 5) - l1, F.floor((4 * n2 + 4) / 5) - l2)
    return F.greatest(F.least(l1, l2), least - beyond)


def _sizes_fit(n1, n2):
    return (5 * F.least(n1, n2)) >= (4 * F.greatest(n1, n2))


def _early(behind, need):
    """Of need shared tokens one has need - 1 more behind it, in both classes."""
    return behind >= F.least(need, F.lit(256)) - 1


def link_classes(docs: DataFrame, classes: DataFrame, sketch: np.ndarray, star_rounds: int = STAR_ROUNDS) -> DataFrame | None:
    """(sid, comp) of all classes that link with another one; classes: (sid, n, doc_id), written, one row a class."""
    bits = block_bits(classes.agg(F.sum("n")).first()[0] or 0)
    met = materialise(_several(_postings(docs, sketch, bits), bits))
    # A class must share as many tokens as the smallest partner it could have would ask for.
    smallest = F.floor((4 * F.col("n") + 4) / 5)
    asked = F.least(F.lit(LEAST_MOST), F.greatest(F.lit(1), F.floor(smallest / LEAST_DIV)))
    live = met.groupBy("sid").agg(F.count("*").alias("m")).join(classes.hint("merge"), "sid").where(F.col("m") >= asked)
    live = materialise(live.select("sid", "m", F.col("n").cast("int").alias("n"), "doc_id", asked.cast("int").alias("asked")))
    # Two classes that share `need` prefix tokens meet at a place with need - 1 more behind it, in both.
    shared = met.join(live.drop("doc_id").hint("merge"), "sid").select("token", "sid", "n", "l", "m", "behind", _early(F.col("behind"), F.col("asked")).alias("early"))
    shared = materialise(shared)
    discard(met)
    sets = Sets(docs, live.select("sid", "doc_id", "n"))
    links, labels = None, None

    def labelled() -> DataFrame:
        early = shared.where("early")
        if labels is None:
            return early.withColumn("comp", F.col("sid"))
        return early.join(labels, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))

    def add(found: DataFrame) -> int:
        nonlocal links, labels
        n = found.count()
        if n:
            # Stars of what was known stand for its links.
            links = found if labels is None else found.unionByName(labels.where("sid <> comp").select(F.col("sid").alias("a"), F.col("comp").alias("b")))
            before, labels = labels, materialise(components(links).select(F.col("node").alias("sid"), "comp"))
            discard(before)
        discard(found)
        return n

    for r in range(star_rounds):
        rows = labelled()
        rows = rows.where(_early(F.col("behind"), _needed(F.col("n"), F.col("l"), F.col("n"), F.col("l"))))
        # The first hub of a list is the class with the most shared tokens, later ones are drawn by hash.
        rank = (F.col("m") / F.col("n")) if r == 0 else F.xxhash64(F.col("sid"), F.lit(r)).cast("double")
        hub = F.max_by(F.struct("sid", "n", "l", "m", "comp"), F.struct(rank, F.col("sid"))).alias("h")
        lists = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub, F.count("*").alias("listed"))
        meets = rows.join(lists.where("lo <> hi").select("token", "h", "listed"), "token").where((F.col("comp") != F.col("h.comp")) & _sizes_fit(F.col("n"), F.col("h.n")))
        need = _needed(F.col("n"), F.col("l"), F.col("h.n"), F.col("h.l"))
        meets = meets.where((F.col("m") >= need) & (F.col("h.m") >= need))
        votes = meets.groupBy("sid", F.col("h.sid").alias("hub")).agg(F.count("*").alias("c"), F.max("listed").alias("listed"))
        best = votes.groupBy("sid").agg(F.max_by(F.struct("hub", "listed"), F.struct("c", "hub")).alias("best"))
        if not add(sets.verify(best.select(F.col("sid").alias("a"), F.col("best.hub").alias("b"), F.col("best.listed").alias("listed")))):
            break
    rows = labelled()
    open_ = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    left = materialise(rows.join(open_.select("token"), "token"))
    a, b = left.alias("a"), left.alias("b")
    col = lambda t, c: F.col(f"{t}.{c}")
    need = _needed(col("a", "n"), col("a", "l"), col("b", "n"), col("b", "l"))
    meet = (
        (col("a", "token") == col("b", "token"))
        & (col("a", "sid") < col("b", "sid"))
        & (col("a", "comp") != col("b", "comp"))
        & _sizes_fit(col("a", "n"), col("b", "n"))
        & (col("a", "m") >= need)
        & (col("b", "m") >= need)
        & _early(col("a", "behind"), need)
        & _early(col("b", "behind"), need)
    )
    pairs = materialise(a.join(b, meet).select(col("a", "sid").alias("a"), col("b", "sid").alias("b"), need.alias("need")).distinct())
    # Enough shared prefix tokens, before any whole set is read.
    some = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    tokens = materialise(shared.join(some, "sid", "left_semi").groupBy("sid").agg(F.collect_list("token").alias("tokens")))
    close = pairs.join(tokens.select(F.col("sid").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("sid").alias("b"), F.col("tokens").alias("y")), "b")
    close = materialise(close.where(F.size(F.array_intersect("x", "y")) >= F.col("need")).select("a", "b"))
    # The set of the class with more partners goes to the others, in copies.
    partners = materialise(close.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("d")))
    mine, other = (partners.select(F.col("sid").alias(c), F.col("d").alias(f"d{c}")) for c in "ab")
    swap = F.col("da") > F.col("db")
    told = close.join(mine, "a").join(other, "b")
    add(sets.verify(told.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"), F.greatest("da", "db").alias("listed"))))
    sets.drop()
    discard(left, pairs, tokens, close, partners, shared, live)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    docs = pick(docs, {"doc_id": "long", "text": "string"})
    first = materialise(_first_pass(docs))
    base = first.where("chunk is null").select("doc_id", "n", "sid")
    sketch = _sketch(first.where("chunk is not null"))
    # One row a class: partial minima come first, so many copies of one text are no hot task.
    classes = materialise(base.where("n > 0").groupBy("sid").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id")))
    labels = link_classes(docs, classes.where("n > 3"), sketch)
    least = classes.select("sid", F.col("doc_id").alias("least"))
    if labels is not None:
        linked = least.join(labels, "sid")
        top = linked.groupBy("comp").agg(F.min("least").alias("top"))
        by_class = least.join(linked.join(top, "comp").select("sid", "top"), "sid", "left").select("sid", F.coalesce("top", "least").alias("component_id"))
        by_class = materialise(by_class)
        discard(labels, classes)
    else:
        by_class = least.withColumnRenamed("least", "component_id")
    out = base.join(by_class, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, stable: bool = False) -> DataFrame:
    """One row of each component, one with the smallest id (without one only if no row has an id); rows without words stay.

    Rows are told apart by their number, not by their id. stable: docs has the same rows in the same partitions whenever
    it is computed, as a plain Parquet scan does; otherwise it is written first.
    """
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    if not stable:
        flat = materialise(flat)
    numbered = pick(flat.toDF(*names), {"doc_id": "long", "text": "string"}).withColumn("_row", F.monotonically_increasing_id())
    found = near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "text"))
    ids = numbered.select("_row", F.col("doc_id").alias("_id"))
    member = found.select(F.col("doc_id").alias("_row"), "component_id").join(ids, "_row")
    least = F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))).alias("least")
    rows = member.groupBy("component_id").agg(least).select(F.col("least._row").alias("_row"))
    return flat.withColumn("_row", F.monotonically_increasing_id()).join(rows, "_row", "left_semi").drop("_row").toDF(*names)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, stable=True)


QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES = {
    "op5_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), tokens AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[k : k + least(5, len(w)) - 1], ' ')) AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m.c, w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) m USING (doc_id)
"""
}
