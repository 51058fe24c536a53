"""Benchmark decontamination with suffix arrays over the training texts.

The words of a bounded run of documents make a shard; its suffix array is sorted by prefix doubling over word ids.
Every suffix of the benchmark texts is binary-searched in the shard, word by word, for all suffixes at once: the
interval at the window length gives all verbatim occurrences, and widening it gives the longest match and a place.
The benchmark goes out in blocks of a bounded number of words, so it may grow; hits of several blocks are merged by
document.

Exact shortcuts: a word that no benchmark text has matches nothing, so it ends every match; a training suffix that
has such a word before the shortest window's end cannot match and is left out of the array.

Defined results: null and empty texts have no words, hits or items; items of fewer than WINDOW words are one window,
items without words have none; an item whose id is null makes hits but is not listed; repeated items count once;
repeated documents and ids are answered row by row; an empty benchmark marks nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialise, pick, releasing, table

WINDOW = 13
#: Benchmark words in one block: the broadcast's bound.
BLOCK_WORDS = 2_000_000
#: Words in a shard; a longer document is a shard of its own.
SHARD_WORDS = 400_000
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_FOLD = bytes(ord(chr(i).lower()) if i < 128 and chr(i).lower().encode()[0] in _KEEP else i if i in _KEEP else 32 for i in range(256))


def _split(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and all non-ASCII characters."""
    folded = (text or "").encode("utf-8", "replace").translate(_FOLD)
    return folded.split()


class Tests:
    """A block of benchmark texts: words as ids from 1, all suffixes, and the windows."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        items = [(i, w) for i, w in items if w]
        self.ids = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        stream: list[int] = []
        start, need, item, names = [], [], [], []
        for name, ws in items:
            at = len(stream)
            stream += [self.ids[w] for w in ws]
            stream.append(0)
            size = min(window, len(ws))
            for k in range(len(ws)):
                start.append(at + k)
                need.append(size)
                item.append(len(names))
            names.append(name)
        self.least = int(min(need, default=window))
        self.stream = np.array(stream + [0] * (max(need, default=1) + 1), dtype=np.int64)
        self.start, self.need, self.item, self.names = np.array(start, np.int64), np.array(need, np.int64), np.array(item, np.int64), names


def suffix_array(ids: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """positions sorted by the words from there on, to depth words at least; id 0 ends a suffix."""
    n = len(ids)
    if not len(positions):
        return positions
    bits = max(1, int(ids.max()).bit_length())
    pack = max(1, 62 // bits)
    padded = np.concatenate([ids, np.zeros(depth + pack + 1, np.int64)])
    key = np.zeros(len(positions), np.int64)
    alive = np.ones(len(positions), bool)
    for k in range(pack):
        w = np.where(alive, padded[positions + k], 0)
        key = (key << bits) | w
        alive &= w > 0
    order = np.argsort(key, kind="stable")
    done = pack
    rank = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]).astype(np.int64))
    while done < depth and rank[-1] < len(positions):
        # Ranks of all suffixes by place; where none starts, what follows can't be told apart by rank, so read words.
        low = np.cumsum(np.concatenate([[0], rank[1:] != rank[:-1]]))
        tied = np.bincount(low)[low] > 1
        at = np.nonzero(tied)[0]
        own = order[at]
        key = np.zeros(len(at), np.int64)
        alive = padded[positions[own] + done - 1] > 0
        for k in range(pack):
            w = np.where(alive, padded[np.minimum(positions[own] + done + k, len(padded) - 1)], 0)
            key = (key << bits) | w
            alive &= w > 0
        by = np.lexsort((key, rank[at]))
        order[at] = own[by]
        key, group = key[by], rank[at][by]
        new = np.concatenate([[True], rank[1:] != rank[:-1]])
        new[at[1:]] |= (group[1:] == group[:-1]) & (key[1:] != key[:-1]) & (at[1:] == at[:-1] + 1)
        rank = np.cumsum(new)
        done += pack
    return positions[order]


def _bound(column_of, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of many values at once, each in its own interval of the suffix array."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.nonzero(lo < hi)[0]
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        got = column_of(mid)
        go = got <= value[open_] if right else got < value[open_]
        lo[open_[go]] = mid[go] + 1
        hi[open_[~go]] = mid[~go]


def search(tests: Tests, ids: np.ndarray, depth_limit: int = 1 << 30):
    """For each test suffix: interval of full-window occurrences, longest match and a place of it; and the array."""
    n = len(ids)
    padded = np.concatenate([ids, np.zeros(len(tests.stream) + 2, np.int64)])
    gap = np.concatenate([[0], np.cumsum(ids == 0)])
    end = np.minimum(np.arange(n) + tests.least, n)
    fits = (np.arange(n) + tests.least <= n) & (gap[end] == gap[:n]) if n else np.zeros(0, bool)
    longest_item = int(np.max(np.diff(np.concatenate([[-1], np.nonzero(tests.stream == 0)[0]])), initial=1))
    sa = suffix_array(ids, np.nonzero(fits)[0].astype(np.int64), min(longest_item, depth_limit))
    m = len(tests.start)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(sa), np.int64)
    first, last = np.zeros(m, np.int64), np.zeros(m, np.int64)
    length, place = np.zeros(m, np.int64), np.full(m, -1, np.int64)
    live = np.arange(m) if len(sa) else np.zeros(0, np.int64)
    k = 0
    while len(live):
        word = tests.stream[tests.start[live] + k]
        keep = word > 0
        live, word = live[keep], word[keep]
        if not len(live):
            break
        column = lambda mid: padded[sa[mid] + k]
        a = _bound(column, lo[live], hi[live], word, False)
        b = _bound(column, a, hi[live], word, True)
        keep = a < b
        live, a, b = live[keep], a[keep], b[keep]
        lo[live], hi[live] = a, b
        k += 1
        length[live], place[live] = k, sa[a] if len(a) else 0
        full = tests.need[live] == k
        first[live[full]], last[live[full]] = a[full], b[full]
    return sa, first, last, length, place


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the intervals, repeated, and all numbers in them."""
    size = last - first
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def shard_hits(tests: Tests, docs: list[list[bytes]]):
    """Per document: hit words as merged [start, end) runs, items with occurrences, longest match (words, start, item)."""
    flat: list[int] = []
    offset = [0]
    get = tests.ids.get
    for ws in docs:
        flat.extend([get(w, 0) for w in ws])
        flat.append(0)
        offset.append(len(flat))
    ids, bounds = np.array(flat, np.int64), np.array(offset, np.int64)
    out = [([], set(), (0, -1, -1)) for _ in docs]
    sa, first, last, length, place = search(tests, ids)
    found = np.nonzero(last > first)[0]
    if not len(found):
        return out
    which, at = _spread(first[found], last[found])
    where, need, item = sa[at], tests.need[found][which], tests.item[found][which]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + need, -1)
    hit = np.cumsum(edge)[:-1] > 0
    step = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    starts, ends = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
    doc = np.searchsorted(bounds, starts, "right") - 1
    for d, s, e in zip(doc.tolist(), starts.tolist(), ends.tolist()):
        out[d][0].append((s - offset[d], e - offset[d]))
    pair = np.unique(np.stack([np.searchsorted(bounds, where, "right") - 1, item]), axis=1)
    for d, i in pair.T.tolist():
        out[d][1].add(i)
    for f in found.tolist():
        d = int(np.searchsorted(bounds, place[f], "right")) - 1
        if length[f] > out[d][2][0]:
            out[d] = (*out[d][:2], (int(length[f]), int(place[f]) - offset[d], int(tests.item[f])))
    return out


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_KIND = "doc_id long, n_words long, runs array<struct<start:long,end:long>>, items array<long>, longest long, longest_start long, longest_item long"


def _matches_of_block(docs: DataFrame, tests: Tests) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tests)

    def run(batches):
        import pyarrow as pa

        kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64())), ("longest", pa.int64()), ("longest_start", pa.int64()), ("longest_item", pa.int64())])
        own = sent.value

        def answer(keys, shard):
            rows = []
            for key, ws, (runs, items, (size, at, item)) in zip(keys, shard, shard_hits(own, shard)):
                names = sorted({own.names[i] for i in items} - {None})
                rows.append({"doc_id": key, "n_words": len(ws), "runs": [{"start": s, "end": e} for s, e in runs], "items": names, "longest": size, "longest_start": at if size else None, "longest_item": own.names[item] if size else None})
            return pa.RecordBatch.from_pylist(rows, schema=kind)

        for b in batches:
            keys, shard, size = [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ws = _split(text.as_py())
                if shard and size + len(ws) > SHARD_WORDS:
                    yield answer(keys, shard)
                    keys, shard, size = [], [], 0
                keys.append(key)
                shard.append(ws)
                size += len(ws)
            if shard:
                yield answer(keys, shard)

    return docs.mapInArrow(releasing(run), _KIND)


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark on the driver, a bounded number of words at a time."""
    block, size = [], 0
    for r in pick(benchmark, {"item_id": "long", "text": "string"}).toLocalIterator():
        ws = _split(r.text)
        if block and size + len(ws) > block_words:
            yield Tests(block)
            block, size = [], 0
        block.append((r.item_id, ws))
        size += len(ws)
    yield Tests(block)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, rows: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, runs of hit words, items that occur, the longest verbatim match.

    With rows also _row, the document's monotonically_increasing_id() in docs.
    """
    flat = pick(docs, {"doc_id": "long", "text": "string"})
    blocks = blocks_of(benchmark, block_words)
    one = next(blocks)
    more = next(blocks, None)
    if more is None:
        found = _matches_of_block(flat, one)
        return found.withColumn("_row", F.monotonically_increasing_id()) if rows else found
    # Several blocks: every pass numbers the same rows alike (docs must be stable then), and answers merge by row.
    parts = [_matches_of_block(flat, one).withColumn("_row", F.monotonically_increasing_id())]
    while more is not None:
        parts.append(_matches_of_block(flat, more).withColumn("_row", F.monotonically_increasing_id()))
        more = next(blocks, None)
    union = materialise(parts[0])
    for p in parts[1:]:
        union = union.unionByName(materialise(p))
    best = F.max(F.struct("longest", "longest_start", "longest_item")).alias("best")
    runs = F.array_sort(F.flatten(F.collect_list("runs")))
    joined = F.aggregate(
        runs,
        F.expr("cast(array() as array<struct<start:long,end:long>>)"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    out = union.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), joined.alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best
    )
    return out.select("doc_id", "n_words", "runs", "items", "best.*", *["_row"] * rows)


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontamination_report(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, rows: bool = False) -> DataFrame:
    """n_words, n_hit, items and the decision for each document."""
    m = benchmark_matches(docs, benchmark, block_words, rows)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return m.select("*", n_hit.alias("n_hit")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "longest",
        "longest_start",
        "longest_item",
        *["_row"] * rows,
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.drop("longest", "longest_start", "longest_item")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, stable: bool = False) -> DataFrame:
    """Documents below the contamination rule; each row is judged by its own text.

    stable: docs has the same rows in the same partitions whenever it is computed, as a plain Parquet scan does; otherwise
    several blocks of the benchmark need it written first.
    """
    names = docs.columns
    lower = [n.lower() for n in names]
    at = names.index("text") if "text" in names else lower.index("text")
    blocks = blocks_of(benchmark, block_words)
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    for tests in blocks:  # a block adds hits only, so several blocks need the merged report
        more = next(blocks, None)
        if more is not None:
            if not stable:
                flat = materialise(flat)
            bad = decontamination_report(flat.toDF(*names), benchmark, block_words, rows=True).where("contaminated").select("_row")
            return flat.withColumn("_row", F.monotonically_increasing_id()).join(bad, "_row", "left_anti").drop("_row").toDF(*names)
        sent = docs.sparkSession.sparkContext.broadcast(tests)

        def run(batches):
            import pyarrow as pa

            own = sent.value
            for b in batches:
                keep, shard, size = [], [], 0

                def judge(shard):
                    for ws, (runs, _, _) in zip(shard, shard_hits(own, shard)):
                        hit = sum(e - s for s, e in runs)
                        keep.append(not (hit > 0 and 20 * hit >= len(ws)))

                for text in b.column(at):
                    ws = _split(text.as_py())
                    if shard and size + len(ws) > SHARD_WORDS:
                        judge(shard)
                        shard, size = [], 0
                    shard.append(ws)
                    size += len(ws)
                if shard:
                    judge(shard)
                yield b.filter(pa.array(keep, pa.bool_()))

        return flat.mapInArrow(releasing(run), flat.schema).toDF(*names)
    return docs


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"), stable=True)


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = WINDOW) -> dict:
    """The contract, word by word; for tests."""
    out = {}
    for key, text in docs:
        ws = _split(text)
        hit, names = set(), set()
        for name, t in items:
            iw = _split(t)
            size = min(window, len(iw))
            wins = {tuple(iw[k : k + size]) for k in range(len(iw) - size + 1)} if size else set()
            for k in range(len(ws) - size + 1):
                if size and tuple(ws[k : k + size]) in wins:
                    hit.update(range(k, k + size))
                    if name is not None:
                        names.add(name)
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        out[key] = (len(ws), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(ws))
    return out


QUERIES = {"op7_decontamination": op7_decontamination}
ORACLES = {
    "op7_decontamination": r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
  FROM documents
), iw AS (
  SELECT item_id, w, least(13, len(w)) AS size FROM (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
    FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM iw)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS t
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM dw, sizes WHERE len(w) >= size)
), found AS (SELECT r, k, p.size, item_id FROM places p JOIN windows i ON p.t = i.t AND p.size = i.size
), hits AS (SELECT r, count(DISTINCT h) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS h FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
}
