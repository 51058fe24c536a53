"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Every whole text gives a short vector of statistics. cos(Wx + b) with Gaussian W approximates a Gaussian kernel over
them. Partitions sum their normal equations, two levels of sums leave a bounded number of small matrices for the
driver, which solves the ridge system; a quarter of the training rows is kept aside for isotonic calibration.

Defined results: null and empty texts have zero statistics and get a score like any other text; rows without an id
count as not held out and have no label; labels with a null quality are ignored, of repeated labels of one id the
largest counts, repeated documents are scored alike; without any training label the score is 0.5.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import crc32_text, materialise, pick, releasing, table

#: Random features; a partition sums FEATURES x FEATURES doubles.
FEATURES = 192
GAMMA = 0.12
RIDGE = 1e-3
#: Bins of the raw score for calibration, so what the driver gathers doesn't grow with the rows.
BINS = 2048
SUMS = 16
STATS = 25
_ALPHA = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SPACE = b" \t\n\v\f\r"
_MARKS = b"%*#$&@^~=+<>{}[]\\/_|"
_NON = {name: bytes(sorted(set(range(256)) - set(keep))) for name, keep in (("alpha", _ALPHA), ("upper", _UPPER), ("digit", _DIGIT), ("marks", _MARKS))}


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text; all of them bounded or logarithmic."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, chars = len(words), len(raw)
    if not n:
        return [0.0] * STATS
    kept = {k: chars - len(raw.translate(None, keep)) for k, keep in (("alpha", _ALPHA), ("upper", _UPPER), ("digit", _DIGIT), ("marks", _MARKS))}
    lens = np.fromiter(map(len, words), np.int64, n)
    unique = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    unique_lines = set(lines)
    pairs = set(zip(words, words[1:]))
    same = sum(a == b for a, b in zip(words, words[1:]))
    stops = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    top = max(counts.values())
    free = n ** 0.5
    return [
        np.log1p(n) / 10,
        np.log1p(len(lines)) / 8,
        min(lens.mean() / 10, 3.0),
        min(lens.std() / 10, 3.0),
        min(np.log1p(lens.max()) / 5, 3.0),
        len(unique) / n,
        len(unique) / (free * 30),
        len(pairs) / max(1, n - 1),
        same / max(1, n - 1),
        top / n,
        len(unique_lines) / max(1, len(lines)),
        kept["alpha"] / chars,
        kept["upper"] / chars * 3,
        kept["digit"] / chars * 3,
        kept["marks"] / chars * 5,
        raw.count(b"!") / n,
        raw.count(b"|") / n * 2,
        raw.count(b"?") / n,
        stops / n * 5,
        raw.count(b",") / n * 5,
        raw.count(b"http") / n * 10,
        float((lens == 1).mean()),
        float((lens > 15).mean()) * 3,
        min(np.log1p(n / max(1, len(lines))) / 5, 3.0),
        sum(1 for w in words if w.isupper() and len(w) > 1) / n,
    ]


def fourier(x: np.ndarray, seed: int = 5, features: int = FEATURES, gamma: float = GAMMA) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, with the plain statistics and a constant beside them."""
    rng = np.random.Generator(np.random.PCG64(seed))
    plain = x.shape[1] + 1
    w = rng.normal(0, 1 / gamma**0.5 / 2, (x.shape[1], features - plain))
    b = rng.uniform(0, 2 * np.pi, features - plain)
    return np.hstack([np.cos(x @ w + b) * (2 / (features - plain)) ** 0.5, x, np.ones((len(x), 1))])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of double) for every document."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, texts = b.column(0), b.column(1)
            stats = [statistics(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(releasing(run), "doc_id long, stats array<double>")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), STATS)


def pool(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted isotonic regression by pooling adjacent violators."""
    out: list[list[float]] = []
    for v, w in zip(values, weights):
        out.append([v, w, 1])
        while len(out) > 1 and out[-2][0] >= out[-1][0]:
            b, a = out.pop(), out.pop()
            out.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in out]) if out else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", held_out_mod: int = 5):
    """(weights, bin edges, calibrated values) from all labelled rows whose crc32(doc_id) mod 5 is not 0."""
    known = (
        pick(labels, {"doc_id": "long", label: "int"})
        .where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(crc32_text(F.col("doc_id")) % held_out_mod != 0)
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
    )
    fold = (F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string")).cast("binary")) % 4 == 0).alias("calibrate")
    rows = materialise(stats.join(known, "doc_id").select("stats", F.col("y").cast("double"), fold))

    def sums(batches):
        import pyarrow as pa

        a, v, n = np.zeros((FEATURES, FEATURES)), np.zeros(FEATURES), 0
        for b in batches:
            z, y = fourier(_matrix(b.column(0))), b.column(1).to_numpy()
            a += z.T @ z
            v += z.T @ y
            n += len(y)
        if n:
            yield pa.RecordBatch.from_pydict({"m": pa.array([np.vstack([a, v]).tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})

    def add(batches):
        import pyarrow as pa

        total, n = None, 0
        for b in batches:
            for m, c in zip(b.column(0), b.column(1)):
                x = np.frombuffer(m.as_py())
                total, n = (x if total is None else total + x), n + c.as_py()
        if n:
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})

    kind = "m binary, n long"
    part = rows.where(~F.col("calibrate")).select("stats", "y").mapInArrow(releasing(sums), kind)
    got = part.repartition(SUMS).mapInArrow(releasing(add), kind).collect()
    if not got:
        return None
    total = sum(np.frombuffer(bytes(r.m)) for r in got).reshape(FEATURES + 1, FEATURES)
    n = sum(r.n for r in got)
    weights = np.linalg.solve(total[:-1] + RIDGE * n * np.diag([1.0] * (FEATURES - 1) + [1e-6]), total[-1])

    def bins(batches):
        import pyarrow as pa

        acc = np.zeros((2, BINS))
        for b in batches:
            s = fourier(_matrix(b.column(0))) @ weights
            at = np.clip(((s + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            np.add.at(acc[0], at, 1)
            np.add.at(acc[1], at, b.column(1).to_numpy())
        at = np.nonzero(acc[0])[0]
        yield pa.RecordBatch.from_pydict({"bin": pa.array(at.astype(np.int32)), "w": pa.array(acc[0][at]), "y": pa.array(acc[1][at])})

    rows2 = rows.where(F.col("calibrate")).select("stats", "y").mapInArrow(releasing(bins), "bin int, w double, y double")
    hist = sorted(rows2.groupBy("bin").agg(F.sum("w").alias("w"), F.sum("y").alias("y")).collect())
    if not hist:
        return weights, np.array([-1.0, 2.0]), np.array([0.0, 1.0])
    centre = (np.array([r.bin for r in hist]) + 0.5) / BINS * 2 - 0.5
    w = np.array([r.w for r in hist])
    value = pool(np.array([r.y for r in hist]) / w, w)
    return weights, centre, value


def scores(stats: np.ndarray, model) -> np.ndarray:
    """Scores in 0 to 1; a slight slope keeps ties of the isotonic steps in the order of the raw scores."""
    if model is None:
        return np.full(len(stats), 0.5)
    weights, centre, value = model
    raw = fourier(stats) @ weights if len(stats) else np.zeros(0)
    return np.interp(raw, centre, value) * 0.999 + 0.001 * np.clip((raw + 0.5) / 2, 0, 1)


def score(stats: DataFrame, model) -> DataFrame:
    """doc_id, score."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            s = scores(_matrix(b.column(1)), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return stats.mapInArrow(releasing(run), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    stats = materialise(document_statistics(docs))
    out = score(stats, fit(stats, labels))
    held = F.coalesce(crc32_text(F.col("doc_id")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores at least threshold; columns and their names stay as they are."""
    model = fit(materialise(document_statistics(docs)), labels)
    names = docs.columns
    at = names.index("text") if "text" in names else [n.lower() for n in names].index("text")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            s = scores(np.array([statistics(t.as_py()) for t in b.column(at)]).reshape(-1, STATS), model)
            yield b.filter(pa.array(s >= threshold, pa.bool_()))

    return flat.mapInArrow(releasing(run), flat.schema).toDF(*names)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; each row is judged by its own text."""
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


QUERIES = {"op9_quality": op9_quality}
ORACLES: dict[str, str] = {}
