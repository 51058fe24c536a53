"""The pipeline's stages, chained by run(), against plain versions on each stage's own input."""

from collections import Counter

import numpy as np

import corpus_pipeline
from siltstone.llm import decontaminate, packing, pii, quality
from siltstone.llm._common import materialise
from tests.llm.test_llm import plain_components

LINE = "the quick brown fox jumps over the lazy dog and runs far away today yes indeed"
FILL = [f"Plain sentence number {i} speaks of topic {i * 7} and of matter {i * 13}, then it ends well." for i in range(120)]
ROWS = [(i, t) for i, t in enumerate(FILL)]
ROWS += [(200 + i, f"!! BUY | NOW | {i} | " * 12) for i in range(120)]
ROWS += [(None, FILL[3]), (None, "A row without an id, and its text is fine, is kept as it is."), (None, LINE), (5, "Another text of a repeated id is kept, as it is clean."), (5, FILL[5])]
ROWS += [(400, LINE), (401, None), (402, ""), (403, "Write to a.b@c.example.com or 10.0.0.1 for the whole story of it.")]
KIND = "doc_id long, text string"


def _tables(spark, path, rows):
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 120)) for i, _ in ROWS if i is not None and i < 320]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, LINE)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_every_stage_against_plain_versions(spark, tmp_path, monkeypatch):
    seen = []

    def watched(stage):
        def run(spark, docs, sf_dir):
            out = materialise(stage(spark, docs, sf_dir))
            seen.append((docs, out))
            return out

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(f)) for n, f in corpus_pipeline.STAGES])
    sf = _tables(spark, tmp_path, ROWS)
    final = corpus_pipeline.run(spark, sf).collect()
    rows = [([tuple(r) for r in i.collect()], [tuple(r) for r in o.collect()]) for i, o in seen]
    assert len(rows) == 5 and all(o.columns == ["doc_id", "text"] for _, o in seen[:-1])
    # quality: each row by its own text
    model = quality.fit(materialise(quality.document_statistics(seen[0][0])), spark.read.parquet(f"{sf}/labels.parquet"))
    ok = quality.scores(np.array([quality.statistics(t) for _, t in rows[0][0]]), model) >= 0.3
    assert Counter(rows[0][1]) == Counter(r for r, k in zip(rows[0][0], ok) if k)
    assert (None, FILL[3]) in rows[0][1] and not any((t or "").startswith("!!") for _, t in rows[0][1])
    # near duplicates: one row of each component by row number, rows without words stay
    given = rows[1][0]
    by = {r: c for r, _, c in plain_components([(k, t) for k, (_, t) in enumerate(given)])}
    best = {}
    for k, (i, _) in enumerate(given):
        best.setdefault(by[k], []).append((i is None, i or 0, given[k]))
    assert Counter((r[0], r[1]) for r in rows[1][1]) == Counter(min(x, key=lambda y: y[:2])[2] for x in best.values())
    assert Counter(rows[2][1]) == Counter(r for r in rows[2][0] if not decontaminate.brute_force([r], [(1, LINE)])[r[0]][-1])
    # personal data: same rows in number and ids; a text without any stays
    assert Counter(i for i, _ in rows[3][1]) == Counter(i for i, _ in rows[3][0])
    clean = Counter(r for r in rows[3][0] if not pii.plain_base(r[1] or "") and r[1] and "[" not in r[1])
    assert not clean - Counter(rows[3][1])
    assert not any("a.b@c.example.com" in (t or "") or "10.0.0.1" in (t or "") for _, t in rows[3][1])
    # packing: every token of every row once
    tok = packing.WordIds(packing.default_tokenizer())
    assert sum(r.length for r in final) == sum(len(tok.encode([t or ""])[0]) // 4 + 1 for _, t in rows[4][0])
    assert Counter(r.doc_id for r in final if r.piece == 0) == Counter(i for i, _ in rows[4][0])


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, _tables(spark, tmp_path, [])).count() == 0
