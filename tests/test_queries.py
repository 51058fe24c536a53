"""Every query of the table layer against its SQL on the smallest tables."""

import math
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siltstone.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def plain(rows):
    show = lambda x: "~" if x is None else round(x, 6) if isinstance(x, float) and not math.isnan(x) else str(x)
    return sorted(str([show(x) for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    assert plain([r[c] for c in cols] for r in df.collect()) == plain([r[names.index(c)] for c in cols] for r in want.fetchall())


@pytest.mark.parametrize("name", ["list_column", "list_contains", "list_elem_access", "list_elem_cast", "list_elements"])
def test_query_over_a_directory(spark, duck, tmp_path, name):
    t = pq.read_table(f"{DATA}/embeddings.parquet")
    (tmp_path / "embeddings.parquet").mkdir()
    for k in range(3):
        pq.write_table(t.slice(k * 80, 80 if k < 2 else None), f"{tmp_path}/embeddings.parquet/part-{k}.parquet")
    (tmp_path / "embeddings.parquet/_SUCCESS").touch()
    df = QUERIES[name](spark, str(tmp_path))
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert plain([r[c] for c in names] for r in df.collect()) == plain(want.fetchall())


#: Null, empty and short lists, null and non-finite elements, and as many elements as the queries name, or more.
LISTS = [None, [], [None], [1.5], [1.5, None], [None, 2.5], [1.0, 2.0, 1.0], [1.0, None, 3.0, None], [1.0, 2.0, 3.0, 4.0, 5.0], [math.nan], [math.nan, math.inf], [-0.0, 0.0]]


@pytest.mark.parametrize("name", ["list_contains", "list_elem_access", "list_elem_cast", "list_elements"])
def test_query_over_odd_lists(spark, tmp_path, name):
    t = pa.table({"vec_id": pa.array([*range(len(LISTS) - 1), None], "int64"), "embedding": pa.array(LISTS, pa.list_(pa.float32())), "label": pa.array([1] * len(LISTS), "int32")})
    (tmp_path / "embeddings.parquet").mkdir()
    for k in range(2):
        pq.write_table(t.slice(k * 6, 6), f"{tmp_path}/embeddings.parquet/part-{k}.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert plain([r[c] for c in names] for r in df.collect()) == plain(want.fetchall())
