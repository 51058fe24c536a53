"""The table layer against known rows, row groups and errors."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siltstone.engine import Engine
from siltstone.errors import BindError, OptionError, TableError, UnsupportedType
from siltstone.plans.planner import EngineConf, choose_reader, usable_order
from siltstone.sources.options import options_from_json, parse_bool, parse_int, quote_path, split_paths

# The tables, rows, row groups and messages that are asserted below are fixed values: they must equal the known results
# that the behaviour of declared tables is specified by, so that the same statements give the same answers.
SIMPLE = {"one": "int8", "two": "int8[]", "three": "text", "four": "timestamp", "five": "date", "six": "bool", "seven": "float8"}


@pytest.fixture
def engine(spark, files):
    e = Engine(spark)
    e.create_table("example1", SIMPLE, {"filename": str(files / "simple/example1.parquet"), "sorted": "one"})
    both = f"{files}/simple/example1.parquet {files}/simple/example2.parquet"
    e.create_table("seq", SIMPLE, {"filename": both})
    e.create_table("srt", SIMPLE, {"filename": both, "sorted": "one"})
    return e


def keys(df, name="one"):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize(
    "where, skipped, rows",
    [
        ("one < 1", [1, 2], 0),
        ("one <= 1", [2], 1),
        ("one > 6", [1, 2], 0),
        ("one >= 6", [1], 1),
        ("one = 2", [2], 1),
        ("one = 7", [1, 2], 0),
        ("six = true", [2], 2),
        ("six", [2], 2),
        ("six = false", [], 4),
        ("NOT six", [], 4),
        ("seven < 1.5", [2], 2),
        ("seven <= 1.5", [], 3),
        ("seven = 1.5", [1], 1),
        ("seven > 1", [1], 2),
        ("seven >= 1", [], 3),
        ("seven IS NULL", [], 2),
        ("five < '2018-01-03'", [2], 2),
        ("five < date'2018-01-01'", [1, 2], 0),
        ("1 >= one", [2], 1),
        ("one BETWEEN 5 AND 9 AND six = false", [1], 2),
        ("one < 1 OR one = 6", [], 1),
    ],
)
def test_pruning(engine, where, skipped, rows):
    assert engine.plan("example1", where).files[0].skipped == skipped
    assert engine.table("example1", where).count() == rows


def test_simple_facts(engine):
    assert [r.x for r in engine.sql("SELECT 1 AS x FROM example1").collect()] == [1] * 6
    assert engine.sql("SELECT count(*) AS n, sum(one) AS s FROM example1").first()[:] == (6, 21)
    assert engine.sql("SELECT * FROM example1 WHERE four < cast(:d AS timestamp_ntz)", {"d": "2018-01-01"}).count() == 0
    pairs = engine.sql("SELECT e1.one AS a, e2.one AS b FROM example1 e1, (SELECT * FROM example1) e2 WHERE e1.one < e2.one ORDER BY 1, 2").collect()
    assert [tuple(r) for r in pairs] == [(a, b) for a in range(1, 7) for b in range(a + 1, 7)]


def test_two_files(engine):
    rows = engine.table("seq").collect()
    assert len(rows) == 11 and sum(r.seven is None for r in rows) == 7
    assert engine.explain_text("seq") == "Reader: Multifile\nRow groups:\n  example1.parquet: 1, 2\n  example2.parquet: 1"
    assert keys(engine.ordered_scan("srt", ["one"])) == [1, 1, 2, 3, 3, 4, 5, 5, 6, 7, 9]
    assert engine.plan("srt", None, ["one"]).reader == "Multifile Merge"
    engine.alter_table("srt", add={"max_open_files": "1"})
    assert engine.plan("srt", None, ["one"]).reader == "Caching Multifile Merge"
    # Not disjoint: the promise is not kept, the order is.
    engine.alter_table("srt", add={"files_in_order": "true"})
    assert keys(engine.ordered_scan("srt", ["one"])) == [1, 1, 2, 3, 3, 4, 5, 5, 6, 7, 9]


def test_single_file_order_needs_no_exchange(engine):
    df = engine.ordered_scan("example1", ["one"])
    assert keys(df) == [1, 2, 3, 4, 5, 6]
    assert "Exchange rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_option_errors(spark, files):
    e, f = Engine(spark), str(files / "simple/example1.parquet")
    cols = {"one": "int8"}
    for options, message in (
        ({}, "filename or function is required"),
        ({"filename": "nonexistent.parquet", "some_option": "1"}, r"No such file or directory \('nonexistent.parquet'\)"),
        ({"filename": f, "some_option": "123"}, 'invalid option "some_option"'),
        ({"filename": f, "use_mmap": "maybe"}, "boolean"),
        ({"filename": f, "max_open_files": "many"}, "integer"),
        ({"filename": f, "max_open_files": "99999999999"}, "out of range"),
        ({"files_func": "absent"}, "does not exist"),
    ):
        with pytest.raises(OptionError, match=message):
            e.create_table("t", cols, options)
    e.register_function("no_args", lambda: [f])
    e.register_function("numbers", lambda arg: [1, 2])
    e.register_function("nothing", lambda arg: None)
    e.register_function("holes", lambda arg: [None])
    e.register_function("empty", lambda arg: [])
    with pytest.raises(OptionError, match="does not exist"):
        e.create_table("t", cols, {"files_func": "no_args"})
    with pytest.raises(OptionError, match="invalid input syntax for type json"):
        e.create_table("t", cols, {"files_func": "numbers", "files_func_arg": "invalid json"})
    for name in ("numbers", "nothing", "holes"):
        e.create_table(name, cols, {"files_func": name})
        with pytest.raises(OptionError):
            e.table(name)
    e.create_table("empty", cols, {"files_func": "empty"})
    with pytest.warns(UserWarning):
        assert e.table("empty").count() == 0
    e.create_table("bad", cols, {"filename": f, "sorted": "nine"})
    with pytest.raises(OptionError, match="nine"):
        e.plan("bad")
    with pytest.raises(TableError):
        e.create_table("bad", cols, {"filename": f})


def test_bind_errors(spark, files):
    e = Engine(spark)
    e.create_table("t", {"one": "int8[]", "two": "int8"}, {"filename": str(files / "simple/example1.parquet")})
    with pytest.raises(BindError):
        e.table("t")
    e.create_table("u", {"two": "int8"}, {"filename": str(files / "simple/example1.parquet")})
    with pytest.raises(BindError, match="list column"):
        e.table("u")


def test_listing_is_asked_each_time(spark, files):
    e, calls = Engine(spark), []

    def listing(arg: dict) -> list[str]:
        calls.append(arg)
        return [f"{arg['dir']}/example{k}.parquet" for k in range(1, 1 + min(2, len(calls)))]

    e.register_function("listing", listing)
    e.create_table("t", SIMPLE, {"files_func": "listing", "files_func_arg": f'{{"dir": "{files}/simple"}}'})
    assert e.sql("SELECT * FROM t").count() == 6
    assert e.sql("SELECT * FROM t").count() == 11


def test_imports(spark, files):
    e = Engine(spark)
    assert [t.name for t in e.import_schema(str(files / "simple"), options={"sorted": "one"})] == ["example1", "example2"]
    assert e.table("example2").columns == ["one", "two", "three", "four", "five", "six"]
    assert [t.name for t in Engine(spark).import_schema(str(files / "simple"), limit_to=["example1", "example2"])] == ["example1", "example2"]
    assert [t.name for t in Engine(spark).import_schema(str(files / "simple"), except_=["example1"])] == ["example2"]
    e.register_function("listing", lambda arg: [f"{arg['dir']}/example{k}.parquet" for k in (1, 2)])
    arg = f'{{"dir": "{files}/simple"}}'
    e.import_parquet("imp", "public", "srv", "listing", arg, '{"sorted": "one"}')
    assert [(r.one, r.three) for r in e.ordered_scan("imp", ["one", "three"]).collect()][:3] == [(1, "eins"), (1, "foo"), (2, "bar")]
    e.import_parquet_explicit("imp2", "public", "srv", ["one", "three", "six"], ["int8", "text", "bool"], "listing", arg, {"sorted": "one"})
    assert e.table("imp2").columns == ["one", "three", "six"] and e.table("imp2").count() == 11
    with pytest.raises(TableError):
        e.import_parquet_explicit("x", None, "srv", ["one"], [], "listing", arg)
    with pytest.raises(TableError):
        e.import_parquet("x", None, "", "listing", arg)
    with pytest.raises(OptionError):
        e.import_parquet("x", None, "srv", "listing", arg, '{"sorted": 1}')
    assert 'CREATE FOREIGN TABLE "example1"' in e.get("example1").to_ddl()


def test_maps(spark, files):
    e = Engine(spark)
    e.create_table("m", {"one": "jsonb", "two": "json", "three": "int2"}, {"filename": str(files / "complex/example3.parquet"), "sorted": "one"})
    rows = [tuple(r) for r in e.table("m").collect()]
    assert rows == [
        ('{"1": "foo", "2": "bar", "3": "baz"}', '{"2018-01-01": 10, "2018-01-02": 15}', 1),
        ('{"4": "test1", "5": "test2"}', '{"2018-01-03": 20, "2018-01-04": 25}', 2),
    ]
    assert e.plan("m", "three = 3").reader == "Trivial"
    assert e.plan("m", [("one", "has_key", 6)]).reader == "Trivial"
    assert e.table("m", [("one", "has_key", 4)]).count() == 1


def test_map_edges(spark, tmp_path):
    kind = pa.schema([("s", pa.map_(pa.string(), pa.int64())), ("b", pa.map_(pa.string(), pa.bool_())), ("f", pa.map_(pa.int64(), pa.float64()))])
    pq.write_table(
        pa.table({"s": [[("bb", 1), ("a", 2), ("bb", 3)], [], None], "b": [[("x", True), ("y", None)], [], None], "f": [[(10, 1.0), (9, 0.5)], [], None]}, schema=kind), tmp_path / "m.parquet"
    )
    e = Engine(spark)
    e.import_schema(str(tmp_path))
    assert [tuple(r) for r in e.table("m").collect()] == [('{"a": 2, "bb": 3}', '{"x": true, "y": null}', '{"9": 0.5, "10": 1}'), ("{}", "{}", "{}"), (None, None, None)]
    assert e.table("m", host_compat=True).first().b == '{"x": "t", "y": null}'


def test_types_and_casts(spark, tmp_path):
    now = dt.datetime(2020, 1, 2, 3, 4, 5, 678901)
    t = pa.table(
        {
            "i8": pa.array([1, None], pa.int8()),
            "i64": pa.array([2, 3]),
            "f": pa.array([2.5, 3.5]),
            "b": pa.array([b"\x01\xff", None]),
            "ns": pa.array([now, None], pa.timestamp("ns")),
            "utc": pa.array([now, None], pa.timestamp("us", tz="UTC")),
            "l": pa.array([[1, None], None], pa.list_(pa.int32())),
            "X": pa.array([1, 2]),
            "x": pa.array([7, 8]),
        }
    )
    pq.write_table(t, tmp_path / "a b.parquet")
    e = Engine(spark)
    (table,) = e.import_schema(str(tmp_path))
    row = e.table(table.name).first()
    assert (row.i8, row.ns, row.utc, row.X) == (1, now, now, 1)
    e.create_table("c", {"i64": "int2", "f": "int4", "b": "text", "l": "int8[]", "zz": "date", "X": "int8"}, {"filename": quote_path(str(tmp_path / "a b.parquet"))})
    assert [tuple(r) for r in e.table("c").collect()] == [(2, 2, "\\x01ff", [1, None], None, 1), (3, 4, None, None, None, 2)]
    pq.write_table(pa.table({"i": pa.array([70000])}), tmp_path / "big.parquet")
    e.create_table("n", {"i": "int2"}, {"filename": str(tmp_path / "big.parquet")})
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        e.table("n").collect()
    pq.write_table(pa.table({"s": pa.array([{"a": 1}])}), tmp_path / "struct.parquet")
    e.register_function("one", lambda arg: [str(tmp_path / "struct.parquet")])
    with pytest.raises(UnsupportedType):
        e.import_parquet("s", None, "srv", "one")


def test_no_statistics_and_nulls(spark, tmp_path):
    t = pa.table({"k": pa.array([None, None, 1, 2], pa.int64())})
    pq.write_table(t, tmp_path / "a.parquet", row_group_size=2)
    pq.write_table(t, tmp_path / "b.parquet", row_group_size=2, write_statistics=False)
    e = Engine(spark)
    for n in "ab":
        e.create_table(n, {"k": "int8"}, {"filename": str(tmp_path / f"{n}.parquet"), "sorted": "k"})
        assert e.table(n, "k > 1").count() == 1
        assert keys(e.ordered_scan(n, ["k"]), "k") == [1, 2, None, None]
    assert e.plan("b", "k > 5").reader == "Single File"


def test_pruned_equals_full(spark, tmp_path):
    import random

    rng = random.Random(4)
    rows = [rng.choice([None, rng.randint(-50, 50)]) for _ in range(400)]
    pq.write_table(pa.table({"k": pa.array(rows, pa.int64())}), tmp_path / "r.parquet", row_group_size=17)
    e = Engine(spark)
    e.create_table("r", {"k": "int8"}, {"filename": str(tmp_path / "r.parquet")})
    import operator

    ops = {"<": operator.lt, "<=": operator.le, "=": operator.eq, ">=": operator.ge, ">": operator.gt}
    for name, f in ops.items():
        for v in (-51, -50, 0, 13, 50, 51):
            live = set(e.plan("r", f"k {name} {v}").files[0].groups)
            assert all(n // 17 + 1 in live for n, k in enumerate(rows) if k is not None and f(k, v))


@pytest.mark.parametrize(
    "sorted_by, order_by, const, got",
    [
        ("a b c", "a b", "", "a b"),
        ("a b c", "b", "", ""),
        ("a b c", "b", "a", "b"),
        ("a b c", "a c", "b", "a c"),
        ("a b", "a b c", "", "a b"),
        ("a b", "c", "", ""),
        ("A", "a", "", "a"),
    ],
)
def test_usable_order(sorted_by, order_by, const, got):
    assert usable_order(sorted_by.split(), order_by.split(), set(const.split())) == got.split()


def test_readers():
    assert choose_reader(0, False, 0) == "Trivial"
    assert choose_reader(1, True, 5) == "Single File"
    assert choose_reader(2, False, 5) == "Multifile"
    assert choose_reader(2, True, 0) == "Multifile Merge"
    assert choose_reader(2, True, 5) == "Caching Multifile Merge"
    assert choose_reader(2, True, 5, EngineConf(enable_multifile_merge=False)) == "Multifile"


def test_parsers():
    assert split_paths('a "b c"  d') == ["a", "b c", "d"]
    assert split_paths('"x"') == ["x"] and split_paths("a ") == ["a"]
    assert split_paths(quote_path('q"u\\o te')) == ['q"u\\o te']
    assert parse_bool("x", "on") and not parse_bool("x", "off")
    assert parse_int("x", " 12 ") == 12
    assert options_from_json('{"a": "b"}') == {"a": "b"}
    with pytest.raises(OptionError):
        options_from_json("[1]")


@pytest.fixture
def parts(spark, files):
    e = Engine(spark)
    cols = {"id": "int4", "token": "int4", "date": "timestamp", "num": "int4"}
    kids = []
    for k in (1, 2):
        e.create_table(f"c{k}", cols, {"filename": f"{files}/partition/part{k}.parquet", "sorted": "id token date"})
        kids.append((dt.datetime(2018, k, 1), dt.datetime(2018, k + 1, 1), f"c{k}"))
    e.create_partitioned("p", "date", kids)
    return e


def test_partitions(parts):
    assert parts.table("p", "id = 1").count() == 3
    day = "date = timestamp_ntz'2018-01-01 00:00:00'"
    assert parts.pruned_children("p", day) == ["c1"] and parts.table("p", day).count() == 1
    assert parts.pruned_children("p", "date >= '2018-03-01'") == []
    assert parts.table("p", "date >= '2018-03-01'").count() == 0
    assert parts.pruned_children("p", "date < '2018-02-01'") == ["c1"]
    df = parts.ordered_scan("p", ["date"])
    dates = keys(df, "date")
    assert dates == sorted(dates) and "Exchange rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "table, over, where, want",
    [
        ("p", "PARTITION BY token ORDER BY date", "id = 1 AND token BETWEEN 1 AND 2", [59]),
        ("c1", "PARTITION BY token ORDER BY date", "id = 1 AND token BETWEEN 1 AND 2", [23]),
        ("c1", "PARTITION BY token", "id = 1 AND token BETWEEN 1 AND 2", [23]),
        ("c1", "PARTITION BY date", "id = 1 AND token BETWEEN 1 AND 2", [23]),
        ("c1", "PARTITION BY token ORDER BY date", "token BETWEEN 1 AND 2", [23, 38]),
        ("p", "PARTITION BY token ORDER BY date", "token BETWEEN 1 AND 2", [59, 96]),
    ],
)
def test_windows(parts, table, over, where, want):
    q = f"""SELECT max(m) AS m FROM (SELECT max(num) OVER w AS m, token FROM {table} WHERE {where}
    WINDOW w AS ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) t GROUP BY token ORDER BY token"""
    assert [r.m for r in parts.sql(q).collect()] == want


def test_statistics_and_samples(engine):
    got = {r.column_name: r for r in engine.analyze("seq", exact_distinct=True).collect()}
    assert (got["one"].row_count, got["one"].null_count, got["one"].distinct_count, got["one"].min_value, got["one"].max_value) == (11, 0, 8, "1", "9")
    assert got["seven"].null_count == 7
    assert sorted(keys(engine.sample("seq", 4))) == [1, 1, 3, 5, 5, 9]
    assert engine.sample("seq", 100).count() == 11
    rows = [tuple(r) for r in engine.explain_scan("seq", "one > 3").collect()]
    assert rows == [("example1.parquet", 2, 3), ("example2.parquet", 1, 5)]


def test_statements_open_needed_files_only(spark, tmp_path):
    for k in range(3):
        pq.write_table(pa.table({"k": list(range(10 * k, 10 * k + 10)), "v": [k] * 10}), f"{tmp_path}/a b+{k}é.parquet")
    names = [f"{tmp_path}/a b+{k}é.parquet" for k in range(3)]
    e = Engine(spark)
    e.create_table("t", {"k": "int8", "v": "int8"}, {"filename": " ".join(map(quote_path, names))})
    for k in range(3):
        e.create_table(f"c{k}", {"k": "int8", "v": "int8"}, {"filename": quote_path(names[k])})
    e.create_partitioned("p", "k", [(10 * k, 10 * k + 10, f"c{k}") for k in range(3)])
    assert len(e.sql("SELECT * FROM t").inputFiles()) == 3
    for t in ("t", "p"):
        one = e.sql(f"SELECT * FROM {t} WHERE k >= :lo AND k < 15", {"lo": 12})
        assert len(one.inputFiles()) == 1 and sorted(r.k for r in one.collect()) == [12, 13, 14]
        assert e.sql(f"SELECT * FROM {t} WHERE k < 0").collect() == []
        # Each scan of the table has its own condition; what any of them needs stays.
        both = e.sql(f"SELECT a.k AS x, b.k AS y FROM {t} a JOIN (SELECT * FROM {t} WHERE k > 25) b ON a.k + 25 = b.k WHERE a.k < 9")
        assert len(both.inputFiles()) == 2 and sorted(map(tuple, both.collect())) == [(1, 26), (2, 27), (3, 28), (4, 29)]
        sub = e.sql(f"SELECT k FROM {t} WHERE k < 5 AND v < (SELECT max(v) FROM {t} WHERE k > 11)")
        assert sorted(r.k for r in sub.collect()) == [0, 1, 2, 3, 4]
        assert e.sql(f"WITH w AS (SELECT * FROM {t} WHERE k = 7) SELECT a.k FROM w a, w b").count() == 1
        assert e.sql(f"SELECT count(*) AS n FROM {t} WHERE k < 5 OR v = 2").first().n == 15
    assert sorted(r.k for r in e.sample("t", 6).collect()) == [0, 5, 10, 15, 20, 25]


def test_samples_are_one_scan(spark, tmp_path):
    for k in range(12):
        pq.write_table(pa.table({"k": [k] * 5}), f"{tmp_path}/f{k:02}.parquet")
    e = Engine(spark)
    e.create_table("t", {"k": "int8"}, {"filename": " ".join(f"{tmp_path}/f{k:02}.parquet" for k in range(12))})
    plan = e.sample("t", 12)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_order_is_counted(spark):
    from siltstone.queries import in_order

    assert in_order(spark.range(0, 100, 1, 4).toDF("k"), "k").first()[:] == (100, 0)
    wrong = spark.range(0, 10, 1, 1).union(spark.range(5, 15, 1, 1)).toDF("k")
    assert in_order(wrong, "k").first()[:] == (20, 1)
    assert in_order(spark.createDataFrame([(2,), (None,), (1,)], "k long").coalesce(1), "k").first().out_of_order == 1
    assert in_order(spark.range(0).toDF("k"), "k").first()[:] == (0, 0)


def test_footers_of_other_stores(spark, tmp_path):
    pq.write_table(pa.table({"k": list(range(40))}), f"{tmp_path}/a.parquet", row_group_size=10)
    pq.write_table(pa.table({"k": list(range(40, 60))}), f"{tmp_path}/b.parquet")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.t.link./in", f"file://{tmp_path}")
    e = Engine(spark)
    e.create_table("t", {"k": "int8"}, {"filename": "viewfs://t/in/a.parquet viewfs://t/in/b.parquet", "sorted": "k", "files_in_order": "true"})
    assert [r.row_group for r in e.explain_scan("t", "k < 15").collect()] == [1, 2]
    assert len(e.sql("SELECT * FROM t WHERE k > 50").inputFiles()) == 1
    assert [r.k for r in e.ordered_scan("t", ["k"]).collect()] == list(range(60))
    assert sorted(r.k for r in e.sample("t", 6).collect()) == [0, 10, 20, 30, 40, 50]
    with pytest.raises(OptionError):
        e.create_table("u", {"k": "int8"}, {"filename": f"{tmp_path}/none.parquet"})


def test_directories_stand_for_their_files(spark, tmp_path):
    (tmp_path / "t.parquet/.hidden").mkdir(parents=True)
    for k in range(3):
        pq.write_table(pa.table({"k": list(range(20 * k, 20 * k + 20))}), f"{tmp_path}/t.parquet/part-{k}.parquet", row_group_size=10)
    (tmp_path / "t.parquet/_SUCCESS").write_text("no table")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.d.link./in", f"file://{tmp_path}")
    for k, path in enumerate((f"{tmp_path}/t.parquet", f"file://{tmp_path}/t.parquet/", "viewfs://d/in/t.parquet")):
        e = Engine(spark)
        e.create_table(f"dir{k}", {"k": "int8"}, {"filename": path, "sorted": "k", "files_in_order": "true"})
        assert keys(e.table(f"dir{k}", "k >= 15"), "k") and e.table(f"dir{k}").count() == 60
        assert [(r.file, r.row_group) for r in e.explain_scan(f"dir{k}", "k < 25").collect()] == [("part-0.parquet", 1), ("part-0.parquet", 2), ("part-1.parquet", 1)]
        assert len(e.sql(f"SELECT * FROM dir{k} WHERE k > 50").inputFiles()) == 1
        assert keys(e.ordered_scan(f"dir{k}", ["k"]), "k") == list(range(60))
        assert sorted(keys(e.sample(f"dir{k}", 6), "k")) == [0, 10, 20, 30, 40, 50]
        e.register_function("whole", lambda arg: [path])
        assert [c.name for c in e.import_parquet("i", None, "s", "whole").columns] == ["k"] and e.table("i").count() == 60
    pq.write_table(pa.table({"k": [60]}), f"{tmp_path}/t.parquet/part-3.parquet")
    assert e.table("dir2").count() == 61
    (tmp_path / "t.parquet/more").mkdir()
    with pytest.raises(OptionError, match="holds the directory"):
        e.table("dir2")
    (tmp_path / "none").mkdir()
    e.create_table("none", {"k": "int8"}, {"filename": f"{tmp_path}/none"})
    assert e.table("none").count() == 0
