"""Queries over declared tables, one or more for each operator of the table layer, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .engine import Engine
from .fixtures import derived, paths
from .sources.options import quote_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Declarations of the given tables.
TABLES = {
    "region": {"r_regionkey": "int4", "r_name": "text"},
    "nation": {"n_nationkey": "int4", "n_name": "text", "n_regionkey": "int4"},
    "customer": {"c_custkey": "int8", "c_name": "text", "c_nationkey": "int4", "c_acctbal": "float8", "c_mktsegment": "text"},
    "supplier": {"s_suppkey": "int8", "s_name": "text", "s_nationkey": "int4", "s_acctbal": "float8"},
    "part": {"p_partkey": "int8", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "int4", "p_retailprice": "float8"},
    "orders": {"o_orderkey": "int8", "o_custkey": "int8", "o_orderstatus": "text", "o_totalprice": "float8", "o_orderdate": "timestamp", "o_orderpriority": "text"},
    "lineitem": {
        "l_orderkey": "int8", "l_partkey": "int8", "l_suppkey": "int8", "l_linenumber": "int4", "l_quantity": "float8", "l_extendedprice": "float8",
        "l_discount": "float8", "l_tax": "float8", "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "timestamp",
    },
    "events": {"event_id": "int8", "ts": "timestamp", "user_id": "int8", "event_type": "text", "value": "float8", "props": "text"},
    "embeddings": {"vec_id": "int8", "embedding": "float4[]", "label": "int4"},
    "labels": {"doc_id": "int8", "quality": "int4", "toxic": "int4"},
}


def engine(spark: SparkSession, sf_dir: str, *names: str) -> Engine:
    """An engine with the named tables declared over the given files."""
    e = Engine(spark)
    for n in names:
        e.create_table(n, TABLES[n], {"filename": quote_path(f"{sf_dir}/{n}.parquet")})
    return e


def over(spark: SparkSession, sf_dir: str, folder: str, columns: dict, **options: str) -> Engine:
    """An engine with table t over a derived input."""
    e = Engine(spark)
    e.create_table("t", columns, {"filename": " ".join(map(quote_path, paths(derived(sf_dir, folder)))), **options})
    return e


def query(name: str, sql: str | None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def statement(name: str, tables: str, spark_sql: str, sql: str | None = None) -> None:
    """A query that is one SQL statement over given tables; sql is the other dialect where it differs."""
    query(name, sql or spark_sql)(lambda spark, d: engine(spark, d, *tables.split()).sql(spark_sql))


def filtered(name: str, condition: str) -> None:
    """orders in eight row groups under a condition."""
    query(name, f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {condition}")(
        lambda spark, d: over(spark, d, "order_groups", TABLES["orders"]).table("t", condition, ["o_orderkey", "o_custkey", "o_totalprice"])
    )


# -- first slice, scans, projections ------------------------------------------------------------------------------------
statement("slice_returnflag", "lineitem", "SELECT l_returnflag, sum(l_quantity) AS q FROM lineitem WHERE l_orderkey < 1000 GROUP BY l_returnflag")
statement("scan_all", "orders", "SELECT * FROM orders")
statement("scan_projection", "orders", "SELECT o_orderkey AS k, o_totalprice * 2 AS doubled FROM orders")
statement("scan_const", "orders", "SELECT 1 AS x FROM orders")
statement("count_star", "orders", "SELECT count(*) AS n FROM orders")

# -- predicates and pruning -------------------------------------------------------------------------------------------
filtered("filter_lt", "o_orderkey < 700")
filtered("filter_le", "o_orderkey <= 700")
filtered("filter_gt", "o_orderkey > 700")
filtered("filter_ge", "o_orderkey >= 700")
filtered("filter_eq", "o_orderkey = 701")
filtered("filter_const_first", "700 > o_orderkey")
filtered("filter_cross_type", "o_totalprice > 100000")
filtered("filter_between", "o_orderkey BETWEEN 100 AND 900 AND o_totalprice > 1000.5")
filtered("filter_or_in_like", "o_orderkey IN (1, 2, 3, 900) OR o_orderpriority LIKE '1-%'")
filtered("filter_not_case", "NOT (o_orderkey > 50) AND CASE WHEN o_custkey > 10 THEN 1 ELSE 0 END <> 0")
filtered("filter_timestamp", "o_orderdate < TIMESTAMP '1995-03-15 00:00:00'")
QUERIES["filter_timestamp"] = lambda spark, d: over(spark, d, "order_groups", TABLES["orders"]).table("t", "o_orderdate < timestamp_ntz'1995-03-15 00:00:00'", ["o_orderkey", "o_custkey", "o_totalprice"])

FLAGS = {"doc_id": "int8", "quality": "bool", "toxic": "int4"}


@query("filter_bool", "SELECT doc_id, toxic FROM labels WHERE quality = 1")
def _(spark, d):
    return over(spark, d, "label_flags", FLAGS).table("t", "quality = true", ["doc_id", "toxic"])


@query("filter_not_bool", "SELECT doc_id, toxic FROM labels WHERE quality = 0")
def _(spark, d):
    return over(spark, d, "label_flags", FLAGS).table("t", "NOT quality", ["doc_id", "toxic"])


@query("filter_is_null", "SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders) WHERE r > (n + 1) // 2")
def _(spark, d):
    return over(spark, d, "order_missing", TABLES["orders"]).table("t", "o_orderstatus IS NULL", ["o_orderkey"])


@query("prepared_param", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01 00:00:00' AND o_orderkey > 20")
def _(spark, d):
    return over(spark, d, "order_groups", TABLES["orders"]).sql(
        "SELECT o_orderkey, o_totalprice FROM t WHERE o_orderdate < cast(:day AS timestamp_ntz) AND o_orderkey > :k", {"day": "1995-01-01", "k": 20}
    )


@query("prepared_prune", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1997-06-01 00:00:00' AND o_orderkey > 7000")
def _(spark, d):
    return over(spark, d, "order_slices", TABLES["orders"]).sql(
        "SELECT o_orderkey, o_totalprice FROM t WHERE o_orderdate < cast(:day AS timestamp_ntz) AND o_orderkey > :k", {"day": "1997-06-01", "k": 7000}
    )


# -- several files, binding, casts ---------------------------------------------------------------------------------------
@query("multifile_seq", "SELECT * FROM orders")
def _(spark, d):
    return over(spark, d, "order_slices", TABLES["orders"]).table("t")


@query(
    "multifile_missing_col",
    "SELECT o_orderkey, CASE WHEN r <= (n + 1) // 2 THEN o_orderstatus END AS o_orderstatus FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)",
)
def _(spark, d):
    return over(spark, d, "order_missing", TABLES["orders"]).table("t", None, ["o_orderkey", "o_orderstatus"])


@query("multifile_mixed_types", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey < 12")
def _(spark, d):
    return over(spark, d, "customer_types", TABLES["customer"]).table("t", "c_nationkey < 12", ["c_custkey", "c_nationkey"])


@query("case_insensitive_bind", "SELECT * FROM part")
def _(spark, d):
    return over(spark, d, "part_upper", TABLES["part"]).table("t")


@query("column_subset", "SELECT p_size, p_partkey FROM part")
def _(spark, d):
    return over(spark, d, "part_upper", {"p_size": "int4", "p_partkey": "int8"}).table("t")


@query("cast_narrow", "SELECT p_partkey, CAST(p_size AS SMALLINT) AS p_size FROM part")
def _(spark, d):
    return over(spark, d, "part_upper", {"p_partkey": "int8", "p_size": "int2"}).table("t")


@query("cast_to_text", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part")
def _(spark, d):
    return over(spark, d, "part_upper", {"p_partkey": "text", "p_size": "text"}).table("t")


@query("cast_float_to_int", "SELECT p_partkey, CAST(round_even(p_retailprice, 0) AS INTEGER) AS p_retailprice FROM part")
def _(spark, d):
    return over(spark, d, "part_upper", {"p_partkey": "int8", "p_retailprice": "int4"}).table("t")


# -- lists and maps ------------------------------------------------------------------------------------------------------
statement(
    "list_column",
    "embeddings",
    "SELECT vec_id, size(embedding) AS n, cast(element_at(embedding, 1) AS double) AS first FROM embeddings",
    "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings",
)
statement(
    "list_elem_access",
    "embeddings",
    "SELECT vec_id, p, cast(e AS double) AS e FROM embeddings LATERAL VIEW posexplode(array(get(embedding, 0), get(embedding, 1), get(embedding, 2), get(embedding, 3))) x AS p, e",
    "SELECT vec_id, CAST(p AS INTEGER) AS p, CAST(embedding[p + 1] AS DOUBLE) AS e FROM embeddings, range(4) r(p)",
)
statement(
    "list_contains",
    "embeddings",
    "SELECT vec_id, array_contains(embedding, try_element_at(embedding, -1)) AS has FROM embeddings",
    "SELECT vec_id, list_contains(embedding, embedding[-1]) AS has FROM embeddings",
)


@query("list_elem_cast", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e1, CAST(embedding[2] AS DOUBLE) AS e2 FROM embeddings")
def _(spark, d):
    e = Engine(spark)
    e.create_table("embeddings", {"vec_id": "int8", "embedding": "float8[]"}, {"filename": quote_path(f"{d}/embeddings.parquet")})
    return e.sql("SELECT vec_id, get(embedding, 0) AS e1, get(embedding, 1) AS e2 FROM embeddings")


@query("map_to_json", "SELECT event_id, '{\"' || event_type || '\": ' || user_id || '}' AS m FROM events")
def _(spark, d):
    return over(spark, d, "event_maps", {"event_id": "int8", "m": "jsonb"}).table("t")


@query("map_key_exists", "SELECT event_id FROM events WHERE event_type = 'click'")
def _(spark, d):
    from pyspark.sql import types as T

    e = over(spark, d, "event_maps", [("event_id", "int8"), ("m", T.MapType(T.StringType(), T.LongType()))])
    return e.table("t", [("m", "has_key", "click")], ["event_id"])


@query("map_value_access", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def _(spark, d):
    e = over(spark, d, "event_maps", {"event_id": "int8", "m": "jsonb"})
    return e.sql("SELECT event_id, cast(get_json_object(m, '$.click') AS bigint) AS user_id FROM t WHERE get_json_object(m, '$.click') IS NOT NULL")


@query("map_functions", "SELECT event_id, event_type AS k, user_id AS v, user_id AS at, CAST(1 AS INTEGER) AS n FROM events")
def _(spark, d):
    from pyspark.sql import types as T

    e = over(spark, d, "event_maps", [("event_id", "int8"), ("m", T.MapType(T.StringType(), T.LongType()))])
    return e.sql("SELECT event_id, map_keys(m)[0] AS k, map_values(m)[0] AS v, element_at(m, map_keys(m)[0]) AS at, size(m) AS n FROM t")


statement(
    "list_elements",
    "embeddings",
    "SELECT vec_id, p, cast(e AS double) AS e FROM embeddings LATERAL VIEW posexplode(embedding) x AS p, e",
    "SELECT vec_id, CAST(p - 1 AS INTEGER) AS p, CAST(embedding[p] AS DOUBLE) AS e FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)",
)
statement(
    "json_props",
    "events",
    "SELECT event_id, cast(get_json_object(props, '$.k') AS bigint) AS k FROM events",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)


# -- order ------------------------------------------------------------------------------------------------------------
@query("merge_sorted", "SELECT * FROM orders")
def _(spark, d):
    return over(spark, d, "order_mixed", TABLES["orders"], sorted="o_orderkey").ordered_scan("t", ["o_orderkey"])


@query("merge_sorted_limited", "SELECT * FROM orders WHERE o_custkey > 50")
def _(spark, d):
    return over(spark, d, "order_mixed", TABLES["orders"], sorted="o_orderkey", max_open_files="1").ordered_scan("t", ["o_orderkey"], "o_custkey > 50")


@query("ordered_concat", "SELECT * FROM orders")
def _(spark, d):
    return over(spark, d, "order_slices", TABLES["orders"], sorted="o_orderkey", files_in_order="true").ordered_scan("t", ["o_orderkey"])


@query("ordered_single", "SELECT * FROM orders WHERE o_custkey < 500")
def _(spark, d):
    return over(spark, d, "order_groups", TABLES["orders"], sorted="o_orderkey").ordered_scan("t", ["o_orderkey"], "o_custkey < 500")


@query("redundant_sort_key", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, d):
    e = over(spark, d, "order_groups", TABLES["orders"], sorted="o_orderstatus o_orderkey")
    return e.ordered_scan("t", ["o_orderstatus", "o_orderkey"], "o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@query("sort_multi_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_quantity > 45")
def _(spark, d):
    return engine(spark, d, "lineitem").ordered_scan("lineitem", ["l_orderkey", "l_linenumber"], "l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


TOP = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate LIMIT 100"
statement("topk", "lineitem", TOP)
statement("limit_offset", "orders", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 25")


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """One row: how many rows df has, and how many neighbours in its order are out of the order of keys, nulls last."""
    key = F.struct(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]).alias("key")
    rows = df.select(key, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    inside = rows.select("*", F.lag("key").over(Window.partitionBy("part").orderBy("place")).alias("before"))
    ends = inside.groupBy("part").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("key")).alias("wrong"), F.min_by("key", "place").alias("first"), F.max_by("key", "place").alias("last")
    )
    across = ends.select("n", "wrong", (F.lag("last").over(Window.orderBy("part")) > F.col("first")).alias("cut"))
    return across.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("wrong") + F.coalesce(F.col("cut").cast("long"), F.lit(0))), F.lit(0)).alias("out_of_order"))


def ordered(name: str, of: str, condition: str, *keys: str) -> None:
    """The order of another query's rows; of its columns those that it is sorted by are asked for."""
    query(name, f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM {of} WHERE {condition}")(lambda spark, d: in_order(QUERIES[name.removesuffix("_order")](spark, d), *keys))


ordered("merge_sorted_order", "orders", "true", "o_orderkey")
ordered("merge_sorted_limited_order", "orders", "o_custkey > 50", "o_orderkey")
ordered("ordered_concat_order", "orders", "true", "o_orderkey")
ordered("ordered_single_order", "orders", "o_custkey < 500", "o_orderkey")
ordered("sort_multi_key_order", "lineitem", "l_quantity > 45", "l_orderkey", "l_linenumber")
ordered("partition_ordered_order", "orders", "o_custkey < 300", "o_orderdate", "o_orderkey")


@query("sort_prefix_order", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM orders")
def _(spark, d):
    """Files in order by the first key only: the second is sorted on top."""
    e = over(spark, d, "order_slices", TABLES["orders"], sorted="o_orderkey", files_in_order="true")
    return in_order(e.ordered_scan("t", ["o_orderkey", "o_totalprice"]), "o_orderkey", "o_totalprice")


# -- joins ------------------------------------------------------------------------------------------------------------
statement("theta_self_join", "nation", "SELECT a.n_nationkey AS x, b.n_nationkey AS y FROM nation a, (SELECT * FROM nation) b WHERE a.n_nationkey < b.n_nationkey")
statement("equi_join", "orders customer", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
statement("left_join", "customer orders", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000")
statement("full_join", "customer orders", "SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_custkey > 20) c FULL JOIN (SELECT * FROM orders WHERE o_custkey < 60) o ON o_custkey = c_custkey")
statement("semi_join", "customer orders", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
statement("anti_join", "customer orders", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
statement("range_join", "nation region", "SELECT n_nationkey, r_regionkey FROM nation JOIN region ON n_nationkey >= r_regionkey * 5 AND n_nationkey < r_regionkey * 5 + 5")
statement("in_subquery", "orders customer", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
statement("star_join", "lineitem orders customer nation", """
SELECT n_name, cast(count(*) AS bigint) AS n, sum(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")  # fmt: skip

statement("right_join", "orders customer", "SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 300000) o RIGHT JOIN customer ON o_custkey = c_custkey")
statement("cross_join", "nation region", "SELECT n_nationkey, r_regionkey FROM nation CROSS JOIN region")
statement(
    "asof_join",
    "orders",
    """
SELECT o_orderkey, prev FROM (
  SELECT o_orderkey, kind, last(if(kind = 0, k, NULL), true) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, kind, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev
  FROM (
    SELECT o_custkey, o_orderdate, o_orderkey, 0 AS kind, o_orderkey AS k FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_custkey, o_orderdate, o_orderkey, 1 AS kind, NULL AS k FROM orders WHERE o_orderstatus <> 'F'
  ) u
) w WHERE kind = 1""",
    """
SELECT l.o_orderkey, (SELECT r.o_orderkey FROM orders r WHERE r.o_orderstatus = 'F' AND r.o_custkey = l.o_custkey AND r.o_orderdate <= l.o_orderdate ORDER BY r.o_orderdate DESC, r.o_orderkey DESC LIMIT 1) AS prev
FROM orders l WHERE l.o_orderstatus <> 'F'""",
)

# -- aggregates -------------------------------------------------------------------------------------------------------
statement("sum_parallel", "lineitem", "SELECT cast(sum(l_orderkey) AS bigint) AS s FROM lineitem")
statement("group_max", "lineitem", "SELECT l_suppkey, max(l_quantity) AS m, min(l_shipdate) AS d FROM lineitem GROUP BY l_suppkey")
statement("distinct_aggregate", "lineitem", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_returnflag HAVING count(*) > 10")
statement("select_distinct", "lineitem", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
statement("grouping_sets", "lineitem", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
statement("rollup_cube", "lineitem", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
statement(
    "array_agg_filter",
    "nation",
    "SELECT array_join(array_sort(collect_list(n_name) FILTER (WHERE n_regionkey = 1)), ',') AS names FROM nation",
    "SELECT array_to_string(list_sort(array_agg(n_name) FILTER (WHERE n_regionkey = 1)), ',') AS names FROM nation",
)

# -- windows, set operations, subqueries ------------------------------------------------------------------------------
FRAME = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
statement("window_full_frame", "lineitem", f"SELECT l_orderkey, l_suppkey, max(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate {FRAME}) AS m FROM lineitem")
statement("window_no_order", "lineitem", f"SELECT l_orderkey, l_suppkey, max(l_quantity) OVER (PARTITION BY l_suppkey {FRAME}) AS m FROM lineitem")
statement("window_other_key", "orders", f"SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_orderdate {FRAME}) AS m FROM orders")
statement("window_group", "lineitem", f"""
SELECT l_suppkey, max(m) AS m FROM (SELECT l_suppkey, max(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate {FRAME}) AS m
FROM lineitem WHERE l_linenumber = 1 AND l_suppkey BETWEEN 1 AND 50) t GROUP BY l_suppkey ORDER BY l_suppkey""")  # fmt: skip
statement("window_rank", "orders", "SELECT o_orderkey, row_number() OVER w AS rn, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS dr, lag(o_orderkey) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
QUERIES["window_rank"] = lambda spark, d: engine(spark, d, "orders").sql(ORACLES["window_rank"]).withColumn("rn", F.col("rn").cast("long")).withColumn("dr", F.col("dr").cast("long"))
statement(
    "window_analytic",
    "orders",
    """SELECT o_orderkey, lead(o_orderkey) OVER w AS next, first_value(o_orderkey) OVER w AS first, last_value(o_orderkey) OVER f AS last, nth_value(o_orderkey, 2) OVER f AS second,
cast(ntile(3) OVER w AS bigint) AS tile, cast(rank() OVER w AS bigint) AS r, percent_rank() OVER w AS pr, cume_dist() OVER w AS cd
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey), f AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
statement("window_range", "part", "SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS n FROM part")
statement("set_except_all", "customer supplier", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey AS k FROM supplier")
statement("set_intersect_all", "customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey AS k FROM supplier")
statement(
    "approx_aggregates",
    "lineitem",
    """SELECT abs(approx_count_distinct(l_suppkey, 0.02) - count(DISTINCT l_suppkey)) <= 0.1 * count(DISTINCT l_suppkey) AS near_count,
abs(percentile_approx(l_extendedprice, 0.5, 1000) - median(l_extendedprice)) <= 0.02 * median(l_extendedprice) AS near_median FROM lineitem""",
    "SELECT true AS near_count, true AS near_median",
)
statement("set_union", "customer supplier", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey AS k FROM supplier")
statement("set_intersect", "customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey AS k FROM supplier")
statement("set_except", "customer supplier", "SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey AS k FROM supplier")
statement("correlated_subquery", "orders", "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
statement("cte_query", "lineitem", "WITH q AS (SELECT l_orderkey AS k, sum(l_quantity) AS s FROM lineitem GROUP BY l_orderkey) SELECT k, s FROM q WHERE s > 150")

# -- partitions -------------------------------------------------------------------------------------------------------


def years(spark: SparkSession, sf_dir: str, **options: str) -> Engine:
    """An engine with orders range-partitioned by year as p."""
    import datetime as dt
    import os

    e, children = Engine(spark), []
    for path in paths(derived(sf_dir, "order_years")):
        name = os.path.basename(path)[:-8]
        e.create_table(name, TABLES["orders"], {"filename": quote_path(path), **options})
        y = int(name[1:])
        children.append((dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1), name))
    e.create_partitioned("p", "o_orderdate", children)
    return e


@query("range_partition", "SELECT * FROM orders")
def _(spark, d):
    return years(spark, d).table("p")


@query("partition_prune_eq", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderkey < 100)")
def _(spark, d):
    day = engine(spark, d, "orders").sql("SELECT max(o_orderdate) AS d FROM orders WHERE o_orderkey < 100").first().d
    return years(spark, d).table("p", f"o_orderdate = timestamp_ntz'{day}'", ["o_orderkey", "o_orderdate"])


@query("partition_prune_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'")
def _(spark, d):
    return years(spark, d).table("p", "o_orderdate >= timestamp_ntz'1994-01-01' AND o_orderdate < timestamp_ntz'1996-02-01'", ["o_orderkey", "o_totalprice"])


@query("partition_prune_sql", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY o_orderstatus")
def _(spark, d):
    return years(spark, d).sql("SELECT o_orderstatus, count(*) AS n FROM p WHERE o_orderdate >= timestamp_ntz'1996-01-01' AND o_orderdate < timestamp_ntz'1997-01-01' GROUP BY o_orderstatus")


@query("partition_ordered", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey < 300")
def _(spark, d):
    return years(spark, d).ordered_scan("p", ["o_orderdate", "o_orderkey"], "o_custkey < 300").select("o_orderkey", "o_orderdate")


# -- imports and listing functions ----------------------------------------------------------------------------------------
@query("import_directory", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region' AS name, count(*) AS n FROM region")
def _(spark, d):
    e = Engine(spark)
    names = [t.name for t in e.import_schema(derived(d, "import_dir"))]
    out = None
    for n in names:
        one = e.table(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def listing(sf_dir: str):
    def files(arg: dict | None) -> list[str]:
        return paths(derived(sf_dir, (arg or {}).get("name", "order_slices")))

    return files


@query("import_files", "SELECT * FROM orders")
def _(spark, d):
    e = Engine(spark)
    e.register_function("list_files", listing(d))
    e.import_parquet("t", "public", "srv", "list_files", {"name": "order_slices"}, {"sorted": "o_orderkey"})
    return e.table("t")


@query("import_explicit", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, d):
    e = Engine(spark)
    e.register_function("list_files", listing(d))
    e.import_parquet_explicit("t", "public", "srv", ["o_orderkey", "o_orderstatus"], ["int8", "text"], "list_files", '{"name": "order_slices"}')
    return e.table("t")


@query("files_func_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey < 500")
def _(spark, d):
    e = Engine(spark)
    e.register_function("list_files", listing(d))
    e.create_table("t", TABLES["orders"], {"files_func": "list_files", "files_func_arg": '{"name": "order_slices"}'})
    return e.table("t", "o_orderkey < 500", ["o_orderkey", "o_custkey"])


@query("trivial_scan", "SELECT o_orderkey FROM orders WHERE o_orderkey < -1")
def _(spark, d):
    return over(spark, d, "order_groups", TABLES["orders"]).table("t", "o_orderkey < -1", ["o_orderkey"])


# -- explanations, statistics, samples ---------------------------------------------------------------------------------
@query(
    "explain_row_groups",
    """WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // ((count(*) OVER () + 7) // 8) AS g FROM orders)
SELECT 'orders.parquet' AS file, CAST(g + 1 AS INTEGER) AS row_group, count(*) AS row_count FROM r GROUP BY g HAVING min(o_orderkey) < 9000 AND max(o_orderkey) >= 4000""",
)
def _(spark, d):
    return over(spark, d, "order_groups", TABLES["orders"]).explain_scan("t", "o_orderkey < 9000 AND o_orderkey >= 4000")


@query("analyze_stats", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
))
def _(spark, d):
    columns = {k: v for k, v in TABLES["orders"].items() if k != "o_totalprice"}
    return over(spark, d, "order_slices", columns).analyze("t", exact_distinct=True)


@query("analyze_approximate", "SELECT column_name, row_count, null_count, true AS near, min_value, max_value FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
    for c in TABLES["orders"] if c != "o_totalprice"
) + ")")
def _(spark, d):
    """The default of analyze: distinct counts within a tenth of the exact ones."""
    columns = {k: v for k, v in TABLES["orders"].items() if k != "o_totalprice"}
    e = over(spark, d, "order_slices", columns)
    exact = e.analyze("t", exact_distinct=True).select("column_name", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.1 * F.col("exact")
    return e.analyze("t").join(exact, "column_name").select("column_name", "row_count", "null_count", near.alias("near"), "min_value", "max_value")


@query("explain_skipped", """WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // ((count(*) OVER () + 7) // 8) AS g FROM orders)
SELECT CAST(g + 1 AS INTEGER) AS row_group FROM r GROUP BY g HAVING NOT (min(o_orderkey) < 9000 AND max(o_orderkey) >= 4000)""")  # fmt: skip
def _(spark, d):
    plan = over(spark, d, "order_groups", TABLES["orders"]).plan("t", "o_orderkey < 9000 AND o_orderkey >= 4000")
    return spark.createDataFrame([(g,) for f in plan.files for g in f.skipped], "row_group int")


@query("plan_rows", "SELECT CAST(coalesce(sum(n) FILTER (WHERE lo < 9000 AND hi >= 4000), 0) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS total_rows FROM (SELECT count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // ((count(*) OVER () + 7) // 8) AS g FROM orders) GROUP BY g)")
def _(spark, d):
    """Rows that the plan expects, from the footers."""
    plan = over(spark, d, "order_groups", TABLES["orders"]).plan("t", "o_orderkey < 9000 AND o_orderkey >= 4000")
    return spark.createDataFrame([(plan.rows, plan.total_rows)], "rows long, total_rows long")


@query("alter_options", "SELECT o_orderkey FROM orders WHERE o_orderkey < 300")
def _(spark, d):
    """A table whose options change: order declared and dropped, hints for input and output, the limit on open files."""
    e = over(spark, d, "order_slices", TABLES["orders"])
    e.alter_table("t", add={"sorted": "o_orderkey", "use_mmap": "true", "use_threads": "false", "max_open_files": "2"})
    e.alter_table("t", set={"max_open_files": "1"}, drop=["use_mmap"])
    return e.ordered_scan("t", ["o_orderkey"], "o_orderkey < 300").select("o_orderkey")


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS r, count(*) OVER () // 100 AS k FROM orders) WHERE r % greatest(k, 1) = 0")
def _(spark, d):
    return over(spark, d, "order_slices", TABLES["orders"]).sample("t", 100).select("o_orderkey", "o_totalprice")


# -- functions of the host ------------------------------------------------------------------------------------------------
statement(
    "string_functions",
    "customer",
    "SELECT c_custkey, lower(c_name) AS l, upper(c_mktsegment) AS u, substring(c_name, 1, 4) AS s, length(c_name) AS n, concat(c_mktsegment, '-', c_name) AS j FROM customer",
    "SELECT c_custkey, lower(c_name) AS l, upper(c_mktsegment) AS u, substring(c_name, 1, 4) AS s, CAST(length(c_name) AS INTEGER) AS n, concat(c_mktsegment, '-', c_name) AS j FROM customer",
)
statement(
    "date_functions",
    "orders",
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, cast(date_trunc('MONTH', o_orderdate) AS date) AS t, cast(o_orderdate AS date) AS d FROM orders",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS t, CAST(o_orderdate AS DATE) AS d FROM orders",
)
statement(
    "math_functions",
    "part",
    "SELECT p_partkey, abs(p_size - 25) AS a, cast(floor(p_retailprice) AS bigint) AS f, cast(ceil(p_retailprice) AS bigint) AS c, sqrt(p_retailprice) AS r, p_partkey div 7 AS q, p_partkey % 7 AS m FROM part",
    "SELECT p_partkey, abs(p_size - 25) AS a, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c, sqrt(p_retailprice) AS r, p_partkey // 7 AS q, p_partkey % 7 AS m FROM part",
)
