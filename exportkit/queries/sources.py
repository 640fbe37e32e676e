"""Registered queries: SQL sources and any-statement passthrough."""

from __future__ import annotations

from ..operators import ModShards, PredicateShards, RangeShards
from ..sources import SqlSource, scalar
from .tables import table, views

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
PURCHASES_TEMPLATE = (
    "SELECT event_id, ts, user_id, event_type, value FROM IDENTIFIER(:source_table) "
    "WHERE event_type = :kind AND value > :floor"
)
PURCHASES_SQL = (
    "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'purchase' AND value > 50"
)

# One statement per category of SQL a source query may use. The text is the same for Spark
# and for the check. Keys that may be hot are aggregated (or ranked with a limit) before they
# meet a join, as one would write it for large tables.
PASSTHROUGH = {
    "pass_filter": (
        ("lineitem",),
        """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount
        FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1996-01-01 00:00:00'
          AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24 AND l_returnflag IN ('A', 'N')
        """,
    ),
    "pass_join": (
        ("orders", "customer", "nation", "region"),
        """
        WITH buyers AS (
          SELECT o_custkey, COUNT(*) AS orders_count, SUM(o_totalprice) AS total_price FROM orders GROUP BY o_custkey
        ), markets AS (
          SELECT c.c_nationkey, COUNT(*) AS customers, SUM(b.orders_count) AS orders_count,
                 SUM(b.total_price) AS total_price
          FROM customer c LEFT JOIN buyers b ON b.o_custkey = c.c_custkey
          GROUP BY c.c_nationkey
        )
        SELECT r.r_name AS region_name, n.n_name AS nation_name, CAST(COALESCE(m.customers, 0) AS BIGINT) AS customers,
               CAST(COALESCE(m.orders_count, 0) AS BIGINT) AS orders_count,
               ROUND(COALESCE(m.total_price, 0), 2) AS total_price
        FROM region r
        JOIN nation n ON n.n_regionkey = r.r_regionkey
        LEFT JOIN markets m ON m.c_nationkey = n.n_nationkey
        """,
    ),
    "pass_semi_anti": (
        ("customer", "orders"),
        """
        WITH buyers AS (
          SELECT o_custkey, MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent
          FROM orders GROUP BY o_custkey
        )
        SELECT c_custkey, 'with urgent' AS kind FROM customer
        WHERE EXISTS (SELECT 1 FROM buyers WHERE o_custkey = c_custkey AND urgent = 1)
        UNION ALL
        SELECT c_custkey, 'without orders' AS kind FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM buyers WHERE o_custkey = c_custkey)
        """,
    ),
    "pass_range_join": (
        ("part",),
        """
        SELECT b.band, CAST(COUNT(*) AS BIGINT) AS parts_count, MIN(p.p_retailprice) AS cheapest
        FROM part p
        JOIN (VALUES ('low', 0.0, 1000.0), ('mid', 1000.0, 1500.0), ('high', 1500.0, 100000.0)) AS b(band, lo, hi)
          ON p.p_retailprice >= b.lo AND p.p_retailprice < b.hi
        GROUP BY b.band
        """,
    ),
    "pass_agg": (
        ("lineitem",),
        """
        SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity), 2) AS sum_qty,
               ROUND(SUM(l_extendedprice), 2) AS sum_base_price,
               ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
               ROUND(AVG(l_discount), 6) AS avg_disc,
               CAST(COUNT(DISTINCT l_suppkey) AS BIGINT) AS suppliers,
               CAST(COUNT(*) AS BIGINT) AS count_order
        FROM lineitem
        GROUP BY l_returnflag, l_linestatus
        """,
    ),
    "pass_rollup": (
        ("orders",),
        """
        SELECT o_orderstatus, o_orderpriority, CAST(COUNT(*) AS BIGINT) AS orders_count,
               ROUND(SUM(o_totalprice), 2) AS total_price
        FROM orders
        GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
        """,
    ),
    "pass_window": (
        ("orders",),
        """
        SELECT o_custkey, o_orderkey, o_totalprice, CAST(nth AS BIGINT) AS nth
        FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nth FROM orders
        ) ranked
        WHERE nth <= 3
        """,
    ),
    "pass_topk": (
        ("orders",),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    ),
    "pass_setops": (
        ("customer", "supplier", "nation"),
        """
        (SELECT DISTINCT c_nationkey AS nationkey FROM customer
         INTERSECT SELECT DISTINCT s_nationkey AS nationkey FROM supplier)
        UNION
        (SELECT n_nationkey AS nationkey FROM nation
         EXCEPT SELECT DISTINCT s_nationkey AS nationkey FROM supplier)
        """,
    ),
    "pass_scalars": (
        ("part",),
        """
        SELECT p_partkey, UPPER(p_brand) AS brand, CAST(LENGTH(p_name) AS BIGINT) AS name_length,
               CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class,
               ABS(ROUND(p_retailprice - 1500, 2)) AS distance, COALESCE(NULLIF(p_size, 1), -1) AS size_or_minus
        FROM part
        """,
    ),
    "pass_cte": (
        ("lineitem",),
        """
        WITH revenue AS (
          SELECT l_suppkey, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS total
          FROM lineitem GROUP BY l_suppkey
        )
        SELECT l_suppkey, total FROM revenue WHERE total > (SELECT AVG(total) FROM revenue)
        """,
    ),
}


def src_query(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return SqlSource(query=ORDERS_SQL).load(spark)


def src_params(spark, sf_dir):
    views(spark, sf_dir, "events")
    source = SqlSource(
        template=PURCHASES_TEMPLATE,
        defaults={"kind": "view", "floor": 0.0, "source_table": "events"},
        params={"kind": "purchase"},
    )
    return source.load(spark, {"floor": 50.0})


def src_scalar(spark, sf_dir):
    """A looked-up scalar bound into a template, as a window bound would be."""
    views(spark, sf_dir, "events")
    newest = scalar(spark, "SELECT MAX(ts) FROM events WHERE event_type = 'error'")
    template = "SELECT event_id, ts, event_type FROM events WHERE ts >= :newest"
    return SqlSource(template=template, params={"newest": newest}).load(spark)


def jdbc_predicates(spark, sf_dir):
    """The predicate texts a parallel JDBC read would get, counted on the table itself."""
    orders = table(spark, sf_dir, "orders")
    layouts = {
        "mod": ModShards("o_orderkey", 4),
        "range": RangeShards("o_custkey", [(0, 300), (300, 900), (900, None)]),
    }
    counted = None
    for name, layout in layouts.items():
        rows = PredicateShards(layout.sql_predicates()).assign(orders).groupBy("shard_index").count()
        rows = rows.selectExpr(f"'{name}' AS layout", "shard_index", "count AS rows")
        counted = rows if counted is None else counted.unionAll(rows)
    return counted


def _passthrough(name):
    tables, text = PASSTHROUGH[name]

    def run(spark, sf_dir):
        views(spark, sf_dir, *tables)
        return SqlSource(query=text).load(spark)

    return run


QUERIES = {
    "src_query": src_query,
    "src_params": src_params,
    "src_scalar": src_scalar,
    "jdbc_predicates": jdbc_predicates,
    **{name: _passthrough(name) for name in PASSTHROUGH},
}

ORACLE = {
    "src_query": "SELECT * FROM orders",
    "src_params": PURCHASES_SQL,
    "src_scalar": """
        SELECT event_id, ts, event_type FROM events
        WHERE ts >= (SELECT MAX(ts) FROM events WHERE event_type = 'error')
    """,
    "jdbc_predicates": """
        SELECT 'mod' AS layout, CAST(o_orderkey % 4 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS rows
        FROM orders GROUP BY 2
        UNION ALL
        SELECT 'range' AS layout,
               CAST(CASE WHEN o_custkey < 300 THEN 0 WHEN o_custkey < 900 THEN 1 ELSE 2 END AS INTEGER) AS shard_index,
               CAST(COUNT(*) AS BIGINT) AS rows
        FROM orders GROUP BY 2
    """,
    **{name: text for name, (_, text) in PASSTHROUGH.items()},
}
