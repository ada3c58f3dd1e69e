"""Domain tables over the supplied ones, as SQL that Spark and an independent engine both read.

Only the inputs are shared text; each query states its own work in DataFrames, and its check states it in SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = tuple("region nation customer supplier part orders lineitem events documents pages benchmark labels conversations embeddings".split())

FIXTURES = {
    # One call row a line item: services, chains, generics, platform calls, sentinels and nulls by key.
    "calls": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               concat('File', CAST(l_suppkey % 7 AS VARCHAR(9)), '.java') AS file_name,
               concat('Svc', CAST(l_suppkey % 5 AS VARCHAR(9))) AS class_interface_name,
               CASE l_linenumber % 4 WHEN 0 THEN 'class' WHEN 1 THEN 'class_implements_interface' WHEN 2 THEN 'interface' ELSE 'enum' END AS type,
               concat('m', CAST(l_partkey % 11 AS VARCHAR(9))) AS method_name,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 'int a' ELSE 'List<String> a, int b' END AS parameters,
               CASE l_partkey % 3 WHEN 0 THEN 'private' WHEN 1 THEN 'public' ELSE 'default' END AS access,
               CASE WHEN l_partkey % 4 = 0 THEN '@Override' ELSE NULL END AS annotations,
               CASE WHEN l_partkey % 17 = 0 THEN NULL
                    WHEN l_partkey % 13 = 0 THEN 'None'
                    WHEN l_partkey % 10 = 0 THEN concat('this.m', CAST(l_suppkey % 9 AS VARCHAR(9)), '()')
                    WHEN l_partkey % 10 = 1 THEN concat('logger.info(', CAST(l_partkey AS VARCHAR(9)), ')')
                    WHEN l_partkey % 10 = 2 THEN concat('List<Svc', CAST(l_suppkey % 5 AS VARCHAR(9)), '>.fetch(x.y)')
                    WHEN l_partkey % 10 = 3 THEN concat('svc', CAST(l_suppkey % 5 AS VARCHAR(9)), '.m', CAST(l_partkey % 11 AS VARCHAR(9)), '()')
                    WHEN l_partkey % 10 = 4 THEN concat('Svc', CAST(l_suppkey % 5 AS VARCHAR(9)), '.m', CAST(l_partkey % 11 AS VARCHAR(9)), '()')
                    WHEN l_partkey % 10 = 5 THEN concat('repo', CAST(l_suppkey % 3 AS VARCHAR(9)), '.dao.find(', CAST(l_orderkey % 100 AS VARCHAR(9)), ').next()')
                    WHEN l_partkey % 10 = 6 THEN concat('m', CAST(l_partkey % 11 AS VARCHAR(9)), '()')
                    WHEN l_partkey % 10 = 7 THEN concat('Svc', CAST(l_suppkey % 5 AS VARCHAR(9)), '.equals(x)')
                    WHEN l_partkey % 10 = 8 THEN concat('super.m', CAST(l_partkey % 11 AS VARCHAR(9)), '(a.b(), 1)')
                    ELSE concat('Ext', CAST(l_suppkey % 4 AS VARCHAR(9)), '.run()') END AS object_call,
               CAST(l_quantity AS INT) AS loc
        FROM {lineitem}""",
    # Variables of files: a supplier's name is a variable whose type is its nation's service.
    "var_types": """
        SELECT concat('File', CAST(s_suppkey % 7 AS VARCHAR(9)), '.java') AS file_name, concat('svc', CAST(s_suppkey % 5 AS VARCHAR(9))) AS var,
               CASE WHEN s_nationkey % 6 = 0 THEN 'List<Item>' ELSE concat('Svc', CAST(s_nationkey % 5 AS VARCHAR(9))) END AS type, s_suppkey AS pos
        FROM {supplier}""",
    # Return types: each nation is a class that declares a few methods; its parent is its region.
    "returns": """
        SELECT concat('Svc', CAST(n_nationkey % 5 AS VARCHAR(9))) AS cls, concat('m', CAST((n_nationkey * 3) % 11 AS VARCHAR(9))) AS method,
               CASE WHEN n_nationkey % 4 = 0 THEN 'void' ELSE concat('com.app.Svc', CAST((n_nationkey + 1) % 5 AS VARCHAR(9))) END AS ret, CAST(n_nationkey AS BIGINT) AS pos
        FROM {nation}""",
    "parents": """
        SELECT concat('Svc', CAST(r_regionkey AS VARCHAR(9))) AS cls, concat('Svc', CAST((r_regionkey + 2) % 5 AS VARCHAR(9))) AS parent FROM {region} WHERE r_regionkey <> 3""",
    # A call graph: the binary tree over parts, and edges back to ancestors.
    "nodes": """
        SELECT p_partkey AS id, concat('Cls', CAST(p_partkey % 7 AS VARCHAR(9))) AS cls, concat('m', CAST(p_partkey AS VARCHAR(9))) AS mth, p_size AS loc FROM {part}""",
    "edges": """
        SELECT CAST(floor((p_partkey - 1) / 2) AS BIGINT) AS src, p_partkey AS dst FROM {part} WHERE p_partkey > 0
        UNION ALL SELECT p_partkey, CAST(floor(p_partkey / 4) AS BIGINT) FROM {part} WHERE p_partkey % 50 = 49""",
    # The same graph by names: a quarter of the calls are bare, and every eighth method stands in an interface too.
    "named_calls": """
        SELECT concat(s.cls, '.', s.mth) AS caller, CASE WHEN e.dst % 4 = 1 THEN concat(d.mth, '()') ELSE concat(d.cls, '.', d.mth) END AS callee
        FROM {edges} e JOIN {nodes} s ON s.id = e.src JOIN {nodes} d ON d.id = e.dst""",
    "named_methods": """
        SELECT cls, mth, 'class' AS type, CASE WHEN id % 3 = 0 THEN 'private' ELSE 'public' END AS access, '' AS annotations FROM {nodes}
        UNION ALL SELECT 'Api', mth, 'interface', 'default', '' FROM {nodes} WHERE id % 8 = 1""",
    # Details: no call, single calls with and without arguments, bare ones, and chains of three to six calls.
    "details": """
        SELECT p_partkey AS id, concat('File', CAST(p_partkey % 7 AS VARCHAR(9)), '.java') AS file_name,
               CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN concat('Svc', CAST(p_partkey % 5 AS VARCHAR(9)), '<A>.m', CAST(p_partkey % 11 AS VARCHAR(9)), '(a, 1)')
                    WHEN 2 THEN concat('Svc', CAST(p_partkey % 5 AS VARCHAR(9)), '.m', CAST(p_partkey % 11 AS VARCHAR(9))) WHEN 3 THEN concat('m', CAST(p_partkey % 11 AS VARCHAR(9)), '(x.y)')
                    ELSE concat('Svc', CAST(p_partkey % 5 AS VARCHAR(9)), '.m', CAST(p_partkey % 11 AS VARCHAR(9)), '(a.b).m', CAST((p_partkey * 3) % 11 AS VARCHAR(9)), '().m', CAST((p_partkey * 7) % 11 AS VARCHAR(9)), '(1)',
                         CASE WHEN p_partkey % 8 > 4 THEN concat('.m', CAST((p_partkey * 2) % 11 AS VARCHAR(9)), '()') ELSE '' END, CASE WHEN p_partkey % 8 > 5 THEN concat('.m', CAST((p_partkey * 5) % 11 AS VARCHAR(9)), '(c)') ELSE '' END,
                         CASE WHEN p_partkey % 8 > 6 THEN concat('.m', CAST((p_partkey * 4) % 11 AS VARCHAR(9)), '()') ELSE '' END) END AS object_call
        FROM {part}""",
    # Token lists: a line item is a method of its order's chunk; an order's child is the customer's next order.
    "tokens": """
        SELECT l_orderkey AS chunk, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
               CASE WHEN l_partkey % 23 = 0 THEN concat('GRP-', CAST(l_partkey % 9 AS VARCHAR(9)), ' no_of_lines : ', CAST(CAST(l_quantity AS INT) AS VARCHAR(9)))
                    WHEN l_partkey % 19 = 0 THEN concat('part', CAST(l_partkey % 60 AS VARCHAR(9)), ' no_of_lines : Nil')
                    WHEN l_partkey % 29 = 0 THEN concat('C', lpad(CAST(l_partkey % 1000 AS VARCHAR(9)), 3, '0'), '_chunk')
                    WHEN l_partkey % 31 = 0 THEN concat('plain', CAST(l_partkey % 60 AS VARCHAR(9)))
                    ELSE concat('part', CAST(l_partkey % 60 AS VARCHAR(9)), ' no_of_lines : ', CAST(CAST(l_quantity AS INT) AS VARCHAR(9))) END AS token,
               l_quantity AS quantity, l_extendedprice AS price, l_shipdate AS shipped
        FROM {lineitem}""",
    "chunk_edges": """
        SELECT o_orderkey AS parent, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS child, concat('entity', CAST(o_custkey % 100 AS VARCHAR(9))) AS entity FROM {orders}""",
    # Paths of four levels.
    "paths": """
        SELECT o_orderkey AS id, concat('R', CAST(n_regionkey AS VARCHAR(9)), '.r') AS l1, concat('N', CAST(n_nationkey AS VARCHAR(9)), '.n no_of_lines : ', CAST(n_nationkey % 3 AS VARCHAR(9))) AS l2,
               concat('C', CAST(c_custkey AS VARCHAR(9)), '.c') AS l3, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('O', CAST(o_orderkey % 50 AS VARCHAR(9)), '.o no_of_lines : 0') END AS l4
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
}


def sql_of(text: str) -> str:
    """The text over the supplied tables alone, for the independent engine."""
    while found := re.findall(r"\{([a-z]\w*)\}", text):
        for name in set(found):
            text = text.replace("{" + name + "}", name if name in TABLES else f"({FIXTURES[name]})")
    return text


class Tables:
    """Supplied tables and fixtures of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.sql(FIXTURES[name])

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: getattr(self, name) for name in set(re.findall(r"\{([a-z]\w*)\}", text))})
