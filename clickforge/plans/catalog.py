"""Registry of the queries and of the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return register


# The impressions view in SQL; see ``views.impressions``.
IMP = """
imp0 AS (
  SELECT event_id AS row_id, user_id, event_type, ts, value,
         CASE WHEN event_type = 'click' THEN 1e0 ELSE 0e0 END AS label,
         CAST(ts AS DATE) AS dt, CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         ((event_id % 2147483648) * 1103515245 + 12345) % 2147483648 AS mix
  FROM events),
imp AS (
  SELECT *, CASE WHEN k % 7 <> 0 THEN k END AS k_seen,
         1e-2 * value - 2e-2 * hour_of_day - 1.4e0 AS margin0,
         round(1e0 / (1e0 + exp(-(1e-2 * value - 2e-2 * hour_of_day - 1.4e0))), 9) AS score,
         CASE WHEN ((value > 50 AND hour_of_day < 12) OR k > 70) <> ((((mix // 65536) + (mix % 65536) * 32768) * 1103515245 + 12345) % 2147483648 < 214748364) THEN 1 ELSE 0 END AS planted,
         CASE WHEN mix < 1717986918 THEN 'train' WHEN mix < 1932735283 THEN 'eval' ELSE 'test' END AS split
  FROM imp0)"""

# Sparse rows in long form; see ``views.sparse_rows``.
SPARSE = IMP + """,
sparse AS (
  SELECT row_id, 0 AS f, CAST(value AS DOUBLE) AS v FROM imp WHERE value IS NOT NULL
  UNION ALL SELECT row_id, 1, CAST(k_seen AS DOUBLE) FROM imp WHERE k_seen IS NOT NULL
  UNION ALL SELECT row_id, 2 + hour_of_day, 1e0 FROM imp
  UNION ALL SELECT row_id, CASE event_type WHEN 'click' THEN 26 WHEN 'error' THEN 27 WHEN 'purchase' THEN 28
                                           WHEN 'signup' THEN 29 ELSE 30 END, 1e0 FROM imp)"""

# The three fixed trees as CASE; see ``views.FIXED_TREES``.
LEAVES = IMP + """,
leaves AS (
  SELECT *,
    CASE WHEN value < 50 THEN CASE WHEN k_seen < 30 THEN 3 ELSE 4 END
         ELSE CASE WHEN hour_of_day = 10 THEN 6 ELSE 5 END END AS l0,
    CASE WHEN k_seen < 70 THEN 1 WHEN value < 20 THEN 3 ELSE 4 END AS l1,
    CASE WHEN event_type = 'click' THEN 2 WHEN value < 100 THEN 3 ELSE 4 END AS l2
  FROM imp),
leaf_long AS (
  SELECT row_id, 0 AS tree, l0 AS leaf FROM leaves UNION ALL SELECT row_id, 1, l1 FROM leaves
  UNION ALL SELECT row_id, 2, l2 FROM leaves),
leaf_value(tree, leaf, leaf_value) AS (
  VALUES (0, 3, -0.4e0), (0, 4, 0.1e0), (0, 5, 0.25e0), (0, 6, 0.9e0), (1, 1, -0.3e0), (1, 3, 0.2e0), (1, 4, 0.7e0),
         (2, 2, 0.35e0), (2, 3, -0.15e0), (2, 4, 0.05e0)),
scored AS (
  SELECT s.*, v0.leaf_value + v1.leaf_value + v2.leaf_value AS margin, v0.leaf_value AS first_margin
  FROM leaves s
  JOIN leaf_value v0 ON v0.tree = 0 AND v0.leaf = s.l0
  JOIN leaf_value v1 ON v1.tree = 1 AND v1.leaf = s.l1
  JOIN leaf_value v2 ON v2.tree = 2 AND v2.leaf = s.l2),
path(tree, leaf, node) AS (
  VALUES (0, 3, 3), (0, 3, 1), (0, 3, 0), (0, 4, 4), (0, 4, 1), (0, 4, 0), (0, 5, 5), (0, 5, 2), (0, 5, 0),
         (0, 6, 6), (0, 6, 2), (0, 6, 0), (1, 1, 1), (1, 1, 0), (1, 3, 3), (1, 3, 2), (1, 3, 0), (1, 4, 4), (1, 4, 2),
         (1, 4, 0), (2, 2, 2), (2, 2, 0), (2, 3, 3), (2, 3, 1), (2, 3, 0), (2, 4, 4), (2, 4, 1), (2, 4, 0)),
split_feature(tree, node, feature) AS (
  VALUES (0, 0, 0), (0, 1, 1), (0, 2, 12), (1, 0, 1), (1, 2, 0), (2, 0, 26), (2, 1, 0))"""

ORDER_LINES = """
ol AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey)"""
