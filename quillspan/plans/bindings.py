"""Evidence relations derived from the driver's tables.

Each is one SQL text that Spark and DuckDB read alike; ``{name}`` stands for a table. The tables
hold no evidence of their own, so operators are shown on these deterministic stand-ins.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Ranked hits of templates on proteins, with ranges, scores and families.
HITS = """
SELECT l_suppkey AS protein,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS line_no,
       l_partkey AS template, p_brand AS family,
       CAST(1 + l_orderkey % 100 AS INT) AS qs, CAST(l_orderkey % 100 + CAST(l_quantity AS INT) AS INT) AS qe,
       CAST(1 + l_partkey % 37 AS INT) AS ts, l_extendedprice / 5000 AS z, l_extendedprice AS evalue, l_discount * 1000 AS prob
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey
"""
#: Residue sets of entities.
RESIDS = "SELECT DISTINCT user_id AS entity, CAST(1 + (event_id * 7) % 211 AS INT) AS resid FROM {events}"
#: Two segments per domain, five domains per protein.
DOMAIN_SEGS = """
SELECT s_suppkey AS protein, r_regionkey AS domain,
       CAST(1 + (s_suppkey * 13 + r_regionkey * 29) % 90 AS INT) AS a1,
       CAST((s_suppkey * 13 + r_regionkey * 29) % 90 + 12 + (s_suppkey * 7 + r_regionkey * 11) % 30 AS INT) AS a2,
       CAST(1 + (s_suppkey * 13 + r_regionkey * 29) % 90 + 12 + (s_suppkey * 7 + r_regionkey * 11) % 30 + 3 + (s_suppkey + r_regionkey * 5) % 18 AS INT) AS b1,
       CAST((s_suppkey * 13 + r_regionkey * 29) % 90 + 12 + (s_suppkey * 7 + r_regionkey * 11) % 30 + 3 + (s_suppkey + r_regionkey * 5) % 18 + 8 + (s_suppkey * 3 + r_regionkey) % 20 AS INT) AS b2
FROM {supplier} CROSS JOIN {region}
"""
#: Structure codes along entities.
CODES = """
SELECT entity, pos, CASE WHEN (pos + entity) % 13 = 0 THEN '-' WHEN (CAST(pos + entity AS BIGINT) % 30) < 11 THEN 'H' WHEN (CAST(pos + entity AS BIGINT) % 30) < 18 THEN 'E' WHEN (CAST(pos + entity AS BIGINT) % 30) < 20 THEN '-' WHEN (CAST(pos + entity AS BIGINT) % 30) < 23 THEN 'B' ELSE 'T' END AS code
FROM (SELECT user_id AS entity, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM {events}) AS e
"""
#: Residues with contact counts and hit marks, dense from 1.
PROFILE = """
SELECT user_id AS protein, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS resid,
       CAST(event_id % 9 AS BIGINT) AS contacts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS hit
FROM {events}
"""
#: Residues of a chain with pair errors, and of the longest chain that a hit can need.
CHAIN, MOST = 60, 160


def errors(chain: int) -> str:
    """Pair errors between the residues of every protein's chain of ``chain`` residues."""
    return f"""
SELECT s_suppkey AS protein, CAST(r1 AS INT) AS r1, CAST(r2 AS INT) AS r2, CAST((s_suppkey * 31 + r1 * 7 + r2 * 13) % 300 AS DOUBLE) / 10 AS err
FROM {{supplier}} CROSS JOIN range(1, {chain + 1}) AS a(r1) CROSS JOIN range(1, {chain + 1}) AS b(r2) WHERE r1 < r2
"""


ERRORS = errors(CHAIN)
#: Points of chains.
ATOMS = """
SELECT CAST(label AS BIGINT) AS protein, CAST(vec_id AS INT) AS resid, CAST(embedding[{base}] AS DOUBLE) * 50 AS x, CAST(embedding[{base} + 1] AS DOUBLE) * 50 AS y, CAST(embedding[{base} + 2] AS DOUBLE) * 50 AS z
FROM {embeddings}
"""
#: Merge pairs: consecutive lines of an order.
EDGES = """
SELECT protein, a, b FROM (
  SELECT l_orderkey AS protein, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM {lineitem}) AS e
WHERE b IS NOT NULL AND a <> b
"""
#: Predictions of topologies for domains.
PREDICTIONS = """
SELECT l_suppkey AS protein, CAST(l_orderkey % 7 AS BIGINT) AS domain, concat(CAST(p_size % 5 AS VARCHAR(9)), '.', CAST(l_partkey % 3 AS VARCHAR(9)), '.', CAST(l_partkey % 4 AS VARCHAR(9))) AS tgroup,
       l_partkey AS template, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS line_no,
       CAST((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 5) % 1000 AS DOUBLE) / 1000 AS prob
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey
"""

_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def bind(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The relation over the Parquet tables of a folder."""
    used = [n for n in _NAMES if f"{{{n}}}" in text]
    return spark.sql(text.replace("{base}", "0"), **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in used})


def duck(text: str) -> str:
    """The same text for DuckDB, whose arrays start at 1."""
    return re.sub(r"\{(\w+)\}", r"\1", text.replace("{base}", "1"))
