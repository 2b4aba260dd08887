"""Inputs derived from the driver's tables, written once as SQL expression text.

The same expression strings feed Spark (``selectExpr``) and the DuckDB oracle,
so both sides see identical data. The tables hold no NULLs, so gaps are
derived by key; every row of every table is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.files import read_table

# lineitem with NULL and NaN gaps (numeric, text and time columns)
GAPPY_LINEITEM = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity",
    "CASE WHEN l_partkey % 23 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS l_extendedprice",
    "CASE WHEN l_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_discount END AS l_discount",
    "l_tax",
    "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag",
    "l_linestatus",
    "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_shipdate END AS l_shipdate",
]

GAPPY_ORDERS = [
    "o_orderkey",
    "o_custkey",
    "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice",
    "o_orderdate",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
]

# boolean-like text: 'True' / 'False' / a number / junk
BOOL_TEXT_LINEITEM = [
    "l_orderkey",
    "l_linenumber",
    "CASE WHEN l_returnflag = 'R' THEN 'True' WHEN l_returnflag = 'A' THEN 'False' "
    "WHEN l_orderkey % 3 = 0 THEN 'x' ELSE CAST(l_linenumber AS STRING) END AS flag_text",
]

PRICE_TEXT_PART = [
    "p_partkey",
    "CASE WHEN p_partkey % 5 = 0 THEN 'n/a' WHEN p_partkey % 7 = 0 THEN '' "
    "ELSE CAST(p_retailprice AS STRING) END AS price_text",
]

# order date and ship date as 'yyyy-MM-dd HH:mm:ss' text; line 7 carries a fraction (unparsable)
TIME_TEXT_JOIN = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey",
    [
        "l_orderkey",
        "l_linenumber",
        "substr(CAST(o_orderdate AS STRING), 1, 19) AS start_text",
        "CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS STRING) || '.5' "
        "ELSE substr(CAST(l_shipdate AS STRING), 1, 19) END AS end_text",
    ],
)

# rule-based multi-class prediction for the metric queries (label: return flag)
RULE_PREDICTIONS = [
    "CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END AS label",
    "CASE WHEN l_shipdate >= TIMESTAMP '1995-06-17 00:00:00' THEN 1.0 "
    "WHEN l_discount < 0.05 THEN 0.0 ELSE 2.0 END AS prediction",
]

# whole texts, some NULL, empty or with blanks, quotes and codes that a CSV file must keep apart
AWKWARD_DOCUMENTS = [
    "doc_id",
    "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' "
    "WHEN doc_id % 5 = 0 THEN '  ' || chr(10) || ' \"a,b\" ' || chr(92) || 'n ' || chr(13) || text || ' ' ELSE text END AS text",
    "CASE WHEN doc_id % 3 = 0 THEN '\"' || lang ELSE lang END AS lang",
    "source",
    "n_chars",
]

# order lines with a text that holds a comma, for the declared layouts
LAYOUT_LINEITEM = ["l_linenumber AS k", "l_returnflag || ', \"' || l_linestatus || '\"' AS note"]

# graph: customers are nodes; an order line links its customer to the customer
# whose key equals the part key (unknown ends exist and are dropped on load)
GRAPH_NODES = [
    "c_custkey AS new_id",
    "c_nationkey AS days",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS mature",
    "c_acctbal AS views",
    "CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS partner",
]
GRAPH_RAW_EDGES = ("orders JOIN lineitem ON o_orderkey = l_orderkey", ["o_custkey AS `from`", "l_partkey AS `to`"])


def gappy_lineitem(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "lineitem").selectExpr(*GAPPY_LINEITEM)


def gappy_orders(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").selectExpr(*GAPPY_ORDERS)


def awkward_documents(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "documents").selectExpr(*AWKWARD_DOCUMENTS)


def layout_lineitem(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "lineitem").selectExpr(*LAYOUT_LINEITEM)


def bool_text_lineitem(spark, base):
    return read_table(spark, base, "lineitem").selectExpr(*BOOL_TEXT_LINEITEM)


def price_text_part(spark, base):
    return read_table(spark, base, "part").selectExpr(*PRICE_TEXT_PART)


def time_text(spark, base):
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(*TIME_TEXT_JOIN[1])


def rule_predictions(spark, base):
    return read_table(spark, base, "lineitem").selectExpr(*RULE_PREDICTIONS)


def graph_node_table(spark, base):
    return read_table(spark, base, "customer").selectExpr(*GRAPH_NODES)


def graph_raw_edges(spark, base):
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    return o.join(li, o.o_orderkey == li.l_orderkey).selectExpr(*GRAPH_RAW_EDGES[1])


def sql_select(exprs: list[str], source: str) -> str:
    return "SELECT " + ", ".join(exprs) + " FROM " + source
