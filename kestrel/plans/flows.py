"""End-to-end flows over the driver's tables.

* batch: profile -> impute -> encode -> split -> classifier -> metrics
  (the accidents notebook's steps, on lineitem: label = return flag)
* graph: load -> merge -> node scores -> export -> oversample -> classifiers
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import balance, clean, evaluate, features, graph, models
from kestrel.plans import fixtures
from kestrel.session import cut_lineage

BATCH_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BATCH_FEATURES = BATCH_NUMERIC + ["l_shipdateVec", "l_linestatusVec"]
BATCH_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def prepared_lineitem(spark: SparkSession, base: str) -> DataFrame:
    """Clean and encode lineitem with gaps: mean/mode imputation, drop rows
    still missing (NaN), lower-case, epoch seconds, string index."""
    df = fixtures.gappy_lineitem(spark, base)
    df = clean.impute_mean(df, BATCH_NUMERIC)
    df = clean.impute_mode(df, ["l_returnflag", "l_linestatus"])
    df = clean.drop_missing_rows(df)
    df = clean.lower_columns(df, ["l_linestatus"])
    # written once: index fit, training and test sides read this table
    df = cut_lineage(features.add_epoch_seconds(df, ["l_shipdate"]))
    df, _ = features.string_index(df, ["l_linestatus", "l_returnflag"])
    return df.withColumnRenamed("l_returnflagVec", "label_idx")


def batch_split(spark: SparkSession, base: str):
    df = prepared_lineitem(spark, base)
    train, test = balance.hash_split(df, BATCH_KEYS, 0.7)
    asm = lambda d: features.assemble(d, BATCH_FEATURES, label="label_idx", keep=BATCH_KEYS)
    return asm(train), asm(test)


def batch_classifier_metrics(spark: SparkSession, base: str, max_iter: int = 100, reg: float = 0.3, en: float = 0.8) -> DataFrame:
    """Logistic regression (the notebook's settings) on the cleaned table; one metrics row."""
    train, test = batch_split(spark, base)
    model = models.logistic(train, max_iter, reg, en)
    return evaluate.weighted_metrics(models.score(model, test)).withColumn("model", F.lit("logistic"))


# ---------------------------------------------------------------- graph


def graph_frames(spark: SparkSession, base: str):
    """``(nodes, loaded_edges, merged_edges)`` from the customer/order tables."""
    nodes = graph.load_nodes(fixtures.graph_node_table(spark, base))
    loaded = graph.load_edges(fixtures.graph_raw_edges(spark, base), nodes)
    merged = graph.merge_edges(loaded)
    return nodes, loaded, merged


GRAPH_FULL = ["betweenness", "days", "louvain", "pageRank", "partner", "triangles", "views", "node2vec[0]", "node2vec[1]"]
GRAPH_BASIC = ["days", "partner", "views"]


def graph_node_features(spark: SparkSession, base: str) -> DataFrame:
    """Nodes with betweenness, PageRank, Louvain, triangles and node2vec columns, computed from the tables."""
    nodes, _, merged = graph_frames(spark, base)
    nodes, merged = cut_lineage(nodes), cut_lineage(merged)
    # the parts do not need each other: small stages of one fill the cores that another leaves idle. The training alone
    # waits for Louvain, whose many short rounds would each queue behind its long tasks
    parts = {
        "walks": lambda: cut_lineage(graph.random_walks(nodes, merged)),
        "louvain": lambda: graph.louvain(nodes, merged, task_nodes=graph.TASK_NODES)[0].withColumnRenamed("community", "louvain"),
        "betweenness": lambda: cut_lineage(graph.betweenness(nodes, merged)),
        "pagerank": lambda: graph.pagerank(nodes, merged).withColumnRenamed("pagerank", "pageRank"),
        "triangles": lambda: cut_lineage(graph.triangles(nodes, merged)),
    }
    same_properties = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(parts)) as pool:
        jobs = {name: pool.submit(same_properties(part) if callable(same_properties) else part) for name, part in parts.items()}
        jobs["louvain"].result()
        vectors = graph.node2vec(nodes, merged, walks=jobs["walks"].result())
    done = {name: job.result() for name, job in jobs.items()} | {"node2vec": vectors}
    return cut_lineage(graph.node_features(nodes, **{name: done[name] for name in ("betweenness", "pagerank", "louvain", "triangles", "node2vec")}))


def classifier_frame(features_table: DataFrame) -> DataFrame:
    """Feature columns as doubles, label and id. Every node has every score, so nothing is filled; a gap fails in the assembler."""
    feats = features.expand_array(features_table, "node2vec", 2)
    return feats.select(
        *[F.col(f"`{c}`").cast("double").alias(c) for c in GRAPH_FULL], F.col("mature").cast("int").alias("label"), "id"
    )


def graph_classifier_comparison(spark: SparkSession, base: str, model: str = "forest") -> DataFrame:
    """Classifier on all graph features vs. the three plain node properties.

    Split first (hash of the node id), then oversample the training side only.
    """
    feats = classifier_frame(graph_node_features(spark, base))
    train, test = balance.hash_split(feats, ["id"], 0.7)
    train = balance.oversample(train, "label")
    kw = dict(max_depth=20, num_trees=21, seed=42) if model == "forest" else dict(max_iter=1000, reg_param=0.03, elastic_net=0.3)
    return models.compare_feature_sets(train, test, {"graph": GRAPH_FULL, "basic": GRAPH_BASIC}, "label", model, **kw)
