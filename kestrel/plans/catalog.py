"""The query catalog: one callable per operator group, ``(spark, base) -> DataFrame``.

Every query reads the driver's tables (or frames Spark derives from them)
in full. Floating results that depend on summation order are rounded to 6
decimals, the same way in the SQL oracle.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kestrel.functions.columns import bool_text_to_int
from kestrel.operators import balance, certificates, clean, evaluate, features, graph, models, profile
from kestrel.plans import fixtures, flows
from kestrel.session import cut_lineage, scratch_path
from kestrel.sources import files
from kestrel.sources.files import read_table
from kestrel.sources.schemas import ACCIDENTS_SCHEMA, ENCODED_ACCIDENTS_SCHEMA
from kestrel.streaming import stream

R = 6


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), R) for c in cols})


# ---------------------------------------------------------------- profile


def q_shape(spark, base):
    return profile.shape(read_table(spark, base, "lineitem"))


def q_schema_table(spark, base):
    return profile.schema_table(read_table(spark, base, "lineitem"))


def q_missing_counts(spark, base):
    return profile.missing_counts(fixtures.gappy_lineitem(spark, base))


def q_summary_numeric(spark, base):
    s = profile.summary(read_table(spark, base, "lineitem"))
    return _round(s, ["mean", "stddev"])


def q_summary_text(spark, base):
    return profile.summary_text(fixtures.gappy_orders(spark, base))


def q_value_counts(spark, base):
    return profile.value_counts(read_table(spark, base, "orders"), ["o_orderstatus", "o_orderpriority"])


def q_modes(spark, base):
    return profile.modes(read_table(spark, base, "part"), ["p_name", "p_brand", "p_type"])


def q_modes_with_nulls(spark, base):
    return profile.modes(fixtures.gappy_orders(spark, base), ["o_orderstatus", "o_orderpriority"])


def q_correlation(spark, base):
    return _round(profile.correlation(read_table(spark, base, "lineitem")), ["corr"])


def q_correlation_gaps(spark, base):
    """Pairs with NULL gaps: rows where either side is missing are skipped."""
    li = fixtures.gappy_lineitem(spark, base).select("l_quantity", "l_tax", "l_linenumber")
    return _round(profile.correlation(li), ["corr"])


def q_spearman(spark, base):
    return _round(profile.correlation(read_table(spark, base, "part").select("p_size", "p_retailprice"), method="spearman"), ["corr"])


def q_spearman_gaps(spark, base):
    """Rank correlation of columns with NULLs in different rows, each pair over its own complete rows."""
    li = fixtures.gappy_lineitem(spark, base).select("l_quantity", "l_tax", "l_linenumber")
    return _round(profile.correlation(li, method="spearman"), ["corr"])


def q_string_index_inverse(spark, base):
    """the index table turns indices back into the text they came from."""
    p = read_table(spark, base, "part").select("p_partkey", "p_brand")
    out, index = features.string_index(p, ["p_brand"])
    return index.inverse(out.drop("p_brand"), "p_brand", "p_brand")


def q_top_orders(spark, base):
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return profile.top_n(o, 20, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# ---------------------------------------------------------------- clean


def q_project(spark, base):
    return clean.project(read_table(spark, base, "orders"), ["o_orderpriority", "o_orderkey", "o_totalprice"])


def q_rename(spark, base):
    return clean.rename(read_table(spark, base, "labels"), {"quality": "is_good", "toxic": "is_toxic"})


def q_drop_columns(spark, base):
    return clean.drop_columns(read_table(spark, base, "lineitem"), ["L_COMMENT", "l_Tax", "L_SHIPDATE", "l_returnFLAG"])


def q_drop_missing(spark, base):
    return clean.drop_missing_rows(fixtures.gappy_lineitem(spark, base))


def q_to_double(spark, base):
    return clean.cast_to_double(fixtures.price_text_part(spark, base), ["price_text"]).withColumnRenamed("price_text", "price")


def q_bool_text(spark, base):
    df = fixtures.bool_text_lineitem(spark, base)
    return df.withColumn("flag", bool_text_to_int("flag_text"))


def q_lower_columns(spark, base):
    return clean.lower_columns(read_table(spark, base, "part"), ["p_name", "p_brand", "p_type"])


def q_impute_mean(spark, base):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    out = clean.impute_mean(fixtures.gappy_lineitem(spark, base), cols)
    return _round(out, cols)


def q_impute_overrides(spark, base):
    """C1 with literal means; a filled integer column becomes double."""
    li = fixtures.gappy_lineitem(spark, base)
    li = li.withColumn("line_gap", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_linenumber")))
    out = clean.impute_mean(li, ["l_quantity", "line_gap"], overrides={"l_quantity": 25.5, "l_discount": 0.05})
    return _round(out, ["line_gap"])


def q_impute_mode(spark, base):
    return clean.impute_mode(fixtures.gappy_orders(spark, base), ["o_orderstatus", "o_orderpriority"])


# ---------------------------------------------------------------- features


def q_token_counts(spark, base):
    docs = features.add_tokens(read_table(spark, base, "documents"), "text", "tokens")
    return docs.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def q_doc_token_stats(spark, base):
    docs = features.add_tokens(read_table(spark, base, "documents"), "text", "tokens")
    return docs.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.size(F.filter("tokens", lambda t: t == F.lit(""))).cast("long").alias("n_empty"),
    )


def q_epoch_duration(spark, base):
    t = fixtures.time_text(spark, base)
    t = features.add_epoch_seconds(t, ["start_text", "end_text"], suffix="_s", drop=False)
    t = features.add_duration(t, "start_text_s", "end_text_s", "duration_s", drop=False)
    return t.select("l_orderkey", "l_linenumber", F.col("start_text_s").alias("start_s"), F.col("end_text_s").alias("end_s"), "duration_s")


def q_parse_vector(spark, base):
    e = read_table(spark, base, "embeddings")
    text = e.select("vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("embedding"))
    parsed = features.add_parsed_vector(text, "embedding")
    return features.expand_array(parsed, "embedding", 64)


def q_string_index(spark, base):
    p = read_table(spark, base, "part").select("p_partkey", "p_brand", "p_type")
    out, _ = features.string_index(p, ["p_brand", "p_type"])
    return out


def q_one_hot(spark, base):
    o = read_table(spark, base, "orders").select("o_orderkey", "o_orderpriority")
    idx, _ = features.string_index(o, ["o_orderpriority"])
    hot, _ = features.one_hot(idx, ["o_orderpriorityVec"])
    pos = F.array_position(vector_to_array("o_orderpriorityVecHot"), F.lit(1.0))
    return hot.select("o_orderkey", "o_orderpriority", F.when(pos > 0, pos - 1).cast("long").alias("hot_slot"))


def q_assemble(spark, base):
    li = read_table(spark, base, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    v = features.assemble(li, cols, label="l_linenumber", keep=["l_orderkey"])
    arr = vector_to_array("features")
    return v.select("l_orderkey", "label", *[arr[i].alias(f"f{i}") for i in range(len(cols))])


def q_text_embedding(spark, base):
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    out, _ = features.text_embedding(docs, "text", "text_vec")
    return out.select("doc_id", vector_to_array("text_vec").alias("text_vec"))


# ---------------------------------------------------------------- balance / evaluate


def q_hash_split(spark, base):
    """Rows and quantity of either side, in one scan grouped by the side."""
    li = read_table(spark, base, "lineitem")
    side = F.when(balance.split_side(["l_orderkey", "l_linenumber"], 0.7), F.lit("train")).otherwise(F.lit("test"))
    return li.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


def q_random_split(spark, base):
    """F5 with Spark's seeded sampler: the two sides make up the table, each row on one side."""
    li = read_table(spark, base, "lineitem")
    train, test = balance.random_split(li, (0.7, 0.3), seed=42)
    both = train.withColumn("side", F.lit(1)).unionByName(test.withColumn("side", F.lit(1)))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"), F.sum("l_orderkey").alias("sum_keys"))


def q_replicate(spark, base):
    return balance.replicate(read_table(spark, base, "labels"), 3)


def q_oversample(spark, base):
    return balance.oversample(read_table(spark, base, "labels"), "quality")


def q_class_ratio(spark, base):
    return balance.class_ratio(read_table(spark, base, "labels"), "quality")


def q_label_counts(spark, base):
    return balance.label_counts(balance.oversample(read_table(spark, base, "labels"), "quality"), "quality")


def q_weighted_metrics(spark, base):
    m = evaluate.weighted_metrics(fixtures.rule_predictions(spark, base))
    return _round(m, ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1"])


def q_accuracy(spark, base):
    return _round(evaluate.accuracy(fixtures.rule_predictions(spark, base)), ["accuracy"])


# ---------------------------------------------------------------- models (row checks)


def q_logistic(spark, base):
    """M1 with the notebook's settings: every test row scored, per label."""
    train, test = flows.batch_split(spark, base)
    return models.scored_rows(models.score(models.logistic(train), test))


def q_logistic_optimum(spark, base):
    """M1: the fitted model meets the optimality condition of its penalised loss on its training rows."""
    enc = _encoded_lineitem(spark, base).select(
        *[(F.col(c) / s).alias(c) for c, s in (("l_quantity", 50.0), ("l_discount", 0.1), ("l_tax", 0.08))],
        (F.col("ship_s") / 1e9).alias("ship_s"), F.col("flag_n").alias("label"),
    )
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax", "ship_s"], outputCol="features").transform(enc).select("features", "label")
    model = LogisticRegression(maxIter=500, regParam=0.001, elasticNetParam=0.0, standardization=False, tol=1e-12).fit(rows)
    worst = models.logistic_gradient(model, rows, 0.001)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.lit(worst < 1e-4).alias("optimal"))


def _node_rows(spark, base):
    """Nodes with their plain properties as features; label: mature."""
    nodes = graph.load_nodes(fixtures.graph_node_table(spark, base))
    flat = nodes.select(F.col("id"), *[F.col(c).cast("double").alias(c) for c in flows.GRAPH_BASIC], F.col("mature").cast("int").alias("label"))
    flat = cut_lineage(flat)
    return features.assemble(flat, flows.GRAPH_BASIC, label="label", keep=["id"])


def q_elastic_net_optimum(spark, base):
    """At the settings in use, (.3, .8) on the batch flow and (.03, .3) on nodes, models meet the elastic net's optimality condition."""
    train, _ = flows.batch_split(spark, base)
    train = cut_lineage(train.select("features", "label"))
    nodes = _node_rows(spark, base)
    out = None
    for name, rows, (most, reg, net) in (("batch", train, (100, 0.3, 0.8)), ("graph", nodes, (1000, 0.03, 0.3))):
        model = models.logistic(rows, most, reg, net)
        worst = certificates.elastic_net_residual(model, rows, reg, net)
        row = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("setting"), "n", F.lit(worst < 1e-3).alias("optimal"))
        out = row if out is None else out.unionByName(row)
    return out


def q_forest_replay(spark, base):
    """M3/M8: depth 20, 21 trees: every split's gain, the importances and the votes of all rows follow from the saved trees."""
    rows = _node_rows(spark, base)
    model = models.forest(rows, max_depth=20, num_trees=21, seed=42)
    seen = certificates.forest_certificate(model, rows, "id", models.feature_names(rows))
    return seen.select("feature", "splits_fit", "importance_fits", "votes_fit")


def q_perceptron(spark, base):
    train, test = flows.batch_split(spark, base)
    m = models.perceptron(train, hidden=(16,), max_iter=100)
    return models.scored_rows(models.score(m, test))


def q_perceptron_certificate(spark, base):
    """M2: trained on scaled lineitem columns to tell large discounted quantities, the layers' loss is below the labels' entropy, and
    their backward pass is the loss's real slope."""
    li = read_table(spark, base, "lineitem").select(
        (F.col("l_quantity") / 50.0).cast("double").alias("quantity"), (F.col("l_discount") * 10.0).cast("double").alias("discount"),
        (F.col("l_tax") * 10.0).cast("double").alias("tax"), (F.col("l_quantity") * (1 - F.col("l_discount")) > 25).cast("double").alias("label"),
    )
    train = cut_lineage(features.assemble(li, ["quantity", "discount", "tax"], label="label"))
    m = models.perceptron(train, hidden=(16,), max_iter=100)
    seen = certificates.perceptron_certificate(list(m.getLayers()), m.weights.toArray().tolist(), train)
    return train.agg(F.count(F.lit(1)).alias("n"), *[F.lit(v).alias(k) for k, v in seen.items()])


def q_fit_stages(spark, base):
    df = flows.prepared_lineitem(spark, base)
    train, test = balance.hash_split(df, flows.BATCH_KEYS, 0.7)
    stages = [
        VectorAssembler(inputCols=flows.BATCH_FEATURES, outputCol="features"),
        LogisticRegression(maxIter=100, regParam=0.3, elasticNetParam=0.8, labelCol="label_idx"),
    ]
    fitted = models.fit_stages(stages, train)
    return models.scored_rows(fitted.transform(test), "label_idx")


def q_save_load(spark, base):
    """The re-loaded model scores every test row exactly like the fitted one."""
    train, test = flows.batch_split(spark, base)
    m = models.logistic(train, 10, 0.3, 0.8)
    path = models.save_model(m, scratch_path(spark, "logistic-model"))
    back = models.load_model(path, "LogisticRegressionModel")
    back = back.setPredictionCol("p2").setRawPredictionCol("raw2").setProbabilityCol("prob2")
    both = back.transform(models.score(m, test))
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("p2")).alias("n_equal")
    )


def q_prediction_preview(spark, base):
    train, test = flows.batch_split(spark, base)
    m = models.logistic(train, 10, 0.3, 0.8)
    scored = models.score(m, test).select(*flows.BATCH_KEYS, "label", "prediction", vector_to_array("probability").alias("probability"))
    return models.preview(scored, 20, [F.desc(F.col("probability")[0]), F.asc("label"), *[F.asc(c) for c in flows.BATCH_KEYS]])


def q_forest_importances(spark, base):
    """M8: importances by feature name; they are shares, so they sum to 1."""
    feats = flows.classifier_frame(flows.graph_node_features(spark, base))
    tr = features.assemble(feats, flows.GRAPH_FULL, label="label")
    m = models.forest(tr, max_depth=20, num_trees=21, seed=42)
    imp = models.importances(m, models.feature_names(tr))
    everything = Window.partitionBy(F.lit(0))  # one row per feature
    return imp.select("feature", F.round(F.sum("importance").over(everything), R).alias("total"), (F.col("importance") >= 0).alias("is_share"))


def _comparison_facts(metrics):
    """Rows of M10 that SQL can check: test rows of either feature set, all metrics being shares."""
    shares = [(F.col(c) >= 0) & (F.col(c) <= 1) for c in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")]
    return metrics.select("feature_set", "model", "n", (shares[0] & shares[1] & shares[2] & shares[3]).alias("are_shares"))


def q_compare_feature_sets(spark, base):
    return _comparison_facts(flows.graph_classifier_comparison(spark, base, "forest"))


def q_graph_logistic(spark, base):
    return _comparison_facts(flows.graph_classifier_comparison(spark, base, "logistic"))


# ---------------------------------------------------------------- graph


def q_graph_load_counts(spark, base):
    """One row per step, each counted once."""
    nodes, loaded, merged = flows.graph_frames(spark, base)
    loaded = cut_lineage(loaded)
    steps = {"nodes": nodes, "edges_loaded": loaded, "edges_merged": graph.merge_edges(loaded)}
    out = None
    for name, df in steps.items():
        row = graph.load_counts(df).select(F.lit(name).alias("step"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def q_graph_load_csv(spark, base):
    """S5/S6 from header CSV files, as the load scripts read them: counts of nodes and of edges between known nodes."""
    nodes_csv = files.write_features(fixtures.graph_node_table(spark, base), scratch_path(spark, "users-csv"), header=True)
    edges_csv = files.write_features(fixtures.graph_raw_edges(spark, base), scratch_path(spark, "edges-csv"), header=True)
    raw = files.read_csv(spark, nodes_csv, "new_id long, days int, mature int, views double, partner int", header=True, encoded=True)
    nodes = graph.load_nodes(raw)
    edges = graph.load_edges(files.read_csv(spark, edges_csv, "`from` long, `to` long", header=True, encoded=True), nodes)
    count = lambda df, name: graph.load_counts(df).select(F.lit(name).alias("step"), "n")
    return count(nodes, "nodes").unionByName(count(edges, "edges_loaded"))


def q_merge_edges(spark, base):
    return flows.graph_frames(spark, base)[2]


def q_project_undirected(spark, base):
    return graph.project(flows.graph_frames(spark, base)[2], "undirected")


def q_pagerank(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    return _round(graph.pagerank(nodes, merged), ["pagerank"])


def q_pagerank_summary(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    return _round(graph.pagerank_run(nodes, merged), ["min_score", "max_score", "score_sum"])


def q_triangles(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    return graph.triangles(nodes, merged)


def q_triangle_total(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    merged = cut_lineage(merged)
    edges = merged.agg(F.count(F.lit(1)).alias("n")).head()["n"]
    return graph.triangle_total(graph.triangles(nodes, merged)).withColumn("relationships", F.lit(edges))


def q_betweenness(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    return _round(graph.betweenness(nodes, merged), ["betweenness"])


def q_modularity(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    part = read_table(spark, base, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("community"))
    return _round(graph.modularity(merged, part), ["modularity"])


def _louvain(spark, base):
    nodes, _, merged = flows.graph_frames(spark, base)
    merged = cut_lineage(merged)
    return nodes, merged, *graph.louvain(nodes, merged, task_nodes=graph.TASK_NODES)


def q_louvain(spark, base):
    """Every node once, its community named by a node."""
    nodes, _, comm, _ = _louvain(spark, base)
    names = nodes.select(F.col("id").alias("community")).distinct()
    known = comm.join(names.withColumn("named", F.lit(True)), "community", "left")
    return known.select("id", F.coalesce("named", F.lit(False)).alias("named"))


def q_louvain_levels(spark, base):
    """The level list rises, and its last modularity is G5's on the final partition."""
    _, merged, comm, levels = _louvain(spark, base)
    q = graph.modularity(merged, comm).head()["modularity"]
    qs = [r["modularity"] for r in levels.orderBy("level").collect()]  # one number per level
    n = merged.agg(F.count(F.lit(1)).alias("edges"))
    return n.select("edges", F.lit(qs == sorted(qs)).alias("rises"), F.lit(abs(qs[-1] - q) < 1e-9).alias("agrees"))


def q_louvain_certificate(spark, base):
    """No move of a node and no merge of two communities raises modularity, by modularity's own definition."""
    _, merged, comm, _ = _louvain(spark, base)
    seen = graph.partition_certificate(merged, comm)
    return seen.select("id", (F.col("node_gain") > 1e-6).alias("better_move"), (F.col("merge_gain") > 1e-6).alias("better_merge"))


def q_betweenness_summary(spark, base):
    """Min / max / sum of betweenness and nodes written."""
    nodes, _, merged = flows.graph_frames(spark, base)
    return _round(graph.run_summary(graph.betweenness(nodes, merged), "betweenness"), ["min_score", "max_score", "score_sum"])


def q_louvain_summary(spark, base):
    """Community count and modularity of the Louvain partition, and nodes written."""
    _, merged, comm, _ = _louvain(spark, base)
    q = graph.modularity(merged, comm).head()["modularity"]
    n = comm.agg(F.countDistinct("community").alias("communities"), F.count(F.lit(1)).alias("nodes"))
    return n.withColumn("modularity", F.round(F.lit(q), R))


def q_random_walks(spark, base):
    """Walks of node2vec, whose steps hash the walk and the step: a replay gives the same paths."""
    nodes, _, merged = flows.graph_frames(spark, base)
    walks = graph.random_walks(nodes, merged, walk_length=4, walks_per_node=2)
    return walks.select(F.col("walk_id.node").alias("id"), F.col("walk_id.r").alias("walk"), F.array_join(F.transform("path", lambda x: x.cast("string")), ",").alias("path"))


def q_node2vec(spark, base):
    """A vector of the wanted width for every node."""
    nodes, _, merged = flows.graph_frames(spark, base)
    return graph.node2vec(nodes, merged).select("id", F.size("node2vec").alias("width"))


def _feature_facts(feats):
    """Columns of G8 that SQL can replay; the two randomised ones by presence."""
    out = feats.select(
        F.col("id").cast("long").alias("id"), F.col("days").cast("double").alias("days"), F.col("mature").cast("int").alias("mature"),
        F.col("partner").cast("int").alias("partner"), "views", "betweenness", "pageRank", F.col("triangles").cast("double").alias("triangles"),
        F.col("louvain").isNotNull().alias("has_community"), F.size("node2vec").alias("width"),
    )
    return _round(out, ["betweenness", "pageRank"])


def q_node_features(spark, base):
    return _feature_facts(flows.graph_node_features(spark, base))


def q_export_nodes(spark, base):
    """The 15-column export, read back, without the columns that hold no property, typed."""
    path = graph.export_nodes(flows.graph_node_features(spark, base), scratch_path(spark, "nodes-csv"))
    back = graph.read_exported_nodes(spark, path, drop=[c for c in graph.EXPORT_DROPS if c != "id"])
    return _feature_facts(back)


# ---------------------------------------------------------------- sources / streams


def q_csv_roundtrip(spark, base):
    li = read_table(spark, base, "lineitem")
    path = files.write_features(li, scratch_path(spark, "lineitem-csv"), header=True)
    return files.read_csv(spark, path, li.schema, header=True, encoded=True)


def q_csv_text_roundtrip(spark, base):
    """Whole texts with line breaks, quotes and blanks, NULL apart from empty."""
    docs = fixtures.awkward_documents(spark, base)
    path = files.write_features(docs, scratch_path(spark, "documents-csv"), header=True)
    return files.read_csv(spark, path, docs.schema, header=True, encoded=True)


def q_declared_layouts(spark, base):
    """Order lines written and read through the declared 49- and 33-column layouts, bound by position."""
    li = fixtures.layout_lineitem(spark, base)
    out = None
    for name, schema in (("accidents", ACCIDENTS_SCHEMA), ("encoded", ENCODED_ACCIDENTS_SCHEMA)):
        cols = []
        for i, f in enumerate(schema.fields):
            number = (F.col("k") + i).cast(f.dataType)
            cols.append((F.concat(F.lit(f"{i}:"), F.col("note")) if f.dataType == T.StringType() else number).alias(f.name))
        path = files.write_features(li.select(*cols), scratch_path(spark, f"{name}-csv"), header=name == "accidents", compression="gzip")
        back = files.read_csv(spark, path, schema, header=name == "accidents", encoded=True)
        last = back.columns[-1]
        facts = back.agg(
            F.lit(name).alias("layout"), F.lit(len(back.columns)).alias("width"), F.count(F.lit(1)).alias("n"),
            F.sum(F.col("Severity").cast("long")).alias("severity"), F.sum(F.length(F.col(last).cast("string")).cast("long")).alias("last_length"),
        )
        out = facts if out is None else out.unionByName(facts)
    return out


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


ROWS_PER_FILE = 250_000


def _dealt(df, batches, key):
    """``df`` dealt by ``key`` to files of about ROWS_PER_FILE rows, a multiple of ``batches``, and the files of a batch."""
    each = max(1, -(-df.count() // (batches * ROWS_PER_FILE)))
    return df.repartition(batches * each, key), each


def q_stream_counts(spark, base):
    """Events written as headerless CSV files, streamed in four batches,
    counted per batch into an epoch-partitioned table, then summed."""
    ev = read_table(spark, base, "events")
    dealt, each = _dealt(ev, 4, "event_id")
    src = files.write_features(dealt, scratch_path(spark, "events-csv"), header=False)
    out = scratch_path(spark, "events-batches")
    s = stream.read_csv_stream(spark, src, EVENT_SCHEMA, header=False, max_files_per_trigger=each)
    s = stream.prepare(s, {"value": "amount"})

    def per_batch(batch, epoch_id):
        agg = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("value_sum"))
        stream.write_epoch(agg, epoch_id, out)

    stream.run_batches(s, per_batch, scratch_path(spark, "events-ckpt"))
    res = spark.read.parquet(out).groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("value_sum").alias("value_sum"))
    return _round(res, ["value_sum"])


STREAM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_s"]


def _encoded_lineitem(spark, base):
    li = read_table(spark, base, "lineitem")
    return li.select(
        *[F.col(c).cast("double") for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]],
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("double").alias("ship_s"),
        F.when(F.col("l_returnflag") == "N", 1.0).otherwise(0.0).alias("flag_n"),
        F.col("l_orderkey").cast("double").alias("l_orderkey"),
    )


ENCODED_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in STREAM_FEATURES + ["flag_n", "l_orderkey"]])


def q_stream_train_per_batch(spark, base):
    """R2: over all epochs, every row is trained on or tested, on the side its keys hash to."""
    enc = _encoded_lineitem(spark, base)
    dealt, each = _dealt(enc, 3, "l_orderkey")
    src = files.write_features(dealt, scratch_path(spark, "encoded-csv"), header=False)
    out = scratch_path(spark, "train-batches")
    s = stream.read_csv_stream(spark, src, ENCODED_SCHEMA, header=False, max_files_per_trigger=each)
    s = stream.prepare(s, {"flag_n": "label"})
    fn = stream.train_per_batch(STREAM_FEATURES, out, key_cols=["l_orderkey", "l_quantity"])
    stream.run_batches(s, fn, scratch_path(spark, "train-ckpt"))
    shares = F.min((F.col("accuracy") >= 0) & (F.col("accuracy") <= 1))
    return spark.read.parquet(out).agg(
        F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"), F.sum("n").alias("n_scored"), shares.alias("are_shares")
    )


def q_stream_metrics_replay(spark, base):
    """R2: each epoch's four metrics are those that its rows, the split rule and its coefficients give."""
    enc = _encoded_lineitem(spark, base)
    dealt, each = _dealt(enc, 3, "l_orderkey")
    src = files.write_features(dealt, scratch_path(spark, "encoded-csv"), header=False)
    out, kept = scratch_path(spark, "train-batches"), scratch_path(spark, "train-rows")
    s = stream.prepare(stream.read_csv_stream(spark, src, ENCODED_SCHEMA, header=False, max_files_per_trigger=each), {"flag_n": "label"})
    keys = ["l_orderkey", "l_quantity"]
    fn = stream.train_per_batch(STREAM_FEATURES, out, key_cols=keys, reg_param=0.001, rows_path=kept)
    stream.run_batches(s, fn, scratch_path(spark, "train-ckpt"))
    results = spark.read.parquet(out)
    again = stream.replay_metrics(spark.read.parquet(kept), results, STREAM_FEATURES, keys)
    names = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "n", "n_train", "n_test"]
    both = results.join(again.select("epoch_id", *[F.col(c).alias(f"r_{c}") for c in names]), "epoch_id", "left")
    equal = F.lit(True)
    for c in names:
        equal = equal & F.coalesce(F.abs(F.col(c) - F.col(f"r_{c}")) < 1e-9, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("epochs"), F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"), F.min(equal).alias("replayed"))


def q_score_stream(spark, base):
    """A re-loaded model scores the stream row by row as it scores the table."""
    enc = _encoded_lineitem(spark, base).withColumnRenamed("flag_n", "label")
    fitted = models.fit_stages(
        [VectorAssembler(inputCols=STREAM_FEATURES, outputCol="features"), LogisticRegression(maxIter=20, regParam=0.01)],
        enc,
    )
    loaded = models.load_model(models.save_model(fitted, scratch_path(spark, "stream-model")))
    dealt, each = _dealt(_encoded_lineitem(spark, base), 2, "l_orderkey")
    src = files.write_features(dealt, scratch_path(spark, "score-csv"), header=False)
    out = scratch_path(spark, "scored")
    s = stream.prepare(stream.read_csv_stream(spark, src, ENCODED_SCHEMA, max_files_per_trigger=each), {"flag_n": "label"})
    scored = stream.score_stream(loaded, s).select(*STREAM_FEATURES, "label", "prediction")
    stream.run_batches(scored, lambda b, e: stream.write_epoch(b, e, out), scratch_path(spark, "score-ckpt"))
    again = models.score(fitted, spark.read.parquet(out).withColumnRenamed("prediction", "streamed"))
    return again.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("streamed")).alias("n_equal"))


QUERIES = {
    "shape": q_shape,
    "schema_table": q_schema_table,
    "missing_counts": q_missing_counts,
    "summary_numeric": q_summary_numeric,
    "summary_text": q_summary_text,
    "value_counts": q_value_counts,
    "modes": q_modes,
    "modes_with_nulls": q_modes_with_nulls,
    "correlation": q_correlation,
    "correlation_gaps": q_correlation_gaps,
    "spearman": q_spearman,
    "spearman_gaps": q_spearman_gaps,
    "top_orders": q_top_orders,
    "project": q_project,
    "rename": q_rename,
    "drop_columns": q_drop_columns,
    "drop_missing": q_drop_missing,
    "to_double": q_to_double,
    "bool_text": q_bool_text,
    "lower_columns": q_lower_columns,
    "impute_mean": q_impute_mean,
    "impute_overrides": q_impute_overrides,
    "impute_mode": q_impute_mode,
    "token_counts": q_token_counts,
    "doc_token_stats": q_doc_token_stats,
    "epoch_duration": q_epoch_duration,
    "parse_vector": q_parse_vector,
    "string_index": q_string_index,
    "string_index_inverse": q_string_index_inverse,
    "one_hot": q_one_hot,
    "assemble": q_assemble,
    "text_embedding": q_text_embedding,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "replicate": q_replicate,
    "oversample": q_oversample,
    "class_ratio": q_class_ratio,
    "label_counts": q_label_counts,
    "weighted_metrics": q_weighted_metrics,
    "accuracy": q_accuracy,
    "logistic": q_logistic,
    "logistic_optimum": q_logistic_optimum,
    "elastic_net_optimum": q_elastic_net_optimum,
    "forest_replay": q_forest_replay,
    "perceptron": q_perceptron,
    "perceptron_certificate": q_perceptron_certificate,
    "fit_stages": q_fit_stages,
    "save_load": q_save_load,
    "prediction_preview": q_prediction_preview,
    "forest_importances": q_forest_importances,
    "compare_feature_sets": q_compare_feature_sets,
    "graph_logistic": q_graph_logistic,
    "graph_load_counts": q_graph_load_counts,
    "graph_load_csv": q_graph_load_csv,
    "merge_edges": q_merge_edges,
    "project_undirected": q_project_undirected,
    "pagerank": q_pagerank,
    "pagerank_summary": q_pagerank_summary,
    "triangles": q_triangles,
    "triangle_total": q_triangle_total,
    "betweenness": q_betweenness,
    "modularity": q_modularity,
    "louvain": q_louvain,
    "louvain_levels": q_louvain_levels,
    "louvain_certificate": q_louvain_certificate,
    "betweenness_summary": q_betweenness_summary,
    "louvain_summary": q_louvain_summary,
    "random_walks": q_random_walks,
    "node2vec": q_node2vec,
    "node_features": q_node_features,
    "export_nodes": q_export_nodes,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_text_roundtrip": q_csv_text_roundtrip,
    "declared_layouts": q_declared_layouts,
    "stream_counts": q_stream_counts,
    "stream_train_per_batch": q_stream_train_per_batch,
    "stream_metrics_replay": q_stream_metrics_replay,
    "score_stream": q_score_stream,
}
