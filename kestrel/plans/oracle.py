"""Independent SQL (DuckDB dialect) for every exactly checkable query in the catalog.

Derived inputs reuse the expression text of :mod:`kestrel.plans.fixtures`.
Trained models, Louvain and embeddings have no closed SQL form; their queries return
facts about the result that SQL can state (rows scored per label, the optimality
condition, agreement of two computations). Four queries whose values depend on training have no entry
and are held to brute force or properties in ``tests/``.
"""

from __future__ import annotations

from kestrel.plans import fixtures as fx

LINEITEM_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
GAPPY_TYPES = {
    "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int",
    "l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float",
    "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time",
}


def _gappy_lineitem() -> str:
    return "(" + fx.sql_select(fx.GAPPY_LINEITEM, "lineitem") + ")"


def _gappy_orders() -> str:
    return "(" + fx.sql_select(fx.GAPPY_ORDERS, "orders") + ")"


def _missing(c: str) -> str:
    return f"(isnan({c}) OR {c} IS NULL)" if GAPPY_TYPES[c] == "float" else f"{c} IS NULL"


def missing_counts() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_missing(c)}) AS n_missing FROM t"
        for c in GAPPY_TYPES
    ]
    return f"WITH t AS {_gappy_lineitem()} " + " UNION ALL ".join(parts)


def summary_numeric() -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, min({x}) AS min, quantile_disc({x}, 0.25) AS p25, "
            f"quantile_disc({x}, 0.5) AS p50, quantile_disc({x}, 0.75) AS p75, max({x}) AS max FROM lineitem"
        )
    return " UNION ALL ".join(parts)


def _value_counts(table: str, cols: list[str], drop_nulls: bool = False) -> str:
    where = lambda c: f" WHERE {c} IS NOT NULL" if drop_nulls else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {table}{where(c)} GROUP BY 2"
        for c in cols
    )


def _modes(table: str, cols: list[str]) -> str:
    return (
        f"WITH c AS ({_value_counts(table, cols, True)}) "
        "SELECT column_name, value AS mode, n FROM ("
        "SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC) AS rn FROM c"
        ") WHERE rn = 1"
    )


def correlation() -> str:
    cols = LINEITEM_NUMERIC
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            e = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {e} AS corr FROM lineitem")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {e} AS corr FROM lineitem")
    return " UNION ALL ".join(parts)


def drop_missing() -> str:
    conds = " AND ".join(f"NOT {_missing(c)}" for c in GAPPY_TYPES)
    return f"SELECT * FROM {_gappy_lineitem()} t WHERE {conds}"


def impute_mean() -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    sel = []
    for c in GAPPY_TYPES:
        if c in cols:
            sel.append(f"round(coalesce({c}, (SELECT avg({c}) FROM t WHERE NOT isnan({c}))), 6) AS {c}")
        else:
            sel.append(c)
    return f"WITH t AS {_gappy_lineitem()} SELECT {', '.join(sel)} FROM t"


def impute_mode() -> str:
    cols = ["o_orderstatus", "o_orderpriority"]
    modes = _modes("t", cols)
    sel = []
    for e in fx.GAPPY_ORDERS:
        name = e.split(" AS ")[-1] if " AS " in e else e
        if name in cols:
            sel.append(f"coalesce({name}, (SELECT mode FROM m WHERE column_name = '{name}')) AS {name}")
        else:
            sel.append(name)
    return f"WITH t AS {_gappy_orders()}, m AS ({modes}) SELECT {', '.join(sel)} FROM t"


def epoch_duration() -> str:
    src = "(" + fx.sql_select(fx.TIME_TEXT_JOIN[1], fx.TIME_TEXT_JOIN[0]) + ")"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    s = f"CAST(epoch(try_strptime(start_text, {fmt})) AS BIGINT)"
    e = f"CAST(epoch(try_strptime(end_text, {fmt})) AS BIGINT)"
    return f"SELECT l_orderkey, l_linenumber, {s} AS start_s, {e} AS end_s, {e} - {s} AS duration_s FROM {src} t"


def parse_vector() -> str:
    cols = ", ".join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS "embedding[{i}]"' for i in range(64))
    return f"SELECT vec_id, {cols} FROM embeddings"


def _index_cte(name: str, table: str, col: str) -> str:
    return (
        f"{name} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v ASC) - 1 AS DOUBLE) AS idx, "
        f"count(*) OVER () AS k FROM (SELECT {col} AS v, count(*) AS n FROM {table} GROUP BY 1))"
    )


def string_index() -> str:
    return (
        f"WITH {_index_cte('rb', 'part', 'p_brand')}, {_index_cte('rt', 'part', 'p_type')} "
        'SELECT p_partkey, p_brand, rb.idx AS "p_brandVec", p_type, rt.idx AS "p_typeVec" '
        "FROM part JOIN rb ON p_brand = rb.v JOIN rt ON p_type = rt.v"
    )


def one_hot() -> str:
    return (
        f"WITH {_index_cte('r', 'orders', 'o_orderpriority')} "
        "SELECT o_orderkey, o_orderpriority, CAST(CASE WHEN idx < k - 1 THEN idx END AS BIGINT) AS hot_slot "
        "FROM orders JOIN r ON o_orderpriority = r.v"
    )


def _train_side(keys: str) -> str:
    """First 32 bits of the MD5 below 70 % of 2^32."""
    return f"CAST(('0x' || substr(md5(concat_ws('|', {keys})), 1, 8)) AS BIGINT) < {round(0.7 * 2**32)}"


def hash_split() -> str:
    side = f"CASE WHEN {_train_side('l_orderkey, l_linenumber')} THEN 'train' ELSE 'test' END"
    return f"SELECT {side} AS side, count(*) AS n_rows, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY 1"


def impute_overrides() -> str:
    sel = []
    for c in GAPPY_TYPES:
        fill = {"l_quantity": "25.5", "l_discount": "0.05"}.get(c)
        sel.append(f"coalesce({c}, CAST({fill} AS DOUBLE)) AS {c}" if fill else c)
    gap = "CASE WHEN l_orderkey % 3 <> 0 THEN l_linenumber END"
    mean = f"(SELECT avg({gap}) FROM t)"
    return f"WITH t AS {_gappy_lineitem()} SELECT {', '.join(sel)}, round(coalesce(CAST({gap} AS DOUBLE), {mean}), 6) AS line_gap FROM t"


def summary_text() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, min({c}) AS min, max({c}) AS max FROM {_gappy_orders()} t"
        for c in ("o_orderstatus", "o_orderpriority")
    )


def correlation_gaps() -> str:
    cols = ["l_quantity", "l_tax", "l_linenumber"]
    e = lambda a, b: f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
    return f"WITH t AS {_gappy_lineitem()} " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {e(a, b)} AS corr FROM t" for a in cols for b in cols
    )


def spearman() -> str:
    """Correlation of average ranks."""
    cols = ["p_size", "p_retailprice"]
    rank = lambda c: f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE AS r_{c}"
    return f"WITH t AS (SELECT {', '.join(map(rank, cols))} FROM part) " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(r_{a}, r_{b}), 6) AS corr FROM t" for a in cols for b in cols
    )


def spearman_gaps() -> str:
    """Correlation of average ranks, ranked for each pair among the rows that have both values."""
    cols = ["l_quantity", "l_tax", "l_linenumber"]
    rank = lambda c: f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE"
    return f"WITH t AS {_gappy_lineitem()} " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 6) AS corr FROM "
        f"(SELECT {rank('x')} AS ra, {rank('y')} AS rb FROM (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM t) "
        "WHERE x IS NOT NULL AND y IS NOT NULL)"
        for a in cols for b in cols
    )


def _cleaned_lineitem() -> str:
    """Rows of the batch flow after imputation and the NaN / NULL drop, with the label's index."""
    return (
        f"t AS {_gappy_lineitem()}, "
        "mode_flag AS (SELECT l_returnflag AS v FROM t WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), "
        "cleaned AS (SELECT *, coalesce(l_returnflag, (SELECT v FROM mode_flag)) AS flag FROM t "
        "WHERE NOT coalesce(isnan(l_extendedprice), FALSE) AND NOT coalesce(isnan(l_discount), FALSE) AND l_shipdate IS NOT NULL), "
        "idx AS (SELECT flag, CAST(row_number() OVER (ORDER BY count(*) DESC, flag) - 1 AS DOUBLE) AS label FROM cleaned GROUP BY 1), "
        f"test AS (SELECT label FROM cleaned JOIN idx USING (flag) WHERE NOT {_train_side('l_orderkey, l_linenumber, l_partkey')})"
    )


def scored_rows() -> str:
    """Every test row of the batch flow is scored, consistently, per label."""
    return f"WITH {_cleaned_lineitem()} SELECT label, count(*) AS n, count(*) AS n_consistent, TRUE AS at_least_majority FROM test GROUP BY 1"


def _oversampled() -> str:
    return (
        "WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1), "
        "mn AS (SELECT quality FROM c ORDER BY n, quality LIMIT 1), "
        "ratio AS (SELECT CAST(floor(max(n) / min(n)) AS BIGINT) + 1 AS r FROM c), "
        "o AS (SELECT doc_id, quality, toxic FROM labels WHERE quality <> (SELECT quality FROM mn) "
        "UNION ALL SELECT l.doc_id, l.quality, l.toxic FROM labels l "
        "JOIN (SELECT unnest(range((SELECT r FROM ratio))) AS copy) g ON TRUE "
        "WHERE l.quality = (SELECT quality FROM mn)) "
    )


def weighted_metrics() -> str:
    src = "(" + fx.sql_select(fx.RULE_PREDICTIONS, "lineitem") + ")"
    return (
        f"WITH p AS {src}, "
        "cm AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2), "
        "t AS (SELECT label AS c, sum(n) AS n_true, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY 1), "
        "pr AS (SELECT prediction AS c, sum(n) AS n_pred FROM cm GROUP BY 1), "
        "pc AS (SELECT CAST(n_true AS DOUBLE) AS n_true, CAST(tp AS DOUBLE) AS tp, CAST(coalesce(n_pred, 0) AS DOUBLE) AS n_pred "
        "FROM t LEFT JOIN pr ON t.c = pr.c), "
        "m AS (SELECT n_true, tp, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS prec, tp / n_true AS rec FROM pc) "
        "SELECT round(sum(tp) / sum(n_true), 6) AS accuracy, "
        "round(sum(prec * n_true) / sum(n_true), 6) AS weighted_precision, "
        "round(sum(rec * n_true) / sum(n_true), 6) AS weighted_recall, "
        "round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END * n_true) / sum(n_true), 6) AS weighted_f1, "
        "CAST(sum(n_true) AS BIGINT) AS n FROM m"
    )


# ---------------------------------------------------------------- graph

GRAPH_CTE = (
    "nodes AS (SELECT DISTINCT " + ", ".join(fx.GRAPH_NODES) + " FROM customer), "
    "ids AS (SELECT DISTINCT new_id AS id FROM nodes), "
    "raw AS (SELECT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey), "
    "loaded AS (SELECT src, dst FROM raw WHERE src IN (SELECT id FROM ids) AND dst IN (SELECT id FROM ids)), "
    "merged AS (SELECT s AS src, CASE WHEN s = lo THEN hi ELSE lo END AS dst FROM "
    "(SELECT least(src, dst) AS lo, greatest(src, dst) AS hi, min(src) AS s FROM loaded GROUP BY 1, 2))"
)


def _pagerank_cte(iters: int = 20, damping: float = 0.85) -> str:
    base = f"CAST(1.0 AS DOUBLE) - CAST({damping} AS DOUBLE)"
    parts = [
        GRAPH_CTE,
        "deg AS (SELECT src, count(*) AS d FROM merged GROUP BY 1)",
        "w AS (SELECT m.src, m.dst, CAST(1.0 AS DOUBLE) / deg.d AS w FROM merged m JOIN deg ON m.src = deg.src)",
        f"r0 AS (SELECT id, {base} AS rank FROM ids)",
    ]
    for i in range(1, iters + 1):
        parts.append(
            f"r{i} AS (SELECT ids.id, {base} + CAST({damping} AS DOUBLE) * coalesce(s.s, 0.0) AS rank FROM ids LEFT JOIN "
            f"(SELECT w.dst, sum(r.rank * w.w) AS s FROM w JOIN r{i - 1} r ON w.src = r.id GROUP BY 1) s ON ids.id = s.dst)"
        )
    return "WITH " + ", ".join(parts) + " "


def pagerank() -> str:
    return _pagerank_cte() + "SELECT id, round(rank, 6) AS pagerank FROM r20"


def pagerank_summary() -> str:
    return _pagerank_cte() + (
        "SELECT round(min(rank), 6) AS min_score, round(max(rank), 6) AS max_score, "
        "round(sum(rank), 6) AS score_sum, count(*) AS nodes, 20 AS iterations FROM r20"
    )


# Brandes in SQL: distances by a keyed recursion, path counts level by level, dependencies from the deepest level back
BETWEENNESS_CTE = (
    "adj AS MATERIALIZED (SELECT DISTINCT src, dst FROM merged WHERE src <> dst), "
    "bfs(s, v, d) USING KEY (s, v) AS (SELECT id, id, 0 FROM ids UNION "
    "SELECT b.s, a.dst, min(b.d) + 1 FROM bfs b JOIN adj a ON b.v = a.src "
    "WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.s = b.s AND r.v = a.dst) GROUP BY b.s, a.dst), "
    "dist AS MATERIALIZED (SELECT s, v, d FROM bfs), "
    "dag AS MATERIALIZED (SELECT b.s, a.src AS v, a.dst AS w, b.d FROM dist b JOIN adj a ON b.v = a.src "
    "JOIN dist c ON c.s = b.s AND c.v = a.dst AND c.d = b.d + 1), "
    "paths(s, v, d, sigma) AS (SELECT id, id, 0, 1.0::DOUBLE FROM ids UNION ALL "
    "SELECT g.s, g.w, g.d + 1, sum(p.sigma) FROM paths p JOIN dag g ON g.s = p.s AND g.v = p.v GROUP BY g.s, g.w, g.d), "
    "sig AS MATERIALIZED (SELECT * FROM paths), "
    "back(s, v, d, delta) AS (SELECT s, v, d, 0.0::DOUBLE FROM sig WHERE d = (SELECT max(d) FROM sig) UNION ALL "
    "SELECT x.s, x.v, x.d, coalesce(sum(x.sigma / y.sigma * (1 + w.delta)), 0.0) FROM sig x "
    "JOIN (SELECT DISTINCT d FROM back) l ON x.d = l.d - 1 LEFT JOIN dag g ON g.s = x.s AND g.v = x.v "
    "LEFT JOIN back w ON w.s = g.s AND w.v = g.w LEFT JOIN sig y ON y.s = g.s AND y.v = g.w GROUP BY x.s, x.v, x.d), "
    "bc AS (SELECT ids.id, coalesce(sum(delta), 0.0) AS score FROM ids LEFT JOIN back ON back.v = ids.id AND back.s <> back.v GROUP BY 1)"
)


def betweenness() -> str:
    return f"WITH RECURSIVE {GRAPH_CTE}, {BETWEENNESS_CTE} SELECT id, round(score, 6) AS betweenness FROM bc"


def betweenness_summary() -> str:
    return (
        f"WITH RECURSIVE {GRAPH_CTE}, {BETWEENNESS_CTE} SELECT round(min(score), 6) AS min_score, "
        "round(max(score), 6) AS max_score, round(sum(score), 6) AS score_sum, count(*) AS nodes FROM bc"
    )


def random_walks(seed: int = 42, length: int = 4, walks: int = 2) -> str:
    """Replay of the hashed walks, a step per CTE."""
    parts = [
        GRAPH_CTE,
        "outs AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS deg FROM (SELECT DISTINCT src, dst FROM merged))",
        "hops AS (SELECT src, dst, deg, row_number() OVER (PARTITION BY src ORDER BY "
        "('0x' || substr(md5(dst::VARCHAR), 1, 8))::BIGINT % CAST(ceil(deg / 10000) AS BIGINT), dst) - 1 AS idx FROM outs)",
        f"w0 AS (SELECT id, walk, id AS node, id::VARCHAR AS path, TRUE AS walking FROM ids, (SELECT unnest(range({walks})) AS walk))",
    ]
    for k in range(1, length):
        h = f"('0x' || substr(md5('{seed}:' || id || ':' || walk || ':{k}'), 1, 8))::BIGINT"
        parts.append(
            f"w{k} AS (SELECT w.id, w.walk, coalesce(h.dst, w.node) AS node, CASE WHEN h.dst IS NULL THEN w.path ELSE w.path || ',' || h.dst END AS path, "
            f"h.dst IS NOT NULL AS walking FROM (SELECT *, {h} AS h FROM w{k - 1}) w LEFT JOIN hops h ON w.walking AND h.src = w.node AND h.idx = w.h % h.deg)"
        )
    return "WITH " + ", ".join(parts) + f" SELECT id, walk, path FROM w{length - 1}"


def node_facts() -> str:
    return (
        f"WITH RECURSIVE {_pagerank_cte()[len('WITH '):].rstrip()}, {TRIANGLE_CTE}, {BETWEENNESS_CTE} "
        "SELECT n.new_id AS id, CAST(n.days AS DOUBLE) AS days, n.mature, n.partner, n.views, round(bc.score, 6) AS betweenness, "
        'round(r20.rank, 6) AS "pageRank", CAST(coalesce(per.n, 0) AS DOUBLE) AS triangles, TRUE AS has_community, 2 AS width '
        "FROM nodes n JOIN bc ON bc.id = n.new_id JOIN r20 ON r20.id = n.new_id LEFT JOIN per ON per.id = n.new_id"
    )


def comparison(model: str) -> str:
    side = f"SELECT count(*) FROM nodes WHERE NOT {_train_side('new_id')}"
    return f"WITH {GRAPH_CTE} " + " UNION ALL ".join(
        f"SELECT '{name}' AS feature_set, '{model}' AS model, ({side}) AS n, TRUE AS are_shares" for name in ("graph", "basic")
    )


TRIANGLE_CTE = (
    "pairs AS (SELECT DISTINCT least(src, dst) AS lo, greatest(src, dst) AS hi FROM merged WHERE src <> dst), "
    "tri AS (SELECT a.lo AS x, a.hi AS y, b.hi AS z FROM pairs a JOIN pairs b ON a.hi = b.lo "
    "JOIN pairs c ON c.lo = a.lo AND c.hi = b.hi), "
    "per AS (SELECT id, count(*) AS n FROM (SELECT x AS id FROM tri UNION ALL SELECT y FROM tri UNION ALL SELECT z FROM tri) GROUP BY 1)"
)


def triangles() -> str:
    return f"WITH {GRAPH_CTE}, {TRIANGLE_CTE} SELECT ids.id, CAST(coalesce(per.n, 0) AS BIGINT) AS triangles FROM ids LEFT JOIN per ON ids.id = per.id"


def triangle_total() -> str:
    return (
        f"WITH {GRAPH_CTE}, {TRIANGLE_CTE} SELECT CAST((SELECT count(*) FROM tri) AS BIGINT) AS global_triangles, "
        "(SELECT count(*) FROM ids) AS nodes, (SELECT count(*) FROM merged) AS relationships"
    )


def modularity() -> str:
    return (
        f"WITH {GRAPH_CTE}, "
        "base AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM merged), "
        "sym AS (SELECT a AS u, b AS v, 1.0 AS w FROM base WHERE a <> b UNION ALL SELECT b, a, 1.0 FROM base WHERE a <> b "
        "UNION ALL SELECT a, b, 2.0 FROM base WHERE a = b), "
        "part AS (SELECT c_custkey AS node, c_nationkey AS c FROM customer), "
        "r AS (SELECT pu.c AS cu, pv.c AS cv, CAST(w AS DOUBLE) AS w FROM sym JOIN part pu ON sym.u = pu.node JOIN part pv ON sym.v = pv.node), "
        "per_c AS (SELECT cu AS c, sum(CASE WHEN cu = cv THEN w ELSE 0.0 END) AS L, sum(w) AS K FROM r GROUP BY 1) "
        "SELECT round(sum(L) / sum(K) - sum(K * K) / (sum(K) * sum(K)), 6) AS modularity FROM per_c"
    )


def save_load() -> str:
    """Every test row of the batch flow is scored identically by the re-loaded model."""
    return f"WITH {_cleaned_lineitem()} SELECT count(*) AS n, count(*) AS n_equal FROM test"


def declared_layouts() -> str:
    """Layout widths, rows, sums of Severity (4th of 49 columns, 2nd of 33) and lengths of the last column's text."""
    src = "(" + fx.sql_select(fx.LAYOUT_LINEITEM, "lineitem") + ") t"
    return (
        f"SELECT 'accidents' AS layout, 49 AS width, count(*) AS n, CAST(sum(k + 3) AS BIGINT) AS severity, "
        f"CAST(sum(length('48:' || note)) AS BIGINT) AS last_length FROM {src} UNION ALL "
        f"SELECT 'encoded', 33, count(*), CAST(sum(k + 1) AS BIGINT), CAST(sum(length(CAST(k + 32 AS VARCHAR) || '.0')) AS BIGINT) FROM {src}"
    )


def stream_training() -> str:
    key = "CAST(CAST(l_orderkey AS DOUBLE) AS VARCHAR), CAST(l_quantity AS VARCHAR)"
    return (
        f"SELECT CAST(count(*) FILTER (WHERE {_train_side(key)}) AS BIGINT) AS n_train, "
        f"CAST(count(*) FILTER (WHERE NOT {_train_side(key)}) AS BIGINT) AS n_test, "
        f"CAST(count(*) FILTER (WHERE NOT {_train_side(key)}) AS BIGINT) AS n_scored, TRUE AS are_shares FROM lineitem"
    )


def oracle_sql() -> dict[str, str]:
    bool_src = "(" + fx.sql_select(fx.BOOL_TEXT_LINEITEM, "lineitem") + ")"
    price_src = "(" + fx.sql_select(fx.PRICE_TEXT_PART, "part") + ")"
    return {
        "shape": (
            "SELECT count(*) AS n_rows, (SELECT count(*) FROM information_schema.columns "
            "WHERE table_name = 'lineitem') AS n_cols FROM lineitem"
        ),
        "schema_table": (
            "SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, "
            "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
            "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
            "WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(data_type) END AS data_type, "
            "is_nullable = 'YES' AS nullable FROM information_schema.columns WHERE table_name = 'lineitem'"
        ),
        "missing_counts": missing_counts(),
        "summary_numeric": summary_numeric(),
        "value_counts": _value_counts("orders", ["o_orderstatus", "o_orderpriority"]),
        "modes": _modes("part", ["p_name", "p_brand", "p_type"]),
        "modes_with_nulls": _modes(_gappy_orders() + " g", ["o_orderstatus", "o_orderpriority"]),
        "correlation": correlation(),
        "top_orders": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
        "drop_columns": (
            "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_linestatus FROM lineitem"
        ),
        "drop_missing": drop_missing(),
        "to_double": f"SELECT p_partkey, TRY_CAST(price_text AS DOUBLE) AS price FROM {price_src} t",
        "bool_text": (
            "SELECT l_orderkey, l_linenumber, flag_text, CASE WHEN flag_text = 'True' THEN 1 "
            f"WHEN flag_text = 'False' THEN 0 ELSE TRY_CAST(flag_text AS INTEGER) END AS flag FROM {bool_src} t"
        ),
        "lower_columns": (
            "SELECT p_partkey, lower(p_name) AS p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type, "
            "p_size, p_retailprice FROM part"
        ),
        "impute_mean": impute_mean(),
        "impute_mode": impute_mode(),
        "token_counts": (
            "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents) GROUP BY 1"
        ),
        "doc_token_stats": (
            "SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_tokens, "
            "CAST(len(list_filter(string_split(text, ' '), lambda x: x = '')) AS BIGINT) AS n_empty FROM documents"
        ),
        "epoch_duration": epoch_duration(),
        "parse_vector": parse_vector(),
        "string_index": string_index(),
        "string_index_inverse": "SELECT p_partkey, p_brand, (dense_rank() OVER (ORDER BY c DESC, p_brand) - 1)::DOUBLE AS \"p_brandVec\" FROM "
        "(SELECT p_partkey, p_brand, count(*) OVER (PARTITION BY p_brand) AS c FROM part)",
        "one_hot": one_hot(),
        "assemble": (
            "SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS label, l_quantity AS f0, l_extendedprice AS f1, "
            "l_discount AS f2, l_tax AS f3 FROM lineitem"
        ),
        "hash_split": hash_split(),
        "replicate": " UNION ALL ".join(["SELECT doc_id, quality, toxic FROM labels"] * 3),
        "oversample": _oversampled() + "SELECT doc_id, quality, toxic FROM o",
        "class_ratio": (
            "SELECT max(n) AS major, min(n) AS minor, CAST(floor(max(n) / min(n)) AS BIGINT) + 1 AS ratio "
            "FROM (SELECT count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality)"
        ),
        "label_counts": _oversampled() + "SELECT quality, count(*) AS n FROM o GROUP BY 1",
        "weighted_metrics": weighted_metrics(),
        "accuracy": (
            "SELECT round(avg(CASE WHEN label = prediction THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END), 6) AS accuracy, "
            f"count(*) AS n FROM ({fx.sql_select(fx.RULE_PREDICTIONS, 'lineitem')}) p"
        ),
        "graph_load_counts": (
            f"WITH {GRAPH_CTE} SELECT 'nodes' AS step, count(*) AS n FROM nodes UNION ALL SELECT 'edges_loaded', count(*) FROM loaded "
            "UNION ALL SELECT 'edges_merged', count(*) FROM merged"
        ),
        "graph_load_csv": (
            f"WITH {GRAPH_CTE} SELECT 'nodes' AS step, count(*) AS n FROM nodes UNION ALL SELECT 'edges_loaded', count(*) FROM loaded"
        ),
        "merge_edges": f"WITH {GRAPH_CTE} SELECT src, dst FROM merged",
        "project_undirected": (
            f"WITH {GRAPH_CTE} SELECT DISTINCT src, dst FROM (SELECT src, dst FROM merged UNION ALL SELECT dst, src FROM merged)"
        ),
        "pagerank": pagerank(),
        "pagerank_summary": pagerank_summary(),
        "triangles": triangles(),
        "triangle_total": triangle_total(),
        "modularity": modularity(),
        "save_load": save_load(),
        "csv_roundtrip": "SELECT * FROM lineitem",
        "csv_text_roundtrip": fx.sql_select(fx.AWKWARD_DOCUMENTS, "documents"),
        "declared_layouts": declared_layouts(),
        "summary_text": summary_text(),
        "correlation_gaps": correlation_gaps(),
        "spearman": spearman(),
        "spearman_gaps": spearman_gaps(),
        "project": "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders",
        "rename": "SELECT doc_id, quality AS is_good, toxic AS is_toxic FROM labels",
        "impute_overrides": impute_overrides(),
        "random_split": "SELECT count(*) AS n_rows, sum(l_quantity) AS sum_qty, CAST(sum(l_orderkey) AS BIGINT) AS sum_keys FROM lineitem",
        "logistic": scored_rows(),
        "perceptron": scored_rows(),
        "fit_stages": scored_rows(),
        "elastic_net_optimum": f"WITH {GRAPH_CTE}, {_cleaned_lineitem()} SELECT 'batch' AS setting, (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM test) AS n, "
        "TRUE AS optimal UNION ALL SELECT 'graph', count(*), TRUE FROM nodes",
        "perceptron_certificate": "SELECT count(*) AS n, TRUE AS below_entropy, TRUE AS slope_agrees FROM lineitem",
        "forest_replay": "SELECT unnest(['days', 'partner', 'views']) AS feature, TRUE AS splits_fit, TRUE AS importance_fits, TRUE AS votes_fit",
        "logistic_optimum": "SELECT count(*) AS n, TRUE AS optimal FROM lineitem",
        "forest_importances": (
            "SELECT feature, CAST(1.0 AS DOUBLE) AS total, TRUE AS is_share FROM (SELECT unnest(["
            "'betweenness', 'days', 'louvain', 'pageRank', 'partner', 'triangles', 'views', 'node2vec[0]', 'node2vec[1]']) AS feature)"
        ),
        "compare_feature_sets": comparison("forest"),
        "graph_logistic": comparison("logistic"),
        "betweenness": betweenness(),
        "betweenness_summary": betweenness_summary(),
        "louvain": f"WITH {GRAPH_CTE} SELECT id, TRUE AS named FROM ids",
        "louvain_certificate": f"WITH {GRAPH_CTE} SELECT id, FALSE AS better_move, FALSE AS better_merge FROM "
        "(SELECT src AS id FROM merged UNION SELECT dst FROM merged)",
        "louvain_levels": f"WITH {GRAPH_CTE} SELECT count(*) AS edges, TRUE AS rises, TRUE AS agrees FROM merged",
        "random_walks": random_walks(),
        "node2vec": f"WITH {GRAPH_CTE} SELECT id, 2 AS width FROM ids",
        "node_features": node_facts(),
        "export_nodes": node_facts(),
        "stream_train_per_batch": stream_training(),
        "stream_metrics_replay": f"SELECT 3 AS epochs, n_train, n_test, TRUE AS replayed FROM ({stream_training()})",
        "score_stream": (
            "SELECT CASE WHEN l_returnflag = 'N' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS label, "
            "count(*) AS n, count(*) AS n_equal FROM lineitem GROUP BY 1"
        ),
        "stream_counts": "SELECT event_type, count(*) AS n, round(sum(value), 6) AS value_sum FROM events GROUP BY 1",
    }
