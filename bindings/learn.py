"""Features, classification, clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import TRANSACTIONS_SQL, money, query, transactions
from zonelake.operators import stats
from zonelake.plans import analysis

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("""
    SELECT user_id, event_type AS dominant FROM (
        SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) AS rn
        FROM events GROUP BY user_id, event_type) WHERE rn = 1""")
def dominant_type(t):
    return stats.dominant_value(t.events, "user_id", "event_type")


USER_FEATURES_SQL = f"""
    WITH tx AS ({TRANSACTIONS_SQL}),
         mean AS (SELECT user_id, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount FROM tx GROUP BY 1),
         mode AS (SELECT user_id, type AS dominant_type FROM (
             SELECT user_id, type, row_number() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, type) AS rn
             FROM tx GROUP BY user_id, type) WHERE rn = 1)
    SELECT c_custkey AS user_id, c_acctbal AS balance, c_mktsegment AS occupation, avg_amount, dominant_type
    FROM customer JOIN mean ON mean.user_id = c_custkey JOIN mode ON mode.user_id = c_custkey
    WHERE c_mktsegment IS NOT NULL"""


def _user_features(t):
    profiles = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("occupation")
    )
    return analysis.user_features(profiles, transactions(t))


@query(USER_FEATURES_SQL)
def user_features(t):
    return _user_features(t)


@query("SELECT c_custkey, c_acctbal, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INT) AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer")
def one_hot(t):
    return analysis.one_hot(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), "c_mktsegment", SEGMENTS)


@query("""
    SELECT c_custkey, round((c_acctbal - AVG(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal
    FROM customer""")
def scaled(t):
    return analysis.standardise(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"]).withColumn(
        "c_acctbal", F.round("c_acctbal", 6)
    )


FEATURES = ["amount", "attempts", "day"]
_FRAME_SQL = """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS attempts, CAST(day(o_orderdate) AS DOUBLE) AS day,
           o_orderstatus AS type, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label
    FROM orders"""
# First eight hex digits of md5 as a number, modulo 100.
_BUCKET_SQL = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


def _labelled_orders(t):
    return t.orders.select(
        "o_orderkey",
        money("o_totalprice").cast("double").alias("amount"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("attempts"),
        F.dayofmonth("o_orderdate").alias("day"),
        F.col("o_orderstatus").alias("type"),
    )


@query(_FRAME_SQL)
def classification_frame(t):
    return analysis.classification_frame(_labelled_orders(t), FEATURES, keep=["o_orderkey"])


@query(f"SELECT o_orderkey, {_BUCKET_SQL} < 80 AS is_train FROM orders")
def hash_split(t):
    return t.orders.select("o_orderkey", analysis.split_column("o_orderkey", portable=True).alias("is_train"))


def _log_density(feature: str) -> str:
    return f"- 0.5 * ln(2 * pi() * v_{feature}) - (f.{feature} - m_{feature}) * (f.{feature} - m_{feature}) / (2 * v_{feature})"


NB_SQL = f"""
    WITH frame AS MATERIALIZED (SELECT *, {_BUCKET_SQL} < 80 AS is_train FROM ({_FRAME_SQL})),
         extra AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in FEATURES)}) AS e, COUNT(*) AS total FROM frame WHERE is_train),
         model AS (SELECT label AS c, COUNT(*) / any_value(total) AS prior,
                          {', '.join(f'AVG({c}) AS m_{c}, var_pop({c}) + any_value(e) AS v_{c}' for c in FEATURES)}
                   FROM frame, extra WHERE is_train GROUP BY label)
    SELECT o_orderkey, type, label, prediction FROM (
        SELECT f.o_orderkey, f.type, f.label, m.c AS prediction, row_number() OVER (PARTITION BY f.o_orderkey
               ORDER BY ln(prior) {' '.join(_log_density(c) for c in FEATURES)} DESC, m.c) AS rn
        FROM frame f, model m WHERE NOT f.is_train) WHERE rn = 1"""


@query(NB_SQL)
def nb_predict(t):
    return analysis.classify(_labelled_orders(t), "o_orderkey", FEATURES, portable=True)


# The rule under test: long documents are good.
_RULED_SQL = """SELECT quality AS label, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS prediction
    FROM labels JOIN documents USING (doc_id)"""


def _ruled(t):
    rule = F.when(F.col("n_chars") > 1500, 1).otherwise(0)
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").alias("label"), rule.alias("prediction")
    )


@query(f"SELECT label, prediction, COUNT(*) AS n FROM ({_RULED_SQL}) GROUP BY ALL")
def confusion(t):
    return stats.confusion(_ruled(t), "label", "prediction")


@query(f"""
    WITH r AS ({_RULED_SQL}), c AS (SELECT DISTINCT unnest([label, prediction]) AS label FROM r),
         s AS (SELECT c.label, COUNT(*) FILTER (WHERE r.label = c.label) AS support,
                      COUNT(*) FILTER (WHERE r.prediction = c.label) AS predicted,
                      COUNT(*) FILTER (WHERE r.label = c.label AND r.prediction = c.label) AS hits FROM c, r GROUP BY 1),
         p AS (SELECT label, support, CASE WHEN predicted = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / predicted END AS "precision",
                      CASE WHEN support = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / support END AS recall FROM s)
    SELECT *, CASE WHEN "precision" + recall = 0 THEN 0 ELSE 2 * "precision" * recall / ("precision" + recall) END AS f1 FROM p""")
def class_report(t):
    return stats.class_report(_ruled(t), "label", "prediction")


@query("SELECT c_custkey, c_acctbal, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INT) AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer")
def one_hot_found(t):
    """The same without a list of categories."""
    return analysis.one_hot(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), "c_mktsegment")


_AXES = ["balance", "avg_amount", *[f"(occupation = '{s}')::INT" for s in SEGMENTS], "(dominant_type = 'Credit')::INT", "(dominant_type = 'Debit')::INT"]
_D = len(_AXES)


def _scaled(i: int) -> str:
    return f"COALESCE((f{i} - AVG(f{i}) OVER ()) / nullif(stddev_pop(f{i}) OVER (), 0), 0)"


def _leading(matrix: str, name: str) -> str:
    """The leading eigenvector and its value: the matrix is squared until one direction is left."""
    return f"""
    {name}_power AS (
        SELECT 0 AS step, m FROM {matrix}
        UNION ALL
        SELECT step + 1, [[x / list_max([list_max([abs(y) FOR y IN s]) FOR s IN p]) FOR x IN r] FOR r IN p]
        FROM (SELECT step, [[list_dot_product(r, c) FOR c IN m] FOR r IN m] AS p FROM {name}_power WHERE step < 40)),
    {name}_column AS (
        SELECT m[list_position([m[i][i] FOR i IN range(1, {_D + 1})], list_max([m[i][i] FOR i IN range(1, {_D + 1})]))] AS v
        FROM {name}_power WHERE step = 40),
    {name}_unit AS (SELECT [x / sqrt(list_dot_product(v, v)) FOR x IN v] AS v FROM {name}_column),
    {name} AS (
        SELECT [x * sign([y FOR y IN v IF abs(y) >= list_max([abs(z) FOR z IN v]) / 2][1]) FOR x IN v] AS v,
               list_dot_product(v, [list_dot_product(r, v) FOR r IN m]) AS value
        FROM {name}_unit, {matrix})"""


_PC_SQL = f"""
    features AS (SELECT user_id, {', '.join(f'CAST({x} AS DOUBLE) AS f{i}' for i, x in enumerate(_AXES))} FROM ({USER_FEATURES_SQL})),
    scaled AS (SELECT user_id, {', '.join(f'{_scaled(i)} AS f{i}' for i in range(_D))} FROM features),
    covariance AS (SELECT [{', '.join('[' + ', '.join(f'covar_pop(f{i}, f{j})' for j in range(_D)) + ']' for i in range(_D))}] AS m FROM scaled),
    {_leading('covariance', 'first')},
    rest AS (SELECT [[m[i][j] - value * v[i] * v[j] FOR j IN range(1, {_D + 1})] FOR i IN range(1, {_D + 1})] AS m FROM covariance, first),
    {_leading('rest', 'second')},
    points AS (
        SELECT user_id, round(list_dot_product(x, first.v), 6) + 0.0 AS pc1, round(list_dot_product(x, second.v), 6) + 0.0 AS pc2
        FROM (SELECT user_id, [{', '.join(f'f{i}' for i in range(_D))}] AS x FROM scaled), first, second)"""

PCA_SQL = f"WITH RECURSIVE {_PC_SQL} SELECT user_id, pc1, pc2 FROM points"

KMEANS_SQL = f"""
    WITH RECURSIVE {_PC_SQL},
    far AS (
        SELECT 1 AS n, [arg_max([pc1, pc2], [-(pc1 * pc1 + pc2 * pc2), pc1, pc2])] AS cs FROM points
        UNION ALL
        SELECT n + 1, list_append(any_value(cs), arg_max([pc1, pc2], [near, pc1, pc2])) FROM (
            SELECT n, cs, pc1, pc2, list_min([(pc1 - c[1]) ** 2 + (pc2 - c[2]) ** 2 FOR c IN cs]) AS near FROM far, points WHERE n < 3)
        GROUP BY n),
    lloyd AS (
        SELECT 0 AS step, cs FROM far WHERE n = 3
        UNION ALL
        SELECT step + 1, list(centre ORDER BY i) FROM (
            SELECT step, i, [round(AVG(pc1), 9), round(AVG(pc2), 9)] AS centre FROM (
                SELECT step, pc1, pc2, list_position(d, list_min(d)) AS i FROM (
                    SELECT step, pc1, pc2, [(pc1 - c[1]) ** 2 + (pc2 - c[2]) ** 2 FOR c IN cs] AS d FROM lloyd, points WHERE step < 30))
            GROUP BY step, i) GROUP BY step),
    centres AS (SELECT list_sort(cs) AS cs FROM lloyd WHERE step = 30)
    SELECT user_id, CAST(list_position(d, list_min(d)) - 1 AS INT) AS cluster
    FROM (SELECT user_id, [(pc1 - c[1]) ** 2 + (pc2 - c[2]) ** 2 FOR c IN cs] AS d FROM points, centres)"""


@query(KMEANS_SQL)
def kmeans_clusters(t):
    rows = analysis.cluster_users(_user_features(t), ["balance", "avg_amount"], ["occupation", "dominant_type"]).rows
    return rows.select("user_id", "cluster")


@query(PCA_SQL)
def pca_components(t):
    rows = analysis.cluster_users(_user_features(t), ["balance", "avg_amount"], ["occupation", "dominant_type"]).rows
    return rows.select("user_id", F.get("pc", F.lit(0)).alias("pc1"), F.get("pc", F.lit(1)).alias("pc2"))
