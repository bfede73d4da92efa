"""Vectors, cluster quality and training-run analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura.operators import labels as L
from murmura.operators import vectors as V
from murmura.suite.base import query, table

DIM = 64


def _sequence(spark, d):
    """Embeddings as the token vectors of short texts; every fourth token is unknown."""
    e = table(spark, d, "embeddings")
    known = F.when(F.col("vec_id") % 4 != 0, F.col("embedding"))
    return e.select(F.floor(F.col("vec_id") / 32).alias("doc_id"), F.col("vec_id").alias("pos"), known.alias("vector"))


def _dims(df, *keys):
    """One row per vector element, rounded."""
    return df.select(*keys, F.posexplode("vector").alias("dim", "x")).withColumn("x", F.round("x", 6))


_SEQ = """seq AS (SELECT vec_id // 32 AS doc_id, vec_id AS pos, CASE WHEN vec_id % 4 <> 0 THEN embedding END AS vector FROM embeddings),
dims AS (SELECT doc_id, pos, CAST(dim - 1 AS INTEGER) AS dim, CAST(vector[dim] AS DOUBLE) AS x FROM seq, (SELECT unnest(range(1, 65)) AS dim))"""


def _pool(how: str, sql: str):
    @query(f"a15_pool_{how}", f"WITH {_SEQ} SELECT doc_id, dim, round({sql}, 6) AS x FROM dims WHERE x IS NOT NULL GROUP BY doc_id, dim")
    def pooled(spark, d):
        return _dims(V.pool_vectors(_sequence(spark, d), how), "doc_id")


_pool("mean", "avg(x)")
_pool("max", "max(x)")
_pool("last", "max_by(x, pos)")


@query(
    "w3_oov_average_context",
    f"""WITH {_SEQ} SELECT doc_id, pos, dim, round(coalesce(x, avg(x) OVER (PARTITION BY doc_id, dim ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 0.0), 6) AS x FROM dims""",
)
def w3(spark, d):
    return _dims(V.oov_average_context(_sequence(spark, d), DIM), "doc_id", "pos")


@query("w4_oov_average", f"WITH {_SEQ} SELECT doc_id, pos, dim, round(coalesce(x, avg(x) OVER (PARTITION BY doc_id, dim), 0.0), 6) AS x FROM dims")
def w4(spark, d):
    return _dims(V.oov_average(_sequence(spark, d), DIM), "doc_id", "pos")


@query(
    "w5_oov_using_unk",
    f"""WITH {_SEQ} SELECT doc_id, pos, dim, round(coalesce(x, ('0x' || substr(md5('0:' || (dim + 1)), 1, 8))::BIGINT / 4294967296.0), 6) AS x FROM dims""",
)
def w5(spark, d):
    return _dims(V.oov_using_unk(_sequence(spark, d), DIM), "doc_id", "pos")


# --- clusters ------------------------------------------------------------------------


_CLUSTERS = """pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT vec_id, label, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM pts),
cd AS (SELECT label, dim, avg(x) AS x FROM pd GROUP BY ALL),
cents AS (SELECT label, list(x ORDER BY dim) AS c FROM cd GROUP BY label),
spreads AS (SELECT p.label, avg(list_distance(p.v, c.c)) AS spread FROM pts p JOIN cents c USING (label) GROUP BY p.label)"""


@query(
    "m14_centroid_distances",
    f"WITH {_CLUSTERS} SELECT a.label AS a, b.label AS b, round(list_distance(a.c, b.c), 6) AS distance FROM cents a, cents b",
)
def m14_centroids(spark, d):
    return V.centroid_distances(table(spark, d, "embeddings"), "label", "embedding").withColumn("distance", F.round("distance", 6))


@query(
    "m14_davies_bouldin",
    f"""WITH {_CLUSTERS}, worst AS (SELECT a.label, max((x.spread + y.spread) / list_distance(a.c, b.c)) AS r FROM cents a JOIN cents b ON a.label <> b.label
  JOIN spreads x ON x.label = a.label JOIN spreads y ON y.label = b.label GROUP BY a.label)
SELECT round(avg(r), 6) AS davies_bouldin FROM worst""",
)
def m14_db(spark, d):
    return V.davies_bouldin(table(spark, d, "embeddings"), "label", "embedding").select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query("m14_intra_distance", f"WITH {_CLUSTERS} SELECT round(avg(spread), 6) AS mean_intra_distance FROM spreads")
def m14_intra(spark, d):
    return V.mean_intra_distance(table(spark, d, "embeddings"), "label", "embedding").select(F.round("mean_intra_distance", 6).alias("mean_intra_distance"))


@query(
    "m14_silhouette_squared",
    f"""WITH {_CLUSTERS}, pair AS (SELECT p.vec_id, p.label AS own, q.label AS other, sum(list_distance(p.v, q.v) ** 2) AS total, count(*) AS n
  FROM pts p, pts q GROUP BY ALL),
ab AS (SELECT vec_id, max(total / (n - 1)) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b FROM pair GROUP BY vec_id)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette_squared FROM ab""",
)
def m14_silhouette(spark, d):
    return V.silhouette_squared(table(spark, d, "embeddings"), "label", "embedding").select(F.round("silhouette_squared", 6).alias("silhouette_squared"))


@query(
    "m15_cosine_topk",
    f"""WITH {_CLUSTERS}, s AS (SELECT c.label AS query_id, p.vec_id AS id, round(list_cosine_similarity(c.c, p.v), 9) AS cosine FROM cents c, pts p)
SELECT query_id, id, round(cosine, 6) AS cosine, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS INTEGER) AS rank FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) <= 20""",
)
def m15(spark, d):
    e = table(spark, d, "embeddings")
    asked = V.centroids(e, "label", "embedding").select(F.col("cluster").alias("query_id"), F.col("centroid").alias("vector"))
    found = V.cosine_topk(asked, e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
    return found.withColumn("cosine", F.round("cosine", 6))


# --- training runs -------------------------------------------------------------------


def _series(spark, d):
    """Event values as the metric series of one run per event type."""
    return table(spark, d, "events").select(F.col("event_type").alias("run"), F.col("event_id").alias("epoch"), "value")


def _sql_stop(patience: int, flip: str = "") -> str:
    floor = "0.0" if not flip else "CAST('-inf' AS DOUBLE)"
    return f"""WITH s AS (SELECT event_type AS run, event_id AS epoch, {flip}value AS v FROM events),
b AS (SELECT *, greatest({floor}, coalesce(max(v) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {floor})) AS prior FROM s),
g AS (SELECT *, CAST(v > prior AS INTEGER) AS up, CAST(v < prior AS INTEGER) AS down FROM b),
h AS (SELECT *, sum(up) OVER (PARTITION BY run ORDER BY epoch) AS grp FROM g),
k AS (SELECT *, sum(down) OVER (PARTITION BY run, grp ORDER BY epoch) AS counter FROM h)
SELECT run, min(epoch) AS stop_epoch FROM k WHERE down = 1 AND counter >= {patience} GROUP BY run"""


@query("w7_early_stop", _sql_stop(10))
def w7(spark, d):
    return L.early_stop_epoch(_series(spark, d), patience=10)


@query("w7_early_stop_loss", _sql_stop(25, "-"))
def w7_loss(spark, d):
    return L.early_stop_epoch(_series(spark, d), patience=25, greater_is_better=False)


@query(
    "w8_final_metrics",
    """SELECT event_type AS run, CAST(user_id AS VARCHAR) AS metric, arg_max(value, event_id) AS final, max(value) AS best,
  arg_max(event_id, (value, -event_id)) AS best_step FROM events GROUP BY ALL""",
)
def w8(spark, d):
    series = table(spark, d, "events").select(
        F.col("event_type").alias("run"), F.col("user_id").cast("string").alias("metric"), F.col("event_id").alias("step"), "value"
    )
    return L.final_metrics(series)


@query(
    "w12_running_metrics",
    """WITH p AS (SELECT event_type AS run, event_id // 32 AS step, CAST(value > 20 AS INTEGER) AS pred, CAST(user_id % 3 AS INTEGER) AS label FROM events),
c AS (SELECT run, step, count(*) AS total, count(*) FILTER (WHERE pred = label) AS correct, count(*) FILTER (WHERE pred = 1 AND label = 1) AS tp,
  count(*) FILTER (WHERE pred = 1 AND label = 0) AS fp, count(*) FILTER (WHERE pred = 0 AND label = 1) AS fn FROM p GROUP BY run, step),
r AS (SELECT run, step, sum(total) OVER w AS total, sum(correct) OVER w AS correct, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(fn) OVER w AS fn
  FROM c WINDOW w AS (PARTITION BY run ORDER BY step)),
m AS (SELECT run, step, correct / total AS accuracy, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM r)
SELECT run, step, round(accuracy::DOUBLE, 6) AS accuracy, round((CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END)::DOUBLE, 6) AS f1,
  round(p::DOUBLE, 6) AS precision, round(r::DOUBLE, 6) AS recall FROM m""",
)
def w12(spark, d):
    preds = table(spark, d, "events").select(
        F.col("event_type").alias("run"), F.floor(F.col("event_id") / 32).alias("step"),
        (F.col("value") > 20).cast("int").alias("pred"), (F.col("user_id") % 3).cast("int").alias("label"),
    )
    metrics = L.running_metrics(preds, ["run"], "step")
    return metrics.select("run", "step", *[F.round(n, 6).alias(n) for n in L.METRICS])


@query("w12_mean_loss", "SELECT event_type AS run, event_id // 1000 AS epoch, round(avg(value), 6) AS mean_loss FROM events GROUP BY ALL")
def w12_loss(spark, d):
    losses = table(spark, d, "events").select(F.col("event_type").alias("run"), F.floor(F.col("event_id") / 1000).alias("epoch"), F.col("value").alias("loss"))
    return L.mean_loss(losses).withColumn("mean_loss", F.round("mean_loss", 6))
