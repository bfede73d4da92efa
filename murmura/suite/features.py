"""Sparse features, clustering, topics, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import text as tx
from murmura.operators import features as M
from murmura.operators import labels as L
from murmura.operators import vectors as V
from murmura.operators.sampling import split_by_hash
from murmura.operators.sentiment import lexicon_polarity
from murmura.plans import answer as A
from murmura.session import materialize
from murmura.sources.files import to_search_docs
from murmura.suite.base import BODIES, STOP, bodies, comments, manual_labels, query, sql_words, table
from murmura.suite.joins import _ENTITIES
from murmura.suite.lexicon import INTENSIFIERS, NEGATIONS, polarity_table
from murmura.suite.search import PLAIN, index, requests


def _sql_bow(source: str, key: str, column: str, bounds: str) -> str:
    return f"""toks AS (SELECT {key} AS id, unnest(list_filter({sql_words(column)}, lambda t: len(t) >= 2 AND t NOT IN {STOP})) AS term FROM {source}),
tf AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df, (SELECT count(*) FROM {source}) AS n FROM tf GROUP BY term),
bow AS (SELECT id, term, tf, df, n FROM tf JOIN dfs USING (term) WHERE {bounds})"""


@query("m1_bag_of_words", f"WITH {_sql_bow('documents', 'doc_id', 'text', 'n < 2 OR (df >= 2 AND df <= 0.95 * n)')} SELECT id, term, tf, df FROM bow")
def m1(spark, d):
    return M.bow(table(spark, d, "documents"), "text", "doc_id").drop("n")


_TFIDF = """raw AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM bow), norms AS (SELECT id, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY id)
SELECT id, term, round(raw / norm, 6) AS weight FROM raw JOIN norms USING (id)"""


@query("m6_tfidf", f"WITH {_sql_bow('documents', 'doc_id', 'text', 'TRUE')}, {_TFIDF}")
def m6(spark, d):
    return M.tfidf(table(spark, d, "documents"), "text", "doc_id").withColumn("weight", F.round("weight", 6))


@query("m7_tfidf_community", f"WITH {_sql_bow('documents', 'doc_id', 'source', 'TRUE')}, {_TFIDF}")
def m7(spark, d):
    return M.tfidf(table(spark, d, "documents"), "source", "doc_id").withColumn("weight", F.round("weight", 6))


@query(
    "m8_multi_hot",
    f"WITH {BODIES}, e AS (SELECT comment_id AS id, unnest(string_split({_ENTITIES}, '|')) AS value FROM bodies) SELECT id, value, 1 AS hot FROM e WHERE value <> ''",
)
def m8(spark, d):
    named = bodies(spark, d).select("comment_id", tx.entity_names(F.col("comment_body")).alias("entities"))
    return M.multi_hot(named, "entities", "comment_id")


# --- learned features and models -------------------------------------------------------


def _features(spark, d):
    """The assembled vectors, stored: fits read them many times."""
    return materialize(_assembled(spark, d))


def _assembled(spark, d):
    scored = lexicon_polarity(comments(spark, d), "comment_body", polarity_table(spark), "comment_id", INTENSIFIERS, NEGATIONS)
    named = scored.withColumn("entities", tx.entity_names(F.col("comment_body")))
    rows = named.select("comment_id", "comment_body", "subreddit", "comment_score", "polarity", "subjectivity", "entities")
    return M.assemble(rows.fillna(0, ["comment_score"]), beside=[c for c in rows.columns if c != "comment_body"])


def _halves(df):
    """Rows to learn from and rows to score, by the hash of the id."""
    split = split_by_hash(df, "comment_id", {"test": 0.2, "train": 0.8})
    return split.filter("split = 'train'").drop("split"), split.filter("split = 'test'").drop("split")


@query("m9_assemble", None)
def m9(spark, d):
    """The assembled vectors, text of every entry that is not zero."""
    values = F.transform(V.vector_to_array("features"), lambda v, k: F.when(v != 0, F.concat(k.cast("string"), F.lit(":"), F.round(v, 6).cast("string"))))
    return _assembled(spark, d).select("comment_id", F.array_join(F.array_compact(values), " ").alias("features"))


@query("m10_reduce", None)
def m10(spark, d):
    reduced = M.reduce(_features(spark, d), 50)
    return reduced.select("comment_id", F.transform(V.vector_to_array("reduced"), lambda v: F.round(v, 6)).alias("reduced"))


@query("m11_cluster", None)
def m11(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return M.cluster(vectors.withColumn("reduced", M.array_to_vector(F.col("vector").cast("array<double>"))), 3).select("vec_id", "cluster")


@query("m11_cluster_metrics", None)
def m11_metrics(spark, d):
    """Clusters, majority labels, weighted metrics."""
    labelled = _features(spark, d).join(manual_labels(spark, d).select("comment_id", "label"), "comment_id").filter("label <> 0")
    clustered = M.cluster(M.reduce(labelled, 50), 3)
    return L.weighted_metrics(materialize(L.map_clusters(clustered, "cluster", "label").select("label", "predicted")), "predicted", "label")


@query("m13_balanced_regression", None)
def m13(spark, d):
    """Principal components, class weights, and metrics over rows held out of the fit."""
    labelled = _features(spark, d).join(manual_labels(spark, d).select("comment_id", "label"), "comment_id").filter("label <> 0")
    binary = labelled.withColumn("label", tx.recode_label(F.col("label").cast("double"), {1.0: 1.0, -1.0: 0.0}))
    train, test = _halves(materialize(M.reduce(binary, 50).select("comment_id", "label", "reduced")))
    return L.weighted_metrics(M.train_balanced_lr(train).transform(test), "prediction", "label")


@query("m2_topics", None)
def m2(spark, d):
    """The strongest terms of each topic."""
    return M.topics(bodies(spark, d), "comment_body")


@query("m3_topic_keywords", None)
def m3(spark, d):
    """The topics' strongest terms with their counts in the corpus."""
    return M.topic_keywords(bodies(spark, d), "comment_body")


@query(
    "w2_top_terms",
    f"""WITH w AS (SELECT lang AS topic, unnest({sql_words('text')}) AS term FROM documents), n AS (SELECT topic, term, count(*) AS weight FROM w GROUP BY ALL)
SELECT topic, term, weight, CAST(row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS INTEGER) AS rank FROM n
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) <= 20""",
)
def w2(spark, d):
    """Strongest terms per group, with the language as the topic."""
    words = table(spark, d, "documents").select(F.col("lang").alias("topic"), F.explode(tx.words(F.col("text"))).alias("term"))
    return M.top_terms(words.groupBy("topic", "term").agg(F.count("*").alias("weight")))


@query("m5_embed", None)
def m5(spark, d):
    tokens = bodies(spark, d).select("comment_id", tx.words(F.col("comment_body")).alias("tokens"))
    return M.embed(tokens, "tokens").select("comment_id", "vector")


@query("m16_embedding_clusters", None)
def m16(spark, d):
    pooled = V.pool_vectors(
        table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("doc_id"), F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
    )
    return M.embedding_clusters(pooled).select("doc_id", "cluster")


@query(
    "j7_stack_features",
    f"""WITH l AS (SELECT doc_id, quality, toxic FROM labels)
SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN l USING (doc_id)""",
)
def j7(spark, d):
    """Feature blocks stacked by key, then read back out of the vector."""
    joined = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    stacked = M.VectorAssembler(inputCols=["n_chars", "quality", "toxic"], outputCol="features").transform(joined)
    values = V.vector_to_array("features")
    return stacked.select("doc_id", values[0].cast("bigint").alias("n_chars"), values[1].cast("int").alias("quality"), values[2].cast("int").alias("toxic"))


def fitted_sentiment(spark, d, model):
    """A classifier fitted on the labelled documents that are not held out, and those that are."""
    texts = bodies(spark, d).join(manual_labels(spark, d).select("comment_id", "label"), "comment_id")
    pairs = texts.select("comment_id", F.col("comment_body").alias("text"), tx.recode_label(F.col("label"), tx.SIGN_TO_CLASS).alias("label"))
    train, test = _halves(materialize(pairs))
    return test, M.train_sentiment(train.select("text", "label"), model=model)


@query("n3_predict_sentiment", None)
def n3(spark, d):
    """Every document's label by the fitted model."""
    _, fitted = fitted_sentiment(spark, d, "logistic")
    named = M.predict_sentiment(bodies(spark, d).select("comment_id", F.col("comment_body").alias("text")), fitted)
    return named.select("comment_id", "sentiment")


@query("n4_train_sentiment", None)
def n4(spark, d):
    """Metrics of the second classifier over rows held out of the fit."""
    test, fitted = fitted_sentiment(spark, d, "perceptron")
    return L.weighted_metrics(fitted.transform(test), "prediction", "label")


@query("q15_answers_model", None)
def q15_model(spark, d):
    """Answers whose sentiment comes from the classifier fitted on the labelled documents; no SQL fits it, a test holds it against its labels."""
    _, model = fitted_sentiment(spark, d, "logistic")
    full = A.answer(index(spark, d), to_search_docs(comments(spark, d)), requests(spark), None, analyzer=PLAIN, model=model)
    return full.select("query_id", "sentiment", "record_count", F.array_join("comments.sentiment", ",").alias("sentiments"))
