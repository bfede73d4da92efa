"""Sparse text features, clustering, topics and classification."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    HashingTF,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura import wordlists as W
from murmura.functions import text
from murmura.functions.once import once
from murmura.operators import skipgram
from murmura.operators import topics as topic_tables
from murmura.operators.chunks import apply_chunks, coded, sizes_of, text_counts
from murmura.operators.scale import FREQUENT_KEYS, join_frequent_apart, top_n_per_group
from murmura.session import materialize


def feature_tokens(c: Column, stopwords: Sequence[str] = W.STOPWORDS) -> Column:
    """Lower-cased words of at least two characters without stop words."""
    return F.filter(text.words(c), lambda t: (F.length(t) >= 2) & ~t.isin(*stopwords))


# --- sparse features as rows -----------------------------------------------------


def bow(df: DataFrame, column: str, id_col: str, min_df: int = 2, max_df: float = 0.95, stopwords: Sequence[str] = W.STOPWORDS) -> DataFrame:
    """``(id, term, tf, df, n)``: term counts per text for terms in at least ``min_df`` texts and at most ``max_df`` of them.

    A corpus of one text keeps every term.
    """
    rows = df.select(F.col(id_col).alias("id"), F.explode(feature_tokens(F.col(column), stopwords)).alias("term"))
    return _kept_terms(rows, df, min_df, max_df)


def _kept_terms(rows: DataFrame, df: DataFrame, min_df: int, max_df: float) -> DataFrame:
    n = df.agg(F.count("*").alias("n")).scalar()
    # Written once: the texts are parsed in one pass, and both uses read the counts.
    counts = materialize(rows.groupBy("id", "term").agg(F.count("*").alias("tf")))
    kept = (
        counts.groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("n", n)
        .filter((F.col("n") < 2) | ((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("n"))))
    )
    kept = materialize(kept)
    common = kept.orderBy(F.desc("df"), "term").limit(FREQUENT_KEYS)
    return join_frequent_apart(counts, kept, "term", frequent=common).select("id", "term", "tf", "df", "n")


def tfidf(df: DataFrame, column: str, id_col: str, stopwords: Sequence[str] = W.STOPWORDS) -> DataFrame:
    """``(id, term, weight)``: ``tf * (ln((1 + n) / (1 + df)) + 1)``, scaled to unit length per text."""
    return _unit_tfidf(bow(df, column, id_col, min_df=1, max_df=1.0, stopwords=stopwords))


def _normed(counts: DataFrame) -> DataFrame:
    """``(id, terms, norm)``: the terms of each text with their raw weights, and their length."""
    raw = F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    # A text's terms meet once; its length is then taken in the row.
    texts = counts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", raw.alias("raw")))).alias("terms"))
    norm = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda s, t: s + t["raw"] * t["raw"]))
    return once(texts, norm=norm)


def _unit_tfidf(counts: DataFrame) -> DataFrame:
    return _normed(counts).select("id", "norm", F.inline("terms")).select("id", "term", (F.col("raw") / F.col("norm")).alias("weight"))


def multi_hot(df: DataFrame, column: str, id_col: str) -> DataFrame:
    """``(id, value, hot)``: one row per distinct member of an array column."""
    return df.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(column)).alias("value")).withColumn("hot", F.lit(1))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, weight)``: ``n / (classes * n_class)``."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn("t", totals).select(label, (F.col("t.n") / (F.col("t.k") * F.col("n"))).alias("weight"))


# --- vector features -------------------------------------------------------------

# Dimensions of the projected blocks, and how many of them each term marks.
TEXT_WIDTH, SET_WIDTH, MARKS_PER_TERM = 256, 64, 4


def term_weights(df: DataFrame, tokens: str, id_col: str) -> DataFrame:
    """``(id, term, weight)``: unit-length TF-IDF of a token array column."""
    return _unit_tfidf(_kept_terms(df.select(F.col(id_col).alias("id"), F.explode(tokens).alias("term")), df, 1, 1.0))


def term_lists(df: DataFrame, tokens: str, id_col: str) -> DataFrame:
    """``(id, terms)``: ``term_weights`` with the terms of a text in one row."""
    normed = _normed(_kept_terms(df.select(F.col(id_col).alias("id"), F.explode(tokens).alias("term")), df, 1, 1.0))
    return normed.select("id", F.transform("terms", lambda t: F.struct(t["term"].alias("term"), (t["raw"] / F.col("norm")).alias("weight"))).alias("terms"))


def _sums(slot: np.ndarray, x: np.ndarray, rows: int, width: int) -> pa.Array:
    """Vectors of ``width`` for each row: the sums of ``x`` by slot. In a fixed order, which gives the same doubles each time."""
    order = np.argsort(x, kind="stable")
    sums = np.bincount(slot[order], weights=x[order], minlength=rows * width)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(sums, pa.float64()))


def _summed(width: int, marks: int):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def add(hashes: pa.Array, weights: pa.Array) -> pa.Array:
        sizes = sizes_of(weights)
        h = hashes.flatten().to_numpy(zero_copy_only=False)
        x = np.repeat(pc.fill_null(weights.flatten(), 0.0).to_numpy(zero_copy_only=False), marks) * np.where(h < 0, -1.0, 1.0) / marks**0.5
        return _sums(np.repeat(np.arange(len(sizes)), sizes * marks) * width + np.mod(h, width), x, len(sizes), width)

    return add


def project_terms(terms: Column, width: int, seed: int = 42) -> Column:
    """Terms ``array<struct<term, weight>>`` of a row as a vector: a seeded sparse random projection, in the row.

    Each term adds its weight to a few dimensions with random signs, all drawn
    from its hash, so every term counts whatever the size of the vocabulary and
    lengths and angles are kept on average.
    """
    hashes = F.flatten(F.transform(terms, lambda t: F.array(*[F.xxhash64(t["term"], F.lit(seed), F.lit(k)) for k in range(MARKS_PER_TERM)])))
    return _summed(width, MARKS_PER_TERM)(hashes, F.transform(terms, lambda t: t["weight"]))


def project(weights: DataFrame, width: int, seed: int = 42) -> DataFrame:
    """``(id, projected)`` from ``(id, term, weight)``, by ``project_terms``."""
    texts = weights.groupBy("id").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    return texts.select("id", project_terms(F.col("terms"), width, seed).alias("projected"))


def assemble(
    df: DataFrame,
    column: str = "comment_body",
    community: str = "subreddit",
    entities: str = "entities",
    numeric: Sequence[str] = ("subjectivity", "polarity", "comment_score"),
    out: str = "features",
    beside: Sequence[str] | None = None,
) -> DataFrame:
    """Community TF-IDF, text TF-IDF, numbers and entity marks in one vector, block by block on the same row.

    The blocks of terms are projected to fixed widths. Terms are numbers into those of a chunk of rows, a chunk sends each
    of its terms once, and the weights of a text arise in its chunk. ``beside`` are the columns of ``df`` that stay, all
    of them unless said. The vectors are not stored: who reads them more than once should write them.
    """
    beside = list(df.columns if beside is None else beside)
    marks = F.transform(F.coalesce(F.array_distinct(entities), F.array().cast("array<string>")), lambda e: F.struct(e.alias("term"), F.lit(1.0).alias("weight")))
    blocks = {"_community": SET_WIDTH, "_text": TEXT_WIDTH}
    rows = df.select(
        *beside,
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]).alias("_numbers"),
        project_terms(marks, SET_WIDTH).alias("_entities"),
        feature_tokens(F.col(community), stopwords=("",)).alias("_community"),
        feature_tokens(F.col(column)).alias("_text"),
    )
    texts, words = coded(rows, list(blocks))
    vectors = _projected_chunks(texts, words, blocks)
    whole = F.concat("_community", "_text", "_numbers", "_entities")
    return vectors.select(*beside, array_to_vector(whole).alias(out))


def _projected_chunks(texts: DataFrame, words: DataFrame, blocks: dict[str, int], seed: int = 42) -> DataFrame:
    """``texts`` of ``coded`` with the tokens of each column of ``blocks`` as the ``project_terms`` of their ``term_lists``."""
    n = texts.agg(F.count("*").alias("n")).scalar()
    width = F.element_at(F.array(*[F.lit(w) for w in blocks.values()]), F.col("_which") + 1)
    # Where a term adds its weight and with which sign: the numbers are below twice the width.
    marks = [F.xxhash64("token", F.lit(seed), F.lit(k)) for k in range(MARKS_PER_TERM)]
    slots = F.array(*[(F.pmod(h, width) * 2 + (h < 0).cast("int")).cast("int") for h in marks])
    factors = words.groupBy("_which", "token").agg(F.sum("docs").alias("df")).withColumn("n", n)
    factors = factors.select("_which", "token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("factor"), slots.alias("slots"))
    # Written once: the shuffles by term go before the chunks are gathered.
    known = materialize(words.join(factors, ["_which", "token"]).select("_chunk", "_which", "_code", "factor", "slots"))
    schema = T.StructType([T.StructField(f.name, T.ArrayType(T.DoubleType()) if f.name in blocks else f.dataType) for f in texts.schema if f.name != "_chunk"])

    def project(part: pa.Table, known: pa.Table) -> pa.Table:
        which = known["_which"].to_numpy()
        for k, (name, width) in enumerate(blocks.items()):
            own = known.filter(pa.array(which == k))
            code = own["_code"].to_numpy()
            factor, slots = np.zeros(len(code)), np.zeros((len(code), MARKS_PER_TERM), np.int64)
            factor[code] = own["factor"].to_numpy()
            slots[code] = own["slots"].combine_chunks().flatten().to_numpy().reshape(-1, MARKS_PER_TERM)
            text, term, tf = text_counts(part[name].combine_chunks(), len(code))
            raw = tf * factor[term]
            norm = np.sqrt(np.bincount(text, weights=raw * raw, minlength=part.num_rows))
            held = slots[term]
            x = (raw / norm[text])[:, None] * np.where(held % 2, -1.0, 1.0) / MARKS_PER_TERM**0.5
            column = _sums((text[:, None] * width + held // 2).ravel(), x.ravel(), part.num_rows, width)
            part = part.set_column(part.schema.get_field_index(name), name, column)
        return part.drop_columns(["_chunk"])

    return apply_chunks(texts, known, project, schema)


def reduce(df: DataFrame, k: int = 50, features: str = "features", out: str = "reduced") -> DataFrame:
    """Principal components. Spark does not centre, which shifts all points alike: distances and clusters are unaffected."""
    width = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs") or df.select(features).first()[0].size
    return PCA(k=min(k, width), inputCol=features, outputCol=out).fit(df).transform(df)


def cluster(df: DataFrame, k: int = 3, features: str = "reduced", out: str = "cluster", seed: int = 42) -> DataFrame:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=out).fit(df).transform(df)


def embed(df: DataFrame, tokens: str, out: str = "vector", size: int = 64, min_count: int = 2, seed: int = 42) -> DataFrame:
    """Text vectors trained on the corpus: the mean of its word vectors."""
    rows = skipgram.dealt(df, tokens)
    means = skipgram.mean_vectors(rows, tokens, skipgram.train(rows, tokens, size, min_count, seed), size)
    return rows.drop("_chunk").join(means.select("_row", F.col("vector").alias(out)), "_row").drop("_row")


def embedding_clusters(df: DataFrame, vector: str = "vector", dims: int = 50, k: int = 6) -> DataFrame:
    """Pooled text vectors, principal components, clusters."""
    vectors = df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    return cluster(reduce(vectors, dims, "_features"), k).drop("_features")


# Words up to which topics are fitted by Spark's own estimators, whose vocabulary and matrix stand on the driver; more are tables.
WORDS_ON_DRIVER = 100_000


# --- topics ------------------------------------------------------------------------


def topics(df: DataFrame, column: str, k: int = 5, terms: int = 20, min_df: float = 2.0, max_df: float = 0.95, seed: int = 42, iterations: int = 10) -> DataFrame:
    """``(topic, rank, term, weight)``: the strongest terms of each topic."""
    return _topics(_tokens(df, column), k, terms, min_df, max_df, seed, iterations)


def _tokens(df: DataFrame, column: str) -> DataFrame:
    # Written once: the texts are parsed in one pass, and all others read their words.
    return materialize(df.select(feature_tokens(F.col(column)).alias("tokens")))


def _topics(tokens: DataFrame, k: int, terms: int, min_df: float, max_df: float, seed: int, iterations: int) -> DataFrame:
    words = tokens.select(F.explode("tokens").alias("t")).agg(F.count_distinct("t")).first()[0]
    if words > WORDS_ON_DRIVER:
        return top_terms(topic_tables.fit(tokens, k, terms, min_df, max_df, seed, iterations), terms)
    counter = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=max(2, words), minDF=min_df, maxDF=max_df).fit(tokens)
    counted = counter.transform(tokens).select("counts")
    model = LDA(k=k, seed=seed, optimizer="online", maxIter=iterations, featuresCol="counts").fit(counted)
    described = model.describeTopics(terms).select(
        "topic", F.inline(F.arrays_zip(F.col("termIndices").alias("i"), F.col("termWeights").alias("weight")))
    )
    vocabulary = tokens.sparkSession.createDataFrame(pa.table({"i": list(range(len(counter.vocabulary))), "term": counter.vocabulary}))
    named = described.join(vocabulary, "i").select("topic", "term", "weight")
    return top_terms(named, terms)


def top_terms(weights: DataFrame, k: int = 20) -> DataFrame:
    """``(topic, term, weight, rank)``: the ``k`` heaviest terms per topic."""
    return top_n_per_group(weights, ["topic"], [F.desc("weight"), F.col("term")], k)


def topic_keywords(df: DataFrame, column: str, k: int = 5, terms: int = 20, seed: int = 42) -> DataFrame:
    """``(keyword, count)``: union of the topics' strongest terms with their counts in the corpus, most frequent first."""
    tokens = _tokens(df, column)
    strongest = _topics(tokens, k, terms, 2.0, 0.95, seed, 10).select(F.col("term").alias("keyword")).distinct()
    # ``k * terms`` keywords at most: they go to the words, so that no other word is grouped.
    named = tokens.select(F.explode("tokens").alias("keyword")).join(F.broadcast(strongest), "keyword", "left_semi")
    return named.groupBy("keyword").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "keyword")


# --- classification ----------------------------------------------------------------


def train_balanced_lr(df: DataFrame, features: str = "reduced", label: str = "label", max_iter: int = 1000):
    """Logistic regression with each class weighted by ``n / (classes * n_class)``."""
    table = class_weights(df, label).agg(F.map_from_entries(F.collect_list(F.struct(label, "weight")))).scalar()
    weighted = df.withColumn("_weight", F.element_at(table, F.col(label)))
    return LogisticRegression(featuresCol=features, labelCol=label, weightCol="_weight", maxIter=max_iter).fit(weighted)


def _lr_stage(width: int, classes: int):
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=50, family="multinomial")


def _mlp_stage(width: int, classes: int):
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=[width, 32, classes], seed=42, maxIter=50)


CLASSIFIERS = {"logistic": _lr_stage, "perceptron": _mlp_stage}


def train_sentiment(df: DataFrame, column: str = "text", classes: int = 3, model: str = "logistic", width: int = 1 << 16, embedding: int = 64) -> PipelineModel:
    """Text classifier from ``(text, label)`` with labels 0 to ``classes - 1``.

    ``logistic`` works on hashed TF-IDF; ``perceptron`` on the mean of trained word vectors.
    """
    tokens = SQLTransformer(
        statement=f"SELECT *, filter(split(regexp_replace(lower(coalesce({column}, '')), '[^\\\\p{{L}}\\\\p{{N}}_]', ' '), ' +'), t -> t <> '') AS _tokens FROM __THIS__"
    )
    if model == "logistic":
        stages = [HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=width), IDF(inputCol="_tf", outputCol="features")]
        size = width
    else:
        stages = [skipgram.SkipGram(vectorSize=embedding, minCount=1, seed=42, inputCol="_tokens", outputCol="features")]
        size = embedding
    fitted = Pipeline(stages=[tokens, *stages, CLASSIFIERS[model](size, classes)]).fit(df.withColumn("label", F.col("label").cast("double")))
    return fitted


def predict_sentiment(df: DataFrame, model: PipelineModel, out: str = "sentiment") -> DataFrame:
    """Label every text in one pass: class 0 is negative, all others positive."""
    scored = model.transform(df)
    chosen = text.argmax(text.softmax(vector_to_array("rawPrediction")))
    return scored.withColumn(out, text.class_label(chosen)).select(*df.columns, out)
