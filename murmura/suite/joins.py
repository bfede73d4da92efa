"""Labels, metrics, set operations, vocabulary lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura.functions import text as tx
from murmura.operators import corpus as C
from murmura.operators import labels as L
from murmura.operators.features import class_weights
from murmura.operators.vectors import closest_word, embed_vocab, oov_count
from murmura.plans.labelling import binary_sets, label_comments, size_report, with_manual_labels
from murmura.operators.sampling import split_by_hash
from murmura.session import materialize
from murmura.suite.base import BODIES, COMMENTS, LABELS, STOP, bodies, comments, manual_labels, query, sql_clean, sql_words, table
from murmura.suite.lexicon import INTENSIFIERS, NEGATIONS, polarity_table, sql_polarity
from murmura.suite.search import sql_slot, token_vectors


def predictions(spark, d):
    """Labels next to a three-way guess from the text length."""
    guess = F.col("n_chars") % 3 - 1
    docs = table(spark, d, "documents").select("doc_id", guess.cast("int").alias("pred"))
    return manual_labels(spark, d).join(docs, "doc_id")


_PREDICTIONS = f"""{LABELS}, preds AS (SELECT m.*, CAST(n_chars % 3 - 1 AS INTEGER) AS pred FROM manual_labels m JOIN documents USING (doc_id))"""


@query(
    "j1_attach_labels",
    f"""WITH {BODIES}, {LABELS}, doubled AS (SELECT comment_id, label FROM manual_labels UNION ALL SELECT comment_id, label + 1 FROM manual_labels WHERE label = -1)
SELECT b.comment_id, b.subreddit, l.label FROM bodies b JOIN (SELECT comment_id, CAST(min(label) AS INTEGER) AS label FROM doubled GROUP BY 1) l USING (comment_id)""",
)
def j1(spark, d):
    labels = manual_labels(spark, d).select("comment_id", "label")
    doubled = labels.unionByName(labels.filter("label = -1").withColumn("label", F.col("label") + 1))
    return L.attach_labels(bodies(spark, d).select("comment_id", "subreddit"), doubled)


@query(
    "j1_attach_labels_fan_out",
    f"""WITH {BODIES}, posts AS (SELECT DISTINCT b.post_id, quality AS label FROM labels l JOIN bodies b USING (doc_id))
SELECT b.comment_id, b.post_id, p.label FROM bodies b JOIN posts p USING (post_id)""",
)
def j1_fan_out(spark, d):
    b = bodies(spark, d)
    posts = table(spark, d, "labels").join(b.select("doc_id", "post_id"), "doc_id").select("post_id", F.col("quality").alias("label")).distinct()
    return L.attach_labels(b.select("comment_id", "post_id"), posts, key="post_id", dedupe=False)


_VOCAB = f"w AS (SELECT unnest({sql_words('text')}) AS token, lang FROM documents), counts AS (SELECT token, count(*) AS n FROM w GROUP BY token)"


@query(
    "j3_embed_vocab",
    f"""WITH {_VOCAB}, known AS (SELECT token, embedding FROM counts JOIN embeddings ON vec_id = {sql_slot('token')} WHERE n >= 5)
SELECT (k.token IS NULL) AS oov, count(*) AS tokens, round(avg(k.embedding[1]::DOUBLE), 6) AS first_dim FROM counts c LEFT JOIN known k USING (token) GROUP BY 1""",
)
def j3(spark, d):
    counts = C.word_counts(bodies(spark, d)).withColumnRenamed("word", "token")
    vectors = token_vectors(spark, d, counts.filter("n >= 5"))
    vocab = counts.select("token", F.xxhash64("token").alias("id"))
    embedded = embed_vocab(vocab, vectors)
    return embedded.groupBy("oov").agg(F.count("*").alias("tokens"), F.round(F.avg(F.col("vector")[0]), 6).alias("first_dim"))


@query("j3_oov_count", f"WITH {_VOCAB} SELECT count(*) FILTER (WHERE n < 5) AS oov, count(*) AS size FROM counts")
def j3_count(spark, d):
    counts = C.word_counts(bodies(spark, d)).withColumnRenamed("word", "token")
    vectors = token_vectors(spark, d, counts.filter("n >= 5"))
    return oov_count(embed_vocab(counts.select("token", F.lit(0).alias("id")), vectors))


_FUZZY = f"""WITH {_VOCAB}, folded AS (SELECT regexp_replace(strip_accents(token), '[^A-Za-z.,;:'']', '', 'g') AS token, sum(n) AS n FROM counts GROUP BY 1),
rare AS (SELECT token FROM folded WHERE n = 1), common AS (SELECT token AS match FROM folded WHERE n >= 5),
pairs AS (SELECT token, match, 1 - levenshtein(token, match) / greatest(len(token), len(match)) AS similarity FROM rare JOIN common
  ON len(match) BETWEEN len(token) - 1 AND len(token) + 1)
SELECT token, match, round(similarity, 6) AS similarity FROM pairs WHERE similarity >= 0.8 - 1e-9
QUALIFY row_number() OVER (PARTITION BY token ORDER BY similarity DESC, match) = 1"""


@query("j4_closest_word", _FUZZY)
def j4(spark, d):
    """Words seen once against words seen five times or more, without accents."""
    # Written once: the texts are parsed in one pass, and both lists read the counts.
    counts = materialize(C.word_counts(bodies(spark, d)).groupBy(tx.ascii_fold(F.col("word")).alias("token")).agg(F.sum("n").alias("n")))
    found = closest_word(counts.filter("n = 1"), counts.filter("n >= 5"))
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    "j6_set_operations",
    f"""WITH {_VOCAB}, en AS (SELECT DISTINCT token FROM w WHERE lang = 'en'), fr AS (SELECT DISTINCT token FROM w WHERE lang = 'fr')
SELECT 'only' AS kind, token FROM (SELECT token FROM en EXCEPT SELECT token FROM fr)
UNION ALL SELECT 'both', token FROM (SELECT token FROM en INTERSECT SELECT token FROM fr)
UNION ALL SELECT 'any', token FROM (SELECT token FROM en UNION SELECT token FROM fr)""",
)
def j6(spark, d):
    b = bodies(spark, d)
    en = C.word_counts(b.filter("lang = 'en'")).select(F.col("word").alias("token"))
    fr = C.word_counts(b.filter("lang = 'fr'")).select(F.col("word").alias("token"))
    only = en.join(fr, "token", "left_anti").select(F.lit("only").alias("kind"), "token")
    both = en.join(fr, "token", "left_semi").select(F.lit("both").alias("kind"), "token")
    either = en.union(fr).distinct().select(F.lit("any").alias("kind"), "token")
    return only.unionByName(both).unionByName(either)


# --- metrics -------------------------------------------------------------------------


@query(
    "a12_majority_label",
    f"""WITH {LABELS}, x AS (SELECT d.source, m.label, count(*) AS n FROM manual_labels m JOIN documents d USING (doc_id) GROUP BY ALL)
SELECT source, label AS majority FROM x QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, label) = 1""",
)
def a12(spark, d):
    labelled = manual_labels(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return L.majority_label(labelled, "source", "label")


@query(
    "m12_map_clusters",
    f"""WITH {LABELS}, x AS (SELECT m.comment_id, d.source, m.label FROM manual_labels m JOIN documents d USING (doc_id)),
n AS (SELECT source, label, count(*) AS n FROM x GROUP BY ALL),
major AS (SELECT source, label AS predicted FROM n QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, label) = 1)
SELECT comment_id, source, label, predicted FROM x JOIN major USING (source)""",
)
def m12(spark, d):
    labelled = manual_labels(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").drop("doc_id")
    return L.map_clusters(labelled, "source", "label")


_BINARY = """c AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE quality = toxic) AS correct,
  count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fp,
  count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fn FROM labels JOIN documents USING (doc_id) GROUP BY source),
r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r FROM c)"""


@query(
    "a13_binary_metrics",
    f"""WITH {_BINARY} SELECT source, round(correct / total, 6) AS accuracy, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1,
  round(p::DOUBLE, 6) AS precision, round(r::DOUBLE, 6) AS recall FROM r""",
)
def a13(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    scored = L.binary_metrics(rows, "quality", "toxic", keys=["source"])
    return scored.select("source", *[F.round(n, 6).alias(n) for n in L.METRICS])


def _sql_weighted(source: str, pred: str, label: str) -> str:
    return f"""classes AS (SELECT {label} AS class FROM {source} UNION SELECT {pred} FROM {source}),
per AS (SELECT class, (SELECT count(*) FROM {source} WHERE {label} = class) AS support, (SELECT count(*) FROM {source} WHERE {pred} = class) AS predicted,
  (SELECT count(*) FROM {source} WHERE {label} = class AND {pred} = class) AS tp FROM classes),
sc AS (SELECT support, tp, CASE WHEN predicted = 0 THEN 1.0 ELSE tp / predicted END AS p, CASE WHEN support = 0 THEN 1.0 ELSE tp / support END AS r,
  CASE WHEN support + predicted = 0 THEN 1.0 ELSE 2 * tp / (support + predicted) END AS f FROM per)
SELECT round((sum(p * support) / sum(support))::DOUBLE, 6) AS precision, round((sum(r * support) / sum(support))::DOUBLE, 6) AS recall,
  round((sum(f * support) / sum(support))::DOUBLE, 6) AS f1, round(sum(tp) / sum(support), 6) AS accuracy FROM sc"""


def _rounded(metrics):
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query("a14_weighted_metrics", f"WITH {_PREDICTIONS}, {_sql_weighted('preds', 'pred', 'label')}")
def a14(spark, d):
    return _rounded(L.weighted_metrics(predictions(spark, d), "pred", "label"))


@query("a14_weighted_empty_class", f"WITH {_PREDICTIONS}, cut AS (SELECT * REPLACE (CASE WHEN pred = 1 THEN 0 ELSE pred END AS pred) FROM preds), {_sql_weighted('cut', 'pred', 'label')}")
def a14_empty(spark, d):
    """A class that is never predicted."""
    cut = predictions(spark, d).withColumn("pred", F.when(F.col("pred") == 1, 0).otherwise(F.col("pred")))
    return _rounded(L.weighted_metrics(cut, "pred", "label"))


@query(
    "a16_random_baseline",
    f"""WITH {_PREDICTIONS}, coins AS (SELECT pred, CASE WHEN ('0x' || substr(md5('42:' || comment_id), 1, 1))::INTEGER % 2 = 0 THEN 1 ELSE -1 END AS coin FROM preds),
{_sql_weighted('coins', 'pred', 'coin')}""",
)
def a16(spark, d):
    return _rounded(L.random_baseline(predictions(spark, d), "pred", "comment_id"))


@query(
    "m13_class_weights",
    f"""WITH {LABELS}, n AS (SELECT label, count(*) AS n FROM manual_labels GROUP BY label)
SELECT label, round((SELECT sum(n) FROM n) / ((SELECT count(*) FROM n) * n), 6) AS weight FROM n""",
)
def m13_weights(spark, d):
    return class_weights(manual_labels(spark, d)).withColumn("weight", F.round("weight", 6))


# --- preparation for classification -----------------------------------------------------


_CLEANED = f"cleaned AS (SELECT *, {sql_clean('comment_body')} AS cleaned_comment FROM comments)"
_GAZETTEER = "list_filter([" + ", ".join(f"CASE WHEN contains(lower(comment_body), '{p}') THEN '{p}' END" for p in tx.W.PLATFORMS) + "], lambda x: x IS NOT NULL)"
_ENTITIES = f"array_to_string(list_sort(list_distinct(list_concat({_GAZETTEER}, regexp_extract_all(comment_body, '(\\p{{Lu}}\\p{{L}}+(?: \\p{{Lu}}\\p{{L}}+){{0,2}})', 1)))), '|')"


@query("m17_entities", f"WITH {BODIES} SELECT comment_id, {_ENTITIES} AS entities FROM bodies")
def m17(spark, d):
    return bodies(spark, d).select("comment_id", F.array_join(tx.entity_names(F.col("comment_body")), "|").alias("entities"))


@query(
    "m18_label_comments",
    f"""WITH {COMMENTS}, {_CLEANED}, {sql_polarity('cleaned', 'comment_id', 'cleaned_comment')}
SELECT comment_id, cleaned_comment, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity,
  CASE WHEN polarity > 0 THEN 'positive' ELSE 'negative' END AS sentiment, {_ENTITIES} AS entities
FROM cleaned JOIN polarity USING (comment_id) WHERE polarity <> 0""",
)
def m18(spark, d):
    labelled = label_comments(comments(spark, d), polarity_table(spark), intensifiers=INTENSIFIERS, negations=NEGATIONS)
    return labelled.select(
        "comment_id", "cleaned_comment", F.round("polarity", 6).alias("polarity"), F.round("subjectivity", 6).alias("subjectivity"),
        "sentiment", F.array_join("entities", "|").alias("entities"),
    )


_DIRTY = f"""{LABELS}, dirty AS (SELECT comment_id, CASE WHEN doc_id % 17 = 0 THEN 'unclear' ELSE CAST(label AS VARCHAR) END AS label FROM manual_labels)"""


def _dirty(spark, d):
    labels = manual_labels(spark, d)
    return labels.select("comment_id", F.when(F.col("doc_id") % 17 == 0, "unclear").otherwise(F.col("label").cast("string")).alias("label"))


@query(
    "m18_with_manual_labels",
    f"""WITH {COMMENTS}, {_CLEANED}, {sql_polarity('cleaned', 'comment_id', 'cleaned_comment')}, {_DIRTY}
SELECT comment_id, CASE WHEN polarity > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sentiment, TRY_CAST(label AS DOUBLE) AS label
FROM polarity JOIN dirty USING (comment_id) WHERE polarity <> 0 AND TRY_CAST(label AS DOUBLE) <> 0""",
)
def m18_labels(spark, d):
    labelled = label_comments(comments(spark, d), polarity_table(spark), intensifiers=INTENSIFIERS, negations=NEGATIONS)
    return with_manual_labels(labelled, _dirty(spark, d)).select("comment_id", "sentiment", "label")


_SPLIT = "CASE WHEN ('0x' || substr(md5('42:' || comment_id), 1, 8))::BIGINT % 1000 < 800 THEN 'train' ELSE 'val' END"


def _split_labels(spark, d):
    labelled = L.attach_labels(bodies(spark, d).select("comment_id", "comment_body"), _dirty(spark, d))
    return split_by_hash(labelled, "comment_id", {"train": 0.8, "val": 0.2})


@query(
    "m19_binary_sets",
    f"""WITH {BODIES}, {_DIRTY}
SELECT comment_body AS text, {_SPLIT} AS split, CAST(CASE TRY_CAST(label AS DOUBLE) WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM bodies JOIN dirty USING (comment_id) WHERE TRY_CAST(label AS DOUBLE) IN (1, -1)""",
)
def m19(spark, d):
    return binary_sets(_split_labels(spark, d))


@query(
    "m19_size_report",
    f"""WITH {BODIES}, {_DIRTY}, x AS (SELECT {_SPLIT} AS split, TRY_CAST(label AS DOUBLE) AS label FROM bodies JOIN dirty USING (comment_id))
SELECT split, count(*) AS before, count(*) FILTER (WHERE label IN (1, -1)) AS after FROM x GROUP BY split""",
)
def m19_sizes(spark, d):
    before = _split_labels(spark, d)
    return size_report(before, binary_sets(before))
