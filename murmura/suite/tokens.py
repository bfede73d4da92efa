"""Vocabularies, encodings, pair merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura.operators import labels as L
from murmura.operators import tokenizers as T
from murmura.operators.sampling import split_by_hash
from murmura.session import materialize
from murmura.suite.base import query, sql_tokens, table
from murmura.suite.sources import _VOCAB_SQL


def _vocab(spark, d):
    return T.build_vocab(T.text_tokens(table(spark, d, "documents"), "text", "doc_id"))


@query("w6_build_vocab", f"WITH {_VOCAB_SQL} SELECT token, id FROM full_vocab")
def w6(spark, d):
    return _vocab(spark, d)


_TRAIN = "('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 1000 < 800"
_SPLIT_VOCAB = _VOCAB_SQL.replace("FROM documents)),", f"FROM documents WHERE {_TRAIN})),", 1)
_ALL_TOKENS = f"""every AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM (SELECT doc_id, {sql_tokens('lower(text)')} AS t FROM documents)),
ids AS (SELECT doc_id, pos, coalesce(id, (SELECT id FROM full_vocab WHERE token = '<UNK>')) AS id FROM every LEFT JOIN full_vocab USING (token))"""


def _encoded(spark, d):
    """All texts in ids of the vocabulary of the training part."""
    docs = split_by_hash(table(spark, d, "documents"), "doc_id", {"train": 0.8, "val": 0.2})
    vocab = materialize(T.build_vocab(T.text_tokens(docs.filter("split = 'train'"), "text", "doc_id")))
    return docs.select("doc_id", "split").join(T.encode(docs, "text", "doc_id", vocab), "doc_id"), vocab


@query(
    "t1_encode",
    f"""WITH {_SPLIT_VOCAB}, {_ALL_TOKENS} SELECT d.doc_id, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos), '') AS ids
FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id GROUP BY d.doc_id""",
)
def t1(spark, d):
    encoded, _ = _encoded(spark, d)
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "a11_unk_rate",
    f"""WITH {_SPLIT_VOCAB}, {_ALL_TOKENS} SELECT CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 1000 < 800 THEN 'train' ELSE 'val' END AS split,
  count(*) FILTER (WHERE id = (SELECT id FROM full_vocab WHERE token = '<UNK>')) AS unknown, count(*) AS total FROM ids GROUP BY 1""",
)
def a11(spark, d):
    encoded, vocab = _encoded(spark, d)
    unk = vocab.filter(F.col("token") == T.UNK).agg(F.max("id")).scalar()
    return L.unk_rate(encoded.withColumn("unk", unk), F.col("unk"))


@query(
    "t2_vocab_from_vectors",
    """SELECT 'w' || vec_id AS token, vec_id AS id FROM embeddings UNION ALL SELECT '<UNK>', max(vec_id) + 1 FROM embeddings
UNION ALL SELECT '<PAD>', max(vec_id) + 2 FROM embeddings""",
)
def t2(spark, d):
    return T.vocab_from_vectors(table(spark, d, "embeddings").select(F.concat(F.lit("w"), F.col("vec_id")).alias("token"), F.col("vec_id").alias("id")))


_PUNCT = T.text.ASCII_PUNCTUATION.replace("'", "''") + "\n"
_WORDS = f"""raw AS (SELECT unnest(string_split(translate(regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g'), '{_PUNCT}', ''), ' ')) AS word FROM documents),
words AS (SELECT word, count(*) AS freq FROM raw WHERE word <> '' GROUP BY word)"""


@query(
    "t3_first_pairs",
    f"""WITH {_WORDS}, p AS (SELECT freq, unnest(list_transform(range(1, CAST(len(word) AS BIGINT)), lambda i: substr(word, i, 1) || ' ' || substr(word, i + 1, 1))) AS pair FROM words)
SELECT pair, CAST(sum(freq) AS BIGINT) AS n FROM p GROUP BY pair""",
)
def t3_pairs(spark, d):
    words = T.word_frequencies(table(spark, d, "documents"), "text").withColumn("spelled", T._spell(F.col("word")))
    return T.pair_counts(words).select(F.concat_ws(" ", "left", "right").alias("pair"), "n")


# Pieces to train to, and the share of the greatest count down to which a pass merges.
PIECES, SPREAD = 2_000, 0.5
_TRAINED: dict[tuple[str, str], tuple] = {}


def trained(spark, d):
    """Rules and pieces of the folder's texts: trained once per session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TRAINED:
        rules, words = T.train_bpe(table(spark, d, "documents"), "text", vocabulary=PIECES, spread=SPREAD)
        _TRAINED[key] = (materialize(rules), words)
    return _TRAINED[key]


@query("t3_train_bpe", None)
def t3(spark, d):
    """The pieces of every word."""
    _, words = trained(spark, d)
    return words.select("word", F.array_join("pieces", " ").alias("pieces"))


@query("t3_merge_rules", None)
def t3_merges(spark, d):
    """The merge rules in order, with the count each pair had."""
    rules, _ = trained(spark, d)
    return rules


@query("t4_encode_bpe", None)
def t4(spark, d):
    """Ids of every text's pieces."""
    docs = table(spark, d, "documents")
    rules, words = trained(spark, d)
    encoded = T.encode_bpe_ids(docs.withColumn("text", T.text.clean_line(F.col("text"))), "text", "doc_id", words, T.piece_ids(rules, words))
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "t4_encode_bpe_given",
    """WITH tableau AS (SELECT DISTINCT source || '-' || lang AS word, [source, '-', lang] AS pieces FROM documents WHERE lang <> 'de'),
w AS (SELECT doc_id, unnest([source || '-' || lang, 'x']) AS word, unnest([0, 1]) AS pos FROM documents),
p AS (SELECT doc_id, pos, coalesce(t.pieces, ['<UNK>']) AS pieces FROM w LEFT JOIN tableau t USING (word))
SELECT doc_id, string_agg(array_to_string(pieces, '|'), '|' ORDER BY pos) AS pieces FROM p GROUP BY doc_id""",
)
def t4_given(spark, d):
    docs = table(spark, d, "documents").withColumn("word", F.concat_ws("-", "source", "lang"))
    known = docs.filter("lang <> 'de'").select("word", F.array("source", F.lit("-"), "lang").alias("pieces")).distinct()
    encoded = T.encode_bpe(docs.withColumn("text", F.concat_ws(" ", "word", F.lit("x"))), "text", "doc_id", known)
    return encoded.select("doc_id", F.array_join("pieces", "|").alias("pieces"))
