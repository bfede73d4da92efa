"""Sources, sinks and schema work."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura import schemas
from murmura.functions import text as tx
from murmura.operators.sampling import split_by_hash
from murmura.operators.scale import deal_out, top_n_per_group
from murmura.operators.tokenizers import build_vocab, text_tokens
from murmura.sources import files, runs
from murmura.suite.base import BODIES, COMMENTS, bodies, comments, query, scratch, small, sql_list, sql_tokens, table

_CSV_COLUMNS = ["comment_id", "post_id", "subreddit", "title", "post_url", "post_content", "comment_body", "comment_author", "comment_score"]


@query("s1_comments_csv", f"WITH {COMMENTS} SELECT {', '.join(_CSV_COLUMNS)} FROM comments")
def s1(spark, d):
    path = scratch(spark)
    files.write_comments_csv(comments(spark, d).select(*_CSV_COLUMNS), path)
    wanted = schemas.T.StructType([f for name in _CSV_COLUMNS for f in schemas.COMMENTS if f.name == name])
    return files.read_comments_csv(spark, path, wanted)


@query("s2_csv_sink", f"WITH {BODIES} SELECT comment_id, CAST(to_json([subreddit, lang]) AS VARCHAR) AS tags FROM bodies")
def s2(spark, d):
    path = scratch(spark)
    files.write_comments_csv(bodies(spark, d).select("comment_id", F.array("subreddit", "lang").alias("tags")), path)
    return files.read_comments_csv(spark, path, schemas.T.StructType.fromDDL("comment_id string, tags string"))


_DOC_SQL = f"""WITH {COMMENTS}
SELECT comment_id AS id, post_id, subreddit, title, post_url AS url,
       coalesce(post_content, '[No content written by the author]') AS post_content, comment_id,
       comment_body AS comment_content, comment_author, comment_score AS score,
       strftime(make_timestamp(CAST(created * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS datetime
FROM comments"""


def _as_text(docs):
    columns = ["id", "post_id", "subreddit", "title", "url", "post_content", "comment_id", "comment_content", "comment_author", "score"]
    return docs.select(*columns, tx.iso_seconds(F.col("datetime")).alias("datetime"))


@query("s3_search_docs_parquet", _DOC_SQL)
def s3(spark, d):
    path = scratch(spark)
    files.write_search_docs(files.to_search_docs(comments(spark, d)), path, "parquet")
    return _as_text(files.read_search_docs(spark, path, "parquet"))


@query("s4_search_docs_json", _DOC_SQL)
def s4(spark, d):
    path = scratch(spark)
    files.write_search_docs(files.to_search_docs(comments(spark, d)), path)
    return _as_text(files.read_search_docs(spark, path))


@query(
    "s5_upsert",
    f"""WITH {BODIES}, versions AS (
  SELECT comment_id AS id, comment_body AS body, 1 AS version FROM bodies
  UNION ALL SELECT 'c' || doc_id, 'quality ' || quality, 2 FROM labels
  UNION ALL SELECT 'n' || doc_id, 'new', 1 FROM labels)
SELECT id, body, CAST(version AS INTEGER) AS version FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1""",
)
def s5(spark, d):
    current = bodies(spark, d).select(F.col("comment_id").alias("id"), F.col("comment_body").alias("body"), F.lit(1).alias("version"))
    labels = table(spark, d, "labels")
    key = F.col("doc_id").cast("string")
    changed = labels.select(F.concat(F.lit("c"), key).alias("id"), F.concat(F.lit("quality "), F.col("quality")).alias("body"), F.lit(2).alias("version"))
    added = labels.select(F.concat(F.lit("n"), key).alias("id"), F.lit("new").alias("body"), F.lit(1).alias("version"))
    return files.upsert(current, changed.unionByName(added), "id", "version")


@query(
    "s6_labelled_lines",
    """WITH lines AS (SELECT lang AS label, lower(trim(unnest(string_split(text, chr(10))))) AS line FROM documents),
folded AS (SELECT label, regexp_replace(strip_accents(line), '[^A-Za-z.,;:'']', '', 'g') AS text FROM lines)
SELECT label, text, count(*) AS n FROM folded WHERE text <> '' GROUP BY ALL""",
)
def s6(spark, d):
    """One file stem per language: the label of its lines."""
    path = scratch(spark)
    table(spark, d, "documents").select(F.concat("lang", F.lit(".v1")).alias("stem"), "text").write.partitionBy("stem").text(path)
    lines = files.read_labelled_lines(spark, f"{path}/*/*.txt", stem=-2)
    return lines.groupBy("label", "text").agg(F.count("*").alias("n")).withColumn("label", F.regexp_replace("label", "^stem=", ""))


@query(
    "s7_splits",
    f"""WITH {BODIES}
SELECT comment_id, 'val' AS split FROM bodies
WHERE (('0x' || substr(md5('42:' || comment_id), 1, 8))::BIGINT % 1000) >= 100
  AND (('0x' || substr(md5('42:' || comment_id), 1, 8))::BIGINT % 1000) < 190""",
)
def s7(spark, d):
    path = scratch(spark)
    parts = {"test": 0.1, "val": 0.09, "train": 0.81}
    files.write_splits(split_by_hash(bodies(spark, d).select("comment_id"), "comment_id", parts), path)
    return files.read_splits(spark, path, "val").select("comment_id", "split")


_VOCAB_SQL = f"""toks AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT doc_id, {sql_tokens('lower(text)')} AS t FROM documents)),
firsts AS (SELECT token, min(struct_pack(d := doc_id, p := pos)) AS f FROM toks GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY f) - 1 AS BIGINT) AS id FROM firsts),
full_vocab AS (SELECT * FROM vocab UNION ALL SELECT '<UNK>', max(id) + 1 FROM vocab UNION ALL SELECT '<PAD>', max(id) + 2 FROM vocab)"""


@query("s9_vocab_files", f"WITH {_VOCAB_SQL} SELECT token, id FROM full_vocab")
def s9(spark, d):
    path = scratch(spark)
    files.write_vocab(build_vocab(text_tokens(table(spark, d, "documents"), "text", "doc_id")), path)
    return files.read_vocab(spark, path)


_KEPT = ["src0", "src3", "src7", "SRC1"]


@query("s10_communities", f"WITH {BODIES} SELECT comment_id, subreddit FROM bodies WHERE subreddit IN {sql_list(_KEPT)}")
def s10(spark, d):
    return files.for_communities(bodies(spark, d), _KEPT).select("comment_id", "subreddit")


@query("s10_communities_table", f"WITH {BODIES} SELECT comment_id, subreddit FROM bodies WHERE subreddit IN {sql_list(_KEPT)}")
def s10_table(spark, d):
    return files.for_communities(bodies(spark, d), small(spark, name=_KEPT)).select("comment_id", "subreddit")


@query(
    "s11_limit_per_community",
    f"""WITH {COMMENTS} SELECT subreddit, comment_id, CAST(row_number() OVER w AS INTEGER) AS rank FROM comments
WINDOW w AS (PARTITION BY subreddit ORDER BY comment_score DESC, comment_id) QUALIFY row_number() OVER w <= 4000""",
)
def s11(spark, d):
    ordered = [F.desc("comment_score"), F.col("comment_id")]
    return top_n_per_group(comments(spark, d).select("subreddit", "comment_id", "comment_score"), ["subreddit"], ordered, 4000).drop("comment_score")


_RUN_USERS = 50


@query(
    "s8_read_runs",
    f"""WITH e AS (SELECT 'run=' || event_type || ' ' || (user_id // {_RUN_USERS}) AS run, event_id, value FROM events)
SELECT run, count(*) OVER (PARTITION BY run) AS size, CAST(row_number() OVER (PARTITION BY run ORDER BY event_id) - 1 AS INTEGER) AS step, value FROM e""",
)
def s8(spark, d):
    """A run folder per event type and stretch of users, all written in one pass, and one without metrics; read back as series of losses."""
    root, events = scratch(spark), table(spark, d, "events")
    run = F.concat("event_type", F.lit(" "), F.floor(F.col("user_id") / _RUN_USERS).cast("string"))
    own = events.groupBy(run.alias("run")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("x"))
    config = F.to_json(F.struct(F.struct(F.col("n").alias("size")).alias("data_config")))
    metrics = F.to_json(F.struct(F.col("x.value").alias("train_loss")))
    documents = F.array(F.struct(F.lit("config.json").alias("document"), config.alias("value")), F.struct(F.lit("metrics.json").alias("document"), metrics.alias("value")))
    alone = small(spark, run=["without metrics"], document=["config.json"], value=['{"data_config": {"size": 0}}'])
    written = own.select("run", F.inline(documents)).unionByName(alone)
    # Dealt by number: few bytes a run would be put together for one task, which would write every folder.
    deal_out(written, "run", "document").write.partitionBy("run", "document").text(root)
    found = runs.read_runs(spark, root, "document=config.json", "document=metrics.json")
    series = runs.metric_series(found).filter(F.col("metric") == "train_loss").join(found.select("run", F.col("`config.data_config.size`").alias("size")), "run")
    return series.select("run", "size", "step", "value")


@query(
    "s11_limit_cuts",
    f"""WITH {COMMENTS} SELECT subreddit, comment_id, CAST(row_number() OVER w AS INTEGER) AS rank FROM comments
WINDOW w AS (PARTITION BY subreddit ORDER BY comment_score DESC, comment_id) QUALIFY row_number() OVER w <= 7""",
)
def s11_cuts(spark, d):
    ordered = [F.desc("comment_score"), F.col("comment_id")]
    return top_n_per_group(comments(spark, d).select("subreddit", "comment_id", "comment_score"), ["subreddit"], ordered, 7).drop("comment_score")


@query(
    "p1_flatten_threads",
    """WITH posts AS (SELECT conv_id, min_by(text, turn) AS post_content, min(turn) AS first FROM conversations GROUP BY conv_id)
SELECT c.conv_id AS post_id, p.post_content, c.turn AS comment_id, c.role AS comment_author, c.text AS comment_body
FROM conversations c JOIN posts p USING (conv_id) WHERE c.turn > p.first""",
)
def p1(spark, d):
    turns = table(spark, d, "conversations").withColumnRenamed("conv_id", "post_id")
    posts = turns.groupBy("post_id").agg(F.min_by("text", "turn").alias("post_content"), F.min("turn").alias("first"))
    replies = turns.select("post_id", F.col("turn").alias("comment_id"), F.col("role").alias("comment_author"), F.col("text").alias("comment_body"))
    return files.flatten_threads(posts, replies).filter(F.col("comment_id") > F.col("first")).drop("first")


@query("p2_search_docs", _DOC_SQL)
def p2(spark, d):
    return _as_text(files.to_search_docs(comments(spark, d)))


@query(
    "p3_enforce_schema",
    """SELECT 'c' || doc_id AS id,
  CASE WHEN doc_id % 11 = 0 THEN 'missing post_id' WHEN doc_id % 13 = 0 THEN 'bad score' ELSE 'ok' END AS reason,
  CAST(CASE WHEN doc_id % 11 <> 0 AND doc_id % 13 <> 0 THEN doc_id % 100 END AS INTEGER) AS score
FROM documents""",
)
def p3(spark, d):
    raw = table(spark, d, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("doc_id") % 11 != 0, F.lit("p")).alias("post_id"),
        F.when(F.col("doc_id") % 13 == 0, "x").otherwise((F.col("doc_id") % 100).cast("string")).alias("score"),
    )
    wanted = schemas.T.StructType([f for f in schemas.SEARCH_DOCS if f.name in ("id", "post_id", "score")])
    ok, rejected = files.enforce_schema(raw, wanted)
    return ok.select("id", F.lit("ok").alias("reason"), "score").unionByName(rejected.select("id", "reason", F.lit(None).cast("int").alias("score")))


@query(
    "p4_suffix_types",
    """SELECT event_id, event_type AS kind_str, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'bad' ELSE CAST(user_id AS VARCHAR) END AS INTEGER) AS user_i,
  round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value_d, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, CAST(value > 20 AS BOOLEAN) AS high_b
FROM events""",
)
def p4(spark, d):
    e = table(spark, d, "events")
    raw = e.select(
        "event_id",
        F.col("event_type").alias("kind_str"),
        F.when(F.col("event_id") % 5 == 0, "bad").otherwise(F.col("user_id").cast("string")).alias("user_i"),
        F.col("value").cast("string").alias("value_f"),
        F.col("ts").cast("string").alias("at_dt"),
        F.when(F.col("value") > 20, "true").otherwise("false").alias("high_b"),
    )
    typed = files.apply_suffix_types(raw)
    return typed.select(
        "event_id", "kind_str", "user_i", F.round(F.col("value_f").cast("double"), 3).alias("value_d"),
        F.date_format("at_dt", "yyyy-MM-dd HH:mm:ss").alias("seen"), "high_b",
    )


@query(
    "p5_fill_defaults",
    f"""WITH {COMMENTS} SELECT comment_id, coalesce(post_content, '[No text content]') AS post_content,
  coalesce(CASE WHEN doc_id % 9 <> 0 THEN comment_author END, 'unknown') AS comment_author FROM comments""",
)
def p5(spark, d):
    raw = comments(spark, d).withColumn("comment_author", F.when(F.col("doc_id") % 9 != 0, F.col("comment_author")))
    return files.fill_defaults(raw).select("comment_id", "post_content", "comment_author")


@query(
    "p6_dates",
    f"""WITH {COMMENTS} SELECT comment_id, strftime(make_timestamp(CAST(created * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS created_iso,
  strftime(make_timestamp(CAST(created * 1000000 AS BIGINT)), '%d %B %Y') AS readable_date FROM comments""",
)
def p6(spark, d):
    return files.with_dates(comments(spark, d)).select("comment_id", "created_iso", "readable_date")


@query(
    "p7_iso_z",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%dT%H:%M:%S.%SZ') AS iso_compat FROM events""",
)
def p7(spark, d):
    ts = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select("event_id", tx.to_iso_z(ts).alias("iso"), tx.to_iso_z(ts, compat=True).alias("iso_compat"))


@query(
    "p22_text_label",
    f"""SELECT d.text, CAST(l.quality AS INTEGER) AS label FROM documents d JOIN labels l USING (doc_id)""",
)
def p22(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return files.as_text_label(joined, "text", "quality")


@query(
    "p23_flatten_struct",
    """SELECT event_id AS "event.id", event_type AS "event.kind.name", round(value, 6) AS "event.kind.value", user_id FROM events""",
)
def p23(spark, d):
    kind = F.struct(F.col("event_type").alias("name"), F.round("value", 6).alias("value"))
    nested = table(spark, d, "events").select(F.struct(F.col("event_id").alias("id"), kind.alias("kind")).alias("event"), "user_id")
    return files.flatten_struct(nested)


@query(
    "p1_flatten_nested",
    """SELECT c.conv_id AS post_id, p.post_content, c.turn AS comment_id, c.text AS comment_body
FROM conversations c JOIN (SELECT conv_id, min_by(text, turn) AS post_content FROM conversations GROUP BY conv_id) p USING (conv_id)""",
)
def p1_nested(spark, d):
    """Posts that hold their comments as an array, one row per comment."""
    turns = table(spark, d, "conversations")
    nested = F.collect_list(F.struct(F.col("turn").alias("comment_id"), F.col("text").alias("comment_body")))
    posts = turns.groupBy(F.col("conv_id").alias("post_id")).agg(F.min_by("text", "turn").alias("post_content"), nested.alias("comments"))
    return files.flatten_nested_threads(posts)
