"""File sources and sinks: comments as CSV, search documents as JSON lines or Parquet, vocabularies, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura import schemas
from murmura.functions import text

_CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_comments_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.COMMENTS) -> DataFrame:
    """CSV comments with quoted line breaks. The schema is fixed: no inference pass.

    A multi-line file cannot be split, so land many moderate files rather than one big one.
    """
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)


def write_comments_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """CSV with header. Writes nothing and returns False when ``df`` is empty. Nested columns go out as JSON text."""
    if df.isEmpty():
        return False
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = df.select(
        *[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema]
    )
    options = {"header": "true", "quote": '"', "escape": '"', "emptyValue": '""'}
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    flat.write.mode(mode).options(**options, **kept).csv(path)
    return True


def write_search_docs(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Search documents as JSON lines, or Parquet for the column-pruned form at rest."""
    df.write.mode(mode).format(fmt).save(path)


def read_search_docs(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.SEARCH_DOCS).format(fmt).load(path)


def upsert(current: DataFrame, updates: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the highest ``order_col`` wins; on equal order the update wins.

    Aggregates rather than ranks, so that many versions of one key collapse
    before the shuffle.
    """
    columns = current.columns
    tagged = current.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
    latest = F.max_by(F.struct(*columns), F.struct(F.col(order_col), F.col("_update")))
    return tagged.groupBy(F.col(key).alias("_key")).agg(latest.alias("_row")).select("_row.*")


def read_labelled_lines(spark: SparkSession, glob: str, stem: int = -1) -> DataFrame:
    """One text per line, the file stem is the label; lines lower-cased, stripped and folded to ASCII letters.

    ``stem`` names the part of the path that holds the label, counted from its
    end. Lines of which folding leaves nothing are dropped, blank ones included.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), stem)
    lines = spark.read.text(glob).select(
        F.lower(F.trim("value")).alias("line"), F.url_decode(F.regexp_replace(name, r"\.[^.]*$", "")).alias("label")
    )
    return lines.select(text.ascii_fold(F.col("line")).alias("text"), "label").filter(F.col("text") != "")


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Named dataset: one partition folder per value of ``split``."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Named dataset; ``split`` prunes to one folder."""
    df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def write_vocab(vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    vocab.write.mode(mode).parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def for_communities(df: DataFrame, communities: Sequence[str] | DataFrame, column: str = "subreddit") -> DataFrame:
    """Keep the listed communities. A list becomes a pushed-down IN; a table becomes a semi join."""
    if isinstance(communities, DataFrame):
        return df.join(communities.select(F.col(communities.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(*communities))


# --- shape -------------------------------------------------------------------


def flatten_threads(posts: DataFrame, comments: DataFrame, key: str = "post_id") -> DataFrame:
    """One row per comment with its post's columns."""
    return comments.join(posts, key)


def flatten_nested_threads(posts: DataFrame, column: str = "comments") -> DataFrame:
    """The same from posts that hold their comments as an array of structs."""
    rest = [c for c in posts.columns if c != column]
    return posts.select(*rest, F.inline(column))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Placeholders for an empty post and a missing author."""
    return df.withColumns(
        {
            "post_content": text.or_placeholder(F.col("post_content"), text.W.NO_POST_TEXT),
            "comment_author": F.coalesce("comment_author", F.lit(text.W.UNKNOWN_AUTHOR)),
        }
    )


def with_dates(df: DataFrame, column: str = "created") -> DataFrame:
    """ISO and readable dates next to the epoch column."""
    ts = text.epoch_timestamp(F.col(column))
    return df.withColumns({"created_iso": text.iso_seconds(ts), "readable_date": text.readable_date(ts)})


def to_search_docs(df: DataFrame) -> DataFrame:
    """Comments as search documents; ``comment_id`` doubles as ``id``."""
    post = F.coalesce(F.col("post_content"), F.lit(text.W.NO_AUTHOR_TEXT))
    return df.select(
        F.col("comment_id").alias("id"),
        "post_id",
        "subreddit",
        "title",
        F.col("post_url").alias("url"),
        post.alias("post_content"),
        "comment_id",
        F.col("comment_body").alias("comment_content"),
        "comment_author",
        F.col("comment_score").alias("score"),
        F.timestamp_seconds("created").alias("datetime"),
    )


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast to ``schema``; return the rows that fit and the rejected rows with a reason.

    A row is rejected when a required column is null or a value does not cast.
    Columns of ``schema`` that ``df`` lacks come out null.
    """
    present = set(df.columns)
    reasons: list[Column] = []
    typed: list[Column] = []
    for field in schema:
        if field.name not in present:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            if not field.nullable:
                reasons.append(F.lit(f"missing {field.name}"))
            continue
        raw = F.col(f"`{field.name}`")
        cast = raw.try_cast(field.dataType)
        typed.append(cast.alias(field.name))
        reasons.append(F.when(raw.isNotNull() & cast.isNull(), f"bad {field.name}"))
        if not field.nullable:
            reasons.append(F.when(raw.isNull(), f"missing {field.name}"))
    marked = df.withColumn("_reason", F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))
    ok = marked.filter(F.col("_reason").isNull()).select(*typed)
    rejected = marked.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return ok, rejected


# Types of suffix-named columns.
SUFFIX_TYPES = {"_txt": "string", "_str": "string", "_i": "int", "_f": "float", "_dt": "timestamp", "_b": "boolean"}


def apply_suffix_types(df: DataFrame) -> DataFrame:
    """Cast columns named ``*_i``, ``*_f`` and so on; values that do not cast become null."""
    def typed(name: str) -> Column:
        c = F.col(f"`{name}`")
        for suffix, kind in SUFFIX_TYPES.items():
            if name.endswith(suffix):
                return c.try_cast(kind).alias(name)
        return c

    return df.select(*[typed(name) for name in df.columns])


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested struct field as a top-level column named by its path."""
    def walk(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += walk(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out

    return df.select(*walk(df.schema, ()))


def as_text_label(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    return df.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"))
