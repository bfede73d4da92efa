"""URL filters: host rules, and a classifier over segmented host and path words for the rest.

Names such as ``cheappills`` are split into words by a unigram Viterbi search:
the most probable division, where a known word has its share of the corpus and
an unknown piece a penalty that grows with its length. Known words come from a
table of any size, joined to the pieces of each distinct name, so nothing of the
vocabulary is sent to the tasks. A multinomial naive Bayes model then scores the
words of host and path. Its training rows are all URLs, labelled by a short list
of words that mark unwanted sites; it blocks what shares their company.

Work is done once per distinct host and path. Nulls: a null URL, or one without
``://``, has an empty host and path. Rows that repeat are judged alike. Empty
tables give an empty result, with nothing to learn from nothing is blocked, and
extra columns are ignored. Names of any length are split whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, table
from murmura.session import materialize

# The rules of the query (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Words that mark a URL as unwanted in training.
MARKERS = ["adult", "ads", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "xxx"]

LONGEST_WORD = 20
SMOOTHING = 0.1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SITE = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _SITE, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SITE, 2), F.lit(""))


def matched(sites: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, rule, verdict) of the longest rule of each site (host, path) that one fits."""
    spark = sites.sparkSession
    known = spark.createDataFrame([(h, p, h + p, v) for h, p, v in rules], "suffix string, prefix string, rule string, verdict string")
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fits = sites.select("host", "path", F.explode(suffixes).alias("suffix")).join(known, "suffix").filter(F.startswith("path", "prefix"))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def names(value: Column) -> Column:
    """Runs of letters of a host or path, lower-cased."""
    return F.filter(F.split(F.lower(value), "[^\\p{L}]+"), lambda x: x != "")


def split_name(name: str, known: dict[str, float], total: float) -> list[str]:
    """The most probable words of a name; ties go to the division whose last word is longest.

    An unknown piece of any length costs its length and one unseen word, so only its best start is kept; known pieces are
    tried by their lengths.
    """
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    lengths, unseen = sorted(set(map(len, known)), reverse=True), math.log10(total)
    start_of_rest = 0
    for end in range(1, len(name) + 1):
        if best[end - 1] + end - 1 > best[start_of_rest] + start_of_rest:
            start_of_rest = end - 1
        choices = [(best[start_of_rest] - unseen - (end - start_of_rest), -start_of_rest)]
        for width in lengths:
            count = known.get(name[end - width : end]) if width <= end else None
            if count:
                choices.append((best[end - width] + math.log10(count / total), width - end))
        best[end], start = max(choices)
        back[end] = -start
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(name, words) for distinct names, with the words of ``vocabulary`` (word, n)."""
    total = float(vocabulary.agg(F.sum("n")).first()[0] or 1)
    starts = F.sequence(F.lit(1), F.length("name"))
    at = chunks.select("name", F.explode(starts).alias("start"))
    widths = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start") + 1))
    pieces = at.select("name", "start", F.explode(widths).alias("width")).select("name", F.expr("substring(name, start, width)").alias("word")).distinct()
    short = pieces.join(vocabulary, "word")
    # Longer words are met by their first letters and then compared whole.
    heads = at.select("name", "start", F.expr(f"substring(name, start, {LONGEST_WORD})").alias("head")).filter(F.length("head") == LONGEST_WORD)
    longer = vocabulary.filter(F.length("word") > LONGEST_WORD).withColumn("head", F.substring("word", 1, LONGEST_WORD))
    long = heads.join(longer, "head").filter("substring(name, start, length(word)) = word").select("name", "word", "n").distinct()
    found = short.select("name", "word", "n").unionByName(long).groupBy("name").agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("counts"))
    rows = chunks.join(found, "name", "left")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("name", "known", "counts")]
            words = [split_name(n, dict(zip(k or [], c or [], strict=True)), total) for n, k, c in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return rows.select("name", "known", "counts").mapInArrow(split, "name string, words array<string>")


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all runs of letters, lower-cased, in ``docs``."""
    words = docs.select(F.explode(names(F.coalesce("text", F.lit("")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def site_words(sites: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(host, path, word, n): the segmented words of each site, with the pages it has."""
    long = sites.select("host", "path", "n", F.explode(F.concat(names(F.col("host")), names(F.col("path")))).alias("name"))
    long = materialize(long)
    split = materialize(segmented(long.select("name").distinct(), vocabulary))
    return long.join(split, "name").select("host", "path", "n", F.explode("words").alias("word"))


def trained(words: DataFrame, sites: DataFrame, markers: Sequence[str] = MARKERS, smoothing: float = SMOOTHING) -> tuple[DataFrame, float, float]:
    """Log odds of being unwanted: per word (word, odds), of an unseen word, and of any site."""
    unwanted = words.groupBy("host", "path").agg(F.max(F.col("word").isin(list(markers)).cast("int")).alias("unwanted"))
    marked = materialize(unwanted.filter("unwanted = 1").select("host", "path", F.lit(1).alias("unwanted")))
    labelled = words.join(marked, ["host", "path"], "left").withColumn("unwanted", F.coalesce("unwanted", F.lit(0)))
    counts = materialize(
        labelled.groupBy("word").agg(
            F.sum(F.when(F.col("unwanted") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("unwanted") == 0, F.col("n")).otherwise(0)).alias("good")
        )
    )
    seen = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("words")).first()
    pages = sites.agg(F.sum("n").alias("n")).first()["n"] or 0
    bad_pages = sites.join(marked, ["host", "path"], "left_semi").agg(F.sum("n").alias("n")).first()["n"] or 0
    if not bad_pages or bad_pages == pages:
        # Nothing to tell apart: all pages carry a marker, or none does.
        return counts.select("word", F.lit(0.0).alias("odds")), 0.0, 1.0 if bad_pages else -1.0
    size = smoothing * (seen["words"] + 1)
    odds = lambda bad, good: F.log((bad + smoothing) / (seen["bad"] + size)) - F.log((good + smoothing) / (seen["good"] + size))
    unseen = math.log((seen["good"] + size) / (seen["bad"] + size))
    return counts.select("word", odds(F.col("bad"), F.col("good")).alias("odds")), unseen, math.log(bad_pages / (pages - bad_pages))


def judged_sites(urls: DataFrame, vocabulary: DataFrame, rules: Sequence[tuple[str, str, str]] = tuple(RULES)) -> DataFrame:
    """(host, path, rule, score, verdict) for each distinct host and path of ``urls`` (url)."""
    sites = materialize(urls.groupBy(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).agg(F.count("*").alias("n")))
    words = materialize(site_words(sites, vocabulary))
    model, unseen, prior = trained(words, sites)
    scored = words.join(model, "word", "left").groupBy("host", "path").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("odds"))
    out = sites.join(scored, ["host", "path"], "left").join(matched(sites, rules), ["host", "path"], "left")
    score = F.lit(prior) + F.coalesce("odds", F.lit(0.0))
    return out.select("host", "path", "rule", score.alias("score"), F.coalesce("verdict", F.when(score > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


@query("op5_url_filters", None)
def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    marked = spark.createDataFrame([(m, 1) for m in MARKERS], "word string, n bigint")
    vocabulary = corpus_words(table(spark, folder, "documents")).unionAll(marked).groupBy("word").agg(F.sum("n").alias("n"))
    sites = materialize(judged_sites(pages, materialize(vocabulary)))
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    return rows.join(sites, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict")
