"""Quality rules: counts of a whole text, and its divergence from its language's references.

Two histograms of a document are held against those of all documents of its
language by the Jensen-Shannon distance: its character classes, and its most
common words (the language's commonest purely alphabetic words and the rest).
A document is dropped when a distance exceeds its limit. Documents too short
for a histogram, and languages with too little text for a reference, are not
judged by it.

DataFrame expressions only: a text stays in its row, and the references are one
row per language. The limits are parameters, chosen once on the labelled rows
of the test tables.

Nulls: a null text is empty; a null language is a language of its own. Empty
texts have no words and fail the base rule. Repeated rows are judged alike and
count in the references as often as they occur. An empty table stays empty.
Extra columns are carried through by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmura.functions.once import once
from murmura.llm.base import SPACE_CLASS, SPACES, WORD, query, table
from murmura.session import materialize

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
RUN = 5

COMMON_WORDS = 32
# Reference words of all languages that are held in the plan to thin a text before it is searched; with more, it is searched whole.
INLINE_WORDS = 10_000
MIN_CHARACTERS = 200
MIN_JUDGED_WORDS = 40
MIN_REFERENCE_WORDS = 2_000
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.2
# A short text's histogram strays from its source by chance, about as one over the root of its words.
WORD_NOISE = 1.5

# Character classes beside white space and lower-case letters, as they are counted in what is left of the text.
_CLASSES = {"upper": "\\p{Lu}", "digit": "[0-9]", "stop": "[.,;:]", "letter": "[\\p{L}\\p{M}]"}
_SYMBOLS = "[#*$%&|<>]"


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def _runs(words: Column, n: Column) -> Column:
    """Hashes of all runs of five words."""
    hashed = F.transform(F.sequence(F.lit(0), n - RUN), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(RUN)]))
    return F.when(n > RUN, hashed).otherwise(F.array().cast("array<bigint>"))


def _repeated_words(runs: Column) -> Column:
    """Words inside runs that occur again in the text."""
    return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0)).otherwise(_covered(runs))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _covered(runs: Column) -> Column:
    def starts(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, k: (x["run"] == F.get(ordered, k - 1)["run"]) | (x["run"] == F.get(ordered, k + 1)["run"]),
        )
        return F.sort_array(F.transform(again, lambda x: x["at"]))

    ordered = F.sort_array(F.transform(runs, lambda r, k: F.struct(r.alias("run"), k.alias("at"))))
    at = _let(ordered, starts)
    widths = lambda s: F.transform(s, lambda x, k: F.least(F.lit(RUN), F.coalesce(F.get(s, k + 1) - x, F.lit(RUN))))
    return F.aggregate(_let(at, widths), F.lit(0), lambda total, x: total + x)


def with_words(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc``, with language, text, words and what the class counts need."""
    text = F.coalesce(F.col("text"), F.lit(""))
    packed = docs.select(F.struct("*").alias("doc"), F.coalesce("lang", F.lit("")).alias("_lang"), text.alias("_text"))
    split = once(packed, _words=_words(F.col("_text")))
    bare = once(split, _bare=F.array_join("_words", ""), _n=F.size("_words"))
    return once(bare, _rest=F.regexp_replace("_bare", "\\p{Ll}+", ""))


def class_counts() -> dict[str, Column]:
    chars, rest = F.length("_bare"), F.length("_rest")
    out = {"white": F.length("_text") - chars, "lower": chars - rest}
    out |= {name: F.regexp_count("_rest", F.lit(pattern)) for name, pattern in _CLASSES.items()}
    out["letter"] = out["letter"] - out["upper"]
    out["other"] = rest - out["upper"] - out["digit"] - out["stop"] - out["letter"]
    return {name: value.cast("bigint") for name, value in out.items()}


CLASS_NAMES = ["white", "lower", "upper", "digit", "stop", "letter", "other"]


def references(docs: DataFrame, common: int = COMMON_WORDS, min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """Per language: shares of the character classes, and its commonest words with their shares of all words."""
    rows = with_words(docs)
    classes = rows.groupBy("_lang").agg(*[F.sum(v).alias(c) for c, v in class_counts().items()], F.sum("_n").alias("words_seen"))
    n_chars = sum((F.col(c) for c in CLASS_NAMES), F.lit(0))
    classes = classes.filter(F.col("words_seen") >= min_words).select(
        "_lang", "words_seen", F.array(*[F.col(c) / n_chars for c in CLASS_NAMES]).alias("ref_classes")
    )
    split = docs.select(F.coalesce("lang", F.lit("")).alias("_lang"), F.explode(_words(F.coalesce("text", F.lit("")))).alias("word"))
    counts = split.filter(F.col("word").rlike("^[\\p{L}]+$")).groupBy("_lang", "word").agg(F.count("*").alias("n"))
    first = Window.partitionBy("_lang").orderBy(F.col("n").desc(), "word")
    top = counts.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= common)
    top = top.groupBy("_lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    joined = classes.join(top, "_lang", "left").withColumn("top", F.coalesce("top", F.array().cast("array<struct<rank:int,word:string,n:bigint>>")))
    shares = F.transform("top", lambda x: x["n"] / F.col("words_seen"))
    return joined.select(
        "_lang", "ref_classes", F.col("top.word").alias("ref_words"), F.concat(shares, F.array(1 - _total(shares))).alias("ref_shares")
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, square root of the divergence) of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: 0.5 * part(a, b) + 0.5 * part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), _total(terms)))


def judged(
    docs: DataFrame,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    word_noise: float = WORD_NOISE,
) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc``, with their counts, distances and verdict."""
    refs = materialize(references(docs))
    runs = once(with_words(docs), _runs=_runs(F.col("_words"), F.col("_n")))
    counts = once(runs, _n_repeated=_repeated_words(F.col("_runs")), **{f"_{c}": v for c, v in class_counts().items()})
    rows = counts.drop("_runs").join(refs, "_lang", "left")
    n_chars = F.length("_text")
    classes = F.array(*[F.col(f"_{c}") / n_chars for c in CLASS_NAMES])
    spaced = F.concat(F.lit(" "), F.array_join(_thinned(refs), "  "), F.lit(" "))
    hits = lambda line, w: (F.octet_length(line) - F.octet_length(F.replace(line, F.concat(F.lit(" "), w, F.lit(" "))))) / (F.octet_length(w) + 2)
    shares = _let(spaced, lambda line: F.transform("ref_words", lambda w: hits(line, w) / F.col("_n")))
    histogram = _let(shares, lambda s: F.concat(s, F.array(1 - _total(s))))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = once(
        rows,
        _class_distance=F.when(n_chars >= MIN_CHARACTERS, divergence(classes, F.col("ref_classes"))),
        _word_distance=F.when(F.col("_n") >= MIN_JUDGED_WORDS, divergence(histogram, F.col("ref_shares"))),
        _dup_lines=_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
    )
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_n_repeated") > MAX_REPEATED_PERCENT * F.col("_n"))
    word_limit = F.lit(max_word_distance) + F.lit(word_noise) / F.sqrt("_n")
    close = (F.coalesce("_class_distance", F.lit(0.0)) <= max_class_distance) & (F.coalesce("_word_distance", F.lit(0.0)) <= word_limit)
    return rows.select(
        "doc",
        F.col("_n").cast("bigint").alias("n_words"),
        F.length("_bare").cast("bigint").alias("word_chars"),
        F.regexp_count("_rest", F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.col("_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("_n_repeated").cast("bigint").alias("n_repeat_words"),
        F.col("_class_distance").alias("class_distance"),
        F.col("_word_distance").alias("word_distance"),
        failed.alias("base_failed"),
        (~failed & F.coalesce(close, F.lit(True))).alias("kept"),
    )


def _thinned(refs: DataFrame) -> Column:
    """The words of a text that are a reference word of any language, or all of them; either way counts agree."""
    inline = refs.select(F.explode("ref_words").alias("word")).distinct().limit(INLINE_WORDS + 1).collect()
    words = F.col("_words")
    return words if len(inline) > INLINE_WORDS else F.filter(words, lambda w: w.isin([r["word"] for r in inline]))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    return judged(docs).filter("kept").select("doc.*")


def _sql_part(a: str, b: str) -> str:
    return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"


def _sql_distance(p: str, q: str) -> str:
    term = f"0.5 * ({_sql_part('x[1]', 'x[2]')}) + 0.5 * ({_sql_part('x[2]', 'x[1]')})"
    pairs = f"list_transform(range(1, len({q}) + 1), lambda i: [{p}[i], {q}[i]])"
    return f"sqrt(greatest(0, list_sum(list_transform({pairs}, lambda x: {term}))))"


QUALITY_SQL = f"""texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
bare AS (SELECT *, len(w) AS n, array_to_string(w, '') AS bare, regexp_replace(array_to_string(w, ''), '\\p{{Ll}}+', '', 'g') AS rest FROM texts),
counted AS (
  SELECT *, len(text) - len(bare) AS white, len(bare) - len(rest) AS lower,
         len(regexp_extract_all(rest, '\\p{{Lu}}')) AS upper, len(regexp_extract_all(rest, '[0-9]')) AS digit,
         len(regexp_extract_all(rest, '[.,;:]')) AS stop,
         len(regexp_extract_all(rest, '[\\p{{L}}\\p{{M}}]')) - len(regexp_extract_all(rest, '\\p{{Lu}}')) AS letter FROM bare),
classed AS (
  SELECT *, [white, lower, upper, digit, stop, letter, len(rest) - upper - digit - stop - letter] AS classes FROM counted),
langs AS (
  SELECT lang, sum(n) AS words_seen, list_transform([sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]), sum(classes[5]),
         sum(classes[6]), sum(classes[7])], lambda c: c / sum(len(text))) AS ref_classes
  FROM classed GROUP BY lang HAVING sum(n) >= {MIN_REFERENCE_WORDS}),
ranked AS (
  SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
  FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM texts)
        WHERE regexp_full_match(word, '\\p{{L}}+') GROUP BY ALL)),
tops AS (SELECT lang, list(word ORDER BY rank) AS ref_words, list(n ORDER BY rank) AS counts FROM ranked WHERE rank <= {COMMON_WORDS} GROUP BY lang),
refs AS (
  SELECT lang, ref_classes, coalesce(ref_words, []) AS ref_words,
         list_append(list_transform(coalesce(counts, []), lambda c: c / words_seen), 1 - coalesce(list_sum(counts), 0) / words_seen) AS ref_shares
  FROM langs LEFT JOIN tops USING (lang)),
runs AS (
  SELECT row_no, unnest(range(1, n - {RUN} + 2)) AS first_no,
         unnest(list_transform(range(1, n - {RUN} + 2), lambda i: array_to_string(w[i:i + {RUN} - 1], ' '))) AS run FROM bare WHERE n > {RUN}),
again AS (SELECT row_no, first_no FROM (SELECT *, count(*) OVER (PARTITION BY row_no, run) AS times FROM runs) WHERE times > 1),
repeated AS (
  SELECT row_no, count(DISTINCT word_no) AS n_repeated
  FROM (SELECT row_no, unnest(range(first_no, first_no + {RUN})) AS word_no FROM again) GROUP BY row_no),
scored AS (
  SELECT c.*, coalesce(n_repeated, 0) AS n_repeated, ref_classes, ref_shares,
         list_transform(ref_words, lambda r: len(list_filter(w, lambda x: x = r)) / n) AS shares,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM classed c LEFT JOIN repeated USING (row_no) LEFT JOIN refs USING (lang)),
measured AS (
  SELECT *, CASE WHEN len(text) >= {MIN_CHARACTERS} AND ref_classes IS NOT NULL
         THEN {_sql_distance("list_transform(classes, lambda c: c / len(text))", "ref_classes")} END AS class_distance,
         CASE WHEN n >= {MIN_JUDGED_WORDS} AND ref_shares IS NOT NULL
         THEN {_sql_distance("list_append(shares, 1 - coalesce(list_sum(shares), 0))", "ref_shares")} END AS word_distance,
         n < {MIN_WORDS} OR 100 * n_repeated > {MAX_REPEATED_PERCENT} * n AS base_failed
  FROM scored)"""


@query(
    "op3_quality_rules",
    f"""WITH {QUALITY_SQL}
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(bare) AS BIGINT) AS word_chars,
       CAST(len(regexp_extract_all(rest, '{_SYMBOLS}')) AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeated AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance, 0) <= {MAX_CLASS_DISTANCE}
         AND coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} + {WORD_NOISE} / sqrt(n) AS kept
FROM measured""",
)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return judged(docs).select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
