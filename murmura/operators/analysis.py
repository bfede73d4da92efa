"""Text analysis for search: what is indexed and what a query is turned into."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text
from murmura.functions.once import once
from murmura.functions.stemming import stem_tokens


@dataclass(frozen=True)
class Analyzer:
    """Word lists of the chain. The analysis stays inside each row: nothing is shuffled."""

    stopwords: Sequence[str] = field(default_factory=lambda: tuple(W.STOPWORDS))
    synonyms: Sequence[Sequence[str]] = field(default_factory=lambda: tuple(map(tuple, W.SYNONYMS)))
    stem: bool = True

    def index_items(self, df: DataFrame, column: str, out: str = "items") -> DataFrame:
        """Add ``array<struct<pos, token>>``: split on spaces, lower, stop, stem, synonyms. Punctuation stays on."""
        return self._expanded(self._stemmed(self._split(df, column, out), out), out)

    def query_items(self, df: DataFrame, column: str, out: str = "items") -> DataFrame:
        """The query side meets synonyms before it stems."""
        return self._stemmed(self._expanded(self._split(df, column, out), out), out)

    def _split(self, df: DataFrame, column: str, out: str) -> DataFrame:
        tokens = text.whitespace_tokens(F.lower(column))
        items = F.transform(tokens, lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
        if self.stopwords:
            items = F.filter(items, lambda x: ~x["token"].isin(*self.stopwords))
        return once(df, **{out: items})

    def _stemmed(self, df: DataFrame, out: str) -> DataFrame:
        if not self.stem:
            return df
        stemmed = df.withColumn("_stems", stem_tokens(F.col(f"{out}.token")))
        joined = F.zip_with(out, "_stems", lambda x, s: F.struct(x["pos"].alias("pos"), s.alias("token")))
        return once(stemmed, **{out: joined}).drop("_stems")

    def _expanded(self, df: DataFrame, out: str) -> DataFrame:
        return expand_synonyms(df, out, self.synonyms) if self.synonyms else df


def expand_synonyms(df: DataFrame, column: str, synonyms: Sequence[Sequence[str]]) -> DataFrame:
    """Append the other members of a set where one of its members occurs.

    Members may have several words; the longest match wins and matches do not
    overlap. A multi-word alternative occupies consecutive positions.
    """
    items = F.col(column)
    alternatives: dict[str, list[str]] = defaultdict(list)
    for group in synonyms:
        for member in group:
            alternatives[member] += [other for other in group if other != member]
    by_length: dict[int, list[str]] = defaultdict(list)
    for phrase in alternatives:
        by_length[len(phrase.split())].append(phrase)
    first_words = sorted({phrase.split()[0] for phrase in alternatives})

    def added(phrase: str) -> Column:
        words = [(i, w) for other in alternatives[phrase] for i, w in enumerate(other.split())]
        return F.array(*[F.struct(F.lit(i).alias("shift"), F.lit(w).alias("word")) for i, w in words])

    table = F.create_map(*[x for phrase in alternatives for x in (F.lit(phrase), added(phrase))])
    # Following tokens are zipped on: an array named inside a lambda would be rebuilt for every element.
    longest = max(by_length)
    tokens = items.getField("token")
    follow = [F.slice(tokens, k + 1, F.greatest(F.size(tokens), F.lit(1))).alias(f"t{k}") for k in range(1, longest)]
    windows = F.arrays_zip(items.alias("item"), *follow)

    def match(x: Column, j: Column) -> Column:
        parts = [x["item"]["token"], *[x[f"t{k}"] for k in range(1, longest)]]
        phrase = F.lit(None).cast("string")
        words = F.lit(0)
        for n in sorted(by_length):
            candidate = F.concat_ws(" ", *parts[:n])
            found = candidate.isin(*by_length[n])
            phrase, words = F.when(found, candidate).otherwise(phrase), F.when(found, n).otherwise(words)
        return F.struct(j.alias("j"), x["item"]["pos"].alias("pos"), words.alias("n"), phrase.alias("phrase"))

    marked = F.transform(windows, lambda x, j: F.when(x["item"]["token"].isin(*first_words), match(x, j)))
    matches = F.filter(marked, lambda m: m["n"] > 0)
    kept = F.aggregate(
        matches,
        F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<j:int,pos:int,n:int,phrase:string>>").alias("out")),
        lambda acc, m: F.when(
            m["j"] >= acc["free"],
            F.struct((m["j"] + m["n"]).alias("free"), F.concat(acc["out"], F.array(m)).alias("out")),
        ).otherwise(acc),
        lambda acc: acc["out"],
    )
    extra = F.flatten(
        F.transform(
            kept,
            lambda m: F.transform(
                F.element_at(table, m["phrase"]),
                lambda a: F.struct((m["pos"] + a["shift"]).alias("pos"), a["word"].alias("token")),
            ),
        )
    )
    return once(df, **{column: F.concat(items, extra)})


def analyze_index(df: DataFrame, text_col: str, id_col: str, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(doc_id, pos, token)`` of the index chain, before n-grams."""
    named = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return analyzer.index_items(named, "_text").select("doc_id", F.inline("items"))


def analyze_query(queries: DataFrame, text_col: str = "query", id_col: str = "query_id", analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(query_id, pos, token)`` of the query chain. Blank queries are rejected."""
    asked = queries.filter(F.trim(text_col) != "").select(F.col(id_col).alias("query_id"), F.col(text_col).alias("_text"))
    return analyzer.query_items(asked, "_text").select("query_id", F.inline("items"))
