"""Term lists of any size: which groups of terms occur in a text."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.operators.scale import row_blocks

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Terms carried by each task at once, about 150 MB as an automaton; more are looked for by further automata in turn.
TERM_BLOCK = 200_000


def _finder(listed: dict[str, list[str]]) -> Callable[[Column], Column]:
    """Groups of the terms that occur in a text, by one automaton per task that finds all terms in one pass over the text."""
    names = sorted({group for groups in listed.values() for group in groups})

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, groups in listed.items():
            automaton.add_word(term, groups)
        automaton.make_automaton()
        for batch in batches:
            out = []
            for value in batch:
                found: set[str] = set()
                for _, groups in automaton.iter(value.as_py() or ""):
                    found.update(groups)
                    if len(found) == len(names):
                        break
                out.append(sorted(found))
            yield pa.array(out, pa.list_(pa.string()))

    return find


def tag_terms(df: DataFrame, column: str, terms: DataFrame, out: str = "groups", block: int = TERM_BLOCK) -> DataFrame:
    """``df`` with the sorted groups that have a term in the text, as a substring and without regard to case.

    ``terms`` is ``(term, group)``; null and empty terms and null groups are left out, repeats count once. A null text
    has no groups. Texts stay where they are: the terms travel, in blocks of at most ``block`` rows.
    """
    listed = terms.select(F.lower("term").alias("term"), F.col("group").cast("string").alias("group"))
    listed = listed.filter((F.col("term") != "") & F.col("group").isNotNull()).distinct()
    found = F.array().cast("array<string>")
    for rows in row_blocks(listed, ["term", "group"], block):
        held: dict[str, list[str]] = {}
        for term, group in rows:
            held.setdefault(term, []).append(group)
        if not held:
            continue
        found = F.array_union(found, _finder(held)(F.lower(column)))
    return df.withColumn(out, F.array_sort(found))


def holding_terms(df: DataFrame, column: str, terms: DataFrame, block: int = TERM_BLOCK) -> DataFrame:
    """Rows whose text holds at least one of the terms of ``terms (term)``."""
    marked = tag_terms(df, column, terms.select("term", F.lit("").alias("group")), "_held", block)
    return marked.filter(F.size("_held") > 0).drop("_held")
