"""License scans: phrases, and text blocks that contain most of a license template.

Blocks are the lines of a text and its paragraphs (runs of lines with a word).
A block matches a template when it holds at least ``threshold`` of the
template's distinct words. Words are ordered by how many lines of the corpus
hold them, rarest first; a template of q words that misses at most
``q - ceil(t * q)`` shares one of its first ``q - ceil(t * q) + 1`` words (the
prefix) with every block that matches. Blocks found through a prefix word are
dropped when they are too short (length filter), or when too few template words
follow that word in the order, on either side, for it to be the first of enough
(positional filter); the rest are counted exactly. Words of no template come
first in the order, as they can match nothing.

Templates are a fixed list, so their words go to every task and texts never
move. Only the counts of template words are shuffled.

Nulls: a null or empty text has no words, no places and no labels. Ties among
equally common words go by the word. Repeated rows are scanned each; an empty
table stays empty. Texts are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, table
from murmura.llm.bytescan import ALPHANUMERIC, Words, row_blocks, words

THRESHOLD = 0.8

# Phrases and labels of the query.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Published wordings by which licenses are stated, with their usual short names.
TEMPLATES = {
    "agpl": "licensed under the GNU Affero General Public License, version 3",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "cc-by": "licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "lgpl": "licensed under the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_FOUND = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "blocks array<struct<first_word:bigint,last_word:bigint,template:string,containment:double>>"
)


def hashed(phrases: Sequence[str]) -> list[np.ndarray]:
    """Word hashes of each phrase."""
    found = words(pa.array(list(phrases), pa.string()), ALPHANUMERIC)
    return [found.hashes[lo:hi] for lo, hi in zip(found.bounds, found.bounds[1:], strict=False)]


def needed(threshold: float, n: int) -> int:
    return math.ceil(round(threshold * n, 9))


def lines_of_words(found: Words) -> np.ndarray:
    """Number of the line, over the whole batch, that each word stands in."""
    breaks = np.flatnonzero(found.raw == 0x0A)
    return np.searchsorted(breaks, found.starts) + found.text_of_word()


def word_frequencies(docs: DataFrame, templates: dict[str, str]) -> dict[int, int]:
    """Lines of the corpus that hold each template word; counted in the tasks, at most one row per word and task."""
    wanted = np.unique(np.concatenate(hashed(list(templates.values()))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for whole in batches:
            for batch in row_blocks(whole, "text"):
                found = words(batch.column("text"), ALPHANUMERIC)
                at = np.minimum(np.searchsorted(wanted, found.hashes), len(wanted) - 1)
                hit = wanted[at] == found.hashes
                pairs = np.unique(np.stack([lines_of_words(found)[hit], at[hit]], axis=1), axis=0)
                total += np.bincount(pairs[:, 1], minlength=len(wanted))
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(total)], names=["word", "n"])

    counted = docs.select("text").mapInArrow(rows, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


class Scanner:
    """Phrases and templates ready to be looked for in a batch."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], frequency: dict[int, int], threshold: float):
        self.phrases = list(zip(hashed(list(phrases)), phrases.values(), strict=True))
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        self.names, self.sets, self.least = list(templates), [], []
        own_words = [np.unique(own) for own in hashed(list(templates.values()))]
        self.vocabulary = np.unique(np.concatenate(own_words))
        in_order = sorted(self.vocabulary.tolist(), key=lambda w: (frequency.get(int(np.uint64(w).view(np.int64)), 0), w))
        self.place = {w: i for i, w in enumerate(in_order)}
        self.places_of = np.array([self.place[w] for w in self.vocabulary.tolist()], np.int64)
        for k, own in enumerate(own_words):
            order = sorted(own.tolist(), key=self.place.get)
            self.sets.append(np.array(order, np.uint64))
            self.least.append(needed(threshold, len(order)))
            for place, word in enumerate(order[: len(order) - self.least[k] + 1]):
                self.prefix.setdefault(word, []).append((k, place))
        self.prefix_words = np.array(sorted(self.prefix), np.uint64)

    def places(self, found: Words) -> Iterator[tuple[np.ndarray, str]]:
        """Indexes of the words where each phrase begins."""
        owner = found.text_of_word()
        for phrase, label in self.phrases:
            n = len(found.hashes) - len(phrase) + 1
            if n <= 0:
                continue
            at = np.flatnonzero(found.hashes[:n] == phrase[0])
            for j in range(1, len(phrase)):
                at = at[found.hashes[at + j] == phrase[j]]
            yield at[owner[at] == owner[at + len(phrase) - 1]], label

    def blocks(self, found: Words) -> Iterator[tuple[int, int, int, float]]:
        """(first word, end word, template, containment) of the blocks that match."""
        if not len(found.hashes):
            return
        at = np.minimum(np.searchsorted(self.prefix_words, found.hashes), len(self.prefix_words) - 1)
        hits = np.flatnonzero(self.prefix_words[at] == found.hashes)
        if not len(hits):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, found.hashes), len(self.vocabulary) - 1)
        global_place = np.where(self.vocabulary[at] == found.hashes, self.places_of[at], -1)
        line = lines_of_words(found)
        new_line = np.flatnonzero(np.diff(line)) + 1
        # A paragraph ends where the line number jumps by more than one: a line without words, or another text.
        owner = found.text_of_word()
        new_paragraph = np.flatnonzero((np.diff(line) > 1) | (owner[1:] != owner[:-1])) + 1
        seen = set()
        for bounds in (new_line, new_paragraph):
            edges = np.concatenate([[0], bounds, [len(line)]])
            lo = hi = -1
            for hit in hits.tolist():
                if hit >= hi:
                    block = int(np.searchsorted(edges, hit, "right")) - 1
                    lo, hi = int(edges[block]), int(edges[block + 1])
                    distinct = np.unique(global_place[lo:hi])
                for template, place in self.prefix[int(found.hashes[hit])]:
                    if (lo, hi, template) in seen:
                        continue
                    own, least = self.sets[template], self.least[template]
                    if hi - lo < least:
                        continue
                    following = len(distinct) - int(np.searchsorted(distinct, global_place[hit], "right"))
                    if 1 + min(len(own) - place - 1, following) < least:
                        continue
                    seen.add((lo, hi, template))
                    shared = int(np.isin(own, found.hashes[lo:hi]).sum())
                    if shared >= least:
                        yield lo, hi, template, shared / len(own)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: its words, the places of the phrases, labels, and the blocks that match a template."""
    scanner = Scanner(phrases, templates, word_frequencies(docs, templates), threshold)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_blocks(whole, "text"):
                found = words(batch.column("text"), ALPHANUMERIC)
                places: dict[int, list[tuple[int, str]]] = {}
                blocks: dict[int, list[dict]] = {}
                for starts, label in scanner.places(found):
                    for at in starts.tolist():
                        text = int(np.searchsorted(found.bounds, at, "right")) - 1
                        places.setdefault(text, []).append((at - int(found.bounds[text]), label))
                for lo, hi, template, share in scanner.blocks(found):
                    text = int(np.searchsorted(found.bounds, lo, "right")) - 1
                    first = int(found.bounds[text])
                    names = {"first_word": lo - first, "last_word": hi - 1 - first, "template": scanner.names[template], "containment": share}
                    blocks.setdefault(text, []).append(names)
                out = {c: [] for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")}
                for text in range(batch.num_rows):
                    here, near = places.get(text, []), blocks.get(text, [])
                    base = {label for _, label in here}
                    out["n_base"].append(len(here))
                    out["first_word"].append(min((at for at, _ in here), default=None))
                    out["last_word"].append(max((at for at, _ in here), default=None))
                    out["base_labels"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(base | {b["template"] for b in near})))
                    out["score"].append(1.0 if base else max((b["containment"] for b in near), default=0.0))
                    out["blocks"].append(near)
                block_kind = pa.list_(
                    pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("template", pa.string()), ("containment", pa.float64())])
                )
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), block_kind]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(found.counts.astype(np.int64)), *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]],
                    names=["doc_id", "n_words", *out],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, _FOUND)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[0-9a-z\\x{80}-\\x{10FFFF}]+"


def _sql_words(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '{_TOKEN}')"


def _sql_phrase(phrase: str, label: str) -> str:
    parts = phrase.split()
    test = " AND ".join(f"w[i + {j}] = '{part}'" for j, part in enumerate(parts))
    return f"list_transform(list_filter(range(1, len(w) - {len(parts)} + 2), lambda i: {test}), lambda i: {{'place': i - 1, 'label': '{label}'}})"


_TEMPLATE_ROWS = ", ".join(f"('{name}', list_distinct({_sql_words(chr(39) + text.replace(chr(39), chr(39) * 2) + chr(39))}))" for name, text in TEMPLATES.items())


@query(
    "op6_license_scan",
    f"""WITH templates AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS t(template, own)),
texts AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text, {_sql_words("coalesce(text, '')")} AS w FROM documents),
placed AS (SELECT *, list_concat({", ".join(_sql_phrase(p, label) for p, label in PHRASES.items())}) AS places FROM texts),
lined AS (SELECT row_no, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM texts),
worded AS (SELECT row_no, line_no, {_sql_words("line")} AS w FROM lined),
grouped AS (SELECT *, line_no - row_number() OVER (PARTITION BY row_no ORDER BY line_no) AS paragraph FROM worded WHERE len(w) > 0),
blocks AS (
  SELECT row_no, w FROM grouped
  UNION ALL SELECT row_no, flatten(list(w)) AS w FROM grouped GROUP BY row_no, paragraph),
matches AS (
  SELECT row_no, template, len(list_intersect(own, list_distinct(w))) / len(own) AS containment
  FROM blocks, templates WHERE len(list_intersect(own, list_distinct(w))) >= ceil(round({THRESHOLD} * len(own), 9))),
best AS (SELECT row_no, max(containment) AS containment, list_distinct(list(template)) AS names FROM matches GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(list_transform(places, lambda p: p.place)) AS BIGINT) AS first_word,
       CAST(list_max(list_transform(places, lambda p: p.place)) AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda p: p.label), coalesce(names, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END::DOUBLE AS score
FROM placed LEFT JOIN best USING (row_no)""",
)
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents")).drop("blocks")
