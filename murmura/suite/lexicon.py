"""Word tables for the invented text, and the SQL of the lexicon scores."""

from __future__ import annotations

from murmura.operators import sentiment as N
from murmura.suite.base import small, sql_list

NEGATIVE = ["trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser", "disgusting", "stupid"]
POSITIVE = ["thatin", "inoran", "hehely", "orantion"]
VALENCES = {**{w: -1.5 - 0.1 * i for i, w in enumerate(NEGATIVE)}, **{w: 1.2 + 0.3 * i for i, w in enumerate(POSITIVE)}, "the": 0.4, "der": -0.3, "les": 0.6}
POLARITY = {w: (round(v / 4.3, 5), 0.3117 + 0.0471 * i) for i, (w, v) in enumerate(VALENCES.items())}
# Frequent words stand in for degree adverbs and negations.
BOOSTERS = {"of": 0.293, "und": 0.293, "that": -0.293, "de": -0.293}
NEGATIONS = ("and", "nicht", "la")
INTENSIFIERS = {"of": 1.3, "und": 1.3, "that": 0.7, "de": 0.7}


def valence_table(spark):
    return small(spark, word=list(VALENCES), valence=list(VALENCES.values()))


def polarity_table(spark):
    return small(spark, word=list(POLARITY), polarity=[p for p, _ in POLARITY.values()], subjectivity=[s for _, s in POLARITY.values()])


def _values(rows) -> str:
    return ", ".join("('" + w + "', " + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in xs) + ")" for w, *xs in rows)


def _tokens(source: str, key: str, column: str) -> str:
    stripped = f"list_transform(list_filter(regexp_split_to_array({column}, '\\s+'), lambda t: t <> ''), lambda t: regexp_replace(t, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g'))"
    return f"""split_texts AS (SELECT {key} AS k, list_filter({stripped}, lambda t: t <> '') AS ts FROM {source}),
placed AS (SELECT k, unnest(ts) AS tok, generate_subscripts(ts, 1) - 1 AS pos FROM split_texts),
near AS (SELECT k, pos, tok, lower(tok) AS word, (upper(tok) = tok AND lower(tok) <> tok) AS caps,
  lag(lower(tok), 1) OVER w AS b1, lag(lower(tok), 2) OVER w AS b2, lag(lower(tok), 3) OVER w AS b3
  FROM placed WINDOW w AS (PARTITION BY k ORDER BY pos))"""


def sql_compound(source: str, key: str, column: str) -> str:
    """CTEs ending in ``compound (key, compound)``."""
    up = sql_list([w for w, s in BOOSTERS.items() if s > 0])
    down = sql_list([w for w, s in BOOSTERS.items() if s < 0])

    def step(v: str, b: str, k: int) -> str:
        boost = f"CASE WHEN {b} IN {up} THEN 0.293 WHEN {b} IN {down} THEN -0.293 ELSE 0.0 END"
        shifted = f"({v} + sign({v}) * ({boost}) * {N.DAMPING[k]})"
        turned = f"CASE WHEN {b} IN {sql_list(NEGATIONS)} OR ends_with({b}, 'n''t') THEN {shifted} * {N.NEGATION} ELSE {shifted} END"
        return f"CASE WHEN {b} IS NULL OR {b} IN {sql_list(list(VALENCES))} THEN {v} ELSE {turned} END"

    return f"""lex(word, valence) AS (VALUES {_values(VALENCES.items())}),
{_tokens(source, key, column)},
flags AS (SELECT k, (bool_or(caps) AND NOT bool_and(caps)) AS mixed, min(pos) FILTER (WHERE word = 'but') AS but_pos FROM near GROUP BY k),
v0 AS (SELECT n.k, n.pos, n.b1, n.b2, n.b3, f.but_pos, CASE WHEN n.caps AND f.mixed THEN l.valence + sign(l.valence) * {N.CAPS} ELSE l.valence END AS v
  FROM near n JOIN lex l ON n.word = l.word JOIN flags f ON n.k = f.k),
v1 AS (SELECT * REPLACE ({step('v', 'b1', 1)} AS v) FROM v0),
v2 AS (SELECT * REPLACE ({step('v', 'b2', 2)} AS v) FROM v1),
v3 AS (SELECT * REPLACE ({step('v', 'b3', 3)} AS v) FROM v2),
sums AS (SELECT k, sum(v * CASE WHEN but_pos IS NULL OR pos = but_pos THEN 1.0 WHEN pos < but_pos THEN {N.BUT_BEFORE} ELSE {N.BUT_AFTER} END) AS s FROM v3 GROUP BY k),
marks AS (SELECT {key} AS k, coalesce(s, 0.0) AS s, least(len({column}) - len(replace({column}, '!', '')), {N.MAX_EXCLAMATIONS}) * {N.EXCLAMATION}
  + CASE WHEN len({column}) - len(replace({column}, '?', '')) > 3 THEN {N.MANY_QUESTIONS}
         WHEN len({column}) - len(replace({column}, '?', '')) > 1 THEN (len({column}) - len(replace({column}, '?', ''))) * {N.QUESTION} ELSE 0.0 END AS e
  FROM {source} LEFT JOIN sums ON {key} = sums.k),
raised AS (SELECT k, CASE WHEN s > 0 THEN s + e WHEN s < 0 THEN s - e ELSE s END AS r FROM marks),
compound AS (SELECT k AS {key}, r / sqrt(r * r + {N.ALPHA}) AS compound FROM raised)"""


def sql_polarity(source: str, key: str, column: str) -> str:
    """CTEs ending in ``polarity (key, polarity, subjectivity)``."""
    factor = "CASE " + " ".join(f"WHEN b1 IN {sql_list([w for w, x in INTENSIFIERS.items() if x == s])} THEN {s}" for s in (1.3, 0.7)) + " ELSE 1.0 END"
    turned = " OR ".join(f"coalesce({b} IN {sql_list(NEGATIONS)} OR ends_with({b}, 'n''t'), FALSE)" for b in ("b1", "b2"))
    return f"""lex(word, p, s) AS (VALUES {_values((w, p, s) for w, (p, s) in POLARITY.items())}),
{_tokens(source, key, column)},
marked AS (SELECT k, greatest(-1.0, least(1.0, l.p * ({factor}) * CASE WHEN {turned} THEN {N.NEGATED_POLARITY} ELSE 1.0 END)) AS p,
  least(1.0, l.s * ({factor})) AS s FROM near JOIN lex l USING (word)),
means AS (SELECT k, avg(p) AS p, avg(s) AS s FROM marked GROUP BY k),
polarity AS (SELECT {key}, coalesce(p, 0.0) AS polarity, coalesce(s, 0.0) AS subjectivity FROM {source} LEFT JOIN means ON {key} = means.k)"""
