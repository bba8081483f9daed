"""Headline terms and sentiment over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query
from zonelake.functions import sentiment, text
from zonelake.plans import analysis

PATTERN = "[a-z0-9]{2,}"
STOP_WORDS = ["the", "and", "that", "la", "le", "de", "der", "die", "el"]
# A small lexicon over the syllables of the given texts.
LEXICON = [("er", -1.5), ("in", 0.5), ("re", 1.9), ("an", -0.7), ("tion", 2.4), ("on", -2.1), ("ver", 1.1), ("en", -0.4)]

_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_LEXICON_SQL = ", ".join(f"('{term}', {valence}::DOUBLE)" for term, valence in LEXICON)


def _terms_sql(table: str, key: str) -> str:
    return f"""
    WITH tokens AS (SELECT {key}, unnest(regexp_extract_all(lower(text), '{PATTERN}', 0)) AS term FROM {table}),
         ranked AS (SELECT {key}, term, row_number() OVER (PARTITION BY {key} ORDER BY COUNT(*) DESC, term) AS rn
                    FROM tokens WHERE term NOT IN ({_STOP_SQL}) GROUP BY {key}, term),
         top AS (SELECT {key}, string_agg(term, ' ' ORDER BY term) AS topic_words FROM ranked WHERE rn <= 2 GROUP BY {key})
    SELECT {key}, COALESCE(topic_words, '') AS topic_words FROM {table} LEFT JOIN top USING ({key})"""


def _top_terms(df, key):
    found = analysis.headline_terms(df, "text", 2, STOP_WORDS, PATTERN)
    return found.select(key, F.array_join("topic_words", " ").alias("topic_words"))


@query(_terms_sql("documents", "doc_id"))
def top_terms(t):
    return _top_terms(t.documents.select("doc_id", "text"), "doc_id")


@query(_terms_sql("benchmark", "item_id"))
def top_terms_short(t):
    return _top_terms(t.benchmark, "item_id")


@query(f"""
    SELECT doc_id, term, CAST(COUNT(*) AS INT) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{PATTERN}', 0)) AS term FROM documents) GROUP BY ALL""")
def term_counts(t):
    return t.documents.select("doc_id", "text").select("doc_id", F.inline(text.term_counts(text.words("text", PATTERN))))


@query(f"""
    WITH lexicon(term, valence) AS (VALUES {_LEXICON_SQL}),
         tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{PATTERN}', 0)) AS term FROM documents),
         sums AS (SELECT doc_id, CAST(SUM(CAST(valence AS DECIMAL(9,1))) AS DOUBLE) AS s FROM tokens JOIN lexicon USING (term) GROUP BY 1)
    SELECT doc_id, round(COALESCE(s, 0) / sqrt(COALESCE(s, 0) * COALESCE(s, 0) + 15), 9) AS score,
           CASE WHEN COALESCE(s, 0) / sqrt(COALESCE(s, 0) * COALESCE(s, 0) + 15) > 0.2 THEN 'positive'
                WHEN COALESCE(s, 0) / sqrt(COALESCE(s, 0) * COALESCE(s, 0) + 15) < -0.2 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM documents LEFT JOIN sums USING (doc_id)""")
def lexicon_sentiment(t):
    lexicon = t.spark.createDataFrame(LEXICON, "term STRING, valence DOUBLE").withColumn(
        "valence", F.col("valence").cast("decimal(9,1)")
    )
    return analysis.lexicon_sentiment(t.documents.select("doc_id", "text"), "doc_id", "text", lexicon, PATTERN).withColumn(
        "score", F.round("score", 9)
    )


# ---------------------------------------------------------------- rules around the lexicon

RULES = sentiment.Rules(stronger=("the", "is"), weaker=("or",), negations=("not", "to"), contrast=("that",))
_BARE = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"


def _step_sql(d: int, before: str) -> str:
    """What the word ``d`` places before does to the valence ``before``."""
    boost = f"CASE WHEN l{d} IN ('the', 'is') THEN 0.293 WHEN l{d} = 'or' THEN -0.293 ELSE 0 END::DOUBLE"
    loud = f"CASE WHEN cap{d} AND mixed THEN 0.733 ELSE 0 END::DOUBLE"
    fading = sentiment.FADING[d - 1]
    added = f"CASE WHEN {boost} <> 0 THEN sign({before}) * ({boost} + {loud}) ELSE 0 END::DOUBLE"
    turned = f"CASE WHEN replace(replace(l{d}, '''', ''), '’', '') IN ('not', 'to') OR suffix(l{d}, 'n''t') THEN -0.74 ELSE 1 END::DOUBLE"
    return f"CASE WHEN l{d} IS NULL OR v{d} IS NOT NULL THEN {before} ELSE ({before} + {added} * {fading}::DOUBLE) * {turned} END"


RULED_SENTIMENT_SQL = f"""
    WITH lexicon(term, valence) AS (VALUES {_LEXICON_SQL}),
         runs AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^ \\t\\n\\f\\r\\v]+') AS ws FROM documents),
         each AS (SELECT doc_id, unnest(ws) AS r, generate_subscripts(ws, 1) AS i FROM runs),
         bare AS (SELECT doc_id, i, r, regexp_replace(r, '{_BARE}', '', 'g') AS b FROM each),
         word AS (SELECT doc_id, i, CASE WHEN length(b) <= 2 THEN r ELSE b END AS w FROM bare),
         fact AS (SELECT doc_id, i, lower(w) AS l, upper(w) = w AND lower(w) <> w AS cap, valence FROM word LEFT JOIN lexicon ON term = lower(w)),
         near AS (SELECT *, {', '.join(f'lag({c}, {d}) OVER o AS {n}{d}' for d in (1, 2, 3) for c, n in (('l', 'l'), ('cap', 'cap'), ('valence', 'v')))},
                         COUNT(*) FILTER (cap) OVER p BETWEEN 1 AND COUNT(*) OVER p - 1 AS mixed,
                         COALESCE(MIN(i) FILTER (l = 'that') OVER p, 0) AS turn
                  FROM fact WINDOW o AS (PARTITION BY doc_id ORDER BY i), p AS (PARTITION BY doc_id)),
         s0 AS (SELECT *, valence + CASE WHEN cap AND mixed THEN sign(valence) * 0.733::DOUBLE ELSE 0 END AS x0 FROM near
                WHERE valence IS NOT NULL AND l NOT IN ('the', 'is', 'or')),
         s1 AS (SELECT *, {_step_sql(1, 'x0')} AS x1 FROM s0),
         s2 AS (SELECT *, {_step_sql(2, 'x1')} AS x2 FROM s1),
         s3 AS (SELECT *, {_step_sql(3, 'x2')} AS x3 FROM s2),
         sums AS (SELECT doc_id, SUM(x3 * CASE WHEN l1 = 'least' AND v1 IS NULL AND COALESCE(l2 NOT IN ('at', 'very'), TRUE) THEN -0.74::DOUBLE ELSE 1 END
                                     * CASE WHEN turn = 0 OR i = turn THEN 1 WHEN i < turn THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END) AS s
                  FROM s3 GROUP BY 1),
         marks AS (SELECT doc_id, least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
                          + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN 0.96::DOUBLE
                                 WHEN length(text) - length(replace(text, '?', '')) > 1
                                 THEN (length(text) - length(replace(text, '?', ''))) * 0.18::DOUBLE ELSE 0 END AS e FROM documents),
         total AS (SELECT doc_id, COALESCE(s + sign(s) * e, 0) AS t FROM documents JOIN marks USING (doc_id) LEFT JOIN sums USING (doc_id)),
         scored AS (SELECT doc_id, round(t / sqrt(t * t + 15), 4) AS score FROM total)
    SELECT doc_id, score, CASE WHEN score > 0.2 THEN 'positive' WHEN score < -0.2 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM scored"""


@query(RULED_SENTIMENT_SQL)
def headline_sentiment(t):
    lexicon = t.spark.createDataFrame(LEXICON, "term STRING, valence DOUBLE")
    return analysis.headline_sentiment(t.documents.select("doc_id", "text"), "text", lexicon, RULES).drop("text")
