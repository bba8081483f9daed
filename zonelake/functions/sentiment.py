"""Rule-based sentiment of short texts, inside the row.

A word's valence comes from a lexicon table.  What stands up to three words before it boosts, dampens or turns it;
capitals, a contrasting conjunction and end marks change the weight.  The rules are those published by Hutto and Gilbert
(ICWSM 2014).  Texts aren't split into rows: nothing is shuffled, and Python isn't needed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.functions.scalars import squash
from zonelake.functions.text import _once

# Fixed values of the published rules.
BOOST, CAPITALS, TURN, NEVER = 0.293, 0.733, -0.74, 1.25
EXCLAMATION, MOST_EXCLAMATIONS, QUESTION, QUESTIONS = 0.292, 4, 0.18, 0.96
BEFORE_CONTRAST, BEHIND_CONTRAST = 0.5, 1.5
#: Weight of a booster one, two and three words before.
FADING = (1.0, 0.95, 0.9)
STRONGER = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply", "enormously",
    "entirely", "especially", "exceptionally", "extremely", "fully", "greatly", "highly", "hugely", "incredibly", "intensely",
    "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total",
    "totally", "tremendously", "unbelievably", "unusually", "utterly", "very",
)
WEAKER = (
    "almost", "barely", "hardly", "just enough", "kind of", "less", "little", "marginally", "occasionally", "partly",
    "scarcely", "slightly", "somewhat", "sort of",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt", "hasnt", "havent", "isnt", "neither",
    "never", "no", "nobody", "none", "nope", "nor", "not", "nothing", "nowhere", "shouldnt", "wasnt", "werent", "without",
    "wont", "wouldnt", "rarely", "seldom", "despite",
)

#: Lists of terms in the lexicon, so that a look-up compares a few terms; terms of a lexicon at most.
LISTS, MOST_TERMS = 1024, 200_000
_EDGES = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"


@dataclass(frozen=True)
class Rules:
    """Word lists of a language; the defaults are English."""

    stronger: tuple[str, ...] = STRONGER
    weaker: tuple[str, ...] = WEAKER
    negations: tuple[str, ...] = NEGATIONS
    contrast: tuple[str, ...] = ("but",)
    weights: dict[str, float] = field(default_factory=dict)  # boosters with a weight of their own

    def boost(self, word: Column) -> Column:
        found = F.when(word.isin(*self.stronger), BOOST).when(word.isin(*self.weaker), -BOOST)
        for w, weight in self.weights.items():
            found = found.when(word == w, weight)
        return F.coalesce(found, F.lit(0.0))

    def negates(self, word: Column) -> Column:
        plain = F.regexp_replace(word, "['’]", "")
        return F.coalesce(plain.isin(*self.negations) | word.endswith("n't"), F.lit(False))


def lexicon_lists(lexicon: DataFrame, lists: int = LISTS, most: int = MOST_TERMS) -> Column:
    """A lexicon (term, valence) as one value: maps by hash of the term.  Over ``most`` terms are an error."""
    rows = lexicon.select(F.lower("term").alias("term"), F.col("valence").cast("double").alias("valence")).dropna()
    rows = rows.groupBy("term").agg(F.max("valence").alias("valence")).limit(most + 1)
    at = F.pmod(F.xxhash64("term"), F.lit(lists)).cast("int")
    parts = rows.groupBy(at.alias("at")).agg(F.map_from_entries(F.collect_list(F.struct("term", "valence"))).alias("terms"))
    whole = parts.agg(F.map_from_entries(F.collect_list(F.struct("at", "terms"))).alias("m"), F.sum(F.size("terms")).alias("n"))
    few = F.when(F.coalesce("n", F.lit(0)) <= most, F.col("m")).otherwise(F.raise_error(F.lit(f"over {most} terms")))
    empty = F.create_map().cast("map<string,double>")
    return whole.select(F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda i: F.coalesce(F.try_element_at(few, i), empty))).scalar()


def valence(word: Column, lists: Column, count: int = LISTS) -> Column:
    """The valence of a lower-case word, NULL if the lexicon doesn't have it."""
    return F.try_element_at(F.get(lists, F.pmod(F.xxhash64(word), F.lit(count)).cast("int")), word)


def tokens(text: Column) -> Column:
    """Words without the marks around them; what has no more than two characters then, such as a smiley, stays as it is."""
    def bare(word: Column) -> Column:
        return _once(F.regexp_replace(word, _EDGES, ""), lambda w: F.when(F.length(w) <= 2, word).otherwise(w))

    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""), bare)


def _word(words: Column, i: Column) -> Column:
    return F.when(i >= 0, F.get(words, i))


def emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the size of the sum."""
    marks = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    asked = _once(marks("?"), lambda n: F.when(n > 3, QUESTIONS).when(n > 1, n * QUESTION).otherwise(0.0))
    return F.least(marks("!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + asked


def sentiment_score(text: Column | str, lists: Column, rules: Rules | None = None) -> Column:
    """Score from -1 to 1 with four decimals; NULL and empty texts have 0."""
    rules = rules or Rules()
    text = F.col(text) if isinstance(text, str) else text

    def scored(row: Column) -> Column:
        low, caps, values, mixed, turn = row["low"], row["caps"], row["values"], row["mixed"], row["turn"]

        def one(value: Column, i: Column) -> Column:
            loud = F.when(F.get(caps, i) & mixed, F.signum(value) * CAPITALS).otherwise(0.0)

            def step(v: Column, d: Column) -> Column:
                word, between = _word(low, i - d), (_word(low, i - 1), _word(low, i - 2))
                known = F.get(values, F.greatest(i - d, F.lit(0))).isNotNull()
                boost = _once(rules.boost(word), lambda b: F.when(b != 0, F.signum(v) * (b + F.when(F.get(caps, F.greatest(i - d, F.lit(0))) & mixed, CAPITALS).otherwise(0.0))).otherwise(0.0))
                fading = F.get(F.array(*[F.lit(x) for x in FADING]), d - 1)
                near = lambda *w: F.coalesce(((d >= 2) & between[0].isin(*w)) | ((d == 3) & between[1].isin(*w)), F.lit(False))
                turned = (
                    F.when((word == "never") & near("so", "this"), NEVER).when((word == "without") & near("doubt"), 1.0)
                    .when(rules.negates(word), TURN).otherwise(1.0)
                )
                return F.when(word.isNull() | known, v).otherwise((v + boost * fading) * turned)

            near_words = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), (value + loud).cast("double"), step)
            least = (_word(low, i - 1) == "least") & ~F.coalesce(_word(low, i - 2).isin("at", "very"), F.lit(False))
            least = F.coalesce(least, F.lit(False)) & F.get(values, F.greatest(i - 1, F.lit(0))).isNull()
            weight = F.when(turn == 0, 1.0).when(i + 1 < turn, BEFORE_CONTRAST).when(i + 1 > turn, BEHIND_CONTRAST).otherwise(1.0)
            whole = near_words * F.when(least, TURN).otherwise(1.0) * weight
            return F.when(value.isNull() | (rules.boost(F.get(low, i)) != 0), 0.0).otherwise(whole)

        total = F.aggregate(F.transform(values, one), F.lit(0.0), lambda a, x: a + x)
        marked = _once(total, lambda s: s + F.signum(s) * emphasis(text))
        return _once(marked, lambda s: F.round(squash(s), 4))

    def facts(words: Column) -> Column:
        caps = F.transform(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w))
        low = F.transform(words, F.lower)
        loud = F.size(F.filter(caps, lambda c: c))
        return F.struct(
            low.alias("low"), caps.alias("caps"), F.transform(low, lambda w: valence(w, lists)).alias("values"),
            ((loud > 0) & (loud < F.size(words))).alias("mixed"), _first(low, rules.contrast).alias("turn"),
        )

    return F.coalesce(_once(_once(tokens(text), facts), scored), F.lit(0.0))


def _first(words: Column, wanted: tuple[str, ...]) -> Column:
    """Position from 1 of the first of some words, 0 if there is none."""
    return F.array_position(F.transform(words, lambda w: w.isin(*wanted)), True)
