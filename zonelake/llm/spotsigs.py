"""Document fingerprints by spot signatures (DataFrame operations only).

A spot is an anchor, one of the common words below or the start of the text, with the next content words: those that
are no anchors.  Where anchors are too far apart, every word between them is an anchor as well, so that the spots span all
of a text in any language.  A fingerprint is the sorted set of 31-bit hashes of a text's spots.  Sets are told apart by length
first: their Jaccard likeness is at most the smaller length over the larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import free_name

#: Very common words of four languages.
ANCHORS = (
    "the", "of", "and", "to", "in", "is", "was", "that", "for", "with", "on", "are", "by",
    "der", "die", "und", "das", "ist", "zu", "den", "von", "ein", "eine",
    "le", "la", "les", "des", "et", "est", "un", "une", "du", "pour", "dans",
    "el", "los", "las", "de", "que", "en", "y", "una", "con", "por",
)
#: Content words of a spot.
CHAIN = 2
#: Words from one anchor to the next in which no other word becomes an anchor; in texts of few anchors ``CHAIN`` for each.
GAP = 8
#: Bounds of the ids that are looked up row by row, and rows that are put in order together.
COARSE, RUN_ROWS, MOST_RUNS = 128, 2048, 65536
_START = "\u0001"


def with_spots(df: DataFrame, text: str, name: str, anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Add array<int> ``name``: the sorted different spots of a text, all of it.  A null text counts as empty.

    Between anchors more than ``GAP`` words apart (``chain`` for each anchor, if that is less) every word starts a spot,
    so a text without common words has one for each of its words.  A text without letters and digits has one spot made of the text itself, so equal texts always have equal sets and
    no set is empty.
    """
    words, found, whole = free_name(df, f"{name}_words"), free_name(df, f"{name}_found"), F.coalesce(F.col(text), F.lit(""))
    marks = "|".join([_START, *sorted(anchors, key=lambda w: (-len(w), w))])
    plain = F.concat(F.lit(f" {_START} "), F.regexp_replace(F.lower(whole), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    plain = F.regexp_replace(plain, " +", " ")
    # Each anchor is glued to what follows, so a run of anchors and the next content word are one word.
    marked = F.replace(F.regexp_replace(plain, f" ({marks})(?= )", " $1^"), F.lit("^ "), F.lit("^"))
    df = df.withColumn(words, F.split(F.trim(marked), " "))
    after = lambda i, k: F.substring_index(F.get(F.col(words), i + k), "^", -1)
    short = lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    hashed = lambda w, i: short(F.xxhash64(w, *[after(i, k) for k in range(1, chain)]))
    anchored = F.filter(
        F.transform(F.col(words), lambda w, i: F.when(w.contains("^"), F.struct(F.substring_index(w, "^", -2).alias("w"), i.alias("i")))),
        lambda x: x.isNotNull(),
    )
    df = df.withColumn(found, anchored)
    widest = F.least(F.lit(GAP), F.size(found) * chain)
    until = lambda k: F.coalesce(F.get(F.col(found), k + 1)["i"], F.size(words))
    plain_word = lambda i: F.struct(F.get(F.col(words), i).alias("w"), i.alias("i"))
    between = F.transform(
        F.col(found),
        lambda x, k: F.when(until(k) - x["i"] > widest, F.transform(F.sequence(x["i"] + 1, until(k) - 1), plain_word)),
    )
    between = F.flatten(F.filter(between, lambda x: x.isNotNull()))
    spots = F.transform(F.concat(F.col(found), between), lambda x: hashed(x["w"], x["i"]))
    bare = F.col(words) == F.array(F.lit(f"{_START}^"))
    spots = F.when(bare, F.array(short(F.xxhash64(whole)))).otherwise(F.array_sort(F.array_distinct(spots)))
    return df.withColumn(name, spots).drop(words, found)


def fingerprint(spots: Column) -> Column:
    """The set as a string of eight hex digits a spot."""
    one = lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")
    return F.array_join(F.transform(spots, one), "")


def length_class(spots: Column, least: float = 0.8) -> Column:
    """Sets whose likeness is ``least`` or more lie in the same class of lengths or in neighbouring ones."""
    return F.floor(F.log(F.size(spots).cast("double")) / F.log(F.lit(1 / least))).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 without counting if their lengths keep it under ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    return F.when(small < large * F.lit(least), F.lit(0.0)).otherwise(exact)


def with_next(df: DataFrame, key: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """Add the values that ``columns`` have in the following row by descending ``key`` (after the last: the first).

    Null keys come last, equal keys follow a hash of the row.  Rows move once, to runs of neighbouring keys; the first
    row of each run is given to the run before it too.  Runs are cut by approximate percentiles and evenly between
    them; there are at most ``MOST_RUNS``, which bounds the table of first keys that is broadcast.
    """
    spark = df.sparkSession
    run, ghost, tie = (free_name(df, n) for n in ("run", "ghost", "tie"))
    n, *rest = df.agg(
        F.count(F.lit(1)), F.percentile_approx(key, [i / COARSE for i in range(COARSE + 1)], 20000)
    ).first()
    bounds = sorted(set(rest[0] or [0]))
    fine = max(1, min(MOST_RUNS // COARSE, n // (RUN_ROWS * max(1, len(bounds) - 1))))
    ends = F.array(*[F.lit(b).cast("double") for b in bounds])
    value = F.col(key).cast("double")
    at = F.greatest(F.size(F.filter(ends, lambda b: b <= value)), F.lit(1))
    low = F.element_at(ends, at)
    width = F.greatest(F.coalesce(F.get(ends, at), low + 1) - low, F.lit(1e-9))
    part = F.least(F.greatest(F.floor((value - low) / width * fine), F.lit(0)), F.lit(fine - 1))
    placed = df.withColumn(run, F.coalesce(((at - 1) * fine + part), F.lit(-1)).cast("int"))
    first = dict(placed.groupBy(run).agg(F.max(key)).collect())
    order = sorted(first, reverse=True)
    heads = [(first[r], order[i - 1]) for i, r in enumerate(order)]
    heads = spark.createDataFrame(heads, f"head {df.schema[key].dataType.simpleString()}, goes int")
    copies = placed.join(F.broadcast(heads), F.col(key).eqNullSafe(F.col("head")))
    copies = copies.select(*df.columns, F.col("goes").alias(run), F.lit(1).alias(ghost))
    everything = placed.withColumn(ghost, F.lit(0)).unionByName(copies)
    everything = everything.withColumn(tie, F.xxhash64(*[F.col(c) for c in columns]))
    follows = W.partitionBy(run).orderBy(ghost, F.col(key).desc_nulls_last(), tie)
    seen = everything.withColumns({f"{prefix}{c}": F.lead(c).over(follows) for c in columns})
    return seen.filter(F.col(ghost) == 0).drop(run, ghost, tie)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like it is to the edited text's and the next one's.

    The edited text has the last third of the characters replaced by as many first ones of the next document (all, if
    it is shorter).  Null texts are empty; an empty text has n_chars 0, equals its edited text and so has near_edited
    1.  A single document follows itself.  Rows that repeat an id are rows of their own.  No rows, no result rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = with_next(with_spots(rows, "text", "spots"), "doc_id", ["text", "spots"])
    size = F.char_length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", size.alias("n_chars"), "spots", "next_spots", edited.alias("edited"))
    rows = with_spots(rows, "edited", "edited_spots")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        F.size("spots").alias("n_spots"),
        length_class(F.col("spots")).alias("length_class"),
    )
