"""Consumption jobs: headlines, series, classification, clustering.  Everything returned is a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonelake.functions import sentiment, text
from zonelake.functions.scalars import quarter_start, squash, three_way
from zonelake.operators import stats
from zonelake.operators.filters import equals_ignoring_case, last_years
from zonelake.plans import clusters
from zonelake.session import scratch_path

# ---------------------------------------------------------------- headlines


def headline_terms(
    df: DataFrame,
    title: str,
    k: int = 2,
    stop_words: list[str] | None = None,
    pattern: str = text.WORD_PATTERN,
    name: str = "topic_words",
) -> DataFrame:
    """Add the ``k`` most frequent non-stop words per title, alphabetically; none left gives an empty array."""
    stop_words = text.default_stop_words() if stop_words is None else stop_words
    tokens = text.drop_words(text.words(title, pattern), stop_words)
    return df.withColumn(name, text.most_frequent(text.term_counts(tokens), k))


def lexicon_sentiment(
    df: DataFrame, key: str, title: str, lexicon: DataFrame, pattern: str = text.WORD_PATTERN
) -> DataFrame:
    """(key, score, sentiment) per title; ``lexicon`` is a table (term, valence) with one row per term.

    The valences of a title's words are summed, squashed to (-1, 1) and labelled.  Words are counted inside the row
    first, so a title sends each of its words once.  The lexicon join is left to Spark: a lexicon below the broadcast
    threshold is broadcast; a larger one is joined by term, where adaptive execution splits frequent words.
    """
    counted = text.term_counts(text.words(title, pattern))
    words = df.select(key, F.explode_outer(counted).alias("_t")).select(key, "_t.term", "_t.n")
    scored = words.join(lexicon.select("term", "valence"), "term", "left")
    total = F.coalesce(F.sum(F.col("valence") * F.col("n")), F.lit(0).cast("double")).cast("double")
    sums = scored.groupBy(key).agg(total.alias("_total"))
    return sums.select(key, squash(F.col("_total")).alias("score")).withColumn("sentiment", three_way(F.col("score")))


def headline_sentiment(
    df: DataFrame, title: str, lexicon: DataFrame, rules: sentiment.Rules | None = None, low: float = -0.2, high: float = 0.2
) -> DataFrame:
    """Add ``score`` and ``sentiment`` by the rules of :mod:`zonelake.functions.sentiment`: negation, boosters, capitals,
    contrast and end marks count.  The lexicon enters the scan as one value; no title leaves its row."""
    held = df.withColumn("_lexicon", sentiment.lexicon_lists(lexicon))
    scored = held.withColumn("score", sentiment.sentiment_score(title, F.col("_lexicon"), rules)).drop("_lexicon")
    return scored.withColumn("sentiment", three_way(F.col("score"), low, high))


# ---------------------------------------------------------------- series


def asset_series(
    report: DataFrame, companies: list[str], label: str = "Total assets", statement: str = "bs"
) -> DataFrame:
    """(symbol, date, value): one balance-sheet line per company and quarter, ready to be drawn."""
    wanted = (
        equals_ignoring_case("label", label) & F.col("symbol").isin(companies) & (F.col("statement") == statement)
    )
    return report.filter(wanted).select("symbol", quarter_start("year", "quarter").alias("date"), "value")


def indicator_series(indicators: DataFrame, chosen: list[str], years: int = 25) -> DataFrame:
    """(indicator, year, value) of chosen indicators over the last years of the whole table."""
    return last_years(indicators, "year", years).filter(F.col("indicator").isin(chosen)).select(
        "indicator", "year", "value"
    )


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Sort for presentation."""
    return df.orderBy(*columns)


# ---------------------------------------------------------------- classification

# The features and the target of the transaction classifier.
FEATURES = ("amount", "account_balance", "transaction_duration", "login_attempts")
TARGET = "type"


def classification_frame(df: DataFrame, features: list[str], target: str = TARGET, keep: list[str] | None = None) -> DataFrame:
    """Complete rows with features as doubles, the target, and ``label``: its alphabetical position.

    The distinct labels (a handful) come in as a scalar subquery, so the table is only scanned.
    """
    # One more than the bound is enough to see that there are too many.
    distinct = df.filter(F.col(target).isNotNull()).select(target).distinct().limit(MOST_CATEGORIES + 1)
    found = F.array_sort(F.collect_list(target))
    few = F.when(F.size(found) <= MOST_CATEGORIES, found).otherwise(F.raise_error(F.lit(f"over {MOST_CATEGORIES} labels")))
    labels = distinct.select(few).scalar()
    complete = df.dropna(subset=[*features, target])
    return complete.select(
        *(keep or []),
        *[F.col(c).cast("double").alias(c) for c in features],
        target,
        (F.array_position(labels, F.col(target)) - 1).cast("int").alias("label"),
    )


def split_column(key: Column | str, train_percent: int = 80, portable: bool = False) -> Column:
    """True for training rows.  Depends on the key only, so it is the same for any partitioning and on every run.

    ``portable`` uses md5, which other engines have as well; the default hash is faster.
    """
    key = F.col(key) if isinstance(key, str) else key
    if portable:
        bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100
    else:
        bucket = F.pmod(F.xxhash64(key), F.lit(100))
    return bucket < train_percent


def fit_gaussian_nb(train: DataFrame, features: list[str], label: str = "label", smoothing: float = 1e-9) -> DataFrame:
    """Gaussian naive Bayes as one aggregation: (label, prior, means, variances), one row per class.

    Variances are population variances plus ``smoothing`` times the largest feature variance of all rows.
    """
    per_class = train.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"_mean{i}") for i, c in enumerate(features)],
        *[F.var_pop(c).alias(f"_var{i}") for i, c in enumerate(features)],
    )
    # The variance over all rows follows from the class moments, so a second pass over the data is not needed.  The
    # window holds one row per class.
    classes = Window.partitionBy(F.lit(0))
    share = F.col("n") / F.sum("n").over(classes)
    overall = [
        F.sum(share_i).over(classes) - F.pow(F.sum(mean_i).over(classes), F.lit(2))
        for share_i, mean_i in (
            (F.col("prior") * (F.col(f"_var{i}") + F.col(f"_mean{i}") * F.col(f"_mean{i}")), F.col("prior") * F.col(f"_mean{i}"))
            for i in range(len(features))
        )
    ]
    return per_class.withColumn("prior", share).withColumn("_extra", F.array_max(F.array(*overall)) * smoothing).select(
        F.col(label).alias("label"),
        "prior",
        F.array(*[F.col(f"_mean{i}") for i in range(len(features))]).alias("means"),
        F.array(*[F.col(f"_var{i}") + F.col("_extra") for i in range(len(features))]).alias("variances"),
    )


def predict_gaussian_nb(df: DataFrame, model: DataFrame, features: list[str], name: str = "prediction") -> DataFrame:
    """Add the class with the highest posterior (the smaller label on a tie).

    The model is one row per class; it enters the scan as a scalar subquery, so nothing is joined or shuffled.
    """
    classes = model.select(
        F.array_sort(F.collect_list(F.struct("label", "prior", "means", "variances")))
    ).scalar()

    def log_posterior(c: Column) -> Column:
        score = F.log(c["prior"])
        for i, feature in enumerate(features):
            mean, variance = F.get(c["means"], F.lit(i)), F.get(c["variances"], F.lit(i))
            gap = F.col(feature) - mean
            score = score - 0.5 * F.log(2 * F.pi() * variance) - gap * gap / (2 * variance)
        return score

    scored = F.transform(
        "_classes", lambda c: F.struct(log_posterior(c).alias("score"), (-c["label"]).alias("order"))
    )
    return df.withColumn("_classes", classes).withColumn(name, -F.array_max(scored)["order"]).drop("_classes")


def classify(df: DataFrame, key: str, features: list[str], target: str = TARGET, portable: bool = False) -> DataFrame:
    """Train on 80 % of the rows and predict the rest: (key, target, label, prediction)."""
    frame = classification_frame(df, features, target, keep=[key])
    is_train = split_column(key, portable=portable)
    model = fit_gaussian_nb(frame.filter(is_train), features)
    return predict_gaussian_nb(frame.filter(~is_train), model, features).select(key, target, "label", "prediction")


# ---------------------------------------------------------------- users and clusters


def user_features(profiles: DataFrame, transactions: DataFrame, key: str = "user_id") -> DataFrame:
    """Profiles with mean amount and dominant transaction type, complete rows only.

    One pass over the transactions: amounts and counts are combined per (user, type) before the first shuffle, so a
    user with a third of all transactions arrives as one row per type and task.
    """
    per_type = transactions.groupBy(key, "type").agg(
        F.sum("amount").alias("_sum"), F.count("amount").alias("_amounts"), F.count("type").alias("_n")
    )
    mode = F.min_by("type", F.when(F.col("type").isNotNull(), F.struct(-F.col("_n"), F.col("type"))))
    per_user = per_type.groupBy(key).agg(
        (F.sum("_sum").cast("double") / F.sum("_amounts")).alias("avg_amount"), mode.alias("dominant_type")
    )
    return profiles.join(per_user, key).dropna()


#: Different values of a column that are still taken for categories.
MOST_CATEGORIES = 1000


def categories(df: DataFrame, columns: list[str], most: int = MOST_CATEGORIES) -> dict[str, list[str]]:
    """The values of each column as sorted texts, from one pass; a column with more than ``most`` is an error."""
    distinct = stats.value_counts(df, columns).filter("value is not null").select("column", "value")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in distinct.limit(most * len(columns) + 1).collect():
        found[row.column].append(row.value)
    if large := sorted(c for c, values in found.items() if len(values) > most):
        raise ValueError(f"over {most} categories in {', '.join(large)}")
    return {c: sorted(values) for c, values in found.items()}


def one_hot(df: DataFrame, column: str, values: list[str] | None = None, drop: bool = True) -> DataFrame:
    """One 0/1 column per category, named ``column_category``; all 0 for NULL and for values that aren't listed.

    Without a list the categories are those of the column (see :func:`categories`).
    """
    values = categories(df, [column])[column] if values is None else values
    flags = [F.coalesce(F.col(column).cast("string") == c, F.lit(False)).cast("int").alias(f"{column}_{c}") for c in values]
    kept = [F.col(f"`{c}`") for c in df.columns if not (drop and c == column)]
    return df.select(*kept, *flags)


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column becomes 0.

    Mean and deviation of all columns come from one aggregation, used as a scalar subquery.
    """
    moments = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(f"c{i}") for i, c in enumerate(columns)])
    ).scalar()
    scaled = {}
    for i, c in enumerate(columns):
        moment = moments[f"c{i}"]
        dev = F.when(moment["dev"] == 0, F.lit(1.0)).otherwise(moment["dev"])
        scaled[c] = (F.col(c) - moment["mean"]) / dev
    return df.withColumns(scaled)


@dataclass(frozen=True)
class Clustering:
    """Fitted components and centres, and the table with ``pc`` (coordinates) and ``cluster``."""

    components: clusters.Components
    centres: list[list[float]]
    rows: DataFrame


def cluster_users(
    df: DataFrame, numeric: list[str], categorical: list[str], k: int = 3, components: int = 2, decimals: int = 6
) -> Clustering:
    """One-hot encode, scale, reduce to principal components, k-means; complete rows only.

    The features are written once and read by each pass over them.  Signs, start and numbers are fixed (see
    :mod:`zonelake.plans.clusters`), so the same rows give the same clusters.
    """
    spark, whole = df.sparkSession, df.dropna(subset=[*numeric, *categorical])
    names = [f"_n{i}" for i in range(len(numeric))]
    features = whole.withColumns({n: F.col(c).cast("double") for n, c in zip(names, numeric)})
    for i, (column, values) in enumerate(categories(whole, categorical).items() if categorical else ()):
        flags = {f"_c{i}_{j}": (F.col(column).cast("string") == v).cast("double") for j, v in enumerate(values)}
        features, names = features.withColumns(flags), [*names, *flags]
    path = scratch_path(spark, "features")
    features.write.parquet(path)
    scaled = standardise(spark.read.schema(features.schema).parquet(path), names)
    found = clusters.principal_components(scaled, names, components)
    axes = [f"_pc{i}" for i in range(components)]
    placed = clusters.project(scaled, found, axes)
    placed = placed.withColumns({c: F.round(F.col(c), decimals) + F.lit(0.0) for c in axes})
    points = scratch_path(spark, "points")
    placed.select(*df.columns, *axes).write.parquet(points)
    placed = spark.read.parquet(points)
    centres = clusters.k_means(placed, axes, k)
    rows = placed.select(*df.columns, F.array(*axes).alias("pc"), clusters.nearest(axes, centres).alias("cluster"))
    return Clustering(found, centres, rows)


def evaluation(predicted: DataFrame, actual: str = "label", prediction: str = "prediction") -> tuple[DataFrame, DataFrame]:
    """(per-class report, confusion matrix)."""
    return stats.class_report(predicted, actual, prediction), stats.confusion(predicted, actual, prediction)
