"""Declarative quality rules, evaluated for a whole suite at once."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.operators.windows import order_violations

# ---------------------------------------------------------------- rules about one row


@dataclass(frozen=True)
class NotNull:
    column: str

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Between:
    """Inclusive bounds; an open side is None.  ``today`` as upper bound is the current date."""

    column: str
    low: object = None
    high: object = None

    def holds(self) -> Column:
        value = F.col(self.column)
        high = F.current_date() if self.high == "today" else self.high
        tests = [value >= self.low] if self.low is not None else []
        tests += [value <= high] if high is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))


@dataclass(frozen=True)
class Matches:
    column: str
    pattern: str

    def holds(self) -> Column:
        return F.col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class InSet:
    column: str
    values: tuple

    def holds(self) -> Column:
        return F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class DistinctWithinRecord:
    """The listed columns differ from each other inside each row; rows where all are NULL are ignored."""

    columns: tuple[str, ...]

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def holds(self) -> Column:
        texts = [F.col(c).cast("string") for c in self.columns]
        clash = reduce(lambda a, b: a | b, [a.eqNullSafe(b) for a, b in combinations(texts, 2)])
        return F.coalesce(*texts).isNull() | ~clash


# ---------------------------------------------------------------- rules about the whole set


@dataclass(frozen=True)
class Unique:
    """No value occurs twice.  With several columns it is a compound key.  Keys with a NULL part are ignored."""

    columns: tuple[str, ...]

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class Increasing:
    """Values increase along an explicit order, within groups if given."""

    column: str
    order_by: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    strict: bool = True


ROW_RULES = (NotNull, Between, Matches, InSet, DistinctWithinRecord)


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple = field(default_factory=tuple)

    def row_rules(self) -> list:
        return [rule for rule in self.rules if isinstance(rule, ROW_RULES)]


def unique(*columns: str) -> Unique:
    return Unique(tuple(columns))


def rule_id(rule) -> str:
    """Stable name of a rule inside its suite, e.g. ``between:rate``."""
    names = {
        NotNull: "not_null",
        Between: "between",
        Matches: "matches",
        InSet: "in_set",
        DistinctWithinRecord: "distinct_within_record",
        Unique: "unique",
        Increasing: "increasing",
    }
    return f"{names[type(rule)]}:{rule.column}"


def _broken(rule) -> Column:
    """True where the row breaks the rule.  A NULL value breaks only ``NotNull``."""
    return F.coalesce(~rule.holds(), F.lit(False))


# ---------------------------------------------------------------- evaluation


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(key columns, n) for each key that occurs more than once; keys with a NULL part are ignored."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _row_results(df: DataFrame, suite: Suite, by: list[str]) -> DataFrame:
    rules = suite.row_rules()
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(_broken(rule)).alias(f"_r{i}") for i, rule in enumerate(rules)]
    )
    lines = F.array(
        *[
            F.struct(F.lit(rule_id(rule)).alias("rule"), F.col("_n").alias("n"), F.col(f"_r{i}").alias("unexpected"))
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(*by, F.inline(lines))


def _unique_results(df: DataFrame, rule: Unique, by: list[str]) -> DataFrame:
    """Counts per key are combined before the shuffle, so a value that fills a third of the table is no hot spot."""
    key = [c for c in rule.columns if c not in by]
    per_key = df.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("_n"))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    return per_key.groupBy(*by).agg(
        F.lit(rule_id(rule)).alias("rule"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when((F.col("_n") > 1) & complete, F.col("_n"))), F.lit(0)).alias("unexpected"),
    )


def _increasing_results(df: DataFrame, rule: Increasing, by: list[str]) -> DataFrame:
    groups = [*by, *[c for c in rule.partition_by if c not in by]]
    per_group = order_violations(df, rule.column, list(rule.order_by), groups, rule.strict)
    return per_group.groupBy(*by).agg(
        F.lit(rule_id(rule)).alias("rule"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("unexpected"),
    )


def evaluate(df: DataFrame, suite: Suite, by: Sequence[str] = ()) -> DataFrame:
    """(by..., suite, rule, n, unexpected, success), one row per rule and group of ``by``.

    All row rules share one aggregation.  Each uniqueness and order rule needs its own key's shuffle and reads only
    that rule's columns.  ``df`` should be a table (or persisted) when the suite has such rules.
    """
    by = list(by)
    parts = [_row_results(df, suite, by)] if suite.row_rules() else []
    parts += [_unique_results(df, rule, by) for rule in suite.rules if isinstance(rule, Unique)]
    parts += [_increasing_results(df, rule, by) for rule in suite.rules if isinstance(rule, Increasing)]
    together = reduce(DataFrame.unionByName, parts)
    return together.select(
        *by, F.lit(suite.name).alias("suite"), "rule", "n", "unexpected", (F.col("unexpected") == 0).alias("success")
    )


def batch_verdict(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., success, failed_rules): one failed rule fails the whole batch."""
    return results.groupBy(*by).agg(
        F.bool_and("success").alias("success"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("rule")))).alias("failed_rules"),
    )


def flag_rows(df: DataFrame, suite: Suite, name: str = "failed_rules") -> DataFrame:
    """Add the array of row rules that each row breaks."""
    broken = F.array(*[F.when(_broken(rule), rule_id(rule)) for rule in suite.row_rules()])
    return df.withColumn(name, F.array_compact(broken))


def split_rows(df: DataFrame, suite: Suite) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with ``failed_rules``) from one flagged frame."""
    flagged = flag_rows(df, suite)
    return flagged.filter(F.size("failed_rules") == 0).drop("failed_rules"), flagged.filter(F.size("failed_rules") > 0)


# ---------------------------------------------------------------- the suites of the trusted tables

# Patterns, sets and bounds of the data contracts.
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ACCOUNT = r"^AC\d{5}$"
CURRENCY = r"^[A-Z]{3}$"
INDICATOR = r"^[A-Z_]+$"
SYMBOL = r"^[A-Z\.]{1,10}$"
WEB_LINK = r"^https?://"
DESCRIPTION = r"^M\d{3} - .+"
DEVICE = r"^D\d{6}$"
IPV4 = r"^(?:\d{1,3}\.){3}\d{1,3}$"
DATE_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
PDF_PATH = r"^s3a://unstructureddata/pdfs/.+\.pdf$"
DOCUMENT_IMAGE_PATH = r"^s3a://unstructureddata/images/doc_.+\.jpg$"
FACE_IMAGE_PATH = r"^s3a://unstructureddata/images/face_.+\.jpg$"
STATEMENTS = ("bs", "cf", "ic")
DIRECTIONS = ("Debit", "Credit")
CATEGORIES = ("contract", "receipt", "report")
KYC_STATES = ("pending", "approved", "rejected")
FIRST_RATE_DAY = datetime.date(1999, 1, 4)


def required(column: str, *rules) -> tuple:
    return (NotNull(column), *rules)


INDICATORS = Suite(
    "indicators",
    (
        *required("year", Between("year", 1900, 2100), Increasing("year", ("year",), ("indicator",))),
        *required("indicator", Matches("indicator", INDICATOR)),
        *required("value"),
        DistinctWithinRecord(("year", "indicator")),
    ),
)
EXCHANGE_RATES = Suite(
    "exchange_rates",
    (
        *required("time", Between("time", FIRST_RATE_DAY, "today")),
        *required("currency", Matches("currency", CURRENCY)),
        *required("rate", Between("rate", 0.0, 1e6)),
        DistinctWithinRecord(("time", "currency")),
    ),
)
NEWS = Suite(
    "financial_news",
    (
        *required("ts"),
        *required("title"),
        *required("link", Matches("link", WEB_LINK), unique("link")),
        *[Between(f"sent_{part}", 0, 1) for part in ("neg", "neu", "pos")],
        Between("sent_polarity", -1, 1),
    ),
)
FINANCIAL_REPORT = Suite(
    "financial_report",
    (
        *required("symbol", Matches("symbol", SYMBOL)),
        *required("year", Between("year", 1900, 2100)),
        *required("quarter", Between("quarter", 1, 4)),
        InSet("statement", STATEMENTS),
        *required("concept"),
        *required("value"),
        DistinctWithinRecord(("symbol", "year", "quarter", "statement", "concept")),
    ),
)
TRANSACTIONS = Suite(
    "user_transactions",
    (
        *required("transaction_id", Matches("transaction_id", UUID), unique("transaction_id")),
        *required("timestamp"),
        InSet("type", DIRECTIONS),
        *required("amount", Between("amount", 0, 1e6)),
        *required("currency", Matches("currency", CURRENCY)),
        Matches("description", DESCRIPTION),
        *required("location"),
        *required("device_id", Matches("device_id", DEVICE)),
        Matches("ip_address", IPV4),
        *required("account_balance", Between("account_balance", 0, 1e8)),
        Matches("previous_transaction", DATE_TIME),
        Between("transaction_duration", 0, 86400),
        Between("login_attempts", 0, 10),
    ),
)
PROFILES = Suite(
    "user_profiles",
    (
        *required("user_id", Matches("user_id", ACCOUNT), unique("user_id")),
        *required("age", Between("age", 0, 120)),
        *required("occupation"),
    ),
)
PDF_UPLOADS = Suite(
    "pdf_metadata",
    (
        *required("request_id", Matches("request_id", UUID), unique("request_id")),
        *required("user_id", Matches("user_id", ACCOUNT)),
        *required("category", InSet("category", CATEGORIES)),
        *required("pdf_s3_path", Matches("pdf_s3_path", PDF_PATH)),
        *required("upload_time"),
    ),
)
KYC = Suite(
    "kyc_metadata",
    (
        *required("request_id", Matches("request_id", UUID), unique("request_id")),
        *required("user_id", Matches("user_id", ACCOUNT)),
        *required("doc_s3_path", Matches("doc_s3_path", DOCUMENT_IMAGE_PATH)),
        *required("face_s3_path", Matches("face_s3_path", FACE_IMAGE_PATH)),
        *required("upload_time"),
        *required("status", InSet("status", KYC_STATES)),
    ),
)
SUITES = {
    suite.name: suite
    for suite in (INDICATORS, EXCHANGE_RATES, NEWS, FINANCIAL_REPORT, TRANSACTIONS, PROFILES, PDF_UPLOADS, KYC)
}
