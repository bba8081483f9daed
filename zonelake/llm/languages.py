"""Language of pages by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text (byte trigrams), the declared markup language, the
suffix of the address, and a prior of the host that is smoothed towards its suffix and all pages.  The last three are
learned without labels from the text's posteriors, by grouped aggregation over all pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import slices, stage
from zonelake.llm.urls import address_parts

#: Texts that are fitted on if there are few languages, texts of each language in any case, and cells of the trigram table.
SAMPLE_ROWS, LEAST_SHARE, CELLS = 4000, 125, 1 << 15
#: A text counts as so many trigrams at most, each with this weight: neighbouring trigrams are no independent evidence.
MOST_TRIGRAMS, TRIGRAM_WEIGHT = 120, 0.1
#: Pages that a suffix or the whole counts as in the prior of a host or a suffix.
HOST_STRENGTH, SUFFIX_STRENGTH, GROUP_STRENGTH = 10.0, 50.0, 20.0

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|nav)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b[^>]*", re.I)
_LANG = re.compile(r"\blang\s*=\s*(?:[\"']\s*)?([a-z]{2,3})\b", re.I)


def page_text(html: str) -> str:
    """Text of a page, in linear time: behind the last ``>`` no tag can end, so none is looked for there."""
    left = _DROPPED.sub(" ", html)
    end = left.rfind(">") + 1
    return _TAG.sub(" ", left[:end]) + left[end:]


def declared_language(html: str) -> str | None:
    """Language of the first ``html`` tag that names one, lower-cased.  Each tag is read once, up to its end."""
    for tag in _HTML.finditer(html):
        said = _LANG.search(html, tag.start() + 5, tag.end())
        if said:
            return said.group(1).lower()
    return None


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased text."""
    raw = np.frombuffer(" ".join(text.lower().split()).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(CELLS, np.int64)
    key = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return np.bincount((key * np.uint32(2654435761)) >> np.uint32(17), minlength=CELLS)


@dataclass
class Trigrams:
    """Log chances of trigram cells: ``floor`` of each language for cells it lacks, and what the cells that it has add.

    ``start`` has the first entry of each cell in ``tongue`` and ``more``.
    """

    floor: np.ndarray
    start: np.ndarray
    tongue: np.ndarray
    more: np.ndarray

    def likelihoods(self, counts: np.ndarray) -> np.ndarray:
        cells = np.flatnonzero(counts)
        size = self.start[cells + 1] - self.start[cells]
        times = np.repeat(counts[cells], size)
        at = np.arange(len(times)) + np.repeat(self.start[cells] - np.cumsum(size) + size, size)
        return self.floor * counts.sum() + np.bincount(self.tongue[at], self.more[at] * times, len(self.floor))


def trigrams(tongue: np.ndarray, cell: np.ndarray, n: np.ndarray, languages: int) -> Trigrams:
    """From the counts of each language and cell; every cell counts as half a trigram more."""
    total = np.bincount(tongue, n, languages) + 0.5 * CELLS
    order = np.argsort(cell, kind="stable")
    start = np.zeros(CELLS + 1, np.int64)
    start[1:] = np.cumsum(np.bincount(cell, minlength=CELLS))
    return Trigrams(np.log(0.5 / total), start, tongue[order].astype(np.int32), np.log((n[order] + 0.5) / 0.5))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = SAMPLE_ROWS):
    """All languages and their log chances of each trigram cell.

    From at most ``rows`` documents chosen by a hash of the id, as many of each language; if that were fewer than
    ``LEAST_SHARE``, from so many of each.  Tasks count, Spark adds up; the driver gets the cells that languages have.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    names = sorted(sizes)
    if not names:
        return [], trigrams(*(np.zeros(0, np.int64) for _ in range(3)), 0)
    # As many of each language, so that rare ones are learned too.
    share = max(rows // len(names), min(rows, LEAST_SHARE), 1)
    # Only ids with small hashes are ranked: about twice as many as are wanted, however many there are.
    ids = known.select(F.col(lang).alias("l"), F.col(key).alias("k")).filter(F.col("k").isNotNull()).withColumn("h", F.xxhash64("k"))
    few = (F.col("h").cast("double") + 2.0**63) * F.col("count") <= 2.0**64 * (2 * share + 64)
    nth = F.row_number().over(W.partitionBy("l").orderBy("h", "k"))
    # One row a language, as ``names``, which goes to all tasks with the model anyway.
    counts = F.broadcast(known.sparkSession.createDataFrame(list(sizes.items()), "l string, count long"))
    picked = ids.join(counts, "l").filter(few).withColumn("nth", nth).filter(F.col("nth") <= share)
    picked = F.broadcast(picked.select("k").distinct())  # at most ``share`` ids a language
    sample = known.join(picked, F.col(key) == F.col("k"), "left_semi").select(F.col(lang).alias("l"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for l, t in zip(part.column("l").to_pylist(), part.column("text").to_pylist()):
                    sums[l] = sums.get(l, 0) + trigram_counts(t)
        for l, counts in sums.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([l] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(counts[cells], pa.int64())], names=["l", "cell", "n"]
            )

    counted = sample.mapInArrow(count, "l string, cell int, n long").groupBy("l", "cell").agg(F.sum("n").alias("n")).toArrow()
    place = pa.array(names, pa.string())
    tongue = pc.index_in(counted["l"], place).to_numpy()
    return names, trigrams(tongue.astype(np.int64), counted["cell"].to_numpy(), counted["n"].to_numpy(), len(names))


def text_evidence(pages: DataFrame, key: str, url: str, html: str, names: list[str], chances: Trigrams) -> DataFrame:
    """Per page: key, host, suffix, declared language (one of ``names``, ``other`` or ``none``) and log likelihoods."""
    slim = pages.select(
        F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("text")
    )

    listed = frozenset(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hosts, suffixes, declared, scores = [], [], [], []
                for u, t in zip(part.column("url").to_pylist(), part.column("text").to_pylist()):
                    host = address_parts(u)[0].rpartition("@")[2].partition(":")[0]
                    hosts.append(host)
                    suffixes.append(host.rpartition(".")[2])
                    said = declared_language(t) or "none"
                    declared.append(said if said in listed or said == "none" else "other")
                    counts = trigram_counts(page_text(t))
                    n = counts.sum()
                    worth = TRIGRAM_WEIGHT * min(n, MOST_TRIGRAMS) / max(n, 1)
                    scores.append((chances.likelihoods(counts) * worth).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(hosts, pa.string()), pa.array(suffixes, pa.string()),
                     pa.array(declared, pa.string()), pa.array(scores, pa.list_(pa.float64()))],
                    names=["page_id", "host", "suffix", "declared", "ll"],
                )

    kind = slim.schema["page_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"page_id {kind}, host string, suffix string, declared string, ll array<double>")


def normal(logs: Column) -> Column:
    """Chances that add up to 1, from logs."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def identify(pages: DataFrame, names: list[str], chances: Trigrams, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, host, suffix, declared, text_lang, lang, chance, and the chances of all languages in order.

    A page without text has only the other evidence; null addresses have an empty host, which is a group like others;
    a missing or unknown declaration is the group ``none`` or ``other``.  A page's own share is taken out of its host's
    count, so no evidence counts twice.  Repeated rows are pages of their own.  Without training texts ``lang`` is null.
    """
    if not names:
        return text_evidence(pages, key, url, html, names, chances).select(
            "page_id", "host", "suffix", "declared", F.lit(None).cast("string").alias("text_lang"),
            F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("chance"),
            F.array().cast("array<double>").alias("chances"),
        )
    seen = stage(text_evidence(pages, key, url, html, names, chances), "languages")
    soft = seen.withColumn("p", normal(F.col("ll")))
    by = ["host", "suffix", "declared"]
    # One pass over the pages, one row for each group and language; the coarser groups add up the finer ones.
    groups = soft.select(*by, F.posexplode("p").alias("i", "p")).groupBy(*by, "i").agg(F.sum("p").alias("s"))
    groups = stage(groups, "groups")

    def counts_by(name: str, *by: str) -> DataFrame:
        """Pages of each language in a row of the groups ``by``, as an array in the order of ``names``."""
        sums = groups.groupBy(*by, "i").agg(F.sum("s").alias("s"))
        row = F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"])
        return sums.groupBy(*by).agg(row.alias(name))

    # Written, so that the joins may split a host or a suffix that has many of the pages.
    by_host = stage(counts_by("nh", "host"), "hosts")
    suffixes = stage(counts_by("ns", "suffix"), "suffixes")
    declared = counts_by("nd", "declared")
    total = [0.0] * len(names)
    for i, s in groups.groupBy("i").agg(F.sum("s")).collect():
        total[i] = float(s)
    whole = sum(total)
    overall = F.array(*[F.lit((x + 1.0) / (whole + len(total))) for x in total])
    counts = F.array(*[F.lit(x) for x in total])
    # At most as many rows as languages and two.
    rows = seen.join(F.broadcast(declared), "declared").join(suffixes, "suffix").join(by_host, "host")
    rows = rows.withColumn("own", normal(F.col("ll")))
    plus = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    less = lambda a: F.zip_with(a, F.col("own"), lambda n, o: F.greatest(n - o, F.lit(0.0)))
    rows = rows.select("page_id", "host", "suffix", "declared", "ll", "own", less(F.col("nh")).alias("nh"), less(F.col("ns")).alias("ns"), less(F.col("nd")).alias("nd"), less(counts).alias("nt"))
    by_suffix = F.zip_with("ns", overall, lambda n, o: (n + o * SUFFIX_STRENGTH) / (plus(F.col("ns")) + SUFFIX_STRENGTH))
    rows = rows.withColumn("ps", by_suffix)
    rows = rows.withColumn("ph", F.zip_with("nh", "ps", lambda n, s: (n + s * HOST_STRENGTH) / (plus(F.col("nh")) + HOST_STRENGTH)))
    # Chance of the declaration given the language, smoothed towards the declaration's share of all pages.
    share = (plus(F.col("nd")) + 1.0) / (plus(F.col("nt")) + float(len(names) + 2))
    said = F.zip_with("nd", "nt", lambda d, t: (d + share * GROUP_STRENGTH) / (t + GROUP_STRENGTH))
    rows = rows.withColumn("pd", said)
    fused = F.zip_with(F.zip_with("ll", "pd", lambda a, b: a + F.log(b)), "ph", lambda a, b: a + F.log(b))
    rows = rows.withColumn("chances", normal(fused))
    tongue = F.array(*[F.lit(n) for n in names])
    best = lambda a: F.get(tongue, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return rows.select(
        "page_id", "host", "suffix", "declared", best(F.col("own")).alias("text_lang"), best(F.col("chances")).alias("lang"),
        F.array_max("chances").alias("chance"), "chances",
    )
