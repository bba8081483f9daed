"""URL filter: domain rules, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One of these words rejects an address.
STRICT = ("porn", "xxx", "hentai", "camgirl", "escort", "malware", "phishing", "warez", "keygen")
#: So many different ones of these reject it.
SOFT = ("ads", "track", "tracker", "casino", "poker", "bet", "adult", "sex", "dating", "torrent", "crack", "viagra", "loan", "bonus")
SOFT_LIMIT = 2
#: (host, path, verdict): fixed values of the production rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def address_parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) after the first ``://`` up to ``/ ? #``, and path up to ``? #``; without it both empty."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host) :]
    ends = [i for i in (path.find(c) for c in "?#") if i >= 0]
    lowered = host.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    return lowered, path[: min(ends)] if ends else path


def automaton(strict: Iterable[str], soft: Iterable[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("soft", soft), ("strict", strict)):
        for word in words:
            if word:
                found.add_word(word.lower(), (kind, word.lower()))
    found.make_automaton()
    return found


def vocabulary_hits(url: str, found) -> tuple[int, int]:
    """Strict occurrences and different soft words; a hit has no ASCII letter or digit next to it."""
    text = url.lower()
    plain = lambda i: not (0 <= i < len(text) and text[i].isascii() and text[i].isalnum())
    strict, soft = 0, set()
    if not len(found):
        return 0, 0
    for end, (kind, word) in found.iter(text):
        if plain(end + 1) and plain(end - len(word)):
            if kind == "strict":
                strict += 1
            else:
                soft.add(word)
    return strict, len(soft)


def judge_urls(
    pages: DataFrame, url: str = "url", keep: tuple[str, ...] = (), rules=RULES, strict=STRICT, soft=SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """``keep`` columns with host, path, rule, verdict, strict_hits and soft_hits of every address.

    A rule fits its host and all subdomains if the path starts with the rule's path; the longest one (host and path
    together, first in the list among equals) decides.  Without a rule, one strict word or ``soft_limit`` different
    soft words block.  A null address, or one without ``://``, has an empty host and path, so no rule fits; its words
    still count (a null address has none and is allowed).  Rows are kept as they are, also repeated ones; one narrow
    pass, no shuffle.
    """
    ranked = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    carried = [f"c{i}" for i in range(len(keep))]
    slim = pages.select(F.col(url).cast("string").alias("u"), *[F.col(k).alias(c) for k, c in zip(keep, carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(strict, soft)
        for batch in batches:
            made: dict[str, list] = {k: [] for k in ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")}
            for address in batch.column("u").to_pylist():
                host, path = address_parts(address)
                rule = next(
                    (r for r in ranked if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])), None
                )
                hard, mild = vocabulary_hits(address or "", found)
                refused = hard > 0 or mild >= soft_limit
                made["host"].append(host)
                made["path"].append(path)
                made["rule"].append(rule[0] + rule[1] if rule else None)
                made["verdict"].append(rule[2] if rule else "block" if refused else "allow")
                made["strict_hits"].append(hard)
                made["soft_hits"].append(mild)
            types = [pa.string()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(v, t) for v, t in zip(made.values(), types)],
                names=carried + list(made),
            )

    fields = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in carried)
    schema = (fields + ", " if fields else "") + "host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
    judged = slim.mapInArrow(run, schema)
    return judged.select(*[F.col(c).alias(k) for k, c in zip(keep, carried)], "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def url_sql(table: str = "pages") -> str:
    """The same rows in SQL, word by word."""
    def hit(word: str) -> str:
        return f"regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9]){word}($|[^a-z0-9])')"

    hard = " OR ".join(hit(w) for w in STRICT)
    mild = " + ".join(f"CAST({hit(w)} AS INT)" for w in SOFT)
    ranked = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda r: f"((host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}'))"
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[0]}{r[1]}'" for r in ranked) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[2]}'" for r in ranked)
    return f"""
    WITH rest AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                  FROM {table}),
    parts AS (SELECT page_id, url, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
                     regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest)
    SELECT page_id, host, path, {rule} AS rule,
           {said} WHEN ({hard}) OR ({mild}) >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
           CAST({mild} AS INT) AS soft_hits
    FROM parts"""
