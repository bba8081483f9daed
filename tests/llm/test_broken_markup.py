"""Broken pages take linear time, and the sample to learn from is the same however it is found."""

import random
import re
import time

from pyspark.sql import functions as F

from zonelake.llm import languages

# The patterns that the scanners stand for, which take quadratic time on broken pages.
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", re.I)


def test_scanners_equal_the_patterns():
    rnd = random.Random(5)
    bits = ["<html", "<HTML ", "lang", "Lang=", "=", " ", "'", '"', "en", "deu", "toolong", ">", "<", "<p", "x", "\n", "<htmls", "xml:lang='fr'"]
    for _ in range(20000):
        page = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        said = DECLARED.search(page)
        assert languages.declared_language(page) == (said.group(1).lower() if said else None), page
        assert languages.page_text(page) == TAG.sub(" ", page), page


def test_broken_pages_take_linear_time():
    start = time.monotonic()
    for page in ("<html " * 400_000, "<" * 2_000_000, "<html lang=" + " " * 2_000_000 + "!", "<script" * 300_000, "<html lang" * 300_000):
        assert languages.declared_language(page) is None
        languages.page_text(page)
    assert time.monotonic() - start < 20


def test_shares_of_groups_equal_a_plain_computation(spark):
    """Chances against loops over pages, hosts, suffixes and declarations."""
    import math

    docs = spark.createDataFrame([(i, t, l) for i in range(30) for t, l in ((f"aba cad {i} aba", "xx"), (f"öö ßü {i} öß", "yy"))], "doc_id long, text string, lang string")
    names, chances = languages.train(docs)
    rows = [(1, "http://a.xx/", "<html lang=xx>aba cad"), (2, "http://a.xx/", "öö ßü"), (3, "http://b.yy/", "<html lang=zz>öß"), (4, None, None), (5, "http://b.yy/q", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = [r.asDict() for r in languages.text_evidence(pages, "page_id", "url", "html", names, chances).collect()]
    share = lambda v: [x / sum(v) for x in v]
    for r in seen:
        r["p"] = share([math.exp(x - max(r["ll"])) for x in r["ll"]])
    total = [sum(r["p"][i] for r in seen) for i in range(2)]
    overall = [(x + 1) / (sum(total) + 2) for x in total]
    want = {}
    for r in seen:
        less = lambda key: [max(sum(o["p"][i] for o in seen if key is None or o[key] == r[key]) - r["p"][i], 0) for i in range(2)]  # noqa: E731, B023
        nh, ns, nd, nt = less("host"), less("suffix"), less("declared"), less(None)
        ps = [(n + o * languages.SUFFIX_STRENGTH) / (sum(ns) + languages.SUFFIX_STRENGTH) for n, o in zip(ns, overall)]
        ph = [(n + o * languages.HOST_STRENGTH) / (sum(nh) + languages.HOST_STRENGTH) for n, o in zip(nh, ps)]
        part = (sum(nd) + 1) / (sum(nt) + len(names) + 2)
        pd = [(d + part * languages.GROUP_STRENGTH) / (t + languages.GROUP_STRENGTH) for d, t in zip(nd, nt)]
        want[r["page_id"]] = share([math.exp(a) * b * c for a, b, c in zip(r["ll"], pd, ph)])
    got = {r.page_id: r.chances for r in languages.identify(pages, names, chances).collect()}
    assert set(got) == set(want)
    assert all(math.isclose(a, b, abs_tol=1e-9) for k in want for a, b in zip(got[k], want[k]))


def test_sample_has_the_smallest_hashes(spark):
    """Of a frequent language exactly as many rows as its share are learned, the same ones each time."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("aaa").alias("text"), F.when(F.col("id") < 50, "yy").otherwise("xx").alias("lang"))
    names, chances = languages.train(docs, rows=1000)
    # Every text has one trigram, so the cell's count is that of the texts.
    import numpy as np

    n = np.round(np.exp(chances.more) * 0.5 - 0.5)
    assert names == ["xx", "yy"] and dict(zip(chances.tongue.tolist(), n.tolist())) == {0: 500.0, 1: 50.0}
