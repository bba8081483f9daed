"""Every labelled language is told apart, however many there are."""

import random

import numpy as np

from zonelake.llm import languages


def tongue(k):
    rnd = random.Random(k)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(40)]


def code(k):
    return "".join("abcdefghij"[int(d)] for d in f"{k:02d}")


def test_forty_languages(spark):
    rnd = random.Random(1)
    text = lambda k, n: " ".join(rnd.choices(tongue(k), k=n))
    # The last ones are the rarest.
    docs = [(100 * k + i, text(k, 60), code(k)) for k in range(40) for i in range(6 if k < 32 else 3)]
    names, chances = languages.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert names == [code(k) for k in range(40)]
    pages = [(k, f"http://h{k}.com/", f"<html lang={code(k)}><p>{text(k, 60)}</p></html>") for k in range(40)]
    found = {r.page_id: r for r in languages.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), names, chances).collect()}
    assert {k: (r.lang, r.text_lang, r.declared) for k, r in found.items()} == {k: (code(k),) * 3 for k in range(40)}


def test_sparse_chances_equal_the_table():
    rnd = np.random.default_rng(2)
    tongues, cell = map(np.ravel, np.meshgrid(np.arange(3), rnd.choice(languages.CELLS, 50, False), indexing="ij"))
    keep = rnd.random(len(cell)) < 0.6
    tongues, cell, n = tongues[keep], cell[keep], rnd.integers(1, 90, keep.sum())
    table = np.full((3, languages.CELLS), 0.5)
    table[tongues, cell] += n
    counts = np.bincount(rnd.choice(cell, 200), minlength=languages.CELLS) + np.bincount([7, 9], minlength=languages.CELLS)
    want = np.log(table / table.sum(axis=1, keepdims=True)) @ counts
    assert np.allclose(languages.trigrams(tongues, cell, n, 3).likelihoods(counts), want)
