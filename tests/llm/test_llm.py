"""The training-data operators on small tables: against brute force, and on nulls, empty texts, ties and repeated rows."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonelake.llm import chunks, languages, metric_join, neighbours, packing, pfair, queries, spotsigs, suffixes, toxicity, urls

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run string, slot int"


def frame(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", f"src{i % 3}", None, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "one two three", "ONE two three", words(1, 300), words(1, 300), words(1, 290) + " x", words(2, 4000)]


def brute_components(texts):
    sets = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [(i, len(s), group[i]) for i, s in enumerate(sets)]


def near_copies():
    base = words(9, 120).split()
    out = []
    for k in range(60):
        rnd, copy = random.Random(k), list(base)
        for _ in range(k % 9):
            copy[rnd.randrange(len(copy))] = f"w{rnd.random()}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("texts", [ODD, near_copies(), near_copies() + ODD, [words(3, 40) + " " + words(k, 200) for k in range(50, 70)]])
def test_metric_join_equals_brute_force(spark, texts):
    found = metric_join.near_duplicates(frame(spark, texts)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == brute_components(texts)


def test_metric_join_by_rings(spark, monkeypatch):
    monkeypatch.setattr(metric_join.similar_sets, "__defaults__", (2, 2))
    found = metric_join.near_duplicates(frame(spark, near_copies())).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == brute_components(near_copies())


def test_one_of_each_keeps_rows_without_words_and_one_of_repeated_rows(spark):
    docs = frame(spark, ["a b c d e f"] * 3 + [None, "", "z"], [5, 5, 7, None, 9, None])
    kept = metric_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect() if r.text) == [(-1, "z"), (5, "a b c d e f")]
    assert kept.filter("text IS NULL OR text = ''").count() == 2


def test_line_dedup(spark):
    passage = "\n".join(words(k, 12) for k in range(20, 40))
    docs = frame(spark, [words(50, 9) + "\n" + passage, words(51, 9) + "\n" + passage + "\n" + words(52, 9), None, "", "a\n\n\nb"])
    rows = {r.doc_id: r for r in chunks.remove_repeats(docs).collect()}
    assert rows[0].text == docs.first().text and rows[0].removed_lines == 0
    assert rows[1].removed_lines >= 12 and words(51, 9) in rows[1].text and words(52, 9) in rows[1].text
    kept = rows[1].text.split("\n")
    assert len(kept) + rows[1].removed_lines == rows[1].n_lines == 22
    assert (rows[2].text, rows[3].text, rows[4].text) == (None, "", "a\n\n\nb")


def test_chunks_follow_the_lines(spark):
    lines = [words(k, 5) for k in range(200)]
    own = {"\n".join(lines[a:b]) for a, b in chunks.line_chunks(lines)}
    moved = ["x", "y", "z", *lines]
    other = {"\n".join(moved[a:b]) for a, b in chunks.line_chunks(moved)}
    assert len(own & other) >= 0.8 * len(own)


def test_packing_is_whole_and_gapless(spark):
    from tokenizers import Tokenizer

    texts = [*ODD, "It's ÀÉ 12 é end. <|endoftext|> x", "Σας J̌", *[words(k, 5 + 13 * k) for k in range(60)]]
    found = packing.pack_documents(frame(spark, texts)).toPandas()
    plain = Tokenizer.from_file(packing.vocabulary_path())
    for i, t in enumerate(texts):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in found[found.doc_id == i].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 4096


def test_strategies_place_every_piece():
    rnd = np.random.default_rng(4)
    for _ in range(5):
        histogram = rnd.integers(0, 30, 32) * (rnd.random(32) < 0.5)
        placed = np.zeros(32, int)
        for parts, times in packing.strategies(histogram):
            assert sum(parts) <= 32
            np.add.at(placed, np.array(parts) - 1, times)
        assert placed.tolist() == histogram.tolist()


def test_fingerprints(spark):
    texts = [t for t in ODD] + ["the of and the of", "!!!", "???", "the cat and a dog in the house of mice " * 40]
    found = {r.doc_id: r for r in spotsigs.edited_fingerprints(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        own, after = t or "", texts[(i - 1) % len(texts)] or ""
        n = len(own) // 3
        edited = own[: len(own) - n] + after[:n]
        assert found[i].n_chars == len(own) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and (own != edited or found[i].near_edited == 1)
        assert found[i].fingerprint and (own != after or found[i].near_next == 1)
    assert found[6].fingerprint == found[7].fingerprint and found[len(ODD) + 1].fingerprint != found[len(ODD) + 2].fingerprint
    long = spotsigs.with_spots(frame(spark, ["the " * 20000 + "end"]), "text", "s").select(F.size("s")).first()[0]
    assert long == 1


def test_mix_deviates_by_less_than_a_block(spark):
    rows = [(i, "abc"[min(i % 5, 2)]) for i in range(3000)] + [(9000, None), (9001, "other"), (None, "a"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    mixed = pfair.mix_sources(docs, "source", "doc_id", {"a": 5.0, "b": 2.0, "c": 3.0}, 0.5, block_rows=8, run_rows=100)
    found = mixed.toPandas()
    assert len(found) == len(rows) and not found.duplicated(["slot", "place"]).any()
    blocks = found.drop_duplicates("slot").sort_values("slot")
    assert blocks.slot.tolist() == list(range(len(blocks)))
    assert ((blocks.slot >= blocks.release) & (blocks.slot < blocks.deadline)).all()
    shares = pfair.whole_shares({"a": 5.0, "b": 2.0, "c": 3.0}, 1024)
    slots = pfair.one_period(shares)
    for s, share in shares.items():
        got = np.cumsum([x == s for x in slots])
        assert (np.abs(got - share / 1024 * np.arange(1, 1025)) < 1).all()


def test_urls(spark):
    rows = [
        (1, "http://a.Example.NET/en/x", "example.net/en/", "allow"), (2, "http://example.net/de/x", "net/", "block"),
        (3, "https://m.example.com/de/1?porn", "example.com/de/", "block"), (4, "https://example.org/fr/", "org/fr/", "allow"),
        (5, None, None, "allow"), (6, "", None, "allow"), (7, "no scheme/porn", None, "block"), (8, "http://x.com/pornography", None, "allow"),
        (9, "http://x.com/casino", None, "allow"), (10, "http://x.com/casino-poker", None, "block"), (11, "http://casino.com/casino", None, "allow"),
        (12, "http://net", None, "allow"), (13, "http://net/", "net/", "block"), (14, "http://planet/", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u) for i, u, _, _ in rows], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, keep=("page_id",)).collect()}
    assert found == {i: (rule, verdict) for i, _, rule, verdict in rows}


def test_neighbours(spark):
    rnd = np.random.default_rng(3)
    vectors = rnd.normal(size=(3000, 32)).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(5000, None), (5020, [0.0] * 32), (5040, [float("nan")] * 32), (5060, [1.0, None] * 16), (None, vectors[0]), (20, vectors[20]), (5080, [1.0, 2.0])]
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    want = neighbours.brute_force(pd.DataFrame({"vec_id": range(3000), "embedding": vectors}))
    assert set(found.query_id) == set(want)
    hits = sum(len(set(g.vec_id) & set(want[q])) for q, g in found.groupby("query_id"))
    assert hits >= 0.9 * 20 * len(want)
    assert (found.groupby("query_id")["rank"].apply(list).map(lambda x: sorted(x) == list(range(1, 21)))).all()
    row = found.iloc[0]
    assert abs(row.score - np.dot(vectors[int(row.query_id)], vectors[int(row.vec_id)])) < 1e-12


def test_suffix_array():
    rnd = random.Random(5)
    for _ in range(60):
        t = [rnd.choice([1, 2, 2, 3, 5]) for _ in range(rnd.randrange(1, 90))] + [0]
        assert suffixes.suffix_array(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("most", [4096, 1])
def test_suffix_dedup_equals_brute_force(spark, most):
    shared, length = words(7, 60), 200
    texts = [*ODD, shared, words(8, 30) + shared[:260] + words(9, 20), shared[100:], "ab" * 300, "é" * 150 + words(8, 30), words(11, 30) + shared[:230]]
    docs = frame(spark, texts).select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tk"), F.coalesce("text", F.lit("")).alias("text"))
    raw = [(t or "").encode() for t in texts]
    places = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            places.setdefault(b[i : i + length], []).append((d, i))
    want = {p for v in places.values() if len(v) > 1 for p in v}
    found = suffixes.repeated_ranges(docs, length, most).collect()
    assert {(r.id, i) for r in found for i in range(r.low, r.high + 1)} == want
    if most == 1:
        return
    for r in suffixes.remove_repeated_strings(frame(spark, texts)).collect():
        gone = np.zeros(len(raw[r.doc_id]), bool)
        for d, i in want:
            if d == r.doc_id:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(raw[r.doc_id], gone) if not g)
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == (len(gone), int(gone.sum()), kept)
        assert r.n_spans == int(np.diff(np.append(0, gone.astype(int))).clip(0).sum())


def test_toxicity_is_learned_from_documents(spark):
    texts = [". ".join(words(100 * i + k, 8) for k in range(6)) + (". you scumbag" + "abc"[i % 3] + " go" if i % 4 == 0 else "") for i in range(400)]
    docs = frame(spark, texts)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert sum(found[i].predicted == int(i % 4 == 0) for i in range(400)) >= 396
    assert "scumbag" in texts[0][found[0].worst_start : found[0].worst_end]
    odd = {r.doc_id: r.score for r in toxicity.score_documents(frame(spark, ODD), model).collect()}
    assert odd[0] == odd[1] == odd[2] == 0.0 and odd[9] < 0.3
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert toxicity.drop_toxic(docs, none).count() == 400 and toxicity.drop_toxic(docs, model).columns == docs.columns


def test_languages(spark):
    docs = spark.createDataFrame(
        [(i, t, l) for i in range(40) for t, l in ((words(i, 50), "xx"), (words(i, 50).upper().replace("A", "ö").replace("B", "ß"), "yy"))], "doc_id long, text string, lang string"
    )
    names, chances = languages.train(docs)
    assert names == ["xx", "yy"]
    pages = spark.createDataFrame(
        [(1, "http://h.xx/", f"<html lang='xx'><p>{words(3, 60)}</p>"), (2, "http://h.yy/", "<html lang=yy>" + words(4, 60).upper().replace("A", "ö").replace("B", "ß")),
         (3, None, None), (4, "", ""), (4, "", "")], "page_id long, url string, html string",
    )
    found = sorted((r.page_id, r.lang, round(sum(r.chances), 6)) for r in languages.identify(pages, names, chances).collect())
    assert found[:2] == [(1, "xx", 1.0), (2, "yy", 1.0)] and len(found) == 5


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "pages", "embeddings", "labels"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts, rows = [r.text for r in docs.collect()], docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, queries_stage(function(spark, rows, SMALL))
        assert rows.columns == docs.columns and rows.count() <= before.count()
        if name in ("line_dedup", "source_mixing"):
            assert rows.count() == before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SMALL)
    assert packed.select("doc_id").distinct().count() == rows.count() > 0.8 * len(set(texts)) * 0.8


def queries_stage(df):
    from zonelake.llm.common import stage

    return stage(df, "test")
