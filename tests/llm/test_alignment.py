"""Tokenizer alignment against a plain version over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from zonelake.llm import alignment

PATHS = alignment.default_paths()
ODD = [
    None, "", " ", "one", "The quick brown fox, jumps over it.", "The quick brown fox, jumps over it.", "naïve façade — 你好 世界 😀😀",
    "<|endoftext|> <s> </s>", "a▁b", "tabs\tand\nlines\n\n\n  and   runs", "word " * 3000, "😀" * 3000, "ab\x00c", "e" * 5000,
]


def plain(texts):
    a_coder, b_coder = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_coder.encode_special_tokens = True
    a_bytes, b_bytes = alignment.token_bytes(a_coder), alignment.piece_bytes(b_coder)
    docs, count = [], Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        a = a_coder.encode(raw.decode(), add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(a_bytes[i]) for i in a]).tolist(), np.cumsum([len(b_bytes[i]) for i in b]).tolist()
        groups = defaultdict(lambda: ([], []))
        cuts = sorted(set(ends_a) & set(ends_b))
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, end in zip(ids, ends):
                groups[int(np.searchsorted(cuts, end))][side].append(i)
        groups = [groups[k] for k in sorted(groups)]
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        count.update(links.keys())
        docs.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, d in enumerate(docs):
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if count[p] == most[p[0]])
        out.append((i, n_a, n_b, len(groups), sum(links.values()), best, sum(n * count[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


def made(n):
    rnd = random.Random(5)
    return [" ".join(rnd.choice(["the", "over", "Straße", "naïve", "token,", "xq", "été.", "1234", "über"]) for _ in range(rnd.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [1 << 17, 20, 0])
def test_link_statistics(spark, monkeypatch, frequent):
    texts = ODD + made(60)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, pairs int")
    found = alignment.link_statistics(docs, *PATHS, frequent=frequent)
    assert sorted(tuple(r) for r in found.collect()) == plain(texts)


def test_empty_table_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "one two", 0), (None, "one two", 0), (1, None, 0)], "doc_id long, text string, rid int")
    found = alignment.link_statistics(docs, *PATHS)
    assert sorted((r.doc_id is None, r.n_groups > 0) for r in found.collect()) == [(False, False), (True, True), (True, True)]
    assert found.filter("doc_id is null").distinct().count() == 1
    assert alignment.link_statistics(docs.limit(0), *PATHS).count() == 0


def test_common_ends_and_blocks_of_links():
    rnd = random.Random(6)
    for _ in range(300):
        size = rnd.randrange(1, 60)
        a, b = (np.array(sorted({size, *rnd.sample(range(1, size + 1), rnd.randrange(size))})) for _ in range(2))
        in_a, in_b = alignment.common_ends(a, b)
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[np.flatnonzero(np.frombuffer(in_a, np.uint8))].tolist() == both == b[np.flatnonzero(np.frombuffer(in_b, np.uint8))].tolist()
    ids_a, ids_b = np.array([rnd.randrange(9) for _ in range(400)]), np.array([rnd.randrange(7) for _ in range(400)])
    end_a, end_b, doc = np.array([1, 2, 200, 399, 400]), np.array([3, 4, 150, 398, 400]), np.array([0, 0, 0, 1, 1])
    want = Counter()
    for g in range(5):
        left, right = ids_a[[0, *end_a][g] : end_a[g]], ids_b[[0, *end_b][g] : end_b[g]]
        want.update((int(doc[g]), int(x) << 20 | int(y)) for x in left for y in right)
    for most in (1 << 21, 50, 1):
        rows = [r for block in alignment.link_counts(ids_a, ids_b, end_a, end_b, doc, most) for r in zip(*(x.tolist() for x in block))]
        assert {(d, p): n for d, p, n in rows} == want and len(rows) == len(want)
