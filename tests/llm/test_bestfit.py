"""Best-fit packing: exact cover of the ids, places without gaps, bounds that hold."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from zonelake.llm import bestfit
from zonelake.llm.vocabularies import packed, public_path

ODD = [None, "", " \n", "one", "one", "x <|endoftext|> y", "word " * 5000, "क़, ਲ਼. naïve " * 300, "z" * 4000]


def check(rows, ids_of, window):
    pieces, sequences = {}, {}
    for r in rows:
        assert 1 <= r.length <= window
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids_of)
    for doc, found in pieces.items():
        at, ids = 0, ids_of[doc]
        for k, r in enumerate(sorted(found, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == window)
            assert r.ids_crc32 == zlib.crc32(packed(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(sequences)


def test_documents(spark):
    rnd = random.Random(3)
    texts = ODD + [" ".join(rnd.choice(["alpha", "beta", "naïve", "12"]) for _ in range(rnd.randrange(1, 900))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, deal int")
    coder = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    want = {i: [*coder.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    for part_rows in (8192, 30):
        n = check(bestfit.pack_documents(docs, part_rows=part_rows).collect(), want, 1024)
        lengths = [x for ids in want.values() for x in [1024] * ((len(ids) - 1) // 1024) + [(len(ids) - 1) % 1024 + 1]]
        assert n <= bestfit.lower_bound(np.bincount(lengths, minlength=1025), 1024) * 1.06 + 1


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (1, "one two"), (1, None)], "doc_id long, text string")
    rows = bestfit.pack_documents(docs).collect()
    assert len(rows) == 4 and len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows)[0] == 0
    assert bestfit.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("window", [10, 12])
def test_bounds_never_exceed_the_best_packing(window):
    def least(lengths, rooms=()):
        if not lengths:
            return len(rooms)
        x, rest = lengths[0], lengths[1:]
        found = least(rest, (*rooms, window - x))
        for r in set(rooms):
            if r >= x:
                i = rooms.index(r)
                found = min(found, least(rest, (*rooms[:i], r - x, *rooms[i + 1 :])))
        return found

    rnd, sharp = random.Random(window), 0
    for _ in range(150):
        lengths = sorted((rnd.randrange(1, window + 1) for _ in range(rnd.randrange(1, 8))), reverse=True)
        bound, best = bestfit.lower_bound(np.bincount(lengths, minlength=window + 1), window), least(tuple(lengths))
        bins, offsets, room = bestfit.best_fit_decreasing(np.array(lengths), window)
        assert -(-sum(lengths) // window) <= bound <= best <= len(room)
        sharp += bound > -(-sum(lengths) // window)
    assert sharp > 5


def test_rounds_close_gaps(spark):
    """Parts of few pieces waste room each; handing over and dealing anew wins it back."""
    rnd = random.Random(8)
    lengths = [rnd.randrange(1, 64) for _ in range(4000)]
    pieces = spark.createDataFrame([(i, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, length long, rid long")
    bound = bestfit.lower_bound(np.bincount(lengths, minlength=65), 64)
    for part_rows, slack in ((60, 1.06), (1000, 1.01)):
        once, more = (bestfit.pack(pieces, 64, part_rows, rounds).select("sequence_id").distinct().count() for rounds in (1, 4))
        assert bound <= more < once and more <= bound * slack
