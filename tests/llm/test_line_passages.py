"""Repeated passages of lines go from end to end, however short they are and wherever the cuts fall."""

import random

import pytest

from test_llm import frame, words
from zonelake.llm import chunks


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6])
def test_no_repeated_passage_is_left(spark, size):
    texts, want = [], []
    for k in range(12):
        seed = 1000 * size + 100 * k
        passage = [words(seed + i, 51 if size == 1 else 26) for i in range(size)]
        own = [[words(seed + 50 + 10 * n + i, 9) for i in range(4)] for n in range(2)]
        texts += ["\n".join([*own[0][:2], *passage, *own[0][2:]]), "\n".join([own[1][0], *passage, *own[1][1:]])]
        want += [texts[-2], "\n".join(own[1])]
    found = {r.doc_id: r for r in chunks.remove_repeats(frame(spark, texts)).collect()}
    assert [found[i].text for i in range(len(texts))] == want
    assert all(found[i].removed_lines == size and found[i].removed_chunks == 1 for i in range(1, len(texts), 2))


def test_short_single_lines_stay_and_every_line_stays_once(spark):
    rnd = random.Random(8)
    pool = [words(k, 12) for k in range(15)]
    texts = ["\n".join(rnd.choices(pool, k=rnd.randrange(1, 9))) for _ in range(40)] + [pool[0]]
    found = [r.text for r in chunks.remove_repeats(frame(spark, texts)).orderBy("doc_id").collect()]
    assert found[-1] == pool[0]
    assert {x for t in found for x in t.split("\n") if x} == {x for t in texts for x in t.split("\n")}


def test_blank_lines_go_with_the_passage(spark):
    a, b = words(70, 30), words(71, 30)
    texts = [f"x\n\n{a}\n\n{b}\n\ny", f"z\n\n{a}\n\n{b}\n\nv", "q\n\nshort\n\nw", "r\n\nshort\n\nu"]
    found = [r.text for r in chunks.remove_repeats(frame(spark, texts)).orderBy("doc_id").collect()]
    assert found == [texts[0], "z\nv", texts[2], texts[3]]
