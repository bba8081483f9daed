"""Ids of the packing operator against ``tokenizers`` over all kinds of letters."""

import random
import sys
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from zonelake.llm import packing

PLAIN = Tokenizer.from_file(packing.vocabulary_path())


def same(coder, texts):
    for text, ids in zip(texts, coder.texts(texts)):
        assert ids == np.array(PLAIN.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), ascii(text)


def test_letters_that_decompose():
    same(packing.WordIds(packing.vocabulary_path()), ["क़,", "a ਲ਼. b", "אַ,", "É. é, É", "İ. ı, ſ. ß, ẞ. K, Å."])


def test_every_letter_with_stops_behind_it():
    coder = packing.WordIds(packing.vocabulary_path())
    letters = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LMN"]
    rare = letters[:20_000] + random.Random(1).sample(letters[20_000:], 5000)
    same(coder, [f"{c}. {c}, a{c}. {c}{c}b," for c in rare])


def test_random_texts():
    rnd, coder = random.Random(2), packing.WordIds(packing.vocabulary_path(), 5000)
    letters = list("abcABC.,'s 12\n\t क़ਲ਼éßǅΣσ\xa0\x85 \x1c<|😀")
    texts = ["".join(rnd.choice(letters) if rnd.random() < 0.9 else chr(rnd.randrange(1, 0x3000)) for _ in range(rnd.randrange(40))) for _ in range(20_000)]
    for start in range(0, len(texts), 500):
        same(coder, texts[start : start + 500])
