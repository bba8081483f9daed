"""Ids of texts, word by word, against the tokenizers on whole texts."""

import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from zonelake.llm import vocabularies

BYTES, PIECES = vocabularies.public_path("byte_bpe_50k.json"), vocabularies.public_path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a\n\n\nb c", "it's. we'll, x.y,", "<|endoftext|>", "a <|endoftext|> b",
    "x<|endoftext|>y.", "é é", "क़, ਲ਼. b", "ﬁ fi", "a\x1cb \x85 c\xa0d", "😀‍ 😀,", "x" * 500, "ab " * 4000, "1,000.5", "\t\t if x:\n\t\t\treturn",
]


def texts():
    rnd = random.Random(4)
    common = list("abcdefgh.,'s \n\t  1é́कﬁ　\x1c\x85\xa0😀‍א")
    out = list(ODD)
    for _ in range(3000):
        rare = [chr(rnd.randrange(1, 0x2FFF)) for _ in range(3)]
        out.append("".join(rnd.choice(common if rnd.random() < 0.85 else rare) for _ in range(rnd.randrange(30))))
    letters = "etaoinshrdlucmfwypvbgkjqxzETAOINS"
    out += [" ".join("".join(rnd.choices(letters, k=rnd.randrange(1, 14))) for _ in range(200)) for _ in range(100)]
    return out


@pytest.mark.parametrize("lead, special", [(False, True), (True, False)])
def test_byte_ids(lead, special):
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = not special
    coder = vocabularies.ByteIds(BYTES, lead, special, 2000)
    for _ in range(2):
        for start in range(0, len(texts()), 400):
            part = [t for t in texts()[start : start + 400] if t]
            for text, ids in zip(part, coder.texts(part)):
                assert ids == vocabularies.packed(plain.encode(" " * lead + text, add_special_tokens=False).ids), ascii(text)


def test_piece_ids():
    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coder = vocabularies.PieceIds(PIECES)
    for text, ids in zip(texts(), coder.texts(texts())):
        assert ids == vocabularies.packed(plain.encode(text)), ascii(text)
