"""Ids of whole texts by public tokenizers, remembered word by word.

The tokenizers of ``tokenizers`` and ``sentencepiece`` spend most of their time on words that they have seen before.
A text is cut at every single space between two other characters.  Neither vocabulary has a piece that reaches over
such a place, so the ids of a text are the ids of its parts one after the other; every part comes from the tokenizer
itself.  ``PieceIds`` checks this property of its vocabulary when it is opened.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator

import numpy as np

#: Parts that a task remembers, and characters of the longest of them.
MEMORY, LONGEST = 500_000, 64
#: A space between two characters that aren't white space; a line break likewise.  Python's white space holds all that
#: the tokenizers take as white space.
PLAIN = re.compile(r"\n?[A-Za-z]+")
SPACE, BREAK = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"(?<=\S)\n(?=\S)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_bytes(plain) -> list[bytes]:
    """The bytes of every token of a byte-level vocabulary; none for special tokens."""
    # The public byte alphabet of such vocabularies: printable bytes stand for themselves, the others follow from 256.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    special = plain.get_added_tokens_decoder()
    raw = [b""] * plain.get_vocab_size()
    for token, i in plain.get_vocab().items():
        if i not in special:
            raw[i] = bytes(letters[c] for c in token)
    return raw


def packed(ids) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return np.asarray(ids, "<u4").tobytes()


class Remembered:
    """Looks up the parts of texts and has the new ones learned together."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.known = memory, {}

    def parts(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, parts: list[str]) -> None:
        raise NotImplementedError

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of each text."""
        known = self.known
        if len(known) > self.memory:
            known.clear()
        rows, new = [], {}
        for text in texts:
            parts = self.parts(text)
            found = list(map(known.get, parts))
            gaps = [i for i, ids in enumerate(found) if ids is None] if None in found else ()
            for i in gaps:
                new[parts[i]] = None
            rows.append((parts, found, gaps))
        if new:
            self.learn(list(new))
        long = [part for part in new if len(part) > LONGEST]
        for parts, found, gaps in rows:
            for i in gaps:
                found[i] = known[parts[i]]
            yield b"".join(found)
        for part in long:
            del known[part]


class ByteIds(Remembered):
    """A byte-level vocabulary whose pieces begin with at most one space.

    ``lead`` puts a space in front of every text; ``special`` takes the strings of special tokens as such.  A part's
    first character says what it is: a line break marks a word without a space in front, a tab a string as it stands;
    all others have a space in front.
    """

    def __init__(self, path: str, lead: bool, special: bool, memory: int = MEMORY):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__(memory)
        self.lead, self.plain = lead, Tokenizer.from_file(path)
        self.plain.encode_special_tokens = not special
        self.line = self.plain.encode("\n", add_special_tokens=False).ids
        assert len(self.line) == 1
        ranks = {raw: i for i, raw in enumerate(token_bytes(self.plain)) if raw}
        # Plain letters are letters by any table, so that the same merges split them alike, three times as fast.
        self.quick = tiktoken.Encoding("plain", pat_str=r" ?[A-Za-z]+|\n", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")

    def parts(self, text: str) -> list[str]:
        words = text.split()
        if " ".join(words) == text:
            if words and not self.lead:
                words[0] = "\n" + words[0]
            return words
        parts: list[str] = []
        for n, line in enumerate(text.split("\n")):
            words = line.split()
            if not words or " ".join(words) != line:
                return self.odd_parts(text)
            if n:
                parts.append("\t\n")
            if n or not self.lead:
                words[0] = "\n" + words[0]
            parts += words
        return parts

    def odd_parts(self, text: str) -> list[str]:
        """Parts of a text with other white space or with more of it in one place."""
        parts: list[str] = []
        for n, run in enumerate(SPACE.split(text)):
            spaced = self.lead or n > 0
            for m, line in enumerate(BREAK.split(run)):
                if m:
                    parts.append("\t\n")
                if line.split() != [line]:
                    parts.append("\t" + (" " + line if spaced and not m else line))
                else:
                    parts.append(line if spaced and not m else "\n" + line)
        return parts

    def learn(self, parts: list[str]) -> None:
        together, quick, stems = {}, {}, []
        for part in parts:
            if PLAIN.fullmatch(part):
                quick[part] = None
            elif part[0] == "\t":
                self.known[part] = self.encode(part[1:]).tobytes()
            elif "<|" in part or len(part) > LONGEST:
                self.known[part] = self.encode(part[1:] if part[0] == "\n" else " " + part).tobytes()
            elif part[-1] in ".," and part[-2:-1].isascii() and part[-2:-1].isalpha():
                stems.append(part)  # a stop behind a plain letter is a piece of its own
                stem = part[:-1]
                if stem not in self.known:
                    (quick if PLAIN.fullmatch(stem) else together)[stem] = None
            else:
                together[part] = None
        self.learn_lines([*together, "\n.", "\n,"], self.encode)
        self.learn_lines(list(quick), lambda text: self.quick.encode_to_numpy(text, disallowed_special=()))
        for part in stems:
            self.known[part] = self.known[part[:-1]] + self.known["\n" + part[-1]]


    def learn_lines(self, words: list[str], encode) -> None:
        """One text for all, with a line break behind each: a line break between others is a piece of its own."""
        ids = encode("".join([w[1:] + "\n" if w[0] == "\n" else f" {w}\n" for w in words])).astype("<u4")
        ends = np.flatnonzero(ids == self.line[0])
        assert len(ends) == len(words)
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, (4 * ends).tolist()):
            self.known[word] = raw[start:end]
            start = end + 4


class PieceIds(Remembered):
    """A sentencepiece vocabulary that puts a space in front of every text and of every part."""

    def __init__(self, path: str, memory: int = MEMORY):
        import sentencepiece

        super().__init__(memory)
        self.plain = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.plain.id_to_piece(i) for i in range(self.plain.get_piece_size()))
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("pieces of this vocabulary reach over spaces")

    def parts(self, text: str) -> list[str]:
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return SPACE.split(text)
        return text.split(" ") if text else []

    def learn(self, parts: list[str]) -> None:
        for part, ids in zip(parts, self.plain.encode(parts, num_threads=1)):
            self.known[part] = packed(ids)


def kept(kind: type, *args):
    """The coder of this Python process, kept for its later tasks."""
    store = vars(sys).setdefault("_kept_coders", {})
    key = (kind.__name__, args)
    if key not in store:
        store[key] = kind(*args)
    return store[key]
