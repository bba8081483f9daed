"""Packing of token sequences by non-negative least squares.

Lengths are put in classes.  Combinations of few classes that fill a window exactly are the columns of a least
squares problem whose right side is the histogram of classes; its solution, rounded, says how often each combination
is used.  What the rounding leaves is packed greedily.  All of this works on the histogram, which has the same size
for any number of documents; Spark tokenizes, counts, ranks the pieces within their class and hands out the places.

Documents whose order matters are cut into stretches of that order first.  Each stretch is packed so by itself, one task a
stretch for its strategies, and the sequences follow the order.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import free_name, slices, stage

WINDOW, END_ID = 4096, 2
#: Tokens of a class of lengths, classes of one combination at most, pieces that are ranked together.
GRAIN, DEPTH, RUN_ROWS = 16, 3, 4096
#: Documents that are packed among themselves if their order matters.
STRETCH = 16384
#: Words whose ids a task remembers.
MEMORY = 600_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of whole texts by a tokenizer whose pieces never cross white space, remembered word by word.

    ``tokenizers`` spends most of its time on repeated words, so a word's ids are kept as bytes.  New words of ASCII
    letters, figures and marks go through tiktoken with the same merges: a letter that no lower-cased text has marks the
    end of a word, and its merges with single bytes come first.  All other words go to ``tokenizers`` as they stand,
    because composed letters, case and classes of letters are its own matter.  Texts with special tokens, odd separators
    or letters whose case depends on their neighbours are left to ``tokenizers`` as a whole.
    """

    END = "A"
    SEPARATORS = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str, memory: int = MEMORY):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.plain, self.memory, self.known = Tokenizer.from_file(path), memory, {}
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        # The public byte alphabet of byte-level vocabularies: printable bytes stand for themselves.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
        vocabulary = model["vocab"]
        end = self.END.encode()

        def raw(token: str) -> bytes:
            last = token.endswith("</w>")
            return bytes(letters[c] for c in (token[:-4] if last else token)) + (end if last else b"")

        ranks = {bytes([b]): b for b in range(256)}
        ids = {b: vocabulary[c] for c, b in letters.items()}
        for b in range(256):
            token = bytes([b]) + end
            ranks[token] = 256 + b
        ids.update({256 + b: vocabulary[c + "</w>"] for c, b in letters.items()})
        for n, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            token = raw(left + right)
            ranks.setdefault(token, 512 + n)
            ids[ranks[token]] = vocabulary[left + right]
        self.odd = re.compile("[\u03a3\u0130\u0300-\u036f]")
        self.table = np.zeros(max(ids) + 1, np.uint32)
        for rank, i in ids.items():
            self.table[rank] = i
        used = set(ranks.values())
        self.coder = tiktoken.Encoding("words", pat_str=r"[^A]*A", mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        assert len(used) == len(ranks)
        self.learn([".", ","])

    def learn(self, words: list[str]) -> None:
        """Remember the ids of new words: plain ones go through the coder in one text, with a line break after each."""
        others = [w for w in words if not w.isascii()]
        for word, found in zip(others, self.plain.encode_batch(others, add_special_tokens=False)):
            self.known[word] = np.array(found.ids, "<u4").tobytes()
        words = [w for w in words if w.isascii()]
        low = "\n".join(words) + "\n"
        marked = self.END.join(self.pieces.findall(low)) + self.END
        ranks = self.coder.encode_to_numpy(marked, disallowed_special=())
        ends = np.flatnonzero(ranks == 256 + ord("\n"))
        ids, start = self.table[ranks].tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self.known[word] = ids[4 * start : 4 * end]
            start = end + 1

    def stem(self, word: str) -> str:
        """The word without a last stop or comma that follows a plain letter, and so is a piece of its own."""
        return word[:-1] if word[-1] in ".," and word[-2:-1].isascii() and word[-2:-1].isalpha() else word

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known, new, rows = self.known, {}, []
        if len(known) > self.memory:
            known.clear()
            self.learn([".", ","])
        for t in texts:
            if "<|" in t or not t.isascii() and self.odd.search(t) or any(c in t for c in self.SEPARATORS):
                rows.append((None, None, t))
                continue
            words = t.lower().split() if t.isascii() else [w.lower() if w.isascii() else w for w in t.split()]
            found = list(map(known.get, words))
            gaps = [(i, words[i]) for i, x in enumerate(found) if x is None] if None in found else ()
            for _, w in gaps:
                stem = self.stem(w)
                if stem not in known:
                    new[stem] = None
            rows.append((found, gaps, None))
        if new:
            self.learn(list(new))
        for found, gaps, whole in rows:
            if whole is not None:
                yield np.array(self.plain.encode(whole, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            for i, w in gaps:
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = known[w[:-1]] + known[w[-1]]
                found[i] = ids
            yield b"".join(found)


def word_ids(path: str) -> WordIds:
    """The coder of this Python process, kept for its later tasks."""
    kept = vars(sys).setdefault("_kept_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def cut_documents(
    docs: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, and the columns ``keep`` of their document.
    A null text has only the end id."""
    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *keep)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, collects = word_ids(path), gc.isenabled()
        gc.disable()  # the lists of words hold no cycles, and looking for some takes half of the time
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    row, start, length, crc, tokens = [], [], [], [], []
                    for i, ids in enumerate(coder.texts(part.column("text").to_pylist())):
                        ids += end
                        n = len(ids) // 4
                        for a in range(0, n, window):
                            size = min(window, n - a)
                            row.append(i)
                            start.append(a)
                            length.append(size)
                            crc.append(zlib.crc32(ids[4 * a : 4 * (a + size)]))
                            tokens.append(n)
                    owner = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(owner), *[pa.array(c, pa.int64()) for c in (start, length, crc, tokens)],
                            *[part.column(c).take(owner) for c in keep],
                        ],
                        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *keep],
                    )
        finally:
            if collects:
                gc.enable()

    kind = slim.schema["doc_id"].dataType.simpleString()
    kept = "".join(f", {c} {slim.schema[c].dataType.simpleString()}" for c in keep)
    return slim.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{kept}")


def combinations(size: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to fill ``size`` with at most ``depth`` falling positive whole numbers."""
    out = []

    def grow(left: int, most: int, parts: tuple[int, ...]) -> None:
        if left == 0:
            out.append(parts)
        elif len(parts) < depth:
            for x in range(min(left, most), 0, -1):
                if x * (depth - len(parts)) < left:
                    break
                grow(left - x, x, (*parts, x))

    grow(size, size, ())
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, weights: np.ndarray, steps: int = 600) -> np.ndarray:
    """x >= 0 with small |sqrt(w) (a x - b)|: active set, with the largest gradient entering."""
    root = np.sqrt(weights)
    a, b = a * root[:, None], b * root
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(steps):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-9 * scale:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if len(z) == 0 or z.min() > 0:
                x[:] = 0.0
                x[on] = z
                break
            bad = z <= 0
            now = x[on]
            step = float(np.min(now[bad] / np.maximum(now[bad] - z[bad], 1e-300)))
            x[on] = now + step * (z - now)
            out = on[x[on] <= 1e-12]
            out = out if len(out) else on[bad][:1]
            x[out] = 0.0
            active[out] = False
    return x


def strategies(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(classes, repeats) that give every piece one place.  histogram[c - 1]: pieces of class c."""
    size = len(histogram)
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(parts: tuple[int, ...], times: int) -> None:
        if times > 0:
            plan.append((parts, int(times)))
            np.subtract.at(left, np.array(parts) - 1, int(times))

    present = {int(c) + 1 for c in np.flatnonzero(left)}
    columns = [p for p in combinations(size, depth) if set(p) <= present]
    if columns:
        a = np.zeros((size, len(columns)))
        for j, p in enumerate(columns):
            np.add.at(a[:, j], np.array(p) - 1, 1.0)
        # Long pieces are the hard ones to place: they weigh more.
        found = non_negative_least_squares(a, left.astype(float), np.arange(1, size + 1) / size)
        for j in np.argsort(-found, kind="stable"):
            parts = columns[j]
            most = min(left[c - 1] // parts.count(c) for c in set(parts))
            use(parts, min(int(round(found[j])), int(most)))
    # What is left: the largest class with the largest that still fit, as often as the scarcest of them allows.
    while left.any():
        parts, room, take = [], size, left.copy()
        for c in range(size, 0, -1):
            n = int(min(take[c - 1], room // c))
            if n:
                parts += [c] * n
                room -= c * n
        use(tuple(parts), int(min(left[c - 1] // parts.count(c) for c in set(parts))))
    return plan


def class_ranges(plan: list[tuple[tuple[int, ...], int]], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """(class, lo, hi, per, first, room): the pieces of ranks lo to hi of a class go ``per`` each into sequences from ``first``,
    which hold them and the classes below in their last ``room`` grains."""
    ranges, first = {}, 0
    for parts, times in plan:
        for c in sorted(set(parts), reverse=True):
            ranges.setdefault(c, []).append((parts.count(c), times, first, size - sum(p for p in parts if p >= c)))
        first += times
    rows = []
    for c, uses in ranges.items():
        at = 0
        for per, times, sequence, after in uses:
            rows.append((c, at, at + per * times, per, sequence, after))
            at += per * times
    return rows


def pack(pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH, run_rows: int = RUN_ROWS) -> DataFrame:
    """Give every piece (with ``length`` up to ``window``) its sequence_id and offset.

    ``pieces`` must be staged: it is counted, ranked and joined, and each time has to be the same.
    """
    spark = pieces.sparkSession
    size = window // grain
    kind = F.ceil(F.col("length") / grain).cast("int")
    classed = pieces.withColumn("class", kind)
    histogram = np.zeros(size, np.int64)
    for c, n in classed.groupBy("class").count().collect():  # at most ``size`` rows
        histogram[c - 1] = n
    rows = class_ranges(strategies(histogram, depth), size)
    places = spark.createDataFrame(rows, "class int, lo long, hi long, per long, first long, room long")
    # Rank within the class in runs of a hash, so that a class of any size is spread.
    runs = max(1, -(-int(histogram.max(initial=0)) // run_rows))
    mark = F.xxhash64("doc_id", "start", "length", "ids_crc32")
    classed = classed.withColumn("mark", mark).withColumn("run", F.pmod(F.col("mark"), F.lit(runs)).cast("int"))
    sizes = classed.groupBy("class", "run").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("class").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("class", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("low"))
    order = W.partitionBy("class", "run").orderBy("mark", "doc_id", "start", "doc_tokens")
    ranked = classed.withColumn("rank", F.row_number().over(order) - 1).join(starts, ["class", "run"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("low")).drop("low", "run")
    # As many rows as strategies have classes: bounded by the number of combinations, whatever the number of pieces.
    p = F.broadcast(places.withColumnRenamed("class", "c"))
    placed = ranked.join(p, (F.col("class") == F.col("c")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    at = F.col("rank") - F.col("lo")
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor(at / F.col("per")))
    inside = W.partitionBy("sequence_id").orderBy(F.col("class").desc(), "rank").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack_in_order(pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH, stretch: int = STRETCH) -> DataFrame:
    """As :func:`pack`, along the order of ``at``, the place of a piece's document among all documents, from 0.

    The documents of places k * stretch to (k + 1) * stretch share no sequence with others, and their sequences come after
    those of all documents before.  Inside a stretch sequences are in the order of their earliest document, and of one
    class earlier documents come first.  Sequences are numbered from 0 without gaps.
    """
    spark = pieces.sparkSession
    size = window // grain
    classed = pieces.withColumns({"class": F.ceil(F.col("length") / grain).cast("int"), "stretch": F.floor(F.col("at") / stretch)})
    counts = classed.groupBy("stretch", "class").agg(F.count(F.lit(1)).alias("n"))
    # Few rows, but each takes a task about a second: they stay spread.
    spread = counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "stretch")
    counts = spread.groupBy("stretch").agg(F.collect_list("class").alias("classes"), F.collect_list("n").alias("ns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["class", "lo", "hi", "per", "first", "room"]
        for batch in batches:
            for k, classes, ns in zip(*(batch.column(c).to_pylist() for c in ("stretch", "classes", "ns"))):
                histogram = np.zeros(size, np.int64)
                histogram[np.array(classes) - 1] = ns
                found = np.array(class_ranges(strategies(histogram, depth), size), np.int64)
                columns = [pa.array(np.full(len(found), k)), pa.array(found[:, 0].astype(np.int32)), *map(pa.array, found[:, 1:].T.copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["stretch", *names])

    places = counts.mapInArrow(run, "stretch long, class int, lo long, hi long, per long, first long, room long")
    places = stage(places, "places")
    ends = places.groupBy("stretch").agg(F.max(F.col("first") + (F.col("hi") - F.col("lo")) / F.col("per")).cast("long").alias("n"))
    before = W.orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)  # a row a stretch
    bases = ends.select("stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = classed.withColumn("rank", F.row_number().over(W.partitionBy("stretch", "class").orderBy("at", "start")) - 1)
    placed = ranked.join(places, ["stretch", "class"]).filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    placed = placed.withColumn("sequence", F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
    whole = W.partitionBy("stretch", "sequence")
    inside = whole.orderBy(F.col("class").desc(), "rank").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumns({"offset": F.coalesce(F.sum("length").over(inside), F.lit(0)), "head": F.min("at").over(whole)})
    nth = F.dense_rank().over(W.partitionBy("stretch").orderBy("head", "sequence")) - 1
    placed = placed.withColumn("nth", nth).join(bases, "stretch").withColumn("sequence_id", F.col("base") + F.col("nth"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack_documents_in_order(docs: DataFrame, path: str | None = None, window: int = WINDOW, stretch: int = STRETCH) -> DataFrame:
    """As :func:`pack_documents`, with sequences that follow the documents: those of the first ``stretch`` documents come
    first, and so on (see :func:`pack_in_order`).

    Documents read from files are in the order of the files' names, as Spark numbers them, and of the rows in each file;
    those of any other frame in the order of its partitions and their rows.
    """
    part, row = free_name(docs, "part"), free_name(docs, "row")
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(part), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        place = F.monotonically_increasing_id()
        placed = docs.withColumn(row, place).withColumn(part, F.lpad(F.shiftright(row, 33).cast("string"), 10, "0"))
        placed = placed.withColumn(row, F.col(row).bitwiseAND((1 << 33) - 1))
    pieces = stage(cut_documents(placed, path or vocabulary_path(), window, keep=(part, row)), "pieces")
    sizes = pieces.groupBy(F.col(part).alias("p")).agg((F.max(row) + 1).alias("n"))
    # A row a file.  A longer number comes later.
    before = W.orderBy(F.length("p"), "p").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("low"))
    pieces = pieces.join(starts, F.col(part) == F.col("p")).withColumn("at", F.col("low") + F.col(row))
    return pack_in_order(pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at"), window, stretch=stretch)


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """All pieces of all documents with their places.  Null and empty texts are one piece of the end id alone; rows
    that repeat an id are packed each; an empty table gives no rows."""
    return pack(stage(cut_documents(docs, path or vocabulary_path(), window), "pieces"), window)
