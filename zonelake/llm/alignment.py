"""Alignment of two tokenizers by skipping along diagonals.

Both tokenizers cut the same bytes.  Their end offsets are compared at the current shift between the indexes: as long
as they are equal the tokens correspond one to one, and probes of doubling length jump over such a stretch.  Where they
differ, a merge of the two lists finds the next common end, the tokens in between are one irregular group, and the shift
changes by its difference in length.

Counts of id pairs over the corpus are joined back in two ways, both for every table: the most frequent pairs, at most
``FREQUENT``, as a broadcast table, and all others, none of which is in many documents, by a shuffle.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import slices, stage
from zonelake.llm.vocabularies import ByteIds, PieceIds, kept, public_path, token_bytes

#: Pairs in the broadcast table (a few MB), links worked on at once, texts worked on at once in bytes.
FREQUENT, LINKS, TEXT = 1 << 17, 1 << 21, 1 << 20


def piece_bytes(plain) -> list[bytes]:
    """The bytes of every sentencepiece token; none for control and unknown ones."""
    out = []
    for i in range(plain.get_piece_size()):
        piece = plain.id_to_piece(i)
        if plain.is_byte(i):
            out.append(bytes([int(piece[3:-1], 16)]))
        elif plain.is_control(i) or plain.is_unknown(i):
            out.append(b"")
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[bytearray, bytearray]:
    """Marks of the tokens at whose ends both sides end.  a, b: rising ends, the last ones equal."""
    in_a, in_b = bytearray(len(a)), bytearray(len(b))
    raw_a, raw_b, list_a, list_b = a.astype(np.int64).tobytes(), b.astype(np.int64).tobytes(), a.tolist(), b.tolist()
    n, m, i, j = len(a), len(b), 0, 0
    while i < n:
        if list_a[i] == list_b[j]:
            # Probes of doubling length at this shift, then of halving length up to the first difference.
            k, step = 1, 1
            while i + k + step <= n and j + k + step <= m and raw_a[8 * (i + k) : 8 * (i + k + step)] == raw_b[8 * (j + k) : 8 * (j + k + step)]:
                k += step
                step *= 2
            while step > 1:
                step //= 2
                if i + k + step <= n and j + k + step <= m and raw_a[8 * (i + k) : 8 * (i + k + step)] == raw_b[8 * (j + k) : 8 * (j + k + step)]:
                    k += step
            in_a[i : i + k] = in_b[j : j + k] = b"\1" * k
            i, j = i + k, j + k
            continue
        x, y = list_a[i], list_b[j]
        while x != y:
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
        in_a[i] = in_b[j] = 1
        i, j = i + 1, j + 1
    return in_a, in_b


class Aligner:
    """Both coders and their token tables."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteIds(path_a, True, False), PieceIds(path_b)
        self.bytes_a, self.bytes_b = token_bytes(self.a.plain), piece_bytes(self.b.plain)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Ids in decimal with what follows them: a comma, or the end of a side.
        self.names = [f"{i}," for i in range(len(self.bytes_a))] + [f"{i}|" for i in range(len(self.bytes_a))]
        self.names += [f"{i}," for i in range(len(self.bytes_b))] + [f"{i};" for i in range(len(self.bytes_b))]

    def ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none if the bytes of either differ from those of a space and the text."""
        none = np.zeros(0, np.int64)
        for text, a, b in zip(texts, self.a.texts(texts), self.b.texts(texts)):
            if not text:
                yield none, none
                continue
            a, b = np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<u4").astype(np.int64)
            raw = b" " + text.encode()
            same = all(
                b"".join(map(table.__getitem__, ids.tolist())) == raw for table, ids in ((self.bytes_a, a), (self.bytes_b, b))
            )
            yield (a, b) if same else (none, none)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index after the last token of each group, on both sides."""
        in_a, in_b = common_ends(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))
        return np.flatnonzero(np.frombuffer(in_a, np.uint8)) + 1, np.flatnonzero(np.frombuffer(in_b, np.uint8)) + 1

    def write(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        vocab, sizes = len(self.bytes_a), (np.diff(end_a, prepend=0), np.diff(end_b, prepend=0))
        which = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[end_a - 1], last_b[end_b - 1] = vocab, len(self.bytes_b)
        which[np.arange(len(a)) + np.repeat(end_b - sizes[1], sizes[0])] = a + last_a
        which[np.arange(len(b)) + np.repeat(end_a, sizes[1])] = b + last_b + 2 * vocab
        return "".join(map(self.names.__getitem__, which.tolist()))[:-1]


def entries(ids: np.ndarray, ends: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, weights, number per group): tokens by group, equal ids of a large group joined into one."""
    sizes = np.diff(ends, prepend=0)
    if not len(large):
        return ids, np.ones(len(ids), np.int64), sizes
    out_ids, out_weights, sizes, at = [], [], sizes.copy(), 0
    for g in large.tolist():
        start, end = int(ends[g] - sizes[g]), int(ends[g])
        found, times = np.unique(ids[start:end], return_counts=True)
        out_ids += [ids[at:start], found]
        out_weights += [np.ones(start - at, np.int64), times]
        sizes[g], at = len(found), end
    return np.concatenate([*out_ids, ids[at:]]), np.concatenate([*out_weights, np.ones(len(ids) - at, np.int64)]), sizes


def link_counts(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, group_doc: np.ndarray, most: int = LINKS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, pair, links) of all linked id pairs, each pair of a document once.  group_doc rises.

    Links are built ``most`` at a time: where there are more, in order of document and A id.
    """
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    large = np.flatnonzero(size_a * size_b > 4096)
    a, weight_a, size_a = entries(a, end_a, large)
    b, weight_b, size_b = entries(b, end_b, large)
    group = np.repeat(np.arange(len(size_a)), size_a)
    first_b = np.cumsum(size_b) - size_b
    fan = size_b[group]
    blocks = [np.arange(len(a))]
    if int(fan.sum()) > most:
        doc = group_doc[group]
        order = np.lexsort((a, doc))
        new = np.flatnonzero(np.diff(doc[order]) | np.diff(a[order])) + 1  # cuts only between documents or A ids
        total, cuts, done = np.cumsum(fan[order]), [0], 0
        for at, end in zip(new.tolist(), [*new[1:].tolist(), len(order)]):
            if total[end - 1] - done > most:
                cuts.append(at)
                done = int(total[at - 1])
        blocks = [order[x:y] for x, y in zip(cuts, [*cuts[1:], len(order)])]
    for block in blocks:
        times = fan[block]
        at = np.repeat(np.arange(len(block)), times)
        inside = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        mine = block[at]
        other = first_b[group[mine]] + inside
        key = (group_doc[group[mine]] << 40) | (a[mine] << 20) | b[other]
        weight = weight_a[mine] * weight_b[other]
        found, place = np.unique(key, return_inverse=True)
        links = np.bincount(place, weights=weight, minlength=len(found)).astype(np.int64) if len(large) else np.bincount(place, minlength=len(found))
        yield found >> 40, found & ((1 << 40) - 1), links


def aligned_rows(aligner: Aligner, part: pa.RecordBatch, whole: bool) -> Iterator[pa.RecordBatch]:
    """A row for each document, and further rows with pairs only where there are many."""
    texts = part.column("text").to_pylist()
    rows, all_a, all_b, ends_a, ends_b, sizes = [], [], [], [], [], []
    at_a = at_b = 0
    for a, b in aligner.ids([t or "" for t in texts]):
        if not len(a):
            rows.append((0, 0, 0, 0, ""))
            sizes.append(0)
            continue
        end_a, end_b = aligner.groups(a, b)
        text = aligner.write(a, b, end_a, end_b)
        links = int(np.diff(end_a, prepend=0) @ np.diff(end_b, prepend=0))
        rows.append((len(a), len(b), len(end_a), links, text if whole else hashlib.sha256(text.encode()).hexdigest()))
        all_a.append(a)
        all_b.append(b)
        ends_a.append(end_a + at_a)
        ends_b.append(end_b + at_b)
        at_a, at_b = at_a + len(a), at_b + len(b)
        sizes.append(len(end_a))
    pairs, links, starts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows) + 1, np.int64)
    blocks: Iterator = iter(())
    if all_a:
        doc = np.repeat(np.arange(len(rows)), sizes)
        blocks = link_counts(*map(np.concatenate, (all_a, all_b, ends_a, ends_b)), doc)
        docs, pairs, links = next(blocks)
        starts = np.searchsorted(docs, np.arange(len(rows) + 1))

    def frame(columns: list, pairs: np.ndarray, links: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x)) for x in (pairs, links)]
        names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]
        return pa.RecordBatch.from_arrays([*columns, *lists], names=names)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    facts = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
    yield frame([part.column("rid"), part.column("doc_id"), *facts], pairs, links, starts)
    for docs, pairs, links in blocks:
        found, starts = np.unique(docs, return_index=True)
        rid = part.column("rid").take(pa.array(found))
        empty = [pa.nulls(len(found), t) for t in (part.schema.field("doc_id").type, *kinds)]
        yield frame([rid, *empty], pairs, links, np.append(starts, len(docs)))


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Each document's groups and its linked id pairs; the result must be staged before it is used twice.

    ``groups`` is the written form of all groups, or its SHA-256 unless ``whole``.  ``pairs`` holds A id * 2^20 + B id,
    ``links`` how often the pair is linked.  Rows with a null n_a hold further pairs of the same ``rid``.
    """
    slim = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, collects = kept(Aligner, path_a, path_b), gc.isenabled()
        gc.disable()  # nothing here holds cycles
        try:
            for batch in batches:
                for part in slices(batch, "text", TEXT):
                    yield from aligned_rows(aligner, part, whole)
        finally:
            if collects:
                gc.enable()

    kind = slim.schema["doc_id"].dataType.simpleString()
    numbers = "n_a long, n_b long, n_groups long, n_links long"
    return slim.mapInArrow(run, f"rid long, doc_id {kind}, {numbers}, groups string, pairs array<long>, links array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each id pair is linked, and whether no pair of its A id has more."""
    counts = stage(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    a = F.shiftright("pair", 20)
    # One row for each id of vocabulary A at most.
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_statistics(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    Texts that are null, empty or not restored by the tokens of either side have zeros and an empty digest.  Rows that
    repeat an id count as documents of their own; null ids stay null; an empty table gives no rows.
    """
    rows = stage(aligned(docs, path_a, path_b, key, text), "aligned")
    counts = stage(pair_counts(rows), "counts")
    powers = {p: n for p, n in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()}  # 64 rows at most
    least, taken = 64, 0
    for p in sorted(powers, reverse=True):
        if taken + powers[p] > frequent:
            break
        least, taken = p, taken + powers[p]
    often = F.floor(F.log2("n")) >= least
    links = rows.select("rid", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("rid", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    # At most ``frequent`` rows by the choice of ``least``.
    top, rest = F.broadcast(counts.filter(often)), counts.filter(~often)
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")]
    common = links.join(top, "pair").groupBy("rid").agg(*sums)
    rare = links.join(F.broadcast(top.select("pair")), "pair", "left_anti").join(rest, "pair").groupBy("rid").agg(*sums)
    both = common.unionByName(rare).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    found = rows.filter("n_a is not null").select("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", F.col("groups").alias("groups_sha256"))
    return found.join(both, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def default_paths() -> tuple[str, str]:
    return public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model")
