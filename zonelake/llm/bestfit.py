"""Best-fit packing whose bin counts are certified by dual feasible functions.

Documents are cut into pieces of at most one window.  Full pieces are sequences of their own; all others are dealt into
parts of bounded size, and every part is packed by best-fit decreasing.  A dual feasible function maps lengths so that
no sequence can hold more than 1 of the mapped sizes; the sum over a part is therefore a lower bound of its number of
sequences.  A part that needs as many as its best bound is certified.  A part with a gap hands
its documents to the next round; a certified part hands over its emptiest sequence, because what is rounded up in each
part may be saved over all.  What was handed over is dealt anew into larger parts, up to a fixed size, so that documents
change their partners, and packed and certified again; a round that saves nothing is not taken.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import slices, stage
from zonelake.llm.vocabularies import ByteIds, kept, packed, public_path

WINDOW, END_ID = 1024, 2
#: Pieces of a part in the first round, how much larger it is in each next one, rounds at most (so a part never has more
#: than about half a million pieces, narrow rows all), and functions of the first family.
PART_ROWS, GROWTH, ROUNDS, FAMILY = 8192, 4, 4, 24


def cut_documents(docs: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a row number ``rid`` of all pieces of all documents.

    Longer documents are cut into full windows; the first piece takes what is left over.
    """
    slim = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    end = packed([END_ID])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, collects = kept(ByteIds, path, False, True), gc.isenabled()
        gc.disable()  # lists of words hold no cycles, and looking for some takes a third of the time
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    row, piece, start, length, crc = [], [], [], [], []
                    for i, ids in enumerate(coder.texts(part.column("text").to_pylist())):
                        ids += end
                        n = len(ids) // 4
                        a, k = 0, 0
                        while a < n:
                            size = (n - 1) % window + 1 if k == 0 else window
                            row.append(i)
                            piece.append(k)
                            start.append(a)
                            length.append(size)
                            crc.append(zlib.crc32(ids[4 * a : 4 * (a + size)]))
                            a, k = a + size, k + 1
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                         *[pa.array(c, pa.int64()) for c in (start, length, crc)]],
                        names=["doc_id", "piece", "start", "length", "ids_crc32"],
                    )
        finally:
            if collects:
                gc.enable()

    kind = slim.schema["doc_id"].dataType.simpleString()
    cut = slim.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("rid", F.monotonically_increasing_id())


def lower_bound(histogram: np.ndarray, window: int, family: int = FAMILY) -> int:
    """A number of sequences that no packing can undercut.  histogram[x]: pieces of length x, up to the window.

    Two families: the rounding functions ``floor((k + 1) x) / k``, and those that count what is nearly a window as a
    whole one and leave out what may stand beside it.  All sums are in whole numbers.
    """
    x, n = np.arange(window + 1, dtype=np.int64), histogram.astype(np.int64)
    best = -(-int(n @ x) // window)
    for k in range(1, family + 1):
        whole = (k + 1) * x % window == 0
        mapped = np.where(whole, x * k, (k + 1) * x // window * window)
        best = max(best, -(-int(n @ mapped) // (k * window)))
    for least in range(1, window // 2 + 1):
        large = int(n[window - least + 1 :].sum())
        between = int(n[least : window - least + 1] @ x[least : window - least + 1])
        best = max(best, large - (-between // window))
    return best


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each of the falling lengths, and the room that each sequence has left."""
    bins, offsets, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0  # bit r: a sequence with room r is open
    for i, x in enumerate(lengths.tolist()):
        fitting = rooms >> x
        if fitting:
            r = x + (fitting & -fitting).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                rooms ^= 1 << r
        else:
            r, b = window, len(room)
            room.append(window)
        bins[i], offsets[i] = b, window - r
        room[b] = r - x
        if r > x:
            open_bins[r - x].append(b)
            rooms |= 1 << (r - x)
    return bins, offsets, np.array(room, np.int64)


def pack_part(part: pa.Table, window: int, last: bool) -> pa.Table:
    """The rows of a part with their places; ``stays`` tells which keep them."""
    part = part.sort_by([("length", "descending"), ("rid", "ascending")])
    lengths, rid = part.column("length").to_numpy(), part.column("rid").to_numpy()
    bins, offsets, room = best_fit_decreasing(lengths, window)
    bound = lower_bound(np.bincount(lengths, minlength=window + 1), window)
    first = np.empty(len(room), np.int64)
    first[bins[::-1]] = rid[::-1]  # a sequence is named by its first piece, which is in no other
    if last:
        stays = np.ones(len(room), bool)
    elif len(room) > bound:
        stays = np.zeros(len(room), bool)
    else:
        stays = np.arange(len(room)) != np.argmax(room)
        stays |= room == 0
    out = part.append_column("sequence_id", pa.array(first[bins])).append_column("offset", pa.array(offsets))
    for name, value in (("part_sequences", len(room)), ("part_bound", bound)):
        out = out.append_column(name, pa.array(np.full(len(bins), value, np.int64)))
    return out.append_column("stays", pa.array(stays[bins])).drop_columns(["deal"])


def part_packer(window: int, last: bool):
    return lambda part: pack_part(part, window, last)


def pack(pieces: DataFrame, window: int = WINDOW, part_rows: int = PART_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Give every piece (``length`` from 1 up to ``window``, unique ``rid``) its sequence_id and offset.

    ``pieces`` must be staged.  part_sequences and part_bound are the sequences and the lower bound of the part in which
    the row found its place.  Row numbers deal the pieces, so equal rows are spread like any others.
    """
    full = F.col("length") == window
    alone = pieces.filter(full).withColumn("sequence_id", F.col("rid")).withColumn("offset", F.lit(0).cast("long"))
    done = [alone.withColumn("part_sequences", F.lit(1).cast("long")).withColumn("part_bound", F.lit(1).cast("long"))]
    left, kept_over, sequences = pieces.filter(~full), None, None
    for turn in range(rounds):
        parts = max(1, -(-left.count() // (part_rows * GROWTH**turn)))
        last = parts == 1 or turn == rounds - 1
        dealt = left.withColumn("deal", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(parts)))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)
        schema += ", sequence_id long, offset long, part_sequences long, part_bound long, stays boolean"
        placed = stage(dealt.groupBy("deal").applyInArrow(part_packer(window, last), schema), "packed")
        starts = placed.filter("offset = 0").groupBy("stays").count().collect()  # a sequence has one piece at 0; two rows
        if sequences is not None and sum(r["count"] for r in starts) > sequences:
            break  # not better than before: the places of the last round hold
        done.append(placed.filter("stays").drop("stays"))
        kept_over = placed.filter("not stays").drop("stays")
        sequences = sum(r["count"] for r in starts if not r.stays)
        if last:
            break
        left = kept_over.select(*pieces.columns)
    if kept_over is not None:
        done.append(kept_over)
    out = done[0]
    for rows in done[1:]:
        out = out.unionByName(rows)
    return out.drop("rid")


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, part_rows: int = PART_ROWS) -> DataFrame:
    """All pieces of all documents with their places in sequences of at most ``window`` tokens.

    A null or empty text is one piece of the end id alone.  Rows that repeat an id are packed each; null ids stay null;
    other columns are not looked at; an empty table gives no rows.
    """
    return pack(stage(cut_documents(docs, path or public_path("byte_bpe_50k.json"), window), "pieces"), window, part_rows)
