"""Repeated strings over all documents, by suffix arrays of shards that are built by induced sorting.

Every string of ``length`` bytes has an anchor: its gram with the smallest hash.  Equal strings have equal anchors, so
the strings of one anchor can be decided apart from all others.  A document is cut into contexts, the runs of strings
whose anchors are equal.  Contexts that are the same in all places of their anchor are one class and need no sorting; the
different contexts of an anchor are put together in shards, and so is a context in which the anchor moves (a text that
repeats itself), because its strings may be equal to each other.  A shard's suffix array is built by induced sorting:
suffixes are classified, the leftmost-smaller substrings are named and ranked, and all other suffixes follow from them
bucket by bucket.  Common prefixes are computed in the order of the text (permuted), where they fall by one at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import mix, odd_powers, signed, slices, stage, text_key, text_of

LENGTH, GRAM = 200, 32
#: Bytes of contexts that one suffix array is built over, and contexts of an anchor beyond which its strings are compared
#: one row a string, dealt by their bytes, instead of being gathered.
SHARD_BYTES, MOST_CONTEXTS = 2 << 20, 4096
#: Starts of a context, and starts of a text that are looked at together (their places have to fit 28 bits).
MOST_STARTS, BLOCK = 256, 1 << 26
#: Bytes that UTF-8 never has: between contexts, and after the last.
BREAK, END = 0xFF, 0xFE

_BASE = 0xC2B2AE3D27D4EB4F | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x165667B19E3779F9))


class Rolling:
    """Hashes of all substrings of a byte array."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_TABLE[raw] * odd_powers(_BASE, len(raw)), out=self.sums[1:])
        self.shift = odd_powers(_INVERSE, len(raw) + 1)

    def of(self, start, stop):
        return mix((self.sums[stop] - self.sums[start]) * self.shift[start])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK):
    """Runs of strings with equal anchors: (document, first start, last start, hash of the anchor, hash of the context,
    whether the anchor moves).  Runs end after ``MOST_STARTS`` starts and at multiples of ``block``."""
    parts = []
    for at in range(0, max(len(raw), 1), block):
        piece = raw[at : at + block + length - 1]
        bounds = np.clip(offsets - at, 0, len(piece))
        document, low, high, *rest = _anchors(piece, bounds, length, gram)
        shift = at + bounds[document] - offsets[document]
        parts.append((document, low + shift, high + shift, *rest))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    n = len(raw)
    none = np.zeros(0, np.int64)
    nothing = none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    if n < length:
        return nothing
    rolling = Rolling(raw)
    at = np.arange(n - gram + 1)
    hashes = rolling.of(at, at + gram)
    # Smallest hash, then smallest place, of the grams of each string.
    least = (hashes & ~np.uint64((1 << 28) - 1)) | at.astype(np.uint64)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    place = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
    sizes = np.diff(offsets)
    inside = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(sizes >= length)
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[: len(place)]) > 0)
    if not len(starts):
        return nothing
    own = place[starts]
    names = hashes[own]
    new = np.ones(len(starts), bool)
    new[1:] = (names[1:] != names[:-1]) | (starts[1:] != starts[:-1] + 1)
    nth = np.arange(len(starts))
    nth -= np.maximum.accumulate(np.where(new, nth, 0))
    first = np.flatnonzero(nth % MOST_STARTS == 0)
    last = np.append(first[1:], len(starts)) - 1
    low, high = starts[first], starts[last]
    document = np.searchsorted(offsets, low, "right") - 1
    # The context's hash also holds where the anchor is in it.
    context = mix(rolling.of(low, high + length) ^ (own[first] - low).astype(np.uint64))
    return document, low - offsets[document], high - offsets[document], names[first], context, own[first] != own[last]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of a whole-number array in order.  The last symbol has to be the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    text = text.astype(np.int64)
    # Classify: smaller (True) or larger than the next suffix; equal symbols take the class of what follows.
    step = np.sign(np.diff(text))
    turn = np.where(step != 0, np.arange(n - 1), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    small = np.append(step[np.minimum(turn, n - 2)] > 0, True)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1  # leftmost smaller suffixes
    order = left[_rank_reduced(text, small, left)]
    symbols = int(text.max()) + 1
    bounds = np.searchsorted(text[order], np.arange(symbols + 1))

    def deal(found: np.ndarray, bucket: list[list[np.ndarray]]) -> None:
        """Append suffixes to the buckets of their first symbols, in the order given."""
        if not len(found):
            return
        key = text[found]
        sort = np.argsort(key, kind="stable")
        key, found = key[sort], found[sort]
        cuts = np.flatnonzero(np.diff(key)) + 1
        for part in np.split(found, cuts):
            bucket[text[part[0]]].append(part)

    def before(found: np.ndarray, kind: bool) -> np.ndarray:
        found = found[found > 0] - 1
        return found[small[found] == kind]

    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    for c in range(symbols):
        at = 0
        while at < len(larger[c]):  # a bucket can feed itself
            now = np.concatenate(larger[c][at:])
            larger[c][at:] = [now]
            at += 1
            deal(before(now, False), larger)
        deal(before(order[bounds[c] : bounds[c + 1]], False), larger)
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in larger]
    smaller[0].append(np.array([n - 1]))
    for c in range(symbols - 1, -1, -1):
        at = 0
        while at < len(smaller[c]):
            now = np.concatenate(smaller[c][at:])
            smaller[c][at:] = [now]
            at += 1
            deal(before(now, True), smaller)
        deal(before(joined[c][::-1], True), smaller)
    out = []
    for c in range(symbols):
        out.append(joined[c])
        if smaller[c]:
            out.append(np.concatenate(smaller[c])[::-1])
    return np.concatenate(out)


def _rank_reduced(text: np.ndarray, small: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of the leftmost-smaller suffixes: their substrings are named, then the string of names is sorted."""
    count = len(left)
    if count < 2:
        return np.arange(count)
    n = len(text)
    width = int(text.max()).bit_length() + 1
    per = max(1, 62 // width)
    marked = (text << 1) | small
    stop = np.append(left[1:], n - 1)  # a substring ends with the next one's first symbol
    # Name by the first symbols, then tell equal names apart by the following ones as long as their substrings go on.
    name, at = np.zeros(count, np.int64), 0
    active = np.arange(count)
    while len(active):
        key = np.zeros(len(active), np.int64)
        for k in range(per):
            where = left[active] + at + k
            inside = where <= stop[active]
            key = (key << width) | np.where(inside, marked[np.minimum(where, n - 1)], 0)
        sort = np.lexsort((key, name[active]))
        old, new = name[active][sort], key[sort]
        change = np.append(True, (old[1:] != old[:-1]) | (new[1:] != new[:-1]))
        fresh = np.flatnonzero(change)
        group = np.cumsum(change) - 1
        head = np.append(True, old[1:] != old[:-1])
        base = np.maximum.accumulate(np.where(head, np.arange(len(old)), 0))
        # Names are places, so that finer ones fit between: each part's is its group's plus the parts' rows before it.
        name[active[sort]] = old + fresh[group] - base
        sizes = np.diff(np.append(fresh, len(old)))[group]
        at += per
        going = (sizes > 1) & (left[active[sort]] + at <= stop[active[sort]])
        # A part in which some substrings end and others go on cannot be: their ends would differ already.
        active = np.sort(active[sort][going])
    # The reduced string's symbols are nearly as many as its places, so its suffixes are ranked by doubling.
    rank = np.unique(name, return_inverse=True)[1].astype(np.int64)
    reach = 1
    while rank.max() + 1 < count:
        after = np.zeros(count, np.int64)
        after[: max(count - reach, 0)] = rank[reach:] + 1
        rank = np.unique(rank * (count + 1) + after, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    return np.argsort(rank, kind="stable")


def common_prefixes(raw: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the text the suffix before it in order (-1: none) and how long a prefix they share, in permuted
    order: counted where it may grow and after each break (up to ``most``), one less than at the place before elsewhere."""
    n = len(raw)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    place = np.arange(n)
    count = (previous < 0) | (place == 0) | (previous == 0)
    ok = ~count
    count[ok] = (raw[place[ok] - 1] != raw[previous[ok] - 1]) | (raw[place[ok] - 1] == BREAK)
    todo = np.flatnonzero(count & (previous >= 0))
    shared = np.zeros(n, np.int64)
    padded = np.full(n + most + 16, END, np.uint8)
    padded[:n] = raw
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    active, at = todo, 0
    while len(active) and at < most:
        a, b = eight[active + at], eight[previous[active] + at]
        differs = a != b
        same = ~differs.any(axis=1)
        shared[active] = at + np.where(same, 8, differs.argmax(axis=1))
        active = active[same]
        at += 8
    reach = np.where(count, shared + place, 0)
    return previous, np.maximum.accumulate(reach) - place


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context the starts of strings of ``length`` bytes that also start elsewhere in one of the contexts."""
    sizes = np.array([len(c) for c in contexts])
    # A break after each context and one last end.
    raw = np.frombuffer(b"".join(c + bytes([BREAK]) for c in contexts) + bytes([END]), np.uint8)
    first = np.append(0, np.cumsum(sizes + 1))[:-1]
    text = raw.astype(np.int64) + 1
    text[-1] = 0
    order = suffix_array(text)
    previous, shared = common_prefixes(raw, order, int(sizes.max()) + 1)
    found = np.zeros(len(text), bool)
    hit = np.flatnonzero(shared >= length)
    # Strings that run over a break are none.
    valid = np.zeros(len(text) + 1, np.int8)
    some = sizes >= length
    np.add.at(valid, first[some], 1)
    np.add.at(valid, (first + sizes - length + 1)[some], -1)
    valid = np.cumsum(valid)[:-1] > 0
    hit = hit[valid[hit] & valid[previous[hit]]]
    found[hit] = True
    found[previous[hit]] = True
    return [np.flatnonzero(found[a : a + s]) for a, s in zip(first, sizes)]


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [from, to) ranges, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def anchor_rows(slim: DataFrame, length: int) -> DataFrame:
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                document, low, high, anchor, context, moves = anchors(*text_of(part.column("text")), length)
                at = pa.array(document, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(context)), part.column("id").take(at), part.column("tk").take(at), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(moves)],
                    names=["anchor", "context", "id", "tk", "low", "high", "moves"],
                )

    return slim.mapInArrow(run, f"anchor long, context long, id {kind}, tk long, low long, high long, moves boolean")


def repeated_ranges(slim: DataFrame, length: int, most_contexts: int = MOST_CONTEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, tk, low, high): strings that start at low .. high of a text start elsewhere too."""
    kind = slim.schema["id"].dataType.simpleString()
    found = stage(anchor_rows(slim, length), "anchors")
    groups = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("places"), F.min("context").alias("x"), F.max("context").alias("y"), F.max("moves").alias("moves")
    )
    alike = (F.col("places") > 1) & (F.col("x") == F.col("y"))
    # Written, so that the join may split an anchor that has many of the places.
    groups = stage(groups.filter((F.col("places") > 1) | F.col("moves")).select("anchor", alike.alias("alike")), "repeated-anchors")
    shared = stage(found.join(groups, "anchor").drop("moves"), "shared-anchors")
    ranges = shared.filter("alike").select("id", "tk", "low", "high")
    # Anchors with different contexts: one of each is sorted, and stands for its copies.
    mixed = shared.filter(~F.col("alike"))
    classes = mixed.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.first("id").alias("id"), F.first("tk").alias("tk"), F.first("low").alias("low"), F.first("high").alias("high")
    )
    classes = stage(classes, "contexts")
    copied = classes.filter(F.col("copies") > 1).select("anchor", "context")
    ranges = ranges.unionByName(mixed.join(copied, ["anchor", "context"], "left_semi").select("id", "tk", "low", "high"))
    many = classes.groupBy("anchor").agg((F.count(F.lit(1)) > most_contexts).alias("many"))
    asked = classes.join(many, "anchor").groupBy(F.col("id").alias("i"), F.col("tk").alias("k")).agg(
        F.collect_list(F.struct("anchor", "copies", "low", "high", "many")).alias("asked")
    )
    texts = slim.join(asked, (F.col("tk") == F.col("k")) & F.col("id").eqNullSafe(F.col("i"))).dropDuplicates(["id", "tk"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                row, key, copies, low, body = [], [], [], [], []
                for i, (t, wanted) in enumerate(zip(part.column("text").to_pylist(), part.column("asked").to_pylist())):
                    raw = t.encode()
                    for w in wanted:
                        a, b = w["low"], w["high"]
                        # A row for each string, or one for all of them.
                        starts = range(a, b + 1) if w["many"] else (a,)
                        row += [i] * len(starts)
                        key += [None if w["many"] else w["anchor"]] * len(starts)
                        copies += [w["copies"]] * len(starts)
                        low += starts
                        body += [raw[x : x + length] for x in starts] if w["many"] else [raw[a : b + length]]
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(copies, pa.int64()), part.column("id").take(at), part.column("tk").take(at), pa.array(low, pa.int64()), pa.array(body, pa.binary())],
                    names=["key", "copies", "id", "tk", "low", "body"],
                )

    bodies = stage(
        texts.select("id", "tk", "text", "asked").mapInArrow(fetch, f"key long, copies long, id {kind}, tk long, low long, body binary"), "bodies"
    )
    strings = bodies.filter(F.col("key").isNull())
    often = stage(strings.groupBy("body").agg(F.sum("copies").alias("n")).filter(F.col("n") > 1).select("body"), "strings")
    strings = strings.join(often, "body", "left_semi").select("id", "tk", "low", F.col("low").alias("high"))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors come together; a shard is some whole anchors."""
        names = ["key", "copies", "id", "tk", "low", "body"]
        held: list[pa.RecordBatch] = []

        def settle(part: pa.Table) -> pa.RecordBatch:
            bodies = part.column("body").to_pylist()
            single = part.column("copies").to_numpy() == 1
            lows, row, low, high = part.column("low").to_numpy(), [], [], []
            for i, starts in enumerate(repeated_starts(bodies, length)):
                if single[i]:  # places of copied contexts are known already
                    a, b = _runs(starts)
                    row += [i] * len(a)
                    low += (a + lows[i]).tolist()
                    high += (b + lows[i]).tolist()
            at = pa.array(row, pa.int64())
            ids = part.column("id").combine_chunks().take(at), part.column("tk").combine_chunks().take(at)
            return pa.RecordBatch.from_arrays([*ids, pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["id", "tk", "low", "high"])

        def cut(table: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
            keys = table.column("key").to_numpy()
            sizes = np.cumsum(pc.binary_length(table.column("body")).to_numpy())
            ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys) if last else np.zeros(0, np.int64)).astype(np.int64)
            parts, start = [], 0
            while start < len(keys):
                base = sizes[start - 1] if start else 0
                fit = ends[(ends > start) & (sizes[ends - 1] - base <= shard_bytes)]
                later = ends[ends > start]
                if not len(later) or (not last and sizes[-1] - base < shard_bytes):
                    break
                stop = int(fit[-1] if len(fit) else later[0])
                parts.append(table.slice(start, stop - start))
                start = stop
            return parts, table.slice(start)

        for batch in batches:
            held.append(batch.select(names))
            if sum(b.column("body").nbytes for b in held) > shard_bytes:
                parts, rest = cut(pa.Table.from_batches(held).combine_chunks(), False)
                held = rest.combine_chunks().to_batches()
                for part in parts:
                    yield settle(part)
        if held:
            for part in cut(pa.Table.from_batches(held).combine_chunks(), True)[0]:
                yield settle(part)

    sorted_bodies = bodies.filter(F.col("key").isNotNull()).repartition("key").sortWithinPartitions("key")
    decided = sorted_bodies.mapInArrow(sort, f"id {kind}, tk long, low long, high long")
    return ranges.unionByName(strings).unionByName(decided)


def remove_repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: its id (under ``key``), n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes).

    Removed is every byte of a string of ``length`` bytes that starts anywhere else too, judged on the input.  Matches
    never cross texts, but a string may overlap its own copy.  Null texts are empty; texts shorter than ``length`` stay
    whole.  Rows that repeat an id and its text are places of their own, so both lose all such strings.  No rows, no
    result.  What remains may end inside a character.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(F.col(key).alias("id"), text_key(key, text).alias("tk"), plain.alias("text"))
    ranges = repeated_ranges(slim, length).distinct()
    ranges = ranges.groupBy(F.col("id").alias("i"), F.col("tk").alias("k")).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    ranges = stage(ranges, "ranges")
    full = slim.join(ranges, (F.col("tk") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left").select("id", "text", "ranges")
    kind = slim.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for t, found in zip(part.column("text").to_pylist(), part.column("ranges").to_pylist()):
                    raw = t.encode()
                    spans = covered([(r["low"], r["high"] + length) for r in found or ()])
                    at, kept = 0, []
                    for a, b in spans:
                        kept.append(raw[at:a])
                        at = b
                    kept.append(raw[at:])
                    left = b"".join(kept)
                    rows.append((len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
                cols = list(zip(*rows)) or [()] * 5
                types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    made = full.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return made.withColumnRenamed("id", key)
