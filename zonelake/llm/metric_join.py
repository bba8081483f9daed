"""Exact join of documents by the Jaccard likeness of their word shingles, in the metric space of Jaccard distance.

Unrelated documents are all at distance 1 from each other, so the plain window of the triangle inequality around
document pivots would hold every document.  The first level therefore takes single shingles as pivots: a document of n
shingles goes to the regions of its first n - ceil(t n) + 1 shingles in one fixed order, which is the narrowest window
that brings every pair of likeness t or more together (common shingles come last in the order).  Inside a region a
document is the pivot, distances to it are computed exactly, and the triangle inequality with e = 1 - t decides:

* within e of the pivot: linked to it, so these are one component and need no pairs among themselves;
* otherwise rings of width e around the pivot are the new regions, and each ring is replicated to the one before it,
  as only documents of the same or of neighbouring rings can be within e of each other.

Large first regions that have the same pivot are one region.  Regions with documents of one component only are done; the
others are joined again with new pivots, small ones pair by pair.  Regions that rings no longer part are cut into blocks,
and pairs of blocks are compared: first each document with the closest of another component, so that a group of near
copies is mostly one component, then all that are still apart.  A pair of a first region needs fitting sizes and room
behind the places of its shingle, and sets differ by at least the parities in which they differ; profiles, vectors of
counts whose distance bounds that of the sets from below, spare most of the other pairs their texts.  They grow with the
set, so that long unrelated documents are told apart as well as short ones.  Documents with equal sets are one vertex.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import mix, odd_powers, signed, slices, stage, stage_buckets, text_key, text_of
from zonelake.llm.graph import components

WORDS, PERCENT = 5, 80
#: Cells of a task's counts of shingles, documents of a task that make a shingle common, common shingles at most, and
#: cells that common shingles mark.  They only set the order of shingles: any order gives the same links.
COUNTERS, COMMON_ROWS, COMMON, MARKS = 1 << 23, 3, 1 << 20, 1 << 24
#: Groups of shingles that a set's profile counts at least and at most; between, there is one for one or two shingles.  What
#: two profiles differ by, the sets differ by at least.
GROUPS, MOST_GROUPS = 128, 1 << 16
#: Groups of shingles of which a set has an even or odd number, as the bits of these columns.
PARITIES = ["odd0", "odd1", "odd2", "odd3"]
#: Documents of a region that is joined pair by pair; levels of rings before larger ones are joined so, too; documents of
#: the blocks that these are cut into.  Each document goes to a task once for each block of its region.
LEAF, LEVELS, BLOCK = 128, 2, 1024
#: Cells of a table that marks texts to be fetched, and bytes of profiles that are compared at once.
CELLS, PROFILE_BYTES = 1 << 24, 1 << 22

#: Bytes of the longest word whose hash is a sum of powers.
LONG_WORD = 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_TABLE[ord("A") : ord("Z") + 1] = _TABLE[ord("a") : ord("z") + 1]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z as a-z) of the concatenated texts, and where each text's words begin."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:n]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    powers = odd_powers(_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[raw] * powers, out=sums[1:])
    found = (sums[ends] - sums[starts]) * odd_powers(_INVERSE, n)[starts]
    # Sums of odd powers fall together for some long words by their build alone: these have another hash.
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        found[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : ends[k]].tobytes().lower())
    return mix(found ^ (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text; a text of fewer words has its whole sequence as one shingle."""
    hashes, first = word_hashes(raw, offsets)
    n = len(hashes)
    coefficients = mix(np.arange(11, 11 + words, dtype=np.uint64)) | np.uint64(1)
    joined = np.zeros(max(n - words + 1, 0), np.uint64)
    for k in range(words):
        joined += hashes[k : n - words + 1 + k] * coefficients[k] if len(joined) else 0
    joined = mix(joined)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        elif b > a:
            whole = np.sum(hashes[a:b] * coefficients[: b - a], dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(mix(np.array([whole], np.uint64)) ^ np.uint64(0xA5A5A5A5)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = np.sum(mix(shingles ^ np.uint64(0x51ED270B9F652295)), dtype=np.uint64) + np.uint64(len(shingles))
    return int(signed(mix(np.array([total], np.uint64)))[0])


def profile(shingles: np.ndarray) -> bytes:
    """Counts of shingles by group, at most 255 each."""
    groups = min(max(GROUPS, 1 << max(len(shingles) - 1, 1).bit_length() - 1), MOST_GROUPS)
    counts = np.bincount((shingles >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def profiles_apart(profiles: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """What the sets of ``profiles[i]`` and ``profiles[j]`` differ by at least; a finer profile is summed up to the other's groups."""
    lengths = np.array([len(p) for p in profiles], np.int64)
    out = np.zeros(len(i), np.int64)
    folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def rows(groups: int) -> tuple[np.ndarray, np.ndarray]:
        if groups not in folded:
            able = np.flatnonzero((lengths >= groups) & (lengths <= 4 * groups))
            at = np.zeros(len(profiles), np.int64)
            at[able] = np.arange(len(able))
            held = np.zeros((len(able), groups), np.int16)
            for k, x in enumerate(able.tolist()):
                held[k] = np.minimum(np.frombuffer(profiles[x], np.uint8).reshape(groups, -1).sum(axis=1, dtype=np.int16), 255)
            folded[groups] = at, held
        return folded[groups]

    least, most = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
    for groups in np.unique(least).tolist():
        at, counts = rows(groups)
        # Sets of fitting sizes have profiles of the same or the next length; for others 0 is a bound, too.
        mine = np.flatnonzero((least == groups) & (most <= 4 * groups))
        step = max(1, PROFILE_BYTES // groups)
        for k in range(0, len(mine), step):
            some = mine[k : k + step]
            out[some] = np.abs(counts[at[i[some]]] - counts[at[j[some]]]).sum(axis=1, dtype=np.int64)
    return out


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether each group has an odd number of shingles, 64 groups to a long."""
    counts = np.bincount((shingles & np.uint64(64 * len(PARITIES) - 1)).astype(np.int64), minlength=64 * len(PARITIES))
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _sets_of(part: pa.RecordBatch, words: int) -> list[np.ndarray]:
    return shingle_sets(*text_of(part.column("text")), words)


def describe(docs: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, DataFrame]:
    """(rows, common): per row id, tk, n, sig and, once for each set of a task, its profile and parities; and shingles that several
    documents of one task have, with their counts."""
    slim = docs.select(F.col(key).alias("id"), text_key(key, text).alias("tk"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, common, seen, total = np.zeros(COUNTERS, np.uint32), set(), set(), 0
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)
        ids = None
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _sets_of(part, words)
                sigs = [signature(s) for s in sets]
                fresh, profiles, odd = [], [], np.zeros((len(sets), len(PARITIES)), np.int64)
                for i, (g, s) in enumerate(zip(sigs, sets)):
                    new = len(s) > 0 and g not in seen
                    profiles.append(profile(s) if new else None)
                    if new:
                        seen.add(g)
                        odd[i] = parities(s)
                        fresh.append(s)
                if fresh:
                    every = np.concatenate(fresh)
                    cell = (every >> shift).astype(np.int64)
                    np.add.at(counters, cell, 1)
                    total += len(every)
                    common.update(every[counters[cell] >= COMMON_ROWS + 4 * total / COUNTERS].tolist())
                ids = part.column("id")
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, part.column("tk"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64()), pa.array(profiles, pa.binary()), none, none, *map(pa.array, odd.T.copy())],
                    names=["id", "tk", "n", "sig", "profile", "shingle", "count", *PARITIES],
                )
        if common:
            found = np.fromiter(common, np.uint64, len(common))
            counts = counters[(found >> shift).astype(np.int64)].astype(np.int64)
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(found), ids.type), none, none, none, pa.nulls(len(found), pa.binary()), pa.array(signed(found)), pa.array(counts), *[none] * len(PARITIES)],
                names=["id", "tk", "n", "sig", "profile", "shingle", "count", *PARITIES],
            )

    odd = "".join(f", {c} long" for c in PARITIES)
    made = slim.mapInArrow(run, f"id {kind}, tk long, n long, sig long, profile binary, shingle long, count long{odd}")
    made = stage(made, "shingle-sets")
    return made.filter(F.col("shingle").isNull()).select("id", "tk", "n", "sig", "profile", *PARITIES), made.filter(F.col("shingle").isNotNull())


def common_marks(common: DataFrame) -> np.ndarray:
    """A table of fixed size that marks the most common shingles."""
    top = common.groupBy("shingle").agg(F.sum("count").alias("n")).orderBy(F.col("n").desc(), "shingle").limit(COMMON)
    marks = np.zeros(MARKS, bool)
    found = np.array([r[0] for r in top.select("shingle").collect()], np.int64).view(np.uint64)
    marks[(found >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(marks)


def first_regions(docs: DataFrame, text: str, words: int, percent: int, marks: np.ndarray) -> DataFrame:
    """(region, sig, n, place): every set of a task once, in the regions of its first shingles, the first at place 0."""
    slim = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shipped = docs.sparkSession.sparkContext.broadcast(marks)  # MARKS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = np.unpackbits(shipped.value).astype(bool), set()
        shift = np.uint64(64 - MARKS.bit_length() + 1)
        for batch in batches:
            for part in slices(batch, "text"):
                regions, sigs, sizes, places = [], [], [], []
                for s in _sets_of(part, words):
                    if not len(s):
                        continue
                    g = signature(s)
                    if g in seen:
                        continue
                    seen.add(g)
                    wanted = prefix_length(len(s), percent)
                    late = flags[(s >> shift).astype(np.int64)]
                    rare = s[~late][:wanted]
                    if len(rare) < wanted:
                        rare = np.concatenate([rare, s[late][: wanted - len(rare)]])
                    regions.append(rare)
                    sigs.append(np.full(len(rare), g, np.int64))
                    sizes.append(np.full(len(rare), len(s), np.int64))
                    places.append(np.arange(len(rare), dtype=np.int64))
                if regions:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.concatenate(regions))), *(pa.array(np.concatenate(x)) for x in (sigs, sizes, places))],
                        names=["region", "sig", "n", "place"],
                    )

    return slim.mapInArrow(run, "region long, sig long, n long, place long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig")))


def _with_both(pairs: DataFrame, table: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The pairs (a, b) with what ``table`` has about both, ``columns`` of b as ``columns_b``.  ``pairs`` must be staged; only
    the rows that they need leave the table."""
    few = stage(table.join(_ends(pairs), "sig", "left_semi").select("sig", *columns), name)
    one = few.withColumnRenamed("sig", "a")
    two = few.select(F.col("sig").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", *columns, *[f"{c}_b" for c in columns])


def plausible(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose profiles leave room for a likeness of ``percent`` / 100.  None that links is lost.

    ``pairs`` must be staged.
    """
    both = _with_both(pairs, profiles, ["n", "profile"], "few-profiles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "profile"):
                k = np.arange(len(part))
                apart = profiles_apart(part.column("profile").to_pylist() + part.column("profile_b").to_pylist(), k, k + len(part))
                total = part.column("n").to_numpy() + part.column("n_b").to_numpy()
                keep = pa.array((total - apart) * 100 >= (total + apart) * percent)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def fetched(docs: DataFrame, key: str, text: str, profiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, text) of the sets ``wanted`` (sig), one text of each.

    A table of fixed size marks the rows that are wanted, so that few others leave their place.
    """
    wanted = stage(profiles.select("sig", "k", "tk").join(wanted, "sig", "left_semi"), "wanted")
    cell = F.pmod(F.xxhash64("k", "tk"), F.lit(CELLS))
    word, bit = F.shiftright(cell, 6).alias("word"), (cell % 64).cast("int").alias("bit")
    words = wanted.select(word, bit).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    texts = docs.select(F.xxhash64(key).alias("k"), text_key(key, text).alias("tk"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.select("*", word, bit).join(F.broadcast(words), "word")  # at most CELLS / 64 rows
    texts = texts.filter(F.expr("shiftrightunsigned(bits, bit) & 1 = 1")).select("k", "tk", "text")
    found = texts.join(wanted, ["k", "tk"]).dropDuplicates(["k", "tk"]).select("sig", "text")
    return stage(found, "pool")


def distances(pairs: DataFrame, pool: DataFrame, words: int) -> DataFrame:
    """(a, b, shared, united) of every pair (a, b), from the texts in ``pool`` (sig, text).  ``pairs`` must be staged."""
    both = _with_both(pairs, pool, ["text"], "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                left, right = shingle_sets(*text_of(part.column("text")), words), shingle_sets(*text_of(part.column("text_b")), words)
                shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
                united = [len(x) + len(y) - s for x, y, s in zip(left, right, shared)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(shared, pa.int64()), pa.array(united, pa.int64())],
                    names=["a", "b", "shared", "united"],
                )

    return both.mapInArrow(run, "a long, b long, shared long, united long")


def _sized(percent: int, x: str = "n", y: str = "m"):
    return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)


def _open_regions(regions: DataFrame, known: DataFrame) -> DataFrame:
    """Regions (region, home, sig, n, place) whose documents are of more than one component, with their component c and size."""
    found = regions.join(known, regions["sig"] == known["v"], "left").select("region", "home", "sig", "n", "place", F.coalesce("c", "sig").alias("c"))
    by = W.partitionBy("region")
    found = found.withColumns({"low": F.min("c").over(by), "high": F.max("c").over(by), "size": F.count(F.lit(1)).over(by)})
    return found.filter(F.col("low") != F.col("high")).drop("low", "high")


def _small_pairs(regions: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of one region and different components whose sizes, places and parities allow the likeness, for regions
    of a bounded number of documents.

    Regions of one ``home`` are compared inside one task, and each of their pairs leaves it once.  A linked pair passes in
    the region of its first common shingle, behind which all the others lie in both sets.
    """
    marked = regions.select("region", "home", "sig", "n", "place", "c").join(profiles.select("sig", *PARITIES), "sig")
    marked = marked.repartition("home").sortWithinPartitions("home", "region")

    def pairs(table: pa.Table) -> pa.RecordBatch:
        region, sig, n, place, c = (table.column(x).to_numpy() for x in ("region", "sig", "n", "place", "c"))
        odd = [table.column(x).to_numpy() for x in PARITIES]
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, len(sig)):
            i = np.flatnonzero(region[step:] == region[:-step])
            if not len(i):
                break
            j = i + step
            total = n[i] + n[j]
            fits = (sig[i] != sig[j]) & (c[i] != c[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)
            fits &= np.minimum(n[i] - place[i], n[j] - place[j]) * (100 + percent) >= total * percent
            i, j, total = i[fits], j[fits], total[fits]
            apart = sum((np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int64) for x in odd), np.zeros(len(i), np.int64))
            fits = (total - apart) * 100 >= (total + apart) * percent
            left.append(sig[i[fits]])
            right.append(sig[j[fits]])
        a, b = np.concatenate(left), np.concatenate(right)
        return _once(np.minimum(a, b), np.maximum(a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(pairs, _groups(batches, "home"))

    return marked.mapInArrow(run, "a long, b long").distinct()


def _once(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The different pairs (a, b)."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], names=["a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows sorted by ``key``, none of which ends inside a group."""
    rest = []
    for batch in batches:
        found = batch.column(key).to_numpy()
        if not len(found):
            continue
        # The last group may go on in the next batch.
        cut = int(np.searchsorted(found, found[-1]))
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        elif rest and rest[-1].column(key)[-1] != batch.column(key)[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


def _block_pairs(regions: DataFrame, profiles: DataFrame, percent: int, closest: bool) -> DataFrame:
    """Pairs (a < b) of one region and different components whose sizes and profiles allow the likeness; with ``closest``
    only the one of each document and block whose profiles leave most room.

    Regions are cut into blocks of about BLOCK documents, and each pair of blocks is compared inside one task, so that no
    task holds a region and only plausible pairs leave it.
    """
    marked = regions.select("region", "sig", "n", "c", "size").join(profiles.select("sig", "profile"), "sig")
    blocks = F.ceil(F.col("size") / BLOCK)
    marked = marked.withColumn("own", F.pmod(F.xxhash64("sig"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    marked = marked.select(F.xxhash64("region", low, high).alias("group"), "region", low.alias("low"), high.alias("high"), "own", "sig", "n", "c", "profile")
    marked = marked.repartition("group").sortWithinPartitions("group")

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = ("region", "low", "high", "own", "sig", "n", "c")
        region, low, high, own, sig, n, c = (table.column(x).to_numpy() for x in names)
        held = table.column("profile").to_pylist()
        # Groups are named by a hash, so their fields tell them apart.
        for name in sorted(set(zip(region.tolist(), low.tolist(), high.tolist()))):
            rows = np.flatnonzero((region == name[0]) & (low == name[1]) & (high == name[2]))
            x, y = rows[own[rows] == name[1]], rows[own[rows] == name[2]]
            i, j = np.repeat(x, len(y)), np.tile(y, len(x))
            fits = (c[i] != c[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)
            fits &= (sig[i] < sig[j]) if name[1] == name[2] else (sig[i] != sig[j])
            i, j = i[fits], j[fits]
            total, apart = n[i] + n[j], profiles_apart(held, i, j)
            fits = (total - apart) * 100 >= (total + apart) * percent
            i, j, room = i[fits], j[fits], apart[fits] / total[fits]
            if closest and len(i):
                order = np.argsort(room, kind="stable")
                keep = np.concatenate([order[np.unique(k[order], return_index=True)[1]] for k in (i, j)])
                i, j = i[keep], j[keep]
            yield _once(np.minimum(sig[i], sig[j]), np.maximum(sig[i], sig[j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "group"):
            yield from pairs(table)

    return marked.mapInArrow(run, "a long, b long").distinct()


def similar_sets(docs: DataFrame, rows: DataFrame, common: DataFrame, key: str, text: str, words: int, percent: int, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """(v, c): every linked set with the smallest of its component.  Sets of likeness ``percent`` / 100 or more link; every
    link is computed exactly."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = first_regions(docs, text, words, percent, common_marks(common)).repartition(partitions, "region")
    by = W.partitionBy("region").orderBy("sig")
    entries = entries.withColumns({"last": F.lag("sig").over(by), "next": F.lead("sig").over(by)})
    # Equal sets of several tasks count once; a region of one set has no pairs.
    shared = entries.filter((F.col("last").isNull() | (F.col("last") != F.col("sig"))) & (F.col("last").isNotNull() | F.col("next").isNotNull()))
    # A row of a region without any other of fitting size has no pairs; one of a region of two needs room with the other.
    sized, every = W.partitionBy("region").orderBy("n", "sig"), W.partitionBy("region")
    ends = F.struct("n", "place")
    shared = shared.withColumns({"x": F.lag(ends).over(sized), "y": F.lead(ends).over(sized), "size": F.count(F.lit(1)).over(every)})

    def meets(other: str):
        m, total = F.col(f"{other}.n"), F.col("n") + F.col(f"{other}.n")
        room = F.least(F.col("n") - F.col("place"), m - F.col(f"{other}.place")) * (100 + percent) >= total * percent
        return F.coalesce(_sized(percent, "n", f"{other}.n") & (room | (F.col("size") > 2)), F.lit(False))

    shared = shared.filter(meets("x") | meets("y"))
    shared = shared.withColumns({"home": F.first("sig").over(by), "m": F.first("n").over(by)})
    regions = stage_buckets(shared.select("region", "home", "sig", "n", "place", "m"), "regions", "region", dealt=True)
    own = rows.filter(F.col("profile").isNotNull()).withColumn("k", F.xxhash64("id"))
    profiles = stage_buckets(own.select("sig", "n", "k", "tk", "profile", *PARITIES).dropDuplicates(["sig"]), "profiles", "sig")

    # Each document with the pivot that it meets most often, its nearest as far as the regions tell.
    stars = regions.filter((F.col("home") != F.col("sig")) & _sized(percent)).groupBy("sig", "home").count()
    nearest = stars.groupBy("sig").agg(F.max(F.struct("count", "home")).alias("x")).select(F.col("sig").alias("a"), F.col("x.home").alias("b"))
    nearest = stage(plausible(stage(nearest, "candidates"), profiles, percent), "nearest")
    pool = fetched(docs, key, text, profiles, _ends(nearest))
    checked = stage(distances(nearest, pool, words), "distances")
    near = F.col("shared") * 100 >= F.col("united") * percent
    known = components(checked.filter(near))

    def compare(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(checked, known) with the pairs that were not compared before, which ``pairs`` (staged) may hold."""
        fresh = stage(distances(pairs, pool, words), "distances")
        links = fresh.filter(near).select("a", "b")
        # Components are the vertices of the new links.
        x, y = known.select(F.col("v").alias("a"), F.col("c").alias("x")), known.select(F.col("v").alias("b"), F.col("c").alias("y"))
        links = links.join(x, "a", "left").join(y, "b", "left").select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
        links = stage(links.filter(F.col("x") != F.col("y")), "links")
        if links.isEmpty():
            return checked.unionByName(fresh), known
        roots = components(links, "x", "y").select(F.col("v").alias("k"), F.col("c").alias("r"))
        moved = known.join(roots, F.col("c") == F.col("k"), "left").select("v", F.coalesce("r", "c").alias("c"))
        new = roots.join(known, F.col("k") == F.col("v"), "left_anti").select(F.col("k").alias("v"), F.col("r").alias("c"))
        every = moved.unionByName(new)
        return checked.unionByName(fresh), stage(every, "known")

    def unseen(pairs: DataFrame) -> DataFrame:
        seen = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return stage(pairs.distinct().join(seen, ["a", "b"], "left_anti"), "pairs")

    e, level = (100 - percent) / 100, 0
    while True:
        level += 1
        regions = stage(_open_regions(regions, known), "open-regions")
        if regions.isEmpty():
            return known
        if level > levels:
            if level == 1:
                pool = fetched(docs, key, text, profiles, regions.select("sig"))
            break
        # Small regions pair by pair, large ones by pivots.
        small, large = regions.filter(F.col("size") <= leaf), regions.filter(F.col("size") > leaf)
        pairs = plausible(stage(_small_pairs(small, profiles, percent), "candidates"), profiles, percent)
        first = W.partitionBy("region").orderBy("sig")
        large = large.withColumns({"pivot": F.first("sig").over(first), "m": F.first("n").over(first)})
        large = large.select("region", "sig", "n", "pivot", "m")
        if level == 1:
            large = large.withColumn("region", F.xxhash64(F.lit("pivot"), "pivot")).distinct()
        large = stage(large, "large-regions")
        others = large.filter(F.col("sig") != F.col("pivot"))
        pairs = unseen(pairs.unionByName(others.select(F.least("sig", "pivot").alias("a"), F.greatest("sig", "pivot").alias("b"))))
        if level == 1:
            # All pairs of later levels are of large regions.
            pool = fetched(docs, key, text, profiles, _ends(pairs).unionByName(large.select("sig")))
        checked, known = compare(pairs)
        apart = checked.select(
            F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), (1 - F.col("shared") / F.col("united")).alias("d")
        ).dropDuplicates(["x", "y"])
        placed = others.join(apart, (F.least("sig", "pivot") == F.col("x")) & (F.greatest("sig", "pivot") == F.col("y")))
        # Rings of width e; a distance on the edge, or next to it by rounding, counts as both.
        inner = F.floor(F.col("d") / e - 1e-9).cast("int")
        outer = F.floor(F.col("d") / e + 1e-9).cast("int")
        ring = F.explode(F.array_distinct(F.array(inner - 1, inner, outer - 1, outer))).alias("ring")
        ringed = placed.select("region", "sig", "n", ring).filter(F.col("ring") >= 0)
        region = F.xxhash64(F.lit(level), "region", "ring")
        regions = ringed.select(region.alias("region"), region.alias("home"), "sig", "n", F.lit(0).cast("long").alias("place"))

    checked, known = compare(unseen(_block_pairs(regions, profiles, percent, closest=True)))
    regions = stage(_open_regions(regions.drop("c", "size"), known), "open-regions")
    if regions.isEmpty():
        return known
    return compare(unseen(_block_pairs(regions, profiles, percent, closest=False)))[1]


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: its id (under ``key``), text_key, n_shingles, component_id and component.

    Rows link when 100 * shared >= percent * united shingles; component_id is the smallest id that links reach.  Rows
    without words have no shingles and link with nothing; their component is null.  Two components can have the same
    smallest id (an id that repeats, or null), so ``component`` names them apart.  Rows that repeat an id or a text are vertices like others;
    a null id is never the smallest unless all of its component are null.  An empty table gives no rows.
    """
    rows, common = describe(docs, key, text, words)
    known = similar_sets(docs, rows, common, key, text, words, percent)
    found = rows.filter(F.col("n") > 0).join(known, F.col("sig") == F.col("v"), "left").select("id", "tk", "n", F.coalesce("c", "sig").alias("c"))
    smallest = found.groupBy(F.col("c").alias("k")).agg(F.min("id").alias("component_id"))
    found = found.join(smallest, F.col("c") == F.col("k")).select("id", "tk", "n", "component_id", F.col("k").alias("component"))
    bare = rows.filter(F.col("n") == 0).select("id", "tk", "n", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return found.unionByName(bare).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("tk").alias("text_key"), "component"
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the one with the smallest id (null last); rows without words all stay."""
    rows = near_duplicates(docs, key, text, words, percent)
    rows = rows.withColumns({"_id": F.col(key), "_tk": F.col("text_key")}).select("_id", "_tk", "n_shingles", "component")
    full = rows.filter(F.col("n_shingles") > 0)
    kept = full.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_tk")).alias("k"))
    kept = kept.select(F.col("k._id").alias("_id"), F.col("k._tk").alias("_tk"), F.lit(True).alias("_once"))
    bare = rows.filter(F.col("n_shingles") == 0).select("_id", "_tk", F.lit(False).alias("_once")).distinct()
    carried = [f"c{i}" for i in range(len(docs.columns))]
    slim = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, carried)], F.col(key).alias("_key"), text_key(key, text).alias("_own"))
    met = slim.join(kept.unionByName(bare), (F.col("_own") == F.col("_tk")) & F.col("_key").eqNullSafe(F.col("_id")))
    nth = F.row_number().over(W.partitionBy("_own", "_key").orderBy(F.lit(1)))
    met = met.withColumn("_nth", nth).filter(~F.col("_once") | (F.col("_nth") == 1))
    return met.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, carried)])
