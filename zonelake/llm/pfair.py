"""Mixing of sources to target weights by a Pfair schedule (DataFrame operations only).

Every source is cut into blocks.  With weights that add up to W, block i (from 0) of a source of weight w may start at
floor(i * W / w) and is due at ceil((i + 1) * W / w), as exact fractions.  Earliest deadline first over the released
blocks gives each source at any time t its w / W * t blocks, less than one block more or less.  The weights as whole
numbers without a common divisor are shares of a period after which the schedule repeats itself, so only one period is
laid out (on the driver) and every block finds its slot by arithmetic.  A phase that ends before its period does is
laid out up to its end.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonelake.llm.common import free_name

#: Slots of a period up to which its table is sent to every task.
PERIOD = 1024
BLOCK_ROWS = 64
#: Rows of one source that are ranked together.
RUN_ROWS = 4096


def whole_shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Shares of a given period, at least one each, by largest remainders; they add up to the period.  They are not the
    exact weights, so the mix does not use them."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    rest = period - sum(shares.values())
    order = sorted(exact, key=lambda s: (shares[s] - exact[s], s))
    for s in order[: max(rest, 0)]:
        shares[s] += 1
    while sum(shares.values()) > period:
        shares[max(shares, key=lambda s: (shares[s] - exact[s], s))] -= 1
    return shares


def exact_shares(weights: dict[str, float]) -> dict[str, int]:
    """The weights, as they are written, as whole numbers without a common divisor."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    common = math.gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


def one_period(shares: dict[str, int], left: dict[str, int] | None = None) -> list[str]:
    """Source of each slot: earliest deadline first over released blocks; up to the last block that a source has ``left``."""
    period = sum(shares.values())
    waiting = [(0, s, 0) for s in shares]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    slots = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-((i + 1) * period // -shares[s]), release, s, i))
        due, _, s, i = heapq.heappop(ready)
        slots.append(s)
        if left is not None and i + 1 == left[s]:
            break
        if i + 1 < shares[s]:
            heapq.heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))
    return slots


def phases(blocks: dict[str, int], weights: dict[str, float]) -> list[dict]:
    """Phases between exhaustions of sources: the weights of those left are scaled up, until all blocks have a slot.

    ``repeat`` has the blocks of each source and the slots after which ``where`` holds again.
    """
    left, done, at, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    while any(left.values()):
        live = {s: weights[s] for s, n in left.items() if n}
        shares = exact_shares(live)
        size = sum(shares.values())
        slots = one_period(shares, left)
        where: dict[str, list[int]] = {s: [] for s in live}
        for t, s in enumerate(slots):
            where[s].append(t)
        if len(slots) < size or any(len(where[s]) == left[s] for s in live):
            length, repeat = len(slots), {s: (left[s], len(slots)) for s in live}
        else:
            last = {s: (left[s] - 1) // shares[s] * size + where[s][(left[s] - 1) % shares[s]] for s in live}
            length, repeat = min(last.values()) + 1, {s: (shares[s], size) for s in live}
        taken = {
            s: length // size * shares[s] + sum(t < length % size for t in where[s]) if length > len(slots) else len(where[s]) for s in live
        }
        out.append({"start": at, "size": size, "shares": shares, "repeat": repeat, "where": where, "from": {s: done[s] for s in live}, "taken": taken})
        for s in live:
            left[s] -= taken[s]
            done[s] += taken[s]
        at += length
    return out


def mix_sources(
    df: DataFrame, source: str, key: str, weights: dict[str, float], other: float = 1.0, period: int = PERIOD,
    block_rows: int = BLOCK_ROWS, run_rows: int = RUN_ROWS,
) -> DataFrame:
    """All rows with ``stream``, ``stream_block``, ``slot`` (of the block in the mix) and ``place`` (of the row in its block).

    Sorting by (slot, place) gives the mix.  ``weights`` names the sources; rows of any other source, or of none,
    form one stream ``other`` with its own weight, so the schedule is as long as the sum of the weights as whole
    numbers (a phase of fewer blocks: as long as that) and no weight is rounded.  Within a stream rows are in the order
    of a hash of ``key`` and all other columns, so rows of one key, or without, are ranked in many runs.  No row is
    dropped or repeated: when a source is used up, the others share its weight.  Repeated rows are rows like others.  An empty table gives no rows.  The
    counts per stream are the only figures on the driver.  A source of any size is ranked in runs of about
    ``run_rows`` rows, whose starts are summed over the small table of runs.  A table of slots longer than ``period``
    for each phase and source is joined as Spark decides.
    """
    if any(w <= 0 for w in [*weights.values(), other]):
        raise ValueError("weights must be above 0")
    spark = df.sparkSession
    rest = "other"
    while rest in weights:
        rest = f"_{rest}"
    stream, run, slot, place, block = (free_name(df, n) for n in ("stream", "stream_run", "slot", "place", "stream_block"))
    mark, low = free_name(df, "stream_mark"), free_name(df, "stream_low")
    named = (
        F.when(F.col(source).isin(*weights), F.col(source)).otherwise(F.lit(rest)) if weights else F.lit(rest)
    )
    # Maps and variants can't be hashed, wherever they are in a column, so such a column's JSON is.
    loose = lambda kind: "map<" in kind or "variant" in kind
    row = [F.to_json(F.struct(F.col(c))) if loose(kind) else F.col(c) for c, kind in df.dtypes]
    marked = df.withColumns({stream: named.cast("string"), mark: F.xxhash64(F.col(key), *row)})
    counts = {r[0]: r[1] for r in marked.groupBy(stream).count().collect()}
    runs = max(1, -(-max(counts.values(), default=0) // run_rows))
    # Equal stretches of the hash: runs in order of the hash, so that the ranks follow on from each other.
    stretch = (F.shiftrightunsigned(F.col(mark), 31) * F.lit(runs) / F.lit(float(1 << 33))).cast("int")
    marked = marked.withColumn(run, stretch)
    sizes = marked.groupBy(stream, run).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy(stream).orderBy(run).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(stream, run, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(low))
    # Rows move with their rank.  Of rows with equal hashes the smaller key is first; equal rows are interchangeable.
    ranked = marked.withColumn(place, F.row_number().over(W.partitionBy(stream, run).orderBy(mark, F.col(key))) - 1)
    ranked = ranked.join(starts, [stream, run]).withColumn(place, F.col(place) + F.col(low))

    plan = phases({s: -(-n // block_rows) for s, n in counts.items()}, {**weights, rest: other})
    spans, slots = [], []
    for k, p in enumerate(plan):
        for s, first in p["from"].items():
            if p["taken"][s]:
                share, size = p["repeat"][s]
                w, total = p["shares"][s], p["size"]
                spans.append((s, k, first, first + p["taken"][s], p["start"], share, size))
                slots += [(k, s, i, t, i * total // w, -((i + 1) * total // -w)) for i, t in enumerate(p["where"][s])]
    small = len(slots) <= period * max(1, len(counts))
    # As long as (sources + 1) ** 2 and, for each phase, its period or its blocks, whichever are fewer.
    spans = spark.createDataFrame(spans, "s string, phase int, lo long, hi long, start long, share long, size long")
    slots = spark.createDataFrame(slots, "phase int, s string, i long, t long, r long, d long")
    n = F.floor(F.col(place) / block_rows)
    names = list(df.columns)
    cut = ranked.select(*names, stream, mark, n.alias(block), (F.col(place) % block_rows).cast("int").alias(place))
    on = F.broadcast(spans.alias("p"))
    timed = cut.join(
        on, (F.col(stream) == F.col("p.s")) & (F.col(block) >= F.col("p.lo")) & (F.col(block) < F.col("p.hi"))
    )
    i = F.col(block) - F.col("p.lo")
    timed = timed.join(
        F.broadcast(slots.alias("q")) if small else slots.alias("q"),
        (F.col("p.phase") == F.col("q.phase")) & (F.col("p.s") == F.col("q.s")) & (i % F.col("p.share") == F.col("q.i")),
    )
    again = F.col("p.start") + ((i - i % F.col("p.share")) / F.col("p.share")).cast("long") * F.col("p.size")
    found, release, due = (again + F.col(c) for c in ("q.t", "q.r", "q.d"))
    return timed.select(
        *[F.col(c) for c in names], F.col(stream), F.col(block), found.alias(slot), F.col(place),
        release.alias(free_name(df, "release")), due.alias(free_name(df, "deadline")),
    )
