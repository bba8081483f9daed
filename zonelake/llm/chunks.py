"""Removal of repeated passages of lines, found as content-defined chunks and as neighbouring lines.

A hash rolls over the hashes of the last lines; where it ends in zeros a chunk ends.  So the same lines are cut at the
same places wherever they stand.  Passages that no two cuts enclose, and the ends of those around a chunk, are found by
windows: every pair of neighbouring lines, and every single line of many words.  Chunks and windows whose hash occurs
again are compared byte by byte; all but the first occurrence go, so a repeated run of lines goes from end to end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import free_name, slices, stage, text_key

#: Lines that the hash rolls over, one cut in so many lines, and lines of a chunk at least.
ROLL, DIVISOR, LEAST_LINES = 2, 2, 2
#: A single line of more words is a passage too.
LONG_LINE = 50
_PRIME, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1


def line_chunks(lines: list[str], roll: int = ROLL, divisor: int = DIVISOR, least: int = LEAST_LINES) -> list[tuple[int, int]]:
    """(first, after last) of all chunks of a text.  Cuts closer than ``least`` lines are passed over, so every chunk
    but the last has at least that many."""
    import xxhash

    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    top = pow(_PRIME, roll, 1 << 64)
    out, start, value = [], 0, 0
    for i, h in enumerate(hashes):
        value = (value * _PRIME + h) & _WORD
        if i >= roll:
            value = (value - hashes[i - roll] * top) & _WORD
        if i + 1 - start >= least and (value >> 33) % divisor == 0:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def _filled(lines: list[str], a: int, b: int) -> int:
    return sum(1 for x in lines[a:b] if x and not x.isspace())


def passages(lines: list[str], least: int) -> list[tuple[int, int]]:
    """(first, after last) of all stretches that are looked up: chunks, windows of ``least`` lines that are not blank
    (with the blank ones between), single lines of over ``LONG_LINE`` words, and lines with a blank one beside them."""
    filled = [i for i, x in enumerate(lines) if x and not x.isspace()]
    found = {(a, filled[k + least - 1] + 1) for k, a in enumerate(filled[: len(filled) - least + 1])}
    found.update((a, b) for a, b in line_chunks(lines, least=least) if b - a > least and _filled(lines, a, b) >= least)
    found.update((i, i + 1) for i in filled if len(lines[i].split(None, LONG_LINE)) > LONG_LINE)
    if len(filled) < len(lines):
        found.update((i, i + 2) for i in range(len(lines) - 1) if _filled(lines, i, i + 2) == 1)
    return sorted(found)


def gone_lines(lines: list[str], spans: list[tuple[int, int]]) -> set[int]:
    """Lines of repeated ``spans``.  A blank line goes with the line beside it, but takes none along."""
    beside = {(a, b) for a, b in spans if b - a == 2 and _filled(lines, a, b) == 1}
    drop = {i for a, b in spans if (a, b) not in beside for i in range(a, b)}
    edges = set()
    for a, b in beside:
        at, blank = (a, a + 1) if _filled(lines, a, a + 1) else (a + 1, a)
        if at in drop:
            edges.add(blank)
    return drop | edges


def chunk_rows(docs: DataFrame, bodies: bool, least: int) -> DataFrame:
    """(id, tk, span, h1, h2) of all passages, or (h1, h2, body) of those in ``wanted``; a span is first << 32 | after last."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text"):
                asked = part.column("wanted").to_pylist() if bodies else [None] * len(part)
                row, span, one, two, body = [], [], [], [], []
                for i, (t, want) in enumerate(zip(part.column("text").to_pylist(), asked)):
                    only = set(want) if want is not None else None
                    lines = t.split("\n")
                    for a, b in passages(lines, least):
                        if only is None or a << 32 | b in only:
                            text = "\n".join(lines[a:b])
                            value = xxhash.xxh3_128_intdigest(text)
                            row.append(i)
                            span.append(a << 32 | b)
                            one.append((value >> 64) - (1 << 63))
                            two.append((value & _WORD) - (1 << 63))
                            body.append(text)
                at = pa.array(row, pa.int64())
                cols = [part.column("id").take(at), part.column("tk").take(at), pa.array(span, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())]
                names = ["id", "tk", "span", "h1", "h2"]
                if bodies:
                    cols, names = cols[3:] + [pa.array(body, pa.string())], ["h1", "h2", "body"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "h1 long, h2 long, body string" if bodies else f"id {kind}, tk long, span long, h1 long, h2 long"
    return docs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LINES) -> DataFrame:
    """All rows and columns of ``docs``, without repeated passages in ``text``, and ``n_lines``, ``removed_lines``, ``removed_chunks``.

    A passage is a run of at least ``least`` lines that are not blank, or one line of over ``LONG_LINE`` words.  Of equal
    ones that with the smallest (id, line) stays, with a null id last; of lines of several passages each stays where it
    stands first.  Lines end with a line feed; removed lines take theirs along.  Null and empty texts stay as they are
    (one empty line, or none).  Rows that repeat an id and its text count as one document: their passages are no copies
    of each other.  ``removed_chunks`` counts runs of removed lines.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(F.col(key).alias("id"), text_key(key, text).alias("tk"), plain.alias("text"))
    chunks = stage(chunk_rows(slim, False, least).distinct(), "chunks")
    often = chunks.groupBy("h1", "h2").count().filter(F.col("count") > 1)
    copies = stage(chunks.join(often.select("h1", "h2"), ["h1", "h2"]), "copies")
    asked = copies.groupBy(F.col("id").alias("i"), F.col("tk").alias("k")).agg(F.collect_list("span").alias("wanted"))
    met = (F.col("tk") == F.col("k")) & F.col("id").eqNullSafe(F.col("i"))
    # Both tables grow with the documents, so neither is ever broadcast.
    bodies = chunk_rows(slim.join(asked.hint("merge"), met).select("id", "tk", "text", "wanted"), True, least)
    # Byte comparison: one body for each hash, or the chunks stay.
    same = bodies.groupBy("h1", "h2").agg(F.min("body").alias("x"), F.max("body").alias("y")).filter(F.col("x") == F.col("y"))
    order = F.struct(F.col("id").isNull(), "id", "tk", "span")
    kept = copies.groupBy("h1", "h2").agg(F.min(order).alias("kept"))
    gone = copies.join(same.select("h1", "h2"), ["h1", "h2"]).join(kept, ["h1", "h2"]).filter(order != F.col("kept"))
    gone = stage(gone.groupBy(F.col("id").alias("i"), F.col("tk").alias("k")).agg(F.collect_list("span").alias("gone")), "gone")

    carried = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    full = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, carried)], text_key(key, text).alias("tk"), F.col(key).alias("id"))
    full = full.join(gone.hint("merge"), met, "left").select(*carried, "gone")
    full = full.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                texts, lines_of, lines_gone, chunks_gone = [], [], [], []
                for t, spans in zip(part.column(f"c{at}").to_pylist(), part.column("gone").to_pylist()):
                    lines = t.split("\n") if t is not None else []
                    drop: set[int] = set()
                    if spans:
                        drop = gone_lines(lines, [(x >> 32, x & 0xFFFFFFFF) for x in spans])
                        t = "\n".join(x for i, x in enumerate(lines) if i not in drop)
                    texts.append(t)
                    lines_of.append(len(lines))
                    lines_gone.append(len(drop))
                    chunks_gone.append(sum(1 for i in drop if i - 1 not in drop))
                cols = [part.column(c) for c in carried]
                cols[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(x, pa.int64()) for x in (lines_of, lines_gone, chunks_gone)],
                    names=carried + ["n_lines", "removed_lines", "removed_chunks"],
                )

    kinds = ", ".join(f"{c} {full.schema[c].dataType.simpleString()}" for c in carried)
    made = full.mapInArrow(cut, kinds + ", n_lines long, removed_lines long, removed_chunks long")
    added = [F.col(c).alias(free_name(docs, c)) for c in ("n_lines", "removed_lines", "removed_chunks")]
    return made.select(*[F.col(n).alias(c) for n, c in zip(carried, docs.columns)], *added)
