"""Line dedup by content-defined chunks and by runs of lines.

A line of ``MIN_WORDS`` words or more is a chunk of its own. The shorter lines between such lines are hashed, and a rolling
hash over the last ``WINDOW`` line hashes ends a chunk where it hits a residue, so the same passage is cut the same way
wherever it stands. Boundaries of chunks can't follow every passage, so runs are looked at beside them: from each line
the shortest run of more than ``RUN_WORDS`` words that begins with it, and the shortest that ends with it. Each line of a
longer repeated run is in one of these. A chunk or run that occurs again anywhere in the table is removed; its first
occurrence stays. Hashes only choose what to look at: what shares a hash is grouped by its bytes, and only equal bytes
count as a repeat.

The search reads the texts twice. The first pass counts hashes; those that are shared set bits of a fixed bitmap of
2^BITS bits, which is broadcast, and the second pass sends on only what hits it. A false hit costs a row, not a
result.

Defined results: a null text stays null; lines end with a line feed. What goes is every line of a run of whole lines that
has more than ``RUN_WORDS`` words, begins and ends with a line that has words and stands earlier too, and of a chunk of
``MIN_WORDS`` words or more that stands earlier too. Lines without words go when the lines with words before and after
them do. Earlier is the place with the least doc_id (null last), then the least row hash, then what stands first in the
text; rows that are equal in all columns count as one document and share its fate.
``dropped_chunks`` counts the chunks that go as a whole, ``dropped_words`` the words of all lines that go. A text that
loses all its lines becomes empty. Empty tables give no rows; extra columns are kept, but for those named like the counts
where these are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import row_hash
from sheetloom.session import staged

WINDOW = 2
# Lines that a chunk of short lines has on average, and at most.
AVERAGE, MOST = 3, 64
MIN_WORDS = 10
RUN_WORDS = 50
SEED = 11
BITS = 27
# Bytes of repeated chunks and runs that a task sends on at once.
SENT = 16 << 20
# Fixed value: bits in one of Spark's bitmaps.
BITMAP = 32768


def chunks(data: bytes) -> list[tuple[int, int]]:
    """Chunks of a text as (first line, line after the last)."""
    lines = data.split(b"\n")
    return _cut(lines, [len(line.split()) for line in lines])


def _cut(lines: list[bytes], words: list[int]) -> list[tuple[int, int]]:
    out, start, before = [], 0, 0
    for i, line in enumerate(lines):
        if words[i] >= MIN_WORDS:
            if start < i:
                out.append((start, i))
            out.append((i, i + 1))
            start, before = i + 1, 0
            continue
        # The hash of the last WINDOW lines: what is older has been shifted out.
        before = (before << 64 // WINDOW ^ xxhash.xxh64_intdigest(line, SEED) >> 64 - 64 // WINDOW) & 0xFFFFFFFFFFFFFFFF
        if (before * 0x9E3779B97F4A7C15 >> 32 & 0xFFFFFFFF) % AVERAGE == 0 or i + 1 - start >= MOST:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def _bodies(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Number and bytes of the chunks that may be removed."""
    lines = data.split(b"\n")
    for n, (a, b) in enumerate(chunks(data)):
        body = b"\n".join(lines[a:b])
        if len(body.split()) >= MIN_WORDS:
            yield n, body


def _runs(words: list[int]) -> Iterator[tuple[int, int]]:
    """The shortest runs of more than RUN_WORDS words from each line and up to each line, but for those of long lines alone, which are chunks."""
    held = [i for i, n in enumerate(words) if n]
    total = [0, *accumulate(words[i] for i in held)]
    short = [0, *accumulate(words[i] < MIN_WORDS for i in held)]
    if not short[-1]:
        return
    end = 0
    for k in range(len(held)):
        while end < len(held) and total[end] - total[k] <= RUN_WORDS:
            end += 1
        if total[end] - total[k] <= RUN_WORDS:
            break
        if short[end] > short[k]:
            yield held[k], held[end - 1] + 1
    start = 0
    for end in range(1, len(held) + 1):
        while total[end] - total[start + 1] > RUN_WORDS:
            start += 1
        # Where the run from its first line is no shorter, it has been given.
        if total[end] - total[start] > RUN_WORDS >= total[end - 1] - total[start]:
            continue
        if total[end] - total[start] > RUN_WORDS and short[end] > short[start]:
            yield held[start], held[end - 1] + 1


def _pieces(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """First line, line after the last and bytes of the chunks and runs that may be removed."""
    lines = data.split(b"\n")
    words = [len(line.split()) for line in lines]
    at = [0, *accumulate(len(line) + 1 for line in lines)]
    given = {(a, b) for a, b in _cut(lines, words) if sum(words[a:b]) >= MIN_WORDS}
    given.update(_runs(words))
    for a, b in sorted(given):
        yield a, b, data[at[a] : at[b] - 1]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(row_hash(docs).alias("row_key"), F.col(f"`{text}`").cast("binary").alias("text"))


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def shared_bitmap(rows: DataFrame) -> dict[int, bytes]:
    """Bits of the hashes that occur more than once: at most 2^BITS of them, by bucket."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [xxhash.xxh64_intdigest(body, SEED) for t in batch.column(0).to_pylist() if t for *_, body in _pieces(t)]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(out))], names=["h"])

    again = rows.select("text").mapInArrow(hashes, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    place = again.select(F.col("h").bitwiseAND(F.lit((1 << BITS) - 1)).alias("place"))
    maps = place.groupBy(F.expr(f"place div {BITMAP}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits"))
    return {r.bucket: bytes(r.bits) for r in maps.toLocalIterator()}


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key and ``drop``, the lines (first, line after the last) that occur earlier, for each row that has such lines."""
    rows = _keyed(docs, text)
    bitmap = docs.sparkSession.sparkContext.broadcast(shared_bitmap(rows))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = bitmap.value
        for batch in batches:
            found, size = [], 0

            def given(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                keys, firsts, ends, bodies = zip(*found, strict=True)
                at = pa.array(keys, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(firsts, pa.int32()), pa.array(ends, pa.int32()), pa.array(bodies, pa.binary())],
                    names=["row_key", "doc_id", "a", "b", "body"],
                )

            for i, t in enumerate(batch.column(1)):
                for a, b, body in _pieces(t.as_py() or b""):
                    place = xxhash.xxh64_intdigest(body, SEED) & ((1 << BITS) - 1)
                    bits = maps.get(place // BITMAP)
                    if bits and bits[place % BITMAP // 8] >> (place % 8) & 1:
                        found.append((i, a, b, body))
                        size += len(body)
                        if size >= SENT:
                            yield given()
                            found, size = [], 0
            if found:
                yield given()

    ident = F.col(f"`{doc_id}`")
    given = docs.select(row_hash(docs).alias("row_key"), F.col(f"`{text}`").cast("binary").alias("text"), ident.alias("doc_id"))
    found = staged(given.mapInArrow(candidates, f"row_key bigint, doc_id {dict(docs.dtypes)[doc_id]}, a int, b int, body binary"), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key", "a")
    firsts = found.groupBy("body").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    # Written first, so that both sides of the join come straight from a shuffle: adaptive execution then splits a frequent line.
    firsts = staged(firsts, "first-chunks")
    # Bodies are repeated lines, far fewer bytes in a file than in memory: their file must not let Spark choose to broadcast them.
    later = found.join(firsts.hint("merge"), "body").where(place != F.col("first"))
    return later.groupBy("row_key").agg(F.collect_set(F.struct("a", "b")).alias("drop"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with repeated chunks and runs taken out of the text (and ``n_chars``, where there is one, adjusted).

    ``counts`` adds ``n_chunks``, ``dropped_chunks`` and ``dropped_words``.
    """
    drops = repeated(docs, doc_id, text).withColumnRenamed("row_key", "_line_key")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(row_hash(docs).alias("_line_key"), F.struct(*names).alias("_line_row")).join(drops, "_line_key", "left")
    body = F.col("_line_row")[text]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, changed, n_chunks, n_dropped, n_words = [], [], [], [], []
            for t, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = chunks(t) if t is not None and counts else []
                gone: set[int] = set()
                for piece in drop or ():
                    gone.update(range(piece["a"], piece["b"]))
                words = 0
                if gone:
                    lines = t.split(b"\n")
                    sizes = [len(line.split()) for line in lines]
                    words = sum(sizes[i] for i in gone)
                    held = [i for i, n in enumerate(sizes) if n]
                    for i, after in pairwise(held):
                        if i in gone and after in gone:
                            gone.update(range(i, after))
                    t = b"\n".join(line for i, line in enumerate(lines) if i not in gone)
                out.append(t)
                changed.append(bool(gone))
                n_chunks.append(len(parts))
                n_dropped.append(sum(gone.issuperset(range(a, b)) for a, b in parts) if gone else 0)
                n_words.append(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(changed, pa.bool_()), pa.array(n_chunks, pa.int32()), pa.array(n_dropped, pa.int32()), pa.array(n_words, pa.int64())],
                names=["row", "text", "changed", "n_chunks", "dropped_chunks", "dropped_words"],
            )

    others = F.struct(*[F.col("_line_row")[c].alias(c) for c in docs.columns if c != text] or [F.lit(0).alias("_none")])
    given = rows.select(others.alias("row"), body.cast("binary").alias("text"), "drop")
    kind = given.schema["row"].dataType.simpleString()
    new = given.mapInArrow(rebuild, f"row {kind}, text binary, changed boolean, n_chunks int, dropped_chunks int, dropped_words bigint")
    changed = F.col("changed")
    out: list[Column] = []
    for c, dtype in docs.dtypes:
        if counts and c in ("n_chunks", "dropped_chunks", "dropped_words"):
            continue
        value = F.col("text").cast("string") if c == text else F.col("row")[c]
        out.append((F.when(changed, F.length(F.col("text").cast("string")).cast(dtype)).otherwise(value) if c == "n_chars" else value).alias(c))
    return new.select(*out, *(["n_chunks", "dropped_chunks", "dropped_words"] if counts else []))
