"""Near-duplicates by 64-bit SimHash fingerprints, joined on a grid of segment bit counts.

A fingerprint becomes the vector of the bit counts of its 32 two-bit segments. The Manhattan distance of two vectors
never exceeds the Hamming distance of the fingerprints. The segments form ``groups`` groups; fingerprints within
``distance`` differ in at most that many of them, so they share the exact counts of all segments of some
groups - distance groups: a cell of the grid. Distinct fingerprints meet in these cells and are then compared exactly.
Cells with more than ``CHUNK`` members are cut into chunks that meet pairwise, and of the links found between two
chunks a spanning forest is handed on, so families of near copies cost no quadratic number of rows.

Defined results: A-Z are lower-cased; words are separated by the ASCII space characters; a text with fewer words than a
shingle is one shingle, and a text without words (null, too) has fingerprint 0, linked like any other; repeated rows each
get a row; null doc_ids are never the id of a component that has another id. Empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import row_hash
from sheetloom.llm.components import components
from sheetloom.session import staged

WORDS = 4
SEED = 42
DISTANCE = 4
# More groups make the cells more selective, at more rows a fingerprint: 70 cells each for 8. The result does not depend on it.
GROUPS = 8
CHUNK = 512
# Fingerprints whose cells a task makes and counts, and the most tasks for that; beyond those, counting spills.
TASK_ROWS, MOST_TASKS = 1 << 14, 1 << 15
# Shingles whose bits are counted at once.
SLICE = 1 << 16


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    parts = data.translate(lower).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = [n + i for i, n in enumerate(accumulate(map(len, parts)))]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    width = min(words, len(parts))
    n = len(parts) - width + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        stop = min(n, at + SLICE)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[at:stop], ends[at + width - 1 : stop + width - 1], strict=True)), np.uint64, stop - at)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", *keep: Column) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or b"") for t in batch.column(0).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps)], names=[*batch.schema.names[1:], "fp"])

    given = docs.select(F.col(f"`{text}`").cast("binary").alias("_text"), *keep)
    fields = ", ".join(f"`{n}` {k}" for n, k in given.dtypes[1:])
    return given.mapInArrow(compute, f"{fields}, fp bigint")


def _cells(distance: int, groups: int) -> list[int]:
    """Masks over the 32 two-bit counts, one for each choice of groups - distance groups."""
    edges = [round(32 * g / groups) for g in range(groups + 1)]
    masks = [sum(3 << (2 * s) for s in range(edges[g], edges[g + 1])) for g in range(groups)]
    return [sum(masks[g] for g in some) for some in combinations(range(groups), groups - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the given ones connect, fewer than nodes: each node to the least of its component."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_links(fps: DataFrame, distance: int = DISTANCE, groups: int = GROUPS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` that connect all those within ``distance`` bits of each other.

    Two are linked, directly or over others, exactly if steps of at most ``distance`` bits lead from one to the other.
    """
    # Both bits of a segment give a count of two, one of them a count of one.
    next_, low = F.shiftrightunsigned("fp", 1), F.lit(0x5555555555555555)
    pair = F.shiftleft(F.col("fp").bitwiseAND(next_).bitwiseAND(low), 1).bitwiseOR(F.col("fp").bitwiseXOR(next_).bitwiseAND(low))
    masks = _cells(distance, groups)
    cells = F.array(*[F.struct(F.lit(i).cast("short").alias("c"), F.col("_counts").bitwiseAND(F.lit(_signed(m))).alias("at")) for i, m in enumerate(masks)])
    # A table of fingerprints is small in bytes, so few tasks would read it, but each row becomes as many as there are masks.
    spread = fps.repartition(min(MOST_TASKS, fps.count() // TASK_ROWS + 1), "fp")
    rows = spread.select("fp", pair.alias("_counts")).select("fp", F.explode(cells).alias("k")).select(F.col("k.c").alias("c"), F.col("k.at").alias("at"), "fp")
    shared = rows.groupBy("c", "at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.expr(f"(n + {chunk - 1}) div {chunk}")
    # Spark sizes what an explosion makes as if each row stayed one, so it must not choose to broadcast such tables.
    held = rows.join(shared.hint("merge"), ["c", "at"]).withColumn("parts", parts).withColumn("part", F.expr("pmod(xxhash64(fp), parts)"))
    chunks = staged(held.groupBy("c", "at", "parts", "part").agg(F.collect_list("fp").alias("left")), "cells")
    alone = chunks.select("left", F.lit(None).cast("array<bigint>").alias("right"))
    wide = chunks.where("parts > 1")
    others = wide.select("c", "at", F.col("part").alias("to"), F.col("left").alias("right"))
    meets = wide.where("part + 1 < parts").withColumn("to", F.explode(F.expr("sequence(part + 1, parts - 1)"))).join(others.hint("merge"), ["c", "at", "to"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(x: np.ndarray, y: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            other = x if y is None else y
            i, j = np.nonzero(np.bitwise_count(x.view(np.uint64)[:, None] ^ other.view(np.uint64)[None, :]) <= distance)
            if y is None:
                i, j = i[i < j], j[i < j]
            a, b = x[i], other[j]
            return _forest(a, b) if len(a) >= len(x) + len(other) * (y is not None) else (a, b)

        for batch in batches:
            out = []
            left, right = batch.column(0), batch.column(1)
            offsets, values = left.offsets.to_numpy(), left.values.to_numpy()
            sizes = np.diff(offsets)
            small = (sizes == 2) & right.is_null().to_numpy(zero_copy_only=False)
            x, y = values[offsets[:-1][small]], values[offsets[:-1][small] + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
            out.append((x[near], y[near]))
            for i in np.flatnonzero(~small):
                out.append(links(values[offsets[i] : offsets[i + 1]], right[i].values.to_numpy() if right[i].is_valid else None))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)], names=["a", "b"])

    return alone.unionByName(meets.select("left", "right")).mapInArrow(compare, "a bigint, b bigint")


def labelled(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rows`` (with doc_id and fp) and ``component_id``: the least doc_id of the component of fp."""
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(near_links(fps.select("fp"), distance))
    linked = roots.union(roots.select("root", "root").distinct())
    # These follow the documents, and a file is a fraction of what it becomes in memory.
    named = linked.join(fps.withColumnRenamed("fp", "node").hint("merge"), "node")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    moved = linked.join(least, "root").select(F.col("node").alias("fp"), "least")
    # Written first, so that both sides of the join come straight from a shuffle: adaptive execution then splits a frequent fingerprint.
    known = staged(fps.join(moved, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "component-ids")
    return rows.join(known.hint("merge"), "fp")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each row."""
    rows = staged(fingerprints(docs, text, F.col(f"`{doc_id}`").alias("doc_id")), "simhash")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return labelled(rows, distance).select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the one with the least doc_id, then the least row hash."""
    keyed = row_hash(docs)
    rows = staged(fingerprints(docs, text, F.col(f"`{doc_id}`").alias("doc_id"), keyed.alias("row_key")), "simhash")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    # A component without any id is its own by fingerprint; the key tells it from the others.
    found = labelled(rows, distance)
    stay = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("_own")).agg(F.min(order).alias("o"))
    keys = stay.select(F.col("o.row_key").alias("_stay_key"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.select(keyed.alias("_stay_key"), F.struct(*names).alias("_stay_row")).join(keys, "_stay_key")
    return kept.dropDuplicates(["_stay_key"]).select(*[F.col("_stay_row")[c].alias(c) for c in docs.columns])
