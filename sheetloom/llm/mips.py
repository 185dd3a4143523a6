"""Exact top-k search by inner product over vectors in order of length.

Candidates are range partitioned by descending length and packed into blocks of ``BLOCK`` rows, as whole numbers of as few
bytes as hold them; queries are packed alike. Where blocks meet they are rotated onto the axes of the candidates'
second-moment matrix (by singular value decomposition, so the first coordinates carry most of every product). A first pass over the longest blocks gives each query a score that its k-th result must reach.
A query block then meets only the blocks long enough to reach it, and inside a block candidates are left out once
the Cauchy-Schwarz bound (the product over the first coordinates plus that of the lengths of the rest) falls short.
What remains is scored in whole numbers, so results are exact.

Defined results: components become floor(scale * x). Vectors that are null or hold a null or non-finite component take no
part, either way; shorter vectors count as filled with zeros; vectors with components too large for exact 64-bit sums are
refused with an error. A candidate that has the query's own id is not one; repeated query rows count once; repeated
candidate rows each take a rank. Ties go to the smaller id, null ids last. Empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import partitions
from sheetloom.session import staged

SCALE = 1024
BLOCK = 4096
QUERIES = 512
# Share of the coordinates in the first sum.
HEAD = 0.25

# Pairs of blocks that one task compares, on average.
TASK_PAIRS = 128
# All products of a slice of a block are taken at once if more than one in so many is left.
MANY = 16

BLOCK_SCHEMA = "part int, nth int, top double, ids binary, nulls binary, ints binary"


def _narrow(ints: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each that hold them all: a block is sent once for each block that it meets."""
    low, high = ints.min(initial=0), ints.max(initial=0)
    kind = next((k for k in (np.int16, np.int32) if np.iinfo(k).min <= low and high <= np.iinfo(k).max), np.int64)
    return ints.astype(kind).tobytes()


def _wide(blob: bytes, count: int, dims: int) -> np.ndarray:
    """The vectors of ``_narrow``."""
    return np.frombuffer(blob, f"i{len(blob) // (count * dims)}").reshape(count, dims).astype(np.int64)


def _turned(ints: np.ndarray, axes: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors on the axes, their lengths, and the lengths of what comes after the first ``head`` coordinates."""
    turned = ints @ axes
    return turned, np.sqrt((turned**2).sum(1)), np.sqrt((turned[:, head:] ** 2).sum(1))


def whole_vectors(df: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer vector ``v`` of each row that takes part."""
    given = F.col(f"`{vector}`").cast("array<double>")
    sound = given.isNotNull() & F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), given.alias("g")).where(sound)
    rows = rows.select("vec_id", F.transform("g", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    return rows.withColumn("length2", F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x))


def _ints(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch, filled with zeros."""
    lists = batch.column("v")
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def second_moments(rows: DataFrame, dims: int) -> np.ndarray:
    """Sum of v v' over all rows: one dims x dims matrix per task, added up by Spark."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _ints(batch, dims).astype(float)
            total += x.T @ x
        i, j = np.divmod(np.arange(dims * dims, dtype=np.int32), dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "x"])

    out = np.zeros((dims, dims))
    for i, j, x in rows.select("v").mapInArrow(sums, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x")).collect():
        out[i, j] = x
    return out


def packed(rows: DataFrame, dims: int, block: int, extra_part: Column) -> DataFrame:
    """Rows, sorted by descending length inside their partitions, as blocks of integer vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, nth = 0, 0

        def out(n: int) -> pa.RecordBatch:
            nonlocal held, nth
            ids, nulls, ints = (np.concatenate(x) for x in zip(*held, strict=True))
            held = [(ids[n:], nulls[n:], ints[n:])]
            ids, nulls, ints = ids[:n], nulls[:n], ints[:n]
            top = float(np.sqrt((ints.astype(float) ** 2).sum(1)).max(initial=0))
            values = [[part], [nth], [top], [ids.tobytes()], [nulls.tobytes()], [_narrow(ints)]]
            kinds = [pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 3]
            nth += 1
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "nth", "top", "ids", "nulls", "ints"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ids = batch.column("vec_id")
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False), _ints(batch, dims)))
            while sum(len(x[0]) for x in held) >= block:
                yield out(block)
        if held and sum(len(x[0]) for x in held):
            yield out(block)

    return rows.withColumn("part", extra_part).select("part", "vec_id", "v").mapInArrow(pack, BLOCK_SCHEMA)


def _meet(batches: Iterator[pa.RecordBatch], axes: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Best k of each query against the candidates of one block, for each row of two packed blocks."""
    dims = len(axes)
    head = max(1, int(dims * HEAD))
    held, ci, ct, c_len, c_rest = None, *[np.zeros(0)] * 4
    for batch in batches:
        rows = batch.to_pydict()
        out: list[tuple[np.ndarray, ...]] = []
        for q_ids, q_ints, floors, ids, nulls, ints in zip(*(rows[c] for c in ("q_ids", "q_ints", "floors", "ids", "nulls", "ints")), strict=True):
            qid, cid, gone = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(nulls, bool)
            qi = _wide(q_ints, len(qid), dims)
            qt, q_len, q_rest = _turned(qi, axes, head)
            # The rows of a block of candidates come one after the other.
            if (len(cid), ints) != held:
                held, ci = (len(cid), ints), _wide(ints, len(cid), dims)
                ct, c_len, c_rest = _turned(ci, axes, head)
            need = np.frombuffer(floors, float).copy() if floors else np.full(len(qid), -np.inf)
            for at in range(0, len(cid), 512):
                part = slice(at, at + 512)
                # Lengths fall, so the first one bounds all that follow.
                open_ = np.flatnonzero(q_len * c_len[at] * (1 + 1e-9) + 1e-6 >= need)
                if not len(open_):
                    break
                bound = qt[open_, :head] @ ct[part, :head].T
                bound += q_rest[open_, None] * c_rest[None, part]
                slack = 1e-9 * q_len[open_, None] * c_len[None, part] + 1e-6
                left = bound + slack >= need[open_, None]
                # Sums below 2^53 are exact in doubles as well, where all products at once are quicker than many one by one.
                if q_len.max() * c_len[at] < 2.0**52 and np.count_nonzero(left) * MANY > left.size:
                    score = qi[open_].astype(float) @ ci[part].T.astype(float)
                    left &= score >= need[open_, None]
                    score = score[left].astype(np.int64)
                    a, b = np.nonzero(left)
                    a, b = open_[a], b + at
                else:
                    a, b = np.nonzero(left)
                    a, b = open_[a], b + at
                    score = np.concatenate([(qi[a[i : i + 65536]] * ci[b[i : i + 65536]]).sum(1) for i in range(0, len(a), 65536)] or [np.zeros(0, np.int64)])
                good = (score >= need[a]) & ((qid[a] != cid[b]) | gone[b])
                a, b, score = a[good], b[good], score[good]
                out.append((qid[a], cid[b], gone[b], score))
                # The k-th score so far is a floor for the rest of the block.
                order = np.lexsort((-score, a))
                first = np.searchsorted(a[order], np.arange(len(qid)))
                kth = first + k - 1
                ok = np.flatnonzero((kth < len(order)) & (np.append(a[order], -1)[np.minimum(kth, len(order))] == np.arange(len(qid))))
                need[ok] = np.maximum(need[ok], score[order][kth[ok]])
        if out:
            q, c, gone, score = (np.concatenate(x) for x in zip(*out, strict=True))
            order = np.lexsort((c, gone, -score, q))
            q, c, gone, score = q[order], c[order], gone[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, c, gone, score = (x[rank < k] for x in (q, c, gone, score))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c, mask=gone), pa.array(score)], names=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates with the largest inner product with each query."""
    spark = candidates.sparkSession
    rows, asked = staged(whole_vectors(candidates, id_col, vector, scale), "vectors"), whole_vectors(queries, id_col, vector, scale)
    count, dims, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("length2")).first()
    dims = max(dims or 0, asked.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    if (longest or 0) >= 2.0**62:
        raise ValueError("components are too large for exact sums")
    axes = np.linalg.svd(second_moments(rows, dims))[0]
    parts = max(1, min(partitions(spark), -(-count // BLOCK)), -(-count // (16 * BLOCK)))
    sorted_rows = rows.repartitionByRange(parts, F.col("length2").desc(), F.xxhash64("vec_id", "v")).sortWithinPartitions(F.col("length2").desc())
    blocks = staged(packed(sorted_rows, dims, BLOCK, F.spark_partition_id()), "vector-blocks")
    wanted = asked.where("vec_id is not null").distinct()
    groups = max(1, -(-wanted.count() // QUERIES))
    dealt = wanted.repartition(groups).sortWithinPartitions(F.col("length2").desc())
    asking = staged(packed(dealt, dims, QUERIES, F.spark_partition_id()), "query-blocks").select(
        F.col("part").alias("q_part"), F.col("nth").alias("q_nth"), F.col("top").alias("q_top"), F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints")
    )
    result = "query_id long, vec_id long, score long"
    # The longest block of all partitions gives each query its first floor.
    first = blocks.agg(F.max_by(F.struct("part", "nth"), "top").alias("first")).first()
    if first is None or first[0] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = F.broadcast(blocks.where((F.col("part") == first[0][0]) & (F.col("nth") == first[0][1])).select("ids", "nulls", "ints"))
    seed = asking.withColumn("floors", F.lit(None).cast("binary")).withColumn("_one", F.lit(1)).join(top.withColumn("_one", F.lit(1)), "_one").drop("_one")
    floors = _best(seed.mapInArrow(lambda b: _meet(b, axes, k), result), k).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))

    def with_floors(key, left: pa.Table, right: pa.Table) -> pa.Table:
        known = dict(zip(right.column("query_id").to_pylist(), right.column("floor").to_pylist(), strict=True))
        out = []
        for row in left.to_pylist():
            out.append(np.array([known.get(i, -np.inf) for i in np.frombuffer(row["q_ids"], np.int64)]).tobytes())
        return left.append_column("floors", pa.array(out, pa.binary()))

    # A query block has QUERIES rows at most, so the floors of a block are few.
    place = asking.select(F.col("q_part").alias("part"), F.col("q_nth").alias("nth"), F.explode(_unpacked(F.col("q_ids"), "bigint")).alias("query_id"))
    known = place.join(floors, "query_id")
    armed = asking.groupBy("q_part", "q_nth").cogroup(known.groupBy("part", "nth")).applyInArrow(
        with_floors, "q_part int, q_nth int, q_top double, q_ids binary, q_ints binary, floors binary"
    )
    armed = staged(armed.withColumn("least", F.array_min(_unpacked(F.col("floors"), "double"))), "query-floors")
    least = F.col("least")
    # Number and length of the blocks of a partition: as many entries as there are partitions.
    shape = blocks.groupBy("part").agg(F.max("nth").alias("last"), F.max("top").alias("longest")).collect()
    entries = F.array(*[F.struct(F.lit(r.part).alias("part"), F.lit(r.last).alias("last"), F.lit(r.longest).alias("longest")) for r in shape])
    near = F.filter(entries, lambda e: F.col("q_top") * e["longest"] * (1 + 1e-9) + 1e-6 >= least)
    reach = armed.withColumn("_near", F.explode(near)).select("*", F.col("_near.part").alias("part"), F.explode(F.sequence(F.lit(0), F.col("_near.last"))).alias("nth")).drop("_near")
    # Neither side may be sent to all machines by way of the driver: Spark takes the queries for as many as they were before
    # they were repeated for each block. Bytes tell nothing about the work either, so tasks follow the pairs.
    tasks = max(partitions(spark), groups * (sum(r.last + 1 for r in shape) // TASK_PAIRS + 1))
    met_at = ["part", "nth"]
    pairs = reach.repartition(tasks, *met_at).join(blocks.repartition(tasks, *met_at).hint("merge"), met_at)
    pairs = pairs.where(F.col("q_top") * F.col("top") * (1 + 1e-9) + 1e-6 >= least)
    met = pairs.select("q_ids", "q_ints", "floors", "ids", "nulls", "ints").mapInArrow(lambda b: _meet(b, axes, k), result)
    return _best(met, k).select("query_id", "rank", "vec_id", "score")



def _unpacked(blob: Column, kind: str) -> Column:
    """The numbers of a packed column, as an array of bigint or double."""

    @F.pandas_udf(f"array<{kind}>")
    def numbers(blob):
        return blob.map(lambda b: np.frombuffer(b, np.int64 if kind == "bigint" else float))

    return numbers(blob)
