"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions. A node of the tree is a context (the last ``d`` bytes, d from 0 to ``DEPTH``) with the
bits of the byte decided so far; it counts the zeros and ones that followed and predicts by the Krichevsky-Trofimov
rule, (ones + 1/2) / (all + 1). From the deepest contexts upwards each node weighs its own estimate against the product
of those below it, half and half in probability; the weights so found mix the estimates of all depths along a context.
A node that training never met leaves the prediction to the deepest one it did meet.

The unit of work is the distinct string of DEPTH + 1 bytes: counting, weighting and mixing are groupings and joins over
them. Texts are written once in chunks of some megabytes, as they are read, bucketed by chunk; a chunk lists its distinct
strings and words, in a table bucketed by them, where they are counted and joined with their values without another
shuffle; values, many to a row, then meet the texts of their chunk. Long texts are worked on in slices. Nothing whole is broadcast, so the tree may grow with the corpus.
Words that one chunk alone holds are counted there and not sent back.

Defined results: a null text is empty; A-Z are lower-cased; a text ends with the byte 0xFF, which UTF-8 never uses, and
starts after DEPTH of them. An empty text scores its end. A null doc_id is in training. Without training texts each bit
has probability 1/2. Repeated rows count each and get equal scores. Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import partitions
from sheetloom.session import scratch_path, staged

DEPTH = 5
#: Context bytes that the strings of a subtree share, and the strings that meet in a task, about.
TOP = 3
STRINGS = 400_000
#: Bytes of text and rows that a chunk holds at most; a single longer text is a chunk by itself.
CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 1 << 13
#: Bytes of text worked on at once inside a chunk.
SLICE = 2 << 20
#: Values that are sorted by chunk before they are sent, at most about.
PACK_ROWS, PACK_BYTES = 1 << 18, 32 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
END = 0xFF
HELD_OUT = (7, 2)


def log_gamma(x: Column) -> Column:
    """ln of the gamma function, for x of 0.5 or more: Stirling's series after six steps up."""
    z = x + 6
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _lower(data: bytes) -> bytes:
    return data.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def _slices(texts: list[bytes], depth: int, size: int) -> Iterator[list[tuple[int, bytes]]]:
    """Pieces of consecutive texts, some megabytes together: the number of the text, and bytes behind the depth ones before them.

    A text has depth bytes before it and its end behind it; one longer than a slice becomes several pieces.
    """
    part, held = [], 0
    for i, t in enumerate(texts):
        whole = bytes([END]) * depth + t + bytes([END])
        for at in range(0, len(t) + 1, size):
            part.append((i, whole[at : at + size + depth]))
            held += len(part[-1][1])
            if held >= size:
                yield part
                part, held = [], 0
    if part:
        yield part


def _strings(part: list[tuple[int, bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All strings of depth + 1 bytes that lie in a piece, as numbers, and how many each piece has."""
    data = np.frombuffer(b"".join(p for _, p in part), np.uint8)
    value = np.zeros(len(data) - depth, np.uint64)
    for k in range(depth + 1):
        value <<= np.uint64(8)
        value |= data[k : len(data) - depth + k]
    sizes = np.array([len(p) - depth for _, p in part])
    # Strings that reach from one piece into the next belong to neither.
    starts = np.cumsum(sizes + depth) - (sizes + depth)
    keep = np.ones(len(value), bool)
    for s, n in zip(starts[:-1], sizes[:-1], strict=True):
        keep[s + n : s + n + depth] = False
    return value[keep], sizes


def _words(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes of it at a time."""
    at = 0
    while len(text) - at > size and (gap := SPACE.search(text, at + size)):
        yield text[at : gap.start()].split()
        at = gap.end()
    yield text[at:].split()


def _eight(keys: np.ndarray) -> pa.Array:
    """Numbers as eight bytes, most significant first."""
    return pa.Array.from_buffers(pa.binary(8), len(keys), [None, pa.py_buffer(keys.astype(">u8").tobytes())]).cast(pa.binary())


def _listing(depth: int):
    """For a chunk: its distinct strings (kind 0) and words (kind 1) with the times they occur in training."""

    def distinct(table: pa.Table) -> pa.Table:
        texts = [_lower(t) for t in table.column("text").to_pylist()]
        train = table.column("train").to_pylist()
        keys, counts, words = [], [], {True: Counter(), False: Counter()}
        for learn in (True, False):
            mine = [t for t, w in zip(texts, train, strict=True) if w == learn]
            for part in _slices(mine, depth, SLICE):
                found, n = np.unique(_strings(part, depth)[0], return_counts=True)
                keys.append(found)
                counts.append(n * learn)
            for t in mine:
                for some in _words(t, SLICE):
                    words[learn].update(some)
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)
        names = [*words[True], *(w for w in words[False] if w not in words[True])]
        times = np.array([words[True][w] for w in names], np.int64)
        size = len(found) + len(names)
        return pa.table({
            "chunk": np.full(size, table.column("chunk")[0].as_py(), np.int64), "kind": np.repeat(np.array([0, 1], np.int8), [len(found), len(names)]),
            "key": pa.concat_arrays([_eight(found), pa.array(names, pa.binary())]), "n": np.concatenate((n, times)),
        })

    return distinct


def _log_beta(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones, as log_gamma() has it for columns."""

    def log_gamma_of(x: np.ndarray) -> np.ndarray:
        z = x + 6
        steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
        return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(steps)

    return log_gamma_of(zeros + 0.5) + log_gamma_of(ones + 0.5) - log_gamma_of(zeros + ones + 1) - math.log(math.pi)


def _bit(key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the last byte before bit k, behind a one, and bit k itself."""
    byte = key & 255
    return (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


def _parent(node: np.ndarray, d: int) -> np.ndarray:
    """The node of depth d - 1 above one of depth d: the byte that lies farthest back is dropped."""
    return node & ((1 << (8 * d)) - 1)


def _climb(key: np.ndarray, n: np.ndarray, k: int, depth: int, top: int) -> tuple[list[tuple], np.ndarray]:
    """Nodes for bit k from the deepest level up to ``top``: (node, zeros, ones, own, below) each, and the top's weighted value."""
    prefix, bit = _bit(key, k)
    nodes, at = np.unique(((key >> 8) << 8) | prefix, return_inverse=True)
    zeros, ones = np.bincount(at, n * (1 - bit), len(nodes)), np.bincount(at, n * bit, len(nodes))
    levels, below, weighted = [], None, np.zeros(0)
    for d in range(depth, top - 1, -1):
        own = _log_beta(zeros, ones)
        weighted = own if below is None else np.logaddexp(own, below) - math.log(2)
        levels.append((nodes, zeros, ones, own, own if below is None else below))
        if d > top:
            nodes, at = np.unique(_parent(nodes, d), return_inverse=True)
            zeros, ones, below = (np.bincount(at, x, len(nodes)) for x in (zeros, ones, weighted))
    return levels, weighted


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _tops(depth: int, top: int):
    """For strings that share their last ``top`` context bytes: the nodes of that depth, the subtrees below summed up."""

    def climb(table: pa.Table) -> pa.Table:
        key, n = _numbers(table, "key"), _numbers(table, "n")
        out = []
        for k in range(8):
            levels, weighted = _climb(key, n, k, depth, top)
            out.append((*levels[-1][:3], weighted))
        node, zeros, ones, weighted = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"node": node.astype(np.int64), "zeros": zeros.astype(float), "ones": ones.astype(float), "weighted": weighted})

    return climb


def _codes(depth: int, top: int):
    """For the same strings, and what lies above their top nodes: the log10 probability of the bits that the subtrees know.

    ``miss`` lists the other bits, whose nodes are above.
    """

    def descend(strings: pa.Table, above: pa.Table) -> pa.Table:
        key, n = _numbers(strings, "key"), _numbers(strings, "n")
        order = np.argsort(_numbers(above, "node"))
        top_node, top_said, top_left = (_numbers(above, c)[order] for c in ("node", "said", "left"))
        value, miss = np.zeros(len(key)), np.zeros((len(key), 8), bool)
        for k in range(8):
            levels, _ = _climb(key[n > 0], n[n > 0], k, depth, top)
            known, said, left = {}, None, None
            for d, (node, zeros, ones, own, below) in zip(range(top, depth + 1), reversed(levels), strict=True):
                if d == top:
                    at = np.searchsorted(top_node, node)
                    said, left = top_said[at], top_left[at]
                else:
                    at = np.searchsorted(known[d - 1][0], _parent(node, d))
                    said, left = said[at], left[at]
                kt = (ones + 0.5) / (zeros + ones + 1)
                weight = np.ones(len(node)) if d == depth else 1 / (1 + np.exp(np.minimum(below - own, 700.0)))
                known[d] = (node, said + left * kt)
                said, left = said + left * weight * kt, left * (1 - weight)
            prefix, bit = _bit(key, k)
            open_ = np.arange(len(key))
            for d in range(depth, top - 1, -1):
                node, one = known[d]
                asked = (((key[open_] >> 8) & ((1 << (8 * d)) - 1)) << 8) | prefix[open_]
                at = np.minimum(np.searchsorted(node, asked), max(0, len(node) - 1))
                hit = node[at] == asked if len(node) else np.zeros(len(asked), bool)
                chance = one[at[hit]]
                value[open_[hit]] += np.log10(np.where(bit[open_[hit]] == 1, chance, 1 - chance))
                open_ = open_[~hit]
            miss[open_, k] = True
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(miss.sum(1)))), pa.int32()), pa.array(np.nonzero(miss)[1], pa.int32()))
        return pa.table({"key": key, "value": value, "miss": lists})

    return descend


def code_lengths(strings: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``key`` and ``value``, the log10 probability of the last byte of a string after the others.

    ``strings`` has ``key`` (a string of depth + 1 bytes as a number) and ``n`` (times in training). Subtrees below contexts
    of TOP bytes lie in one task each: with DEPTH 5 such a context has 2^24 strings at most. Levels above are SQL.
    """
    top = min(TOP, depth)
    groups = max(1, -(-strings.count() // STRINGS))
    context = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << (8 * top)) - 1))
    dealt = strings.withColumn("part", F.pmod(F.xxhash64(context), F.lit(groups)).cast("int"))
    trained = dealt.where("n > 0").groupBy("part").applyInArrow(_tops(depth, top), "node bigint, zeros double, ones double, weighted double")
    level = staged(trained, f"tree-{top}")
    # Upwards: a node's own probability and that of the nodes below, half and half, added without leaving the logarithm.
    own = log_gamma(F.col("zeros") + 0.5) + log_gamma(F.col("ones") + 0.5) - log_gamma(F.col("zeros") + F.col("ones") + 1) - math.log(math.pi)
    levels = {top: level}
    for d in range(top - 1, -1, -1):
        parent = F.col("node").bitwiseAND(F.lit((1 << (8 * (d + 1))) - 1))
        level = level.groupBy(parent.alias("node")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        level = level.withColumn("own", own)
        high, low = F.greatest("own", "below"), F.least("own", "below")
        level = level.withColumn("weighted", high + F.log1p(F.exp(low - high)) - math.log(2))
        level = levels[d] = staged(level, f"tree-{d}")
    # Downwards: what the nodes above say, and the weight they leave to those below.
    kt = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    weight = 1 / (1 + F.exp(F.least(F.col("below") - F.col("own"), F.lit(700.0))))
    upper, down = None, None
    for d in range(top):
        level = levels[d].withColumn("kt", kt)
        if down is None:
            level = level.withColumn("said", F.lit(0.0)).withColumn("left", F.lit(1.0))
        else:
            level = _below(level, down, d)
        down = staged(level.select(
            "node", (F.col("said") + F.col("left") * F.col("kt")).alias("one"),
            (F.col("said") + F.col("left") * weight * F.col("kt")).alias("said"), (F.col("left") * (1 - weight)).alias("left"),
        ), f"mix-{d}")
        one = down.select(F.lit(d).alias("depth"), "node", "one")
        upper = one if upper is None else upper.unionByName(one)
    tops = levels[top].select("node")
    tops = _below(tops, down, top).select("node", "said", "left") if top else tops.select("node", F.lit(0.0).alias("said"), F.lit(1.0).alias("left"))
    tops = tops.withColumn("part", F.pmod(F.xxhash64(F.shiftrightunsigned("node", 8)), F.lit(groups)).cast("int"))
    coded = staged(dealt.groupBy("part").cogroup(tops.groupBy("part")).applyInArrow(_codes(depth, top), "key bigint, value double, miss array<int>"), "codes")
    # Bits that no subtree knows ask the levels above for the deepest node there is.
    prefix = F.expr("shiftright(key & 255, 8 - k) | shiftleft(1L, k)")
    bit = F.expr("shiftright(key & 255, 7 - k) & 1L")

    def node(d: int) -> Column:
        return F.shiftleft(F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << (8 * d)) - 1)), 8).bitwiseOR(F.col("prefix"))

    missed = coded.select("key", F.explode("miss").alias("k")).withColumn("prefix", prefix).withColumn("bit", bit)
    if top:
        asked = missed.select("key", "k", "bit", F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), node(d).alias("node")) for d in range(top)])).alias("s")).select("key", "k", "bit", "s.*")
        met = asked.join(upper, ["depth", "node"], "left").groupBy("key", "k", "bit").agg(F.max(F.when(F.col("one").isNotNull(), F.struct("depth", "one"))).alias("best"))
        found = F.coalesce(F.col("best.one"), F.lit(0.5))
    else:
        met, found = missed, F.lit(0.5)
    rest = met.groupBy("key").agg(F.sum(F.log10(F.when(F.col("bit") == 1, found).otherwise(1 - found))).alias("rest"))
    return coded.join(rest, "key", "left").select("key", (F.col("value") + F.coalesce("rest", F.lit(0.0))).alias("value"))


def _below(level: DataFrame, down: DataFrame, d: int) -> DataFrame:
    """Nodes of depth d with what the level above says and leaves."""
    above = down.select(F.col("node").alias("_up"), "said", "left")
    return level.join(above, F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1)) == F.col("_up"))


def _scoring(depth: int, base: int, ends: int):
    """For a chunk of texts and the values of its strings and words: the sums of each text.

    ``base``: what the count of a word plus one is divided by; ``ends``: how often the end was seen.
    """

    def score(texts: pa.Table, values: pa.Table) -> pa.Table:
        if not texts.num_rows:
            raise ValueError("values without their texts")
        kind = values.column("kind").to_numpy()

        def joined(column: str, of: int) -> bytes:
            return b"".join(values.column(column).filter(pa.array(kind == of)).to_pylist())

        grams = np.frombuffer(joined("keys", 0), ">u8").astype(np.uint64)
        order = np.argsort(grams)
        grams, chance = grams[order], np.frombuffer(joined("vals", 0), np.float64)[order]
        del order
        data = [_lower(t) for t in texts.column("text").to_pylist()]
        # Words that are nowhere else have their counts here.
        counts: Counter = Counter()
        for t, learn in zip(data, texts.column("train").to_pylist(), strict=True):
            if learn:
                for some in _words(t, SLICE):
                    counts.update(some)
        for word, count in zip(joined("keys", 1).split(), np.frombuffer(joined("vals", 1), np.float64).tolist(), strict=True):
            counts[word] = int(count)
        unseen, end = math.log10(1 / base), math.log10((ends + 1) / base)
        # Counts become logarithms in place: a second table of words would take as much memory again.
        logs = counts
        for word, count in logs.items():
            logs[word] = math.log10((count + 1) / base)
        # A direct table finds most strings in one step; those that share a place are searched for.
        bits = max(10, len(grams).bit_length() + 2)
        factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
        table = np.zeros(1 << bits, np.int32)
        table[(grams * factor) >> shift] = np.arange(len(grams), dtype=np.int32)
        sums = np.zeros(len(data))
        for part in _slices(data, depth, SLICE):
            asked, sizes = _strings(part, depth)
            at = table[(asked * factor) >> shift]
            wrong = np.flatnonzero(grams[at] != asked)
            at[wrong] = np.searchsorted(grams, asked[wrong])
            np.add.at(sums, [i for i, _ in part], np.add.reduceat(chance[at], np.cumsum(sizes) - sizes))
        words = []
        for t in data:
            n, known, total = 1, int(ends > 0), [end]
            for some in _words(t, SLICE):
                found = [logs.get(w, unseen) for w in some]
                n, known = n + len(found), known + sum(x > unseen for x in found)
                total.append(math.fsum(found))
            words.append((n, known, math.fsum(total)))
        n_tokens, n_known, base_scores = zip(*words, strict=True)
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": pc.invert(texts.column("train")), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base_scores, pa.float64()), "score": pa.array(sums),
        })

    return score


def _packed(known: DataFrame, kind: int, space: bytes) -> DataFrame:
    """``chunk``, ``kind``, ``keys`` and ``vals``: of some hundred thousand rows (chunk, key, value), those of a chunk in one row.

    Keys stand one after the other, each with ``space`` behind it, values as eight bytes each. A task that puts the values
    of a chunk in order then handles few wide rows.
    """

    def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        rows = rows.take(pa.array(np.argsort(rows.column("chunk").to_numpy(), kind="stable")))
        chunk, key = rows.column("chunk").to_numpy(), rows.column("key").combine_chunks()
        if space:
            key = pc.binary_join_element_wise(key, pa.scalar(space, pa.binary()), pa.scalar(b"", pa.binary()))
        edges = np.concatenate(([0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(chunk)]))
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(key).to_numpy())))[edges]

        def wide(offsets: np.ndarray, data: bytes) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data)])

        return pa.RecordBatch.from_arrays(
            [pa.array(chunk[edges[:-1]]), pa.array(np.full(len(edges) - 1, kind, np.int8)), wide(ends, b"".join(key.to_pylist())), wide(edges * 8, rows.column("value").to_numpy().tobytes())],
            names=["chunk", "kind", "keys", "vals"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= PACK_ROWS or size >= PACK_BYTES:
                yield packs(held)
                held, rows, size = [], 0, 0
        if held:
            yield packs(held)

    return known.select("chunk", "key", "value").mapInArrow(pack, "chunk bigint, kind byte, keys binary, vals binary")


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """The table written once, bucketed by ``key``: grouping by it or joining on it then takes no shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, key)
    name = "ctw_" + path.rpartition("-")[2]
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(partitions(spark), key).saveAsTable(name)
    return spark.table(name)


def _chunk(text: str, most_bytes: int, most_rows: int) -> Column:
    """Number of the chunk that a row belongs to: a run of rows of one task, bounded in bytes and rows. Only lengths go to Python."""

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, rows, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            out = []
            for n in batch.to_pylist():
                if rows and (rows == most_rows or size + n > most_bytes):
                    at, rows, size = at + 1, 0, 0
                rows, size = rows + 1, size + n
                out.append(at)
            yield pa.array(out, pa.int64())

    return F.arrow_udf(number, "bigint").asNondeterministic()(F.octet_length(text))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    spark = docs.sparkSession
    ident = F.col(f"`{doc_id}`")
    out = F.coalesce(F.crc32(ident.cast("string")) % held_out[0] == held_out[1], F.lit(False))
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(ident.alias("doc_id"), (~out).alias("train"), body.alias("text"))
    size, ends = rows.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    # A chunk is a run of rows of one task, so the texts are written without a shuffle; nothing hangs on where a row is.
    chunk = _chunk("text", CHUNK_BYTES, CHUNK_ROWS)
    dealt = _bucketed(rows.coalesce(max(1, -(-(size or 0) // CHUNK_BYTES))).withColumn("chunk", chunk), "chunk")
    listed = dealt.select("chunk", "train", "text").groupBy("chunk").applyInArrow(_listing(depth), "chunk bigint, kind byte, key binary, n bigint")
    listed = _bucketed(listed.repartition(partitions(spark), "key"), "key")
    counted = listed.groupBy("key", "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("chunks"))
    words = counted.where("kind = 1")
    total, distinct = words.where("n > 0").agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = int(total or 0) + ends, distinct + (ends > 0)
    number = F.conv(F.hex("key"), 16, 10).cast("long")
    strings = staged(counted.where("kind = 0").select(number.alias("key"), "n"), "string-counts")
    lengths = code_lengths(strings, depth)
    codes = lengths.select(F.unhex(F.lpad(F.hex("key"), 16, "0")).alias("key"), "value")
    shared = words.where("chunks > 1").select("key", F.col("n").cast("double").alias("value"))
    asked = listed.select("chunk", "kind", "key")
    known = _packed(asked.where("kind = 0").join(codes, "key"), 0, b"").unionByName(_packed(asked.where("kind = 1").join(shared, "key"), 1, b" "))
    kind = dict(rows.dtypes)["doc_id"]
    result = dealt.select("chunk", "doc_id", "train", "text").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _scoring(depth, total + distinct + 1, ends), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
