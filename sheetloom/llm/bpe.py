"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

The JVM cuts texts into words by the tokenizer's pattern. Words that make up at least ``SHARE`` of all words (so there
are at most 1 / SHARE of them) are encoded once each by Spark's higher-order functions, which fold the ranked merges over
the byte pieces of a word with a constant rank table, and are broadcast. Tasks encode the distinct words of a batch: from
that table, or, if they are rarer or longer, by the same merges in Python; ids are then laid out with numpy.
Decoding is native: pieces from a constant table, joined.

Defined results: a null text is empty and has no tokens; texts with U+FFFD or any other character are encoded by their
UTF-8 bytes; equal rows give equal rows; ``encode`` keeps columns besides the text as they are, but replaces those named
like its own. Empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.session import staged

SHARE = 2.0**-18
# Bytes of the longest word that the broadcast table holds; with SHARE this bounds its size.
LONGEST = 64
BUCKETS = 1 << 16
RANKS, PIECES = "array<array<struct<p:binary,r:int>>>", "array<binary>"


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a line of base64 and rank for each piece. It is read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def words_of(text: Column, pattern: str) -> Column:
    """Matches of the pattern; with (?U) Java takes classes as Unicode does."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?U){pattern}"), F.lit(0))


def _rank_lists(ranks: dict[bytes, int]) -> str:
    """The rank map as an array of BUCKETS short lists, since Spark's own map is searched from end to end."""
    lists: list[list[dict]] = [[] for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        lists[xxhash.xxh64_intdigest(piece, 42) % BUCKETS].append({"p": base64.b64encode(piece).decode(), "r": rank})
    return json.dumps(lists)


def _piece_list(ranks: dict[bytes, int]) -> str:
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return json.dumps([base64.b64encode(p).decode() for p in pieces])


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal."""
    return F.from_json(F.lit(_rank_lists(ranks)), RANKS)


def with_table(df: DataFrame, table: str, kind: str, name: str) -> DataFrame:
    """A column that holds a JSON table of this kind, the same in each row.

    It is the value of a subquery. The driver keeps descriptions of the plans that it ran, and a literal is written out
    in each of them, at its full length. Select what is made of the column at once: the optimiser then puts the
    table in the place of its one use, and no row carries it.
    """
    one = df.sparkSession.createDataFrame([(table,)], "json string").select(F.from_json("json", kind).alias("table"))
    return df.select("*", one.scalar().alias(name))


def _rank(table: Column, piece: Column) -> Column:
    # The low bits of a hash are the same whether it is read with a sign or without.
    bucket = F.element_at(table, (F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)) + 1).cast("int"))
    return F.get(F.transform(F.filter(bucket, lambda e: e["p"] == piece), lambda e: e["r"]), F.lit(0))


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of a word: start from its bytes and merge the pair of least rank, the first one if several, until none is left."""
    byte = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(word, i, F.lit(1)))
    pairs = F.when(F.octet_length(word) > 1, F.transform(F.sequence(F.lit(1), F.octet_length(word) - 1), lambda i: _rank(table, F.substring(word, i, F.lit(2))))).otherwise(F.array().cast("array<int>"))
    start = F.struct(byte.alias("p"), pairs.alias("r"))

    def merge(state: Column, _i: Column) -> Column:
        pieces, rates = state["p"], state["r"]
        # The place of the best pair; the array of one element gives the expression a name.
        best = F.array(F.array_position(rates, F.array_min(rates)).cast("int"))

        def at(j: Column) -> Column:
            joined = F.array(F.concat(F.element_at(pieces, j), F.element_at(pieces, j + 1)))

            def around(new: Column) -> Column:
                left = F.when(j > 1, F.array(_rank(table, F.concat(F.get(pieces, j - 2), new)))).otherwise(F.array().cast("array<int>"))
                right = F.when(j + 1 < F.size(pieces), F.array(_rank(table, F.concat(new, F.get(pieces, j + 1))))).otherwise(F.array().cast("array<int>"))
                rates_now = F.concat(F.slice(rates, 1, F.greatest(j - 2, F.lit(0))), left, right, F.slice(rates, j + 2, F.size(rates)))
                return F.struct(F.concat(F.slice(pieces, 1, j - 1), F.array(new), F.slice(pieces, j + 2, F.size(pieces))).alias("p"), rates_now.alias("r"))

            return F.get(F.transform(joined, around), F.lit(0))

        return F.when(F.array_min(rates).isNull(), state).otherwise(F.get(F.transform(best, at), F.lit(0)))

    folded = F.aggregate(F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2))), start, merge, lambda s: s["p"])
    whole = _rank(table, word)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, lambda p: _rank(table, p)))


def folded_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``word`` (binary) and its ``ids``."""
    # An array of one element binds the table, so that the plan holds it once and not at each look-up.
    folded = F.get(F.transform(F.array("_ranks"), lambda table: fold_merges(F.col("word"), table)), F.lit(0))
    return with_table(words.select("word"), _rank_lists(ranks), RANKS, "_ranks").select("word", folded.alias("ids"))


def frequent_words(docs: DataFrame, text: str, pattern: str, ranks: dict[bytes, int], share: float = SHARE) -> dict[bytes, bytes]:
    """Ids (as little-endian bytes) of the words that make up ``share`` of all words or more: at most 1 / share."""
    words = docs.select(F.explode(words_of(F.col(f"`{text}`"), pattern)).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counted.select(F.col("word").cast("binary").alias("word"), "n"), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where((F.col("n") >= F.lit(share * total)) & (F.octet_length("word") <= LONGEST)).select("word")
    ids = folded_words(often, ranks)
    return {bytes(r.word): np.array(r.ids, "<u4").tobytes() for r in ids.toLocalIterator()}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word of any length: the pair of least rank is merged first, the left one of equals."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    if n <= LONGEST:
        pieces = [word[i : i + 1] for i in range(n)]
        rates = [ranks.get(word[i : i + 2], 1 << 30) for i in range(n - 1)]
        while rates and (best := min(rates)) < 1 << 30:
            j = rates.index(best)
            pieces[j : j + 2] = [pieces[j] + pieces[j + 1]]
            del rates[j]
            if j:
                rates[j - 1] = ranks.get(pieces[j - 1] + pieces[j], 1 << 30)
            if j < len(rates):
                rates[j] = ranks.get(pieces[j] + pieces[j + 1], 1 << 30)
        return [ranks[p] for p in pieces]
    # A heap of pairs over linked pieces keeps very long words from taking quadratic time.
    ends, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = ends[i]
        if middle < 0 or middle >= n or ends[middle] != end:
            continue
        ends[i], ends[middle] = end, -1
        if end < n:
            before[end] = i
            if (r := ranks.get(word[i : ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = ends[i]
    return out


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", share: float = SHARE) -> DataFrame:
    """All columns of ``docs`` but the text, then ``ids`` (array), ``n_tokens`` and ``ids_sha256`` (of 32-bit little-endian ids)."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast((frequent_words(docs, text, pattern, ranks, share), ranks))
    rest = [c for c in docs.columns if c not in (text, "ids", "n_tokens", "ids_sha256")]
    cut = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_none")]).alias("_row"), words_of(F.col(f"`{text}`"), pattern).alias("_words"))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, by_piece = known.value
        own: dict[bytes, bytes] = {}
        for batch in batches:
            # A few documents at a time, so that memory follows the texts and not the batch.
            offsets = batch.column(1).offsets.to_numpy()
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 1_000_000, "right")) - 1)
                part = batch.slice(at, stop - at)
                at = stop
                lists = part.column(1)
                coded = lists.flatten().dictionary_encode()
                pieces = []
                for word in coded.dictionary.cast(pa.binary()).to_pylist():
                    ids = table.get(word) or own.get(word)
                    if ids is None:
                        ids = np.array(merged(word, by_piece), "<u4").tobytes()
                        if len(own) >= 400_000:
                            own.clear()
                        if len(word) <= LONGEST:
                            own[word] = ids
                    pieces.append(ids)
                flat = np.frombuffer(b"".join(pieces), "<u4")
                sizes = np.array([len(p) // 4 for p in pieces], np.int64)
                starts = np.cumsum(sizes) - sizes
                index = coded.indices.to_numpy(zero_copy_only=False)
                n = sizes[index]
                ends = np.cumsum(n)
                ids = flat[np.repeat(starts[index] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)] if len(n) else flat[:0]
                edges = np.concatenate(([0], ends))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
                blob = memoryview(np.ascontiguousarray(ids)).cast("B")
                shas = [hashlib.sha256(blob[4 * a : 4 * b]).hexdigest() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                arrays = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), arrays, pa.array(np.diff(edges)), pa.array(shas)], names=["_row", "ids", "n_tokens", "ids_sha256"])

    kind = cut.schema["_row"].dataType.simpleString()
    out = cut.mapInArrow(lay_out, f"_row {kind}, ids array<int>, n_tokens bigint, ids_sha256 string")
    return out.select(*[F.col("_row")[c].alias(c) for c in rest], "ids", "n_tokens", "ids_sha256")


def decode(ids: Column, ranks: dict[bytes, int], table: Column | None = None) -> Column:
    """The bytes of the ids: pieces from ``table``, a literal by default, concatenated. Strings serve as carriers of raw bytes."""
    pieces = F.from_json(F.lit(_piece_list(ranks)), PIECES) if table is None else table
    return F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1).cast("string")), "").cast("binary")


def decoded_digest(coded: DataFrame, ranks: dict[bytes, int], name: str = "decoded_sha256") -> DataFrame:
    """All columns and the SHA-256 of what ``ids`` decode to."""
    rest = [F.col(f"`{c}`") for c in coded.columns if c != name]
    # A name that is longer than all others is free.
    free = "_" * (1 + max(len(c) for c in coded.columns))
    digest = F.sha2(decode(F.col("ids"), ranks, F.col(free)), 256)
    return with_table(coded, _piece_list(ranks), PIECES, free).select(*rest, digest.alias(name))
