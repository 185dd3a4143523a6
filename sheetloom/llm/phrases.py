"""Phrases whose words stand together more often than chance, mined by Toivonen's sampling method.

A sample of the documents proposes phrases: all that occur in it at a lowered rate. One full pass then counts the
proposed phrases and their negative border, which are the phrases that occur in the texts, are not proposed, but whose
two shorter parts (without the last word, without the first) are. If a phrase of the border turns out to be frequent, the
proposals were too narrow: one further pass counts every phrase that was not counted, and whose shorter phrases are all
frequent as far as they were. Every frequent phrase has frequent parts, so nothing is missed, whatever the sample holds.

Passes compare 64-bit hashes of phrases, and tasks know the proposals by a bitmap of at most ``MOST_BITS`` bits. Equal
hashes and full bitmaps can only make a pass count more, never less: the last pass counts the text of all phrases
found, exactly, and decides. Counts are combined in each task and then by Spark.

Defined results: a null text is empty, a null group is ``und``; texts of any length are read whole, a slice of pieces at
a time; repeated rows count each time; null ids fall in or out of the sample together; extra columns are ignored. Ties
are ordered by falling count and rising text. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.session import staged

# What ends a piece, what separates its words, and how capitals are lowered.
STOP = re.compile(rb"[.,;:!?\x0A-\x0D]")
STOPS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
UNKNOWN = "und"
# One document in so many is in the sample, and the share of its expected count that a proposed phrase needs there.
SAMPLE = 16
LOWERED = 0.5
# Bits of a bitmap for each phrase in it, in passes that count hashes and in the last one; at most so many in all.
BITS_EACH, LAST_BITS_EACH, MOST_BITS = 32, 256, 1 << 30
BUCKET = 32768
# Bytes of a bitmap that the driver reads at once.
READ = 1 << 24
# Bytes of text that are cut into words at once, and entries that a task holds before it hands them on.
SLICE = 2_000_000
HELD = 2_000_000
HELD_TEXTS = 300_000
# The last pass hands on each phrase of each task, so a task takes up to so many splits of the input, if every core has two tasks.
SPLITS = 8
SALTS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(STOPS)] = 1, 2
_random = np.random.Generator(np.random.PCG64(20_240_607))
_BYTES = _random.integers(1, 1 << 63, (2, 256), np.uint64) | np.uint64(1)
_BYTES[:, list(SPACES + STOPS)] = 0
_FACTOR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Text:
    """The words of a slice of texts: where they are, which pieces they are in, and hashes of their phrases."""

    def __init__(self, parts: list[bytes], groups: np.ndarray) -> None:
        """``groups``: a hash for each part, of the group that its phrases are counted in."""
        self.raw = b"\n".join(parts).translate(LOWER)
        self.data = np.frombuffer(self.raw, np.uint8)
        kind = _KIND[self.data]
        inside = np.concatenate(([False], kind == 0, [False]))
        turns = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32)
        self.starts, self.ends = turns[::2], turns[1::2]
        stops = np.cumsum(kind == 2, dtype=np.int32)
        self.piece = stops[self.starts]
        first = np.cumsum([0, *[len(p) + 1 for p in parts]][:-1])
        self.part = np.searchsorted(first, self.starts, "right") - 1
        self.groups = groups

    def __len__(self) -> int:
        return len(self.starts)

    def words(self, seed: int) -> np.ndarray:
        """A hash of each word, by its bytes and their places."""
        if not len(self):
            return np.zeros(0, np.uint64)
        begin = self.starts[0]
        sizes = np.diff(np.append(self.starts, len(self.data)))
        place = np.arange(begin, len(self.data), dtype=np.int32) - np.repeat(self.starts, sizes)
        powers = np.cumprod(np.full(int(sizes.max()) + 1, _FACTOR[seed]))
        return _mixed(np.add.reduceat(_BYTES[seed][self.data[begin:]] * powers[place], self.starts - begin))

    def phrases(self, longest: int, seed: int = 0) -> list[np.ndarray]:
        """For each length, hashes of the phrases that begin at each word; the last ones of a slice are left out."""
        words = self.words(seed)
        hashes = [_mixed(words + self.groups[self.part])]
        for k in range(2, longest + 1):
            hashes.append(_mixed(hashes[-1][:-1] * _FACTOR[1 - seed] + words[k - 1 :]))
        return hashes

    def whole(self, k: int) -> np.ndarray:
        """Whether the phrase of k words from each word lies in one piece."""
        return self.piece[: max(0, len(self) - k + 1)] == self.piece[k - 1 :]

    def text(self, word: int, k: int) -> str:
        return b" ".join(self.raw[self.starts[word] : self.ends[word + k - 1]].split()).decode()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Text, list[str]]]:
    """Slices of the texts, cut where pieces end, and the group of each part."""
    parts: list[bytes] = []
    names: list[str] = []
    held = 0
    seen: dict[str, int] = {}

    def group(name: str) -> int:
        if name not in seen:
            if len(seen) > 10_000:
                seen.clear()
            seen[name] = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
        return seen[name]

    def cut() -> tuple[_Text, list[str]]:
        return _Text(parts, np.array([group(n) for n in names], np.uint64)), names

    for batch in batches:
        for text, name in zip(batch.column(0), batch.column(1), strict=True):
            raw, at = text.as_py() or b"", 0
            while at < len(raw):
                stop = STOP.search(raw, at + SLICE)
                end = stop.start() if stop else len(raw)
                parts.append(raw[at:end])
                names.append(name.as_py())
                held += end - at
                at = end
                if held >= SLICE:
                    yield cut()
                    parts, names, held = [], [], 0
    if parts:
        yield cut()


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _asked(text: _Text, hashes: list[np.ndarray], proposed: np.ndarray | None, known: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """For each length, the words from which a phrase to count begins: one whose two shorter parts are both ``proposed``.

    With ``known``, what passes over ``proposed`` found frequent: the phrases that those did not count, and whose shorter
    phrases of any length are known as far as they were counted.
    """
    members = [_in(proposed, h) if proposed is not None else np.ones(len(h), bool) for h in hashes]
    found = np.ones(len(text), bool)
    # Whether a phrase may be frequent, from each word.
    maybe = _in(known, hashes[0]) if known is not None else found
    for k in range(1, len(hashes) + 1):
        if k > 1:
            found = text.whole(k)
            found &= members[k - 2][: len(found)] & members[k - 2][1 : len(found) + 1]
        if known is None:
            yield np.flatnonzero(found)
        elif k > 1:
            maybe = text.whole(k) & maybe[: len(found)] & maybe[1 : len(found) + 1]
            yield np.flatnonzero(maybe & ~found)
            maybe &= ~found | _in(known, hashes[k - 1])
        else:
            yield np.flatnonzero(~found)


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(joined)
    joined, n = joined[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], joined[1:] != joined[:-1])))
    return joined[first], np.add.reduceat(n, first)


def _hash_counts(docs: DataFrame, longest: int, proposed: Broadcast | None = None, known: Broadcast | None = None) -> DataFrame:
    """``h`` and ``n``: occurrences of the phrases of up to ``longest`` words, by hash.

    Without ``proposed`` of all phrases; with this bitmap, of those whose shorter parts are in it; with ``known``, of
    those that were not counted so, but may be frequent by what is known.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def handed() -> pa.RecordBatch:
            h, n = _summed(hashes, counts)
            hashes.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))], names=["h", "n"])

        held = 0
        for text, _ in _texts(batches):
            found = text.phrases(longest)
            for every, at in zip(found, _asked(text, found, proposed and proposed.value, known and known.value), strict=True):
                if len(at):
                    h, n = _summed([every[at]], [np.ones(len(at), np.int64)])
                    hashes.append(h)
                    counts.append(n)
                    held += len(h)
            if held >= HELD:
                yield handed()
                held = 0
        if hashes:
            yield handed()

    return docs.mapInArrow(count, "h bigint, n int").groupBy("h").agg(F.sum("n").alias("n"))


def _bitmap(hashes: DataFrame, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits with a bit for each ``h``; tasks build its parts."""
    # Spark numbers bits from 1.
    at = F.col("h").bitwiseAND(F.lit(size - 1)) + 1
    parts = hashes.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    bits = np.zeros(max(size, BUCKET) // 8, np.uint8)
    # The driver runs a job for each partition that it reads.
    for row in parts.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).coalesce(len(bits) // READ + 1).toLocalIterator():
        bits[(row.bucket - 1) * BUCKET // 8 :][: BUCKET // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def _size(n: int, each: int) -> int:
    return min(MOST_BITS, max(BUCKET, 1 << math.ceil(math.log2(max(1, n * each)))))


def frequent_hashes(docs: DataFrame, in_sample: Column, longest: int, least: int, sample: int = SAMPLE, lowered: float = LOWERED) -> DataFrame:
    """``h``: hashes of all phrases of ``docs`` (text, name) with at least ``least`` occurrences, and maybe of a few others."""
    context = docs.sparkSession.sparkContext
    needed = max(1, math.floor(least / sample * lowered))
    proposals = staged(_hash_counts(docs.where(in_sample).drop("id"), longest).where(F.col("n") >= needed).select("h"), "proposed")
    docs = docs.drop("id")
    size = _size(proposals.count(), BITS_EACH)
    proposed = _bitmap(proposals, size)
    shared = context.broadcast(proposed)
    frequent = staged(_hash_counts(docs, longest, shared).where(F.col("n") >= least).select("h"), "frequent")
    everything = _bitmap(frequent, size)
    if (everything & ~proposed).any():
        # Of a frequent phrase that was not counted, all shorter ones that were are frequent; so one more pass finds it.
        missed = _hash_counts(docs, longest, shared, context.broadcast(everything)).where(F.col("n") >= least).select("h")
        frequent = frequent.unionByName(staged(missed, "missed"))
    return frequent


class _Held:
    """Phrases of a task by their two hashes: each one's text is made out once, and its occurrences are added up."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        # Where each one's text stands, and its occurrences in that order.
        self.place, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.names: list[str] = []
        self.phrases: list[str] = []

    def add(self, first: np.ndarray, second: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Adds occurrences; which of these phrases are new, by rising first hash, and so want a name() next. One that is not met again counts as new."""
        at = np.minimum(np.searchsorted(self.first, first), max(0, len(self.first) - 1))
        known = (self.first[at] == first) & (self.second[at] == second) if len(self.first) else np.zeros(len(first), bool)
        np.add.at(self.n, self.place[at[known]], n[known])
        new = np.flatnonzero(~known)
        if len(new):
            joined = np.concatenate((self.first, first[new]))
            order = np.argsort(joined, kind="stable")
            self.first, self.second = joined[order], np.concatenate((self.second, second[new]))[order]
            self.place = np.concatenate((self.place, np.arange(len(self.n), len(self.n) + len(new))))[order]
            self.n = np.concatenate((self.n, n[new]))
        return new

    def name(self, names: list[str], phrases: list[str]) -> None:
        self.names += names
        self.phrases += phrases

    def counts(self) -> list[int]:
        return self.n.tolist()


def _phrase_counts(docs: DataFrame, longest: int, frequent: DataFrame) -> DataFrame:
    """``name``, ``phrase`` and ``f`` for phrases with these hashes, counted by their text; all words of a name count for the empty phrase."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(frequent, _size(frequent.count(), LAST_BITS_EACH)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()
        held = _Held()

        def handed() -> pa.RecordBatch:
            names, phrases, f = [*held.names, *totals], [*held.phrases, *[""] * len(totals)], [*held.counts(), *totals.values()]
            held.clear()
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(phrases), pa.array(f, pa.int64())], names=["name", "phrase", "f"])

        for text, names in _texts(batches):
            for part, n in zip(*np.unique(text.part, return_counts=True), strict=True):
                totals[names[part]] += int(n)
            found, other = text.phrases(longest), text.phrases(longest, 1)
            for k, at in enumerate(_asked(text, found, shared.value), 1):
                at = at[_in(shared.value, found[k - 1][at])]
                if not len(at):
                    continue
                # Rows of a phrase follow each other; a second hash parts those that share the first.
                at = at[np.argsort(found[k - 1][at], kind="stable")]
                a, b = found[k - 1][at], other[k - 1][at]
                first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
                new = held.add(a[first], b[first], np.diff(np.append(first, len(at))))
                words = at[first][new].tolist()
                held.name([names[text.part[w]] for w in words], [text.text(w, k) for w in words])
            if len(held.phrases) >= HELD_TEXTS:
                yield handed()
        if totals:
            yield handed()

    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(docs.rdd.getNumPartitions() / SPLITS))
    return docs.coalesce(tasks).mapInArrow(count, "name string, phrase string, f bigint").groupBy("name", "phrase").agg(F.sum("f").alias("f"))


def _scored(counts: DataFrame, totals: DataFrame, cover: int) -> DataFrame:
    """Phrases of two words and more that no longer one covers, with their lowest-scoring cut."""
    words = F.split("phrase", " ")
    phrases = counts.select("name", "phrase", F.col("f").alias("a"), words.alias("words")).where(F.size("words") > 1)
    size = F.size("words")
    # Each phrase's shorter phrases, with the largest count of one that holds them.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice("words", i, k), " "))))
    longer = phrases.where(size > 2).select("name", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    covered = longer.groupBy("name", "phrase").agg(F.max("longer").alias("longer"))
    open_ = phrases.join(covered, ["name", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    cuts = open_.select("name", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    halves = cuts.select("name", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    lefts = counts.select("name", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counts.select("name", F.col("phrase").alias("right"), F.col("f").alias("r"))
    sided = halves.join(lefts, ["name", "left"]).join(rights, ["name", "right"]).join(totals, "name")
    # Counts of up to 15 digits make products of up to 34, which decimals hold exactly.
    big = {c: f"cast({c} as decimal(15,0))" for c in "anlr"}
    score = F.expr(f"cast(1000 as decimal(4,0)) * {big['a']} * {big['n']} div ({big['l']} * {big['r']})")
    sided = sided.withColumn("score", score)
    least = sided.groupBy("name", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return least.select("name", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def collocations(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: str = "lang", longest: int = 5, least: int = 100, cover: int = 100, top: int = 2000, sample: int = SAMPLE
) -> DataFrame:
    """The ``top`` phrases of each group by score: name, rank, phrase, a, l, r, n, score.

    A phrase has 2 to ``longest`` words of one piece and at least ``least`` occurrences ``a``. Cut in two with ``l`` and
    ``r`` occurrences, among ``n`` words, it scores 1000 a n / (l r) rounded down; its lowest-scoring cut counts, the
    first of several. A phrase goes if a longer one that holds it has ``cover`` per cent of its occurrences or more.
    """
    if longest < 2 or least < 1 or sample < 1:
        raise ValueError("phrases have two words, and counts and samples are of one at least")
    name = F.coalesce(F.col(f"`{group}`").cast("string"), F.lit(UNKNOWN)).alias("name")
    given = docs.select(F.col(f"`{text}`").cast("binary").alias("text"), name, F.col(f"`{doc_id}`").alias("id"))
    frequent = frequent_hashes(given, F.expr(f"pmod(xxhash64(id), {int(sample)}) = 0"), longest, least, sample)
    counts = staged(_phrase_counts(given.drop("id"), longest, frequent).where((F.col("f") >= least) | (F.col("phrase") == "")), "phrases")
    totals = counts.where("phrase = ''").select("name", F.col("f").alias("n"))
    scored = _scored(counts.where("phrase <> ''"), totals, cover)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A group's phrases are first cut down in parts, so that the last window sees a bounded number of them.
    salted = scored.withColumn("_salt", F.expr(f"pmod(xxhash64(phrase), {SALTS})"))
    for by in (["name", "_salt"], ["name"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return salted.select("name", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
