"""Spelling variants: words one edit apart, found by asymmetric chunks, and the form each of them goes back to.

Of two words one edit apart, the longer one (either, if equally long) is cut into two disjoint chunks, and one edit
leaves one of them whole. The other word gives its grams; a gram meets a chunk only at the chunk's place, shifted by the
difference of lengths behind the edit, which is one at most. The half with the edit is matched the same way once more:
one of its two chunks is whole as well. So a key is a length, the quarter with the edit, and the text of the other three.
What meets is verified by edit distance, and counted at the first quarter that matches, so each pair comes once.

Words get numbers by falling count and rising text, so the least number among near words is the best form. Forms always
have more occurrences, so following them ends; roots are found by pointer jumping, in a logarithmic number of rounds.

Defined results: a null text has no words and a null id reads as an empty text; texts of any length are read whole, a
slice at a time; repeated rows count each time; extra columns are ignored; equal counts are ordered by text. Empty
tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.ordering import row_numbers
from sheetloom.session import staged

# What a word is made of, and how its capitals are lowered.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
GAP = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Characters of a text that are cut into words at once, and words that a task counts before it hands them on.
SLICE = 1 << 20
COUNTED = 500_000
QUARTERS = 4
# Rows that are numbered in one task.
NUMBERED = 10_000


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Callable[[str, str], str] | None = None) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts. ``change`` may put another word for one, by the document's id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, raw in zip(batch.column(0), batch.column(1), strict=True):
                name, whole = i.as_py() or "", (raw.as_py() or b"").translate(LOWER).decode()
                at = 0
                while at < len(whole):
                    gap = GAP.search(whole, at + SLICE)
                    stop = gap.start() if gap else len(whole)
                    words = Counter(RUN.findall(whole, at, stop))
                    at = stop
                    if change is None:
                        seen.update(words)
                    else:
                        for word, n in words.items():
                            seen[change(name, word)] += n
                if len(seen) >= COUNTED:
                    yield found()
                    seen.clear()
        yield found()

    given = docs.select(F.col(f"`{doc_id}`").cast("string").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    counted = given.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _edges(size: Column) -> list[Column]:
    """Where the four quarters of a word of this length begin, and where the last one ends."""
    half = F.floor(size / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((size - half) / 2), size]


def _keys(size: Column, behind: Column) -> Column:
    """For each quarter of a word of length ``size``: the text of ``word`` before it, and after it with the shift ``behind``."""
    edges = _edges(size)
    word = F.col("word")
    keys = []
    for quarter in range(QUARTERS):
        before, after = edges[quarter].cast("int"), (edges[quarter + 1] - behind).cast("int")
        kept = F.concat(word.substr(F.lit(1), before), F.lit(" "), word.substr(after + 1, F.length(word)))
        keys.append(F.struct(F.lit(quarter).cast("byte").alias("quarter"), kept.alias("kept"), before.alias("at")))
    return F.array(*keys)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a`` and ``b``: numbers of each two words (``id``, ``word``, of four characters at least) that are exactly one edit apart, once."""
    size = F.length("word")
    chunks = words.select(F.col("id").alias("a"), F.col("word").alias("long"), size.alias("size"), F.explode(_keys(size, F.lit(0))).alias("k"))
    chunks = chunks.select("a", "long", "size", "k.*")
    shifted = words.select("id", "word", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"))
    grams = shifted.select(F.col("id").alias("b"), F.col("word").alias("short"), "shift", (size + F.col("shift")).alias("size"), F.explode(_keys(size + F.col("shift"), F.col("shift"))).alias("k"))
    grams = grams.select("b", "short", "shift", "size", F.col("k.quarter").alias("quarter"), F.col("k.kept").alias("kept"))
    # Spark sizes what an explosion makes as if each row stayed one, so it must not choose to broadcast chunks or grams.
    met = chunks.join(grams.hint("merge"), ["size", "quarter", "kept"])
    # A shorter word may fit several quarters: it counts at the first, where the quarter before does not fit.
    first = (F.col("quarter") == 0) | (F.expr("substring(long, at + 1)") != F.expr("substring(short, at)"))
    once = F.when(F.col("shift") == 0, F.col("a") < F.col("b")).otherwise(first)
    return met.where(once & (F.levenshtein("long", "short", 1) == 1)).select("a", "b")


def _roots(forms: DataFrame) -> DataFrame:
    """``id`` and ``top`` for each word with a form: the last word on the way from form to form."""
    steps = staged(forms.select("id", F.col("form").alias("top")), "steps")
    while True:
        onward = steps.select(F.col("id").alias("top"), F.col("top").alias("_further"))
        longer = steps.join(onward.hint("merge"), "top", "left")
        steps = staged(longer.select("id", F.coalesce("_further", "top").alias("top"), F.col("_further").isNotNull().alias("moved")), "steps")
        if steps.where("moved").isEmpty():
            return steps.select("id", "top")
        steps = steps.drop("moved")


def variants(counts: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """Each word of ``counts`` (word, n) that is long and frequent enough, with its near words' number, its form and its root.

    The form is the near word with the most occurrences (the first by text, if several), if it has at least ``ratio``
    times as many as the word: word, form, root, n, n_near, form_n.
    """
    if least_length < QUARTERS:
        raise ValueError("words must have a character for each quarter")
    if ratio < 2:
        raise ValueError("a form must have more occurrences than its word")
    taken = counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count)).select("word", "n")
    words = staged(row_numbers(staged(taken, "words"), [], ["-n", "word"], "id", NUMBERED), "numbered")
    pairs = near_pairs(words.select("id", "word"))
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("near")), F.struct(F.col("b").alias("id"), F.col("a").alias("near")))).alias("p")).select("p.*")
    near = staged(both.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best")), "near")
    named = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    # These follow the vocabulary, and numbers in order are far fewer bytes in a file than in memory, by which they would be broadcast.
    best = words.join(near.hint("merge"), "id", "left").join(named.hint("merge"), "best", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    shaped = staged(best.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *[F.when(enough, F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "forms")
    roots = _roots(shaped.where("best IS NOT NULL").select("id", F.col("best").alias("form")))
    tops = roots.join(words.select(F.col("id").alias("top"), F.col("word").alias("root")).hint("merge"), "top").select("id", "root")
    return shaped.join(tops.hint("merge"), "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
