"""Spelling variants against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sheetloom.llm import spelling
from sheetloom.llm.queries import misspelt
from sheetloom.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def one_apart(a, b):
    """Whether exactly one inserted, deleted or replaced character makes one of the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, least_length=5, least_count=3, ratio=2):
    """Every word with a hole for each place tried against all others with the same hole, or that hole filled."""
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
    rows = []
    for w, n in words.items():
        near = set()
        for i in range(len(w)):
            near |= holes[w[:i], w[i + 1 :]]
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near.add(shorter)
        for i in range(len(w) + 1):
            near |= holes[w[:i], w[i:]]
        near.discard(w)
        assert all(one_apart(w, x) for x in near)
        form = min(near, key=lambda x: (-words[x], x.encode()), default=None)
        rows.append((w, form if form and words[form] >= ratio * n else None, n, len(near)))
    forms = {r[0]: r[1] for r in rows}

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return sorted((w, f or "", root(w), n, k, words[f] if f else -1) for w, f, n, k in rows)


def found(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefgh"])
def test_random_words(spark, letters):
    g = random.Random(len(letters))
    counts = {"".join(g.choice(letters) for _ in range(g.randint(3, 9))): g.choice([2, 3, 4, 8, 20, 100]) for _ in range(700)}
    rows = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(spelling.variants(rows)) == brute(counts)
    assert found(spelling.variants(rows, 4, 1, 3)) == brute(counts, 4, 1, 3)


def test_pairs_come_once(spark):
    words = ["a" * n for n in range(4, 12)] + ["ab" * n for n in range(2, 6)] + ["aab" * n for n in range(2, 4)] + ["abababb", "aaaab", "baaaa", "aabaa", "aabba"]
    rows = spark.createDataFrame(list(enumerate(words)), "id bigint, word string")
    got = [tuple(sorted((words[r.a], words[r.b]))) for r in spelling.near_pairs(rows).collect()]
    assert sorted(got) == sorted({tuple(sorted((x, y))) for x in words for y in words if one_apart(x, y)})


def test_long_chains(spark):
    # Each word is a variant of the next, which has twice as many occurrences.
    word, counts = "mmmmmmmmmmmm", {}
    for i in range(12):
        counts[word] = 3 * 2**i
        word = word[:i] + "xyz"[i % 3] + word[i + 1 :]
    rows = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = found(spelling.variants(rows))
    assert got == brute(counts) and len({r[2] for r in got}) == 1


def test_word_counts(awkward, nothing, monkeypatch):
    want = Counter()
    for r in awkward.collect():
        want.update(spelling.RUN.findall((r.text or "").encode().translate(spelling.LOWER).decode()))
    for length, most in ((1 << 20, 500_000), (3, 2)):
        monkeypatch.setattr(spelling, "SLICE", length)
        monkeypatch.setattr(spelling, "COUNTED", most)
        got = spelling.word_counts(awkward.withColumn("n", F.lit(1)).withColumn("word", F.lit("x")))
        assert {r.word: r.n for r in got.collect()} == want
    assert "naïve" in want and "Ünïcödé" in want
    assert spelling.variants(spelling.word_counts(nothing)).count() == 0


def test_awkward_documents(awkward):
    counts = {r.word: r.n for r in spelling.word_counts(awkward, change=misspelt).collect()}
    assert found(spelling.variants(spelling.word_counts(awkward, change=misspelt))) == brute(counts)


def test_refusals(spark):
    rows = spark.createDataFrame([("word", 1)], "word string, n bigint")
    for wrong in ({"least_length": 3}, {"ratio": 1}):
        with pytest.raises(ValueError):
            spelling.variants(rows, **wrong)


def test_query_equals_brute_force(spark):
    counts = Counter()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        for word in spelling.RUN.findall((r.text or "").encode().translate(spelling.LOWER).decode()):
            counts[misspelt(str(r.doc_id), word)] += 1
    got = found(QUERIES["op11_spelling_variants"](spark, FOLDER))
    assert got == brute(counts) and any(r[1] for r in got)


def test_chunks_and_grams_are_not_broadcast(spark):
    words = spark.range(300).select("id", F.concat(F.lit("word"), F.conv("id", 10, 26)).alias("word"))
    plan = spelling.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_the_vocabulary_is_not_broadcast(spark, monkeypatch):
    plans, real = [], spelling.staged
    monkeypatch.setattr(spelling, "staged", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, label))
    counts = spark.range(300).select(F.concat(F.lit("word"), F.conv("id", 10, 26)).alias("word"), (F.col("id") * 7 % 90 + 3).alias("n"))
    plans.append(spelling.variants(counts)._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("BroadcastHashJoin" in p for p in plans)
