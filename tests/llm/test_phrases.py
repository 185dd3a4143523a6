"""Collocations against counting everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import phrases


def brute(docs, longest=5, least=100, cover=100, top=2000):
    """Counts of all phrases in plain Python, from (group, text)."""
    counts, totals = Counter(), Counter()
    for group, text in docs:
        group = "und" if group is None else group
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            totals[group] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[group, " ".join(words[i : i + k])] += 1
    taken = {(g, p): a for (g, p), a in counts.items() if a >= least and " " in p}
    covered = set()
    for (g, p), a in taken.items():
        words = p.split(" ")
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = " ".join(words[i : i + k])
                if 100 * a >= cover * taken[g, part]:
                    covered.add((g, part))
    rows = defaultdict(list)
    for (g, p), a in taken.items():
        if (g, p) in covered:
            continue
        words = p.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[g, " ".join(words[:k])], counts[g, " ".join(words[k:])]
            cuts.append((1000 * a * totals[g] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows[g].append((-score, -a, p.encode(), left, right))
    return sorted((g, i, p.decode(), -a, left, right, totals[g], -s) for g, found in rows.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed, many=120):
    g = random.Random(seed)
    words = ["a", "b", "c", "Dd", "é", "of", "the", "x-y", "\x1c", "z z"]
    return [(n, g.choice(["en", "de", None]), "".join(g.choice(words) + g.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". "]) for _ in range(g.randint(0, 60)))) for n in range(many)]


@pytest.mark.parametrize("sample", [1, 4, 1000])
def test_random_texts(spark, sample):
    rows = texts(sample)
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    # A sample of one document in a thousand proposes next to nothing, so all comes from failures at the border.
    got = found(phrases.collocations(docs, least=4, sample=sample))
    want = brute([r[1:] for r in rows], least=4)
    assert got == want and len(want) > 50


def passes(monkeypatch):
    """Collects the passes that count hashes, by whether they have a bitmap of proposals and of known phrases."""
    seen, count = [], phrases._hash_counts
    monkeypatch.setattr(phrases, "_hash_counts", lambda docs, longest, *bits: seen.append(len(bits)) or count(docs, longest, *bits))
    return seen


def test_one_pass_closes_what_the_sample_missed(spark, monkeypatch):
    # Only in documents outside the sample, so that phrases of all lengths are missing from the proposals.
    chosen = {r.id for r in spark.range(400).where("pmod(xxhash64(cast(id as int)), 4) = 0").collect()}
    rows = [(n, "en", "plain words" if n in chosen else "one two three four five six seven. two three one two three four") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    seen = passes(monkeypatch)
    got = found(phrases.collocations(docs, least=4, sample=4))
    assert got == brute([r[1:] for r in rows], least=4) and any(len(r[2].split()) == 5 for r in got)
    assert seen == [0, 1, 2]


def test_bitmaps_are_read_in_few_jobs(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id) as h")
    context = spark.sparkContext
    context.setJobGroup("bitmap", "")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bits = phrases._bitmap(hashes, 1 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        jobs = len(context.statusTracker().getJobIdsForGroup("bitmap"))
        context.setLocalProperty("spark.jobGroup.id", None)
    want = {h % (1 << 20) for (h,) in hashes.collect()}
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == want
    assert jobs < 10


def test_texts_of_a_task_are_made_out_once(monkeypatch):
    held = phrases._Held()
    new = held.add(np.array([3, 5, 9], np.uint64), np.array([1, 1, 1], np.uint64), np.array([1, 2, 3]))
    held.name(["g"] * 3, ["c", "e", "i"])
    assert new.tolist() == [0, 1, 2]
    # One of these shares its first hash with another phrase.
    new = held.add(np.array([4, 5, 9], np.uint64), np.array([1, 7, 1], np.uint64), np.array([10, 20, 30]))
    held.name(["g"] * len(new), ["d", "other"])
    assert new.tolist() == [0, 1]
    total = Counter()
    for p, n in zip(held.phrases, held.counts(), strict=True):
        total[p] += n
    assert total == {"c": 1, "e": 2, "i": 33, "d": 10, "other": 20}


def test_parameters(spark):
    rows = texts(9)
    docs = spark.createDataFrame([(n, text, lang) for n, lang, text in rows], "id int, body string, kind string")
    got = found(phrases.collocations(docs, "id", "body", "kind", 3, 5, 60, 7, 2))
    assert got == brute([r[1:] for r in rows], 3, 5, 60, 7)


def test_full_bitmaps_and_equal_hashes_change_nothing(spark, monkeypatch):
    rows = texts(11)
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    monkeypatch.setattr(phrases, "MOST_BITS", phrases.BUCKET)
    monkeypatch.setattr(phrases, "_size", lambda n, each: 8)
    monkeypatch.setattr(phrases, "_bitmap", lambda hashes, size: np.full(1, 255, np.uint8))
    assert found(phrases.collocations(docs, least=4, sample=3)) == brute([r[1:] for r in rows], least=4)


def test_slices(spark, monkeypatch):
    rows = texts(12)
    rows += [(500, "en", "one two three four five " * 300), (501, "en", ". ".join(["one two three four five six"] * 300))]
    got = [(p, n) for t, names in small_slices(rows, monkeypatch) for p in names for n in [len(t)]]
    assert len(got) > 100
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    assert found(phrases.collocations(docs, least=4)) == brute([r[1:] for r in rows], least=4)


def small_slices(rows, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(phrases, "SLICE", 50)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2].encode() for r in rows]), pa.array([r[1] or "und" for r in rows])], names=["text", "name"])
    return list(phrases._texts(iter([batch])))


def test_large_counts_are_exact(spark):
    counts = spark.createDataFrame([("g", "a b", 10**12), ("g", "a", 10**12 + 7), ("g", "b", 10**12 + 9)], "name string, phrase string, f bigint")
    totals = spark.createDataFrame([("g", 10**14 + 3)], "name string, n bigint")
    row = phrases._scored(counts, totals, 100).first()
    assert row.score == 1000 * 10**12 * (10**14 + 3) // ((10**12 + 7) * (10**12 + 9))


def test_awkward_documents(awkward, nothing):
    docs = [(r.lang, r.text) for r in awkward.collect()]
    clashing = awkward.withColumn("name", F.lit("x")).withColumn("phrase", F.lit(1)).withColumn("id", F.lit(2)).withColumn("h", F.lit(3))
    assert found(phrases.collocations(clashing, least=2)) == brute(docs, least=2)
    assert found(phrases.collocations(nothing)) == []


def test_refusals(awkward):
    for wrong in ({"longest": 1}, {"least": 0}, {"sample": 0}):
        with pytest.raises(ValueError):
            phrases.collocations(awkward, **wrong)
