"""Exact top-k against all products."""

import numpy as np
import pytest

from sheetloom.llm import mips


def brute(rows, k):
    ready = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in ready:
        if q is None or q % 100:
            continue
        found = sorted(((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in ready if i != q))[:k]
        out |= {(q, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(found)}
    return out


def check(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    given = [(r.vec_id, r.embedding) for r in df.collect()]
    assert {tuple(r) for r in mips.top_k(df, df.where("vec_id % 100 = 0"), k).collect()} == brute(given, k)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_random_vectors(spark, spread, monkeypatch):
    monkeypatch.setattr(mips, "BLOCK", 64)
    monkeypatch.setattr(mips, "QUERIES", 3)
    g = np.random.default_rng(1)
    x = g.normal(size=(900, 12)) * np.exp(spread * g.normal(size=(900, 1)))
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_ties_nulls_and_short_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 0.0]), (7, [2.0]), (8, []), (100, [0.0, 0.0]), (9, [-3.0, 0.5])]
    check(spark, rows)
    check(spark, rows, 3)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert mips.top_k(empty, empty, 10).count() == 0


@pytest.mark.parametrize("size, many", [(1.0, 16), (30.0, 0), (1e5, 16), (1e5, 1 << 40)])
def test_numbers_of_any_width(spark, size, many, monkeypatch):
    monkeypatch.setattr(mips, "BLOCK", 64)
    monkeypatch.setattr(mips, "QUERIES", 3)
    monkeypatch.setattr(mips, "MANY", many)
    x = size * np.random.default_rng(2).normal(size=(400, 5))
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_queries_are_not_sent_by_way_of_the_driver(spark, monkeypatch):
    monkeypatch.setattr(mips, "BLOCK", 8)
    x = np.random.default_rng(3).normal(size=(200, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    plan = mips.top_k(df, df.where("vec_id % 100 = 0"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
