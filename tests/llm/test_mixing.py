"""The mix against targets worked out by hand in plain Python."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sheetloom.llm import mixing
from sheetloom.llm.common import running_total


def words(text):
    return len((text or "").encode().split())


def wanted(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if 2 * sizes[s] <= level * weight[s]}
        if more == full:
            return {s: min(2 * sizes[s], level * weight[s]) for s in order}
        full = more


@pytest.mark.parametrize("block", [3, 64, 1024])
def test_targets_are_met(spark, awkward, block):
    rows = mixing.mix_plan(awkward, block=block).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0) for r in awkward.collect())
    sizes, taken = Counter(), Counter()
    for d in awkward.collect():
        sizes[d.source] += words(d.text)
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and (r.first_slot is None) == (r.taken == 0)
    for source, target in wanted(sizes).items():
        assert abs(taken[source] - target) <= 1
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[source] for r in rows if r.source == source)


def test_reruns_agree(awkward):
    first, again = (sorted(map(str, mixing.mix_plan(awkward.repartition(n), block=16).collect())) for n in (1, 5))
    assert first == again


def test_schedule_is_even(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("w " * 100).alias("text"), F.when(F.col("id") < 300, "big").otherwise("small").alias("source"))
    sources = mixing.targets(mixing.mix_plan(docs, block=50).groupBy(F.concat(F.lit("0"), "source").alias("_src")).agg(F.max("source_size").alias("source_size")))
    slots = mixing.slots(sources, 50).orderBy("slot").collect()
    share = sum(s._src == "0big" for s in slots) / len(slots)
    for cut in range(100, len(slots), 100):
        assert abs(sum(s._src == "0big" for s in slots[:cut]) / cut - share) < 0.06


def test_mixed_documents_hold_the_words_taken(awkward):
    plan = mixing.mix_plan(awkward, block=16)
    mix = mixing.mixed(awkward, block=16)
    assert mix.columns == awkward.columns
    taken, held = Counter(), Counter()
    for r in plan.collect():
        taken[r.source] += r.taken
    for r in mix.collect():
        held[r.source] += words(r.text)
    assert taken == {s: held[s] for s in taken}


def test_empty_table(nothing):
    assert mixing.mix_plan(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_running_total_over_levels(spark):
    rows = spark.range(3000).select((F.col("id") * 7919 % 4096).alias("k"), (F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 5).alias("v"))
    got = {(r.g, r.k): r.t for r in running_total(rows, ["g"], "k", "v", "t", 12).collect()}
    for g in "012":
        total = 0
        for r in rows.where(F.col("g") == g).orderBy("k").collect():
            assert got[g, r.k] == total
            total += r.v


def test_sources_may_repeat_more_often(spark):
    docs = spark.createDataFrame([(1, "a b c d", "s"), (2, "e f g h i j", "t")], "doc_id bigint, text string, source string")
    rows = {r.source: r for r in mixing.mix_plan(docs, share=3.0, repeat=4.0, block=2).collect()}
    assert rows["s"].taken == 16 and rows["t"].taken == 14 and rows["s"].target == 16.0


def test_a_running_total_does_not_broadcast_its_rows(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), "id", F.lit(2).alias("v"))
    total = running_total(rows, ["g"], "id", "v", "before", 16)
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {(r.id, r.before) for r in total.collect()} == {(i, i // 3 * 2) for i in range(5000)}


def test_pieces_of_the_schedule_are_not_broadcast(spark):
    sources = spark.range(4).select(F.col("id").cast("string").alias("_src"), F.col("id").alias("_rank"), F.lit(300000).cast("long").alias("source_size"), F.lit(300000.0).alias("target"), F.lit(600000).cast("long").alias("_cap"))
    plan = mixing.slots(sources)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
