"""Dedup against the persistent index."""

import hashlib

from sheetloom.llm.digest_index import DigestIndex
from sheetloom.session import scratch_path


def test_groups_of_equal_texts(spark, awkward, rows):
    got = rows(DigestIndex(spark, scratch_path(spark, "i"), 4).dedup(awkward).drop("indexed"))
    given = [(r.doc_id, r.text or "") for r in awkward.collect()]
    want = []
    for i, t in given:
        ids = [j for j, u in given if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_later_batches_meet_the_index(spark):
    path = scratch_path(spark, "i")
    index = DigestIndex(spark, path, 4)
    one = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    two = spark.createDataFrame([(9, "b"), (10, "c"), (11, "c")], "doc_id bigint, text string")
    index.dedup(one).collect()
    got = {r.doc_id: (r.keep_id, r.kept, r.indexed) for r in index.dedup(two).collect()}
    assert got == {9: (2, False, True), 10: (11, False, False), 11: (11, True, False)}
    index.append_new(two)
    assert index.table().count() == 3
    spark.sql(f"DROP TABLE {index.name}")
    assert DigestIndex(spark, path, 4).table().count() == 3  # the files outlive the session's catalogue


def test_index_is_not_shuffled(spark):
    index = DigestIndex(spark, scratch_path(spark, "i"), 4)
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = index.groups(docs).join(index.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark, nothing):
    assert DigestIndex(spark, scratch_path(spark, "i"), 4).dedup(nothing).count() == 0


def test_another_bucket_number_finds_what_is_held(spark):
    path = scratch_path(spark, "index")
    batch = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    first = DigestIndex(spark, path, 4)
    assert first.dedup(batch).where("kept").count() == 40
    # Only the files are left for the next session, which asks for another number.
    spark.sql(f"DROP TABLE {first.name}")
    second = DigestIndex(spark, path, 7)
    later = spark.createDataFrame([(100 + i, f"text {i}") for i in range(45)], "doc_id bigint, text string")
    got = second.dedup(later).collect()
    assert second.buckets == 4 and sorted(r.doc_id for r in got if r.kept) == [140, 141, 142, 143, 144]
    assert sum(r.indexed for r in got) == 40 and second.table().count() == 45
