"""Encoding against the tokenizer library, decoding as a round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from sheetloom.llm import bpe
from sheetloom.llm.queries import vocabulary


@pytest.fixture(scope="module")
def ranks():
    return vocabulary()[0]


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=vocabulary()[1], mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("share", [2.0**-18, 0.01, 2.0])
def test_awkward_documents(awkward, ranks, library, share):
    got = bpe.encode(awkward, ranks, vocabulary()[1], share=share).withColumn("back", bpe.decode(F.col("ids"), ranks))
    assert got.columns[:7] == [c for c in awkward.columns if c != "text"]
    texts = sorted((r.text or "" for r in awkward.collect()))
    assert sorted(bytes(r.back).decode() for r in got.collect()) == texts
    for r in got.collect():
        ids = library.encode_ordinary(bytes(r.back).decode())
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_fold_and_python_merges_agree(spark, ranks, library):
    g = random.Random(3)
    words = ["".join(g.choice("abcdethnor") for _ in range(g.randint(1, 24))) for _ in range(60)] + ["é", "ß" * 9, "a"]
    rows = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    for r in rows.select("word", bpe.fold_merges(F.col("word"), bpe.rank_table(ranks)).alias("ids")).collect():
        assert r.ids == bpe.merged(bytes(r.word), ranks) == library.encode_ordinary(bytes(r.word).decode())


def test_plans_do_not_spell_out_the_vocabulary(spark, ranks, library):
    plain = spark.createDataFrame([("hello wörld",), ("Don't  stop",), (None,)], "text string")
    coded = bpe.decoded_digest(bpe.encode(plain.withColumn("_pieces", F.lit("kept")), ranks, vocabulary()[1]), ranks)
    words = bpe.folded_words(spark.createDataFrame([(b"hello",), (b" stop",)], "word binary"), ranks)
    for df in (coded, words, corpus_pipeline.encode(spark, plain, "")):
        assert len(df._jdf.queryExecution().toString()) < 200_000
        # The table stands in its one use; a projection of its own would copy it into each row.
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Subquery" in plan and not re.search(r"\] AS _(ranks|_+)#", plan)
    assert {r.decoded_sha256 for r in coded.collect()} == {hashlib.sha256(t.encode()).hexdigest() for t in ("hello wörld", "Don't  stop", "")}
    assert {r._pieces for r in coded.collect()} == {"kept"}
    assert all(r.ids == library.encode_ordinary(bytes(r.word).decode()) for r in words.collect())


def test_long_words(ranks, library):
    g = random.Random(4)
    for n in (64, 65, 66, 500, 20_000):
        word = "".join(g.choice("abcdethnor") for _ in range(n))
        assert bpe.merged(word.encode(), ranks) == library.encode_ordinary(word)


def test_empty_table(nothing, ranks):
    assert bpe.encode(nothing, ranks, vocabulary()[1]).count() == 0


def test_columns_named_like_the_result_are_replaced(spark, ranks):
    docs = spark.createDataFrame([("a b", "x", 1.5, None)], "text string, ids string, n_tokens double, ids_sha256 string")
    got = bpe.encode(docs, ranks, vocabulary()[1])
    assert got.columns == ["ids", "n_tokens", "ids_sha256"] and got.first().n_tokens == 2
