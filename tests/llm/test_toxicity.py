"""The classifier on texts it has not seen, and on awkward ones."""

import random
import zlib

from sheetloom.llm import toxicity


def corpus(spark, n=600):
    g = random.Random(2)
    words = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        toxic = g.random() < 0.3
        text = [g.choice(words) for _ in range(g.randint(5, 80))]
        if toxic:
            for _ in range(g.randint(1, 4)):
                text.insert(g.randrange(len(text)), g.choice(["blorg", "you snarf", "Grunkle!", "frabjack"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in toxicity.Toxicity(docs, labels).score(docs, keep=[docs["doc_id"]]).collect()}
    assert len(got) == 600 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.95


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs, labels = corpus(spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.is_held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in toxicity.Toxicity(docs, lab).score(docs, keep=[docs["doc_id"]]).collect()} for lab in (labels, flipped))
    assert one == two


def test_awkward_documents(spark, awkward, nothing):
    docs, labels = corpus(spark, 200)
    model = toxicity.Toxicity(docs, labels)
    scored = model.score(awkward)
    assert scored.count() == awkward.count() and scored.where("score is null").count() == 0
    assert scored.select("row.*").columns == awkward.columns
    assert model.score(nothing).count() == 0


def test_without_labels(spark, awkward):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.Toxicity(awkward, empty).score(awkward).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.Toxicity(awkward, odd).score(awkward).count() == awkward.count()


def test_obfuscated_words_count():
    known = {"stupid": 3.0}
    row = dict(zip(toxicity.FEATURES, toxicity.features("you are stup1d", known, frozenset(["stup"]))))
    assert row["unmasked_rate"] > 0 and row["obfuscated"] > 0
