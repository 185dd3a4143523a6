"""Toxicity by gradient-boosted trees over dense features of a text.

A lexicon is learnt from labelled texts: words, and word beginnings of four and five letters, that stand far more often in
toxic texts. Features are the densities of its entries, their nearness to words of the second person, capitals,
punctuation and obfuscation rates. Spark's boosted trees learn on them, and isotonic regression on rows that the trees
did not see turns their output into a probability.

Defined results: a null text is empty; an empty text has all rates 0 and gets the score that the trees give to it; without
labelled rows of both classes all scores are the share of toxic ones (0 if there are none). Repeated labels of a doc_id
count by their largest value; a null doc_id has no label and is not held out. Repeated rows get equal scores. Extra
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.session import staged

#: Most labelled rows that lexicon and trees are fitted on; a hash of the id chooses them.
TRAIN_ROWS = 40_000
#: Entries of the lexicon, and the toxic texts an entry must stand in.
LEXICON, SUPPORT = 2_000, 5
HELD_OUT = (5, 0)
# Of the training rows, one of so many calibrates.
CALIBRATE = 4
TREES, LEVELS, SEED = 12, 4, 17
# Words that address someone, in the languages of the corpus, and letters that digits and signs stand for.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch euer ihr sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros su sus".split()
)
LEET = str.maketrans("013457@$!|", "oieastasil")
FEATURES = (
    "log_words", "hits_rate", "log_hits", "top_weight", "weight_rate", "nearness", "second_rate", "capitals", "shouting", "punctuation", "exclaims",
    "obfuscated", "unmasked_rate", "runs", "non_ascii",
)
ENDS = ".,;:!?\"'()[]{}<>*#$%&-_…«»¿¡"
MASKED = re.compile(r"[^\W\d_]+[0-9@$!|*#]+[^\W\d_]+|[0-9@$!|*#]+[^\W\d_]{2,}")
RUNS = re.compile(r"([^\W\d_])\1\1")
CAPITALS = re.compile(r"[A-ZÄÖÜÉÈÀÂÊÎÔÛÇÑÁÍÓÚ]")
SHOUTED = re.compile(r"\b[A-ZÄÖÜÉÈÀÂÊÎÔÛÇÑÁÍÓÚ]{3,}\b")
PUNCTUATION = re.compile(r"[^\w\s]")


def terms(word: str) -> tuple[str, ...]:
    """What a word may be known by: itself and its first four and five letters."""
    return (word, word[:5] + "…", word[:4] + "…") if len(word) > 5 else (word, word[:4] + "…") if len(word) > 4 else (word,)


def features(text: str, lexicon: dict[str, float], heads: frozenset[str]) -> list[float]:
    """The FEATURES of a text. ``heads``: the first four letters of all entries, to pass over other words quickly."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits, weights = [], []
    for i, w in enumerate(words):
        if w[:4] in heads or not w[0].isalnum():
            w = w.strip(ENDS)
            if w[:4] in heads and (known := [lexicon[t] for t in terms(w) if t in lexicon]):
                hits.append(i)
                weights.append(max(known))
    masked = MASKED.findall(text)
    unmasked = sum(any(t in lexicon for t in terms(w.lower().translate(LEET).strip(ENDS))) for w in masked)
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0.0
    if hits and second:
        at = np.searchsorted(second, hits)
        places = np.array(second)
        gap = np.minimum(np.abs(places[np.minimum(at, len(second) - 1)] - hits), np.abs(places[np.maximum(at - 1, 0)] - hits))
        near = float((1.0 / (1.0 + gap)).max())
    size = len(text)
    return [
        math.log1p(n), len(hits) / n, math.log1p(len(hits)), max(weights, default=0.0), sum(weights) / n, near, len(second) / n,
        len(CAPITALS.findall(text)) / size, len(SHOUTED.findall(text)) / n, len(PUNCTUATION.findall(text)) / size, text.count("!") / n,
        len(masked) / n, unmasked / n, len(RUNS.findall(text)) / n, 1 - len(text.encode("ascii", "ignore")) / size,
    ]


def learn_lexicon(train: DataFrame, size: int = LEXICON, support: int = SUPPORT) -> dict[str, float]:
    """Entries and their log odds, the ``size`` strongest of those with odds over e^2; at most TRAIN_ROWS texts are read."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {term for w in set((t or "").lower().split()) if w.strip(ENDS) for term in terms(w.strip(ENDS))}
                (toxic if y else clean).update(found)
            names = list(toxic | clean)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[w] for w in names], pa.int64()), pa.array([clean[w] for w in names], pa.int64())], names=["term", "toxic", "clean"])

    n_toxic, n = train.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    counts = train.select("text", "toxic").mapInArrow(count, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / F.lit((n_toxic or 0) + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n - (n_toxic or 0) + 1.0))
    strong = counts.where(F.col("toxic") >= support).withColumn("odds", odds).where("odds > 2").orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(size)
    return {r.term: r.odds for r in strong.collect()}


class Toxicity:
    """A fitted scorer. ``docs`` and ``labels`` (doc_id, toxic) are joined on the id; held-out rows teach nothing."""

    def __init__(self, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> None:
        spark = docs.sparkSession
        known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic is not null")
        known = known.where(~is_held_out(F.col("_id"))).groupBy("_id").agg(F.max("toxic").alias("toxic"))
        total = known.count()
        share = min(1.0, train_rows / max(1, total))
        pick = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "_id"), 11) < F.lit(int(share * 2**53))
        # At most about TRAIN_ROWS pairs of numbers are broadcast.
        chosen = staged(known.where(pick), "toxic-labels")
        given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("text"))
        rows = given.join(F.broadcast(chosen), "_id").select("_id", "text", "toxic")
        train = staged(rows.repartition(8, "_id"), "toxic-train")
        self.lexicon = spark.sparkContext.broadcast(learn_lexicon(train))
        self.model = self.calibration = None
        n, toxic = train.agg(F.count(F.lit(1)), F.sum("toxic")).first()
        self.prior = (toxic or 0) / n if n else 0.0
        if not 0 < self.prior < 1:
            return
        ready = staged(self.features(train.select("_id", "toxic", "text"), "text").withColumn("label", F.col("toxic").cast("double")), "toxic-features")
        ready = ready.withColumn("vector", array_to_vector("features"))
        aside = F.pmod(F.xxhash64(F.lit(SEED + 1), "_id"), F.lit(CALIBRATE)) == 0
        trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=LEVELS, seed=SEED)
        fit, calibrate = ready.where(~aside), ready.where(aside)
        if fit.select("label").distinct().count() < 2:
            return
        self.model = trees.fit(fit.select("vector", "label"))
        if calibrate.select("label").distinct().count() == 2:
            judged = self.model.transform(calibrate).select(vector_to_array("probability")[1].alias("chance"), "label")
            self.calibration = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="calibrated").fit(judged)

    def features(self, rows: DataFrame, text: str) -> DataFrame:
        """All columns of ``rows`` and ``features``, an array."""
        lexicon = self.lexicon

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = lexicon.value
            heads = frozenset(t[:4] for t in known)
            for batch in batches:
                values = [features(t or "", known, heads) for t in batch.column(text).to_pylist()]
                flat = pa.array(np.array(values, float).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES)), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "features"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(compute, f"{fields}, features array<double>")

    def score(self, docs: DataFrame, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
        """``keep`` (all columns of ``docs`` as ``row`` by default), score and predicted."""
        kept = keep or [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")]
        given = docs.select(*kept, F.col(f"`{text}`").alias("_text"))
        names = [c for c in given.columns if c != "_text"]
        if self.model is None:
            scored = given.withColumn("score", F.lit(self.prior))
        else:
            rows = self.features(given, "_text").withColumn("vector", array_to_vector("features"))
            judged = self.model.transform(rows).withColumn("chance", vector_to_array("probability")[1])
            score = F.col("chance")
            if self.calibration is not None:
                judged = self.calibration.transform(judged)
                # Isotonic regression has steps; a thousandth of the trees' own output keeps the order inside a step.
                score = 0.999 * F.col("calibrated") + 0.001 * F.col("chance")
            scored = judged.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
        return scored.select(*names, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))
