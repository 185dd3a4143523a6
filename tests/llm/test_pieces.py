"""Pieces against the library that reads such models, and the pair test against merging."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from sheetloom.llm import pieces
from sheetloom.llm.queries import piece_model
from sheetloom.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return piece_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_model_file(model, library):
    assert model.pieces == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert model.end_id == library.eos_id()
    assert all(abs(model.scores[i] - library.get_score(i)) < 1e-6 for i, k in enumerate(model.kinds) if k == pieces.NORMAL)


def test_random_texts(model, library):
    g = random.Random(5)
    names = [p for p, k in zip(model.pieces, model.kinds, strict=True) if k == pieces.NORMAL]
    for n in range(6000):
        text = (
            "".join(g.choice(names) for _ in range(g.randint(0, 12))),
            "".join(g.choice("aabeinostrh ▁  ") for _ in range(g.randint(1, 60))),
            "".join(chr(g.choice([g.randint(0, 127), g.randint(0, 0x2FFF), g.randint(0xE000, 0x1FFFF), 32, 97])) for _ in range(g.randint(1, 30))),
        )[n % 3]
        ids = pieces.encode_text(text, model).tolist()
        assert ids == library.encode(text, add_eos=True), text
        assert pieces.decode_ids(ids, model) == library.decode(ids)


def test_any_ids_decode_like_the_library(model, library):
    g = random.Random(6)
    for _ in range(4000):
        ids = [g.choice([g.randrange(32000), g.randint(0, 258), 259, 28705]) for _ in range(g.randint(0, 12))]
        assert pieces.decode_ids(ids, model) == library.decode(ids), ids


def test_pair_test_equals_merging(model):
    table = model.table

    def merge(text):
        now = list(text)
        while len(now) > 1:
            ranks = [table.rank.get(a + b, pieces.NEVER) for a, b in zip(now[:-1], now[1:], strict=True)]
            if (best := min(ranks)) == pieces.NEVER:
                break
            j = ranks.index(best)
            now[j : j + 2] = [now[j] + now[j + 1]]
        return now

    g = random.Random(7)
    made = [p for p in table.made if len(p) < 8]
    by_start = {}
    for p in made:
        by_start.setdefault(p[0], []).append(p)
    seen = Counter()
    for _ in range(20_000):
        # The second piece often goes on where some longer piece would.
        longer, b = g.choice(made), g.choice(made)
        a = longer[:-1] if len(longer) > 1 and longer[:-1] in table.made else longer
        b = g.choice(by_start.get(longer[-1], [b]))
        found = table.compatible(table.ids[a], table.ids[b])
        assert found == (merge(a + b) == [a, b]), (a, b)
        seen[found] += 1
    assert min(seen.values()) > 1000


def test_long_words_and_slices(model, library, monkeypatch):
    g = random.Random(8)
    for text in ("x" * 50_000, "".join(g.choice("abcdethnor") for _ in range(50_000)), "  ".join(["word, other"] * 9000), " " * 3000, "一梦ゼ" * 3000):
        assert pieces.encode_text(text, model).tolist() == library.encode(text, add_eos=True)
    monkeypatch.setattr(pieces, "SLICE", 7)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    text = "A few words, and  a\nlonger-one; then: end " * 20
    assert pieces.encode_text(text, model).tolist() == library.encode(text, add_eos=True)


def test_awkward_documents(awkward, model, library):
    coded = pieces.encode(awkward, model)
    got = pieces.decode(coded.withColumn("n", coded.n_tokens), model).collect()
    assert coded.columns[:7] == [c for c in awkward.columns if c != "text"]
    assert sorted(r.text for r in got) == sorted(r.text or "" for r in awkward.collect())
    for r in coded.collect():
        text = library.decode(r.ids)
        assert r.ids == library.encode(text, add_eos=True) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    assert all(r.ids[-1] != model.end_id for r in pieces.encode(awkward, model, end=False).where("n_tokens > 0").collect())


def test_clashing_names_and_empty_table(spark, nothing, model):
    docs = spark.createDataFrame([("a b", "x", 1.5, None, 3)], "text string, ids string, n_tokens double, ids_sha256 string, _row int")
    coded = pieces.encode(docs, model)
    assert coded.columns == ["_row", "ids", "n_tokens", "ids_sha256"] and coded.first().n_tokens == 3
    assert pieces.decode(coded.withColumn("text", coded._row), model).first().text == "a b"
    assert pieces.decode(pieces.encode(nothing, model), model).count() == 0


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "none.model"
    path.write_bytes(b"")
    with pytest.raises(ValueError):
        pieces.Model(str(path))


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op13_pieces"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_eos=True)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
