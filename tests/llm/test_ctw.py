"""Context-tree scores against a tree kept in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

from sheetloom.llm import ctw


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def log2_half(a, b):
    return max(a, b) + math.log1p(math.exp(-abs(a - b))) - math.log(2)


def reference(train, texts, depth):
    counts = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]

    def steps(text):
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                prefix, bit = (1 << k) | data[i] >> (8 - k), data[i] >> (7 - k) & 1
                yield [(data[i - d : i], prefix) for d in range(depth + 1)], bit

    for t in train:
        for nodes, bit in steps(t):
            for d, node in enumerate(nodes):
                counts[d][node][bit] += 1

    def own(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(c[0] + c[1] + 1) - math.log(math.pi)

    weighted = [{} for _ in range(depth + 1)]
    below = [defaultdict(float) for _ in range(depth + 1)]
    for d in range(depth, -1, -1):
        for (context, prefix), c in counts[d].items():
            weighted[d][context, prefix] = own(c) if d == depth else log2_half(own(c), below[d][context, prefix])
            if d:
                below[d - 1][context[1:], prefix] += weighted[d][context, prefix]

    def probability(nodes, bit):
        said, left, last = 0.0, 1.0, 0.5
        for d, node in enumerate(nodes):
            if node not in counts[d]:
                break
            c = counts[d][node]
            kt = (c[1] + 0.5) / (c[0] + c[1] + 1)
            last = said + left * kt
            w = 1.0 if d == depth else 1 / (1 + math.exp(min(700, below[d][node] - own(c))))
            said, left = said + left * w * kt, left * (1 - w)
        return last if bit else 1 - last

    return [sum(math.log10(probability(n, b)) for n, b in steps(t)) for t in texts]


def check(docs, depth):
    rows = docs.select("doc_id", "text").collect()
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    texts = [lower(r.text) for r in rows]
    train = [t for t, h in zip(texts, held) if not h]
    counts = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r, h, t, s in zip(rows, held, texts, reference(train, texts, depth)):
        tokens = [*t.split(), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((r.doc_id, h, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, s))
    got = [tuple(r) for r in ctw.scores(docs, depth=depth).collect()]

    def key(r):
        return (r[0] is None, r[0] or 0, r[2])

    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-6), (a, b)


def test_awkward_documents(awkward):
    check(awkward.where("doc_id is null or doc_id not in (8, 9)"), 3)


def test_held_out_texts(spark):
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 12))) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)


def test_a_repeated_text_costs_less_than_a_new_one(spark):
    rows = [(i, "the same old story told once more") for i in range(30)] + [(100, "zq xv jk wp ßß qq")]
    got = {r.doc_id: r.score for r in ctw.scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[3] > got[100] / 2


def test_empty_table_and_no_training(spark, nothing):
    assert ctw.scores(nothing).count() == 0
    lone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = ctw.scores(spark.createDataFrame([(lone, "ab")], "doc_id bigint, text string")).collect()[0]
    assert row.held_out and row.train_tokens == 0 and math.isclose(row.score, 3 * 8 * math.log10(0.5))


def test_chunks_are_bounded_in_bytes_and_rows(spark, monkeypatch):
    sizes = [400, 400, 400, 3000, 100, *[10] * 30, 900, 900]
    docs = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], "doc_id bigint, text string").coalesce(1)
    seen = []
    bucketed = ctw._bucketed
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(ctw, "CHUNK_ROWS", 8)
    monkeypatch.setattr(ctw, "_bucketed", lambda df, key: seen.append(bucketed(df, key)) or seen[-1])
    assert ctw.scores(docs).count() == len(sizes)
    chunks = defaultdict(list)
    for r in seen[0].collect():
        chunks[r.chunk].append(len(r.text))
    assert all(len(c) <= 8 and (sum(c) <= 1000 or len(c) == 1) for c in chunks.values()) and len(chunks) < len(sizes)


def test_texts_longer_than_a_slice_and_packs_of_few_rows(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 90))) for i in range(12)] + [(12, "x" * 700), (13, ""), (14, " a  b ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(map(tuple, ctw.scores(docs, depth=3).collect()))
    for name, size in (("SLICE", 50), ("PACK_ROWS", 7), ("CHUNK_BYTES", 600)):
        monkeypatch.setattr(ctw, name, size)
    texts = [t.encode() for _, t in rows]
    parts = list(ctw._slices(texts, 3, 50))
    assert max(len(p) for part in parts for _, p in part) == 53
    assert sorted(s for part in parts for s in ctw._strings(part, 3)[0]) == sorted(s for t in texts for s in ctw._strings(next(ctw._slices([t], 3, 1 << 20)), 3)[0])
    assert all([w for some in ctw._words(t, 50) for w in some] == t.split() for t in texts)
    check(docs, 3)
    for a, b in zip(sorted(map(tuple, ctw.scores(docs, depth=3).collect())), whole):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-12) and math.isclose(a[6], b[6], rel_tol=1e-9)
