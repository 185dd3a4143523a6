"""Chunks of lines against a search in plain Python."""

import random
from collections import Counter, defaultdict

from sheetloom.llm import line_chunks


def brute(rows):
    """New text of each row; rows are (order, text) with equal rows given once."""
    places = defaultdict(list)
    for order, text in rows:
        for n, body in line_chunks._bodies((text or "").encode()):
            places[body].append((order, n))
    gone = {p for found in places.values() for p in sorted(found)[1:]}
    out = {}
    for order, text in rows:
        if text is None:
            out[order] = None
            continue
        lines = text.encode().split(b"\n")
        out[order] = b"\n".join(x for n, (a, b) in enumerate(line_chunks.chunks(text.encode())) if (order, n) not in gone for x in lines[a:b]).decode()
    return out


def test_repeated_passages(spark):
    passage = "\n".join(f"line {i} of a passage that many documents share word for word" for i in range(30))
    rows = [(i, f"start of {i} with words of its own\n" * (i % 5) + passage + f"\nend of {i}, also its own and different") for i in range(12)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id bigint, text string, n_chars bigint")
    got = {r.doc_id: r for r in line_chunks.dedup_lines(docs).collect()}
    want = brute(rows)
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    # Most of the shared lines go, in whatever place they stand, and what is a document's own stays.
    assert all(got[i].text.count("of a passage") < 12 and f"end of {i}," in got[i].text for i in range(1, 12))
    assert got[0].text == rows[0][1]


def test_chunks_cover_all_lines():
    for text in (b"", b"\n", b"a", b"a\nb\n", b"\n".join(b"%d" % i for i in range(500))):
        parts = line_chunks.chunks(text)
        assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == len(text.split(b"\n"))


def test_awkward_documents(awkward):
    new = line_chunks.dedup_lines(awkward)
    assert new.columns == awkward.columns and new.count() == awkward.count()
    got = {r.doc_id: r.text for r in new.collect()}
    assert got[3] is None and got[4] == "" and got[5] == "   \n\t " and got[1].startswith("Alpha")
    rows = {(r.doc_id is None, r.doc_id or 0): r.text for r in awkward.collect()}
    want = brute(sorted(rows.items()))
    assert {(i is None, i or 0): t for i, t in got.items()} == want


def test_empty_table(nothing):
    assert line_chunks.dedup_lines(nothing).count() == 0


def test_columns_named_like_the_counts_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x", "row")], "doc_id bigint, text string, n_chunks string, row string")
    assert line_chunks.dedup_lines(docs, counts=True).columns == ["doc_id", "text", "row", "n_chunks", "dropped_chunks", "dropped_words"]
    assert line_chunks.dedup_lines(docs).first().n_chunks == "x"


def test_passages_of_one_line(spark):
    def passage(p):
        return " ".join(f"w{p}x{j}" for j in range(60))

    rows, want = [], {}
    for i in range(40):
        before, after = [f"own {i} before {j}" for j in range(1 + i % 4)], [f"own {i} after {j}" for j in range(i % 3)]
        rows.append((i, "\n".join([*before, passage(i // 2), *after])))
        want[i] = "\n".join([*before, *([passage(i // 2)] if i % 2 == 0 else []), *after])
    got = {r.doc_id: r.text for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


def repeated_lines(rows, most):
    """(order, line) of all lines in runs of more than ``most`` words that stand earlier; tries every run there is."""
    places = defaultdict(list)
    for order, text in rows:
        lines = text.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if lines[a].split() and lines[b - 1].split() and sum(len(x.split()) for x in lines[a:b]) > most:
                    places[tuple(lines[a:b])].append((order, a))
    return {(order, a + k) for run, found in places.items() for order, a in sorted(found)[1:] for k in range(len(run))}


def test_repeated_runs_of_short_and_long_lines(spark):
    rng = random.Random(3)

    def line():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 3, 5, 8, 9, 9, 14, 60])))

    passages = [[line() for _ in range(rng.randint(1, 14))] for _ in range(12)] + [[f"a{k}", f"b{k} b b b b b b b"] * 9 for k in range(2)]
    rows = []
    for i in range(60):
        lines = [line() for _ in range(rng.randint(0, 3))]
        for _ in range(rng.randint(1, 2)):
            p = rng.choice(passages)
            lines += p[rng.randint(0, 2) :] + [line() for _ in range(rng.randint(0, 4))]
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, f"{passages[-1][1]} " * 9 + "\n\n \n" + "end " * 60) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_chunks.dedup_lines(docs, counts=True).collect()}
    must, may = repeated_lines(rows, 50), repeated_lines(rows, line_chunks.MIN_WORDS - 1)
    assert len(must) > 100 and got[101].text == ""
    for i, text in rows:
        lines, kept = text.split("\n"), got[i].text.split("\n")
        left = iter([x for k, x in enumerate(lines) if (i, k) not in must])
        # All that must go is gone; what went besides stands earlier in a run of ten words or more.
        assert kept == [""] or all(any(x == y for y in left) for x in kept)
        assert not Counter(x for k, x in enumerate(lines) if (i, k) not in may and x.split()) - Counter(kept)
        assert got[i].dropped_words == len(text.split()) - len(got[i].text.split())


def test_repeated_lines_are_not_broadcast(spark):
    passage = "\n".join(f"line {i} of a passage that many documents share word for word" for i in range(30))
    docs = spark.createDataFrame([(i, passage) for i in range(5)], "doc_id bigint, text string")
    plan = line_chunks.repeated(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
