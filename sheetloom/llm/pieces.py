"""SentencePiece encoding and decoding with a merge-type (BPE) model with byte fallback.

A text is cut between two characters that stand side by side in no piece, so that no merge crosses the place; above all
where white space begins. For every prefix of a word the table holds one token, the last one of the prefix's encoding. It is the only piece
that (a) an automaton over all pieces finds at the end of the prefix and (b) is compatible with the last token of the
prefix before it: a pair of pieces is compatible if merging their joined text ends with exactly these two. The ids are
then read backwards. This takes one step per match and never merges a text; the merges of the vocabulary's own pieces,
done once per worker, give the trees on which the pair test walks.

Defined results: a null text is empty; an empty text has the end id alone; characters outside the vocabulary become the
ids of their UTF-8 bytes; texts of any length are encoded whole, a slice of words at a time; equal rows give equal rows.
``encode`` keeps columns besides the text as they are but replaces those named like its own; ``decode`` likewise. Empty
tables give empty results. Models of another type, with a normaliser, or without byte fallback are refused.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The space mark, field numbers and kinds of the public model format.
MARK = "▁"
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, END_ID = 3, 35, 42
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2

EDGE = re.compile(f"(?<=[^{MARK}])(?={MARK})")
# Characters of a text that are cut into words at once, words and pairs that a worker remembers, and their longest word.
SLICE = 1 << 20
REMEMBERED = 600_000
LONGEST = 64
# Neighbours are looked up for the Latin blocks; texts are not cut beside characters from this code point on.
LATIN = 0x250
NEVER = 1 << 40


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in the protocol buffers' wire format."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces, scores and kinds of a model file. It is read on the driver; its size is that of the vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        for value in (v for k, v in parts if k == PIECES):
            piece = dict(_fields(value))
            self.pieces.append(piece.get(PIECE, b"").decode())
            self.scores.append(struct.unpack("<f", piece.get(SCORE, bytes(4)))[0])
            self.kinds.append(piece.get(KIND, NORMAL))
        trainer = dict(_fields(dict(parts).get(TRAINER, b"")))
        rules = dict(_fields(dict(parts).get(NORMALIZER, b"")))
        if trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK):
            raise ValueError("only merge-type models with byte fallback are read")
        if rules.get(CHARSMAP) or not rules.get(ESCAPE, 1) or rules.get(REMOVE_EXTRA, 1) or not rules.get(DUMMY_PREFIX, 1):
            raise ValueError("only models that keep texts as they are, with a space before them, are read")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces are not read")
        if any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds, strict=True) if k == NORMAL):
            raise ValueError("a piece holds white space after another character")
        self.end_id = trainer.get(END_ID, 2)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "words", "joined", "said")}

    @cached_property
    def said(self) -> list[bytes]:
        """What each id stands for in a text."""
        plain = {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}
        rows = zip(self.pieces, self.kinds, strict=True)
        return [bytes([int(p[3:5], 16)]) if k == BYTE else plain.get(k, p.replace(MARK, " ").encode()) for p, k in rows]

    @cached_property
    def joined(self) -> np.ndarray:
        """Whether some piece holds two Latin characters side by side; the mark has the number 0, and others may always be joined."""
        pairs = np.zeros((LATIN + 1, LATIN + 1), bool)
        pairs[LATIN], pairs[:, LATIN] = True, True
        for piece, kind in zip(self.pieces, self.kinds, strict=True):
            if kind == NORMAL and len(piece) > 1:
                codes = _codes(piece)
                pairs[codes[:-1], codes[1:]] = True
        # A text's own U+0000 shares the mark's number, but no piece holds it: it only is cut off less often.
        return pairs

    @cached_property
    def table(self) -> PrefixTable:
        return PrefixTable(self)

    @cached_property
    def words(self) -> _Remembered:
        return _Remembered(self.table)


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int32)
    codes[codes == ord(MARK)] = 0
    return np.minimum(codes, LATIN)


class PrefixTable:
    """The automaton over the pieces that merging can make, and their merge trees, for the pair test."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.bytes = model.bytes
        normal = [i for i, k in enumerate(model.kinds) if k == NORMAL]
        # Equal scores are equal ranks: the pair further left goes first.
        places = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal}, reverse=True), 1)}
        self.rank = {model.pieces[i]: places[model.scores[i]] for i in normal}
        self.ids = {model.pieces[i]: i for i in normal}
        self.fit: dict[int, bool] = {}
        # For each piece: when it is made, and its parts.
        self.made: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.spines: dict[str, tuple[list[tuple[str, int]], list[tuple[str, int]]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.ids, key=len):
            if self._tree(piece):
                self.automaton.add_word(piece, (self.ids[piece], len(piece), self.ids[piece] << 24))
        self.names = dict(zip(self.ids.values(), self.ids, strict=True))
        self.automaton.make_automaton()

    def _tree(self, piece: str) -> bool:
        """Whether merging the piece's characters ends with the piece; its last merge is then kept."""
        now = list(piece)
        while len(now) > 2:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(now[:-1], now[1:], strict=True)]
            best = min(ranks)
            if best == NEVER:
                return False
            j = ranks.index(best)
            now[j : j + 2] = [now[j] + now[j + 1]]
        if len(now) == 1:
            self.made[piece] = 0
            return True
        left, right = now
        self.parts[piece] = (left, right)
        # Later than both parts, even if its score is better than theirs.
        self.made[piece] = max(self.rank[piece], self.made.get(left, 0), self.made.get(right, 0))
        return True

    def _spine(self, piece: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
        """What stands at the piece's end, and at its start, while it is merged, each with the time at which that goes."""
        known = self.spines.get(piece)
        if known is None:
            both = []
            for side in (1, 0):
                chain, inner, until = [], piece, NEVER
                while True:
                    chain.append((inner, until))
                    if inner not in self.parts:
                        break
                    until = self.made[inner]
                    inner = self.parts[inner][side]
                both.append(chain[::-1])
            known = self.spines[piece] = (both[0], both[1])
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces ends with these two: at no time is a merge over the border the best."""
        key = (a << 24) + b
        known = self.fit.get(key)
        if known is not None:
            return known
        left, right = self._spine(self.names[a])[0], self._spine(self.names[b])[1]
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            over = self.rank.get(x + y)
            if over is not None:
                over = max(over, self.made[x], self.made[y])
                # Of equal merges the one on the left goes first.
                if over < x_until and over <= y_until:
                    found = False
                    break
            if x_until == y_until == NEVER:
                found = True
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        if len(self.fit) >= REMEMBERED * 4:
            self.fit.clear()
        self.fit[key] = found
        return found

    def encode(self, word: str) -> list[int]:
        """Ids of a word of any length."""
        # Token and size of the last token of each prefix; none at the start and after a character outside the vocabulary.
        last: list = [None] * (len(word) + 1)
        fits = self.fit.get
        for end, found in self.automaton.iter(word):
            end += 1
            if last[end] is None:
                before = last[end - found[1]]
                # Nothing stands before the first token, and no piece has a character outside the vocabulary.
                if before is None:
                    last[end] = found
                else:
                    known = fits(before[2] + found[0])
                    if known or known is None and self.compatible(before[0], found[0]):
                        last[end] = found
        ids, at = [], len(word)
        while at:
            if found := last[at]:
                ids.append(found[0])
                at -= found[1]
            else:
                at -= 1
                ids += [self.bytes[b] for b in reversed(word[at].encode())]
        ids.reverse()
        return ids


class _Remembered(dict):
    """Ids of words, as bytes. What is not known is encoded; short words are kept for two generations, or longer if met again."""

    def __init__(self, table: PrefixTable) -> None:
        self.table = table
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or array("I", self.table.encode(word)).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def encode_text(text: str, model: Model, end: bool = True) -> np.ndarray:
    """Ids of a whole text; with ``end``, the end id follows."""
    marked = f"{MARK}{text.replace(' ', MARK)}" if text else ""
    known, joined = model.words.__getitem__, model.joined
    out, at = bytearray(), 0
    while at < len(marked):
        edge = EDGE.search(marked, at + SLICE)
        part = marked[at : edge.start() if edge else len(marked)]
        codes = _codes(part)
        cuts = (np.flatnonzero(~joined[codes[:-1], codes[1:]]) + 1).tolist()
        out += b"".join([known(part[a:b]) for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)])
        at += len(part)
    ids = np.frombuffer(bytes(out), np.uint32).astype(np.int32)
    return np.append(ids, np.int32(model.end_id)) if end else ids


def decode_ids(ids: list[int], model: Model) -> str:
    """The text of the ids: the space before the text goes, control ids say nothing, bytes that are no character are U+FFFD each."""
    said = model.said
    start = next((i for i in ids if model.kinds[i] != CONTROL), None)
    whole = b"".join(map(said.__getitem__, ids))
    if start is not None and model.pieces[start].startswith(MARK):
        whole = whole[1:]
    try:
        # Pieces are whole characters, so if all is valid, each run of bytes is.
        return whole.decode()
    except UnicodeDecodeError:
        pass
    out, raw = [], bytearray()
    for i in [*ids, None]:
        if i is not None and model.kinds[i] == BYTE:
            raw += said[i]
            continue
        while raw:
            try:
                out.append(raw.decode())
                raw.clear()
            except UnicodeDecodeError as e:
                out.append(raw[: e.start].decode() + "�")
                del raw[: e.start + 1]
        if i is not None:
            out.append(said[i].decode())
    text = "".join(out)
    return text[1:] if model.pieces[start].startswith(MARK) else text


def _kept(docs: DataFrame, gone: tuple[str, ...]) -> tuple[list[str], DataFrame]:
    names = [c for c in docs.columns if c not in gone]
    return names, docs.select(F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(0).alias("_none")]).alias("_row"), *[F.col(f"`{c}`") for c in gone if c in docs.columns])


def _slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of which each holds about ``most`` bytes or a single row."""
    sizes = batch.column(1).nbytes // max(1, batch.num_rows)
    step = max(1, most // max(1, sizes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def encode(docs: DataFrame, model: Model, text: str = "text", end: bool = True) -> DataFrame:
    """All columns of ``docs`` but the text, then ``ids`` (array), ``n_tokens`` and ``ids_sha256`` (of decimal ids with a space between)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, given = _kept(docs.withColumnRenamed(text, "_text").drop("ids", "n_tokens", "ids_sha256"), ("_text",))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        decimal = [str(i) for i in range(len(own.pieces))]
        for batch in batches:
            for part in _slices(batch):
                found = [encode_text(t or "", own, end) for t in part.column(1).to_pylist()]
                shas = [hashlib.sha256(" ".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest() for ids in found]
                sizes = np.array([len(ids) for ids in found], np.int64)
                edges = np.concatenate(([0], np.cumsum(sizes)))
                arrays = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([part.column(0), arrays, pa.array(sizes), pa.array(shas)], names=["_row", "ids", "n_tokens", "ids_sha256"])

    kind = given.schema["_row"].dataType.simpleString()
    out = given.mapInArrow(lay_out, f"_row {kind}, ids array<int>, n_tokens bigint, ids_sha256 string")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], "ids", "n_tokens", "ids_sha256")


def decode(coded: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """All columns of ``coded`` but the ids, then ``text``. Null ids give a null text."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    names, given = _kept(coded.withColumnRenamed(ids, "_ids").drop("text"), ("_ids",))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in _slices(batch):
                texts = [None if x is None else decode_ids(x, own) for x in (v.values.to_numpy().tolist() if v.is_valid else None for v in part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["_row", "text"])

    kind = given.schema["_row"].dataType.simpleString()
    out = given.mapInArrow(lay_out, f"_row {kind}, text string")
    return out.select(*[F.col("_row")[c].alias(c) for c in names], "text")
