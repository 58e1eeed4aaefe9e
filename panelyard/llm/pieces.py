"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The vocabulary comes from a given SentencePiece model file and is never trained here. That file holds merge
ranks instead of probabilities, so a piece's log score follows Zipf's law over its rank: -ln(rank + 1) - ln(H).
Spaces become markers, with one marker before the text; a character that no piece has is
written as its UTF-8 byte pieces, at a score of ten below the lowest. A marker character in the text itself
is written in bytes too, so decoding always gives the text back.

No piece has a marker after another character (checked when the vocabulary is loaded), so the best path of a text is
the best paths of its marker-led stretches, and equal stretches are solved once per task. One
numpy pass solves thousands of stretches at a time.

Defined cases: null text is encoded as empty text; an empty text has no pieces. Repeated rows give equal rows. Extra
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MARK = "▁"
#: Stretches that a task remembers, of so many characters at most (about 100 MB at worst); the memory is emptied when full. Longer ones are solved each time that they come.
CACHE, REMEMBERED = 250_000, 48
BELOW = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


#: Characters from which a stretch is solved alone.
LONG = 400


@dataclass
class Vocabulary:
    """Pieces, scores and the trie. codes: character -> trie label (from 1); base, check, piece: by trie state (0 is the root)."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    codes: np.ndarray
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    lowest: float
    single: np.ndarray

    def lists(self) -> tuple[list, list, list, list]:
        """base, check, piece and scores as lists, made once."""
        if not hasattr(self, "_lists"):
            self._lists = tuple(x.tolist() for x in (self.base, self.check, self.piece, self.scores))
        return self._lists

    def label(self, points: np.ndarray) -> np.ndarray:
        return np.where(points < len(self.codes), self.codes[np.minimum(points, len(self.codes) - 1)], 0)


def double_array(words: dict[tuple[int, ...], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a double-array trie: state t follows s by label c if t = base[s] + c and check[t] = s."""
    root: dict = {}
    for word, value in words.items():
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[0] = value
    size = 1 << 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0] = True
    queue, low = [(root, 0)], 1
    for node, state in queue:
        value[state] = node.pop(0, -1)
        if not node:
            continue
        labels = np.sort(np.fromiter(node, np.int64))
        while used[low]:
            low += 1
        window, start = low, -1
        while start < 0:
            if window + 4096 + labels[-1] >= len(used):
                more = len(used)
                base, check, value = (np.concatenate([x, np.full(more, v, np.int32)]) for x, v in ((base, 0), (check, -1), (value, -1)))
                used = np.concatenate([used, np.zeros(more, bool)])
            free = np.flatnonzero(~used[window : window + 4096]) + window - labels[0]
            free = free[free >= 0]
            fits = free[~used[free[:, None] + labels].any(1)] if len(labels) > 1 else free
            start = int(fits[0]) if len(fits) else -1
            window += 4096
        if len(labels) == 1 and start >= 0:
            low += 1
        base[state] = start
        for c in labels.tolist():
            used[start + c] = True
            check[start + c] = state
            queue.append((node[c], start + c))
    end = int(np.flatnonzero(used)[-1]) + 1
    return base[:end], check[:end], value[:end]


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probability of each rank (from 0) under Zipf's law."""
    return -np.log(ranks + 1.0) - np.log(np.sum(1.0 / (ranks + 1.0)))


def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    if any(MARK in text[i].lstrip(MARK) for i in normal):
        raise ValueError("a piece has a marker inside")
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    ranks = np.empty(n)
    ranks[sorted(normal, key=lambda i: -model.get_score(i))] = np.arange(len(normal))
    scores = np.full(n, -np.inf)
    scores[normal] = zipf_scores(ranks[normal])
    chars = sorted({c for i in normal for c in text[i]})
    codes = np.zeros(max(map(ord, chars)) + 1, np.int32)
    codes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    base, check, piece = double_array({tuple(codes[[ord(c) for c in text[i]]].tolist()): i for i in normal})
    out = [text[i].replace(MARK, " ").encode() for i in range(n)]
    for i in range(n):
        if model.is_control(i) or model.is_unknown(i):
            out[i] = b""
    for b, i in enumerate(byte_ids):
        out[i] = bytes([b])
    single = np.zeros(len(codes), bool)
    single[[ord(text[i]) for i in normal if len(text[i]) == 1]] = True
    return Vocabulary(out, scores, byte_ids, codes, base, check, piece, float(scores[normal].min()) - BELOW, single)


def viterbi(voc: Vocabulary, stretches: list[str]) -> list[bytes]:
    """Best piece ids of each stretch, as little-endian 32-bit integers. Short ones are solved together, a step of all at a time; long ones one by one."""
    out = [_solve_long(voc, x) if len(x) > LONG else b"" for x in stretches]
    order = sorted((i for i in range(len(stretches)) if len(stretches[i]) <= LONG), key=lambda i: len(stretches[i]))
    at = 0
    while at < len(order):
        end, longest = at, 0
        while end < len(order) and end - at < 8192:  # rows times length stay bounded
            longest = len(stretches[order[end]])
            if end > at and (end - at + 1) * longest > 400_000:
                break
            end += 1
        rows = order[at:end]
        for i, ids in zip(rows, _solve(voc, [stretches[i] for i in rows])):
            out[i] = ids
        at = end
    return out


def _solve_long(voc: Vocabulary, text: str) -> bytes:
    """Best piece ids of one stretch; the same steps and ties as `_solve`."""
    base, check, piece, scores, size = *voc.lists(), len(voc.check)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    labels = voc.label(points).tolist()
    alone = np.where(points < len(voc.single), voc.single[np.minimum(points, len(voc.single) - 1)], False).tolist()
    n = len(labels)
    best, came, by = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        here = best[i]
        if not alone[i] and here + voc.lowest > best[i + 1]:
            best[i + 1], came[i + 1], by[i + 1] = here + voc.lowest, i, -1
        state = 0
        for j in range(i, n):
            label = labels[j]
            to = base[state] + label
            if not label or to >= size or check[to] != state:
                break
            state, p = to, piece[to]
            if p >= 0 and here + scores[p] > best[j + 1]:
                best[j + 1], came[j + 1], by[j + 1] = here + scores[p], i, p
    ids: list[int] = []
    at = n
    while at > 0:
        ids += [by[at]] if by[at] >= 0 else voc.byte_ids[list(text[at - 1].encode())].tolist()[::-1]
        at = came[at]
    return np.array(ids[::-1], "<u4").tobytes()


def _solve(voc: Vocabulary, texts: list[str]) -> list[bytes]:
    m = len(texts)
    lengths = np.array([len(t) for t in texts])
    width = int(lengths.max(initial=0))
    points = np.zeros((m, width), np.int64)
    points[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    labels = voc.label(points)
    alone = np.where(points < len(voc.single), voc.single[np.minimum(points, len(voc.single) - 1)], False)
    best = np.full((m, width + 1), -np.inf)
    best[:, 0] = 0
    came = np.zeros((m, width + 1), np.int32)
    by = np.full((m, width + 1), -1, np.int32)
    for i in range(width):
        rows = np.flatnonzero(lengths > i)
        no_piece = rows[~alone[rows, i]]
        score = best[no_piece, i] + voc.lowest
        up = score > best[no_piece, i + 1]
        best[no_piece[up], i + 1], came[no_piece[up], i + 1], by[no_piece[up], i + 1] = score[up], i, -1
        state = np.zeros(len(rows), np.int64)
        for j in range(i, width):
            label = labels[rows, j]
            to = voc.base[state] + label
            ok = (label > 0) & (j < lengths[rows]) & (to < len(voc.check))
            ok &= voc.check[np.where(ok, to, 0)] == state
            rows, state = rows[ok], to[ok]
            if not len(rows):
                break
            ids = voc.piece[state]
            is_piece = ids >= 0
            r, p = rows[is_piece], ids[is_piece]
            score = best[r, i] + voc.scores[p]
            up = score > best[r, j + 1]
            best[r[up], j + 1], came[r[up], j + 1], by[r[up], j + 1] = score[up], i, p[up]
    found_row, found_at, found_id = [], [], []
    rows, at = np.flatnonzero(lengths > 0), lengths[lengths > 0]
    while len(rows):
        found_row.append(rows)
        found_at.append(at)
        found_id.append(by[rows, at])
        at = came[rows, at]
        rows, at = rows[at > 0], at[at > 0]
    if not found_row:
        return [b""] * m
    row, end, ids = np.concatenate(found_row), np.concatenate(found_at), np.concatenate(found_id)
    sort = np.lexsort((end, row))
    row, end, ids = row[sort], end[sort], ids[sort]
    cuts = np.searchsorted(row, np.arange(m + 1)).tolist()
    raw = ids.astype("<u4").tobytes()
    special = np.unique(row[ids < 0])
    out = [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]
    for r in special.tolist():
        full: list[int] = []
        for p, e in zip(ids[cuts[r] : cuts[r + 1]].tolist(), end[cuts[r] : cuts[r + 1]].tolist()):
            full += [p] if p >= 0 else voc.byte_ids[list(texts[r][e - 1].encode())].tolist()
        out[r] = np.array(full, "<u4").tobytes()
    return out


#: A literal marker, a line end, spaces with the word after them, a word at the start of a line.
_PARTS = re.compile(f"{MARK}|\n|  *[^ \n{MARK}]*|[^ \n{MARK}]+")


class Encoder:
    """Encodes texts with a memory of solved stretches.

    Keys of the memory: a word stands for itself after a space, or, if it starts with a line end, for itself; a
    1-tuple for a stretch as it is; None for a marker that the text itself holds.
    """

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.known: dict = {}
        self.marker = voc.byte_ids[list(MARK.encode())].astype("<u4").tobytes()
        if len(voc.codes) > 10 and voc.codes[10]:
            raise ValueError("a piece holds a line end")

    @staticmethod
    def _stretches(text: str) -> list:
        """Keys of parts whose best paths join to the text's best path: no piece crosses a line end or goes on after a word into a space."""
        if not text:
            return []
        if "  " not in text and text[0] != " " and MARK not in text:
            return text.replace("\n", " \n").split(" ")
        return [None if x == MARK else (x.replace(" ", MARK),) for x in _PARTS.findall(" " + text)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Piece ids of each text, little-endian 32-bit."""
        parts = [self._stretches(t or "") for t in texts]
        known = self.known
        new = {p for x in parts for p in x} - known.keys()
        if len(known) + len(new) > CACHE:
            known.clear()
            new = {p for x in parts for p in x}
        new.discard(None)
        keys = list(new)
        known.update(zip(keys, viterbi(self.voc, [k[0] if isinstance(k, tuple) else k if k[:1] == "\n" else MARK + k for k in keys])))
        known[None] = self.marker
        out = [b"".join(map(known.__getitem__, x)) for x in parts]
        for k in keys:
            if len(k[0] if isinstance(k, tuple) else k) > REMEMBERED:
                del known[k]
        return out


def decode(voc: Vocabulary, ids: list[int]) -> str:
    """The text of piece ids: bytes joined, markers as spaces, without the one before the text. Broken bytes become U+FFFD."""
    return b"".join(map(voc.pieces.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def encode(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece_ids array<int> of each row's whole text."""
    voc = load(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc)
        for b in batches:
            got = encoder.encode(b.column(1).to_pylist())
            ends = np.cumsum([0, *(len(x) // 4 for x in got)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), "<i4")))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "piece_ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece_ids array<int>")


def decoded(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, piece_ids)."""
    voc = load(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(voc, x or []) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "piece_ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def encoded_and_back(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip (decoding gives the text), columns to keep."""
    voc = load(model or default_model())
    low, high = int(voc.byte_ids.min()), int(voc.byte_ids.max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(voc)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                texts = b.column(1).slice(first, 512).to_pylist()
                got = encoder.encode(texts)
                arrays = [np.frombuffer(x, "<u4") for x in got]
                same = [decode(voc, a.tolist()) == (t or "") for a, t in zip(arrays, texts)]
                cols = [
                    b.column(0).slice(first, 512), pa.array([len(a) for a in arrays], pa.int64()),
                    pa.array([int(((a >= low) & (a <= high)).sum()) for a in arrays], pa.int64()),
                    pa.array([zlib.crc32(x) for x in got], pa.int64()), pa.array(same, pa.bool_()),
                    *[c.slice(first, 512) for c in b.columns[2:]],
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip", *keep])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_pieces bigint, n_byte_pieces bigint, ids_crc32 bigint, round_trip boolean"
    schema += "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *keep).mapInArrow(run, schema)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_back(table(spark, sf_dir, "documents").select("doc_id", "text"))
