"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least three periods long, that no neighbouring
word extends. All of them are found, exactly.

Periods up to 4 come from comparing each word with those 1 to 4 before it. Periods in (2t, 4t] come from scale t = 2, 4, 8, ...: every position has a hash
of its t words, and the synchronising set of scale t holds position i if the least hash of positions i to i+t is that of i or of i+t. Membership
depends on the 2t words from i on only, so equal contexts are members alike, and the set has about 2/t of all positions. Positions
whose t words have a period of t/3 or less have no hash: these highly periodic regions lie in runs that smaller scales have supplied by then. In a
run of period q in (2t, 4t], some member among the first q+1 positions or so meets its own context q words on (the least hash of any 2t+1 neighbouring positions
makes one of them a member, and by Fine and Wilf a highly periodic stretch of q+t words would give the run a smaller period).
So each pair of members with equal contexts and a distance in (2t, 4t] proposes its distance as a period, and is
extended both ways by binary search over prefix hashes. What comes out is compared word by word, so that an unlucky hash can't make a run.

Texts are tasks of their own, without a shuffle: time is n log n in the words of a text, memory about 20 times its bytes at most.

Defined cases: words are `[^\\x20\\x09-\\x0D]+`; a null, empty or blank text has none, no runs and an empty collapsed text. Null and repeated ids and equal
rows are rows like any others. An empty table gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, passes, table

#: Shortest run in words, and in periods.
SHORTEST, PERIODS = 24, 3
#: Words of short texts that one numpy pass works on, and bytes of a long text that are split into words at a time.
_PASS, _PIECE = 1 << 16, 1 << 22
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_NONE = U64(2**64 - 1)
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists; a long text is cut at white space. (bytes.split() knows exactly the bytes 32 and 9 to 13.)"""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + _PIECE) if len(raw) - at > _PIECE else None
        end = gap.start() if gap else len(raw)
        yield raw[at:end].split()
        at = end


def word_ids(raw: bytes) -> np.ndarray:
    """A 64-bit number per word, equal for equal words (in this process)."""
    found = [np.fromiter(map(hash, words), np.int64, len(words)) for words in pieces(raw)]
    return np.concatenate(found).view(U64) if found else np.zeros(0, U64)


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal true stretches of at least so many."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


class _Prefixes:
    """Equality of stretches of words by hashes of prefixes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.full(n + 1, _BASE, U64)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sum = np.zeros(n + 1, U64)
        np.cumsum(mix(words) * self.power[:-1], out=self.sum[1:])

    def same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.sum[i + n] - self.sum[i]) * self.power[j - i] == self.sum[j + n] - self.sum[j]

    def extent(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """How many words from i and j (i < j) on are equal, or how many before them."""
        low, high = np.zeros(len(i), np.int64), (i if back else len(self.sum) - 1 - j).copy()
        while (todo := low < high).any():
            half = (low + high + 1) // 2
            ok = self.same(i - half, j - half, half) if back else self.same(i, j, half)
            low, high = np.where(todo & ok, half, low), np.where(todo & ~ok, half - 1, high)
        return low


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive values."""
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _joined(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of 2t words from those of t words."""
    return mix(h[:-t] * _BASE + (h[t:] ^ (h[t:] >> U64(31)))) if len(h) > t else h[:0]


def _proposed(h: np.ndarray, context: np.ndarray, t: int, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of pairs of members of scale t's synchronising set with equal contexts and a distance in (2t, 4t]."""
    ids = np.where(periodic[: len(h)], _NONE, h)
    least = _least(ids, t + 1)[: len(context)]
    here = len(least)
    member = np.flatnonzero(((ids[:here] == least) | (ids[t : t + here] == least)) & (least != _NONE))
    c = context[member]
    # most contexts occur once: a table of counts by some of their bits drops nearly all of those
    few = (c >> U64(11)).astype(np.int64) & ((1 << 17) - 1)
    again = np.bincount(few, minlength=1)[few] > 1 if len(few) else np.zeros(0, bool)
    member, c = member[again], c[again]
    first, second = [], []
    live, step = np.arange(len(member)), 1
    while len(live):
        live = live[live + step < len(member)]
        distance = member[live + step] - member[live]
        live, distance = live[distance <= 4 * t], distance[distance <= 4 * t]
        hit = live[(distance > 2 * t) & (c[live] == c[live + step])]
        first.append(member[hit])
        second.append(member[hit + step])
        step += 1
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second))
    return i, j - i


def _checked(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) compared word by word; one that hashes had made too long gives what it really holds."""
    out = []
    for s, e, q in runs.tolist():
        same = words[s : e - q] == words[s + q : e]
        if same.all():
            out.append((s, e, q))
        else:
            a, b = _stretches(same, 2 * q)
            out += [(s + x, s + y + q, q) for x, y in zip(a.tolist(), b.tolist())]
    return np.array(out, np.int64).reshape(-1, 3)


def _one_period_each(runs: np.ndarray) -> np.ndarray:
    """Of runs (start, end, period) of equal places the one with the smallest period, by start, then end."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def cubic_runs(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(start, end, period) of all maximal runs of at least three periods in an array of 64-bit numbers, by start, then end.

    longest: the longest part of `words` that a run may span, if separators that occur once divide it.
    """
    n = len(words)
    longest = n if longest is None else longest
    found = []
    for q in range(1, min(4, longest // 3) + 1):
        start, end = _stretches(words[q:] == words[:-q], 2 * q)
        found.append(np.stack([start, end + q, np.full(len(start), q)], 1))
    runs = _one_period_each(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)
    prefixes, t, h = None, 2, _joined(mix(words), 1)
    while 3 * (2 * t + 1) <= longest:
        context = _joined(h, t)
        deep = runs[(runs[:, 2] <= t // 3) & (runs[:, 1] - runs[:, 0] >= t)]
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, deep[:, 0], 1)
        np.add.at(depth, deep[:, 1] - t + 1, -1)
        i, q = _proposed(h, context, t, np.cumsum(depth) > 0)
        if len(i):
            prefixes = prefixes or _Prefixes(words)
            start = i - prefixes.extent(i, i + q, True)
            end = i + q + prefixes.extent(i, i + q, False)
            some = np.stack([start, end, q], 1)[end - start >= 3 * q]
            if len(some):
                runs = _one_period_each(np.concatenate([runs, _checked(words, np.unique(some, axis=0))]))
        h, t = context, 2 * t
    return runs


def _separators(texts: list[np.ndarray], some: np.ndarray) -> np.ndarray:
    """Numbers, one for each of some texts, that no word of theirs has."""
    salt = 1
    while True:
        out = mix(np.arange(salt, salt + len(some), dtype=U64) * _BASE)
        if not any(np.isin(texts[k], out).any() for k in some):
            return out
        salt += len(some)


def runs_of(texts: list[np.ndarray], shortest: int = SHORTEST, periods: int = PERIODS) -> list[np.ndarray]:
    """Per array of word numbers its runs (start, length, period) of at least so many words and periods, by start, then period.

    Texts of like length share passes; separators that occur nowhere else keep their runs apart."""
    if periods < 3:
        raise ValueError("runs of less than three periods are not found")
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(size, kind="stable")
    order = order[size[order] >= max(shortest, 3)]
    at = 0
    while at < len(order):
        end, total, least = at, 0, int(size[order[at]])
        while end < len(order) and (end == at or total + size[order[end]] <= _PASS and size[order[end]] <= 2 * least):
            total += int(size[order[end]]) + 1
            end += 1
        some = order[at:end]
        begin = np.cumsum([0, *(size[some] + 1)])
        joined = np.empty(begin[-1], U64)
        for k, first in zip(some, begin):
            joined[first : first + size[k]] = texts[k]
        joined[begin[1:] - 1] = _separators(texts, some)
        runs = cubic_runs(joined, int(size[some].max()))
        length = runs[:, 1] - runs[:, 0]
        runs = runs[(length >= shortest) & (length >= periods * runs[:, 2])]
        of = np.searchsorted(begin, runs[:, 0], "right") - 1
        cuts = np.searchsorted(of, np.arange(len(some) + 1))
        for k, text in enumerate(some):
            own = runs[cuts[k] : cuts[k + 1]]
            if len(own):
                own = np.stack([own[:, 0] - begin[k], own[:, 1] - own[:, 0], own[:, 2]], 1)
                out[text] = own[np.lexsort((own[:, 2], own[:, 0]))]
        at = end
    return out


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Of n words, those that a run (start, length, period) holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:n]) > 0


def collapsed(raw: bytes, runs: np.ndarray, n: int) -> bytes:
    """The text's words that stay, joined by single spaces."""
    drop, at, out = dropped_words(n, runs) if len(runs) else None, 0, []
    for words in pieces(raw):
        if drop is not None:
            gone = drop[at : at + len(words)].tolist()
            at += len(words)
            words = [w for w, g in zip(words, gone) if not g]
        if words:
            out.append(b" ".join(words))
    return b" ".join(out)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, periods: int = PERIODS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the text without what repeats in its runs, words joined by a space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in passes(b.column(1)):
                raw = [t.encode() for t in b.column(1).slice(i, j - i).to_pylist()]
                ids = [word_ids(x) for x in raw]
                runs = runs_of(ids, shortest, periods)
                flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
                offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]))
                short = [collapsed(x, r, len(w)).decode() for x, r, w in zip(raw, runs, ids)]
                columns = [b.column(0).slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), listed.cast(_RUNS), pa.array(short, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the documents, by checksums of their ids, end in a run whose start and period follow from the checksum. Null ids are not among them."""

    def planted(key: int | None, text: str) -> str:
        h = zlib.crc32(str(key).encode())
        if key is None or h % 10:
            return text
        words = [w for some in pieces(text.encode()) for w in some]
        n, g = len(words), h // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            root = words[a : a + p]
            words[a:] = (root * (-(-(n - a) // p)))[: n - a]
        return b" ".join(words).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in passes(b.column(1)):
                ids = b.column(0).slice(i, j - i)
                texts = [planted(k, t) for k, t in zip(ids.to_pylist(), b.column(1).slice(i, j - i).to_pylist())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string())], ["doc_id", "text"])

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, text string")


def digested(found: DataFrame) -> DataFrame:
    """What `find_runs` gives, as counts, the run with the greatest exponent, and digests."""
    best = F.expr("CASE WHEN size(runs) > 0 THEN aggregate(runs, runs[0], (b, r) -> IF(r.length * b.period > b.length * r.period, r, b)) END")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    out = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period")
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(find_runs(with_planted_runs(table(spark, sf_dir, "documents"))))
