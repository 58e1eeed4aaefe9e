"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a line of the text) is hashed to a wide vector of 32-bit lanes, and a fingerprint is the sum of its paragraphs' vectors, lane
by lane, modulo 2^32. Sums don't know their order, so texts of the same paragraphs in any order have equal fingerprints, and a paragraph is
inserted or deleted by adding or subtracting its vector (`updated`, `apply_edits`), without the rest of the text.

A vector has two parts. The last 64 lanes are SHAKE-128 of the paragraph: they tell different multisets apart. The first 256 lanes are what its
24-byte windows add to them (one for each byte, the window that ends there; at a paragraph's start it is what there is): each adds 1 or -1 to a
lane that its hash picks, and the j-th time that a window occurs in a paragraph is a window of its own. The cosine of two such sums estimates the cosine of the texts' window counts with a standard error of
about 1/16, so `likeness` sees how much two texts share although it has their fingerprints only. Equal fingerprints have likeness 1, and
estimates below 0 are 0.

Documents and their successors meet by ranges: bounds come from a narrow sort of the ids, each range's first document also goes to
the range before it, and each task streams its sorted range. Texts are shuffled once. Rows that are equal in id and text stay in one range.

Defined cases: a null text is an empty one, which has one empty paragraph. Null ids come before others, equal ids are ordered by a
hash of their texts, so every row has a successor; a table of one row is its own. An empty table gives no rows. Extra columns are not
read, whatever their names. A text takes memory of a few times its own bytes; windows are hashed in slices.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, passes, table

LANES, MARKS, WINDOW = 256, 64, 24
#: Most ranges that documents are dealt to; their bounds are three numbers each in the driver and in tasks.
RANGES = 20_000
_SLICE = 1 << 18
_ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: For 0 to 24 bytes of a window, the bytes to keep of its last, middle and first eight.
_KEEP = np.array([[(0xFFFFFFFFFFFFFFFF << 8 * (8 - min(max(n - 8 * k, 0), 8))) & 0xFFFFFFFFFFFFFFFF for n in range(WINDOW + 1)] for k in range(3)], U64)


def _slices(begins: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(first byte, end, start of the first byte's line): whole lines of about _SLICE bytes; longer lines are cut from their own start on."""
    lo = 0
    while lo < n:
        hi = n if lo + _SLICE >= n else int(begins[np.searchsorted(begins, lo + _SLICE, "right") - 1])
        if hi > lo:
            yield lo, hi, lo
        else:
            after = np.searchsorted(begins, lo, "right")
            hi = int(begins[after]) if after < len(begins) else n
            for cut in range(lo, hi, _SLICE):
                yield cut, min(hi, cut + _SLICE), lo
        lo = hi


def _window_lanes(data: np.ndarray, ends: np.ndarray, out: np.ndarray) -> None:
    """Adds each text's windows to its row of out. data: the texts' bytes, WINDOW zeros before them; ends: offsets of the texts' ends."""
    n = len(data) - WINDOW
    begins = np.unique(np.concatenate([[0], ends[:-1], np.flatnonzero(data[WINDOW:] == 10) + 1]))
    begins = begins[begins < n]
    for lo, hi, start in _slices(begins, n):
        raw = data[WINDOW + lo : WINDOW + hi]
        own = begins[np.searchsorted(begins, lo, "left") : np.searchsorted(begins, hi, "left")]
        own = own if len(own) and own[0] == lo else np.concatenate([[lo], own])
        size = np.diff(own, append=hi)
        line = np.repeat(np.arange(len(own)), size)
        held = np.minimum(np.arange(lo, hi) - np.repeat(np.concatenate([[start], own[1:]]), size) + 1, WINDOW)
        h = held.astype(U64)
        for k in range(3):
            eight = np.ndarray(hi - lo, "<u8", data.data, offset=WINDOW + lo - 7 - 8 * k, strides=(1,))
            h += (eight & _KEEP[k][held]) * _ODD[k]
            h ^= h >> U64(29)
        # sorted by line and hash, so that a window's repeats in its line (or piece of one) can be told apart
        key = np.sort(((line.astype(U64) << U64(44)) | (mix(h) >> U64(20)))[raw != 10])
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        nth = np.arange(len(key))
        nth -= np.maximum.accumulate(np.where(new, nth, 0))
        h = mix((key & U64((1 << 44) - 1)) + nth.astype(U64) * _ODD[0])
        of = np.searchsorted(ends, own, "right")
        text = of[(key >> U64(44)).astype(np.int64)]
        first = int(text[0])
        cell = (text - first) * LANES + (h % U64(LANES)).astype(np.int64)
        rows = int(text[-1]) - first + 1
        added = np.bincount(cell, np.where(h >> U64(63), 1.0, -1.0), rows * LANES).astype(np.int64).reshape(rows, LANES)
        out[first : first + rows, :LANES] += (added & 0xFFFFFFFF).astype(np.uint32)


def sums(texts: list[str]) -> np.ndarray:
    """A row of lanes per text: the sum of its paragraphs' vectors modulo 2^32."""
    out = np.zeros((len(texts), LANES + MARKS), np.uint32)
    if not texts:
        return out
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in raw])
    lines = [x.split(b"\n") for x in raw]
    marks = np.frombuffer(b"".join(hashlib.shake_128(p).digest(4 * MARKS) for x in lines for p in x), "<u4").reshape(-1, MARKS)
    first = np.cumsum([0, *map(len, lines[:-1])])
    out[:, LANES:] = np.add.reduceat(marks, first, axis=0, dtype=np.uint32)
    _window_lanes(np.frombuffer(bytes(WINDOW) + b"".join(raw), np.uint8), ends, out)
    return out


def as_text(lanes: np.ndarray) -> str:
    return base64.b64encode(lanes.astype("<u4").tobytes()).decode()


def as_lanes(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").astype(np.uint32)


def fingerprint(text: str | None) -> str:
    return as_text(sums([text or ""])[0])


def updated(old: str, inserted: list[str] = (), deleted: list[str] = ()) -> str:
    """The fingerprint after paragraphs (without line ends) are inserted and deleted."""
    new = as_lanes(old) + sums(list(inserted)).sum(0, dtype=np.uint32) - sums(list(deleted)).sum(0, dtype=np.uint32)
    return as_text(new)


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness, 0 to 1, of rows of lanes."""
    x, y = (v[:, :LANES].astype(np.int32).astype(np.float64) for v in (a, b))
    both = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), both, out=np.zeros(len(x)), where=both > 0)
    return np.where((a == b).all(1), 1.0, np.clip(cosine, 0, 1))


def likeness(a: str, b: str) -> float:
    return float(likenesses(as_lanes(a)[None], as_lanes(b)[None])[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in passes(b.column(1)):
                some = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([as_text(x) for x in sums(some.column(1).to_pylist())], pa.string())], ["doc_id", "fingerprint"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return picked.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fingerprint string")


def apply_edits(prints: DataFrame, edits: DataFrame) -> DataFrame:
    """prints (doc_id, fingerprint) after edits (doc_id, paragraph, times: 1 inserts it, -1 deletes it, other numbers so often). Edits of ids that
    prints lack and null ids have no effect; a null paragraph is empty, null times are none. A document with a great many edits is summed up inside tasks first."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in passes(b.column(1)):
                ids, lanes = b.column(0).slice(i, j - i).to_numpy(zero_copy_only=False), sums(b.column(1).slice(i, j - i).to_pylist())
                lanes *= b.column(2).slice(i, j - i).to_numpy().astype(np.int64).astype(np.uint32)[:, None]
                own, of = np.unique(ids, return_inverse=True)
                total = np.zeros((len(own), LANES + MARKS), np.uint32)
                np.add.at(total, of, lanes)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([x.astype("<u4").tobytes() for x in total], pa.binary())], ["edited", "change"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(LANES + MARKS, np.uint32)
        for b in batches:
            done: list[tuple[int, bytes]] = []
            for k, change in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != now:
                    if now is not None:
                        done.append((now, total.tobytes()))
                    now, total = k, np.zeros(LANES + MARKS, np.uint32)
                total = total + np.frombuffer(change, "<u4")
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int64()), pa.array([x for _, x in done], pa.binary())], ["edited", "change"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["edited", "change"])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [f if c is None else as_text(as_lanes(f) + np.frombuffer(c, "<u4")) for f, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], ["doc_id", "fingerprint"])

    rows = edits.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("paragraph", F.lit("")).alias("paragraph"), F.coalesce(F.col("times").cast("bigint"), F.lit(0)).alias("times"))
    parts = rows.mapInArrow(summed, "edited bigint, change binary").repartition("edited").sortWithinPartitions("edited")
    changes = parts.mapInArrow(met, "edited bigint, change binary")
    both = prints.join(changes, F.col("doc_id") == F.col("edited"), "left").select(F.col("doc_id").cast("bigint").alias("doc_id"), "fingerprint", "change")
    return both.mapInArrow(moved, "doc_id bigint, fingerprint string")


def with_successors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, part, guest: sorted in each task by part, then order, so that a row's successor is the next row of its part; the last rows of a part are
    guests, which stand for the first row of the part after it (of the first part after the last one). To be streamed, not counted."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(F.col("doc_id").isNotNull().cast("int").alias("named"), F.coalesce("doc_id", F.lit(0)).alias("key"), F.xxhash64("text").alias("hash"), "doc_id", "text")
    order = ["named", "key", "hash"]
    n = min(RANGES, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    firsts = rows.select(*order).repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("low"))
    bounds = sorted(tuple(r["low"]) for r in firsts.collect())  # a row per range, RANGES at most

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in order)))
            part = [max(0, bisect_right(bounds, k) - 1) for k in keys]
            guests = []
            for i, (k, p) in enumerate(zip(keys, part)):
                if k == bounds[p] and p not in sent:  # one of equal rows is enough
                    sent.add(p)
                    guests.append(i)
            own = pa.Table.from_batches([b]).append_column("part", pa.array(part, pa.int32())).append_column("guest", pa.array([False] * len(b)))
            yield from own.to_batches()
            if guests:
                lent = pa.Table.from_batches([b.take(pa.array(guests))])
                lent = lent.append_column("part", pa.array([(part[i] - 1) % len(bounds) for i in guests], pa.int32())).append_column("guest", pa.array([True] * len(guests)))
                yield from lent.to_batches()

    spread = rows.mapInArrow(dealt, "named int, key bigint, hash bigint, doc_id bigint, text string, part int, guest boolean")
    return spread.repartitionById(max(1, len(bounds)), "part").sortWithinPartitions("part", "guest", *order)


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row and its edited text, whose last quarter is the start of its successor: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (by
    deleting and inserting the paragraphs that the edit touches), near_edited, near_next."""

    def edit(now: str, then: str) -> tuple[str, str, str]:
        """(edited text, paragraphs that it lacks, those that it has instead)."""
        cut = len(now) - len(now) // 4
        new = now[:cut] + then[: len(now) // 4]
        line = now.rfind("\n", 0, cut) + 1
        return new, now[line:], new[line:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, parts, guests, lanes = [], [], [], [], np.zeros((0, LANES + MARKS), np.uint32)
        for b in batches:
            for i, j in passes(b.column(1)):
                some = b.slice(i, j - i)
                new = some.column(1).to_pylist()
                ids, texts, parts, guests = ids + some.column(0).to_pylist(), texts + new, parts + some.column(2).to_pylist(), guests + some.column(3).to_pylist()
                lanes = np.concatenate([lanes, sums(new)])
                own = [k for k in range(len(ids) - 1) if not guests[k]]
                edits = [edit(texts[k], texts[k + 1]) for k in own]
                of, following = lanes[own], lanes[[k + 1 for k in own]]
                changed = of - sums([x[1] for x in edits]) + sums([x[2] for x in edits])
                columns = (
                    [ids[k] for k in own], [len(texts[k]) for k in own], [hashlib.sha256(x[0].encode()).hexdigest() for x in edits], [as_text(x) for x in of], [as_text(x) for x in changed],
                    likenesses(of, changed), likenesses(of, following),
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()))], names)
                ids, texts, parts, guests, lanes = ids[-1:], texts[-1:], parts[-1:], guests[-1:], lanes[-1:]
        if guests and not guests[0]:
            raise ValueError("a range without the first row of the next one")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = with_successors(docs, doc_id, text).select("doc_id", "text", "part", "guest")
    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))
