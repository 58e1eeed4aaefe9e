"""Best matches of bit sets by similarity (shared bits over all bits): a sketch index with exact results.

A set's sketch is a few packed words: its bits are dealt to 128 groups, and word by word the groups that hold at least one of them, and at least two. The bits that two
sets share are at most what the AND of their sketches counts (and what is over two a group), so one `bitwise_count` a word bounds a pair's similarity, whatever
the number of bits. Only pairs whose bound reaches what the query has found already are compared bit by bit. Sets of up to 128 different bits are their own sketches.

Whole blocks are skipped before that: references are in buckets of like size and, where there are enough of them, of the nearest of a few pivots. Two sets of a and b bits are at most
min(a, b) / max(a, b) similar, and 1 - similarity is a metric, so a bucket's range of distances to its pivot bounds it too. Queries first meet the bucket of their
own kind; what they find bounds the buckets that they still visit. No pair leaves a task: a block gives back a row per query and reference set.

Nearest references of sets of at most FEW_BITS different bits are found without buckets: all pairs' bits are counted, in tiles, which costs less than to bound them.

A block holds about 1,024 queries and as many references: their bits, 32 bytes of sketch each, and two matrices of 1,024 x 1,024 numbers (12 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelyard.sources.shared import drop_kept, kept

#: Digits kept, so that sums in any order give equal results.
DIGITS = 9
#: Most queries and references that meet in one group, on average.
BLOCK = 1024
#: Sizes within this ratio share a bucket.
RATIO = 1.25
#: Groups and levels of a sketch; most pivots (they are sent to all tasks).
GROUPS, LEVELS, PIVOTS = 128, 2, 256
#: Different bits in a block up to which sets are packed to compare them, and words that are compared at a time.
_PACKED, _AT_ONCE = 1 << 14, 1 << 23
_SLACK = 1e-9
#: Rows of a share that meets another in a task, and rows of it that are compared at a time.
TILE, AT_A_TIME = 4096, 1024
#: Different bits up to which a sketch of a set would be as long as the set, and words that are compared without leaving a core's cache.
FEW_BITS, _IN_CACHE = GROUPS * LEVELS, 1 << 16


def _rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, their row, bits of each row) of a column of lists."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = np.asarray(lists.value_lengths()).astype(np.int64)
    return np.asarray(lists.flatten()).astype(np.int64), np.repeat(np.arange(len(lists)), n), n


def _packed(rows: np.ndarray, columns: np.ndarray, n: int, width: int) -> np.ndarray:
    """n x width/64 words with the bits (row, column) set."""
    out = np.zeros((n, width // 8), np.uint8)
    np.bitwise_or.at(out, (rows, columns >> 3), (1 << (columns & 7)).astype(np.uint8))
    return out.view("<u8")


def sketches(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words of each set, bits beyond the sketch's levels)."""
    bits, row, n = _rows(lists)
    counts = np.bincount(row * GROUPS + bits % GROUPS, minlength=len(n) * GROUPS).reshape(len(n), GROUPS)
    words = [np.packbits(counts > level, axis=1, bitorder="little").view("<u8") for level in range(LEVELS)]
    return np.concatenate(words, 1), np.maximum(counts - LEVELS, 0).sum(1)


def most_shared(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Upper bounds of the bits that sets of two lists of sketches share."""
    out = np.minimum(a[1][:, None], b[1][None, :]).astype(np.int32)
    for k in range(a[0].shape[1]):
        out += np.bitwise_count(a[0][:, k, None] & b[0][None, :, k])
    return out


class _Exact:
    """Shared bits of pairs of a block's sets."""

    def __init__(self, a: pa.ChunkedArray, b: pa.ChunkedArray):
        (ba, ra, self.na), (bb, rb, self.nb) = _rows(a), _rows(b)
        every = np.unique(np.concatenate([ba, bb]))
        at = [np.searchsorted(every, x) for x in (ba, bb)]
        self.compared = 0
        if len(every) <= _PACKED:
            width = max(64, -(-len(every) // 64) * 64)
            self.words = [_packed(r, x, len(n), width) for r, x, n in zip((ra, rb), at, (self.na, self.nb))]
        else:
            self.words, self.bits = None, at
            self.start = [np.cumsum(n) - n for n in (self.na, self.nb)]

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        self.compared += len(i)
        out = np.zeros(len(i), np.int64)
        step = max(1, _AT_ONCE // (self.words[0].shape[1] if self.words else int(self.na.max(initial=1) + self.nb.max(initial=1))))
        for at in range(0, len(i), step):
            some = slice(at, at + step)
            if self.words:
                out[some] = np.bitwise_count(self.words[0][i[some]] & self.words[1][j[some]]).sum(1)
            else:
                keys = np.sort(np.concatenate([self._keyed(0, i[some]), self._keyed(1, j[some])]))
                out[some] = np.bincount(keys[1:][keys[1:] == keys[:-1]] >> 32, minlength=len(i[some]))
        return out

    def block(self, rows: slice, columns: slice) -> np.ndarray:
        """Shared bits of each of some sets of one side with each of some of the other, in as few bytes as hold them."""
        na, nb = self.na[rows], self.nb[columns]
        most = min(int(na.max(initial=0)), int(nb.max(initial=0)))
        out = np.zeros((len(na), len(nb)), np.uint8 if most < 256 else np.int32)
        if self.words:
            a, b = self.words[0][rows], self.words[1][columns]
            step = max(1, _IN_CACHE // max(1, len(nb)))
            for k in range(a.shape[1]):
                if a[:, k].any() and b[:, k].any():
                    x, y = a[:, k], np.ascontiguousarray(b[:, k])
                    for at in range(0, len(na), step):
                        out[at : at + step] += np.bitwise_count(x[at : at + step, None] & y)
            return out
        # bits are many, so few sets have one of them: what meets on a bit is counted
        (x, i), (y, j) = (self._some(side, of) for side, of in ((0, rows), (1, columns)))
        order = np.argsort(y)
        y, j = y[order], j[order]
        first, last = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
        ends = np.cumsum(last - first)
        at = 0
        while at < len(x):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, "right")))
            n = (last - first)[at:to]
            met = j[np.repeat(first[at:to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            out += np.bincount(np.repeat(i[at:to], n) * len(nb) + met, minlength=out.size).reshape(out.shape).astype(out.dtype)
            at = to
        return out

    def _some(self, side: int, of: slice) -> tuple[np.ndarray, np.ndarray]:
        """(bits, their row from 0) of some sets of a side."""
        n = (self.na, self.nb)[side][of]
        begin = int(self.start[side][of][0]) if len(n) else 0
        return self.bits[side][begin : begin + int(n.sum())], np.repeat(np.arange(len(n)), n)

    def _keyed(self, side: int, of: np.ndarray) -> np.ndarray:
        n = (self.na, self.nb)[side][of]
        pair = np.repeat(np.arange(len(of)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return (pair << 32) | self.bits[side][np.repeat(self.start[side][of], n) + within]


def _best_in_block(t: pa.Table, n_sets: int, m: int, types: tuple[pa.DataType, pa.DataType]) -> pa.Table:
    """The m most similar references of each set for every query of a block (smallest ids of equals), and a row with what was compared (k is -1)."""
    query = t["query"].to_numpy(zero_copy_only=False)
    a, b = t.filter(pa.array(query)), t.filter(pa.array(~query))
    schema = pa.schema([("q", types[0]), ("k", pa.int32()), ("r", types[1]), ("both", pa.int64()), ("every", pa.int64())])
    if not len(a) or not len(b):
        return schema.empty_table()
    b = b.take(pc.sort_indices(b["r"]))
    sketch = [(np.stack(x["words"].to_numpy(zero_copy_only=False)).view(np.uint64), x["over"].to_numpy()) for x in (a, b)]
    exact = _Exact(a["bits"], b["bits"])
    total = exact.na[:, None] + exact.nb[None, :]
    most = np.minimum(most_shared(*sketch), np.minimum(exact.na[:, None], exact.nb[None, :]))
    bound = most / np.maximum(total - most, 1)
    bound[a["apart"].to_numpy()[:, None] == b["apart"].to_numpy()[None, :]] = 0
    member, floors = b["sets"].to_numpy(), np.stack(a["floors"].to_numpy(zero_copy_only=False))
    shared = np.full(bound.shape, -1, np.int32)

    def similarities(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        new = shared[i, j] < 0
        shared[i[new], j[new]] = exact.shared(i[new], j[new])
        return shared[i, j] / np.maximum(total[i, j] - shared[i, j], 1)

    rows: list[pa.Table] = []
    for k in range(n_sets):
        fits = np.flatnonzero((member >> k) & 1)
        if not len(fits):
            continue
        own = bound[:, fits]
        take = min(m, len(fits))
        # the most promising ones raise the floor that the others must reach
        first = np.argpartition(-own, take - 1, axis=1)[:, :take]
        i = np.repeat(np.arange(len(a)), take)
        seen = similarities(i, fits[first.reshape(-1)]).reshape(len(a), take)
        floor = np.maximum(floors[:, k], seen.min(1) if take == m else 0.0)
        i, j = np.nonzero((own >= floor[:, None] - _SLACK) & (own > 0))
        ratio = similarities(i, fits[j])
        order = np.lexsort((j, -ratio, i))
        i, j, ratio = i[order], fits[j[order]], ratio[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        hit = (nth < m) & (ratio > 0)
        i, j = i[hit], j[hit]
        cols = {"q": a["q"].take(pa.array(i)), "k": pa.array(np.full(len(i), k, np.int32)), "r": b["r"].take(pa.array(j))}
        rows.append(pa.table(cols | {"both": pa.array(shared[i, j].astype(np.int64)), "every": pa.array((total[i, j] - shared[i, j]).astype(np.int64))}).cast(schema))
    work = {"q": pa.nulls(1, types[0]), "k": pa.array([-1], pa.int32()), "r": pa.nulls(1, types[1]), "both": pa.array([exact.compared]), "every": pa.array([len(a) * len(b)])}
    return pa.concat_tables([*rows, pa.table(work, schema=schema)])


def _indexed(rows: DataFrame) -> DataFrame:
    """rows (id, bits, apart, sets) with n, words, over."""

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            words, over = sketches(b.column("bits"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(words.view(np.int64).reshape(-1)), words.shape[1]).cast(pa.list_(pa.int64()))
            cols = [*b.columns, b.column("bits").value_lengths().cast(pa.int32()), lists, pa.array(over.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, "n", "words", "over"])

    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("n int, words array<bigint>, over int").fields])
    return rows.mapInArrow(run, schema)


def _far_apart(sets: list[list[int]], n: int) -> list[list[int]]:
    """n of a few sets, each the farthest from those before it, so that groups of like sets have a pivot of their own."""
    column = pa.chunked_array([pa.array(sets, pa.list_(pa.int64()))])
    exact, every = _Exact(column, column), np.arange(len(sets))
    out, near = [0], np.full(len(sets), np.inf)
    while sets and len(out) < min(n, len(sets)):
        last = np.full(len(sets), out[-1])
        both = exact.shared(every, last)
        near = np.minimum(near, 1 - both / np.maximum(exact.na + exact.na[last] - both, 1))
        if near.max() <= 0:
            break
        out.append(int(near.argmax()))
    return [sets[k] for k in out] if sets else []


def _placed(rows: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """rows with `distances` to the pivots, in float32."""
    sets = pa.array(pivots, pa.list_(pa.int64()))

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            exact = _Exact(pa.chunked_array([b.column("bits").cast(pa.list_(pa.int64()))]), pa.chunked_array([sets]))
            n = len(b)
            i, j = np.repeat(np.arange(n), len(sets)), np.tile(np.arange(len(sets)), n)
            both = exact.shared(i, j)
            far = 1 - both / np.maximum(exact.na[i] + exact.nb[j] - both, 1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(far), len(sets)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "distances"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("distances", T.ArrayType(T.DoubleType()))]))


def _compared(q: DataFrame, r: DataFrame, visits: DataFrame, n_sets: int, m: int) -> DataFrame:
    """What `_best_in_block` finds for queries in the buckets that they visit (id, bucket, floors)."""
    visiting = q.drop("bucket").join(visits.withColumnRenamed("id", "visitor"), F.col("id").eqNullSafe(F.col("visitor")))
    blocks = r.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rb")).join(visiting.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qb")), "bucket")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    h, kinds = F.xxhash64("id"), (q.schema["id"].dataType, r.schema["id"].dataType)
    same = ["bits", "words", "over", "apart"]
    left = visiting.join(blocks, "bucket").select("bucket", F.pmod(h, "qb").cast("int").alias("i"), every("rb").alias("j"), F.lit(True).alias("query"), F.col("id").alias("q"), F.lit(None).cast(kinds[1]).alias("r"), *same, F.lit(0).cast("bigint").alias("sets"), "floors")
    right = r.join(blocks, "bucket").select("bucket", every("qb").alias("i"), F.pmod(h, "rb").cast("int").alias("j"), F.lit(False).alias("query"), F.lit(None).cast(kinds[0]).alias("q"), F.col("id").alias("r"), *same, "sets", F.lit(None).cast("array<double>").alias("floors"))
    from pyspark.sql.pandas.types import to_arrow_type

    types = tuple(to_arrow_type(k) for k in kinds)
    schema = T.StructType([T.StructField("q", kinds[0]), T.StructField("k", T.IntegerType()), T.StructField("r", kinds[1]), T.StructField("both", T.LongType()), T.StructField("every", T.LongType())])
    return left.unionByName(right).groupBy("bucket", "i", "j").applyInArrow(lambda t: _best_in_block(t, n_sets, m, types), schema)


def _found(queries: DataFrame, refs: DataFrame, n_sets: int, m: int, pivots: int | None) -> tuple[list[DataFrame], list[DataFrame]]:
    """(tables of rows of blocks, tables that they were made from)."""
    spark = queries.sparkSession
    # a null `apart` is a value that no reference has
    shaped = lambda df, none: df.select("id", F.array_distinct("bits").alias("bits"), F.when(F.col("apart").isNull(), F.lit(none).cast("bigint")).otherwise(F.xxhash64("apart")).alias("apart"), *(["sets"] if "sets" in df.columns else [])).where("size(bits) > 0")
    q, r = kept(_indexed(shaped(queries, 1)), "queries"), kept(_indexed(shaped(refs, 2)), "refs")
    made = [q, r]
    if m == 1 and pivots is None and q.select("bits").union(r.select("bits")).select(F.explode("bits")).distinct().limit(FEW_BITS + 1).count() <= FEW_BITS:
        return [kept(_nearest(q, r, n_sets), "nearest")], made
    wanted = min(PIVOTS, r.count() // (4 * BLOCK) if pivots is None else pivots)
    chosen = _far_apart([list(x["bits"]) for x in r.orderBy(F.xxhash64("bits"), "id").limit(8 * wanted).select("bits").collect()], wanted) if wanted else []  # 8 x PIVOTS at most
    if chosen:
        q, r = (kept(_placed(x, chosen), "placed") for x in (q, r))
        made += [q, r]
    else:
        q, r = (x.withColumn("distances", F.array(F.lit(0.0))) for x in (q, r))
    nearest = F.expr("CAST(array_position(distances, array_min(distances)) - 1 AS INT)")
    size = F.floor(F.log("n") / np.log(RATIO)).cast("int")
    q, r = (x.withColumns({"cell": nearest, "bucket": size * (PIVOTS + 1) + nearest}) for x in (q, r))
    r = r.withColumn("near", F.array_min("distances"))
    spans = r.groupBy("bucket").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("cell").alias("pivot"), F.min("near").alias("low"), F.max("near").alias("high"), *[F.max(F.expr(f"shiftright(sets, {k}) & 1")).alias(f"s{k}") for k in range(n_sets)])
    no_floor = F.array(*[F.lit(0.0)] * n_sets)
    near = kept(_compared(q, r, q.select("id", "bucket", no_floor.alias("floors")), n_sets, m), "near")
    # a query's floor is the m-th best that it has of a set; a bucket is visited if it may still hold one as good for some set
    ratio = F.col("both") / F.col("every")
    nth = Window.partitionBy("q", "k").orderBy(ratio.desc(), "r")
    floors = near.where("k >= 0").withColumn("nth", F.row_number().over(nth)).where(F.col("nth") == m).groupBy("q").agg(*[F.coalesce(F.max(F.when(F.col("k") == k, ratio)), F.lit(0.0)).alias(f"b{k}") for k in range(n_sets)])
    sizes = q.select("id", F.col("bucket").alias("own"), F.col("n").alias("size"), "distances").join(floors, F.col("id").eqNullSafe(F.col("q")), "left")
    sizes = sizes.withColumn("floors", F.array(*[F.coalesce(f"b{k}", F.lit(0.0)) for k in range(n_sets)]))
    by_size = F.when(F.col("size") < F.col("least"), F.col("size") / F.col("least")).when(F.col("size") > F.col("most"), F.col("most") / F.col("size")).otherwise(1.0)
    far = F.expr("element_at(distances, pivot + 1)")
    by_pivot = 1 - F.greatest(F.lit(0.0), far - F.col("high"), F.col("low") - far)
    better: Column = F.lit(False)
    for k in range(n_sets):
        better = better | ((F.col(f"s{k}") > 0) & (F.least(by_size, by_pivot) >= F.col("floors")[k] - _SLACK))
    # a row per bucket of sizes and pivots: some dozens times PIVOTS at most
    visits = sizes.join(F.broadcast(spans), (F.col("bucket") != F.col("own")) & better).select("id", "bucket", "floors")
    more = kept(_compared(q, r, visits, n_sets, m), "more")
    return [near, more], made


def best_matches(queries: DataFrame, refs: DataFrame, n_sets: int = 1, m: int = 1, pivots: int | None = None) -> DataFrame:
    """(q, k, similarity, r): the m most similar references of set k for each query that share a bit with it, the smallest ids of equals.

    queries: id, bits, apart; refs: id, bits, apart, sets (bit k: in set k). Ids are of any type that has an order, and may differ in it. Rows whose `apart` is equal and not null
    don't meet. pivots: how many (by default none for less than 4,096 references, then one for each so many).
    """
    found, made = _found(queries, refs, n_sets, m, pivots)
    rows = reduce(DataFrame.unionByName, found).where("k >= 0").select("q", "k", F.round(F.col("both") / F.col("every"), DIGITS).alias("similarity"), "r")
    if m == 1:
        best = rows.groupBy("q", "k").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "r")).alias("b")).select("q", "k", (-F.col("b.minus")).alias("similarity"), "b.r")
    else:
        best = rows.withColumn("nth", F.row_number().over(Window.partitionBy("q", "k").orderBy(F.col("similarity").desc(), "r"))).where(F.col("nth") <= m).drop("nth")
    best = kept(best, "best")
    drop_kept(*found, *made)
    return best


def search_work(queries: DataFrame, refs: DataFrame, n_sets: int = 1, m: int = 1, pivots: int | None = None) -> dict[str, int]:
    """What a search costs: pairs (all), bounded (pairs of blocks that are visited) and compared (bit by bit)."""
    found, made = _found(queries, refs, n_sets, m, pivots)
    row = reduce(DataFrame.unionByName, found).where("k < 0").agg(F.sum("every").alias("bounded"), F.sum("both").alias("compared")).first()
    out = {"pairs": made[0].count() * made[1].count(), "bounded": row["bounded"] or 0, "compared": row["compared"] or 0}
    drop_kept(*found, *made)
    return out


def _rounded(both: np.ndarray, every: np.ndarray) -> np.ndarray:
    """both / every to DIGITS digits, halves up, as SQL's `round` of the quotient: the nearest number of that many digits is found in integers, so a pair costs some nanoseconds."""
    return (2 * 10**DIGITS * both + every) // (2 * every) / 10.0**DIGITS


def _listed(t: pa.Table, at_least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(q, r, similarity) of the pairs of a tile that share a bit; with at_least, of those that may reach it."""
    query = t["query"].to_numpy(zero_copy_only=False)
    a, b = t.filter(pa.array(query)), t.filter(pa.array(~query))
    if not len(a) or not len(b):
        return
    exact = _Exact(a["bits"], b["bits"])
    q, r = a["q"].combine_chunks(), b["r"].combine_chunks()
    # shared >= c * (bits of both) for a similarity of t, with c = t / (1 + t); the slack is more than float32 loses, and similarities decide later
    c = at_least / (1 + at_least)
    kind = np.float32 if max(int(exact.na.max()), int(exact.nb.max())) < 20_000 else np.float64
    least_a, least_b = ((c * n - 0.02).astype(kind) for n in (exact.na, exact.nb))
    for i in range(0, len(a), AT_A_TIME):
        for j in range(0, len(b), AT_A_TIME):
            rows, columns = slice(i, i + AT_A_TIME), slice(j, j + AT_A_TIME)
            shared = exact.block(rows, columns)
            x, y = np.nonzero(shared >= least_a[rows, None] + least_b[None, columns] if at_least > 0 else shared)
            if not len(x):
                continue
            both = shared[x, y].astype(np.int64)
            x, y = x + i, y + j
            keep = both > 0
            x, y, both = x[keep], y[keep], both[keep]
            cols = [q.take(pa.array(x)), r.take(pa.array(y)), pa.array(_rounded(both, exact.na[x] + exact.nb[y] - both))]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(cols, schema)], schema=schema)


def _tiled(q: DataFrame, r: DataFrame, size: int, *more: str) -> tuple[DataFrame, tuple]:
    """(rows (i, j, query, q, r, bits, more) of both sides in each tile that they are in, grouped by nothing yet; types of both ids).

    Each side is dealt into shares of about `size` rows, and each share of one side meets each of the other in a tile, so a row is shuffled once for each share of the other side."""
    kinds = (q.schema["id"].dataType, r.schema["id"].dataType)
    n, m = (max(1, -(-df.count() // size)) for df in (q, r))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    own = lambda k: F.pmod(F.xxhash64("id", "bits"), F.lit(k)).cast("int")
    extra = lambda df: [F.col(c) if c in df.columns else F.lit(0).cast("bigint").alias(c) for c in more]
    left = q.select(own(n).alias("i"), every(m).alias("j"), F.lit(True).alias("query"), F.col("id").alias("q"), F.lit(None).cast(kinds[1]).alias("r"), "bits", *extra(q))
    right = r.select(every(n).alias("i"), own(m).alias("j"), F.lit(False).alias("query"), F.lit(None).cast(kinds[0]).alias("q"), F.col("id").alias("r"), "bits", *extra(r))
    # as many partitions as tiles: a partition's tiles follow each other in one task
    return left.unionByName(right).repartition(min(n * m, 10_000), "i", "j"), kinds


def _nearest_in_tile(t: pa.Table, n_sets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What `_best_in_block` gives for m = 1 and no floors, for sets of few different bits: all pairs' shared bits are counted, and of references of one size the best has the most."""
    query = t["query"].to_numpy(zero_copy_only=False)
    a, b = t.filter(pa.array(query)), t.filter(pa.array(~query))
    if not len(a) or not len(b):
        return
    b = b.take(pc.sort_indices(b["r"]))
    size = np.asarray(b["bits"].combine_chunks().value_lengths()).astype(np.int64)
    rank = np.argsort(size, kind="stable")  # by size, then id; and each row's place by id
    b, size = b.take(pa.array(rank)), size[rank]
    exact, seen = _Exact(a["bits"], b["bits"]), 0
    begin = np.flatnonzero(np.append(True, size[1:] != size[:-1]))
    end, one = np.append(begin[1:], len(size)), size[begin]
    codes = np.unique(np.concatenate([a["apart"].to_numpy(), b["apart"].to_numpy()]), return_inverse=True)[1].astype(np.int32)
    apart_a, apart_b = codes[: len(a)], codes[len(a) :]
    met, member = bool(np.isin(apart_a, apart_b).any()), b["sets"].to_numpy()
    for at in range(0, len(a), AT_A_TIME):
        rows = slice(at, at + AT_A_TIME)
        shared = exact.block(rows, slice(0, len(b)))
        if met:
            shared *= apart_a[rows, None] != apart_b[None, :]
        for k in range(n_sets):
            mine = ((member >> k) & 1).astype(bool)
            own = shared if mine.all() else shared * mine
            most = np.stack([own[:, x:y].max(1) for x, y in zip(begin, end)], 1).astype(np.int64)
            ratio = most / (exact.na[rows, None] + one - most)
            top = ratio.max(1)
            found = np.full(len(own), len(b), np.int64)  # smallest place by id of equals
            for c, (x, y) in enumerate(zip(begin, end)):
                i = np.flatnonzero((ratio[:, c] == top) & (top > 0))
                if len(i):
                    seen += len(i)
                    found[i] = np.minimum(found[i], rank[x + (own[i, x:y] == most[i, c, None]).argmax(1)])
            i = np.flatnonzero(found < len(b))
            place = np.empty(len(b), np.int64)
            place[rank] = np.arange(len(b))
            j = place[found[i]]
            both = own[i, j].astype(np.int64)
            cols = [a["q"].combine_chunks().take(pa.array(i + at)), pa.array(np.full(len(i), k, np.int32)), b["r"].combine_chunks().take(pa.array(j)), pa.array(both), pa.array(exact.na[i + at] + exact.nb[j] - both)]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(cols, schema)], schema=schema)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, schema[0].type), pa.array([-1], pa.int32()), pa.nulls(1, schema[2].type), pa.array([seen]), pa.array([len(a) * len(b)])], schema=schema)


def _nearest(q: DataFrame, r: DataFrame, n_sets: int) -> DataFrame:
    """A row per query, set and tile (q, k, r, both, every), and one per tile with what was looked at (k is -1). Without buckets and pivots, which keep few of such sets apart and
    would send a query to each bucket; the pairs are as many as ever, at some nanoseconds each."""
    from pyspark.sql.pandas.types import to_arrow_type

    dealt, kinds = _tiled(q.select("id", "bits", "apart"), r.select("id", "bits", "apart", "sets"), 2 * TILE, "apart", "sets")
    schema = T.StructType([T.StructField("q", kinds[0]), T.StructField("k", T.IntegerType()), T.StructField("r", kinds[1]), T.StructField("both", T.LongType()), T.StructField("every", T.LongType())])
    types = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _nearest_in_tile(pa.Table.from_batches(list(batches)), n_sets, types)

    return dealt.groupBy("i", "j").applyInArrow(run, schema)


def pairs_in_tiles(queries: DataFrame, refs: DataFrame, at_least: float = 0.0) -> tuple[DataFrame, list[DataFrame]]:
    """((q, r, similarity) of every pair of rows (id, bits) that shares a bit, or of those at or over a similarity; tables that it reads).

    A task gives a tile's pairs back as it finds them. So no pair is shuffled, and a task holds two shares and some millions of pairs. All pairs are compared, by an AND and a count of
    bits a word."""
    from pyspark.sql.pandas.types import to_arrow_type

    q, r = made = [kept(df.select("id", F.array_distinct("bits").alias("bits")).where("size(bits) > 0"), "tiled") for df in (queries, refs)]
    dealt, kinds = _tiled(q, r, TILE)
    schema = T.StructType([T.StructField("q", kinds[0]), T.StructField("r", kinds[1]), T.StructField("similarity", T.DoubleType())])
    types = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _listed(pa.Table.from_batches(list(batches)), at_least, types)

    found = dealt.groupBy("i", "j").applyInArrow(run, schema)
    return (found.where(F.col("similarity") >= at_least) if at_least > 0 else found), made
