"""Near-duplicate documents: dart MinHash signatures of weighted word shingles, banded, then verified.

A document's weighted set holds its five-word windows with their counts (lower-cased words; a text
of one to four words is one window). Two documents are linked when the weighted Jaccard similarity
of these sets is at least 0.8. The bands propose pairs (a pair at 0.8 is missed with a probability
of 3e-5, less above), the sets themselves decide. Documents with equal sets are one
representative with members, so copies are never expanded into pairs.

Inside a band's bucket each representative is compared with the bucket's smallest one. In buckets
whose members are still in different components after that, all members outside the largest component are
compared with all members, in blocks of bounded size that give back a spanning forest of their
links. So no link that a bucket proposes is lost, no pairs are emitted, and a bucket of n close
copies costs about n comparisons.

Rows are told apart by numbers of their own, their places in the files that they are read from, never by their ids, so
repeated ids with different texts are documents like any others.

Defined cases: null, empty and blank texts have no windows and are classes of their own. Repeated rows are copies. A
class is named by its smallest id that is not null (null if no row has one), and its kept row is the first by id (nulls
last), then by row number: exactly one in each class. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, components, forget, fresh, hashed_words, mix, numbered, passes, scratch, table, windows, written

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
#: Most members on a side of a block of comparisons, and most cells that they hold.
BLOCK, BLOCK_CELLS = 512, 2_000_000
_STEP = U64(0x9E3779B97F4A7C15)


def weighted_cells(texts: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(cell, text number), by text: the j-th time that a window occurs is a unit cell of its own."""
    words, ends = hashed_words(pc.utf8_lower(pc.fill_null(texts, "")))
    window, doc, _ = windows(words, ends, k)
    if not len(window):
        return window, doc
    tagged = mix(window + mix(doc.astype(U64) + _STEP))
    order = np.argsort(tagged)
    sorted_ = tagged[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    nth = np.empty(len(order), U64)
    nth[order] = (np.arange(len(order)) - run).astype(U64)
    return mix(window + nth * _STEP), doc


def dart_signatures(cells: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k earliest dart times. cells: unit regions, hashed; owner: their set, ascending. A set without cells has inf only.

    Each cell has one endless series of darts, the same in every set: exponential gaps from hashes, and a
    coordinate for each dart. A set of weight W throws those that arrive before k (ln k + 3) / W, and
    repeats with twice the time if a coordinate is still empty. Two sets agree in a coordinate
    with the probability of their weighted Jaccard similarity.
    """
    out = np.full(n * k, np.inf)
    weight = np.bincount(owner, minlength=n)
    until = k * (np.log(k) + 3) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        pick = todo[owner]
        live, of = cells[pick], owner[pick]
        time = np.zeros(len(live))
        step = 0
        while len(live):
            step += 1
            dart = mix(live + U64(step * int(_STEP) % 2**64))
            time = time - np.log1p(-(dart >> U64(11)).astype(np.float64) * 2.0**-53)
            hit = time <= until[of]
            live, of, time, dart = live[hit], of[hit], time[hit], dart[hit]
            np.minimum.at(out, of * k + (mix(dart) % U64(k)).astype(np.int64), time)
        todo &= np.isinf(out.reshape(n, k)).any(1)
        until = until * 2
    return out.reshape(n, k)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, text) -> (row, id, key, weight, bands); key and bands null without windows."""
    for b in batches:
        for i, j in passes(b.column(2)):
            yield _sign(b.slice(i, j - i))


def _sign(b: pa.RecordBatch) -> pa.RecordBatch:
    texts = b.column(2)
    cells, doc = weighted_cells(texts)
    n = len(b)
    weight = np.bincount(doc, minlength=n)
    has = weight > 0
    first = np.cumsum(weight)[has] - weight[has]
    key = np.zeros((n, 2), U64)
    if has.any():
        key[has, 0] = np.add.reduceat(mix(cells + U64(1)), first)
        key[has, 1] = np.add.reduceat(mix(cells ^ _STEP), first)
    times = dart_signatures(cells, doc, n, BANDS * ROWS).view(U64).reshape(n, BANDS, ROWS)
    band = np.broadcast_to(mix(np.arange(BANDS, dtype=U64) + U64(77)), (n, BANDS)).copy()
    for r in range(ROWS):
        band = mix(band + times[:, :, r])
    keys = pa.array([x.tobytes() if h else None for x, h in zip(key, has)], pa.binary())
    at = np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(band[has].reshape(-1).view(np.int64)))
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), keys, pa.array(weight), lists], ["row", "id", "key", "weight", "bands"])


def similarities(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the rows' texts."""
    out = np.zeros(len(a))
    for i, j in passes(a, b):
        n = j - i
        ca, da = weighted_cells(a.slice(i, n))
        cb, db = weighted_cells(b.slice(i, n))
        both = np.concatenate([mix(ca + mix(da.astype(U64) + _STEP)), mix(cb + mix(db.astype(U64) + _STEP))])
        order = np.argsort(both)
        equal = both[order[1:]] == both[order[:-1]]
        common = np.bincount(np.concatenate([da, db])[order[1:][equal]], minlength=n)
        total = np.bincount(da, minlength=n) + np.bincount(db, minlength=n)
        out[i:j] = common / np.maximum(total - common, 1)
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        good = pa.array(similarities(b.column("ta"), b.column("tb")) >= SIMILARITY)
        yield b.select(["a", "b"]).filter(good)


def common_cells(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], na: int, nb: int) -> np.ndarray:
    """na x nb counts of cells that texts of two lists of (cell, text number) share.

    Cells that many texts on both sides hold are columns of two matrices, multiplied in slices; the rest are counted one by one.
    """
    both = np.intersect1d(a[0], b[0])
    out = np.zeros(na * nb, np.int64)
    if not len(both):
        return out.reshape(na, nb)
    sides = []
    for cell, doc in (a, b):
        at = np.minimum(np.searchsorted(both, cell), len(both) - 1)
        hit = both[at] == cell
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], doc[hit][order]))
    (ka, da), (kb, db) = sides
    fa, fb = np.bincount(ka, minlength=len(both)), np.bincount(kb, minlength=len(both))
    often = np.flatnonzero(fa * fb >= 256)
    slot = np.full(len(both), -1)
    slot[often] = np.arange(len(often))
    for first in range(0, len(often), 4096):
        matrices = []
        for k, d, n in ((ka, da, na), (kb, db, nb)):
            s = slot[k]
            pick = (s >= first) & (s < first + 4096)
            m = np.zeros((n, min(4096, len(often) - first)), np.float32)
            m[d[pick], s[pick] - first] = 1
            matrices.append(m)
        out += (matrices[0] @ matrices[1].T).astype(np.int64).reshape(-1)
    rare = slot[kb] < 0
    kb, db = kb[rare], db[rare]
    begin = np.cumsum(fa) - fa
    reps = fa[kb]
    within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    rows = da[np.repeat(begin[kb], reps) + within]
    out += np.bincount(rows * nb + np.repeat(db, reps), minlength=na * nb)
    return out.reshape(na, nb)


def _block_links(t: pa.Table) -> pa.Table:
    """Links of a block's outer members with its others: for each member with one, the first that it is linked with, and those of the first."""
    outer = t["outer"].to_numpy()
    a, b = t.filter(pa.array(outer)), t.filter(pa.array(~outer))
    links: set[tuple[int, int]] = set()
    if len(a) and len(b):
        cells = [_all_cells(x["text"].combine_chunks()) for x in (a, b)]
        wa, wb = (np.bincount(c[1], minlength=len(x)) for c, x in zip(cells, (a, b)))
        common = common_cells(*cells, len(a), len(b))
        near = common / np.maximum(wa[:, None] + wb[None, :] - common, 1) >= SIMILARITY
        ia, ib = a["x"].to_numpy(), b["x"].to_numpy()
        near &= ia[:, None] != ib[None, :]
        links = _forest_links(ia, ib, near)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _all_cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = [(weighted_cells(texts.slice(i, j - i)), i) for i, j in passes(texts)]
    return np.concatenate([c[0] for c, _ in found]), np.concatenate([c[1] + i for c, i in found])


def _forest_links(ia: np.ndarray, ib: np.ndarray, near: np.ndarray) -> set[tuple[int, int]]:
    """Pairs that keep the components of a link matrix, fewer than its nodes."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = set()
    for r, c in zip(*(v.tolist() for v in np.nonzero(near))):
        x, y = top(int(ia[r])), top(int(ib[c]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.add((int(ia[r]), int(ib[c])))
    return out


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of pairs (a, b) whose texts are similar enough. Texts are shuffled, never broadcast, whatever their files' size."""
    withed = pairs.join(texts.toDF("a", "ta").hint("merge"), "a").join(texts.toDF("b", "tb").hint("merge"), "b")
    return withed.select("a", "b", "ta", "tb").mapInArrow(_verified, "a bigint, b bigint")


def _classed(rows: DataFrame) -> DataFrame:
    """(row, id, text) -> (row, id, class_row (number of the class's kept row), class_id, copies (rows with the same windows))."""
    signed = written(rows.mapInArrow(_signed, "row bigint, id bigint, key binary, weight bigint, bands array<bigint>"), "signed")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "weight", "bands")).alias("r")
    reps = written(signed.where("key IS NOT NULL").groupBy("key").agg(first, F.count("*").alias("copies")).select("key", "r.*", "copies"), "reps")
    roots = _roots(rows.select("row", "text"), reps)
    rooted = reps.join(roots, F.col("row") == F.col("node"), "left").select("key", "unnamed", "id", "row", "copies", F.coalesce("root", "row").alias("root"))
    rooted = written(rooted, "rooted")
    best = rooted.groupBy("root").agg(F.min(F.struct("unnamed", "id", "row")).alias("b")).select("root", F.col("b.id").alias("class_id"), F.col("b.row").alias("class_row"))
    classes = rooted.join(best, "root").select(F.col("key").alias("class_key"), "copies", "class_id", "class_row")
    out = signed.select("row", "id", "key").join(classes, F.col("key") == F.col("class_key"), "left").select(
        "row", "id", F.coalesce("class_row", "row").alias("class_row"), F.when(F.col("class_row").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )
    out = written(out, "classes", lasting=True)
    forget(signed, reps, roots, rooted)
    return out


def _roots(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, root) of the representatives (row numbers) that are linked with others; texts: row, text."""
    named = reps.select(F.col("row").alias("x"), "weight", F.explode("bands").alias("band"))
    shared = named.groupBy("band").agg(F.min("x").alias("low"), F.count("*").alias("n")).where("n > 1")
    members = written(named.join(shared.select("band", "low"), "band").select("band", "x", "weight", "low"), "members")
    wanted = members.select(F.col("x").alias("row")).distinct()
    # texts are joined by shuffles at every size, so that plans don't change with it
    texts = written(texts.join(wanted.hint("merge"), "row", "left_semi"), "texts")
    stars = members.where("x <> low").select(F.col("low").alias("a"), F.col("x").alias("b")).distinct()
    links = written(_links(stars, texts), "links")
    roots = written(components(links), "roots")
    # what the stars leave open: members of a bucket in different components
    rooted = members.join(roots.withColumnRenamed("node", "x"), "x", "left").select("band", "x", "weight", "low", F.coalesce("root", "x").alias("root"))
    rooted = written(rooted, "rooted")
    tally = rooted.groupBy("band", "root").agg(F.count("*").alias("k"), F.max("weight").alias("heaviest"))
    open_ = tally.groupBy("band").agg(F.max(F.struct("k", "root")).alias("main"), F.sum("k").alias("n"), F.count("*").alias("parts"), F.max("heaviest").alias("heaviest")).where("parts > 1 AND n > 2")
    side = F.expr(f"greatest(8, least({BLOCK}, {BLOCK_CELLS} div heaviest))")
    open_ = open_.select("band", F.col("main.root").alias("main"), F.ceil((F.col("n") - F.col("main.k")) / side).alias("nb"), F.ceil(F.col("n") / side).alias("vb"))
    left = rooted.join(open_, "band").withColumn("h", F.xxhash64("x", F.lit(3)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    outer = left.where("root <> main").select("band", F.pmod("h", "nb").alias("i"), every("vb").alias("j"), F.lit(True).alias("outer"), "x")
    inner = left.select("band", every("nb").alias("i"), F.pmod("h", "vb").alias("j"), F.lit(False).alias("outer"), "x")
    dealt = written(outer.unionByName(inner), "dealt")
    if not dealt.isEmpty():
        blocks = dealt.join(texts.toDF("x", "text").hint("merge"), "x").groupBy("band", "i", "j").applyInArrow(_block_links, "a bigint, b bigint")
        more = written(links.union(blocks), "links")
        forget(roots)
        roots = written(components(more), "roots")
        forget(more)
    forget(members, texts, links, rooted, dealt)
    return roots


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, class_id (smallest id of its component), copies (rows with the same windows), kept."""
    row = fresh(docs.columns, "_row")[0]
    with scratch():
        rows = numbered(docs, row).select(F.col(row).alias("row"), F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
        classes = _classed(rows)
    return classes.select(F.col("id").alias("doc_id"), "class_id", "copies", (F.col("row") == F.col("class_row")).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The kept row of each class, with the columns of docs; rows, not ids, are dropped."""
    row = fresh(docs.columns, "_row")[0]
    own = numbered(docs, row)
    with scratch():
        found = _classed(own.select(F.col(row).alias("row"), F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")))
        kept = written(found.where("row = class_row").select(F.col("row").alias(row)), "kept", lasting=True)
        forget(found)
    return own.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
