"""What the operators of this subpackage share: tables, the shared folder, hashed words.

Numpy helpers here work on one Arrow batch inside a task; Spark partitions and shuffles.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

U64 = np.uint64
_own_dirs: list[tempfile.TemporaryDirectory] = []
#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a folder of our own, but only if
    all tasks run in this machine's process (master local); on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own_dirs:
            _own_dirs.append(tempfile.TemporaryDirectory(prefix="panelyard-"))
        found = f"file://{_own_dirs[0].name}"
    return found.rstrip("/")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of each query, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, what: str, lasting: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and a lost executor costs no recomputation. Shuffles that made it are dropped.

    Inside `scratch` it goes when that ends; a lasting one goes with the scratch around it, if there is one."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    around = _scratches[:-1] if lasting else _scratches
    if around:
        around[-1].append(out)
    return out


_scratches: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that are written inside are deleted at the end, but for lasting ones."""
    _scratches.append([])
    try:
        yield
    finally:
        forget(*_scratches.pop())


def from_files(df: DataFrame) -> bool:
    """Whether df's rows come from Parquet files, and so have places in them."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


#: Files up to which where each one's rows start is broadcast (16 bytes a file); with more of them rows are joined by shuffles.
FILES = 1_000_000


def numbered(df: DataFrame, row: str) -> DataFrame:
    """df with a number of its own for each row, from 0, the same in every scan: rows of the files before it, by name, and its index in its
    own file. Rows that do not come from Parquet files are written to some first. Texts are not shuffled for it."""
    if not from_files(df):
        df = written(df, "rows")
    file, index, f, start = fresh([*df.columns, row], "_file", "_index", "_f", "_start")
    rows = df.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(index))
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = df.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("n"))
    starts = written(starts.select(F.xxhash64("path").alias(f), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(start)), "starts")
    few = starts.count() <= FILES
    both = rows.join(F.broadcast(starts) if few else starts, F.col(file) == F.col(f))
    return both.select(*[rows[c] for c in df.columns], (F.col(start) + F.col(index)).alias(row))


def forget(*tables: DataFrame | None) -> None:
    """Deletes tables made by `written` that nothing will read again; others are left alone."""
    for df in tables:
        path = getattr(df, "written_to", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str) -> tuple[DataFrame, DataFrame]:
    """(df with `rank`, from 0, of each row in its group by `order`; group columns and `n`, its rows). No group: all rows.

    Rows are range-partitioned by group and order, so a hot group is spread over many tasks, and no window holds rows:
    one row per group and partition is summed up. Rows that are equal in all of `order` get ranks in any order.
    """
    part, at, low, before, tie = fresh([*df.columns, rank, "n"], "_part", "_at", "_low", "_before", "_tie")
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order, F.col(tie)]
    rows = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    rows = written(rows.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "sorted")  # narrow rows, by its callers' choice
    counts = rows.groupBy(*group, part).agg(F.count("*").alias("n"), F.min(at).alias(low))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, part, low, "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    own = fresh([*df.columns, part, at, low, before, rank, "n"], *[f"_g{i}" for i in range(len(group) + 1)])
    starts = written(starts.withColumnsRenamed(dict(zip([*group, part], own))), "starts")
    same = rows[part] == starts[own[-1]]
    for g, o in zip(group, own):
        same = same & rows[g].eqNullSafe(starts[o])
    out = rows.join(starts, same).select(*[rows[c] for c in df.columns], (F.col(at) - F.col(low) + F.col(before)).alias(rank))
    return out, starts.groupBy(*[F.col(o).alias(g) for g, o in zip(group, own)]).agg(F.sum("n").alias("n"))


def fresh(columns: list[str], *names: str) -> list[str]:
    """names, each with underscores appended until no given column has it (clashing extra columns)."""
    out = []
    for n in names:
        while n.lower() in {c.lower() for c in columns} | {c.lower() for c in out}:
            n += "_"
        out.append(n)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values: xor-shifts and odd multipliers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_PRIME = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, U64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 1024), _PRIME, U64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def passes(texts: pa.Array, *more: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows holding about PASS_BYTES of text in all given arrays."""
    size = np.zeros(len(texts), np.int64)
    for a in (texts, *more):
        size += np.asarray(pc.fill_null(pc.binary_length(a), 0).cast(pa.int64()))
    at = 0
    total = np.cumsum(size)
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PASS_BYTES, "right")))
        yield at, end
        at = end


def word_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in bytes of the words (runs of bytes other than 9-13 and 32) of texts that lie one after the other and end at `ends`."""
    starts, stops = [], []
    cuts = np.unique(ends[(ends > 0) & (ends < len(data))])
    for lo in range(0, len(data), PASS_BYTES):
        hi = min(len(data), lo + PASS_BYTES)
        inside = ~_SPACE[data[max(lo - 1, 0) : hi]]
        if not lo:
            inside = np.concatenate([[False], inside])
        here = inside[1:]
        split = np.zeros(len(here), bool)
        own = cuts[(cuts >= lo) & (cuts < hi)] - lo
        split[own] = True
        starts.append(np.flatnonzero(here & (~inside[:-1] | split)) + lo)
        stops.append(np.flatnonzero(inside[:-1] & (~here | split)) + lo)
    starts, stops = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, stops))
    return starts, np.append(stops, len(data)) if len(starts) > len(stops) else stops


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of bytes other than 9-13 and 32) of all texts; per text the end offset. Null: no words.

    Texts are hashed in pieces of about PASS_BYTES, cut between words (a longer word in parts), so what it takes beside the result is about 24 bytes a word."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or ends[-1] == ends[0]:
        return np.zeros(0, U64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends[1:] - ends[0]
    starts, stops = word_places(data, ends)
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(stops, lo + PASS_BYTES, "right")))
        hi = int(stops[to - 1])
        if to == at + 1 and hi - lo > PASS_BYTES:  # the sum over a long word's parts, each times a power of the prime
            out[at] = U64(sum(int((_BYTE[data[x : min(hi, x + PASS_BYTES)]] * _power(min(hi, x + PASS_BYTES) - x)).sum(dtype=U64)) * pow(_PRIME, x - lo, 1 << 64) for x in range(lo, hi, PASS_BYTES)) & (2**64 - 1))
        else:
            out[at:to] = _sums(data[lo:hi], starts[at:to] - lo, stops[at:to] - starts[at:to])
        at = to
    return mix(out), np.searchsorted(starts, ends, "left").astype(np.int64)


#: Values of the bytes at the first places of a word, and how many places have such a table.
_PLACES = 16
_PLACED = _BYTE * np.array([pow(_PRIME, k, 1 << 64) for k in range(_PLACES)], U64)[:, None]


def _sums(data: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of words of n bytes from `first` on: sum of the values of their bytes, each times the prime to the power of its place."""
    out = np.zeros(len(n), U64)
    order = np.argsort(-np.minimum(n, _PLACES).astype(np.int8), kind="stable")
    start, total = first[order], np.zeros(len(n), U64)
    more = np.searchsorted(-np.minimum(n, _PLACES)[order], -np.arange(_PLACES), "left")  # how many words have more bytes than that
    for k in range(_PLACES):
        total[: more[k]] += _PLACED[k][data[start[: more[k]] + k]]
    out[order] = total
    far = np.flatnonzero(n > _PLACES)
    if len(far):
        left = n[far] - _PLACES
        begin = np.cumsum(left) - left
        place = np.arange(int(left.sum())) - np.repeat(begin, left) + _PLACES
        value = _BYTE[data[np.repeat(first[far], left) + place]] * _power(int(place.max()) + 1)[place]
        out[far] += np.add.reduceat(value, begin)
    return out


def windows(words: np.ndarray, ends: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, first word) of every k-word window; a text of 1 to k-1 words is one window when short."""
    n = np.diff(ends, prepend=0)
    begin = ends - n
    out = np.zeros(len(words), U64)
    padded = np.concatenate([words, np.zeros(k, U64)])
    doc = np.repeat(np.arange(len(ends)), n)
    at = np.arange(len(words)) - np.repeat(begin, n)
    room = np.repeat(n, n) - at
    for j in range(k):
        x = padded[j : j + len(words)] * U64((2 * j + 1) * 0x9FB21C651E98DF25 % 2**64)
        if short:
            x[room <= j] = 0
        x ^= x >> U64(29)
        out += x
    keep = room >= k
    if short:
        keep |= (room < k) & (at == 0)
    return mix(out[keep]), doc[keep], at[keep]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of edges (a, b); root is the smallest node. Nodes are longs, not null.

    Alternates stars around larger and smaller neighbours; each round is written to the shared folder. Joins
    follow plain exchanges so that Spark can split a hot node's partition.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        last = now
        now = written(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b"), F.col("m"))).distinct(), "edges")
        forget(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
