"""Set similarity (shared bits over all bits): bits of texts and numbers, nearest references, threshold pairs by prefixes of rare bits or by bands."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelyard.operators.bitindex import DIGITS, best_matches, pairs_in_tiles
from panelyard.sources.shared import drop_kept, kept

#: A pair that meets by prefixes costs as much as so many that are compared in a tile.
PREFIX = 100


#: Characters of a text that are taken apart at a time.
PIECE = 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def text_bits(text: Column, n_bits: int = 2048, width: int = 3) -> Column:
    """On-bit positions of a text: hashes of its character n-grams, folded to n_bits. Null for null.

    A text is cut into pieces and those into characters, so the cost is linear in its length (a `substring` for each n-gram reads the text from its start each time)
    and only one piece's characters are held at a time."""
    size = max(PIECE, width)
    bit = lambda gram: F.pmod(F.xxhash64(gram), F.lit(n_bits)).cast("int")
    none = F.array().cast("array<int>")

    def bits(chars: Column) -> Column:
        gram = lambda i: bit(F.concat(*[F.get(chars, i + k) for k in range(width)]))
        return F.when(F.size(chars) < width, none).otherwise(F.transform(F.sequence(F.lit(0), F.size(chars) - width), gram))

    def piece(pieces: Column, k: Column) -> Column:
        """A piece with the first characters of the next."""
        return F.concat(F.get(pieces, k), F.substring(F.coalesce(F.get(pieces, k + 1), F.lit("")), 1, width - 1)) if width > 1 else F.get(pieces, k)

    def every(pieces: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(pieces) - 1), none, lambda seen, k: F.array_distinct(F.concat(seen, _let(F.split(piece(pieces, k), ""), bits))))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) < width, F.array(bit(text))).when(text.isNotNull(), F.sort_array(_let(cut, every)))


def threshold_bits(vector: str, cut: float) -> Column:
    """Positions (from 0) of a numeric array's components over cut."""
    return F.expr(f"filter(sequence(0, size({vector}) - 1), i -> CAST({vector}[i] AS DOUBLE) > {cut})")


def column_by(df: DataFrame, make: Callable[[list], list], column: str, out: str, kind: str) -> DataFrame:
    """df with a column from a plug-in: make gets a batch of another column's values and returns as many of the SQL type `kind`, null for what it can't read. Other columns pass unchanged."""
    field = T._parse_datatype_string(f"`{out}` {kind}").fields[0]
    rows = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        to = to_arrow_type(field.dataType)
        for b in batches:
            made = make(b.column(column).to_pylist())
            if len(made) != len(b):
                raise ValueError(f"the plug-in for {out!r} returned {len(made)} values for {len(b)} rows")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, to)], [*b.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, field]))


def bits_by(df: DataFrame, make: Callable[[list], list[list[int] | None]], column: str, bits: str = "bits") -> DataFrame:
    """df with bits from a plug-in: make gets a batch of the column's values and returns on-bit positions, null for what it can't read."""
    return column_by(df, make, column, bits, "array<int>")


def keys_by(df: DataFrame, make: Callable[[list], list[str | None]], column: str, key: str = "key") -> DataFrame:
    """df with normalised keys from a plug-in (in place of the lexical ones of `scalars.largest_fragment`); null for what it can't read, and such rows are dropped by `curate` and counted by `funnel`."""
    return column_by(df, make, column, key, "string")


def pair_similarities(queries: DataFrame, refs: DataFrame, query_id: str, ref_id: str, bits: str = "bits", at_least: float | None = None) -> DataFrame:
    """(q, r, similarity) of every pair that shares a bit, which is a large table by design; with at_least, only of pairs at or over it.

    Rows meet in tiles and pairs leave a task as they are found, so nothing but the sets is shuffled."""
    if at_least is not None:
        return threshold_matches(queries, refs, query_id, ref_id, at_least, bits)
    return pairs_in_tiles(_shaped(queries, query_id, bits), _shaped(refs, ref_id, bits))[0]


def _shaped(df: DataFrame, key: str, bits: str, other_than: str | None = None) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(bits).alias("bits"), (F.col(other_than) if other_than else F.lit(None).cast("int")).alias("apart"))


def nearest(queries: DataFrame, refs: DataFrame, query_id: str, ref_id: str, other_than: str | None = None, bits: str = "bits") -> DataFrame:
    """q, nn (0 if nothing is shared), nearest reference (smallest id of equals). other_than: a column whose equal values don't meet. Ids are of any type."""
    best = best_matches(_shaped(queries, query_id, bits, other_than), _shaped(refs, ref_id, bits, other_than).withColumn("sets", F.lit(1).cast("bigint")))
    best = best.withColumnRenamed("q", "_q")
    return queries.select(F.col(query_id).alias("q")).join(best, F.col("q") == F.col("_q"), "left").select("q", F.coalesce("similarity", F.lit(0.0)).alias("nn"), F.col("r").alias("nearest"))


def most_similar(queries: DataFrame, refs: DataFrame, query_id: str, ref_id: str, m: int = 5, other_than: str | None = None, bits: str = "bits") -> DataFrame:
    """(q, rank, r, similarity): the m most similar references of each query that share a bit with it (smaller ids first of equals). The way to list pairs at scale: m rows a query come out,
    and a block of the search holds about 1,024 x 1,024 pairs."""
    best = best_matches(_shaped(queries, query_id, bits, other_than), _shaped(refs, ref_id, bits, other_than).withColumn("sets", F.lit(1).cast("bigint")), m=m)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("similarity").desc(), "r"))
    return best.select("q", rank.alias("rank"), "r", "similarity")


def three_similarities(queries: DataFrame, refs: DataFrame, query_id: str, ref_id: str, set_name: str = "set_name", sets: tuple[str, ...] = ("train", "actives", "known"), bits: str = "bits") -> DataFrame:
    """One job over all reference sets: the best similarity to each (0 if none), and the nearest of the last set. A reference in several sets is one row with flags."""
    flag = sum((F.when(F.col(set_name) == s, F.lit(1 << k)).otherwise(0) for k, s in enumerate(sets)), F.lit(0))
    flags = refs.groupBy(F.col(ref_id).alias("id"), F.col(bits).alias("bits")).agg(F.bit_or(flag).cast("bigint").alias("sets")).withColumn("apart", F.lit(None).cast("int"))
    best = best_matches(queries.select(F.col(query_id).alias("id"), F.col(bits).alias("bits"), F.lit(None).cast("int").alias("apart")), flags, len(sets))
    wide = best.groupBy("q").agg(*[F.max(F.when(F.col("k") == k, F.col("similarity"))).alias(f"sim_{s}") for k, s in enumerate(sets)], F.max(F.when(F.col("k") == len(sets) - 1, F.col("r"))).alias("closest"))
    return queries.select(F.col(query_id).alias("q")).join(wide, "q", "left").select("q", *[F.coalesce(f"sim_{s}", F.lit(0.0)).alias(f"sim_{s}") for s in sets], "closest")


def threshold_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, at_least: float, bits: str = "bits") -> DataFrame:
    """Pairs at or over a threshold, each row of one side with each of the other. Two ways, both exact:

    Where bits are rare, only prefixes of rare bits meet: two sets that are this similar share one of their first n - ceil(t * n) + 1 bits in any common order, here
    rarest first; sizes must fit, and the exact count decides. Where prefixes would meet in more than one of PREFIX pairs, as those of few and common bits do, rows
    meet in tiles (`bitindex.pairs_in_tiles`) and their sets are compared there. The prefixes are counted by bit first."""
    low = at_least - 10.0**-DIGITS  # what may round to the threshold
    l, r = _shaped(left, left_id, bits), _shaped(right, right_id, bits)
    lp, rp = (df.select(F.monotonically_increasing_id().alias("row"), "id", F.array_distinct("bits").alias("b")) for df in (l, r))
    lp, rp = kept(lp, "left"), kept(rp, "right")
    seen = kept(lp.select(F.explode("b").alias("bit")).union(rp.select(F.explode("b").alias("bit"))).groupBy("bit").agg(F.count("*").alias("n")), "bits")

    def prefix(df: DataFrame) -> DataFrame:
        ordered = df.select("row", F.explode("b").alias("bit")).join(seen, "bit").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "bit"))).alias("o"))
        n = F.size("o")
        return ordered.select("row", F.explode(F.slice("o", F.lit(1), (n - F.ceil(low * n) + 1).cast("int"))).alias("s")).select("row", "s.bit")

    first = [kept(prefix(df), "prefix") for df in (lp, rp)]
    count = lambda df, name: df.groupBy("bit").agg(F.count("*").cast("double").alias(name))
    meetings = count(first[0], "x").join(count(first[1], "y"), "bit").agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0.0
    made: list[DataFrame] = []
    if meetings * PREFIX <= lp.count() * rp.count():
        both, (n, m) = F.size(F.array_intersect("lb", "rb")), (F.size("lb"), F.size("rb"))
        met = first[0].toDF("x", "bit").join(first[1].toDF("y", "bit"), "bit").select("x", "y").distinct()
        met = met.join(lp.toDF("x", "q", "lb"), "x").join(rp.toDF("y", "r", "rb"), "y").where((n >= low * m) & (m >= low * n))
        found = met.select("q", "r", F.round(both / (n + m - both), DIGITS).alias("similarity")).where(F.col("similarity") >= at_least)
    else:
        found, made = pairs_in_tiles(l, r, at_least)
    found = kept(found, "matches")
    drop_kept(lp, rp, seen, *first, *made)
    return found


def near_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, at_least: float, bits: str = "bits", bands: int = 20, rows: int = 3) -> DataFrame:
    """Most pairs at or over a threshold, and no others: an opt-in for bits that are too common for `threshold_matches`.

    Sets meet if one of `bands` bands of `rows` min-hashes each is equal, which a pair of similarity s misses with a probability of (1 - s^rows)^bands: by default
    0.8 % at 0.6 and 0.004 % at 0.75. The exact similarity decides about those that meet. Sets without bits meet nothing."""
    def banded(df: DataFrame, key: str, name: str) -> DataFrame:
        shaped = df.select(F.col(key).alias(name), F.array_distinct(bits).alias("own")).where("size(own) > 0")
        least = lambda k: F.array_min(F.transform("own", lambda x: F.xxhash64(x.cast("bigint"), F.lit(k))))
        made = [F.xxhash64(F.lit(b), *[least(b * rows + i) for i in range(rows)]) for b in range(bands)]
        return shaped.withColumn("band", F.explode(F.array(*made))).withColumnRenamed("own", f"{name}b")

    met = banded(left, left_id, "q").join(banded(right, right_id, "r").withColumnRenamed("band", "other"), F.col("band") == F.col("other"))
    n, m, both = F.size("qb"), F.size("rb"), F.size(F.array_intersect("qb", "rb"))
    pairs = met.where((n >= at_least * m) & (m >= at_least * n)).select("q", "r", F.round(both / (n + m - both), DIGITS).alias("similarity"))
    return pairs.where(F.col("similarity") >= at_least).distinct()
