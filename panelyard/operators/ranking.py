"""Ranks, running sums and exact quantiles from range-partitioned sorts: no window and no task holds a whole group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.sources.shared import drop_kept, kept


def _running(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str]) -> tuple[DataFrame, list[DataFrame]]:
    """(what `running` gives, the tables that it reads)."""
    keys = [F.col(c).asc_nulls_first() for c in by] + order
    parted = kept(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*by, "_part").orderBy(*order)
    totals = parted.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums)])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = {c: f"_b{i}" for i, c in enumerate([*by, "_part"])}
    before = totals.select(*[F.col(c).alias(n) for c, n in names.items()], *[F.coalesce(F.sum(f"_t{i}").over(earlier), F.lit(0)).alias(f"_s{i}") for i in range(len(sums))])
    before = kept(before, "starts")
    local = parted.withColumns({out: F.sum(c).over(inside) for c, out in sums.items()})
    same = F.lit(True)
    for c, n in names.items():
        same = same & local[c].eqNullSafe(before[n])
    joined = local.join(before, same)
    return joined.select(*[local[c] for c in df.columns], *[(local[out] + F.col(f"_s{i}")).alias(out) for i, out in enumerate(sums.values())]), [parted, before]


def running(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """df with, for each column of `sums`, its sum (under the given name) over the rows of the group up to and with this one.

    Rows are range-partitioned by group and order; windows go over one group's rows in one partition, and over one row
    per group and partition. The order must tell all rows of a group apart. The rows are a table in the shared folder, which the result reads.
    """
    return _running(df, by, order, sums)[0]


def ranked(df: DataFrame, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """df with the rank, from 1, of each row in its group."""
    return running(df.withColumn("_one", F.lit(1).cast("bigint")), by, order, {"_one": rank}).drop("_one")


def smallest(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The n first rows by columns that tell all rows apart (nulls first); all if there are fewer. Only these columns are sorted, by ranges, to find where the n-th row is; then rows are filtered,
    so that no task gathers them."""
    keys = df.select(*order)
    upto, tables = _running(keys.withColumn("_one", F.lit(1).cast("bigint")), [], [F.col(c).asc_nulls_first() for c in order], {"_one": "_rank"})
    last = upto.where(F.col("_rank") == n).select(*order).first() if n > 0 else None
    fewer = last is None and n > 0
    drop_kept(*tables)
    if fewer:
        return df
    if last is None:
        return df.limit(0)
    before, same = F.lit(False), F.lit(True)
    for c in order:
        at = F.lit(last[c]).cast(df.schema[c].dataType)
        less = (F.col(c).isNull() & at.isNotNull()) | F.coalesce(F.col(c) < at, F.lit(False))
        before, same = before | (same & less), same & F.col(c).eqNullSafe(at)
    return df.where(before | same)


def quantiles(df: DataFrame, column: str, wanted: dict[str, float], by: tuple[str, ...] = (), times: str | None = None) -> DataFrame:
    """Exact quantiles of a column's values that are not null (linear between the two next to the place), one row a group; none for a group without values.
    times: a column that says how often a row counts.

    Values are counted first, in one pass over df, so repeated ones cost nothing, and only the values around the wanted places are gathered.
    """
    keys = list(by)
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("_v")).agg((F.sum(times) if times else F.count("*")).alias("_n"))
    upto, tables = _running(counts, keys, [F.col("_v").asc()], {"_n": "_upto"})
    total = tables[0].groupBy(*keys).agg(F.sum("_n").alias("_total"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        total = total.withColumnRenamed(k, f"_k{i}")
        same = same & upto[k].eqNullSafe(F.col(f"_k{i}"))
    placed = upto.join(total, same) if keys else upto.crossJoin(total)  # without groups the total is one row
    picks = []
    for i, q in enumerate(wanted.values()):
        place = F.lit(q) * (F.col("_total") - 1)
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{end}{i}"))
    found = placed.groupBy(*keys, "_total").agg(*picks)
    out = []
    for i, (name, q) in enumerate(wanted.items()):
        place = F.lit(q) * (F.col("_total") - 1)
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place - F.floor(place))).alias(name))
    done = kept(found.select(*keys, *out), "quantiles")
    drop_kept(*tables)
    return done


def kth(df: DataFrame, column: str, index: int) -> float:
    """The value at an index (from 0) of the sorted column, nulls left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    upto, tables = _running(counts, [], [F.col("_v").asc()], {"_n": "_upto"})
    row = upto.where((F.col("_upto") > index) & (F.col("_upto") - F.col("_n") <= index)).first()
    drop_kept(*tables)
    if row is None or math.isnan(row["_v"]):
        raise IndexError(index)
    return float(row["_v"])
