"""Splits, folds, scrambled labels and weights: functions of ids, alike on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions.scalars import hash_bucket
from panelyard.operators.ranking import ranked

def is_test(column: str, percent: int = 20, seed: int = 0) -> Column:
    return hash_bucket(F.col(column), seed) % 100 < percent


def random_split(df: DataFrame, column: str = "id", percent: int = 20, seed: int = 0) -> DataFrame:
    return df.withColumn("split", F.when(is_test(column, percent, seed), "test").otherwise("train"))


def group_folds(df: DataFrame, group: str = "grp", k: int = 5) -> DataFrame:
    """df with a fold per group: groups by size, dealt out back and forth over min(k, groups) folds; no group is in two. One rule at every number of groups."""
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    order = ranked(sizes, [], [F.desc("_n"), F.col(group).asc_nulls_first()], "_rank")
    k = max(1, min(k, sizes.count()))
    lap, at = F.floor((F.col("_rank") - 1) / k), (F.col("_rank") - 1) % k
    folds = order.select(F.col(group).alias("_g"), F.when(lap % 2 == 0, at).otherwise(k - 1 - at).cast("bigint").alias("fold"))
    return df.join(folds, df[group].eqNullSafe(F.col("_g"))).drop("_g")


def temporal_split(df: DataFrame, cutoff: int, year: str = "year") -> DataFrame:
    """split: train before the cutoff, test from it on, null without a year."""
    return df.withColumn("split", F.when(F.col(year) < cutoff, "train").when(F.col(year) >= cutoff, "test"))


def temporal_counts(df: DataFrame, cutoff: int, label: str = "label_pre", min_train: int = 50, min_test: int = 20) -> DataFrame:
    """One row: train rows with their era's label, train rows without, test rows, rows without a year, and whether there are enough."""
    one = temporal_split(df, cutoff).agg(
        F.count_if((F.col("split") == "train") & F.col(label).isNotNull()).alias("n_train"), F.count_if((F.col("split") == "train") & F.col(label).isNull()).alias("n_dropped"),
        F.count_if(F.col("split") == "test").alias("n_test"), F.count_if(F.col("split").isNull()).alias("n_undated"),
    )
    return one.withColumn("evaluated", (F.col("n_train") >= min_train) & (F.col("n_test") >= min_test))


def scrambled(df: DataFrame, column: str = "id", label: str = "y", seed: int = 11) -> DataFrame:
    """df with y_scrambled, a permutation of the labels: rows in id order get the labels in hash order. Both ranks come from range-partitioned sorts."""
    rows = df.select(column, label).where(F.col(column).isNotNull())
    h = hash_bucket(F.col(column), seed)
    by_id = ranked(rows, [], [F.col(column)], "_rank").select(F.col(column).alias("_id"), "_rank")
    by_hash = ranked(rows, [], [h, F.col(column)], "_rank").select(F.col(label).alias("y_scrambled"), "_rank")
    mixed = by_id.join(by_hash, "_rank").select("_id", "y_scrambled")
    return df.join(mixed, df[column] == mixed["_id"], "left").drop("_id")


def group_weights(df: DataFrame, group: str = "grp") -> DataFrame:
    """df with weight 1 / size of its group. The sizes are joined back, so a hot group is not one window."""
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).withColumnRenamed(group, "_g")
    return df.join(sizes, df[group].eqNullSafe(sizes["_g"])).withColumn("weight", 1 / F.col("_n")).drop("_n", "_g")


def one_per_group(df: DataFrame, group: str = "grp", order: str = "id") -> DataFrame:
    """The first row of each group."""
    return df.groupBy(group).agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def pair_eligibility(wide: DataFrame, primary: str, comparators: list[str] | None, groups: str | None = None, min_rows: int = 25, min_groups: int = 2, key: str = "structure") -> DataFrame:
    """(comparator, n, reason): pairs of the primary with each comparator; None stands for all other targets of the panel, [] for none.

    The targets of a panel are its columns other than the key, the groups and the differences."""
    found = [c for c in wide.columns if c not in (primary, key, groups) and not c.startswith("delta_")]
    wanted = found if comparators is None else comparators
    spark = wide.sparkSession
    if not wanted:
        return spark.createDataFrame([], "comparator string, n bigint, reason string")
    have = [c for c in wanted if c in wide.columns]
    counts = wide.agg(*[F.count_if(F.col(primary).isNotNull() & F.col(c).isNotNull()).alias(c) for c in have], *([F.countDistinct(groups).alias("_groups")] if groups else [F.lit(min_groups).alias("_groups")]))
    rows = [F.struct(F.lit(c).alias("comparator"), (F.col(c) if c in have else F.lit(0)).cast("bigint").alias("n"),
                     (F.when(F.col("_groups") < min_groups, "too few groups").when(F.col(c) < min_rows, "too few rows") if c in have else F.lit("target absent")).cast("string").alias("reason")) for c in wanted]
    return counts.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def oof_mean(df: DataFrame, group: str = "grp", fold: str = "fold", y: str = "y") -> DataFrame:
    """df with p: the mean of y in all other folds (each row predicted once, without its own fold). Two small aggregations, no loop."""
    by_fold = df.groupBy(fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    total = by_fold.agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    means = by_fold.crossJoin(total).select(F.col(fold).alias("_f"), ((F.col("_ts") - F.col("_s")) / F.nullif(F.col("_tn") - F.col("_n"), F.lit(0))).alias("p"))  # a row per fold, one row
    return df.join(F.broadcast(means), df[fold].eqNullSafe(F.col("_f")), "left").drop("_f")
