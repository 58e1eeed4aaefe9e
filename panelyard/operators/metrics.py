"""Evaluation of predictions: errors, folds, applicability bins, leakage, conformal band, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.operators.ranking import kth, quantiles

#: Half-open similarity bins, low end inside.
AD_BINS = ((0.0, 0.3), (0.3, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 1.0000001))
FINE_BINS = tuple((k / 10, (k + 1) / 10 if k < 9 else 1.0000001) for k in range(10))
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def r2(y: str = "y", p: str = "p") -> Column:
    """1 - SSE / SST; of a constant y, 1 if every error is 0, else 0."""
    sse = F.sum((F.col(y) - F.col(p)) ** 2)
    sst = F.regr_syy(F.col(y), F.col(y))
    return F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1 - sse / sst)


def regression(df: DataFrame, *by: str, y: str = "y", p: str = "p", digits: int = 6) -> DataFrame:
    """n, r2, mae, rmse per group (or of all rows); rows without y or p are left out."""
    err = F.col(y) - F.col(p)
    rows = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(r2(y, p), digits).alias("r2"), F.round(F.avg(F.abs(err)), digits).alias("mae"), F.round(F.sqrt(F.avg(err * err)), digits).alias("rmse"))


def fold_summary(df: DataFrame, fold: str = "fold") -> DataFrame:
    """One row: folds, mean and population standard deviation of their R2."""
    return regression(df, fold, digits=9).agg(F.count("*").alias("folds"), F.round(F.avg("r2"), 6).alias("r2_mean"), F.round(F.stddev_pop("r2"), 6).alias("r2_std"))


def _bins(spark: SparkSession, bins: tuple[tuple[float, float], ...]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(i, *b) for i, b in enumerate(bins)], "bin int, lo double, hi double"))  # a fixed, short list


def ad_curve(df: DataFrame, sim: str = "nn", bins: tuple[tuple[float, float], ...] = AD_BINS) -> DataFrame:
    """n and mae by similarity bin; empty bins stay, with n 0 and no mae."""
    b = _bins(df.sparkSession, bins)
    binned = df.join(b, (F.col(sim) >= F.col("lo")) & (F.col(sim) < F.col("hi"))).groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("y") - F.col("p"))), 6).alias("mae"))
    return b.join(binned, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"), "mae")


def ad_reliability(df: DataFrame, halfwidth: float, sim: str = "nn") -> DataFrame:
    """Ten bins: n, percent of all, mae, rmse, coverage at the half-width, median residual. Empty bins stay."""
    b = _bins(df.sparkSession, FINE_BINS)
    rows = df.join(b, (F.col(sim) >= F.col("lo")) & (F.col(sim) < F.col("hi"))).select("bin", F.abs(F.col("y") - F.col("p")).alias("err"))
    err = F.col("err")
    binned = rows.groupBy("bin").agg(
        F.count("*").alias("n"), F.round(F.avg(err), 6).alias("mae"), F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"), F.round(F.avg((err <= halfwidth).cast("int")), 6).alias("coverage"),
    )
    medians = quantiles(rows, "err", {"median_residual": 0.5}, ("bin",))
    binned = binned.join(F.broadcast(medians), "bin", "left")  # ten rows
    total = df.agg(F.count("*").alias("total"))
    return b.join(binned, "bin", "left").crossJoin(F.broadcast(total)).select(
        "bin", "lo", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("total") > 0, F.round(100 * F.coalesce("n", F.lit(0)) / F.col("total"), 4)).alias("pct"),
        "mae", "rmse", "coverage", F.round("median_residual", 6).alias("median_residual"),
    )


def similarity_error_correlation(df: DataFrame, sim: str = "nn") -> DataFrame:
    return df.agg(F.round(F.corr(F.col(sim), F.abs(F.col("y") - F.col("p"))), 6).alias("correlation"), F.count("*").alias("n"))


def ad_cumulative(df: DataFrame, sim: str = "nn", thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Rows and mae on either side of each threshold, in one pass over the rows."""
    err = F.abs(F.col("y") - F.col("p"))
    aggs = []
    for i, t in enumerate(thresholds):
        over = F.col(sim) >= t
        aggs += [F.count_if(over).alias(f"na{i}"), F.count_if(~over).alias(f"nb{i}"), F.round(F.avg(F.when(over, err)), 6).alias(f"ma{i}"), F.round(F.avg(F.when(~over, err)), 6).alias(f"mb{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(t).alias("threshold"), F.col(f"na{i}").alias("n_above"), F.col(f"nb{i}").alias("n_below"), F.col(f"ma{i}").alias("mae_above"), F.col(f"mb{i}").alias("mae_below")) for i, t in enumerate(thresholds)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def group_overlap(df: DataFrame, group: str = "grp", test: str = "is_test") -> DataFrame:
    """One row: train and test rows, distinct train groups, share of test rows whose group is in train too."""
    trained = df.where(~F.col(test) & F.col(group).isNotNull()).select(F.col(group).alias("_g")).distinct()
    marked = df.join(trained, df[group] == trained["_g"], "left")
    hit = F.when(F.col(test), F.col("_g").isNotNull().cast("int"))
    return marked.agg(F.count_if(~F.col(test)).alias("n_train"), F.count_if(F.col(test)).alias("n_test"), F.countDistinct(F.when(~F.col(test), F.col(group))).alias("train_groups"), F.round(F.avg(hit), 6).alias("overlap"), F.round(100 * F.avg(hit), 1).alias("overlap_pct"))


def leakage(nn: DataFrame, overlap: DataFrame, sim: str = "nn") -> DataFrame:
    """One row: median and 95th percentile of the nearest similarity, near-identical rows, overlap of groups."""
    q = quantiles(nn, sim, {"nn_median": 0.5, "nn_p95": 0.95})
    one = nn.agg(F.count_if(F.col(sim) >= 0.999).alias("near_identical")).join(q, F.lit(True), "left")
    one = one.select(F.round("nn_median", 6).alias("nn_median"), F.round("nn_p95", 6).alias("nn_p95"), "near_identical")
    return one.crossJoin(overlap.select("overlap"))  # one row each


def conformal_band(df: DataFrame, calibration: Column, coverage: float = 0.9, y: str = "y", p: str = "p") -> DataFrame:
    """One row: calibration rows, half-width, rows and share covered among the others.

    The half-width is the residual at index ceil(level * (n - 1)) (from 0) with level = min(1, ceil((n + 1) * coverage) / n).
    """
    rows = df.withColumn("_e", F.abs(F.col(y) - F.col(p))).withColumn("_cal", calibration)
    cal = rows.where("_cal AND _e IS NOT NULL")
    n = cal.count()
    if not n:
        return df.sparkSession.createDataFrame([(0, None, None, None)], "n_cal bigint, halfwidth double, n_test bigint, covered double")
    level = min(1.0, -(-((n + 1) * round(coverage * 1000)) // 1000) / n)
    index = int(-(-(level * (n - 1)) // 1))
    halfwidth = kth(cal, "_e", index)
    return rows.where("NOT _cal AND _e IS NOT NULL").agg(F.lit(n).cast("bigint").alias("n_cal"), F.lit(round(halfwidth, 6)).alias("halfwidth"), F.count("*").alias("n_test"), F.round(F.avg((F.col("_e") <= halfwidth).cast("int")), 6).alias("covered"))


def mean_baseline(df: DataFrame, test: Column, y: str = "y") -> DataFrame:
    """Errors of the train mean on the test rows."""
    mean = df.where(~test).agg(F.avg(y).alias("p"))
    return regression(df.where(test).crossJoin(F.broadcast(mean)))  # one row


def ridge_one_feature(df: DataFrame, alpha: float = 1.0, x: str = "x", y: str = "y") -> DataFrame:
    """Slope and intercept of the one-feature ridge with penalty alpha on the slope, in one aggregation."""
    slope = F.regr_sxy(F.col(y), F.col(x)) / (F.regr_sxx(F.col(y), F.col(x)) + alpha)
    return df.agg(F.count("*").alias("n"), F.round(slope, 6).alias("slope"), F.round(F.avg(y) - slope * F.avg(x), 4).alias("intercept"))


def gates(metrics: DataFrame, thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """(gate, value, threshold, passed, all_passed) for the gates that are configured. A gate whose metric is missing fails."""
    spec = metrics.sparkSession.createDataFrame([(g, op, float(t)) for g, (op, t) in thresholds.items()], "gate string, op string, threshold double")
    joined = F.broadcast(spec).join(metrics, spec["gate"] == metrics["metric"], "left")
    passed = F.coalesce(F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold")), F.lit(False))
    rows = joined.select("gate", "value", "threshold", passed.alias("passed"))
    return rows.crossJoin(rows.agg(F.bool_and("passed").alias("all_passed")))  # one row
