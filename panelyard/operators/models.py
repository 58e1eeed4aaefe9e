"""Fits by MLlib over panels: forests, boosting, ridge, out-of-fold predictions, saved models, prediction bands."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.operators.support import poisson_bags
from panelyard.sources.shared import drop_kept, kept

#: Rows whose weights in all bags are made at a time, and distinct features that a task sums up before it hands them on.
_ROWS, _CELLS = 256, 2048
#: Levels of all trees that one job grows.
_LEVELS = 6


def with_features(df: DataFrame, bits: str | None = None, n_bits: int = 0, numbers: tuple[str, ...] = ()) -> DataFrame:
    """df with a `features` vector: set bits as 0/1, then the numbers. Rows without bits or with a null number are left out.

    Bits stay sparse: a row costs its set bits, not n_bits."""
    parts, rows = list(numbers), df
    if bits:
        rows = rows.where(F.col(bits).isNotNull()).withColumn("_names", F.transform(bits, lambda x: x.cast("string")))
        counted = CountVectorizerModel.from_vocabulary([str(i) for i in range(n_bits)], inputCol="_names", outputCol="_bits").setBinary(True).setMinTF(1.0)
        rows = counted.transform(rows).drop("_names")
        parts = ["_bits", *parts]
    return VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="skip").transform(rows).drop("_bits")


def forest(label: str = "y", trees: int = 400, depth: int = 12, seed: int = 0, weight: str | None = None) -> RandomForestRegressor:
    made = RandomForestRegressor(labelCol=label, featuresCol="features", predictionCol="p", numTrees=trees, maxDepth=min(depth, 30), seed=seed)
    return made.setWeightCol(weight) if weight else made


def boosted(label: str = "y", rounds: int = 600, depth: int = 6, step: float = 0.05, seed: int = 0) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol="features", predictionCol="p", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)


def ridge(df: DataFrame, label: str = "y", alpha: float = 1.0) -> LinearRegression:
    """The penalty in MLlib's scale: alpha times the label's sample deviation over the rows."""
    n, dev = df.agg(F.count(label), F.stddev_samp(label)).first()
    return LinearRegression(labelCol=label, featuresCol="features", predictionCol="p", elasticNetParam=0.0, standardization=False, regParam=alpha * (dev or 1.0) / max(n, 1))


def _fitted(spark: SparkSession, work: list[Callable[[], DataFrame]], at_once: int) -> DataFrame:
    """The union of what the calls give. Each fits models; so many calls run at a time, so that the many small jobs of a fit leave no executor idle."""
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(spark)(lambda f: f()), work))


def out_of_fold(df: DataFrame, make: Callable[[DataFrame], Estimator], fold: str = "fold", folds: int = 5, keep: tuple[str, ...] = ("id", "grp", "fold", "y"), at_once: int = 4) -> DataFrame:
    """Every row predicted once, by a fit without its fold. The rows are computed once, as a table that all fits read; so many folds are fitted at a time."""
    rows = kept(df, "folds")

    def one(k: int) -> DataFrame:
        train = rows.where(F.col(fold) != k)
        return make(train).fit(train).transform(rows.where(F.col(fold) == k)).select(*keep, "p")

    return _fitted(df.sparkSession, [partial(one, k) for k in range(folds)], at_once)


def bag_sums(df: DataFrame, numbers: tuple[str, ...], by: str, bags: int, weight: Callable[[Column], Column], label: str = "y", row: str = "id", seed: int = 0) -> DataFrame:
    """(by, numbers, bag, w, s, q): per value of `by`, distinct features and bag the sums of the rows' weights, weighted labels and weighted squared labels.

    A row's weight in a bag is a function of its id: `weight` of a number of 32 bits. A tree that is grown by variance sees nothing else of the rows, so that the fits read
    a row per distinct features and not per row: for features of few distinct values. Rows without a label add nothing; rows with a null or NaN number are left out."""
    y = F.col(label).cast("double")
    y = F.when(y.isNotNull() & ~F.isnan(y), y)
    rows = df.where(_whole(numbers)).select(by, *numbers, F.col(row).alias("_row"), y.alias("_y"))
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))).alias("bag"))  # a loop over the bags; added up before any shuffle
    h = F.pmod(F.xxhash64("_row", "bag", F.lit(seed)), F.lit(1 << 32))
    each = each.withColumn("_h", h).withColumn("_w", F.when(F.col("_y").isNotNull(), weight(F.col("_h"))).otherwise(0).cast("double"))
    w, y = F.col("_w"), F.coalesce("_y", F.lit(0.0))
    return kept(each.groupBy(by, *numbers, "bag").agg(F.sum(w).alias("w"), F.sum(w * y).alias("s"), F.sum(w * y * y).alias("q")), "sums")


def _whole(numbers: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double")) for n in numbers])


def _points(sums: DataFrame, *more: str, numbers: tuple[str, ...]) -> DataFrame:
    """Two weighted rows (y, w) for each sum, which have its weight, mean and variance."""
    mean = F.col("s") / F.col("w")
    dev = F.sqrt(F.greatest(F.col("q") / F.col("w") - mean * mean, F.lit(0.0)))
    points = sums.where("w > 0").select(*numbers, *more, (F.col("w") / 2).alias("w"), F.explode(F.array(mean - dev, mean + dev)).alias("y"))
    return with_features(points, numbers=numbers)


def _tree(depth: int, seed: int, subset: str, label: str = "y") -> RandomForestRegressor:
    """One tree on all the rows that it is given: their bag is in their weights."""
    made = RandomForestRegressor(labelCol=label, featuresCol="features", predictionCol="p", numTrees=1, maxDepth=min(depth, 30), seed=seed, featureSubsetStrategy=subset, bootstrap=False)
    return made.setWeightCol("w")


def tree_sums(df: DataFrame, numbers: tuple[str, ...], by: str, bags: int, label: str = "y", row: str = "id", seed: int = 0) -> DataFrame:
    """(by, n0 and so on (the numbers as doubles), bag, w, s): `bag_sums` without squares, for many bags of Poisson weights. Each row is hashed once, and a task makes its weights in all bags
    by Arrow batches and hands on a row per distinct features and bag, not per row and bag."""
    y, names = F.col(label).cast("double"), [f"n{i}" for i in range(len(numbers))]
    y = F.when(y.isNotNull() & ~F.isnan(y), y)
    values = [F.col(n).cast("double").alias(k) for n, k in zip(numbers, names)]
    rows = df.where(_whole(numbers) & F.col(by).isNotNull()).select(F.col(by).cast("bigint").alias(by), *values, F.xxhash64(row, F.lit(seed)).alias("_h"), y.alias("_y"))
    keys = [by, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            cells = [np.repeat(np.array(c), bags) for c in zip(*held)]
            sums = np.concatenate(list(held.values()), 1)
            bag = np.tile(np.arange(bags, dtype=np.int32), len(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (*cells, bag, *sums)], [*keys, "bag", "w", "s"])

        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
            order = np.lexsort(cols)
            cols = [c[order] for c in cols]
            h = b.column("_h").to_numpy()[order].view(np.uint64)
            own = b.column("_y").to_numpy(zero_copy_only=False).astype(np.float64)[order]
            there = ~np.isnan(own)
            sides = np.stack([there.astype(np.float64), np.where(there, own, 0.0)])
            new = np.append(True, reduce(np.logical_or, [c[1:] != c[:-1] for c in cols]))[: len(h)]
            cuts = np.union1d(np.flatnonzero(new), np.append(np.arange(0, len(h), _ROWS), len(h)))
            at = weights = None
            for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
                if at != lo // _ROWS:
                    at = lo // _ROWS
                    weights = poisson_bags(h[at * _ROWS : (at + 1) * _ROWS], bags)
                cell = tuple(c[lo].item() for c in cols)
                got = sides[:, lo:hi] @ weights[lo - at * _ROWS : hi - at * _ROWS].astype(np.float64)
                held[cell] = held[cell] + got if cell in held else got
                if len(held) >= _CELLS:
                    yield told()
        if held:
            yield told()

    typed = ", ".join([f"`{by}` bigint", *[f"{n} double" for n in names], "bag int", "w double", "s double"])
    return kept(rows.mapInArrow(run, typed).groupBy(*keys, "bag").agg(F.sum("w").alias("w"), F.sum("s").alias("s")), "sums")


def _split(cells: DataFrame, at: list[str], names: list[str], tried: int, seed: int) -> DataFrame:
    """cells with the nodes of the next level: 2 * node, and 1 more over the threshold that gains most of those of the features that the node tries. `new`: whether it was split."""
    features = F.array_sort(F.array(*[F.struct(F.xxhash64(*at, F.lit(i), F.lit(seed)).alias("h"), F.lit(i).alias("f"), F.col(n).alias("v")) for i, n in enumerate(names)]))
    each = cells.select("*", F.posexplode(F.slice(features, 1, tried)).alias("slot", "c")).select(*cells.columns, "slot", "c.f", "c.v")
    group, whole = Window.partitionBy(*at, "f"), Window.partitionBy(*at)
    left = group.orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"_l{c}": F.sum(c).over(left) for c in "ws"} | {f"_t{c}": F.sum(c).over(group) for c in "ws"}
    each = each.withColumns(sums | {"_next": F.expr(f"lead(IF(w > 0, v, NULL)) IGNORE NULLS OVER (PARTITION BY {', '.join(at)}, f ORDER BY v)")})
    square = lambda s, w: s * s / F.nullif(w, F.lit(0.0))
    lw, ls, tw, ts = (F.col(c) for c in ("_lw", "_ls", "_tw", "_ts"))
    gain = square(ls, lw) + square(ts - ls, tw - lw) - square(ts, tw)
    better = (F.col("w") > 0) & (F.col("_next") > F.col("v")) & (gain > 1e-12 * square(ts, tw))  # what rounding leaves is no gain
    cut = F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("v")).alias("v"), (F.col("v") + (F.col("_next") - F.col("v")) / 2).alias("half"))
    each = each.withColumn("_best", F.max(F.when(better, cut)).over(whole)).where("slot = 0")
    over = F.get(F.array(*names), -F.col("_best.f")) > F.col("_best.half")
    new = F.col("_best").isNotNull()
    return each.withColumns({"node": F.when(new, 2 * F.col("node") + over.cast("int")).otherwise(F.col("node")), "new": new}).select(*cells.columns)


def grown(cells: DataFrame, keys: list[str], names: list[str], depth: int, seed: int = 0, share: float = 1.0) -> DataFrame:
    """cells with `p` of the tree that is grown by variance from the cells of equal `keys` (one tree each, all of them at once, level by level); w and s are a cell's weight and weighted label.

    A node tries all thresholds between the values that its cells have, of a share of the features by a hash; it is a leaf at this depth, or if no threshold gains. Cells of weight 0 are only
    predicted. The cells of a tree are in one task, sorted by node and value there, and _LEVELS levels are one job."""
    at, tried = [*keys, "node"], max(1, math.ceil(share * len(names)))
    now = cells.select(*cells.columns, F.lit(1).cast("bigint").alias("node"), F.lit(True).alias("new"))
    for level in range(0, depth, _LEVELS):
        last, now = now, now.repartition(*keys)
        for _ in range(min(_LEVELS, depth - level)):
            now = _split(now, at, names, tried, seed)
        now = kept(now, "nodes")
        drop_kept(last)
        if now.where("new").isEmpty():
            break
    node = Window.partitionBy(*at)
    out = kept(now.repartition(*keys).withColumn("p", F.sum("s").over(node) / F.nullif(F.sum("w").over(node), F.lit(0.0))).drop("node", "new"), "grown")
    drop_kept(now)
    return out


def forest_by_sums(df: DataFrame, numbers: tuple[str, ...], label: str = "y", fold: str = "fold", folds: int = 5, row: str = "id", trees: int = 400, depth: int = 30, seed: int = 0, keep: tuple[str, ...] = ("id", "grp", "fold", "y")) -> DataFrame:
    """`out_of_fold` of forests, from `tree_sums`: the rows are read once for all folds and trees, a bag is a function of the ids, on any partitioning alike, and the trees of all
    folds grow side by side, a level at a time. As in MLlib a node tries a third of the features; thresholds are all that there are, not 32 bins."""
    rows = kept(df.select(*dict.fromkeys([*keep, fold, row, label, *numbers])), "folds")
    names = [f"n{i}" for i in range(len(numbers))]
    sums = tree_sums(rows, numbers, fold, trees, label, row, seed)
    others = lambda c: F.sum(F.when(F.col(fold) != F.col("k"), F.col(c)).otherwise(0.0)).alias(c)
    each = sums.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    cells = each.groupBy("k", "bag", *names).agg(others("w"), others("s"), F.max(F.col(fold) == F.col("k")).alias("own")).where("own OR w > 0")
    said = grown(cells, ["k", "bag"], names, depth, seed, 1 / 3 if trees > 1 else 1.0)
    mean = kept(said.where("own").groupBy("k", *names).agg(F.avg("p").alias("p")), "said")
    drop_kept(sums, said)
    met = [F.col(fold) == F.col("k"), *[F.col(n).cast("double") == F.col(k) for n, k in zip(numbers, names)]]
    return rows.join(mean, reduce(Column.__and__, met)).select(*keep, "p")


def boosted_by_sums(df: DataFrame, numbers: tuple[str, ...], test: str = "test", label: str = "y", row: str = "id", rounds: int = 600, depth: int = 6, step: float = 0.05, seed: int = 0, share: float = 0.8, subset: str = "0.8") -> DataFrame:
    """The rows of df where `test` holds, with `p` of `boosted` fitted to the others, from `bag_sums`: each round's bag is a share of the rows by their ids, and
    the rounds read a row per distinct features. Steps are those of MLlib: the first tree counts whole, later ones are fitted to the loss's gradient, twice the error."""
    sums = bag_sums(df, numbers, test, rounds, lambda h: (h < int(share * 2**32)).cast("int"), label, row, seed)
    now = kept(sums.select(*numbers).distinct().withColumn("_f", F.lit(0.0)), "said")
    for t in range(rounds):
        bag = sums.where(~F.col(test) & (F.col("bag") == t)).join(now, list(numbers))
        points = _points(bag, "_f", numbers=numbers).withColumn("y", (F.col("y") - F.col("_f")) * (2.0 if t else 1.0))
        added = _tree(depth, seed + t, subset).fit(points).transform(with_features(now, numbers=numbers))
        last, now = now, kept(added.select(*numbers, (F.col("_f") + F.col("p") * (step if t else 1.0)).alias("_f")), "said")
        drop_kept(last)
    drop_kept(sums)
    return df.where(test).join(now.withColumnRenamed("_f", "p"), list(numbers))


def delta_arms(df: DataFrame, arms: dict[str, tuple[str, Callable[[str], Estimator]]], fold: str = "fold", folds: int = 5, row: str = "id", a: str = "a", b: str = "b", by: str | None = None, at_once: int = 8) -> DataFrame:
    """(arm, row, y, p), out of fold, all arms on the same folds and features; y is a - b. by: a column (its values are few, such as pairs of targets) each of whose values has fits
    of its own, and which the result has too.

    arms: name -> (kind, estimator for a label column). Kind `direct` fits the difference, `subtract` fits both values and takes the difference of
    what is predicted; an arm of another algorithm is a further `subtract`. The rows are computed once, as a table; so many fits run at a time."""
    if wrong := sorted({kind for kind, _ in arms.values()} - {"direct", "subtract"}):
        raise ValueError(f"unknown kind of arm {wrong[0]!r}")
    rows = kept(df.withColumn("_delta", F.col(a) - F.col(b)), "arms")
    groups = [r[0] for r in rows.select(by).distinct().orderBy(by).collect()] if by else [None]  # names of pairs

    def one(group: object, k: int, name: str) -> DataFrame:
        own = rows.where(F.col(by).eqNullSafe(F.lit(group))) if by else rows
        train, test = own.where(F.col(fold) != k), own.where(F.col(fold) == k)
        kind, make = arms[name]
        if kind == "direct":
            said = make("_delta").fit(train).transform(test).select(row, "_delta", "p")
        else:
            first = make(a).fit(train).transform(test).withColumnRenamed("p", "_pa")
            said = make(b).fit(train).transform(first).select(row, "_delta", (F.col("_pa") - F.col("p")).alias("p"))
        return said.select(*([F.lit(group).alias(by)] if by else []), F.lit(name).alias("arm"), row, F.col("_delta").alias("y"), "p")

    return _fitted(df.sparkSession, [partial(one, g, k, name) for g in groups for k in range(folds) for name in arms], at_once)


def linear_arms(df: DataFrame, fold: str = "fold", by: tuple[str, ...] = (), x: str = "x", a: str = "a", b: str = "b") -> DataFrame:
    """df with p_direct, p_subtract and p_mean of a - b, out of fold: a least-squares line on one feature for the difference, two lines subtracted, and the mean.

    All folds at once from sums: a fold's fit is the sums of all rows less its own."""
    keys = list(by)
    parts = {"n": F.lit(1.0), "x": F.col(x), "xx": F.col(x) ** 2, "a": F.col(a), "b": F.col(b), "xa": F.col(x) * F.col(a), "xb": F.col(x) * F.col(b)}
    own = df.groupBy(*keys, fold).agg(*[F.sum(c).alias(f"o_{n}") for n, c in parts.items()])
    every = own.groupBy(*keys).agg(*[F.sum(f"o_{n}").alias(f"t_{n}") for n in parts])
    sums = own.join(every, keys) if keys else own.crossJoin(every)  # a row per fold and group, one row per group
    s = {n: F.col(f"t_{n}") - F.col(f"o_{n}") for n in parts}
    sxx = s["xx"] - s["x"] * s["x"] / s["n"]
    slope = lambda y: F.coalesce((s["x" + y] - s["x"] * s[y] / s["n"]) / F.nullif(sxx, F.lit(0.0)), F.lit(0.0))
    line = lambda y: (s[y] / s["n"] + slope(y) * (F.col(x) - s["x"] / s["n"]))
    joined = df.join(sums, [*keys, fold])  # Spark broadcasts the sums where they are few
    direct = (s["a"] - s["b"]) / s["n"] + ((s["xa"] - s["xb"]) - s["x"] * (s["a"] - s["b"]) / s["n"]) / F.nullif(sxx, F.lit(0.0)) * (F.col(x) - s["x"] / s["n"])
    out = {"p_direct": F.coalesce(direct, (s["a"] - s["b"]) / s["n"]), "p_subtract": line("a") - line("b"), "p_mean": (s["a"] - s["b"]) / s["n"]}
    return joined.select(*[df[c] for c in df.columns], *[c.alias(n) for n, c in out.items()])


def fit_all(df: DataFrame, stages: list) -> PipelineModel:
    return Pipeline(stages=stages).fit(df)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def band(halfwidth: float | None, measured: float, p: str = "p") -> list[Column]:
    """lower and upper; a configured half-width counts even if it is 0."""
    h = measured if halfwidth is None else halfwidth
    return [(F.col(p) - h).alias("lower"), (F.col(p) + h).alias("upper")]
