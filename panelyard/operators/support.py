"""Whether a difference can be predicted: bootstrap interval, verdict with reasons, ranking metrics, arms, production basis."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.operators.ranking import ranked, running
from panelyard.sources.shared import drop_kept, kept

#: Upper ends of the Poisson(1) distribution function for 0, 1, ... occurrences.
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119)


def poisson_weight(h: Column) -> Column:
    """0 to 7 from a uniform bucket of 2^32."""
    u = h / 4294967296
    out = F.when(u < POISSON[0], 0)
    for k, x in enumerate(POISSON[1:], 1):
        out = out.when(u < x, k)
    return out.otherwise(7)


#: Rows whose weights are held at a time, groups that a task sums up before it hands them on.
_ROWS, _GROUPS = 1024, 256
_STEPS = np.array([np.ceil(x * 2.0**32) for x in POISSON]).astype(np.uint32)


def poisson_bags(hashes: np.ndarray, bags: int) -> np.ndarray:
    """rows x bags weights 0 to 7, as `poisson_weight` of 32 bits mixed from a row's hash and the bag's number."""
    z = hashes[:, None] + np.arange(1, bags + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    u = (z >> np.uint64(32)).astype(np.uint32)
    out = np.zeros(u.shape, np.uint8)
    for step in _STEPS:
        out += u >= step
    return out


def poisson_weights(ids: np.ndarray, replicates: int) -> np.ndarray:
    """replicates x rows weights 0 to 7: `poisson_weight` of `hash_bucket(id * 1009 + replicate * 7919, 17)`, many at a time."""
    x = ids[None, :] * 1009 + (np.arange(replicates) * 7919)[:, None] if (ids < 0).any() else None
    if x is None:  # the remainder of a sum from those of its parts
        x = (ids * 1009 % 1000003).astype(np.uint32)[None, :] + (np.arange(replicates) * 7919 % 1000003).astype(np.uint32)[:, None]
        x -= np.where(x >= 1000003, np.uint32(1000003), np.uint32(0))
        h = x * np.uint32(2654435761) + np.uint32(17 * 40503)
        low = None
    else:
        h = np.fmod(np.fmod(x, 1000003) * 2654435761 + 17 * 40503, 1 << 32)
        low, h = h < 0, np.maximum(h, 0).astype(np.uint32)
    out = np.zeros(h.shape, np.uint8)
    for step in _STEPS:
        out += h >= step
    if low is not None:
        out[low] = 0
    return out


def _weighted_sums(ids: np.ndarray, y: np.ndarray, p: np.ndarray, replicates: int) -> np.ndarray:
    """6 x replicates: sums of weights, weighted y, y^2 and squared errors; least and greatest y with a weight."""
    out = np.zeros((6, replicates))
    out[4], out[5] = np.inf, -np.inf
    order = np.argsort(y, kind="stable")
    for at in range(0, len(y), _ROWS):
        some = order[at : at + _ROWS]
        w = poisson_weights(ids[some], replicates)
        own = y[some]
        out[:4] += np.stack([np.ones(len(some)), own, own**2, (own - p[some]) ** 2]) @ w.T.astype(np.float64)
        there = w > 0
        any_ = there.any(1)
        out[4] = np.where(any_, np.minimum(out[4], own[there.argmax(1)]), out[4])
        out[5] = np.where(any_, np.maximum(out[5], own[len(some) - 1 - there[:, ::-1].argmax(1)]), out[5])
    return out


def bootstrap_r2(df: DataFrame, *by: str, replicates: int = 1000, y: str = "y", p: str = "p", row: str = "id") -> DataFrame:
    """n, and the 2.5 and 97.5 percentiles of R2 over Poisson bootstrap replicates, per group.

    A replicate is a few sums of weighted rows. Each task adds its rows up to arrays of all replicates' sums, one per group, so the shuffle holds
    replicates x groups rows a task and no row is copied. Replicates whose labels don't vary are left out; no replicate left gives nulls.
    """
    names = ["n", "s", "q", "e", "lo", "hi"]
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & F.col(row).isNotNull())
    rows = rows.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"), F.col(row).cast("bigint").alias("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        kinds: list[pa.DataType] = []

        def made() -> pa.RecordBatch:
            lists = [pa.array([x[k].tolist() for x in sums.values()], pa.list_(pa.float64())) for k in range(6)]
            return pa.RecordBatch.from_arrays([*[pa.array(v, t) for v, t in zip(zip(*sums), kinds)], *lists], [*keys, *names])

        for b in batches:
            kinds = [b.column(k).type for k in keys]
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(k).to_pylist() for k in keys)) if keys else [()] * len(b)):
                groups.setdefault(key, []).append(i)
            ids, ys, ps = (b.column(c).to_numpy() for c in ("i", "y", "p"))
            for key, at in groups.items():
                new = _weighted_sums(ids[at], ys[at], ps[at], replicates)
                old = sums.get(key)
                sums[key] = new if old is None else np.concatenate([old[:4] + new[:4], np.minimum(old[4:5], new[4:5]), np.maximum(old[5:], new[5:])])
                if len(sums) >= _GROUPS:
                    yield made()
                    sums.clear()
        if sums:
            yield made()

    schema = T.StructType([*rows.schema.fields[: len(keys)], *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]])
    parts = rows.mapInArrow(run, schema).select(*keys, F.posexplode(F.arrays_zip(*names)).alias("rep", "x"))
    sums = parts.groupBy(*keys, "rep").agg(*[F.sum(f"x.{n}").alias(n) for n in names[:4]], F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
    score = sums.where("hi > lo").withColumn("r2", 1 - F.col("e") / (F.col("q") - F.col("s") ** 2 / F.col("n")))
    out = score.groupBy(*keys).agg(F.count("*").alias("replicates"), F.round(F.percentile("r2", 0.025), 6).alias("lo"), F.round(F.percentile("r2", 0.975), 6).alias("hi"))
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "replicates", "lo", "hi")


def pair_support(df: DataFrame, threshold: float = 1.0, by: str = "pair", replicates: int = 1000, y: str = "delta", p: str = "score") -> DataFrame:
    """Verdict per pair: selective rows (one-sided), prevalence, interval, ordered reasons, supported."""
    counts = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col(y) >= threshold).alias("n_selective"))
    both = counts.join(bootstrap_r2(df, by, replicates=replicates, y=y, p=p), by, "left").withColumn("prevalence", F.round(F.col("n_selective") / F.col("n"), 6))
    lo, hi = F.coalesce("lo", F.lit(float("-inf"))), F.coalesce("hi", F.lit(0.0))
    why = F.array_compact(F.array(
        F.when(hi < 0, "interval below zero").when(lo <= 0, "interval spans zero"),
        F.when(F.col("n_selective") == 0, "constant label").when(F.col("prevalence") < 0.05, "few positives"),
    ))
    return both.select(by, "n", "n_selective", "prevalence", "lo", "hi", F.array_join(why, "; ").alias("reasons"), ((lo > 0) & (F.col("n_selective") > 0)).alias("supported"))


def rank_metrics(df: DataFrame, *by: str, positive: str = "positive", score: str = "score", row: str = "id") -> DataFrame:
    """Average precision, ROC AUC, prevalence, lift, top-tenth enrichment per group; nulls for the metrics of a single class.

    Rows are counted by score first; all but the last metric come from running sums over those counts. At the score where the top
    tenth ends, ties go by the row id: only those rows are ranked.
    """
    df = df.where(F.col(score).isNotNull() & F.col(positive).isNotNull())
    df = df if by else df.withColumn("_all", F.lit(1))
    keys = list(by) or ["_all"]
    df = narrow = kept(df.select(*keys, score, positive, row), "scored")
    counts = df.groupBy(*keys, F.col(score).alias("_s")).agg(F.count("*").alias("n"), F.count_if(positive).alias("p"))
    run = kept(running(counts, keys, [F.col("_s").desc()], {"n": "cn", "p": "cp"}), "counts")
    total = run.groupBy(*keys).agg(F.max("cn").alias("_n"), F.max("cp").alias("_p"))
    total = total.withColumn("_k", F.greatest(F.lit(1), F.floor(F.col("_n") * 0.1)))
    run = run.join(total, keys)
    neg = F.col("n") - F.col("p")
    above = F.col("cn") - F.col("cp") - neg
    at_cut = (F.col("cn") >= F.col("_k")) & (F.col("cn") - F.col("n") < F.col("_k"))
    parts = run.groupBy(*keys, "_n", "_p", "_k").agg(
        F.sum(F.col("p") * F.col("cp") / F.col("cn")).alias("ap"), F.sum(F.col("p") * (F.col("_n") - F.col("_p") - above - neg / 2)).alias("u"),
        F.max(F.when(at_cut, F.col("_s"))).alias("_cut"), F.max(F.when(at_cut, F.col("cp") - F.col("p"))).alias("_hits"), F.max(F.when(at_cut, F.col("_k") - F.col("cn") + F.col("n"))).alias("_left"),
    )
    tied = df.join(parts.select(*keys, "_cut", "_left"), keys).where(F.col(score) == F.col("_cut")).select(*keys, row, F.col(positive).alias("_pos"), "_left")
    more = ranked(tied, keys, [F.col(row)], "_rank").where("_rank <= _left").groupBy(*keys).agg(F.count_if("_pos").alias("_more"))
    both = (F.col("_p") > 0) & (F.col("_p") < F.col("_n"))
    prevalence = F.col("_p") / F.col("_n")
    precision = F.col("ap") / F.col("_p")
    out = parts.join(more, keys, "left").select(
        *keys, F.col("_n").alias("n"), F.col("_p").alias("positives"), F.round(prevalence, 6).alias("prevalence"), F.when(both, F.round(precision, 6)).alias("average_precision"),
        F.when(both, F.round(F.col("u") / F.col("_p") / (F.col("_n") - F.col("_p")), 6)).alias("roc_auc"), F.when(both, F.round(precision / prevalence, 6)).alias("lift"),
        F.when(both, F.round((F.col("_hits") + F.coalesce("_more", F.lit(0))) / F.col("_k") / prevalence, 6)).alias("top_enrichment"),
    )
    done = kept(out.drop("_all"), "metrics")
    drop_kept(narrow, run)
    return done


def paired_deltas(wide: DataFrame, primary: str, comparators: list[str], key: str = "structure") -> DataFrame:
    """(key, pair, a, b, delta) of the rows that have both targets: a the primary's value, b the comparator's."""
    made = [F.struct(F.lit(f"{primary}-{c}").alias("pair"), F.col(primary).alias("a"), F.col(c).alias("b"), (F.col(primary) - F.col(c)).alias("delta")) for c in comparators]
    return wide.select(key, F.explode(F.array(*made)).alias("x")).select(key, "x.*").where("delta IS NOT NULL")


def production_basis(verdicts: DataFrame) -> DataFrame:
    """One row: pairs, supported pairs, the sorted names of those and of the others, and what a production model may be fitted on."""
    names = lambda cond: F.array_join(F.sort_array(F.collect_list(F.when(cond, F.col("pair")))), ",")  # noqa: E731  a name per pair of targets
    one = verdicts.agg(F.count("*").alias("pairs"), F.count_if("supported").alias("supported_pairs"), names(F.col("supported")).alias("names"), names(~F.col("supported")).alias("unsupported"))
    return one.withColumn("basis", F.when(F.col("supported_pairs") == 0, "none").when(F.col("supported_pairs") < F.col("pairs"), "supported_min").otherwise("all_min"))


def production_target(wide: DataFrame, primary: str, supported: list[str], min_rows: int = 25) -> DataFrame | None:
    """structure and the least supported difference; None if nothing is supported or too few rows have one."""
    if not supported:
        return None
    cols = [F.col(f"delta_{primary}_{c}") for c in supported]
    out = wide.select("structure", (F.least(*cols) if len(cols) > 1 else cols[0]).alias("target")).where("target IS NOT NULL")
    return out if out.limit(min_rows).count() >= min_rows else None
