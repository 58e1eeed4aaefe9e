"""Library screening: funnel with first failing reasons, property windows, annotation that drops nothing, censuses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.operators.ranking import quantiles, smallest
from panelyard.operators.similarity import three_similarities

# Names of strata and advisory labels.
STRATA = ("S1_in_domain", "S2_near_domain", "S3_far_novel")
PRIORITIES = ("fep_first", "front_of_queue", "none", "qsar_below_hit_floor", "abstain_out_of_ad")
#: Property, name of its lower bound (or None), name of its upper bound.
BOUNDS = (("mw", "mw_min", "mw_max"), ("logp", None, "logp_max"), ("tpsa", None, "tpsa_max"))


@dataclass(frozen=True)
class Thresholds:
    in_domain: float = 0.5
    borderline: float = 0.35
    high_conf: float = 0.6
    halfwidth: float = 0.955
    hit_floor: float = 6.0
    prio_point: float = 7.0
    prio_delta: float = 1.0
    fep_lower: float = 7.4
    fep_delta: float = 1.5
    known_flag: float = 0.65
    derived_for: str | None = None

    def of(self, target: str) -> Thresholds:
        """self; raises if they were derived for another target."""
        if self.derived_for not in (None, target):
            raise ValueError(f"thresholds were derived for {self.derived_for!r}, not {target!r}")
        return self


def funnel(library: DataFrame, fails: list[tuple[str, Column]], key: str = "key", order: str = "pos") -> DataFrame:
    """One row per step in order: rows left, rows dropped. Every row is dropped for its first failing reason; keys that repeat stay once."""
    reason = F.when(F.col(key).isNull(), "unparseable")
    for name, bad in fails:
        reason = reason.when(F.coalesce(bad, F.lit(True)), name)
    marked = library.withColumn("_reason", reason)
    first = marked.where("_reason IS NULL").groupBy(key).agg(F.count("*").alias("n"))
    steps = ["unparseable", *[n for n, _ in fails]]
    one = marked.agg(F.count("*").alias("raw"), *[F.count_if(F.col("_reason") == s).alias(f"d_{s}") for s in steps]).crossJoin(first.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d_duplicate")))  # one row each
    rows, left = [F.struct(F.lit(0).alias("step"), F.lit("raw").alias("name"), F.lit(0).cast("bigint").alias("dropped"), F.col("raw").alias("remaining"))], F.col("raw")
    for i, s in enumerate([*steps, "duplicate"], 1):
        left = left - F.col(f"d_{s}")
        rows.append(F.struct(F.lit(i).alias("step"), F.lit(s).alias("name"), F.col(f"d_{s}").cast("bigint").alias("dropped"), left.alias("remaining")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def first_of_each(library: DataFrame, key: str = "key", order: str = "pos") -> DataFrame:
    """key, first row's id and order, rows with the key: an aggregation, no window."""
    return library.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("first"), F.count("*").alias("copies"))


def seeded_cap(df: DataFrame, n: int, h: str = "h", order: str = "pos") -> DataFrame:
    """n rows by their hash, in input order; all if there are fewer."""
    return smallest(df, n, [h, order]).orderBy(order)


def seeded_shuffle(df: DataFrame, h: str = "h", order: str = "pos") -> DataFrame:
    """All rows in hash order (a range-partitioned sort), so that any first part is a uniform sample."""
    return df.orderBy(h, order)


def potency_cut(actives: DataFrame, label: str = "label", quantile: float | None = 0.75, absolute: float | None = None) -> DataFrame:
    """One row: the cut, how it was made, rows at or over it."""
    if absolute is None and not (quantile is not None and 0 < quantile < 1):
        raise ValueError("a potency cut is a quantile between 0 and 1, or an absolute value")
    if absolute is not None:
        cut = actives.agg(F.lit(float(absolute)).alias("cut"))
    else:
        cut = quantiles(actives, label, {"cut": quantile}).select(F.round("cut", 6).alias("cut"))
    how = f"absolute {absolute}" if absolute is not None else f"quantile {quantile}"
    return actives.crossJoin(F.broadcast(cut)).groupBy("cut").agg(F.count_if(F.col(label) >= F.col("cut")).alias("n_over"), F.lit(how).alias("how"))  # one row


def _long(df: DataFrame) -> DataFrame:
    return df.unpivot([], [p for p, _, _ in BOUNDS], "property", "v").where("v IS NOT NULL")


def _bounds(lo: Column, hi: Column, spans: DataFrame) -> DataFrame:
    """(bound, value) rows of (property, lower, upper) ones."""
    names = F.lit(None).cast("array<struct<bound:string,value:double>>")
    for p, low, high in BOUNDS:
        pair = ([F.struct(F.lit(low).alias("bound"), F.round(F.greatest(F.lit(0.0), lo), 3).alias("value"))] if low else []) + [F.struct(F.lit(high).alias("bound"), F.round(hi, 3).alias("value"))]
        names = F.when(F.col("property") == p, F.array(*pair)).otherwise(names)
    return spans.select(F.explode(names).alias("b")).select("b.*")


def envelope(actives: DataFrame, low: float = 0.05, high: float = 0.95, margin: float = 0.15) -> DataFrame:
    """(bound, value): each property's quantile range, widened by a share of itself; lower bounds are not below 0."""
    if not 0 <= low < high <= 1 or margin < 0:
        raise ValueError("an envelope needs 0 <= low < high <= 1 and a margin of at least 0")
    spans = quantiles(_long(actives.select([F.col(p).cast("double").alias(p) for p, _, _ in BOUNDS])), "v", {"lo": low, "hi": high}, ("property",))
    pad = (F.col("hi") - F.col("lo")) * margin
    return _bounds(F.col("lo") - pad, F.col("hi") + pad, spans)


def reference_ceiling(refs: DataFrame, margin: float = 0.15, inflation: float = 2.0, properties: tuple[str, ...] = ("mw", "logp")) -> DataFrame:
    """(bound, value): the references' range, widened by margin * (1 + inflation / sqrt(references))."""
    n = refs.agg(F.count("*").alias("n"))
    spans = _long(refs.select([F.col(p).cast("double").alias(p) for p, _, _ in BOUNDS])).where(F.col("property").isin(*properties)).groupBy("property").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    spans = spans.crossJoin(F.broadcast(n))  # one row
    pad = (F.col("hi") - F.col("lo")) * (margin * (1 + inflation / F.sqrt("n")))
    return _bounds(F.col("lo") - pad, F.col("hi") + pad, spans)


def ceiling_notes(refs: DataFrame, margin: float = 0.15, inflation: float = 2.0, few: int = 4) -> DataFrame:
    """One row: references, margin with its inflation, and a caveat where there are none or fewer than `few`."""
    n = F.col("n_references")
    caveat = F.when(n == 0, "no references: no ceiling can be derived").when(n < few, F.concat(F.lit("only "), n.cast("string"), F.lit(" references: the ceiling is weakly determined")))
    inflated = F.when(n > 0, F.round(F.lit(margin) * (1 + inflation / F.sqrt(n)), 4)).otherwise(F.lit(margin))
    return refs.agg(F.count("*").alias("n_references")).select("n_references", inflated.alias("margin"), caveat.alias("caveat"))


def intersect_bounds(*windows: DataFrame) -> DataFrame:
    """The tighter of equal bounds: the least maximum, the greatest minimum; the others are taken over."""
    every = windows[0]
    for w in windows[1:]:
        every = every.unionByName(w)
    return every.groupBy("bound").agg(F.when(F.endswith("bound", F.lit("_max")), F.min("value")).otherwise(F.max("value")).alias("value"))


def rejections(items: DataFrame, bounds: DataFrame, name: str = "name") -> DataFrame:
    """(name, reasons): items outside a bound, with all bounds they break, by name."""
    wide = bounds.agg(*[F.max(F.when(F.col("bound") == b, F.col("value"))).alias(b) for _, lo, hi in BOUNDS for b in (lo, hi) if b])
    joined = items.crossJoin(F.broadcast(wide))  # one row of bounds
    broken = [F.when(F.col(p) < F.col(lo), lo) for p, lo, _ in BOUNDS if lo] + [F.when(F.col(p) > F.col(hi), hi) for p, _, hi in BOUNDS]
    return joined.select(name, F.array_join(F.sort_array(F.array_compact(F.array(*broken))), ",").alias("reasons")).where("reasons <> ''")


def check_admits(refs: DataFrame, bounds: DataFrame) -> DataFrame:
    """One row: references, admitted ones, passed. No reference at all does not pass."""
    bad = rejections(refs, bounds).agg(F.count("*").alias("n_rejected"))
    return refs.agg(F.count("*").alias("n_references")).crossJoin(bad).select("n_references", (F.col("n_references") - F.col("n_rejected")).alias("n_admitted"), ((F.col("n_rejected") == 0) & (F.col("n_references") > 0)).alias("passed"))  # one row each


def stratum(sim: Column, t: Thresholds) -> Column:
    return F.when(sim >= t.in_domain, STRATA[0]).when(sim >= t.borderline, STRATA[1]).otherwise(STRATA[2])


def priority(point: Column, delta: Column, sim: Column, t: Thresholds) -> Column:
    """Advisory label; a null difference never promotes."""
    sure = sim >= t.high_conf
    return (
        F.when(F.coalesce(sim < t.in_domain, F.lit(True)), PRIORITIES[4]).when(point + t.halfwidth < t.hit_floor, PRIORITIES[3])
        .when(sure & (point - t.halfwidth >= t.fep_lower) & (delta >= t.fep_delta), PRIORITIES[0]).when(sure & (point >= t.prio_point) & (delta >= t.prio_delta), PRIORITIES[1]).otherwise(PRIORITIES[2])
    )


def annotate(rows: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """rows (prediction, delta, sim) with band, stratum, label, known flag; every row stays."""
    p, s = F.col("prediction"), F.col("sim")
    return rows.withColumns({"lower": F.round(p - t.halfwidth, 3), "upper": F.round(p + t.halfwidth, 3), "stratum": stratum(s, t), "priority": priority(p, F.col("delta"), s, t), "known_reference": F.coalesce(s >= t.known_flag, F.lit(False))})


def screen_library(library: DataFrame, refs: DataFrame, predict: Callable[[DataFrame], DataFrame], t: Thresholds = Thresholds(), row: str = "id", bits: str = "bits", set_name: str = "set_name") -> DataFrame:
    """Every row of the library with its similarities to the three reference sets, its nearest known reference, what `predict` says,
    band, stratum, label and known flag. Rows without bits can't be read: they keep null similarities and the label `unparseable`.

    refs: id, bits and the set's name, a row per set. predict: adds `prediction` and `delta` (a fitted MLlib pipeline's transform, or Column expressions);
    it gets readable rows only.
    """
    parsed = F.col(bits).isNotNull()
    sims = three_similarities(library.where(parsed), refs, row, row, set_name, bits=bits).withColumnRenamed("q", "_q")
    said = predict(library.where(parsed)).select(F.col(row).alias("_p"), "prediction", "delta")
    rows = library.join(sims, F.col(row) == F.col("_q"), "left").join(said, F.col(row) == F.col("_p"), "left").drop("_q", "_p")
    known = F.col("sim_known")
    out = annotate(rows.withColumn("sim", F.col("sim_train")), t).withColumn("known_reference", F.coalesce(known >= t.known_flag, F.lit(False))).drop("sim")
    return out.withColumns({c: F.when(parsed, F.col(c)).otherwise("unparseable") for c in ("stratum", "priority")} | {"parsed": parsed})


def screen_or_skip(enabled: bool, library: DataFrame | None, screen: Callable[[DataFrame], DataFrame], spark: SparkSession) -> tuple[DataFrame, DataFrame | None]:
    """(one status row, what was screened): skipped, with the reason, when the screen is switched off or there is no library or no row in it."""
    there = library is not None and not library.isEmpty()
    reason = None if enabled and there else f"enabled={str(enabled).lower()}, library={'present' if there else 'absent'}"
    status = spark.createDataFrame([("ran" if reason is None else "skipped", reason)], "status string, reason string")
    return status, screen(library) if reason is None else None


def top_anchors(rows: DataFrame, cut: float, n: int = 25, value: str = "prediction", order: str = "id") -> DataFrame:
    """The n best rows at or over a cut; ties by the row id."""
    return rows.where(F.col(value) >= cut).orderBy(F.desc(value), order).limit(n)


def review_list(rows: DataFrame, n: int = 200, flag: str = "known_reference", value: str = "sim", order: str = "id") -> DataFrame:
    """Flagged rows, the n most similar."""
    return rows.where(flag).orderBy(F.desc(value), order).limit(n)


def head(rows: DataFrame, n: int, order: str = "pos") -> DataFrame:
    """The first n rows by position."""
    return rows.orderBy(order).limit(n)


def census(rows: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """(name, n) for every known name, 0 where none is."""
    known = rows.sparkSession.createDataFrame([(n,) for n in names], "name string")
    counts = rows.groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))
    return F.broadcast(known).join(counts, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("n"))


def outcome_sums(rows: DataFrame, status: str, ok: str, score: str, seconds: Column) -> DataFrame:
    """One row: jobs, those that ended well, the sum of their scores, the time of all."""
    fine = F.col(status) == ok
    return rows.agg(F.count("*").alias("jobs"), F.count_if(fine).alias("ok"), F.round(F.sum(F.when(fine, F.col(score))), 4).alias("score"), F.sum(seconds).alias("seconds"))


def per_stratum(rows: DataFrame) -> DataFrame:
    """Long form: stratum, rows of each label, and the stratum's rows, median similarity and prediction."""
    labels = rows.groupBy("stratum", "priority").agg(F.count("*").alias("n_label"))
    by = labels.groupBy("stratum").agg(F.sum("n_label").alias("n"))
    for column, name in (("sim", "median_sim"), ("prediction", "median_prediction")):
        by = by.join(F.broadcast(quantiles(rows, column, {name: 0.5}, ("stratum",))), "stratum", "left").withColumn(name, F.round(name, 6))  # three strata
    return labels.join(F.broadcast(by), "stratum")


def similarity_summary(rows: DataFrame, sim: str = "sim", flag: float = 0.65) -> DataFrame:
    """One row over the non-null similarities; no row if there are none."""
    have = rows.where(F.col(sim).isNotNull())
    q = quantiles(have, sim, {"median": 0.5, "p90": 0.9, "p99": 0.99})
    one = have.agg(F.count("*").alias("n"), F.max(sim).alias("max"), F.count_if(F.col(sim) >= flag).alias("n_known"))
    return one.crossJoin(q).select("n", *[F.round(k, 6).alias(k) for k in ("median", "p90", "p99")], "max", "n_known")  # one row each
