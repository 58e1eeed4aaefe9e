"""Multi-objective scores of candidates: transforms, two reductions in one pass, ranking, acquisition rounds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.functions.scalars import transformed

FLOOR = 1e-9


@dataclass(frozen=True)
class Component:
    name: str
    transform: str
    weight: float
    params: dict[str, float] = field(default_factory=dict)


def checked(spec: list[Component], available: list[str], optional: tuple[str, ...] = ()) -> list[Component]:
    """spec without absent optional components; empty specs, weights that sum to 0 and absent required components are errors."""
    out = [c for c in spec if c.name in available or c.name not in optional]
    if missing := [c.name for c in out if c.name not in available]:
        raise ValueError(f"scores need columns {missing}")
    if not out or sum(c.weight for c in out) <= 0:
        raise ValueError("a score needs components with a positive weight")
    return out


def component_scores(spec: list[Component]) -> list[Column]:
    """A transformed column s_<name> each; a missing value scores 0."""
    return [F.coalesce(transformed(c.transform, F.col(c.name), **c.params), F.lit(0.0)).alias(f"s_{c.name}") for c in spec]


def weighted_mean(spec: list[Component]) -> Column:
    return sum((c.weight * F.col(f"s_{c.name}") for c in spec), F.lit(0.0)) / sum(c.weight for c in spec)


def weighted_geometric_mean(spec: list[Component]) -> Column:
    return F.exp(sum((c.weight * F.ln(F.least(F.greatest(F.col(f"s_{c.name}"), F.lit(FLOOR)), F.lit(1.0))) for c in spec), F.lit(0.0)) / sum(c.weight for c in spec))


def scored(df: DataFrame, spec: list[Component], digits: int = 9) -> DataFrame:
    """df with its components' scores and both reductions."""
    parts = df.select("*", *component_scores(spec))
    return parts.withColumns({"score_sum": F.round(weighted_mean(spec), digits), "score_geo": F.round(weighted_geometric_mean(spec), digits)})


def two_arms(df: DataFrame, k: int, row: str = "id", arms: tuple[str, ...] = ("score_sum", "score_geo")) -> DataFrame:
    """arm, rank, id and score of each reduction's k best; two bounded top-k's, no global window over all rows."""
    out = None
    for arm in arms:
        top = df.orderBy(F.desc(arm), row).limit(k)
        ranked = top.select(F.lit(arm).alias("arm"), F.row_number().over(Window.orderBy(F.desc(arm), row)).alias("rank"), row, F.col(arm).alias("score"))  # k rows
        out = ranked if out is None else out.unionByName(ranked)
    return out


def arm_summary(arms: DataFrame, candidates: DataFrame, row: str = "id", value: str = "sim") -> DataFrame:
    """Mean distance (1 - similarity) of each arm's choice."""
    return F.broadcast(arms).join(candidates.select(row, value), row).groupBy("arm").agg(F.count("*").alias("n"), F.round(F.avg(1 - F.col(value)), 6).alias("mean_distance"))


def acquire(df: DataFrame, k: int, mode: str = "exploit", row: str = "id", score: str = "score_geo", sim: str = "sim") -> DataFrame:
    """The k rows of the best score (exploit) or of the greatest distance (explore)."""
    if mode not in ("exploit", "explore"):
        raise ValueError(f"unknown mode {mode!r}")
    return df.orderBy(F.desc(score) if mode == "exploit" else F.asc(sim), row).limit(k)


def acquisition_rounds(pool: DataFrame, measured: DataFrame, rounds: int, k: int, modes: tuple[str, ...] = ("exploit", "explore"), score: Callable[[DataFrame], DataFrame] | None = None, retrain: Callable[[DataFrame], Callable[[DataFrame], DataFrame] | None] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda d: d, row: str = "id") -> DataFrame:
    """round, id, score, measured value of what each round picks: k rows that no earlier round picked.

    score: adds the score columns to a pool; retrain: gets what has been validated so far and may return a new score; keep: writes a round's
    picks (for many rounds, pass a function that writes them to the shared folder, so that plans don't grow).
    """
    history = None
    for n in range(rounds):
        rest = pool if history is None else pool.join(F.broadcast(history.select(row)), row, "left_anti")  # rounds x k rows
        picked = acquire(score(rest) if score else rest, k, modes[n % len(modes)], row).select(row, "score_geo")
        now = keep(F.broadcast(picked).join(measured, row, "left").select(F.lit(n).alias("round"), row, "score_geo", "measured"))
        history = now if history is None else history.unionByName(now)
        if retrain:
            score = retrain(history) or score
    return history


def sampled(source: Callable[[SparkSession, int], DataFrame], spark: SparkSession, n: int, key: str = "key", row: str = "id") -> DataFrame:
    """At most n candidates from a source (a callable that returns a table): rows without a key dropped, keys that repeat once, by row id."""
    found = source(spark, n)
    if missing := {key, row} - set(found.columns):
        raise ValueError(f"the source gives no column {sorted(missing)}")
    return found.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*[c for c in found.columns if c != key]), row).alias("r")).select(key, "r.*").orderBy(row).limit(n)


def component_vector(candidates: DataFrame, numbers: tuple[str, ...], sim: str = "sim", row: str = "id", digits: int = 6) -> DataFrame:
    """What a score is made of: the row id, predictions and properties as rounded doubles (null where there are none), and the distance 1 - similarity."""
    return candidates.select(row, *[F.round(F.col(c).cast("double"), digits).alias(c) for c in numbers], F.round(1 - F.col(sim), digits).cast("double").alias("distance"))


def round_trace(history: DataFrame) -> DataFrame:
    return history.groupBy("round").agg(F.count("*").alias("n"), F.round(F.avg("score_geo"), 6).alias("mean_score"), F.round(F.avg("measured"), 6).alias("mean_measured"))


def ordered_scores(inputs: DataFrame, scores: DataFrame, position: str = "pos", key: str = "key", value: str = "score") -> DataFrame:
    """Every input row in its order with its score; 0 for what could not be scored."""
    return inputs.join(scores.select(key, value), key, "left").select(position, key, F.coalesce(value, F.lit(0.0)).alias(value)).orderBy(position)
