"""Mixing sources to target weights: Pfair slots for blocks of each source.

A source's documents are cut into blocks. Block i (from 1) of a source with weight w, its exact share of all weights, is
released at slot floor((i - 1) / w) and due by slot ceil(i / w); earliest deadline first among the released blocks keeps each
source within less than one block of w * slots at every slot. Weights are whole numbers or decimals and are never rounded:
they become whole slots of a frame as long as their sum (in lowest terms), after which the schedule repeats.

Sources of equal weight are one class that is scheduled as a whole and whose slots go round its members; a member's window
holds the class's window, so the bound stays. The class with most slots has those that the others leave, so a plan holds the blocks
of the other classes in one frame only: it follows from the weights given as a parameter, however many sources the data has.

When a source runs out, its later slots stay empty and the others close ranks. The clock of releases and deadlines is
the slot number with the empty ones counted, so the bound holds against that clock to the end; until the first source runs
out it is the number of blocks placed. Positions count documents and have no gaps.

All ranks come from range-partitioned sorts (`ranked`), so a source with most of the rows is spread over many tasks.

Defined cases: a null source is a source of its own. Sources without a target weight have the mean of the given ones.
Null ids and repeated rows get places of their own (equal rows share theirs in any order). An empty table gives no
rows. Weights of 0 or less are an error. Extra columns are not read by `mix` and kept by
`in_mixed_order`, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from math import gcd, lcm

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, from_files, numbered, ranked, scratch, table, written

BLOCK = 16
#: Target weights of the registered jobs: three favoured sources, the others at 1 (exact in a frame of the sum's length).
PRODUCTION = {"src0": 4, "src1": 2, "src2": Fraction(1, 2)}
PRODUCTION_OTHERS = 1


def whole_weights(weights: list[Fraction]) -> list[int]:
    """The weights as whole numbers in the same ratios, in lowest terms."""
    scale = reduce(lcm, (w.denominator for w in weights), 1)
    whole = [int(w * scale) for w in weights]
    common = reduce(gcd, whole, 0)
    return [w // common for w in whole]


def exact(weight: object) -> Fraction:
    """A weight as the decimal that it is written as."""
    out = weight if isinstance(weight, Fraction) else Fraction(str(weight))
    if out <= 0:
        raise ValueError("a target weight must be over 0; leave the source out of the input instead")
    return out


def frame(slots: list[int], horizon: int | None = None) -> tuple[int, list[np.ndarray | None]]:
    """(the class with most slots, for each other class the slots of its blocks): earliest deadline first (ties by number) in a frame of sum(slots) slots. The
    class with most slots has all that are left, so what is planned are the blocks of the others, whatever the number of its sources.

    horizon: slots that are planned at most, for a frame that is longer than the data.
    """
    length = sum(slots)
    horizon = length if horizon is None else min(length, horizon)
    most = max(range(len(slots)), key=lambda c: (slots[c], -c))
    n = slots[most]
    got: list[list[int]] = [[] for _ in slots]
    ready: list[tuple[int, int]] = []
    waiting = [(0, c) for c in range(len(slots)) if c != most]
    heapq.heapify(waiting)
    t = placed = 0
    while t < horizon and (ready or waiting):
        while waiting and waiting[0][0] <= t:
            c = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(len(got[c]) + 1) * length // slots[c]), c))
        if not ready:
            t = waiting[0][0]
            continue
        due, c = ready[0]
        # the first slot that the large class's next block isn't released for, and the first at which its deadline comes after this one
        early = -(-(placed + 1) * n // (length - n)) + placed
        later = ((due if most > c else due + 1) - 1) * n // length + placed
        at = max(t, min(early, later))
        if waiting and waiting[0][0] <= at:
            t = max(t, waiting[0][0])
            continue
        if at >= horizon:
            break
        heapq.heappop(ready)
        got[c].append(at)
        placed, t = placed + 1, at + 1
        if len(got[c]) < slots[c]:
            heapq.heappush(waiting, (len(got[c]) * length // slots[c], c))
    return most, [None if c == most else np.array(x, np.int64) for c, x in enumerate(got)]


class Frame:
    """Slots of blocks, from what `frame` plans."""

    def __init__(self, slots: list[int], horizon: int | None = None):
        self.slots, self.length = np.array(slots, np.int64), sum(slots)
        self.most, self.planned = frame(slots, horizon)
        taken = np.sort(np.concatenate([np.zeros(0, np.int64), *[x for x in self.planned if x is not None]]))
        self.free = taken - np.arange(len(taken))  # free slots before each taken one

    def slot(self, c: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The slot of each class's block (from 0); frames follow one another."""
        nth, rest = np.divmod(block, self.slots[c])
        out = nth * self.length
        for k, known in enumerate(self.planned):
            own = c == k
            out[own] += rest[own] + np.searchsorted(self.free, rest[own], "right") if known is None else known[rest[own]]
        return out


@dataclass(frozen=True)
class Targets:
    """Exact target weights by source; `others` is the weight of sources that are not named."""

    given: dict[str | None, Fraction]
    others: Fraction

    @classmethod
    def of(cls, weights: Mapping[str | None, object] | None, others: object | None) -> Targets:
        given = {s: exact(w) for s, w in (weights or {}).items()}
        mean = sum(given.values(), Fraction(0)) / len(given) if given else Fraction(1)
        return cls(given, mean if others is None else exact(others))

    @property
    def distinct(self) -> list[Fraction]:
        return sorted({*self.given.values(), self.others})


def slotted(docs: DataFrame, targets: Targets, source: str, block: int, names: tuple[str, str, str]) -> DataFrame:
    """docs with three columns: block number inside the source (from 0), slot of the block, place inside the block."""
    spark = docs.sparkSession
    distinct = targets.distinct
    h, rank, s, c, q, m, k, cc = fresh([*docs.columns, *names], *"_h _rank _s _c _q _m _k _cc".split())
    inside, sizes = ranked(docs.withColumn(h, F.xxhash64(*docs.columns)), [source], [F.col(h)], rank)
    # the parameter's entries and nothing of the data
    known = spark.createDataFrame([(name, distinct.index(w)) for name, w in targets.given.items()], f"{cc} string, {c} int")
    sizes = sizes.withColumnRenamed(source, s)
    sizes = sizes.join(F.broadcast(known), F.col(s).eqNullSafe(F.col(cc)), "left")
    sizes = written(sizes.select(s, "n", F.coalesce(c, F.lit(distinct.index(targets.others))).alias(c)), "sources")
    members, _ = ranked(sizes, [c], [F.col(s).asc_nulls_first()], q)
    classes = sizes.groupBy(c).agg(F.count("*").alias("m"), F.max("n").alias("most")).orderBy(c).collect()  # a row per distinct weight
    if not classes:
        return docs.select("*", *[F.lit(0).cast("bigint").alias(x) for x in names])
    slots = [a * x["m"] for a, x in zip(whole_weights([distinct[x[c]] for x in classes]), classes)]
    length = sum(slots)
    blocks = [-(-x["most"] // block) * x["m"] for x in classes]
    plan = Frame(slots, max(-(-b * length // n) + 1 for b, n in zip(blocks, slots)))
    sizes_ = spark.createDataFrame([(x[c], i, x["m"]) for i, x in enumerate(classes)], f"{cc} int, {k} int, {m} bigint")
    members = members.join(F.broadcast(sizes_), F.col(c) == F.col(cc)).select(s, q, m, k)  # a row per distinct weight
    # the join follows the tables' sizes: small ones are broadcast below Spark's own threshold, others are shuffled
    both = inside.join(written(members, "members"), inside[source].eqNullSafe(F.col(s)))
    both = both.withColumn(names[0], F.expr(f"`{rank}` div {block}"))

    @F.pandas_udf("bigint")
    def slot(c: pd.Series, j: pd.Series) -> pd.Series:
        return pd.Series(plan.slot(c.to_numpy(), j.to_numpy()))

    at = slot(F.col(k), F.col(names[0]) * F.col(m) + F.col(q))
    return both.select(*[inside[x] for x in docs.columns], names[0], at.alias(names[1]), F.pmod(rank, F.lit(block)).alias(names[2]))


def mix(docs: DataFrame, weights: Mapping[str | None, object] | None = None, others: object | None = None, doc_id: str = "doc_id",
        source: str = "source", block: int = BLOCK) -> DataFrame:
    """doc_id, source, block (number inside the source, from 0), slot (of the block), position (of the document in the mix).

    weights: target weight of each source, any scale. others: that of sources which it does not name (the mean of the
    given ones when not given itself, 1 without any).
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"))
    with scratch():
        rows = slotted(rows, Targets.of(weights, others), "source", block, ("block", "slot", "within"))
        out, _ = ranked(rows, [], [F.col("slot"), F.col("within")], "position")
        return written(out.drop("within"), "mix", lasting=True)


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, object] | None = None, others: object | None = None) -> DataFrame:
    """All rows of docs, in files and rows ordered by their place in the mix; the columns of docs.

    Only row numbers, sources and hashes are ranked. Texts are shuffled twice: to meet their slots, and into the order of the mix."""
    row, h, slot, within, block, own_row = fresh(docs.columns, "_row", "_h", "_slot", "_within", "_block", "_own")
    own = numbered(docs, row)
    with scratch():
        narrow = own.select(row, "source", F.xxhash64(*docs.columns).alias(h))
        placed = slotted(narrow, Targets.of(weights, others), "source", BLOCK, (block, slot, within))
        places = written(placed.select(F.col(row).alias(own_row), slot, within), "places", lasting=True)
    both = own.join(places.hint("merge"), F.col(row) == F.col(own_row))  # by shuffles at every size
    return both.repartitionByRange(slot, within).sortWithinPartitions(slot, within).select(*docs.columns)


def stored_places(docs: DataFrame, place: str = "place") -> DataFrame:
    """docs, as read from the files that `in_mixed_order` was written to, with each row's place (from 0) in them. Null for rows that do not
    come from files, which have no order."""
    others = docs.drop(place)
    return numbered(others, place) if from_files(docs) else others.withColumn(place, F.lit(None).cast("bigint"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"), PRODUCTION, PRODUCTION_OTHERS)
